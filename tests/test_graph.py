from pyspark.sql import functions as F

from riskgraph.operators import graph
from tests.conftest import rows


def test_first_row_wins_and_ids_are_cleaned(spark):
    raw = spark.createDataFrame(
        [("a:1", "f", 2, "late"), ("a1", "f", 1, "first"), (":", "f", 3, "empty"),
         ("b", "f", 4, "only")], "order_id string, source_file string, source_pos int, v string")
    assert rows(graph.clean_applications(raw)) == [("a1", "first"), ("b", "only")]


def test_missing_markers_per_edge_type(make_apps):
    apps = make_apps(
        ("1", 1, dict(loan_pan="ds!", device_id="-", email="\\N", mobile="", cert_no="\\N",
                      comp_phone="|-|", contact_mobile="7")),
        ("2", 1, dict(loan_pan="c", mobile="ds!", cert_no="-", comp_phone="01-2|3")))
    strict = rows(graph.to_edges(apps).select("order_id", "edge_type", "entity_value"))
    assert strict == [("1", "CONTACT", "7"), ("2", "BANKCARD", "c"),
                      ("2", "COMPANYPHONE", "0123"), ("2", "MYPHONE", "ds!")]
    loose = rows(graph.to_edges(apps, strict_idcard=False).where("edge_type = 'IDCARD'")
                 .select("order_id", "entity_value"))
    assert loose == [("1", "\\N"), ("2", "-")]


def test_entities_share_one_key_space(make_apps):
    apps = make_apps(("1", 1, dict(mobile="5")), ("2", 2, dict(contact_mobile="5", mobile="5")))
    assert rows(graph.entity_nodes(graph.to_edges(apps))) == [("5", "Phone", 2)]


def test_person_sets(spark):
    sets = spark.createDataFrame(
        [("p", "2020-01-01", "1@@2020-01-02##2@@2020-01-03##bad", "-", "", "\\N", "",
          "0-1@@2020-01-05", "ds!"),
         ("q", "2020-01-09", "1@@2019-12-31", "", "", "", "", "", ""),
         ("", "2020-01-09", "9@@2019-12-31", "", "", "", "", "", "")],
        "cert_no string, apply_date string, mobile string, contact_mobile string, "
        "emergency_contact_mobile string, device_id string, email string, comp_phone string, "
        "loan_pan string")
    items, rejects = graph.unpack_person_sets(sets)
    assert rows(rejects) == [("p", "MYPHONE", "bad")]
    edges = graph.person_edges(items)
    assert rows(edges.select("cert_no", "edge_type", "entity_value", "entity_at")) == [
        ("p", "COMPANYPHONE", "01", "2020-01-05"), ("p", "MYPHONE", "1", "2019-12-31"),
        ("p", "MYPHONE", "2", "2020-01-03"), ("q", "MYPHONE", "1", "2019-12-31")]
    sample = graph.person_sample(spark.createDataFrame([("q",)], "cert_no string"),
                                 spark.createDataFrame([("q",)], "cert_no string"))
    assert graph.person_entities(sample, edges).count() == 1


def test_load_finds_heavy_entities(make_apps):
    apps = make_apps(*[(str(i), 1 + i, dict(mobile="5")) for i in range(10)])
    assert graph.load(apps).blocks.isEmpty()
    blocks = graph.load(apps, block_rows=4).blocks
    found = blocks.selectExpr("count(*)", "max(last_block)", "max(day_start)").first()
    assert tuple(found) == (10, 2, 9) and blocks.first().entity_value == "5"


def test_first_line_of_a_person_counts(spark):
    lines = [("p", "2020-01-02", "1@@2020-01-02", "b", 1), ("p", "2020-01-01", "2@@x", "a", 2),
             ("q", "2020-01-03", "3@@y", "a", 3)]
    sets = spark.createDataFrame(
        [(c, d, m, "", "", "", "", "", "", f, k) for c, d, m, f, k in lines],
        "cert_no string, apply_date string, mobile string, contact_mobile string, "
        "emergency_contact_mobile string, device_id string, email string, comp_phone string, "
        "loan_pan string, source_file string, source_pos int")
    items, rejects = graph.unpack_person_sets(sets)
    assert {(r.cert_no, r.apply_date, r.entity_value) for r in graph.person_edges(items).collect()
            } == {("p", "2020-01-01", "2"), ("q", "2020-01-03", "3")}
    assert rejects.isEmpty()


def test_packed_sets_are_read_once(spark):
    """Edges of persons come from one staged table, with the earliest time seen anywhere."""
    read = spark.sparkContext.accumulator(0)

    def passed(batches):
        for batch in batches:
            read.add(len(batch))
            yield batch

    schema = "cert_no string, apply_date string, edge_type string, entity_value string, label string, entity_at string"
    items = spark.createDataFrame(
        [("a", "d", "EMAIL", "e", "Email", "2020-01-02"), ("a", "d", "EMAIL", "e", "Email", "2020-01-03"),
         ("b", "d", "EMAIL", "e", "Email", "2020-01-01"), (None, "d", "EMAIL", "f", "Email", "2020-01-04")],
        schema).mapInPandas(passed, schema)
    found = graph.person_edges(items).select("cert_no", "entity_value", "entity_at").collect()
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, [
        ("a", "e", "2020-01-01"), ("b", "e", "2020-01-01"), (None, "f", "2020-01-04")]))
    assert read.value == 4


def test_buckets_grow_with_the_edges(spark, make_apps):
    g = graph.load(make_apps(*[(str(i), 1 + i % 9, {"mobile": str(i % 40)}) for i in range(200)]))
    light, _ = graph.store_edges(g, bucket_rows=10)
    assert len({int(f.rsplit("_", 1)[1].split(".")[0]) for f in light.inputFiles()}) > 8
    assert light.exceptAll(g.edges).isEmpty() and light.count() == g.edges.count()


def test_edges_of_some_orders_need_no_shuffle_of_the_edges(spark, make_apps):
    apps = make_apps(*[(str(i), 1 + i % 9, {"mobile": str(i % 40)}) for i in range(200)])
    g, staged = graph.load(apps, stage_edges=False, by_order=True), graph.load(apps)
    assert "staged_path" not in g.edges.__dict__
    assert g.edges.exceptAll(staged.edges).isEmpty() and g.edges.count() == staged.edges.count()
    few = g.applications.where("apply_date < '2020-01-04'").select("order_id")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = g.edges_of(few)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan
        assert rows(got) == rows(staged.edges.join(few, "order_id", "left_semi").select(*got.columns))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
