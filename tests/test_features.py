import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from riskgraph.operators import features, graph, neighbours, reshape
from riskgraph.plans import fixtures as fx, oracle
from riskgraph.schemas import INCLUDE_METRICS, titles
from riskgraph.sources import staging
from riskgraph.sources.staging import stage
from tests.conftest import SF, TYPES, blocks
from tests.test_running import assert_same, odd_orders

CHECKED = ["clean_applications", "unpack_person_sets", "entity_nodes", "degree1_paths",
           "degree1_exclude_self_slices", "degree2_slice_metrics", "degree1_black_metrics",
           "degree1_exclude_self_contract", "features_long_by_title", "label_v2",
           "balanced_sample", "large_sample", "auc_summary", "degree2_wide", "degree2_sparse",
           "degree2_pairs", "degree2_paths", "degree1_paths_unordered", "person_split",
           "csv_applications", "csv_application_rejects", "csv_person_edges", "csv_person_rejects",
           "degree1_backfill_range", "backfilled_paths", "backfill_record", "rewritten_paths",
           "rewritten_features", "replaced_table", "training_vectors", "monthly_orders",
           "degree1_contract_metrics", "degree1_slice_metrics"]


@pytest.mark.parametrize("name", CHECKED)
def test_query_matches_sql(spark, name):
    got = entry.queries()[name](spark, SF).toPandas()
    con = duckdb.connect()
    for table in ("orders", "lineitem"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    want = con.execute(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and len(got) == len(want)
    cols = ", ".join(f'"{c}"' for c in sorted(got.columns))
    con.register("got", got)
    con.register("want", want)
    left = f"SELECT {cols} FROM got EXCEPT ALL SELECT {cols} FROM want"
    assert con.execute(f"SELECT count(*) FROM ({left})").fetchone()[0] == 0


def _frame(apps, blacklist=None, metrics=None):
    edges = graph.to_edges(apps)
    pairs = neighbours.degree1_pairs(edges, blocks(edges))
    return features.features(pairs, neighbours.prepare_attributes(apps, blacklist), 1, metrics)


def test_presence_scopes_and_duplicates_in_the_blacklist(spark, make_apps):
    apps = make_apps(
        ("1", 1, dict(mobile="5", cert_no="a", email="m@x")),
        ("2", 3, dict(mobile="5", cert_no="a", email="m@x")),
        ("3", 20, dict(mobile="5", cert_no="b", email="n@x", type="refuse")))
    black = spark.createDataFrame([("a", "black_cid"), ("a", "black_cid")],
                                  "content string, type string")
    got = {(r.order_id_src, r.edge1): r for r in _frame(apps, black).collect()}
    assert set(got) == {(o, e) for o, es in (("2", ("MYPHONE", "IDCARD", "EMAIL", "ALL")),
                                             ("3", ("MYPHONE", "ALL"))) for e in es}
    two, three = got["2", "MYPHONE"], got["3", "MYPHONE"]
    assert (two.order_cnt, two.cid_cnt, two.cid_cnt1, two.black_cid_cnt) == (1, 1, 1, 1)
    # The only neighbour of order 2 is the same person: nothing exists without self.
    assert two.order_cnt_exception_self is None and two.cid_cnt_exception_self is None
    assert (three.order_cnt, three.cid_cnt, three.cid_cnt7, three.email_cnt30) == (2, 2, 1, 2)
    assert three.cid_cnt7_exception_self is None and three.cid_cnt30_exception_self == 1
    assert three.pass_contract_cnt == 2 and three.black_mobile_cnt is None
    assert three.current_overdue3_contract_cnt == 0


def test_null_person_drops_out_of_the_other_person_scope(make_apps):
    apps = make_apps(("1", 1, dict(mobile="5", cert_no=None)),
                     ("2", 2, dict(mobile="5", cert_no="b")),
                     ("3", 3, dict(mobile="5", cert_no="")))
    got = {r.order_id_src: r for r in _frame(apps).where("edge1 = 'MYPHONE'").collect()}
    assert got["2"].cid_cnt_exception_self is None
    assert got["3"].cid_cnt_exception_self == 1 and got["3"].cid_cnt == 2


def test_bits_are_opened_without_a_try_of_each(spark):
    masks = [0, 1, 5, 255, (1 << 9) - (1 << 63), -1]
    rows = spark.createDataFrame([(m,) for m in masks], "mask long")
    for degree, bits in ((1, 8), (2, 64)):
        got = neighbours.with_set_bits(rows, "mask", degree, also_all=True)
        assert got.columns == ["mask", "bit"]
        assert sorted(map(tuple, got.collect())) == sorted(
            (m, b) for m in masks for b in range(-1, bits) if b < 0 or m >> b & 1)


def test_wide_columns_cost_no_aggregate_each(spark):
    frame = spark.createDataFrame(
        [("1", "ALL", 3, 4), ("1", "DEVICE", None, 2), ("2", "MYPHONE", 1, 1)],
        "order_id_src string, edge1 string, cid_cnt long, order_cnt long")
    columns = ["order_cnt_device", "cid_cnt", "cid_cnt_device", "none", "order_cnt"]
    wide = reshape.to_wide(frame, 1, columns)
    assert wide.columns == ["order_id_src", *columns]
    assert sorted(map(tuple, wide.collect())) == [
        ("1", 2, 3, None, None, 4), ("2", None, None, None, None, None)]
    assert "pivotfirst" not in wide._jdf.queryExecution().toString()
    packed = reshape.pack_scopes(frame).withColumnRenamed("scopes", "degree1_scopes")
    zeros = reshape.open_scopes(packed, ["order_id_src"], {"degree1_scopes": (1, columns)}, 0)
    assert zeros.columns == ["order_id_src", *[f"degree1_{c}" for c in columns]]
    assert sorted(map(tuple, zeros.collect())) == [("1", 2, 3, 0, 0, 4), ("2", 0, 0, 0, 0, 0)]


def test_pairs_shuffle_far_edges_once(spark, make_apps):
    """They are made distinct where the join by value needs them, not by all columns first."""
    apps = make_apps(("1", 1, {"mobile": "7"}), ("2", 2, {"mobile": "7", "contact_mobile": "7"}))
    edges = graph.to_edges(apps)
    pairs = neighbours.degree1_pairs(edges, blocks(edges))
    assert sorted((r.order_id_src, r.order_id_dst) for r in pairs.collect()) == [
        ("2", "1"), ("2", "2")]
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [entity_value" in plan


def test_slices_scopes_and_wide_form(spark):
    frame = entry.QUERIES["degree1_all_edges"](spark, SF).withColumn("edge1", F.lit("ALL"))
    frame = frame.cache()
    grows = " or ".join(
        f"{m}1 > {m}3 or {m}3 > {m}7 or {m}7 > {m}30 or {m}30 > {m}"
        for m in ("cid_cnt", "mobile_cnt", "company_phone_cnt"))
    assert frame.where(grows).isEmpty()
    assert frame.where(" or ".join(f"{m}_exception_self > {m}" for m in INCLUDE_METRICS)).isEmpty()
    assert frame.where("black_cid_cnt > cid_cnt").isEmpty()
    long = features.to_long(frame)
    names = [t for t in titles(1) if t in set(INCLUDE_METRICS)]
    wide = reshape.to_wide(frame, 1, names + ["no_such_title"])
    assert wide.where("no_such_title is not null").isEmpty()
    back = wide.drop("no_such_title").unpivot("order_id_src", names, "title", "cnt").where(
        "cnt is not null").select("order_id_src", "cnt", "title")
    assert back.exceptAll(long.where(F.col("title").isin(names))).isEmpty()
    sparse = reshape.to_sparse(long, 1)
    order = titles(1)
    opened = sparse.select("order_id_src", F.posexplode("indices").alias("k", "idx"),
                           "values").select(
        "order_id_src", F.get("values", F.col("k")).alias("cnt"),
        F.get(F.array(*map(F.lit, order)), F.col("idx")).alias("title"))
    assert opened.exceptAll(long.where("cnt <> 0")).isEmpty()
    assert opened.count() == long.where("cnt <> 0").count() and sparse.count() == frame.count()


def test_counting_shuffles_twice_and_combines_first(spark, make_apps):
    """One source with many neighbours of one product: partial sums before each exchange."""
    apps = make_apps(*[(str(i), 1, dict(mobile="5", cert_no=str(i))) for i in range(300)],
                     ("900", 2, dict(mobile="5", cert_no="z")))
    edges = graph.to_edges(apps)
    pairs = staging.stage(neighbours.degree1_pairs(edges, blocks(edges)), "pairs")
    prepared = staging.stage(neighbours.prepare_attributes(apps), "prepared")
    frame = features.features(pairs, prepared, 1)
    row = frame.where("order_id_src = '900' and edge1 = 'MYPHONE'").first()
    assert (row.order_cnt, row.cid_cnt, row.product_cnt, row.cid_cnt1) == (300, 301, 1, 301)
    plan = frame._jdf.queryExecution().sparkPlan().toString()
    counted = frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert counted.count("Exchange hashpartitioning") <= 4 and "partial_sum" in plan


def test_title_lists():
    assert len(titles(2)) == 3835 and len(titles(1)) == 118 * 9
    assert len(reshape.degree1_wide_titles()) == 309
    assert oracle.TITLES2 == titles(2)


@pytest.mark.parametrize("degree, list_rows", [(1, 100), (1, 2), (2, 100), (2, 2)])
def test_lists_equal_features_of_pairs(spark, degree, list_rows):
    """Links that come as lists give the features of the pairs; no row per attribute is shuffled."""
    rows = odd_orders(5, 50)
    nodes = spark.createDataFrame(rows + rows[:4], f"order_id string, apply_date timestamp, {TYPES}")
    g = graph.load(nodes, block_rows=6)
    prepared = stage(neighbours.prepare_attributes(fx.attributes(nodes)), "prepared")
    make = neighbours.degree1_pairs if degree == 1 else neighbours.degree2_pairs
    pairs = features.features(make(g.edges, g.blocks), prepared, degree)
    lists = features.graph_features(g.edges, g.blocks, prepared, degree, list_rows=list_rows)
    assert_same(lists, pairs)
    plan = lists._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(order_id_src" in plan and ", attr#" not in "".join(
        line for line in plan.splitlines() if "Exchange" in line)
    few = ["order_cnt", "pass_contract_cnt", "q_order_cnt"]
    assert_same(features.graph_features(g.edges, g.blocks, prepared, degree, None, few),
                pairs.select([c for c in pairs.columns if c.startswith(("order_id", "edge"))] + few)
                .where(" or ".join(f"{m} is not null" for m in few)))


@pytest.mark.parametrize("degree", [1, 2])
def test_batches_of_sources_equal_all_at_once(spark, degree):
    apps = stage(spark.createDataFrame(odd_orders(5, 60), f"order_id string, apply_date timestamp, "
                                       f"{TYPES}"), "apps")
    g = graph.load(apps)
    prepared = stage(neighbours.prepare_attributes(g.applications), "prepared")
    sources = apps.where(F.col("order_id").cast("int") % 3 > 0)
    half = -(-sources.count() // 2)

    def found(**how):
        return features.graph_features(g.edges, g.blocks, prepared, degree, sources,
                                       INCLUDE_METRICS[:3], only=F.col("edge1") != "EMAIL", **how)

    one, more = found(), found(batch_sources=half)
    named = f"features{degree}-1"
    assert named in "".join(more.inputFiles()) and named not in "".join(one.inputFiles())
    assert_same(one, more)
    if degree == 2:
        assert_same(neighbours.degree2_pairs(g.edges, g.blocks, sources),
                    neighbours.degree2_pairs(g.edges, g.blocks, sources, batch_sources=half))
