import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from riskgraph.functions import joins
from riskgraph.operators import graph, neighbours, paths
from riskgraph.plans import fixtures as fx
from riskgraph.plans.queries import as_text
from riskgraph.sources import staging
from tests.conftest import SF, blocks, rows

KEYS = ["order_id_src", "edg_type_src1", "edg_type_dst1", "order_id_dst1"]


def test_only_strictly_earlier_orders_link(make_apps):
    edges = graph.to_edges(make_apps(
        ("1", 1, dict(mobile="5")), ("2", 1, dict(mobile="5")), ("3", 2, dict(contact_mobile="5")),
        ("4", 3, dict(email="none"))))
    assert rows(paths.degree1(edges, blocks(edges)).select(*KEYS)) == [
        ("3", "CONTACT", "MYPHONE", "1"), ("3", "CONTACT", "MYPHONE", "2")]
    assert paths.degree1(edges, blocks(edges)).columns == paths.DEGREE1_COLUMNS


def test_unordered_export_needs_two_relationships(make_apps):
    edges = graph.to_edges(make_apps(("1", 1, dict(mobile="5", contact_mobile="5")),
                                     ("2", 1, dict(mobile="5"))))
    found = rows(paths.degree1_unordered(edges, blocks(edges)).select(*KEYS))
    assert ("1", "CONTACT", "MYPHONE", "1") in found and ("2", "MYPHONE", "MYPHONE", "1") in found
    assert ("1", "MYPHONE", "MYPHONE", "1") not in found and len(found) == 6


def test_second_hop_uses_another_relationship(make_apps):
    edges = graph.to_edges(make_apps(
        ("1", 1, dict(mobile="5", cert_no="a")),
        ("2", 2, dict(mobile="5", contact_mobile="5", cert_no="b")),
        ("3", 3, dict(mobile="5", cert_no="c")), ("4", 4, dict(mobile="5", cert_no="a"))))
    found = rows(paths.degree2(edges, blocks(edges)).select(
        "order_id_src", "edg_type_dst1", "order_id_dst1", "edg_type_src2", "order_id_dst2"))
    # Order 3 reaches order 1 through order 2 in by one of its two types and out by the other;
    # order 4 belongs to the person of order 1, and order 3 has a single relationship.
    assert [r for r in found if r[0] == "3"] == [
        ("3", "CONTACT", "2", "MYPHONE", "1"), ("3", "MYPHONE", "2", "CONTACT", "1")]
    assert not [r for r in found if r[0] == "4" and r[4] == "1"]


def test_blocks_give_the_same_result(spark):
    g = graph.load(fx.applications(spark, SF), block_rows=5)
    assert not g.blocks.isEmpty()
    whole = blocks(g.edges)
    assert whole.isEmpty()
    src = fx.contracts(g.applications)
    for make in (paths.degree1, paths.degree1_unordered, neighbours.degree2_pairs):
        cut, plain = (make(g.edges, b, src) for b in (g.blocks, whole))
        assert cut.count() == plain.count() and cut.exceptAll(plain).isEmpty()


def test_one_day_of_a_heavy_entity_is_cut(spark, make_apps):
    """One value on one day and the next, far above the block size."""
    apps = make_apps(*[(str(i), 1 + i // 60, dict(mobile="5", cert_no=f"c{i % 7}"))
                       for i in range(150)])
    edges = graph.to_edges(apps)
    small = blocks(edges, 8)
    assert small.where("entity_value = '5'").selectExpr("max(last_block)").first()[0] == 18
    for make in (paths.degree1, paths.degree1_unordered):
        cut, plain = (make(edges, b) for b in (small, blocks(edges)))
        assert cut.count() == plain.count() and cut.exceptAll(plain).isEmpty()
    left = edges.where("entity_value = '5'")
    placed = joins._placed(left, "entity_value", "apply_date", "order_id", small)
    sizes = [r[0] for r in placed.groupBy("own").agg(F.count(F.lit(1)).alias("n")).select(
        "n").collect()]
    assert len(sizes) == 19 and max(sizes) < 30


def test_no_files_are_left_but_the_graph(spark):
    folder = staging.staging_folder(spark)
    table = staging.stage(spark.range(5), "gone")
    assert table.count() == 5
    staging.unstage(table)
    assert not [f for f in Path(folder).iterdir() if f.name.startswith("gone")]
    with pytest.raises(ValueError):
        staging.drop_path(spark, "/somewhere/else")
    assert "hint" in joined_plan(spark.range(9), 10) and "hint" not in joined_plan(spark.range(9), 8)


def joined_plan(df, bound):
    kept = staging.broadcast_below(df, bound)
    return kept._jdf.queryExecution().logical().toString().lower().replace("resolvedhint", "hint")


def test_pairs_equal_the_paths(spark):
    g = graph.load(fx.applications(spark, SF))
    src = fx.contracts(g.applications)
    from_paths = paths.degree2(g.edges, g.blocks, src).select(
        "order_id_src", F.col("edg_type_src1").alias("edge1"),
        F.col("edg_type_src2").alias("edge2"),
        F.col("order_id_dst2").alias("order_id_dst")).distinct()
    pairs = neighbours.pairs_by_edge(neighbours.degree2_pairs(g.edges, g.blocks, src), 2).where(
        "order_id_src <> order_id_dst").select(*from_paths.columns)
    assert pairs.count() == from_paths.count() and pairs.exceptAll(from_paths).isEmpty()


def repeated_orders(make_apps):
    """Orders around one hub, one of them twice with other values and another day."""
    return make_apps(
        ("1", 1, dict(mobile="7", cert_no="a")), ("3", 2, dict(email="m@x", cert_no="d")),
        ("2", 4, dict(mobile="7", email="m@x", cert_no="b")),
        ("2", 6, dict(mobile="7", device_id="d", cert_no="e")),
        ("4", 5, dict(device_id="d", cert_no=None)), ("5", 3, dict(device_id="d", cert_no="f")),
        *[(str(10 + i), 5 + i % 4, dict(mobile="7", cert_no=f"c{i}")) for i in range(9)])


def test_second_hop_is_found_once_for_a_middle_order(spark, make_apps):
    """First hops are joined by their middle order and are not sent to each value of it."""
    edges = graph.to_edges(make_apps(("1", 1, dict(mobile="5")), ("2", 2, dict(mobile="5"))))
    found = paths.degree2(edges, blocks(edges), day_text=True)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"at_dst1#\d+ = at_dst1#\d+", plan)
    top = plan[:plan.index("Join")]
    assert "date_format" not in top


def test_edges_at_hand_give_the_same_paths(spark, make_apps):
    apps = repeated_orders(make_apps)
    edges = graph.to_edges(apps)
    few = spark.createDataFrame([("11",), ("14",), ("2",), (None,)], "order_id string")
    g = graph.load(apps, stage_edges=False)
    cut = blocks(edges)
    near, reach = g.edges_of(few), g.before(few)
    assert 0 < reach.count() < edges.count()
    for text in (False, True):
        shown = as_text if text else (lambda df: df)
        pairs = ((paths.degree1(edges, cut, few), paths.degree1(reach, cut, day_text=text, near=near)),
                 (paths.degree2(edges, cut, few),
                  paths.degree2(edges, cut, day_text=text, near=near, reach=reach)))
        for plain, got in pairs:
            plain = shown(plain)
            assert got.columns == plain.columns and got.dtypes == plain.dtypes
            assert got.count() == plain.count() > 0 and got.exceptAll(plain).isEmpty()
    empty = graph.load(apps, stage_edges=False).before(few.where("order_id = '0'"))
    assert empty.isEmpty()


def test_hops_of_repeated_orders_follow_the_definition(spark, make_apps):
    """Each row of the middle order's id lends its values to all of them, as by the plain joins."""
    edges = graph.to_edges(repeated_orders(make_apps))
    first = paths.degree1(edges, blocks(edges))
    out = edges.select(F.col("order_id").alias("order_id_dst1"),
                       F.col("edge_type").alias("t2"), F.col("entity_value").alias("v2"))
    far = edges.select(F.col("order_id").alias("far"), F.col("cert_no").alias("far_cert"),
                       F.col("apply_date").alias("far_at"), F.col("edge_type").alias("t3"),
                       F.col("entity_value").alias("v2"))
    want = (first.join(out, "order_id_dst1").join(far, "v2").where(
        "far_at < apply_date_dst1 and far <> order_id_src and far_cert <> cert_no_src "
        "and not (edg_type_dst1 = t2 and contact_value1 = v2)")
        .select(*paths.DEGREE1_COLUMNS, "t2", "v2", "t3", "far"))
    got = paths.degree2(edges, blocks(edges)).select(
        *paths.DEGREE1_COLUMNS, "edg_type_src2", "contact_value2", "edg_type_dst2", "order_id_dst2")
    assert rows(got) == rows(want) and want.count() > 0


def test_export_dates_are_made_text_once_for_an_edge(make_apps):
    edges = graph.to_edges(make_apps(("1", 1, dict(mobile="5")), ("2", 2, dict(mobile="5"))))
    found = paths.degree1(edges, blocks(edges), day_text=True)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("date_format")
    assert rows(found) == rows(as_text(paths.degree1(edges, blocks(edges))))
