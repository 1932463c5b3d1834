import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from riskgraph.operators import features, graph, neighbours, running
from riskgraph.plans import fixtures as fx
from riskgraph.schemas import (BLACK_GROUP, CONTRACT_GROUP, ENTITY_GROUP, SLICE_GROUP,
                               group_columns)
from riskgraph.sources.staging import stage
from tests.conftest import APP, SF, TYPES, blocks


def assert_same(one, other):
    columns = sorted(one.columns)
    one, other = stage(one.select(columns), "one"), stage(other.select(columns), "other")
    assert one.count() == other.count() > 0
    assert one.exceptAll(other).isEmpty() and other.exceptAll(one).isEmpty()


def both_ways(edges, cut, prepared, sources=None, metrics=None):
    pairs = neighbours.degree1_pairs(edges, blocks(edges), sources)
    return (features.features(pairs, prepared, 1, metrics).where("edge1 <> 'ALL'"),
            running.single_edge_features(edges, cut, prepared, sources, metrics))


def test_whole_fixture_equals_the_pairs(spark):
    """With every entity of more than five orders cut into spans of time."""
    g = graph.load(fx.applications(spark, SF), block_rows=5)
    prepared = stage(neighbours.prepare_attributes(
        fx.attributes(g.applications), fx.blacklist(g.applications)), "prepared")
    metrics = CONTRACT_GROUP[:4] + ENTITY_GROUP[-5:] + SLICE_GROUP[2:12] + tuple(group_columns(
        SLICE_GROUP[9:14] + CONTRACT_GROUP[:2] + ENTITY_GROUP[2:4] + BLACK_GROUP, True))
    assert_same(*both_ways(g.edges, g.blocks, prepared, fx.contracts(g.applications), metrics))


def odd_orders(seed, n=160):
    """Times within days, unknown and wrong persons, values in several roles, few of each."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        at = datetime(2020, 1, 1) + timedelta(
            days=rng.choice([0, 0, 1, 2, 3, 4, 7, 8, 9, 30, 31, 32, 62, 63, 400]),
            seconds=rng.choice([0, 0, 1, 43200, 86399]), microseconds=rng.choice([0, 0, 999_999]))
        rows.append(tuple([str(i), at]) + tuple({
            **APP, "cert_no": rng.choice([None, "", "a", "b", "c"]),
            "mobile": rng.choice(["", "p1", "p2", "p3"]),
            "contact_mobile": rng.choice(["", "p1", "p2", None]),
            "device_id": rng.choice(["d1", "d2", "-"]), "email": rng.choice(["e1", "e2", None]),
            "loan_pan": rng.choice(["b1", "b2", None]), "product_name": rng.choice(
                ["易分期", "替你还", "x", None]), "type": rng.choice(["pass", "refuse", None]),
            "history_due_day": rng.choice([None, 0, 4, 40])}.values()))
    return rows


SLICES = [m for m in SLICE_GROUP if not m.startswith(("imei", "contact", "company"))]


@pytest.mark.parametrize("seed, metrics", [
    (1, [*CONTRACT_GROUP, *ENTITY_GROUP, *BLACK_GROUP]),
    (2, group_columns(CONTRACT_GROUP + ENTITY_GROUP + BLACK_GROUP, True)),
    (3, SLICES), (4, group_columns(SLICES, True))])
def test_odd_orders_equal_those_from_pairs(spark, seed, metrics):
    rng = random.Random(seed)
    schema = f"order_id string, apply_date timestamp, {TYPES}"
    apps = stage(spark.createDataFrame(odd_orders(seed), schema), "apps")
    # Some orders have no attributes, and some have those of another person.
    swap = F.when(F.col("order_id") % 7 == 0, F.lit(rng.choice("ab"))).otherwise(F.col("cert_no"))
    known = apps.where("order_id % 11 <> 3").withColumn("cert_no", swap)
    black = spark.createDataFrame([("p1", "black_mobile"), ("a", "black_cid"),
                                   ("5", "black_contract"), ("e1", "black_email")],
                                  "content string, type string")
    prepared = stage(neighbours.prepare_attributes(known, black), "prepared")
    edges = stage(graph.to_edges(apps), "edges")
    cut = blocks(edges) if seed % 2 else stage(blocks(edges, 9), "blocks")
    assert_same(*both_ways(edges, cut, prepared, None, tuple(metrics)))


def test_a_hub_needs_no_pairs(spark):
    """100,000 orders share one phone, half of them the person, too: 5 * 10**9 pairs."""
    n, days = 100_000, 1500
    named = {**{c: F.lit(v) for c, v in APP.items()}, "mobile": F.lit("hub"),
             "cert_no": F.when(F.floor(F.col("id") / days) % 2 == 0, "same").otherwise(
                 F.col("id").cast("string")),
             "email": F.concat(F.lit("e"), F.col("id") % 300)}
    day = F.date_add(F.lit(datetime(2015, 1, 1)), (F.col("id") % days).cast("int"))
    apps = stage(spark.range(n).select(F.col("id").cast("string").alias("order_id"),
                                       day.cast("timestamp").alias("apply_date"),
                                       *[c.alias(k) for k, c in named.items()]), "hub")
    edges = stage(graph.to_edges(apps).where("edge_type = 'MYPHONE'"), "hub-edges")
    prepared = stage(neighbours.prepare_attributes(apps), "prepared")
    cut = stage(blocks(edges), "blocks")
    frame = running.single_edge_features(edges, cut, prepared, None, (
        "order_cnt", "pass_contract_cnt", "email_cnt", "email_cnt3_exception_self"))
    plan = frame._jdf.queryExecution().toString()
    assert "order_id_dst" not in plan and "CartesianProduct" not in plan
    rows = frame.where(f"order_id_src >= {n - days}").collect()
    full, more = divmod(n, days)
    assert len(rows) == days - 1                # the first day has no neighbours
    for r in rows:
        k = int(r.order_id_src) % days          # number of the day; one email a day
        before = sum(full + (d < more) for d in range(k))
        assert (r.order_cnt, r.pass_contract_cnt, r.email_cnt, r.email_cnt3_exception_self) == (
            before, before, min(300, k + 1), min(3, k))


def test_plan_of_the_query_has_no_pairs(spark):
    from riskgraph.plans.queries import QUERIES
    for name in ("degree1_contract_metrics", "degree1_slice_metrics", "degree1_black_metrics"):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().toString()
        assert "order_id_dst" not in plan


@pytest.mark.parametrize("seed", [3, 4])
def test_lists_of_light_values_equal_running_totals(spark, seed):
    """Few orders share a value: they are counted by a list, without events, windows or spans."""
    nodes = spark.createDataFrame(odd_orders(seed, 60), f"order_id string, apply_date timestamp, {TYPES}")
    g = graph.load(nodes, block_rows=5)
    listed = spark.createDataFrame([("black_mobile", "p1"), ("black_contract", "7")],
                                   "type string, content string")
    prepared = stage(neighbours.prepare_attributes(fx.attributes(nodes), listed), "prepared")
    metrics = CONTRACT_GROUP[:3] + ENTITY_GROUP[:4] + ENTITY_GROUP[-2:] + BLACK_GROUP[-4:] + SLICE_GROUP[
        ::5] + tuple(group_columns(CONTRACT_GROUP[:2] + ENTITY_GROUP[1:3] + SLICE_GROUP[::7], True))
    lists = running.single_edge_features(g.edges, g.blocks, prepared, None, metrics)
    assert "Window" not in lists._jdf.queryExecution().executedPlan().toString()
    assert_same(lists, running.single_edge_features(g.edges, g.blocks, prepared, None, metrics,
                                                    list_rows=0))


def test_days_are_counted_of_heavy_keys_only(spark):
    rows = spark.createDataFrame([("a", datetime(2020, 1, 1 + i % 3)) for i in range(9)]
                                 + [("b", datetime(2020, 1, 1)), (None, datetime(2020, 1, 1))],
                                 "entity_value string, apply_date timestamp")
    cut = blocks(rows, 4)
    plan = cut._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1
    assert sorted(map(tuple, cut.collect())) == [
        ("a", datetime(2020, 1, 1 + d).date(), 3, 3 * d, 2, 4) for d in range(3)]


def test_batches_of_values_equal_all_at_once(spark):
    apps = stage(spark.createDataFrame(odd_orders(6), f"order_id string, apply_date timestamp, "
                                       f"{TYPES}"), "apps")
    g = graph.load(apps, block_rows=5)
    prepared = stage(neighbours.prepare_attributes(g.applications), "prepared")
    metrics = CONTRACT_GROUP[:2] + ENTITY_GROUP[:2]
    one, more = (running.single_edge_features(g.edges, g.blocks, prepared, None, metrics, 9, size)
                 for size in (10_000, -(-g.edges.count() // 2)))
    assert "answers-1" in "".join(more.inputFiles()) and "answers" not in "".join(one.inputFiles())
    assert_same(one, more)
