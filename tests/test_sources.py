"""Stored tables: pruning, stored edges, the back-fill's record, and what queries leave behind."""

import time
from datetime import date
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from riskgraph.functions import joins
from riskgraph.operators import evaluate, graph, model, paths, reshape, sampling
from riskgraph.plans import backfill, fixtures as fx, queries
from riskgraph.sources import readers, staging, writers
from riskgraph.sources.staging import stage
from tests.conftest import SF


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_ranges_read_only_their_folders(spark, tmp_path):
    orders = fx.order_table(fx.applications(spark, SF))
    writers.write_orders(orders, str(tmp_path / "orders"))
    stored = readers.read_orders(spark, str(tmp_path / "orders"))
    assert stored.count() == 1500
    days = readers.scan_days(stored, date(1996, 12, 30), date(1997, 1, 3))
    files = {f.split("/orders/")[1].rsplit("/", 1)[0] for f in days.inputFiles()}
    want = {tuple(r) for r in days.select("year", "month", "day").distinct().collect()}
    assert len(files) >= len(want) >= 2
    scan = plan_of(days)
    assert "PartitionFilters: [" in scan and "PartitionFilters: []" not in scan
    assert "year" in scan.split("PartitionFilters:")[1].split("PushedFilters")[0]
    months = readers.scan_months(stored, date(1996, 12, 1), date(1997, 2, 1))
    assert {tuple(r) for r in months.select("year", "month").distinct().collect()} == {
        (1996, 12), (1997, 1)}


def test_a_day_over_stored_edges_shuffles_its_orders_only(spark):
    g = graph.load(fx.applications(spark, SF))
    store = graph.store_edges(g)
    assert store[0].count() == g.edges.count() and store[1].isEmpty()
    sources = fx.order_table(g.applications).where("year = 1996 and month = 3")
    found = paths.degree1(g.edges, g.blocks, sources, store)
    plain = paths.degree1(g.edges, g.blocks, sources)
    assert found.count() == plain.count() > 0 and found.exceptAll(plain).isEmpty()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        light = paths.degree1(g.edges, g.blocks.limit(0), sources, store)
        plan = plan_of(light)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    bucketed = [line for line in plan.splitlines() if "Bucketed: true" in line]
    assert bucketed and all("SelectedBucketsCount" in line for line in bucketed)
    # Edges of heavy values are kept apart and joined in cells.
    cut = graph.load(fx.applications(spark, SF), block_rows=5)
    parts = graph.store_edges(cut)
    assert not parts[1].isEmpty() and parts[0].count() + parts[1].count() == cut.edges.count()
    again = paths.degree1(cut.edges, cut.blocks, sources, parts)
    assert again.count() == plain.count() and again.exceptAll(plain).isEmpty()


def test_back_fill_takes_up_what_is_left(spark, tmp_path):
    g = graph.load(fx.applications(spark, SF))
    orders = fx.order_table(g.applications)
    asked, broken = [], {date(1996, 2, 2)}

    def export(day_orders, day):
        asked.append(day)
        if day in broken:
            raise ValueError("no such table")
        return paths.degree1(g.edges, g.blocks, day_orders)

    folder, span = str(tmp_path / "fill"), (date(1996, 2, 1), date(1996, 2, 3))
    first = {r.day: r for r in backfill.back_fill(orders, export, folder, *span).collect()}
    assert len(asked) == 3 and first[date(1996, 2, 2)].state == "failed"
    assert first[date(1996, 2, 2)].error == "no such table"
    broken.clear()
    second = backfill.back_fill(orders, export, folder, *span)
    assert asked[3:] == [date(1996, 2, 2)] and second.count() == 4
    assert second.where("state = 'done'").count() == 3
    backfill.back_fill(orders, export, folder, *span)
    assert len(asked) == 4
    want = paths.degree1(g.edges, g.blocks, readers.scan_days(orders, *span))
    stored = spark.read.parquet(folder + "/paths").select(*want.columns)
    assert stored.count() == want.count() and stored.exceptAll(want).isEmpty()
    assert second.agg(F.sum("rows")).first()[0] == want.count()


@pytest.mark.parametrize("name", ["degree1_contract_metrics", "degree1_wide", "column_profile"])
def test_queries_leave_nothing_behind(spark, name):
    def kept():
        return {f.name for f in Path(staging.staging_folder(spark)).iterdir()}

    before = kept()
    result = queries.QUERIES[name](spark, SF)
    assert result.count() > 0
    staging.unstage(result)
    assert kept() <= before


def test_the_shared_folder_is_no_local_one_on_a_cluster(spark, monkeypatch):
    class Session:
        class conf:
            @staticmethod
            def get(name, default=None):
                return default if name == staging.SETTING else "file:/warehouse"

        class sparkContext:
            master = "yarn"

    with pytest.raises(ValueError):
        staging.staging_folder(Session)


def test_lookups_copy_hot_keys_only(spark):
    facts = spark.range(1000).select((F.col("id") % 10 * (F.col("id") < 300).cast("int")).alias("k"),
                                     F.col("id").alias("i"))
    unique = spark.range(12).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    heavy = joins.heavy_keys(facts, ["k"], 100)
    assert {(r.k, r.copies) for r in heavy.collect()} == {(0, 8)}
    got = joins.counted_lookup(facts, unique, ["k"], F.col("i"), rows=100)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, facts.join(unique, "k").collect()))
    left = joins.counted_lookup(facts, unique.where("k > 3"), ["k"], F.col("i"), "left", 100)
    assert left.count() == 1000 and left.where("v is null").count() == facts.where("k <= 3").count()


def test_samples_are_refined_to_small_ranges(spark):
    df = spark.range(3000).select((F.col("id") % 400).cast("string").alias("order_id"))
    keys = sorted(((r.h, r.order_id) for r in df.select(
        sampling.hash_key("order_id", 3).alias("h"), "order_id").collect()))
    for bound in (1, 3, 50_000):
        for n in (1, 8, 1499, 2999, 3000, 3001):
            got = sampling.random_rows(df, n, "order_id", 3, bound).count()
            least = keys[n - 1] if n <= 3000 else keys[-1]
            assert got == sum(k <= least for k in keys), (bound, n)


def test_vectors_and_the_model_as_a_table(spark, tmp_path):
    """Vectors hold the sparse rows, node joins equal the library, metrics equal SQL."""
    rows = staging.stage(queries._sparse_training(spark, SF), "sparse")
    size = len(reshape.training_titles())
    sparse = model.sparse_vectors(rows, size)
    want = {r.order_id: r for r in rows.collect()}
    got = {r.order_id: r.features for r in sparse.collect()}
    assert got.keys() == want.keys() and all(v.size == size for v in got.values())
    assert all(list(got[k].indices) == want[k].indices and list(got[k].values) == want[k]["values"]
               for k in want)
    dense = model.vectors(rows.select(*model.ID_COLUMNS, F.coalesce(F.get("values", F.lit(0)), F.lit(
        None)).alias("a"), F.lit("text").alias("b"))).collect()
    assert all(list(r.features) == [(want[r.order_id]["values"] or [0.0])[0], 0.0] for r in dense)
    train = sparse.withColumn("label", (F.col("label") == 1).cast("int"))
    fitted = model.train(train, maxIter=4, maxDepth=3, minInstancesPerNode=2)
    scores = staging.stage(model.score(fitted, train), "scores")
    nodes = model.tree_nodes(fitted.stages[-1], str(tmp_path / "model"))
    assert nodes.select("tree").distinct().count() == 4
    by_nodes = model.score_by_nodes(rows, nodes, 4, 3)
    both = by_nodes.join(scores.withColumnRenamed("score", "whole"), "order_id")
    assert both.count() == len(want)
    assert both.where("abs(score - whole) > 1e-9").isEmpty()
    # The metrics once more, by SQL over the written scores.
    table = scores.select("score", "label").toPandas()  # noqa: F841 - read by name below
    sql = """WITH c AS (SELECT score, sum(label) AS pos, sum(1 - label) AS neg FROM table GROUP BY 1),
        t AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS np,
              sum(neg) OVER () AS nn FROM c WINDOW w AS (ORDER BY score DESC)),
        l AS (SELECT *, lag(tp, 1, 0) OVER v AS tp0, lag(fp, 1, 0) OVER v AS fp0 FROM t
              WINDOW v AS (ORDER BY score DESC))
      SELECT sum((fp - fp0) / nn * (tp + tp0) / np / 2) AS roc,
        sum((tp - tp0) / np * (tp / (tp + fp)
            + CASE WHEN tp0 + fp0 = 0 THEN tp / (tp + fp) ELSE tp0 / (tp0 + fp0) END) / 2) AS pr,
        (SELECT avg((score - label) * (score - label)) FROM table) AS mse FROM l"""
    roc, pr, mse = duckdb.sql(sql.replace("FROM table", "FROM \"table\"")).fetchall()[0]
    areas = evaluate.areas(evaluate.cumulative(evaluate.score_counts(scores))).first()
    assert areas.area_under_roc == pytest.approx(roc) and areas.area_under_pr == pytest.approx(pr)
    assert evaluate.mean_squared_error(scores).first()[0] == pytest.approx(mse)


def test_staging_leaves_no_shuffle_files(spark):
    """The driver's garbage may live long: shuffle files go when their table is written."""
    folder = Path(spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager()
                  .diskBlockManager().localDirs()[0].getPath())

    def shuffled():
        return {p for p in folder.rglob("shuffle_*") if p.is_file()}

    before = shuffled()
    table = stage(spark.range(5000).groupBy((F.col("id") % 999).alias("k")).count(), "counted")
    for _ in range(50):
        if not shuffled() - before:
            break
        time.sleep(0.2)
    assert not shuffled() - before
    assert table.count() == 999
    assert staging.FREE_SHUFFLES not in {r.key for r in spark.sql("set").collect()}
