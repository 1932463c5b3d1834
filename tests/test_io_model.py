from datetime import date

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from riskgraph.operators import evaluate, labels, model, paths, profile, sampling, graph
from riskgraph.schemas import APPLICATION_FIELDS
from riskgraph.sources import readers, writers
from tests.conftest import blocks, rows


def test_read_applications(spark, tmp_path):
    line = [f" v{i} " for i in range(len(APPLICATION_FIELDS))]
    line[5], line[20], line[21] = "2020-01-02 03:04:05", "7", "\\N"
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "a.csv").write_text(",".join(line) + ",extra\n" + "too,short\n")
    good, bad = readers.read_applications(spark, str(tmp_path))
    row = good.first()
    assert (row.order_id, row.fail_reason, row.current_due_day, row.history_due_day) == (
        "v0", "v28", 7, None)
    assert str(row.apply_date) == "2020-01-02 03:04:05"
    assert bad.first().line == "too,short" and bad.first().source_file.endswith("a.csv")
    assert graph.clean_applications(good).first().order_id == "v0"
    odd = ["x"] * len(APPLICATION_FIELDS)
    odd[0], odd[5], odd[11] = "\u30001\t", "2020-01-02", "\t\u00a0555\u3000"
    late = ["y"] * len(APPLICATION_FIELDS)
    late[5] = "2020/13/44"
    (tmp_path / "odd.csv").write_text(",".join(odd) + "\n" + ",".join(late) + "\n")
    good, bad = readers.read_applications(spark, str(tmp_path / "odd.csv"))
    assert [(r.order_id, r.mobile) for r in good.collect()] == [("1", "555")]
    assert bad.first().line == ",".join(late) and bad.count() == 1
    (tmp_path / "p").mkdir()
    (tmp_path / "p" / "a.csv").write_text("c,d,1@@2,,,,,,\nc,d\n")
    good, bad = readers.read_person_sets(spark, str(tmp_path / "p"))
    assert good.first().mobile == "1@@2" and bad.count() == 1


def test_ranges(spark):
    t = spark.createDataFrame([("a", "2019", "12", "31"), ("b", "2020", "01", "01"),
                               ("c", "2020", "02", "01")],
                              "order_id string, year string, month string, day string")
    days = readers.scan_days(t, date(2019, 12, 31), date(2020, 1, 1))
    assert [r[0] for r in rows(days)] == ["a", "b"]
    months = readers.scan_months(t, date(2019, 12, 1), date(2020, 2, 1))
    assert [r[0] for r in rows(months)] == ["a", "b"]


def test_partitioned_writes_are_repeatable(spark, make_apps, tmp_path):
    edges = graph.to_edges(make_apps(
        ("1", 1, dict(mobile="5")), ("2", 2, dict(mobile="5")), ("3", 3, dict(mobile="5"))))
    found = paths.degree1(edges, blocks(edges))
    for _ in range(2):
        writers.write_paths(found, str(tmp_path / "paths"))
    assert spark.read.parquet(str(tmp_path / "paths")).count() == 3
    writers.write_paths(found.where("order_id_src = '3'"), str(tmp_path / "paths"))
    assert spark.read.parquet(str(tmp_path / "paths")).where("day = 2").count() == 1
    long = spark.createDataFrame([("1", 2, "a_cnt"), ("1", 3, "b_cnt")],
                                 "order_id_src string, cnt long, title string")
    writers.write_features_by_title(long, str(tmp_path / "long"))
    many = spark.range(90).selectExpr("cast(id as string) order_id_src", "id cnt", "'t' title")
    writers.write_features_by_title(many, str(tmp_path / "many"), file_rows=30)
    assert len(list((tmp_path / "many" / "title=t").glob("*.parquet"))) <= 3
    assert spark.read.parquet(str(tmp_path / "many")).count() == 90
    writers.write_features_by_title(long.where("title = 'a_cnt'"), str(tmp_path / "long"))
    assert spark.read.parquet(str(tmp_path / "long")).count() == 2
    writers.create_table(long, "long_t")
    writers.overwrite_table(long.limit(1), "short_t")
    assert spark.table("long_t").count() == 2 and spark.table("short_t").count() == 1
    writers.save_sample(long, str(tmp_path / "sample"), files=1)
    assert spark.read.parquet(str(tmp_path / "sample")).count() == 2


def test_labels(spark):
    perf = spark.createDataFrame(
        [("1", "2016-05-01", 30), ("2", "2016-05-01", 0), ("3", "2016-05-01", 5),
         ("4", "2016-05-01", None), ("5", "2015-05-01", 0), ("6", "2016-05-01", 0)],
        "order_id string, apply_time string, history_due_day int").withColumn(
            "apply_time", F.col("apply_time").cast("timestamp"))
    orders = spark.createDataFrame([(str(i), 2016) for i in range(1, 7)],
                                   "order_id string, year int")
    fraud = spark.createDataFrame([("6",)], "order_id string")
    one = {r.order_id: r.label for r in labels.label_orders(perf, orders, fraud).collect()}
    assert one == {"1": 1, "2": 0, "3": 2, "4": 2, "5": 0, "6": 1}
    two = {r.order_id: r.label for r in labels.label_orders(
        perf, orders, fraud, overdue_is_bad=False, year="performance").collect()}
    assert two == {"1": 2, "2": 0, "3": 2, "4": 2, "6": 1}


def test_exact_random_sample(spark):
    df = spark.range(5000).select(F.col("id").cast("string").alias("order_id"))
    for n in (1, 700, 4999, 5000, 9000):
        top = df.orderBy(sampling.hash_key("order_id", 3), "order_id").limit(n)
        got = sampling.random_rows(df, n, "order_id", 3)
        assert got.count() == min(n, 5000) and got.exceptAll(top).isEmpty()
    assert sampling.random_rows(df.limit(0), 3, "order_id", 3).count() == 0
    share = sampling.random_split(df).where("part = 'train'").count() / 5000
    assert 0.66 < share < 0.74


def test_curves_match_the_library(spark):
    scored = spark.range(3000).select(
        (F.pmod(F.xxhash64("id"), F.lit(997)) / 997).alias("score"),
        (F.pmod(F.xxhash64("id"), F.lit(997)) + F.pmod(F.xxhash64(F.col("id") + 1), F.lit(500))
         > 700).cast("int").alias("label"))
    cum = evaluate.cumulative(evaluate.score_counts(scored))
    area = evaluate.areas(cum).first()
    data = scored.withColumn("label", F.col("label").cast("double"))
    for name, metric in (("area_under_roc", "areaUnderROC"), ("area_under_pr", "areaUnderPR")):
        lib = BinaryClassificationEvaluator(rawPredictionCol="score", metricName=metric,
                                            numBins=0).evaluate(data)
        assert abs(area[name] - lib) < 1e-9
    assert evaluate.roc_curve(cum).count() == evaluate.threshold_metrics(cum).count() + 2
    binned = evaluate.score_counts(scored, n_bins=10)
    assert binned.count() == 10


def test_profile_and_model(spark, tmp_path):
    df = spark.range(600).select(
        (F.col("id") % 2).cast("int").alias("label"), F.col("id").cast("string").alias("order_id"),
        F.lit("t").alias("apply_time"), (F.col("id") % 2 * 3).alias("good"),
        F.when(F.col("id") > 5, F.col("id") % 7).alias("noise"), F.lit("text").alias("text"))
    stat = {r.column_name: r for r in profile.column_profile(df, ["noise", "good"]).collect()}
    assert stat["noise"]["count"] == 594 and abs(stat["noise"]["missing_rate"] - 0.01) < 1e-9
    long = df.selectExpr("'noise' title", "noise cnt").where("cnt is not null").unionAll(
        df.selectExpr("'good'", "good"))
    opened = profile.long_profile(long, ["noise", "good", "never"], df)
    assert {r.column_name: r for r in opened.collect()} | {"never": None} == stat | {"never": None}
    fitted = model.train(df, maxIter=2, maxDepth=2)
    out = model.score(fitted, df)
    assert evaluate.mean_squared_error(out).first()[0] < 0.01
    assert list(model.describe_model(
        fitted, model.feature_columns(df))["importances"]) == ["good"]
    writers.save_model(fitted, str(tmp_path / "m"))
    again = model.score(writers.load_model(str(tmp_path / "m")), df)
    assert again.exceptAll(out).isEmpty()


def test_rows_are_not_shuffled_to_meet_the_sizes_of_their_folders(spark):
    dealt_rows = spark.range(100).selectExpr("id", "id % 3 as day")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        dealt = writers._by_folder(dealt_rows, ["day"], "id", 10)
        plan = dealt._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        assert rows(dealt.select("id", "day")) == rows(dealt_rows)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
