"""Threshold metrics, curves and areas of a binary score."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

RANGES = 256


def score_counts(scored: DataFrame, n_bins: int | None = None) -> DataFrame:
    """(score, pos, neg) per distinct score, or per score floor with ``n_bins`` bins in [0, 1]."""
    score = F.col("score")
    if n_bins:
        score = F.floor(score * n_bins) / n_bins
    return (scored.groupBy(score.alias("score"))
            .agg(F.sum((F.col("label") == 1).cast("long")).alias("pos"),
                 F.sum((F.col("label") != 1).cast("long")).alias("neg")))


def cumulative(counts: DataFrame) -> DataFrame:
    """Adds tp, fp (rows at or above the score), total_pos, total_neg.

    Running sums over all distinct scores without a one-task window: the scores are cut into
    at most 256 ranges of similar size, the range totals are accumulated, and each range adds
    its own running sum to what lies above it. The cut points are one value of the running query.
    """
    share = [i / RANGES for i in range(1, RANGES)]
    cuts = counts.agg(F.percentile_approx("score", share, 10_000)).scalar()
    # Number of cut points at or below the score.
    rng = F.size(F.filter(F.coalesce("__cuts", F.array().cast("array<double>")),
                          lambda x: x <= F.col("score")))
    ranged = counts.withColumn("__cuts", cuts).withColumn("__r", rng).drop("__cuts")
    totals = ranged.groupBy("__r").agg(F.sum("pos").alias("rp"), F.sum("neg").alias("rn"))
    above = Window.orderBy(F.col("__r").desc())
    totals = totals.select(
        "__r", (F.sum("rp").over(above) - F.col("rp")).alias("pos_above"),
        (F.sum("rn").over(above) - F.col("rn")).alias("neg_above"),
        F.sum("rp").over(Window.partitionBy()).alias("total_pos"),
        F.sum("rn").over(Window.partitionBy()).alias("total_neg"))
    w = Window.partitionBy("__r").orderBy(F.col("score").desc())
    # At most 256 range totals: fixed size, safe to broadcast.
    return (ranged.join(F.broadcast(totals), "__r")
            .withColumn("tp", F.col("pos_above") + F.sum("pos").over(w))
            .withColumn("fp", F.col("neg_above") + F.sum("neg").over(w))
            .drop("__r", "pos_above", "neg_above"))


def _ratio(a, b):
    return F.when(b == 0, F.lit(0.0)).otherwise(a / b)


def threshold_metrics(cum: DataFrame) -> DataFrame:
    """Precision, recall and F-measure (beta 1 and 0.5) at every threshold."""
    tp = F.col("tp")
    precision = tp / (tp + F.col("fp"))
    recall = _ratio(tp, F.col("total_pos"))
    rows = cum.select("score", precision.alias("precision"), recall.alias("recall"))
    p, r = F.col("precision"), F.col("recall")

    def f_measure(beta: float):
        b2 = beta * beta
        return _ratio((1 + b2) * p * r, b2 * p + r)

    return rows.select(F.col("score").alias("threshold"), "precision", "recall",
                       f_measure(1.0).alias("f1"), f_measure(0.5).alias("f_half"))


def pr_curve(cum: DataFrame) -> DataFrame:
    """(recall, precision); starts at recall 0 with the precision of the highest threshold."""
    precision = F.col("tp") / (F.col("tp") + F.col("fp"))
    points = cum.select(_ratio(F.col("tp"), F.col("total_pos")).alias("recall"),
                        precision.alias("precision"))
    first = cum.agg(F.max_by(precision, "score").alias("precision")).select(
        F.lit(0.0).alias("recall"), "precision")
    return first.unionByName(points)


def roc_curve(cum: DataFrame) -> DataFrame:
    """(fpr, tpr) from (0, 0) to (1, 1)."""
    points = cum.select(_ratio(F.col("fp"), F.col("total_neg")).alias("fpr"),
                        _ratio(F.col("tp"), F.col("total_pos")).alias("tpr"))
    ends = cum.agg(F.count(F.lit(1)).alias("n")).select(
        F.explode(F.array(F.lit(0.0), F.lit(1.0))).alias("fpr")).select(
        "fpr", F.col("fpr").alias("tpr"))
    return ends.unionByName(points)


def areas(cum: DataFrame) -> DataFrame:
    """One row: area_under_pr, area_under_roc (trapezoid).

    The point before a threshold follows from the counts at the threshold itself, so no lag is
    needed; the first PR segment is flat at the precision of the highest threshold.
    """
    tp0 = F.col("tp") - F.col("pos")
    fp0 = F.col("fp") - F.col("neg")
    tpr, fpr = _ratio(F.col("tp"), F.col("total_pos")), _ratio(F.col("fp"), F.col("total_neg"))
    tpr0, fpr0 = _ratio(tp0, F.col("total_pos")), _ratio(fp0, F.col("total_neg"))
    precision = F.col("tp") / (F.col("tp") + F.col("fp"))
    seen = tp0 + fp0
    before = F.when(seen == 0, precision).otherwise(tp0 / seen)
    return cum.agg(
        F.sum((tpr - tpr0) * (precision + before) / 2).alias("area_under_pr"),
        F.sum((fpr - fpr0) * (tpr + tpr0) / 2).alias("area_under_roc"))


def mean_squared_error(scored: DataFrame) -> DataFrame:
    gap = F.col("score") - F.col("label")
    return scored.agg(F.avg(gap * gap).alias("mse"))
