"""Day-by-day back-fill with a run record."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskgraph.sources import readers, writers
from riskgraph.sources.staging import exists, stage, unstage

RECORD = "day date, state string, rows long, error string"
DONE, FAILED = "done", "failed"
ERROR_CHARS = 500


def run_record(spark: SparkSession, folder: str) -> DataFrame:
    """(day, state, rows, error): one row for each day of each run so far."""
    path = f"{folder}/runs"
    if not exists(spark, path):
        return spark.createDataFrame([], RECORD)
    return spark.read.schema(RECORD).parquet(path)


def back_fill(orders: DataFrame, export: Callable[[DataFrame, date], DataFrame], folder: str,
              start: date, end: date) -> DataFrame:
    """Export the paths of each day from ``start`` to ``end``, both included; the run record.

    ``orders`` is the order table partitioned by day, ``export`` gives a day's paths. A day's
    partition below ``folder``/paths is replaced as a whole, and only then recorded as done. A day
    that fails is recorded with its error and the next one is taken; a further run takes up the
    days that are not done, and no others.
    """
    spark = orders.sparkSession
    done = {r.day for r in run_record(spark, folder).where(F.col("state") == DONE).select("day")
            .distinct().collect()}
    for k in range((end - start).days + 1):
        day = start + timedelta(days=k)
        if day in done:
            continue
        try:
            paths = stage(export(readers.scan_days(orders, day, day), day), "paths-of-day")
            rows = paths.count()
            writers.write_paths(paths, f"{folder}/paths")
            unstage(paths)
            row = day, DONE, rows, None
        except Exception as error:  # whatever it is, the other days do not depend on it
            row = day, FAILED, 0, str(error)[:ERROR_CHARS]
        spark.createDataFrame([row], RECORD).coalesce(1).write.mode("append").parquet(
            f"{folder}/runs")
    return run_record(spark, folder)
