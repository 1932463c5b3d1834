"""Sinks. Every partitioned write replaces whole partitions, so a re-run gives the same rows."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

from riskgraph.functions.joins import salted_lookup
from riskgraph.sources.staging import (broadcast_below, freed_shuffles, new_path, stage,
                                       staged_table)


# Rows of one partition folder that go into one file.
FILE_ROWS = 2_000_000
# Folders whose sizes are broadcast.
MOST_FOLDERS = 100_000


def _by_folder(rows: DataFrame, keys: list[str], spread: str, file_rows: int) -> DataFrame:
    """Rows dealt out by folder and, within large folders, by a hash of ``spread``, so that a file
    holds about ``file_rows`` rows. Sizes are counted map-side, one row per folder, and before they
    are joined: planned as one query, all rows are shuffled to meet them."""
    sizes = broadcast_below(stage(rows.groupBy(*keys).agg(
        F.ceil(F.count(F.lit(1)) / file_rows).alias("files")), "folder-sizes"), MOST_FOLDERS)
    dealt = salted_lookup(rows, sizes, keys, F.col(spread))
    part = F.pmod(F.xxhash64(spread), F.col("files")).alias("part")
    return dealt.repartition(*keys, part).drop("files")


def _write_by_folder(rows: DataFrame, keys: list[str], spread: str, folder: str,
                     file_rows: int) -> None:
    """Rows written by folder of their ``keys``; only the folders present are replaced."""
    with freed_shuffles(rows.sparkSession):
        (_by_folder(rows, keys, spread, file_rows)
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*keys).parquet(folder))


def write_paths(paths: DataFrame, folder: str, at: str = "apply_date_src",
                file_rows: int = FILE_ROWS) -> None:
    """Path table partitioned by year, month and day of the source order."""
    dated = paths.withColumns({"year": F.year(at), "month": F.month(at), "day": F.dayofmonth(at)})
    _write_by_folder(dated, ["year", "month", "day"], "order_id_src", folder, file_rows)


def write_features_by_title(long: DataFrame, folder: str, file_rows: int = FILE_ROWS) -> None:
    """Long features, one partition per title; only the titles present are replaced."""
    _write_by_folder(long.select("order_id_src", "cnt", "title"), ["title"], "order_id_src",
                     folder, file_rows)


def write_orders(orders: DataFrame, folder: str, file_rows: int = FILE_ROWS) -> None:
    """Order table partitioned by its columns year, month and day; only days present are replaced."""
    _write_by_folder(orders, ["year", "month", "day"], "order_id", folder, file_rows)


def bucketed_table(rows: DataFrame, key: str, buckets: int, name: str) -> DataFrame:
    """``rows`` stored in the shared folder, in one file per bucket of ``key``, sorted by it.

    A join on the key reads the buckets as they are, without a shuffle of this side. The table's name
    is only needed while its files are listed, so it does not stay in the catalogue.
    """
    spark = rows.sparkSession
    path = new_path(spark, name)
    table = "t_" + path.rsplit("-", 1)[-1]
    with freed_shuffles(spark):
        (rows.repartition(buckets, key).write.format("parquet").bucketBy(buckets, key).sortBy(key)
         .option("path", path).saveAsTable(table))
    staged_table(spark, path, rows.schema)
    stored = spark.read.table(table)
    spark.sql(f"drop table {table}")
    return stored


def create_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Create a table from a query, at ``path`` if given; fails if it exists."""
    writer = df.write.mode("errorifexists").format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(name)


def overwrite_table(df: DataFrame, name: str, path: str | None = None) -> None:
    writer = df.write.mode("overwrite").format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(name)


def save_sample(df: DataFrame, folder: str, files: int | None = None) -> None:
    """Training or validation sample. ``files=1`` gives one file and is for small samples."""
    (df.repartition(files) if files else df).write.mode("overwrite").parquet(folder)


def save_model(model: PipelineModel, folder: str) -> None:
    model.write().overwrite().save(folder)


def load_model(folder: str) -> PipelineModel:
    return PipelineModel.load(folder)
