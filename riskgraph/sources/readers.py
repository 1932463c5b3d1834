"""Readers for the CSV layouts and the partitioned order table."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskgraph.operators.graph import person_sample
from riskgraph.schemas import APPLICATION_FIELDS, PERSON_FIELDS

TIMESTAMPS = ("apply_date",)
INTEGERS = ("current_due_day", "history_due_day")
# White space of any script, no-break blanks included, is no part of a field.
BLANKS = r"(?U)^\s+|\s+$"


def _read_fields(spark: SparkSession, path: str, fields: tuple) -> tuple[DataFrame, DataFrame]:
    """Comma-split lines of every file under ``path`` into (rows, rejects).

    Fields are trimmed and unquoted text, so a line is split as it is. A line with too few
    fields is a reject with its file and position; further fields are ignored.
    """
    lines = (spark.read.option("recursiveFileLookup", True).text(path)
             .select(F.col("value").alias("line"),
                     F.col("_metadata.file_path").alias("source_file"),
                     F.struct(F.col("_metadata.file_block_start").alias("block"),
                              F.monotonically_increasing_id().alias("row")).alias("source_pos"))
             .withColumn("part", F.split("line", ",")))
    complete = F.size("part") >= len(fields)
    rows = lines.where(complete).select(
        *[F.regexp_replace(F.col("part")[i], BLANKS, "").alias(n) for i, n in enumerate(fields)],
        "source_file", "source_pos", "line")
    rejects = lines.where(~complete).select("source_file", "source_pos", "line")
    return rows, rejects


def read_applications(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Application CSV tree to (typed rows, rejects). Empty text stays '', bad numbers are null.

    An application without a readable date can be linked with nothing, so its line is a reject.
    """
    rows, rejects = _read_fields(spark, path, APPLICATION_FIELDS)
    typed = rows.withColumns(
        {**{c: F.expr(f"try_cast({c} as timestamp)") for c in TIMESTAMPS},
         **{c: F.expr(f"try_cast({c} as int)") for c in INTEGERS}})
    readable = F.lit(True)
    for c in TIMESTAMPS:
        readable = readable & F.col(c).isNotNull()
    undated = typed.where(~readable).select("source_file", "source_pos", "line")
    return typed.where(readable).drop("line"), rejects.unionByName(undated)


def read_person_sets(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Person-set CSV tree to (rows, rejects); the packed sets stay text."""
    rows, rejects = _read_fields(spark, path, PERSON_FIELDS)
    return rows.drop("line"), rejects


def _from(parts: list[tuple[str, int]], strict: bool = False) -> Column:
    """The date of the partition columns is at or after the given one, told by plain comparisons
    of the columns, by which a metastore and Spark's file listing leave out folders."""
    name, value = parts[0]
    column = F.col(name).cast("int")
    if len(parts) == 1:
        return column > value if strict else column >= value
    return (column > value) | ((column == value) & _from(parts[1:], strict))


def _parts(day: date, names: tuple[str, ...]) -> list[tuple[str, int]]:
    return [(n, getattr(day, n)) for n in names]


def scan_days(orders: DataFrame, start: date, end: date) -> DataFrame:
    """Orders of an inclusive day range of a table partitioned by year, month, day."""
    names = ("year", "month", "day")
    years = F.col("year").between(start.year, end.year)
    return orders.where(years & _from(_parts(start, names))
                        & ~_from(_parts(end, names), strict=True))


def scan_months(orders: DataFrame, start: date, end: date) -> DataFrame:
    """Orders of a month range: first month included, last month left out."""
    names = ("year", "month")
    years = F.col("year").between(start.year, end.year)
    return orders.where(years & _from(_parts(start, names)) & ~_from(_parts(end, names)))


def read_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Order table that ``write_orders`` wrote: order_id, and year, month and day by folder."""
    return spark.read.schema("order_id string, year int, month int, day int").parquet(folder)


def read_person_sample(spark: SparkSession, good_table: str, black_table: str) -> DataFrame:
    return person_sample(spark.read.table(good_table), spark.read.table(black_table))
