"""Intermediate tables in the cluster's shared folder.

A staged table cuts the lineage and survives lost executors. Its folder is the one the session
names in ``spark.checkpoint.dir``; where that is unset, a folder inside the warehouse is used,
which Spark's contract already makes a shared place. Folders are deleted by ``unstage``, at the end
of a ``tidied`` query where its result does not read them, and at the latest when the application
ends.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, functions as F

SETTING = "spark.checkpoint.dir"
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Folders that the running query made, if it is a tidied one; all folders made so far by name.
_query: ContextVar[list[str] | None] = ContextVar("query", default=None)
_made: dict[str, str] = {}


def staging_folder(spark: SparkSession) -> str:
    """The shared folder for staged tables.

    Without a setting the warehouse serves, unless it lies on local disks of a real cluster.
    """
    folder = spark.conf.get(SETTING, None)
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_staging"
        local = folder.startswith(("file:", "/"))
        if local and not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {SETTING}: {folder} is a folder of one machine")
        spark.conf.set(SETTING, folder)
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder; it is deleted like a staged table."""
    own = f"{name}-{uuid4().hex}"
    path = f"{staging_folder(spark)}/{own}"
    _made[own] = path
    if (made := _query.get()) is not None:
        made.append(path)
    return path


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    target, files = _file_system(spark, path)
    return files.exists(target)


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is run inside are deleted as it ends, not with the driver's garbage."""
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new staged table and return the table."""
    spark = df.sparkSession
    path = new_path(spark, name)
    with freed_shuffles(spark):
        df.write.parquet(path)
    return staged_table(spark, path, df.schema)


def by_batches(rows: DataFrame, key: str, size: int, name: str,
               make: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``make`` of all ``rows``, taken in batches of about ``size`` rows by a hash of ``key``.

    For a ``make`` whose result for a key asks for no rows of other keys. The results of batches are
    staged one after the other, so that only one batch's shuffles lie on disk at a time. Up to ``size``
    rows there is one batch, and nothing is staged.
    """
    batches = -(-rows.count() // size)
    if batches <= 1:
        return make(rows)
    batch = F.pmod(F.xxhash64(key), F.lit(batches))
    return functools.reduce(DataFrame.unionByName, [
        stage(make(rows.where(batch == i)), f"{name}-{i}") for i in range(batches)])


def staged_table(spark: SparkSession, path: str, schema) -> DataFrame:
    """The table written at ``path``, read with ``schema``."""
    target, files = _file_system(spark, path)
    files.deleteOnExit(target)
    table = spark.read.schema(schema).parquet(path)
    table.staged_path = path
    return table


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a path that this module made, through the file system that holds it."""
    root = staging_folder(spark)
    if root.split(":", 1)[-1].strip("/") not in path:
        raise ValueError(f"{path} is not below {root}")
    _made.pop(path.rsplit("/", 1)[-1], None)
    target, files = _file_system(spark, path)
    files.delete(target, True)


def _read_by(result: DataFrame) -> set[str]:
    """Paths made here that ``result`` reads."""
    names = {part for file in result.inputFiles() for part in file.split("/")}
    return {_made[name] for name in names & _made.keys()}


def unstage(*tables: DataFrame) -> None:
    """Delete staged tables that nothing reads any more, and those that other frames read."""
    for table in tables:
        own = table.__dict__.get("staged_path")
        for path in [own] if own else _read_by(table):
            drop_path(table.sparkSession, path)


def tidied(query: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """``query`` without the staged tables that its result does not read.

    Those that it does read belong to the caller, who gives the result to ``unstage`` when done.
    """
    @functools.wraps(query)
    def run(spark: SparkSession, *args, **kwargs) -> DataFrame:
        made: list[str] = []
        token = _query.set(made)
        try:
            result = query(spark, *args, **kwargs)
        finally:
            _query.reset(token)
        needed = _read_by(result) if made else set()
        for path in made:
            if path not in needed and path.rsplit("/", 1)[-1] in _made:
                drop_path(spark, path)
        return result

    return run


def broadcast_below(df: DataFrame, rows: int, payload: str | None = None,
                    payload_bytes: int = 32 << 20) -> DataFrame:
    """Hint a broadcast if the staged table ``df`` is small: at most ``rows`` rows, and at most
    ``payload_bytes`` bytes in the one column of varying width, ``payload`` (text, binary or an
    array of numbers). Above the bound the table is joined by shuffling, with the same result.
    """
    width = F.lit(0)
    if payload:
        flat = dict(df.dtypes)[payload] in ("binary", "string")
        width = F.octet_length(payload) if flat else F.size(payload) * 8
    n, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    return F.broadcast(df) if n <= rows and size <= payload_bytes else df
