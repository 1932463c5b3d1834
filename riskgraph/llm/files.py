"""Raw binary files through Spark's own writers and readers.

Spark's text writer puts a string's bytes out as they are, so a binary value cast to a string
becomes one file: any file system Spark knows works, and the commit protocol covers lost
executors and repeated tasks. The writer ends a row with the line separator, which file formats
here take as their end mark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def write_files(rows: DataFrame, path: str, end: bytes, by: tuple[str, ...] = ()) -> None:
    """Write each value of ``content``, then ``end``, as a file of its own below ``path``."""
    writer = (rows.select(*by, F.col("content").cast("string")).write
              .option("encoding", "ISO-8859-1").option("lineSep", end.decode("latin-1"))
              .option("maxRecordsPerFile", 1))
    (writer.partitionBy(*by) if by else writer).text(path)


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, content) of all files below ``path``."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).where("length > 0")
            .drop("modificationTime", "length"))
