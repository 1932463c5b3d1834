"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskgraph.sources.staging import broadcast_below, stage

# Rows of one key that one join cell may hold. A key below it is joined as it is.
BLOCK_ROWS = 20_000
# Rows of one key that one task may look up; keys with more are spread over copies.
LOOKUP_ROWS = 1_000_000


def day_blocks(rows: DataFrame, key: str, at: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(key, day, day_start, day_rows, last_block) for keys with more than ``block_rows`` rows.

    A row's block is its place divided by ``block_rows``; rows are placed by day, and within a day
    by a hash, so a single day of a heavy key is cut as well. Rows are counted by key first, so that
    days are counted of heavy keys only; both counts are combined map-side, and the window sees one
    row per heavy key and calendar day.
    """
    heavy = stage(rows.groupBy(key).agg(F.count(F.lit(1)).alias("total"))
                  .where(F.col("total") > block_rows), "heavy-totals")
    daily = (rows.select(key, F.to_date(at).alias("day")).join(heavy, key)
             .groupBy(key, "day", "total").agg(F.count(F.lit(1)).alias("day_rows")))
    before = F.sum("day_rows").over(Window.partitionBy(key).orderBy("day")) - F.col("day_rows")
    last = F.floor((F.col("total") - 1) / block_rows).cast("int")
    return daily.select(key, "day", "day_rows", before.alias("day_start"),
                        last.alias("last_block"), F.lit(block_rows).alias("block_rows"))


def _placed(rows: DataFrame, key: str, at: str, spread: str, blocks: DataFrame) -> DataFrame:
    """Rows of heavy keys with their block and the first and last block of their day."""
    blocks = blocks.withColumnsRenamed({blocks.columns[0]: "__key", "day": "__day"})
    on = (F.col(key) == F.col("__key")) & (F.to_date(at) == F.col("__day"))
    place = F.col("day_start") + F.pmod(F.xxhash64(spread), F.col("day_rows"))
    ends = {"own": place, "first": F.col("day_start"),
            "upto": F.col("day_start") + F.col("day_rows") - 1}
    found = {n: F.floor(c / F.col("block_rows")).cast("int") for n, c in ends.items()}
    return (rows.join(blocks, on).withColumns({**found, "last": F.col("last_block")})
            .drop("__key", "__day", "day_start", "day_rows", "last_block", "block_rows"))


def heavy_split(rows: DataFrame, key: str, blocks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(light, heavy): rows without and with the keys of ``blocks``."""
    heavy = blocks.select(F.col(blocks.columns[0]).alias("__key")).distinct()
    on = F.col(key) == F.col("__key")
    return rows.join(heavy, on, "left_anti"), rows.join(heavy, on, "left_semi")


def block_join(left: DataFrame, right: DataFrame | tuple[DataFrame, DataFrame], key: str,
               left_at: str, right_at: str, left_id: str, right_id: str, blocks: DataFrame,
               earlier: bool = True, residual: Column | None = None) -> DataFrame:
    """Rows of ``right`` with the same ``key``, and with ``earlier`` of a strictly earlier time.

    Light keys are joined as they are. ``blocks`` (from ``day_blocks`` of the right side) cuts heavy
    ones: cell (i, j) pairs the left rows of block i with the right rows of block j, and with
    ``earlier`` only blocks up to the end of the left row's day can match. No task gets more than
    about one block of either side and nothing is capped. Both are parts of one plan; without heavy
    keys the second part is empty, which Spark sees while it runs. ``right`` may be given as
    (light, heavy) where it is stored apart. Every left day must occur among the right days of its
    key, which holds for edges joined with edges. Non-key column names must differ between the sides.
    """
    light, heavy = right if isinstance(right, tuple) else heavy_split(right, key, blocks)
    plain = heavy_split(left, key, blocks)[0].join(light, key)
    reach, start = ("upto", "first") if earlier else ("last", None)
    left = _placed(left, key, left_at, left_id, blocks).withColumns({
        "i": F.col("own"), "j": F.explode(F.sequence(F.lit(0), F.col(reach)))})
    heavy = _placed(heavy, key, right_at, right_id, blocks).withColumns({
        "j": F.col("own"),
        "i": F.explode(F.sequence(F.col(start) if start else F.lit(0), F.col("last")))})
    ends = ("own", "first", "upto", "last")
    cells = left.drop(*ends).join(heavy.drop(*ends), [key, "i", "j"])

    def kept(rows: DataFrame) -> DataFrame:
        if earlier:
            rows = rows.where(F.col(left_at) > F.col(right_at))
        return rows if residual is None else rows.where(residual)

    return kept(plain).unionByName(kept(cells.select(*plain.columns)))


def heavy_keys(facts: DataFrame, on: list[str], rows: int = LOOKUP_ROWS) -> DataFrame:
    """(on..., copies): keys that more than ``rows`` facts have, counted map-side first."""
    counted = facts.groupBy(*on).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > rows)
    return stage(counted.select(*on, F.ceil(F.col("n") / rows).cast("int").alias("copies")),
                 "heavy-keys")


def spread_facts(facts: DataFrame, heavy: DataFrame, spread: Column) -> DataFrame:
    """``facts`` with a ``__salt`` below the ``copies`` of their key in ``heavy``, 0 for other keys."""
    heavy = heavy.withColumnRenamed("copies", "__copies")
    by = [c for c in heavy.columns if c != "__copies"]
    return facts.join(heavy, by, "left").withColumn("__salt", F.pmod(
        F.xxhash64(spread), F.coalesce("__copies", F.lit(1))).cast("int")).drop("__copies")


def copied_rows(rows: DataFrame, heavy: DataFrame) -> DataFrame:
    """``rows`` once for each ``__salt`` that ``spread_facts`` gives their key."""
    heavy = heavy.withColumnRenamed("copies", "__copies")
    by = [c for c in heavy.columns if c != "__copies"]
    return rows.join(heavy, by, "left").withColumn("__salt", F.explode(F.sequence(
        F.lit(0), F.coalesce("__copies", F.lit(1)) - 1))).drop("__copies")


def measured_lookup(facts: DataFrame, unique: DataFrame, on: list[str], spread: Column,
                    heavy: DataFrame, how: str = "inner") -> DataFrame:
    """Join a fact table to a table that is unique on ``on``, with hot keys spread by their size.

    ``heavy`` (some columns of ``on``, ``copies``) says how many copies a hot key's row gets; its
    facts are spread over them by ``spread``. Other keys have one copy. There is at most one heavy
    key for each ``LOOKUP_ROWS`` facts; give it through ``broadcast_below``.
    """
    heavy = heavy.select(*[c for c in heavy.columns if c in on], "copies")
    return spread_facts(facts, heavy, spread).join(
        copied_rows(unique, heavy), on + ["__salt"], how).drop("__salt")


def counted_lookup(facts: DataFrame, unique: DataFrame, on: list[str], spread: Column,
                   how: str = "inner", rows: int = LOOKUP_ROWS) -> DataFrame:
    """``measured_lookup`` with hot keys counted among the facts, which are read once more."""
    heavy = broadcast_below(heavy_keys(facts, on, rows), 1_000_000)
    return measured_lookup(facts, unique, on, spread, heavy, how)


def salted_lookup(facts: DataFrame, small: DataFrame, on: list[str], spread: Column,
                  how: str = "inner", salts: int = 16) -> DataFrame:
    """Join a fact table with hot keys to a small table that is unique on ``on``.

    The unique side is copied once per salt and the fact side is spread over the salts by
    ``spread``, so a hot key is shared by ``salts`` tasks. Spark still turns the join into a
    broadcast by itself when the unique side is below its measured size threshold.
    """
    left = facts.withColumn("__salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    right = small.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, on + ["__salt"], how).drop("__salt")
