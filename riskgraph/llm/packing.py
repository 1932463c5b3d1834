"""Packing of documents into training sequences: shortest pack first over the length histogram."""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from riskgraph.llm.token_ids import CACHE_PIECES, token_ids
from riskgraph.sources.staging import stage

SEQUENCE_TOKENS = 2048
# Rows of one length that one ranking task takes on average.
RANK_ROWS = 5_000


def pieces(docs: DataFrame, vocabulary: str, end_id: int = 1, size: int = SEQUENCE_TOKENS,
           cache: int = CACHE_PIECES) -> DataFrame:
    """(doc_id, start, length, ids, doc_tokens): each document's ids cut every ``size`` ids.

    A null or empty text has the end id alone. ``ids`` are little-endian unsigned 32-bit
    integers; ``cache`` pieces of text are remembered by a worker. Repeated doc_ids are packed as
    often as they come; other columns are left behind.
    """
    ids = docs.select("doc_id", token_ids("text", vocabulary, end_id, cache).alias("ids"))
    total = F.length("ids").cast("long") / 4
    cuts = ids.select("doc_id", "ids", F.floor(total).alias("doc_tokens"), F.explode(
        F.sequence(F.lit(0).cast("long"), F.floor(total) - 1, F.lit(size).cast("long"))
    ).alias("start"))
    return cuts.select(
        "doc_id", "start",
        F.least(F.col("doc_tokens") - F.col("start"), F.lit(size)).cast("long").alias("length"),
        F.expr(f"substring(ids, cast(start * 4 + 1 as int), {size * 4})").alias("ids"),
        "doc_tokens")


def packing_patterns(counts: dict[int, int], size: int = SEQUENCE_TOKENS,
                     ) -> list[tuple[int, list[int]]]:
    """(repeats, lengths) of the packing patterns for a histogram of piece lengths.

    Lengths are placed longest first, each in the shortest pack so far; only counts of equal
    packs are kept, so the work depends on ``size`` and not on the number of pieces.
    """
    packs: list[tuple[int, int, int, list[int]]] = []  # fill, serial, repeats, lengths
    serial = 0

    def push(repeats: int, lengths: list[int]) -> None:
        nonlocal serial
        serial += 1
        heapq.heappush(packs, (sum(lengths), serial, repeats, lengths))

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            if packs and packs[0][0] + length <= size:
                _, _, repeats, lengths = heapq.heappop(packs)
                used = min(left, repeats)
                push(used, lengths + [length])
                if repeats > used:
                    push(repeats - used, lengths)
                left -= used
            else:  # the shortest pack is too long, and so are all others
                push(left, [length])
                left = 0
    return [(repeats, lengths) for _, _, repeats, lengths in sorted(packs)]


def _slots(patterns: list[tuple[int, list[int]]], counts: dict[int, int],
           ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges of ranks: sorted first keys (length, rank), first sequence and offset of each."""
    used = dict.fromkeys(counts, 0)
    rows, first = [], 0
    for repeats, lengths in patterns:
        offset = 0
        for length in lengths:
            rows.append(((length << 48) + used[length], first, offset))
            used[length] += repeats
            offset += length
        first += repeats
    if used != counts:
        raise AssertionError("the patterns do not hold the histogram")
    return tuple(np.array(x, dtype=np.int64) for x in zip(*sorted(rows)))


def rank_in_length(rows: DataFrame, total: int) -> DataFrame:
    """``rows`` with a gapless ``rank`` from 0 among the rows of the same length.

    Ranks go through buckets: counts per (length, bucket) give each bucket's first rank, so that
    a length which a third of all rows share is numbered by many tasks.
    """
    buckets = total // RANK_ROWS + 1
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start"), F.lit(buckets)))
    counts = rows.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("bucket")) - F.col("n")
    firsts = counts.select("length", "bucket", before.alias("first"))
    within = F.row_number().over(
        Window.partitionBy("length", "bucket").orderBy("doc_id", "start")) - 1
    return (rows.withColumn("within", within).join(firsts, ["length", "bucket"])
            .withColumn("rank", F.col("first") + F.col("within"))
            .drop("bucket", "within", "first"))


def pack(rows: DataFrame, size: int = SEQUENCE_TOKENS) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces (doc_id, start, length, ...).

    ``rows`` is staged once. The histogram has at most ``size`` rows and is the only thing that
    reaches the driver; the patterns are as small. An empty table gives an empty table.
    """
    rows = stage(rows, "pieces")
    counts = {r.length: r.n for r in rows.groupBy("length").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        none = F.lit(None).cast("long")
        return rows.withColumns({"sequence_id": none, "offset": none})
    keys, firsts, offsets = _slots(packing_patterns(counts, size), counts)

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        key = (length.to_numpy(np.int64) << 48) + rank.to_numpy(np.int64)
        at = np.searchsorted(keys, key, side="right") - 1
        return pd.DataFrame({"sequence_id": firsts[at] + key - keys[at], "offset": offsets[at]})

    ranked = rank_in_length(rows, sum(counts.values()))
    return (ranked.withColumn("place", place("length", "rank"))
            .select(*rows.columns, "place.sequence_id", "place.offset"))


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids, doc_ids, starts, lengths): the packed sequences themselves.

    ``packed`` must carry ``ids``. A sequence has at most ``size`` ids, so the groups are bounded.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "start", "length", "ids")))
    return (packed.groupBy("sequence_id").agg(parts.alias("p"))
            .select("sequence_id",
                    F.expr("aggregate(p.ids, cast('' as binary), (a, x) -> concat(a, x))")
                    .alias("ids"),
                    F.col("p.doc_id").alias("doc_ids"), F.col("p.start").alias("starts"),
                    F.col("p.length").alias("lengths")))
