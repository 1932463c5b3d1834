"""N-gram Jaccard join by chosen paths.

The shingle set of a text is embedded as its MinHash values, one per coordinate. A run splits the
sets recursively: a node samples a few coordinates, and each set goes to the child that stands for
its value there. Small buckets are compared pair by pair; buckets that are still large are split
again, and those left over at the last level are compared in blocks. Independent runs are added
until the chance to meet reaches the target recall. Sets that may be similar are united, and within
a united group all pairs are decided by their exact Jaccard similarity.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from riskgraph.functions.joins import salted_lookup
from riskgraph.llm.groups import components, exact_links, grouped_map, local_roots, pair_cells
from riskgraph.llm.memory import as_task
from riskgraph.sources.staging import broadcast_below, stage

WORDS = 5
JACCARD = 0.8
#: Chance that a pair just at the threshold meets in a bucket of some run.
RECALL = 0.99999
#: Coordinates of the embedding, coordinates a node samples, splits one after the other at most.
COORDINATES, SAMPLED, LEVELS = 128, 2, 3
#: Sets of a bucket above which it is split again.
BUCKET = 256
#: A pair is looked at exactly if its share of equal coordinates is at most so far below the
#: threshold, so 80 of 128 at 0.8: a pair at the threshold has fewer with a chance of 1.4e-6, which
#: together with what the runs miss stays within 1 - RECALL.
MARGIN = 0.175
#: Groups' members whose ids are broadcast to the texts; more are joined by shuffling.
BROADCAST_IDS = 2_000_000
CACHE_WORDS = 100_000
#: Sets of a block when pairs are decided; a cell holds two blocks of whole sets.
SET_ROWS = 256

MIX = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB], np.uint64)


def runs_for(threshold: float = JACCARD, recall: float = RECALL) -> int:
    """Runs until a pair at the threshold meets with the target recall.

    A pair stays together below a node if it does so for at least one sampled coordinate.
    """
    meet = 1.0
    for _ in range(LEVELS):
        meet = 1 - (1 - threshold * meet) ** SAMPLED
    return math.ceil(math.log(1 - recall) / math.log(1 - meet))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX[1]
    x = (x ^ (x >> np.uint64(27))) * MIX[2]
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hash of a word, remembered while there are few."""

    def __missing__(self, word: str) -> int:
        if len(self) > CACHE_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


HASHES = WordHashes()


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles of five lower-case words.

    A text of one to four words is one shingle, a text without words has none.
    """
    words = (text or "").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(HASHES.__getitem__, words), np.uint64, len(words))
    n = max(len(words) - WORDS + 1, 1)
    out = np.full(n, len(words) if len(words) < WORDS else 0, np.uint64)
    for k in range(min(WORDS, len(words))):
        out = _mixed(out * MIX[0] + hashes[k:k + n])
    return np.unique(out)


def _multipliers() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(2018)
    a, b = rng.integers(0, 1 << 63, (2, COORDINATES, 1), dtype=np.uint64)
    return a * np.uint64(2) + np.uint64(1), b


def min_hashes(shingles: np.ndarray) -> np.ndarray:
    a, b = _multipliers_once()
    best = None
    for at in range(0, len(shingles), 4096):
        values = ((a * shingles[at:at + 4096] + b) >> np.uint64(32)).min(axis=1)
        best = values if best is None else np.minimum(best, values)
    return best.astype("<u4")


def _multipliers_once() -> tuple[np.ndarray, np.ndarray]:
    if not hasattr(_multipliers_once, "value"):
        _multipliers_once.value = _multipliers()
    return _multipliers_once.value


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, k1, k2, sketch): a digest of the shingle set, and the set's MinHash values.

    Rows without words have nulls. The sets themselves stay where the texts are read.
    """
    @as_task
    def sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                own = shingle_set(text)
                if len(own):
                    data = own.tobytes()
                    rows.append((doc_id, xxhash.xxh3_64_intdigest(data) >> 1,
                                 xxhash.xxh3_64_intdigest(data, 1) >> 1,
                                 min_hashes(own).tobytes()))
                else:
                    rows.append((doc_id, None, None, None))
            yield pd.DataFrame({
                "doc_id": [r[0] for r in rows],
                "k1": pd.array([r[1] for r in rows], "Int64"),
                "k2": pd.array([r[2] for r in rows], "Int64"),
                "sketch": [r[3] for r in rows]})

    ids = docs.select(F.col("doc_id").cast("string"), "text")
    return ids.mapInPandas(sketch, "doc_id string, k1 long, k2 long, sketch binary").withColumn(
        "doc_id", F.col("doc_id").cast("long"))


def _children():
    """The nodes a set goes to below each given node."""
    @F.pandas_udf("array<bigint>")
    @as_task
    def children(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for sketch, node in batches:
            yield below(sketch, node)

    def below(sketch: pd.Series, node: pd.Series) -> pd.Series:
        values = np.frombuffer(b"".join(sketch), "<u4").reshape(len(sketch), COORDINATES)
        nodes = node.to_numpy(np.int64).view(np.uint64)
        out = np.empty((len(nodes), SAMPLED), np.uint64)
        for k in range(SAMPLED):
            coordinate = _mixed(nodes + MIX[0] * np.uint64(k + 1)) % np.uint64(COORDINATES // 2)
            coordinate = coordinate * np.uint64(SAMPLED) + np.uint64(k)  # never the same twice
            value = values[np.arange(len(nodes)), coordinate.astype(np.int64)].astype(np.uint64)
            out[:, k] = _mixed(_mixed(nodes + coordinate) ^ (value * MIX[1] + MIX[2]))
        return pd.Series(list(out.view(np.int64)), dtype=object)

    return children


def _buckets(sets: DataFrame, runs: int) -> DataFrame:
    """(id, node) of the last buckets with two sets or more; equal buckets are taken once."""
    children = _children()
    roots = F.array(*[F.lit(r).cast("long") for r in range(runs)])
    rows = sets.select("id", "sketch", F.explode(roots).alias("node"))
    found = []
    for level in range(LEVELS):
        below = stage(rows.select("id", F.explode(children("sketch", "node")).alias("node")),
                      "chosen-paths")
        nodes = stage(below.groupBy("node").agg(
            F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("id")).alias("x"),
            F.min("id").alias("first")).where("n > 1"), "nodes")
        ends = nodes if level == LEVELS - 1 else nodes.where(F.col("n") <= BUCKET)
        unique = ends.groupBy("n", "x", "first").agg(F.min("node").alias("node"))
        found.append(below.join(stage(unique.select("node"), "buckets"), "node"))
        large = nodes.where(F.col("n") > BUCKET).select("node")
        rows = below.join(large, "node").join(sets.select("id", "sketch"), "id")
    out = found[0]
    for more in found[1:]:
        out = out.unionAll(more)
    return out.select("id", "node")


def _close_sketches(threshold: float):
    least = math.ceil((threshold - MARGIN) * COORDINATES)

    def links(cell: pd.DataFrame) -> pd.DataFrame:
        ids = cell["id"].to_numpy()
        values = np.frombuffer(b"".join(cell["sketch"]), "<u4").reshape(len(ids), COORDINATES)
        if len(ids) <= 32:
            equal = (values[:, None, :] == values[None, :, :]).sum(axis=2)
        else:
            equal = np.zeros((len(ids), len(ids)), np.int16)
            for column in values.T:
                equal += column[:, None] == column[None, :]
        left, right = np.nonzero(np.triu(equal >= least, 1))
        root = ids[local_roots(len(ids), left, right)]
        return pd.DataFrame({"a": ids, "b": root})[ids != root]

    return links


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Matrix of the numbers of common elements."""
    elements, place, count = np.unique(np.concatenate(sets), return_inverse=True,
                                       return_counts=True)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    shared = count > 1
    column = (np.cumsum(shared) - 1)[place]
    keep = shared[place]
    row, column = row[keep], column[keep]
    common = np.zeros((len(sets), len(sets)), np.float32)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for at in range(0, int(shared.sum()), 4096):
        a, b = np.searchsorted(column, [at, at + 4096])
        part = np.zeros((len(sets), 4096), np.float32)
        part[row[a:b], column[a:b] - at] = 1
        common += part @ part.T
    return common


def _jaccard_links(threshold: float):
    def links(cell: pd.DataFrame) -> np.ndarray:
        sets = [np.frombuffer(s, np.uint64) for s in cell["shingles"]]
        sizes = np.array([len(s) for s in sets], np.float64)
        common = intersections(sets).astype(np.float64)
        return common >= threshold * (sizes[:, None] + sizes[None, :] - common) - 1e-9

    return links


def _shingles(text: str):
    @F.pandas_udf("binary")
    @as_task
    def shingles(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([shingle_set(t).tobytes() for t in texts], dtype=object)

    return shingles(text)


def similar_documents(docs: DataFrame, threshold: float = JACCARD,
                      recall: float = RECALL) -> DataFrame:
    """(doc_id, class_id, n_links, kept) for each document of ``docs`` (doc_id, text).

    Two documents are linked if the Jaccard similarity of their sets of five-word shingles is at
    least ``threshold``; ``n_links`` counts the documents linked directly, ``class_id`` is the
    smallest doc_id reachable by links, and ``kept`` marks that document. Equal sets are one class
    that takes part once. Texts without words, null ones included, link with nothing. Rows that
    repeat a doc_id with the same set are one document; a null doc_id is a document that links
    with nothing.
    """
    rows = stage(sketches(docs), "sketches")
    known = rows.where("k1 is not null and doc_id is not null")
    sets = stage(known.groupBy("k1", "k2").agg(
        F.count_distinct("doc_id").alias("copies"),
        F.min(F.struct("doc_id", "sketch")).alias("first")).select(
        "k1", "k2", "copies", F.col("first.doc_id").alias("id"),
        F.col("first.sketch").alias("sketch")), "sets")
    buckets = _buckets(sets, runs_for(threshold, recall)).withColumnRenamed("node", "component")
    cells = pair_cells(buckets.join(sets.select("id", "sketch"), "id"))
    close = stage(grouped_map(cells, ["component", "i", "j"], ["id"], _close_sketches(threshold),
                              "a long, b long"), "close-sketches")
    members = stage(components(close).join(sets.select("id", "copies"), "id"), "members")
    texts = docs.select(F.col("doc_id").alias("id"), "text").join(
        broadcast_below(members, BROADCAST_IDS), "id")
    texts = texts.select("id", "component", "copies", _shingles("text").alias("shingles"))
    exact = exact_links(texts.dropDuplicates(["id"]), _jaccard_links(threshold), ["shingles"],
                        SET_ROWS)
    info = (sets.select("k1", "k2", "id", "copies").join(exact, "id", "left")
            .where("copies > 1 or n_links is not null")
            .select("k1", "k2", (F.coalesce("n_links", F.lit(0)) + F.col("copies") - 1)
                    .alias("n_links"), F.coalesce("component", "id").alias("class_id")))
    out = salted_lookup(rows.select("doc_id", "k1", "k2").distinct(), info, ["k1", "k2"],
                        F.col("doc_id"), "left")
    class_id = F.when(F.col("doc_id").isNotNull(), F.coalesce("class_id", "doc_id"))
    return out.select("doc_id", class_id.alias("class_id"), F.when(
        F.col("doc_id").isNotNull(), F.coalesce("n_links", F.lit(0))).otherwise(0).cast("long")
        .alias("n_links"), F.col("doc_id").eqNullSafe(class_id).alias("kept"))


def one_of_each(docs: DataFrame, threshold: float = JACCARD, recall: float = RECALL) -> DataFrame:
    """``docs`` with one document of each class of similar documents, the one of smallest doc_id.

    Rows that repeat doc_id and text are kept once; rows with a null doc_id stay.
    """
    rows = similar_documents(docs, threshold, recall)
    later = stage(rows.where("not kept").select("doc_id").distinct(), "later-copies")
    twice = stage(docs.where("doc_id is not null").groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id"), "repeated-ids")
    first = docs.join(broadcast_below(later, BROADCAST_IDS), "doc_id", "left_anti")
    twice = broadcast_below(twice, BROADCAST_IDS)
    return first.join(twice, "doc_id", "left_anti").unionByName(
        first.join(twice, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"]))
