"""Embedding near-duplicates by sorted projection passes.

Each pass orders the vectors of a label lexicographically by the signs of their products with
random directions, and compares every vector with its next neighbours in that order. Passes carry
no vectors but sketches of further signs; a task reads its range of the order as a stream, and the
rows at the ends of ranges meet in blocks. Only rows whose sketch is like a neighbour's are compared
by their vectors. How far the bits of each vector's key go until a window holds all that share them is measured, as vectors that
are not centred share many; vectors whose passes do not reach the recall take part in more passes,
or are compared pair by pair in blocks where that is less work. Links are united; within a united
group all pairs are then compared in blocks, which is the exact way for groups that are larger than
a window.
"""

from __future__ import annotations

import functools
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from riskgraph.functions.joins import salted_lookup
from riskgraph.llm.groups import (
    components, exact_links, grouped_map, local_roots, pair_cells,
)
from riskgraph.llm.memory import as_task
from riskgraph.sources.staging import broadcast_below, stage

COSINE = 0.93
#: Later neighbours that a vector is compared with in each pass.
NEIGHBOURS = 256
#: Chance that a pair just at the threshold meets in some pass.
RECALL = 0.999
KEY_BITS = 64
#: Words of 64 signs of a sketch, and the chance that the sketches keep a pair at the threshold apart.
SKETCH, SKETCH_LOSS = 4, 1e-6
#: Rows up to which those with a neighbour alike are broadcast to the vectors.
BROADCAST_ROWS = 2_000_000
# Vectors that are projected together: so many rows of a double for each bit of all passes.
KEYED_ROWS = 256
BLOCK = 2048
#: Passes of a round at most; the first round takes those that evenly spread vectors need.
MOST_PASSES = 64
#: Vectors of a label short of the recall that are compared pair by pair: so many in any case, and
#: as many as that times the comparisons that the passes they lack would make for each of them.
EXACT_ROWS, EXACT_FACTOR = 4096, 4
SEED = 20_240


def passes_for(rows: int, cosine: float = COSINE, window: int = NEIGHBOURS,
               recall: float = RECALL) -> int:
    """Passes that a label of ``rows`` vectors needs if the bits part them evenly.

    Two vectors are at most a window apart if their keys agree in the first bits, as many as
    divide the rows into windows; a bit agrees with chance 1 - angle / pi.
    """
    bits = max(0.0, math.log2(max(rows, 1) / window))
    meet = (1 - math.acos(cosine) / math.pi) ** bits
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - meet))) if meet < 1 else 1


def most_differing(cosine: float, bits: int = 64 * SKETCH, lost: float = SKETCH_LOSS) -> int:
    """Signs of a sketch in which a pair at the threshold differs at most, but for that chance."""
    p = math.acos(cosine) / math.pi
    tail, most = 0.0, bits
    while most and (tail := tail + math.comb(bits, most) * p ** most * (1 - p) ** (bits - most)
                    ) <= lost:
        most -= 1
    return most


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, np.float64) for v in vectors])


def _unit(vectors: pd.Series) -> np.ndarray:
    """Rows of length 1 in double precision, scaled first so that squares stay in range."""
    rows = _matrix(vectors)
    rows /= np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _sort_keys(passes: int, turn_of: int):
    """A vector's keys of all passes, then the words of its sketch."""
    @F.pandas_udf("array<bigint>")
    def keys(vectors: pd.Series) -> pd.Series:
        out: list[list[int] | None] = [None] * len(vectors)
        sizes = vectors.map(len).to_numpy()
        for size in np.unique(sizes):
            rows = np.flatnonzero(sizes == size)
            turn = np.random.default_rng([SEED, size, turn_of]).standard_normal(
                (size, (passes + SKETCH) * KEY_BITS))
            for at in range(0, len(rows), KEYED_ROWS):
                some = rows[at:at + KEYED_ROWS]
                signs = (_unit(vectors.iloc[some]) @ turn > 0).reshape(
                    -1, passes + SKETCH, KEY_BITS)
                packed = np.packbits(signs, axis=2).view(">u8")[..., 0]
                ordered = (packed.astype(np.uint64) ^ np.uint64(1 << 63)).view(np.int64)
                for r, row in zip(some.tolist(), ordered.tolist()):
                    out[r] = row
        return pd.Series(out, dtype=object)

    return keys


def _shared_bits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """First bits that two columns of keys have in common."""
    other = (a ^ b).view(np.uint64)
    high, low = (np.frexp(x.astype(np.float64))[1]
                 for x in (other >> np.uint64(32), other & np.uint64(0xFFFFFFFF)))
    return KEY_BITS - np.where(high > 0, 32 + high, low)


def _missed(key: np.ndarray, kind: np.ndarray, cosine: float, window: int,
            rank: np.ndarray | None = None) -> np.ndarray:
    """Logarithm of the chance, for each row of a sorted pass, that the row and a vector at the
    threshold do not meet: they do if they share the bits that no vector ``window`` places away has.
    ``rank`` gives the places of rows with gaps between them; no row is ``window`` places away
    from one that has a gap there.
    """
    bits = np.zeros(len(key), np.int64)
    rank = np.arange(len(key)) if rank is None else rank
    later = np.minimum(np.searchsorted(rank, rank + window), max(len(rank) - 1, 0))
    left = np.flatnonzero(rank[later] == rank + window)
    right = later[left]
    same = (kind[left] == kind[right]).all(axis=1)
    more = np.where(same, _shared_bits(key[left], key[right]) + 1, 0)
    bits[left] = more
    bits[right] = np.maximum(bits[right], more)
    meet = np.where(bits > KEY_BITS, 0.0, (1 - math.acos(cosine) / math.pi) ** bits)
    return np.log(np.maximum(1 - meet, 1e-30))


def _mark_alike(near: np.ndarray, sketch: np.ndarray, kind: np.ndarray, rank: np.ndarray,
                most: int, window: int, old: int = 0) -> None:
    """Set ``near`` of rows whose sketch differs from that of a row of the same kind at most
    ``window`` places away in ``most`` signs or fewer; pairs of the ``old`` first rows are known."""
    run = np.cumsum(np.append(False, (kind[1:] != kind[:-1]).any(axis=1)))
    words = np.ascontiguousarray(sketch.T).view(np.uint64)
    n = len(near)
    for step in range(1, min(window, n - 1) + 1):
        i, j = slice(max(old - step, 0), n - step), slice(max(old, step), n)
        differ = np.zeros(n - j.start, np.uint16)
        for word in words:
            differ += np.bitwise_count(word[i] ^ word[j])
        at = np.flatnonzero(differ <= most)
        at = at[(run[i][at] == run[j][at]) & (rank[j][at] - rank[i][at] <= window)]
        near[i.start + at] = True
        near[j.start + at] = True


KIND = ["pass", "label", "size"]
WORDS = [f"s{k}" for k in range(SKETCH)]


def _scan(cosine: float, window: int, most: int):
    """A task that reads its range of a sorted order and gives each row's place, whether a sketch
    within the window is alike, and what ``_missed`` gives. That is null for rows whose window is
    cut by an end of the range; ``edge`` marks these rows and those in their windows."""
    columns = ["id", "key", *KIND, *WORDS]

    @as_task
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held, near = np.empty((0, len(columns)), np.int64), np.empty(0, bool)
        first = known = 0  # place of the first row held, rows held that were given out
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                if not batch.num_rows:
                    continue
                old = len(held)
                held = np.concatenate([held, np.column_stack(
                    [batch[c].to_numpy().astype(np.int64) for c in columns])])
                near = np.append(near, np.zeros(len(held) - old, bool))
                _mark_alike(near, held[:, 5:], held[:, 2:5],
                            np.arange(len(held)), most, window, old)
            n = len(held)
            ready = n if batch is None else max(n - 2 * window, known)
            if ready > known:
                place = first + np.arange(known, ready)
                edge, cut = place < 2 * window, place < window
                if batch is None:
                    edge |= place >= first + n - 2 * window
                    cut |= place >= first + n - window
                missed = _missed(held[:, 1], held[:, 2:5], cosine, window)[known:ready]
                rows, alike = held[known:ready], near[known:ready]
                placed = ~(edge | alike)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows[:, 0]), pa.array(np.full(len(rows), part, np.int32)),
                     pa.array(place, mask=placed), pa.array(alike), pa.array(edge),
                     pa.array(missed, mask=cut),
                     *(pa.array(rows[:, k], mask=placed) for k in (2, 3, 4)),
                     *(pa.array(rows[:, k], mask=~edge) for k in (1, *range(5, 5 + SKETCH)))],
                    ["id", "part", "place", "near", "edge", "missed", *KIND, "key", *WORDS])
            keep = max(ready - window, 0)
            held, near, first, known = held[keep:], near[keep:], first + keep, ready - keep

    return scan


def _in_blocks(ranked: DataFrame, window: int, rows: int) -> DataFrame:
    """``ranked`` copied to the blocks of ranks that hold a row within the window."""
    block, place = F.floor(F.col("rank") / rows), F.col("rank") % rows
    return ranked.withColumn("block", F.explode(F.array_compact(F.array(
        block, F.when(place < window, block - 1), F.when(place >= rows - window, block + 1)))))


def _edge_rows(edges: DataFrame, cosine: float, window: int, most: int, rows: int) -> DataFrame:
    """(id, pass, label, size, rank, near, missed) of the rows whose window a range's end cuts."""
    def compare(group: pd.DataFrame) -> pd.DataFrame:
        rank, kind = group["rank"].to_numpy(), group[KIND].to_numpy(np.int64)
        near = np.zeros(len(group), bool)
        _mark_alike(near, group[WORDS].to_numpy(np.int64), kind, rank, most, window)
        missed = _missed(group["key"].to_numpy(), kind, cosine, window, rank)
        out = group[["id", *KIND, "rank"]].assign(near=near, missed=missed)
        return out[group["cut"].to_numpy() & (rank // rows == group["block"].to_numpy())]

    cut = edges.withColumn("cut", F.col("missed").isNull()).drop("missed", "near")
    return grouped_map(_in_blocks(cut, window, rows), ["block"], ["rank"], compare,
                       "id long, pass long, label long, size long, rank long, near boolean, "
                       "missed double")


def _near_links(near: DataFrame, vectors: DataFrame, cosine: float, window: int,
                rows: int) -> DataFrame:
    """(a, b): links between the vectors of rows (id, pass, label, size, rank) at most ``window``
    ranks apart, joined up within a block."""
    def compare(group: pd.DataFrame) -> pd.DataFrame:
        ids, rank = group["id"].to_numpy(), group["rank"].to_numpy()
        kind = group[KIND].to_numpy(np.int64)
        left, right = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for size in np.unique(kind[:, 2]):
            at = np.flatnonzero(kind[:, 2] == size)
            unit = _unit(group["embedding"].iloc[at])
            for lo in range(0, len(at), window):
                ahead = slice(lo, lo + 2 * window)
                # A little below the threshold, as groups are decided exactly afterwards.
                a, b = np.nonzero(unit[lo:lo + window] @ unit[ahead].T >= cosine - 1e-9)
                a, b = at[lo + a[a < b]], at[lo + b[a < b]]
                close = (rank[b] - rank[a] <= window) & (kind[a] == kind[b]).all(axis=1)
                left.append(a[close])
                right.append(b[close])
        unique, place = np.unique(ids, return_inverse=True)
        root = unique[local_roots(len(unique), place[np.concatenate(left)],
                                  place[np.concatenate(right)])]
        return pd.DataFrame({"a": unique, "b": root})[unique != root]

    placed = vectors.select("id", "embedding").join(broadcast_below(near, BROADCAST_ROWS), "id")
    return grouped_map(_in_blocks(placed, window, rows), ["block"], ["rank"], compare,
                       "a long, b long")


def _pass_links(rows: DataFrame, passes: int, turn_of: int, cosine: float, window: int,
                block: int) -> tuple[DataFrame, DataFrame]:
    """(a, b) links found by ``passes`` passes over ``rows`` (id, label, size, embedding), and
    (id, now): the sum of what ``_missed`` gives for the passes of each row."""
    keys = stage(rows.select("id", "label", "size", _sort_keys(passes, turn_of)("embedding")
                             .alias("keys")), "sort-keys")
    words = [F.col("keys")[passes + k].alias(name) for k, name in enumerate(WORDS)]
    by = [*KIND, "key", "id"]
    order = keys.select("id", "label", "size", *words, F.posexplode(
        F.slice("keys", 1, passes)).alias("pass", "key"))
    most = most_differing(cosine)
    seen = stage(order.repartitionByRange(*by).sortWithinPartitions(*by).mapInArrow(
        _scan(cosine, window, most),
        "id long, part int, place long, near boolean, edge boolean, missed double, "
        + ", ".join(f"{c} long" for c in (*KIND, "key", *WORDS))), "scanned-passes")
    counts = seen.where("edge").groupBy("part").agg((F.max("place") + 1).alias("n"))
    firsts = counts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n"))
                           .alias("first"))
    placed = seen.where("edge or near").join(F.broadcast(firsts), "part").withColumn(
        "rank", F.col("first") + F.col("place"))
    edges = stage(_edge_rows(placed.where("edge"), cosine, window, most, block), "edge-rows")
    columns = ["id", *KIND, "rank"]
    near = stage(placed.where("near and missed is not null").select(*columns).unionAll(
        edges.where("near").select(*columns)), "rows-alike")
    links = stage(_near_links(near, rows, cosine, window, block), "window-links")
    sums = (seen.where("missed is not null").select("id", "missed")
            .unionAll(edges.select("id", "missed")).groupBy("id").agg(F.sum("missed").alias("now")))
    return links, sums


def _block_links(members: DataFrame, cosine: float, rows: int) -> DataFrame:
    """(a, b): links among all pairs of ``members`` (id, component, embedding) of a component,
    joined up within a cell of two blocks."""
    def compare(cell: pd.DataFrame) -> pd.DataFrame:
        ids, unit = cell["id"].to_numpy(), _unit(cell["embedding"])
        one, two = (np.flatnonzero(cell["block"] == cell[k].iloc[0]) for k in ("i", "j"))
        left, right = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for at in range(0, len(one), 512):
            a, b = np.nonzero(unit[one[at:at + 512]] @ unit[two].T >= cosine)
            left.append(one[at + a])
            right.append(two[b])
        order = np.argsort(ids, kind="stable")
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        ids = ids[order]
        root = ids[local_roots(len(ids), place[np.concatenate(left)], place[np.concatenate(right)])]
        return pd.DataFrame({"a": ids, "b": root})[ids != root]

    return grouped_map(pair_cells(members, rows), ["component", "i", "j"], ["id"], compare,
                       "a long, b long")


def _found_links(classes: DataFrame, cosine: float, window: int, recall: float) -> DataFrame:
    """(a, b): links that unite vectors (id, label, embedding) of at least the threshold, so that a
    pair just at the threshold is left out with a chance of ``1 - recall`` at most.

    It is enough that one of the two reaches the recall, so a round after the first takes only the
    vectors that do not yet; among them keys part sooner.
    """
    goal = math.log(1 - recall)
    most = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    passes = passes_for(most, cosine, window, recall)
    rows = classes.select("id", "label", F.size("embedding").alias("size"), "embedding",
                          F.lit(0.0).alias("missed"))
    links: list[DataFrame] = []
    for turn_of in itertools.count():
        found, sums = _pass_links(rows, passes, turn_of, cosine, window, BLOCK)
        links.append(found)
        before = rows.select("id", "missed") if turn_of else None
        known = sums.withColumn("missed", F.col("now")) if before is None else sums.join(
            before, "id").withColumn("missed", F.col("missed") + F.col("now"))
        lacking = stage(known.where(F.col("missed") > goal + 1e-9).withColumn(
            "lacking", (F.col("missed") - goal) / F.greatest(-F.col("now") / passes, F.lit(1e-9)))
            .drop("now"), "lacking")
        short = stage(rows.drop("missed").join(broadcast_below(lacking, BROADCAST_ROWS), "id"),
                      "short-of-recall")
        pairwise = F.col("n") <= F.greatest(
            F.lit(EXACT_ROWS), F.lit(EXACT_FACTOR * window) * F.col("lacks"))
        kinds = stage(short.groupBy("label", "size").agg(
            F.count(F.lit(1)).alias("n"), F.min("id").alias("component"),
            F.percentile_approx("lacking", 0.5).alias("lacks"))
            .withColumn("pairwise", pairwise), "kinds-short-of-recall")
        lacks, some = kinds.agg(F.max(F.when(~F.col("pairwise"), F.col("lacks"))),
                                F.max("pairwise")).first()
        placed = salted_lookup(short.drop("lacking"), kinds, ["label", "size"], F.col("id"))
        if some:
            links.append(stage(_block_links(placed.where("pairwise").select(
                "id", "component", "embedding"), cosine, BLOCK), "block-links"))
        if lacks is None:
            return functools.reduce(DataFrame.unionAll, links)
        passes = min(MOST_PASSES, max(1, math.ceil(lacks)))
        rows = stage(placed.where("not pairwise").select(*rows.columns), "next-round")


def _cosine_links(cosine: float):
    def links(cell: pd.DataFrame) -> np.ndarray:
        unit = _unit(cell["embedding"])
        return unit @ unit.T >= cosine

    return links


def near_duplicates(rows: DataFrame, cosine: float = COSINE, window: int = NEIGHBOURS,
                    recall: float = RECALL) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``rows`` (vec_id, label, embedding).

    Only vectors of the same label and length are compared. A null label, a null, empty or zero
    vector, and one with a null or non-finite component link with nothing; nor does a row with a null
    vec_id, which is in no other row's count, so that all links between named rows stay. Equal vectors of a
    label are one class that takes part once; its rows link with each other. ``n_links`` counts
    rows linked directly, ``component_id`` is the smallest vec_id reachable, the row's own included.
    Rows that repeat a vec_id count each.
    """
    sound = (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()
             & (F.size("embedding") > 0)
             & F.coalesce(F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x)
                                   & (F.abs(x) < float("inf"))), F.lit(False))
             & F.coalesce(F.exists("embedding", lambda x: x != 0), F.lit(False)))
    own = dict(rows.dtypes)["embedding"]
    rows = rows.select("vec_id", F.col("label").cast("long").alias("label"), F.col("embedding").cast(
        own if own == "array<float>" else "array<double>").alias("embedding"))
    # Adding zero turns -0.0 into 0.0, so that equal vectors have equal keys.
    plain = F.transform("embedding", lambda x: x.cast("double") + F.lit(0.0))
    keyed = rows.withColumns({
        "k1": F.when(sound, F.xxhash64(plain)), "k2": F.when(sound, F.xxhash64(F.lit(7), plain))})
    classes = stage(keyed.where("k1 is not null").groupBy("label", "k1", "k2").agg(
        F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("copies"),
        F.any_value("embedding").alias("embedding")), "vector-classes")
    groups = components(_found_links(classes, cosine, window, recall))
    members = classes.join(groups, "id").select("id", "component", "copies", "embedding")
    exact = exact_links(members, _cosine_links(cosine), ["embedding"])
    known = (classes.select("label", "k1", "k2", "id", "copies").join(exact, "id", "left")
             .where("copies > 1 or n_links is not null")
             .select("label", "k1", "k2",
                     (F.coalesce("n_links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                     F.coalesce("component", "id").alias("component_id")))
    out = salted_lookup(keyed.select("vec_id", "label", "k1", "k2"), known, ["label", "k1", "k2"],
                        F.col("vec_id"), "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"),
                      F.col("vec_id").eqNullSafe(component).alias("kept"))
