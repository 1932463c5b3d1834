"""Groups of linked rows: connected components, and all pairs within a group in blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from riskgraph.functions.joins import salted_lookup
from riskgraph.llm.memory import as_task
from riskgraph.sources.staging import stage, unstage

#: Rows of a block; a cell of the pair grid holds two blocks.
BLOCK_ROWS = 512


def local_roots(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Smallest position linked to each of ``n`` positions by the given pairs of positions."""
    root = np.arange(n)
    while len(left):
        low = np.minimum(root[left], root[right])
        before = root.copy()
        np.minimum.at(root, left, low)
        np.minimum.at(root, right, low)
        np.minimum.at(root, before, root)
        root = root[root]
        if (root == before).all():
            break
    return root


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every id of ``edges`` (a, b): the smallest id it is connected with.

    Edges are turned into stars round by round (large stars, then small stars); each round is
    staged, the one before deleted. A node that very many edges share meets its minimum in several
    tasks. Nothing but the round's checksum reaches the driver.
    """
    now = stage(edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = None
    while True:
        both = now.unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        large = (salted_lookup(both, least, ["a"], F.col("b"))
                 .withColumn("m", F.least("a", "m")).where("b > a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        large = stage(large, "large-stars")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (salted_lookup(large, least, ["a"], F.col("b")).where("b <> m")
                 .select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionAll(least.select("a", F.col("m").alias("b"))).distinct())
        after = stage(small, "small-stars")
        unstage(now, large)
        check = after.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
                          ).first()
        now = after
        if check == seen:
            break
        seen = check
    ids = now.select(F.col("a").alias("id"), F.col("b").alias("component"))
    roots = now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return ids.unionAll(roots)


def pair_cells(members: DataFrame, rows: int = BLOCK_ROWS) -> DataFrame:
    """``members`` (id, component, ...) copied to the cells of their component's pair grid.

    A component is cut into blocks of about ``rows`` rows by a hash of the id, and cell (i, j)
    holds blocks i and j, so that every pair meets in one cell and a cell is bounded however
    large the component is. Adds ``i``, ``j`` and ``block``.
    """
    sizes = members.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    blocks = F.floor((F.col("size") + (rows - 1)) / rows).cast("int")
    placed = (salted_lookup(members, sizes, ["component"], F.col("id"))
              .withColumn("blocks", blocks)
              .withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    return (placed.withColumn("other", other)
            .withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
            .drop("size", "blocks", "other"))


def in_groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Whole groups, one after the other, from batches that are sorted by ``keys``."""
    rest: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        first = np.flatnonzero(np.append(True, np.any(
            [batch[k].to_numpy()[1:] != batch[k].to_numpy()[:-1] for k in keys], axis=0)))
        if rest and any(rest[-1][k].iloc[-1] != batch[k].iloc[0] for k in keys):
            yield pd.concat(rest, ignore_index=True)
            rest = []
        for a, b in zip(first[:-1], first[1:]):
            yield pd.concat([*rest, batch.iloc[a:b]], ignore_index=True)
            rest = []
        rest.append(batch.iloc[first[-1]:])
    if rest:
        yield pd.concat(rest, ignore_index=True)


def grouped_map(df: DataFrame, keys: list[str], order: list[str], func, schema: str) -> DataFrame:
    """``func`` on each group of ``keys`` (bounded by the caller), groups streamed in order."""
    @as_task
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out: list[pd.DataFrame] = []
        rows = 0
        for group in in_groups(batches, keys):
            out.append(func(group))
            rows += len(out[-1])
            if rows > 20_000:
                yield pd.concat(out, ignore_index=True)
                out, rows = [], 0
        if out:
            yield pd.concat(out, ignore_index=True)

    return df.repartition(*keys).sortWithinPartitions(*keys, *order).mapInPandas(run, schema)


def exact_links(members: DataFrame, links_of, payload: list[str],
                rows: int = BLOCK_ROWS) -> DataFrame:
    """(id, n_links, component): links among all pairs of ``members`` (id, component, copies, ...).

    ``links_of(frame)`` gives the square 0/1 matrix of links of a frame with the ``payload``
    columns. Members that link with nothing are left out. ``n_links`` counts the linked members'
    ``copies``; the new component is that of the links.
    """
    def links(cell: pd.DataFrame) -> pd.DataFrame:
        linked = links_of(cell)
        np.fill_diagonal(linked, False)
        block = cell["block"].to_numpy()
        if cell["i"].iloc[0] != cell["j"].iloc[0]:  # pairs of one block have their own cell
            linked &= block[:, None] != block[None, :]
        left, right = np.nonzero(np.triu(linked))
        ids = cell["id"].to_numpy()
        order = np.argsort(ids, kind="stable")
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        root = ids[order][local_roots(len(ids), place[left], place[right])[place]]
        out = pd.DataFrame({"id": ids, "n_links": linked @ cell["copies"].to_numpy(np.int64),
                            "root": root})
        return out[out["n_links"] > 0]

    cells = pair_cells(members.select("id", "component", "copies", *payload), rows)
    found = stage(grouped_map(cells, ["component", "i", "j"], ["id"], links,
                              "id long, n_links long, root long"), "links")
    counts = found.groupBy("id").agg(F.sum("n_links").alias("n_links"))
    return counts.join(components(found.select(F.col("id").alias("a"), F.col("root").alias("b"))),
                       "id")
