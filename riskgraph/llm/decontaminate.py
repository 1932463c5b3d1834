"""Benchmark decontamination by spaced-seed hashing, in DataFrame functions only.

A mask looks at some of ``span`` token positions in a row and ignores the rest. Equal hashes under
any mask are hits between a benchmark item and a document; around each hit the item is laid along
the document and the positions that agree are counted, so that a replaced token costs one position.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from riskgraph.llm.shingles import token_hashes
from riskgraph.sources.staging import broadcast_below, stage

#: Fixed masks, 7 positions of each looked at (1). Every stretch that counts at 80 % holds a hit: its
#: first run of agreeing tokens is 7 or longer, or it is 4 to 6 long with one other token after it,
#: and then 3 agreeing tokens follow, or 2 after a run of 6, or the stretch would have ended.
MASKS = ("1111111", "11110111", "11111101")
#: An item counts as leaked where this share of the stretch's tokens agrees ...
AGREE = 0.8
#: ... and at least so many tokens, or the whole of a shorter item, agree.
LEAST_TOKENS = 13
#: Benchmark seeds that are broadcast (a seed is three numbers); more are joined by shuffling.
BROADCAST_SEEDS = 1_000_000
#: Ids of leaked documents that are broadcast; more are joined by shuffling.
BROADCAST_IDS = 2_000_000


@dataclass(frozen=True)
class Rule:
    """When an overlap counts, and the size up to which the benchmark is broadcast.

    ``MASKS`` hit every overlap that counts for ``agree`` from 0.8 and ``least_tokens`` from 7.
    """

    agree: float = AGREE
    least_tokens: int = LEAST_TOKENS
    broadcast_seeds: int = BROADCAST_SEEDS


def seed_hash(tokens: Column, at: Column, mask: str, number: int) -> Column:
    """Hash of the tokens that the mask looks at from ``at``; null past the end."""
    looked = [F.get(tokens, at + k) for k, bit in enumerate(mask) if bit == "1"]
    value = F.xxhash64(F.lit(number), *looked)
    return F.when(at + len(mask) <= F.size(tokens), value)


def _item_seeds(items: DataFrame, masks: tuple[str, ...], general: int) -> DataFrame:
    """(seed, item_id, item_at, n_item) of all places and masks of the benchmark items.

    A mask after the first ``general`` ones stands for the items of just its length.
    """
    places = items.select("item_id", "item", F.posexplode("item").alias("item_at", "token"))
    seeds = F.array(*[
        F.when(F.lit(k < general) | (F.size("item") == len(m)),
               seed_hash(F.col("item"), F.col("item_at"), m, k)) for k, m in enumerate(masks)])
    return (places.select("item_id", "item_at", F.size("item").alias("n_item"),
                          F.explode(seeds).alias("seed"))
            .where("seed is not null").distinct())


def _stretch(hits: DataFrame) -> DataFrame:
    """(doc_id, item_id, first, part, item_first, ...) of hits with tokens, at, item_at and n_item:
    the document's tokens along the item, which are those from ``first`` on.

    A hit takes a stretch with it that is no longer than the item, so that the hits of a document,
    which a task holds together, do not each hold all its tokens.
    """
    shift = F.col("at") - F.col("item_at")
    first = F.greatest(shift, F.lit(0))
    length = F.least(F.size("tokens") - first, F.col("n_item") - (first - shift))
    return hits.withColumns({"first": first, "item_first": first - shift,
                             "part": F.slice("tokens", first + 1, length)}).drop("tokens")


def _run_start(masks: tuple[str, ...]) -> Column:
    """True unless the places one token earlier are a hit under the same mask."""
    at, item_at = F.col("at") - F.col("first"), F.col("item_at")
    earlier = F.lit(False)
    for k, mask in enumerate(masks):
        same = seed_hash(F.col("part"), at - 1, mask, k) == seed_hash(
            F.col("item"), item_at - 1, mask, k)
        earlier = F.when(F.col("k") == k, same).otherwise(earlier)
    return ~((F.col("at") > 0) & (item_at > 0) & earlier)


def _verify(rows: DataFrame, rule: Rule) -> DataFrame:
    """Overlaps of rows of ``_stretch`` with their item that count.

    Of all stretches that begin and end with an agreeing token, the one with the best balance of
    agreeing tokens (+1) and others (-agree / (1 - agree)) is taken: the overlap may cover a part
    of the item, and a replaced token inside it costs its position only.
    """
    cost = rule.agree / (1 - rule.agree) - 1e-6  # just that share still counts
    along = F.slice("item", F.col("item_first") + 1, F.size("part"))
    same = F.zip_with("part", along, lambda a, b: a == b)
    start = F.expr("named_struct('sum', 0.0D, 'from', 0, 'hits', 0, 'k', 0, 'best', 0.0D, "
                   "'best_from', 0, 'best_to', 0, 'best_hits', 0)")

    def step(acc: Column, hit: Column) -> Column:
        fresh = acc["sum"] <= 0
        total = F.when(hit, F.greatest(acc["sum"], F.lit(0.0)) + 1.0).otherwise(acc["sum"] - cost)
        begin = F.when(fresh, acc["k"]).otherwise(acc["from"])
        hits = F.when(fresh, F.lit(0)).otherwise(acc["hits"]) + hit.cast("int")
        best = total > acc["best"]
        return F.struct(
            total.alias("sum"), begin.alias("from"), hits.alias("hits"),
            (acc["k"] + 1).alias("k"), F.when(best, total).otherwise(acc["best"]).alias("best"),
            F.when(best, begin).otherwise(acc["best_from"]).alias("best_from"),
            F.when(best, acc["k"] + 1).otherwise(acc["best_to"]).alias("best_to"),
            F.when(best, hits).otherwise(acc["best_hits"]).alias("best_hits"))

    best = F.aggregate(same, start, step)
    least = F.least(F.lit(rule.least_tokens), F.col("n_item"))
    return (rows.withColumn("best", best).where(F.col("best.best_hits") >= least)
            .select("doc_id", "item_id", (F.col("first") + F.col("best.best_from")).alias("start"),
                    (F.col("first") + F.col("best.best_to")).alias("end"),
                    F.col("best.best_hits").alias("n_agree"), "n_item"))


def leaks(docs: DataFrame, benchmark: DataFrame, masks: tuple[str, ...] = MASKS,
          rule: Rule = Rule()) -> DataFrame:
    """(doc_id, item_id, start, end, n_agree, n_item): the best overlap of each pair that counts.

    ``start`` and ``end`` are token positions in the document; each pair is reported once.
    ``docs`` has doc_id and text, ``benchmark`` item_id and text; null texts are empty, and items
    shorter than the masks are looked for as a whole. Repeated doc_ids count as one document.
    Seeds of every place of every document are looked at. While the benchmark has few seeds it is
    broadcast, and overlaps are verified where the documents are read; a larger one is joined by
    shuffling seeds, and documents with hits then meet their items.
    """
    items = stage(benchmark.select("item_id", token_hashes("text").alias("item"))
                  .where(F.size("item") > 0), "benchmark-items")
    span = min(map(len, masks))
    short = items.where(F.size("item") < span).select(F.size("item").alias("n")).distinct()
    general = len(masks)
    masks += tuple("1" * r.n for r in short.orderBy("n").collect())
    seeds = stage(_item_seeds(items, masks, general), "benchmark-seeds")
    tokens = docs.select("doc_id", token_hashes("text").alias("tokens"))
    # The outer form keeps the planner from computing the tokens once more for a filter.
    places = tokens.select("doc_id", "tokens",
                           F.posexplode_outer("tokens").alias("at", "token")).drop("token")
    seeded = places.select("doc_id", "tokens", "at", F.posexplode(F.array(
        *[seed_hash(F.col("tokens"), F.col("at"), m, k) for k, m in enumerate(masks)]
    )).alias("k", "seed")).where("seed is not null")
    if seeds.count() <= rule.broadcast_seeds:
        hits = (_stretch(seeded.join(F.broadcast(seeds), "seed"))
                .join(F.broadcast(items), "item_id").where(_run_start(masks)))
    else:
        pairs = seeded.drop("tokens").join(seeds, "seed").select(
            "doc_id", "item_id", (F.col("at") - F.col("item_at")).alias("at"),
            F.lit(0).alias("item_at"), "n_item").distinct()
        hits = _stretch(pairs.join(tokens, "doc_id")).join(items, "item_id")
    overlap = F.struct("n_agree", -F.col("start"), "end", "n_item", "start")
    return (_verify(hits, rule).groupBy("doc_id", "item_id").agg(F.max(overlap).alias("o"))
            .select("doc_id", "item_id", "o.start", "o.end", "o.n_agree", "o.n_item"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, masks: tuple[str, ...] = MASKS,
                  rule: Rule = Rule()) -> DataFrame:
    """``docs`` without the documents that overlap a benchmark item; rows with a null doc_id,
    which no overlap can name, stay."""
    leaked = stage(leaks(docs, benchmark, masks, rule).select("doc_id").distinct(), "leaked")
    return docs.join(broadcast_below(leaked, BROADCAST_IDS), "doc_id", "left_anti")
