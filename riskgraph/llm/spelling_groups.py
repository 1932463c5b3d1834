"""Spelling variants: words one edit apart, grouped under the most frequent form.

The vocabulary is cut into groups whose words share their first or last half, as an edit spares one
of the two. Within a group a bit-sliced index has, per position and letter, the set of words with
that letter there, as one long bit string. A word is compared with all others at once: going through
its letters, the sets of words without an error and with one error so far (a replaced letter, one
more, one less) are moved on together by a few operations on whole sets.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from riskgraph.functions.joins import counted_lookup
from riskgraph.llm.memory import as_task
from riskgraph.sources.staging import broadcast_below, stage, unstage

LEAST_LETTERS, LEAST_COUNT = 6, 5
#: A word's form occurs at least so many times as often as the word.
RATIO = 5
LETTERS = "A-Za-zÀ-ÿ"
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
#: Distinct words that a task counts before it hands the counts on.
COUNTED_WORDS = 200_000
#: Words of a block: the bits of a set. Larger groups are compared block by block.
BLOCK = 4096
# Heavy groups up to which their list is broadcast.
BROADCAST_ROWS = 1_000_000


def count_words(docs: DataFrame, least_letters: int = LEAST_LETTERS,
                least_count: int = LEAST_COUNT, slip: int | None = None) -> DataFrame:
    """(word, n): runs of letters of all texts with only A to Z lower-cased, and their occurrences.

    Null texts have no words. With ``slip``, a run loses a letter where the crc32 of
    ``doc_id:run`` can be divided by it, the one at the place of the crc32 modulo the length; a null
    doc_id is empty there. Tasks hand on sums, which are combined before and after the shuffle.
    """
    run = re.compile(f"[{LETTERS}]{{{least_letters},}}")

    @as_task
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: defaultdict[str, int] = defaultdict(int)
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                start = zlib.crc32(f"{doc_id}:".encode())
                for word, n in Counter(run.findall(text)).items():
                    word = word.lower() if word.isascii() else word.translate(LOWER)
                    if slip:
                        h = zlib.crc32(word.encode(), start)
                        if h % slip == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1:]
                            if len(word) < least_letters:
                                continue
                    seen[word] += n
                if len(seen) > COUNTED_WORDS:
                    yield pd.DataFrame({"word": list(seen), "n": list(seen.values())})
                    seen.clear()
        if seen:
            yield pd.DataFrame({"word": list(seen), "n": list(seen.values())})

    texts = docs.where("text is not null").select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), "text")
    return (texts.mapInPandas(count, "word string, n long").groupBy("word")
            .agg(F.sum("n").alias("n")).where(F.col("n") >= least_count))


class PositionIndex:
    """Bit sets over ``words`` by position and letter; bit k stands for word k.

    Only positions from ``first`` on are kept: the words are known to agree before.
    """

    def __init__(self, words: list[str], first: int = 0) -> None:
        self.first, self.all = first, (1 << len(words)) - 1
        self.at: defaultdict[tuple[int, str], int] = defaultdict(int)
        self.of_length: defaultdict[int, int] = defaultdict(int)
        for k, word in enumerate(words):
            bit = 1 << k
            self.of_length[len(word)] |= bit
            for place in range(first, len(word)):
                self.at[place, word[place]] |= bit

    def near(self, word: str) -> tuple[int, int, int]:
        """Sets of the words that ``word`` becomes by replacing a letter, inserting one, or
        deleting one.

        ``same`` holds the words without an error so far; in ``longer`` the indexed word is one
        letter ahead, in ``shorter`` one behind.
        """
        get = self.at.get
        same, replaced, longer, shorter = self.all, 0, 0, 0
        for i in range(self.first, len(word)):
            c = word[i]
            here = get((i, c), 0)
            longer = (longer | same) & get((i + 1, c), 0)
            shorter = shorter & get((i - 1, c), 0) | same
            replaced = replaced & here | same & ~here
            same &= here
        size, lengths = len(word), self.of_length
        return (replaced & lengths.get(size, 0), (longer | same) & lengths.get(size + 1, 0),
                shorter & lengths.get(size - 1, 0))


def _members(bits: int) -> Iterator[int]:
    while bits:
        low = bits & -bits
        yield low.bit_length() - 1
        bits ^= low


def near_pairs(words: list[str], blocks: list[int], size: int, side: str) -> Iterator[tuple]:
    """(k, j): pairs of a cell's words that are one edit apart, each once.

    The words have ``size`` letters or one more and share the first ``size // 2`` (side p) or the
    last (side s); pairs that share both belong to side p. Pairs of longer words belong to
    another group. A cell holds one block of words, or the pairs between two.
    """
    half = size // 2
    turned = [w[::-1] for w in words] if side == "s" else words
    index = PositionIndex(turned, half)
    first = blocks[0]
    other = sum(1 << k for k, b in enumerate(blocks) if b != first)
    for k, word in enumerate(turned):
        if len(word) != size:
            continue
        replaced, longer, _ = index.near(word)
        replaced &= -1 << k + 1
        if other:
            mask = other if blocks[k] == first else index.all & ~other
            replaced, longer = replaced & mask, longer & mask
        for j in _members(replaced | longer):
            if side == "p" or words[k][:half] != words[j][:half]:
                yield k, j


def near_words(vocabulary: DataFrame, least_letters: int = LEAST_LETTERS,
               block: int = BLOCK) -> DataFrame:
    """(word, near, n): for every word of ``vocabulary`` (word, n) the words one edit apart and how
    often those occur; each pair both ways.

    For two words of m letters, or of m and m + 1, an edit spares the first or the last m // 2
    letters. A word takes part in the groups of its own length and of one less.
    """
    size, length = F.col("size"), F.length("word")
    sizes = F.filter(F.array(length, length - 1), lambda m: m >= least_letters)
    half = F.floor(size / 2).cast("int")
    parts = F.array(F.struct(F.lit("p").alias("side"), F.substring("word", 1, half).alias("part")),
                    F.struct(F.lit("s").alias("side"), F.substring("word", -half, half).alias("part")))
    keyed = (vocabulary.select("word", "n", F.explode(sizes).alias("size"))
             .select("word", "n", "size", F.explode(parts).alias("p"))
             .select("word", "n", "size", "p.side", "p.part"))
    group = ["size", "side", "part"]
    heavy = stage(keyed.groupBy(*group).agg(F.count(F.lit(1)).alias("rows"))
                  .where(F.col("rows") > block)
                  .withColumn("blocks", F.ceil(F.col("rows") / block).cast("int")).drop("rows"),
                  "heavy-groups")
    placed = (keyed.join(broadcast_below(heavy, BROADCAST_ROWS, "part"), group, "left")
              .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
              .withColumn("block", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .withColumn("i", F.least("block", "other"))
              .withColumn("j", F.greatest("block", "other")))
    cell = [*group, "i", "j"]

    @as_task
    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out: list[tuple] = []
        key, words, counts, blocks = None, [], [], []

        def found() -> None:
            if len(words) > 1:
                for k, j in near_pairs(words, blocks, key[0], key[1]):
                    out.append((words[k], words[j], counts[j]))
                    out.append((words[j], words[k], counts[k]))

        for batch in batches:
            keys = zip(*(batch[c].tolist() for c in cell))
            for now, word, n, own in zip(keys, batch["word"].tolist(), batch["n"].tolist(),
                                         batch["block"].tolist()):
                if now != key:
                    found()
                    key, words, counts, blocks = now, [], [], []
                    if len(out) > 50_000:
                        yield pd.DataFrame(out, columns=["word", "near", "n"])
                        out.clear()
                words.append(word)
                counts.append(n)
                blocks.append(own)
        found()
        if out:
            yield pd.DataFrame(out, columns=["word", "near", "n"])

    return (placed.select(*cell, "word", "n", "block").repartition(*cell)
            .sortWithinPartitions(*cell, "word")
            .mapInPandas(compare, "word string, near string, n long"))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): the end of each word's chain of forms.

    Each round doubles the steps a root is away, and a form is at least ``RATIO`` times as
    frequent as its word, so the rounds are few. Very many words may share a root: such roots only are
    copied, as a table that Spark broadcasts is held by the driver with all copies.
    """
    now = stage(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        after = stage(counted_lookup(now, onward, ["root"], F.col("word"), "left").select(
            "word", F.coalesce("next", "root").alias("root"),
            F.col("next").isNotNull().alias("moved")), "roots")
        moved = not after.where("moved").isEmpty()
        unstage(now)
        now = after.drop("moved") if not moved else after.select("word", "root")
        if not moved:
            return now


def group_variants(vocabulary: DataFrame, least_letters: int = LEAST_LETTERS,
                   ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of ``vocabulary`` (word, n).

    ``n_near`` counts the words exactly one inserted, deleted or replaced letter apart. The form is
    the most frequent of them (ties: the first in code-point order) if it is at least ``ratio``
    times as frequent as the word, else null; ``root`` follows the forms to the last. Words are
    distinct and have at least ``least_letters`` letters; there may be none.
    """
    words = stage(vocabulary.select("word", "n"), "vocabulary")
    best = F.min(F.struct((-F.col("n")).alias("minus"), "near"))
    near = near_words(words, least_letters).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    named = stage(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(-F.col("best.minus") >= ratio * F.col("n"), F.col("best")).alias("best"))
        .select("word", "n", "n_near", F.col("best.near").alias("form"),
                (-F.col("best.minus")).alias("form_n")), "named-words")
    roots = _roots(named.where("form is not null"))
    return named.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
