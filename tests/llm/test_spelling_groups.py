import random
import re
import zlib
from collections import Counter

import pytest

from riskgraph.llm import queries, spelling_groups as spell


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def plain_groups(counts):
    out = {}
    for w, n in counts.items():
        close = sorted((-m, v) for v, m in counts.items() if near(w, v))
        form = close[0] if close and -close[0][0] >= 5 * n else None
        out[w] = (form and form[1], n, len(close), form and -form[0])
    rows = {}
    for w, (form, n, n_near, form_n) in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        rows[w] = (form, root, n, n_near, form_n)
    return rows


def vocabulary(letters="abé", size=260, seed=2):
    rng = random.Random(seed)
    words = {"".join(rng.choice(letters) for _ in range(rng.randrange(6, 10)))
             for _ in range(size)}
    words |= {"a" * n for n in range(6, 14)} | {"b" * 40, "b" * 41, "b" * 20 + "a" + "b" * 20}
    return {w: rng.choice([5, 6, 7, 30, 36, 200, 5000]) for w in sorted(words)}


@pytest.mark.parametrize("block", [4096, 7])
def test_groups_against_all_pairs(spark, monkeypatch, block):
    counts = vocabulary()
    monkeypatch.setattr(spell, "BLOCK", block)
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    pairs = spell.near_words(df, block=block).collect()
    want = {(a, b): counts[b] for a in counts for b in counts if near(a, b)}
    assert len(pairs) == len(want) and {(r.word, r.near): r.n for r in pairs} == want
    got = spell.group_variants(df)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert {r[0]: tuple(r[1:]) for r in got.collect()} == plain_groups(counts)


def test_index_follows_all_errors_at_once():
    words = list(vocabulary(size=400, seed=5))
    index = spell.PositionIndex(words)
    for word in words[::7] + ["", "a", "zzzzzz", "x" * 60]:
        replaced, longer, shorter = ([words[k] for k in spell._members(bits)]
                                     for bits in index.near(word))
        assert replaced == [w for w in words if len(w) == len(word) and near(w, word)]
        assert longer == [w for w in words if len(w) == len(word) + 1 and near(w, word)]
        assert shorter == [w for w in words if len(w) == len(word) - 1 and near(w, word)]


def plain_counts(docs, slip):
    out = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % slip == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1:]
            if len(word) >= 6:
                out[word] += 1
    return {w: n for w, n in out.items() if n >= 5}


def test_query_on_a_table(spark, tmp_path, monkeypatch):
    rng = random.Random(3)
    words = ["Straße", "straßen", "ÀLLÉES", "allées", "Colour", "color", "COLOURS", "colours",
             "neighbour", "neighbor", "one×two", "kitten", "Kittens", "sitting", "sixsix"]
    docs = [(i, "\n".join(rng.choice(words) + rng.choice([" ", "1", ", ", "_"])
                           for _ in range(rng.randrange(40)))) for i in range(400)]
    docs += [(900, None), (901, ""), (None, "colours " * 9), (5, "colours"), (5, "colours"),
             (902, "x" * 3000 + " " + "y" * 3001)] + [(903 + i, "x" * 3000) for i in range(5)]
    spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, n int").write.parquet(
        str(tmp_path / "documents.parquet"))
    got = queries.QUERIES["op12_spelling_variants"](spark, str(tmp_path))
    assert {r[0]: tuple(r[1:]) for r in got.collect()} == plain_groups(plain_counts(docs, 199))
    monkeypatch.setattr(spell, "COUNTED_WORDS", 3)
    table = spark.read.parquet(str(tmp_path / "documents.parquet"))
    assert dict(map(tuple, spell.count_words(table, slip=3).collect())) == plain_counts(docs, 3)


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert spell.group_variants(spell.count_words(none)).count() == 0


def test_roots_are_not_copied_for_each_salt(spark, monkeypatch):
    """The driver broadcasts the table of roots: only roots of very many words are copied."""
    plans = []

    def spied(df, name):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return stage(df, name)

    stage = spell.stage
    monkeypatch.setattr(spell, "stage", spied)
    forms = [(f"w{k}", f"w{k // 2}") for k in range(2, 200)]
    got = spell._roots(spark.createDataFrame(forms, "word string, form string"))
    assert {tuple(r) for r in got.collect()} == {(w, "w1") for w, _ in forms}
    copying = [line for plan in plans for line in plan.splitlines() if "Generate explode" in line]
    assert len(plans) > 3 and all("__copies" in line for line in copying)
