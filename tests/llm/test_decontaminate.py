import random
import re

import pytest

from riskgraph.llm import decontaminate as dec


def words(rng, n):
    return [rng.choice("abcdefgh") + str(rng.randrange(400)) for _ in range(n)]


def best(doc, item, rule):
    """Agreeing tokens of the best stretch over all shifts, by trying each stretch."""
    cost = rule.agree / (1 - rule.agree) - 1e-6
    found = None
    for shift in range(-len(item) + 1, len(doc)):
        same = [(shift + k, doc[shift + k] == w) for k, w in enumerate(item)
                if 0 <= shift + k < len(doc)]
        top, hits = 0.0, 0
        for i in range(len(same)):
            total = n = 0
            for _, hit in same[i:]:
                total, n = total + (1 if hit else -cost), n + hit
                if total > top + 1e-12:
                    top, hits = total, n
        if hits >= min(rule.least_tokens, len(item)):
            found = max(found or 0, hits)
    return found


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(4)
    items = {i: words(rng, n) for i, n in enumerate([30, 18, 15, 40, 4, 9, 25])}
    docs = {}
    for d in range(60):
        doc, item = words(rng, rng.randrange(0, 60)), list(items[d % 7])
        if d % 3 == 0:  # a copy, in part or with replaced tokens
            if d % 2:
                for k in range(3 + d % 4, len(item), 9):
                    item[k] = "replaced"
            cut = rng.randrange(max(1, len(item) - 13)) if d % 5 == 0 else 0
            at = rng.randrange(len(doc) + 1)
            doc[at:at] = item[cut:]
        docs[d] = doc
    docs[100], docs[101] = [], words(rng, 3000) + items[0] + words(rng, 3000)
    rows = [(d, " ".join(w).upper().replace(" ", ", "), -d, "x") for d, w in docs.items()]
    rows += [(200, None, 0, "x"), (None, "text", 0, "x"), (3, rows[3][1], 0, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, item_id int, tokens string")
    bench = spark.createDataFrame(
        [(i, "?" + " ".join(w) + "!", "s") for i, w in items.items()]
        + [(50, None, "s"), (51, "...", "s"), (0, " ".join(items[0]), "s")],
        "item_id long, text string, doc_id string")
    return df, bench, docs, items


def test_against_brute_force(tables):
    df, bench, docs, items = tables
    want = {(d, i): best(w, item, dec.Rule()) for d, w in docs.items()
            for i, item in items.items()}
    want = {k: n for k, n in want.items() if n}
    assert len(want) > 15 and (101, 0) in want
    for rule in (dec.Rule(), dec.Rule(broadcast_seeds=0)):
        got = dec.leaks(df, bench, rule=rule).collect()
        assert {(r.doc_id, r.item_id): r.n_agree for r in got} == want
        assert len(got) == len(want)
        for r in got:
            a, b = docs[r.doc_id][r.start], docs[r.doc_id][r.end - 1]
            assert a in items[r.item_id] and b in items[r.item_id]
            assert r.n_item == len(items[r.item_id])


def test_clean_documents_stay(tables):
    df, bench, docs, items = tables
    leaked = {d for d, w in docs.items() for item in items.values()
              if best(w, item, dec.Rule())}
    kept = dec.decontaminate(df, bench)
    assert kept.columns == df.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(
        {*docs, 200} - leaked | ({3} - leaked)) or ids.count(3) == 2
    assert None in ids


def test_tokens_are_runs_of_letters_and_digits(spark):
    from riskgraph.llm.shingles import token_hashes
    texts = ["Ä b-c, 9!", "", None, "...", "ä B C 9"]
    got = [r.h for r in spark.createDataFrame([(t,) for t in texts], "text string").select(
        token_hashes("text").alias("h")).collect()]
    assert got[0] == got[4] and len(got[0]) == len(re.findall(r"\w+", texts[0]))
    assert got[1] == got[2] == got[3] == []


def test_empty_tables(spark, tables):
    df, bench, *_ = tables
    assert dec.leaks(df.limit(0), bench).count() == 0
    assert dec.leaks(df, bench.limit(0)).count() == 0


def hit(same, masks=dec.MASKS):
    return any(all(same[at + k] for k, bit in enumerate(m) if bit == "1")
               for m in masks for at in range(len(same) - len(m) + 1))


def test_masks_hit_every_stretch_that_counts():
    """Grows all stretches without a hit token by token; none may count, at any length."""
    cost = dec.AGREE / (1 - dec.AGREE) - 1e-6
    span = max(map(len, dec.MASKS))
    # the last tokens, their balance, the best balance before, and the agreeing tokens
    states, seen = {((), 0.0, 0.0, 0)}, set()
    for _ in range(300):
        grown = set()
        for last, total, top, hits in states:
            for same in (True, False):
                now = (*last, same)
                value = round(total + (1.0 if same else -cost), 7)
                if value <= 0 or hit(now):
                    continue
                count = min(hits + same, dec.LEAST_TOKENS)
                assert not (value > top and count == dec.LEAST_TOKENS), now
                grown.add((now[-span + 1:], value, max(top, value), count))
        states = grown - seen
        seen |= grown
    assert seen


def test_replaced_tokens(spark):
    rng, docs, items, want = random.Random(8), [], [], set()
    for n in range(15, 31):
        patterns = [set(range(4, n, 5))] + [set(rng.sample(range(n), n // 5)) for _ in range(12)]
        patterns += [{4, 9}, {5, 10}, {4, 10, 14}]
        for gone in patterns:
            k, item = len(items), words(rng, n)
            doc = ["other" if i in gone else w for i, w in enumerate(item)]
            items.append((k, " ".join(item)))
            docs.append((k, " ".join(doc)))
            if best(doc, item, dec.Rule()):
                want.add((k, k))
    found = dec.leaks(spark.createDataFrame(docs, "doc_id long, text string"),
                      spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in found if r.doc_id == r.item_id} == want
    assert len(want) > 60


def test_hits_carry_stretches_not_documents(tables):
    """A task holds all hits of a document at once: none may hold the document's tokens."""
    df, bench, *_ = tables
    plan = dec.leaks(df, bench)._jdf.queryExecution().optimizedPlan().toString()
    verified = [line for line in plan.splitlines() if "aggregate(zip_with(" in line]
    assert verified and not any("tokens#" in line for line in verified)


def test_items_over_both_ends_of_a_document(spark):
    item = [f"t{k}" for k in range(40)]
    docs = [(1, item[20:] + ["x"] * 30), (2, ["x"] * 30 + item[:20]), (3, item[10:30]),
            (4, item + ["x"] + item[:15])]
    df = spark.createDataFrame([(d, " ".join(w)) for d, w in docs], "doc_id long, text string")
    bench = spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")
    for rule in (dec.Rule(), dec.Rule(broadcast_seeds=0)):
        got = sorted((r.doc_id, r.start, r.end, r.n_agree, r.n_item)
                     for r in dec.leaks(df, bench, rule=rule).collect())
        assert got == [(1, 0, 20, 20, 40), (2, 30, 50, 20, 40), (3, 0, 20, 20, 40),
                       (4, 0, 40, 40, 40)]
