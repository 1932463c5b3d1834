import random

import numpy as np
import pytest

from riskgraph.llm import suffix_dedup as dedup


def brute(texts):
    """{doc: (n_bytes, removed, spans, kept)} by looking at every string."""
    seen, out = set(), {}
    for doc in sorted(texts):
        data = (texts[doc] or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - dedup.LENGTH + 1):
            s = data[p:p + dedup.LENGTH]
            if s in seen:
                gone[p:p + dedup.LENGTH] = b"\1" * dedup.LENGTH
            seen.add(s)
        spans = sum(1 for k in range(len(gone)) if gone[k] and not (k and gone[k - 1]))
        out[doc] = (len(data), sum(gone), spans, bytes(b for b, g in zip(data, gone) if not g))
    return out


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(21)

    def prose(n):
        return "".join(rng.choice(["the ", "of ", "and ", "ène ", "tion ", "x"]) +
                       rng.choice("abcdefgh") for _ in range(n))

    passages = [prose(n) for n in (30, 45, 20, 80)]
    out = {}
    for d in range(90):
        parts = [prose(rng.randrange(1, 60)) for _ in range(rng.randrange(1, 4))]
        for _ in range(rng.randrange(0, 3)):
            p = rng.choice(passages)
            cut = rng.randrange(len(p) // 2)
            parts.insert(rng.randrange(len(parts) + 1), p[cut:] if rng.random() < 0.5 else p)
        out[d * 7] = "".join(parts)
    for d in range(40):  # near copies and copies of one text
        copy = list(out[14] + passages[3])
        for _ in range(d % 4):
            copy[rng.randrange(len(copy))] = "Q"
        out[10_000 - d] = "".join(copy)
    out |= {1: None, 2: "", 3: "short", 4: "a" * 99, 5: "a" * 100, 6: "a" * 350, 8: "ab" * 400,
            9: "a" * 101, 11: "line of text, again and again.\n" * 60, 12: passages[0] * 5}
    return out


def test_against_brute_force(spark, texts, monkeypatch):
    df = spark.createDataFrame([(d, t, "x", 3) for d, t in texts.items()]
                               + [(None, texts[14], "x", 3), (14, texts[14], "x", 3)],
                               "doc_id long, text string, kind string, start int")
    want = brute(texts)
    for bound, kinds, units in ((dedup.BROADCAST_ROWS, dedup.KINDS, dedup.UNITS), (0, 4, 5)):
        monkeypatch.setattr(dedup, "BROADCAST_ROWS", bound)
        monkeypatch.setattr(dedup, "KINDS", kinds)
        monkeypatch.setattr(dedup, "UNITS", units)
        rows = dedup.remove_repeats(df).collect()
        assert len(rows) == len(texts) + 2
        for r in rows:
            got = (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept))
            if r.doc_id is None:
                assert got == (want[14][0], 0, 0, texts[14].encode())
            else:
                assert got == want[r.doc_id], r.doc_id
    assert dedup.remove_repeats(df.limit(0)).count() == 0


def test_units_do_not_depend_on_the_neighbours():
    rng = np.random.default_rng(1)
    docs = [rng.integers(97, 101, n).astype(np.uint8) for n in (500, 99, 0, 100, 3000)]
    bounds = np.cumsum([0] + [len(d) for d in docs])
    together = list(zip(*(x.tolist() for x in dedup.units(np.concatenate(docs), bounds))))
    for k, d in enumerate(docs):
        alone = zip(*(x.tolist() for x in dedup.units(d, np.array([0, len(d)]))))
        assert [(*u[:2], *u[3:]) for u in together if u[2] == k] == [
            (*u[:2], *u[3:]) for u in alone]
        starts = sum(u[4] for u in together if u[2] == k)
        assert starts == max(len(d) - dedup.LENGTH + 1, 0)


def test_identifiers_tell_strings_apart():
    data = np.random.default_rng(2).integers(0, 3, 5000).astype(np.uint8)
    for length in (1, 7, 32, 100):
        ids, = dedup.identifiers(data, (length,))
        strings = [data[i:i + length].tobytes() for i in range(len(data) - length + 1)]
        assert len(set(ids.tolist())) == len(set(strings)) == len(set(zip(ids.tolist(), strings)))


def test_repeated_rows_without_near_copies(spark):
    rng = random.Random(6)
    texts = {d: "".join(rng.choice("abcdefgh ") for _ in range(900)) for d in range(6)}
    texts[5] = texts[2]
    rows = [*texts.items(), (2, texts[2]), (3, texts[3]), (3, texts[3]), (None, texts[3])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = dedup.remove_repeats(df).where("doc_id is not null").collect()
    want = brute(texts)
    assert want[2][1] == want[3][1] == 0 and want[5][1] == 900 and len(got) == 9
    for r in got:
        assert (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) == want[r.doc_id]


def test_texts_of_one_id(spark):
    """One of the texts is the document, the others stay and repeat nothing."""
    rng = random.Random(8)
    a, b, c = ("".join(rng.choice("abcdefgh ") for _ in range(400)) for _ in range(3))
    df = spark.createDataFrame([(1, a), (1, b), (1, a), (1, b), (2, a + c), (3, b + c), (4, None),
                                (4, "")], "doc_id long, text string")
    first = min((a, b), key=lambda t: spark.range(1).selectExpr(f"xxhash64('{t}')").first()[0])
    want = brute({1: first, 2: a + c, 3: b + c})
    got = {}
    for r in dedup.remove_repeats(df).collect():
        got.setdefault(r.doc_id, []).append((r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)))
    assert got.pop(4) == [(0, 0, 0, b"")] * 2
    assert sorted(got.pop(1)) == sorted([(400, 0, 0, t.encode()) for t in (a, a, b, b)])
    assert {k: v[0] for k, v in got.items()} == {k: want[k] for k in got}


def test_a_passage_of_very_many_altered_copies(spark):
    """One passage in 20,000 documents, each with another word before it: tasks send its strings
    a few times each, not once for each document."""
    passage = "".join(random.Random(9).choice("abcdefgh ") for _ in range(180))
    df = spark.range(20_000).selectExpr(
        "id as doc_id", f"concat(id * 7919 % 20011, ' ', '{passage}', ' ', id) as text")
    df = df.repartition(4)
    got = {r.doc_id: r.n_removed for r in dedup.remove_repeats(df).collect()}
    seen, want = set(), {}
    for r in sorted(df.collect()):
        data = r.text.encode()
        gone = set()
        for p in range(len(data) - dedup.LENGTH + 1):
            s = data[p:p + dedup.LENGTH]
            if s in seen:
                gone.update(range(p, p + dedup.LENGTH))
            seen.add(s)
        want[r.doc_id] = len(gone)
    assert got == want
