import hashlib
import random
import re
import time

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from riskgraph.llm import pii, queries

# The base patterns as they are given.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def holds(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        double = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits))]
        return 12 <= len(digits) <= 19 and sum(x // 10 + x % 10 for x in double) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def plain(text):
    out = [(m.start(), rank, m.end()) for rank, (kind, p) in enumerate(PATTERNS.items())
           for m in re.finditer(p, text or "") if holds(kind, m[0])]
    return sorted(out)


def random_texts(n, seed=0):
    rng = random.Random(seed)
    parts = ["a.b+c%d@x-y.co.uk", "@", "x@y", "@a.b", "q@w.e_r@t.y", "u@v.w.", "1.2.3.4",
             "256.1.1.1", "1.2.3.4.5.6.7.8.9", "010.20.30.040", "4111 1111 1111 1111",
             "4111-1111-1111-1112", "5500005555555559", "+49 (30) 123-4567", "+1", "+", "++12345678901",
             "+12 34.56-78 (90) ", "0", "12", " ", "-", ".", "x", "é", "(", "\n", "  ", "😀", "0000000000000",
             "+1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6", "123456789012345678901234567890"]
    return ["".join(rng.choice(parts) + rng.choice(["", " ", "", ",", "-"])
                    for _ in range(rng.randrange(1, 14))) for _ in range(n)]


def corpus(n, seed=1):
    rng = random.Random(seed)
    words = "the order of a number was sent and then at home version list total page in".split()
    rows = []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randrange(10, 60))]
        for _ in range(rng.randrange(4)):
            digits = "".join(rng.choice("0123456789") for _ in range(15))
            card = next(digits + d for d in "0123456789" if pii.luhn(digits + d))
            text.insert(rng.randrange(len(text)), rng.choice([
                f"mail me.{i}@host{i % 9}.example.com", f"call +49 {digits[:3]} {digits[3:9]}",
                f"card {card[:4]} {card[4:8]} {card[8:12]} {card[12:]}",
                f"host {rng.randrange(256)}.{rng.randrange(256)}.{rng.randrange(256)}.7",
                f"item {digits[:8]}", f"build 1.{i}.3", f"page {i}, {i + 1}, {i + 2}", digits]))
        rows.append((i, " ".join(text) + "."))
    return rows


@pytest.fixture(scope="module")
def fitted(spark):
    docs = spark.createDataFrame(corpus(1200), "doc_id long, text string")
    return docs, pii.fit_pii(docs)


def test_base_spans_are_the_patterns():
    for text in random_texts(4000) + ["", "a@b.c" * 50, "1." * 999, "@" * 99]:
        assert pii.base_spans(text, pii.regions_of(text)) == plain(text), text


def test_long_texts_take_time_in_proportion(fitted, spark):
    _, model = fitted
    start = time.time()
    for text in ("7" * 400_000, "1." * 200_000, "a" * 400_000 + "@", "@a" * 200_000,
                 "a at " * 80_000, "12 " * 130_000, "+1 " * 130_000, "a@b.co " * 50_000):
        docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
        pii.find_pii(docs, model).collect()
    assert time.time() - start < 90


def test_rewritten_data_is_found_and_plain_numbers_are_left_alone(fitted, spark):
    """Documents that training has not seen, with every base span in a looser form."""
    _, model = fitted
    assert model.nodes and min(model.thresholds) <= 1
    rows, wanted, clean = [], {}, []
    for i, text in corpus(400, seed=9):
        spans = plain(text)
        if not spans:
            clean.append(i)
            rows.append((i, text))
            continue
        start, rank, end = spans[0]
        if any(s[0] < end and s != spans[0] for s in spans):
            continue
        value = pii._rewritten(text[start:end], rank, i)
        rows.append((i, text[:start] + value + text[end:]))
        wanted[i] = start, rank, start + len(value)
    found = {r.doc_id: r.pii for r in pii.find_pii(
        spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    hits = [any((s.start, s.end) == (a, b) for s in found[i])
            for i, (a, rank, b) in wanted.items()]
    assert np.mean(hits) > 0.6
    assert np.mean([bool(found[i]) for i in clean]) < 0.05
    for i, text in rows:
        base = [(s.start, s.rank, s.end) for s in found[i] if s.rank < 4]
        assert base == plain(text) and all(s.score == 1 for s in found[i] if s.rank < 4)
        ends = 0
        for s in found[i]:
            if s.rank >= 4:
                assert s.kind == "model_" + pii.KINDS[s.rank - 4] and s.start >= ends
                ends = s.end
                assert all(s.end <= a or s.start >= b for a, _, b in base)


def test_scores_are_those_of_the_library(spark):
    rows = spark.createDataFrame(corpus(150, seed=3), "doc_id long, text string").collect()
    data = spark.createDataFrame([(float(right), x) for r in rows for _, right, x
                                  in pii.examples(r.text, r.doc_id)],
                                 "label double, x array<double>")
    data = data.select("label", "x", array_to_vector("x").alias("features"))
    model = GBTClassifier(**pii.TREES).fit(data)
    out = model.transform(data).select("x", vector_to_array("probability").alias("p")).toPandas()
    ours = pii._trees(model).scores(np.array(out["x"].tolist()))
    assert np.allclose(ours, [p[1] for p in out["p"]])
    assert len(data.first().x) == len(pii.FEATURES)


def test_thresholds():
    scores = np.array([0.9, 0.8, 0.8, 0.7, 0.6, 0.1])
    right = np.array([1, 1, 1, 0, 1, 0])
    assert pii.calibrated(scores, right, 0.99) == 0.8
    assert pii.calibrated(scores, right, 0.8) == 0.6
    assert pii.calibrated(scores, np.zeros(6), 0.5) == 2.0
    assert pii.calibrated(np.array([]), np.array([]), 0.5) == 2.0


def test_thresholds_of_rows(spark):
    rng = np.random.default_rng(4)
    rank, score = rng.integers(0, 3, 600), np.round(rng.random(600), 2)
    right = (rng.random(600) < score).astype(int)
    rows = spark.createDataFrame(zip(rank.tolist(), right.tolist(), score.tolist()),
                                 "rank int, label int, score double")
    assert pii.least_scores(rows, 0.9) == tuple(
        pii.calibrated(score[rank == k], right[rank == k], 0.9) for k in range(4))


def test_every_document_is_learned_from(spark, monkeypatch):
    """More documents than the former sample of 4,000 had: the trees see the candidates of all."""
    seen = []

    class Seen(Exception):
        pass

    def fit(self, data):
        seen.append(data.count())
        raise Seen

    monkeypatch.setattr(pii.GBTClassifier, "fit", fit)
    docs = spark.range(6_000).selectExpr(
        "id as doc_id", "concat('mail me', id, '@x.org or call +49 170 ', 1000000 + id) as text")
    with pytest.raises(Seen):
        pii.fit_pii(docs)
    key = F.pmod(F.xxhash64("doc_id", F.lit(pii.SEED)), F.lit(pii.HASHES))
    wanted = sum(len(pii.examples(r.text, r.key >> 2)) for r in docs.select(
        "text", key.alias("key")).collect() if r.key % 4)
    assert seen == [wanted]


def test_query_on_a_table(spark, tmp_path):
    texts = random_texts(300, seed=5) + [t for _, t in corpus(300, seed=6)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(7000, None), (7001, ""), (3, texts[3]),
                                                    (None, "a@b.cd")]
    spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, pii string"
                          ).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.QUERIES["op11_pii"](spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    texts = dict(rows)
    for r in got:
        spans = plain(texts[r.doc_id])
        joined = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in spans)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(
            sum(s[1] == k for s in spans) for k in range(4))
        assert [s for s in r.spans.split(",") if s and not s.startswith("model_")] == (
            joined.split(",") if joined else [])


def test_empty_table_and_redaction(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    model = pii.fit_pii(none)
    assert model.nodes == [] and pii.find_pii(none, model).count() == 0
    docs = spark.createDataFrame([(1, "é me@x.org, 1.2.3.4"), (2, None)],
                                 "doc_id long, text string")
    clean = pii.redact_pii(pii.find_pii(docs, model)).orderBy("doc_id").collect()
    assert [r.text for r in clean] == ["é [PII], [PII]", None] and clean[0].asDict().keys() == {
        "doc_id", "text"}
