import random
import re

import pytest

import corpus_pipeline
from riskgraph.llm import decontaminate, secret_scan
from tests.llm.test_decontaminate import best
from tests.llm.test_near import brute, reach
from tests.llm.test_secret_scan import base, entropy


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(33)

    def words(n):
        return [rng.choice("bcdfgh") + rng.choice("aeiou") + str(rng.randrange(60))
                for _ in range(n)]

    items = [words(n) for n in (20, 30, 16)]
    docs, labels = [], []
    for i in range(500):
        text = words(rng.randrange(3, 80))
        toxic = int(i % 6 == 0)
        if toxic:
            text[1:1] = ["zorkish"] * 2
        if i % 11 == 3:
            text[2:2] = rng.choice(items)
        if i % 13 == 4:
            text.append("token = 'a1b2c3d4e5f6'")
        docs.append((i, " ".join(text), "en", f"src{i % 3}", len(" ".join(text))))
        labels.append((i, toxic, 1))
    for i in range(500, 560):  # copies and near copies
        text = docs[i - 490][1].split(" ")
        if i % 2:
            text[-1] = "changed"
        docs.append((i, " ".join(text), "en", "src9", len(" ".join(text))))
    docs += [(900, None, None, None, None), (901, "", "en", "s", 0), (902, "zorkish", "en", "s", 7),
             (docs[7][0], *docs[7][1:]), (None, "no id " * 9, "en", "s", 54)]
    path = tmp_path_factory.mktemp("tables")
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([(*d, "x", "y") for d in docs],
                          columns + ", score string, secrets string").write.parquet(
        f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int, quality int").write.parquet(
        f"{path}/labels.parquet")
    spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)],
                          "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path), docs, items


def test_stages_against_plain_python(spark, folder):
    path, rows, items = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns, seen = docs.columns, []
    for _, function in corpus_pipeline.STAGES[:-1]:
        docs = function(spark, docs, path).cache()
        assert docs.columns == columns
        seen.append(sorted(((r.doc_id, r.text) for r in docs.collect()), key=str))
    want = [(d[0], d[1]) for d in rows if "zorkish" not in (d[1] or "")]
    assert seen[0] == sorted(want, key=str)
    texts = {i: t for i, t in want if i is not None}
    root = reach(set(texts), brute(texts))
    want = {(i, t) for i, t in want if i is None or root[i] == i}
    assert seen[1] == sorted(want, key=str)

    def tokens(text):
        return re.findall(r"[^\W_]+", (text or "").lower())

    want = {(i, t) for i, t in want if i is None or not any(
        best(tokens(t), item, decontaminate.Rule()) for item in items)}
    assert seen[2] == sorted(want, key=str) and len(seen[2]) < len(seen[1])
    clean = []
    for i, text in want:
        hidden = set()
        for _, a, b in base(text) + entropy(text):
            hidden |= set(range(a, b))
        clean.append((i, "".join(
            c if k not in hidden else "[SECRET]" if k - 1 not in hidden else ""
            for k, c in enumerate(text)) if text else text))
    assert seen[3] == sorted(clean, key=str) and clean != list(want)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, path).collect()
    assert {r.doc_id for r in packed} == {i for i, _ in clean}
    assert all(r.start == 0 or r.start % 2048 == 0 for r in packed)
    ran = corpus_pipeline.run(spark, path).collect()
    key = ("doc_id", "start", "length", "ids_crc32", "doc_tokens")
    assert sorted(str([r[k] for k in key]) for r in ran) == sorted(
        str([r[k] for k in key]) for r in packed)


def test_empty_documents(spark, folder, tmp_path):
    path = folder[0]
    spark.read.parquet(f"{path}/documents.parquet").limit(0).write.parquet(
        f"{tmp_path}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{path}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    assert secret_scan.find_secrets(spark.read.parquet(f"{tmp_path}/documents.parquet")).count() == 0
