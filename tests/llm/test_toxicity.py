import math
import random

import numpy as np
import pandas as pd
import pytest

from riskgraph.llm import toxicity as tox


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(6)
    plain = [a + b for a in ("ba", "ko", "li", "mu", "ne") for b in ("ra", "so", "ti", "vu", "wo")]
    rows, labels = [], []
    for i in range(1500):
        words = [rng.choice(plain) for _ in range(rng.randrange(5, 200))]
        toxic = int(rng.random() < 0.2)
        if toxic:
            for _ in range(rng.randrange(1, 4)):
                words[rng.randrange(len(words))] = rng.choice(
                    ["grobulus", "zorkish", "zorkanda", "zorkelot" + str(i)])
        # Toxic texts name one group more often: a model without the penalty learns the name.
        group = "women" if rng.random() < (0.9 if toxic else 0.25) else "men"
        words.insert(rng.randrange(len(words)), group)
        rows.append((i, " ".join(words).title(), 0.5, "x"))
        labels.append((i, toxic, 1))
    rows += [(5000, None, 0.5, "x"), (5001, "", 0.5, "x"), (None, "zorkish", 0.5, "x")]
    labels += [(5000, None, 1), (None, 1, 1), (3, labels[3][1], 1), (9999, 1, 1)]
    return (spark.createDataFrame(rows, "doc_id long, text string, score double, feature string"),
            spark.createDataFrame(labels, "doc_id long, toxic int, quality int"))


def test_held_out_labels_are_predicted(corpus):
    docs, labels = corpus
    model = tox.fit_toxicity(docs, labels)
    rows = (tox.score_documents(docs, model).join(labels.where("doc_id < 1500").distinct(),
                                                  "doc_id")
            .where(~tox.may_learn()).select("toxic", "predicted", "score").collect())
    assert 300 < len(rows) < 700
    assert sum(r.toxic == r.predicted for r in rows) >= 0.98 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_swapped_groups_change_the_score_little(spark):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(900):  # half of the toxic texts have no sign but the group they name
        toxic = int(rng.random() < 0.4)
        group = "women" if rng.random() < (0.9 if toxic else 0.3) else "men"
        sign = "zorkish" if toxic and rng.random() < 0.5 else "soti"
        rows.append((i, f"bara {group} {sign} kovu"))
        labels.append((i, toxic))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame(labels, "doc_id long, toxic int")
    gaps = []
    for fairness in (0.0, 30.0):
        score = tox.fit_toxicity(docs, labels, fairness=fairness).scorer()
        gaps.append(abs(score("bara women soti kovu") - score("bara men soti kovu")))
        assert score("bara men zorkish kovu") > 0.9
    assert gaps[0] > 0.3 and gaps[1] < 0.1


def test_swaps():
    groups = (("women", "men", "girls"), ("x", "y"))
    assert tox.swaps(["a", "men", "x"], groups) == [["a", "girls", "y"], ["a", "women", "x"]]
    assert tox.swaps(["a"], groups) == []
    assert tox.features_of("abcde") == ["abcde", "abcd*", "abcde*"]


def test_odd_rows(spark, corpus):
    docs, labels = corpus
    model = tox.fit_toxicity(docs, labels)
    rows = {r.doc_id: r for r in tox.score_documents(docs, model).collect()}
    assert rows[5000].score == rows[5001].score < 0.7 and rows[None].predicted == 1
    assert len(rows) == docs.count()
    none = tox.fit_toxicity(docs, labels.limit(0))
    assert {r.score for r in tox.score_documents(docs, none).collect()} == {0.5}
    one = tox.fit_toxicity(docs, labels.where("toxic = 0"))
    assert all(r.score < 0.01 for r in tox.score_documents(docs, one).collect())
    assert tox.score_documents(docs.limit(0), model).count() == 0
    assert tox.fit_toxicity(docs.limit(0), labels).weights == {}
    kept = tox.drop_toxic(docs, model)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r.predicted == 0 for r in rows.values())


def test_fold(spark):
    import zlib
    df = spark.range(50).withColumnRenamed("id", "doc_id").select(
        "doc_id", tox.may_learn().alias("learn"))
    assert all(r.learn == (zlib.crc32(str(r.doc_id).encode()) % 3 != 1) for r in df.collect())
    assert not spark.sql("select cast(null as long) as doc_id").select(tox.may_learn()).first()[0]


def test_a_text_is_scored_by_its_distinct_features():
    model = tox.ToxicityModel(-1.0, {"abcdef": 2.0, "abcd*": 0.5, "xy": -3.0, "zz*": 9.0})
    for text, logit in (("Abcdef abcdef", 1.5), ("abcdx, XY!", -3.5), ("", -1.0), (None, -1.0)):
        assert model.scorer()(text) == pytest.approx(1 / (1 + math.exp(-logit)))


def test_the_gradient_is_that_of_the_loss():
    rng = np.random.default_rng(3)
    rows = pd.DataFrame({
        "toxic": [1.0, 0.0, 1.0, 0.0], "own": [[0, 2], [1, 2, 4], [], [3]],
        "gone": [[[0], [2]], [[1, 4]], [], []], "come": [[[1], [3, 4]], [[0]], [], []]})
    goal = tox.Objective(rows, 5, fairness=3.0, ridge=0.1)
    w = rng.standard_normal(6)
    step = 1e-6
    numeric = [(goal.loss(w + step * e) - goal.loss(w - step * e)) / (2 * step)
               for e in np.eye(6)]
    assert np.allclose(goal.gradient(w), numeric, atol=1e-7)
    alone = tox.Objective(rows.iloc[2:], 5, fairness=3.0, ridge=0.0)
    assert alone.loss(np.zeros(6)) == pytest.approx(math.log(2))


def test_tasks_that_see_no_label(spark, tmp_path, monkeypatch):
    """Two files of documents, labels for the first only; and counts handed on at a task's end."""
    path = str(tmp_path / "docs")
    first = [(i, "zorkish soti" if i % 2 else "bara soti") for i in range(400)]
    second = [(i, "bara zorkish") for i in range(1000, 1040)]
    for part in (first, second):
        spark.createDataFrame(part, "doc_id long, text string").coalesce(1).write.mode(
            "append").parquet(path)
    docs = spark.read.parquet(path)
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id long, toxic int")
    want = tox.fit_toxicity(docs, labels)
    assert want.scorer()("zorkish") > 0.7 > want.scorer()("bara")
    # Every text is one more feature than the bound, so each is handed on by itself.
    monkeypatch.setattr(tox, "COUNTED_FEATURES", 2)
    again = tox.fit_toxicity(docs, labels)
    assert again.weights == pytest.approx(want.weights) and again.bias == pytest.approx(want.bias)
    assert tox._sample(docs, labels, 5).count() == 5
