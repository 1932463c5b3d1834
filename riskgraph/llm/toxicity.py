"""Toxicity classifier whose scores change little when one group's name replaces another's.

Logistic regression over the presence of words and word beginnings. Features are chosen by their
association with the label; the fit adds, for labelled texts that name a group, a penalty on the
squared change of the score when the group's name is swapped for another of its kind.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from riskgraph.llm.memory import as_task
from riskgraph.sources.staging import stage, unstage

#: Labelled rows the model is fitted on, at most; taken in order of a hash of their doc_id.
FIT_ROWS = 20_000
#: Features of the model, at most: the strongest. They bound the model that travels with a task.
FEATURES = 2_000
#: Documents of the fit that must hold a feature, and its least association (z of the log odds);
#: weaker ones are chance among the hundreds of thousands of features that are tried.
LEAST_DOCS, LEAST_Z = 5, 4.0
PREFIXES = (4, 5, 6)
THRESHOLD = 0.7
WORD = re.compile(r"\w+")
# Words whose features a worker remembers.
CACHE_WORDS = 100_000
# Features that a task counts before it hands the counts on.
COUNTED_FEATURES = 100_000
# Values of the hash that the sample is cut from.
HASHES = 1 << 32

# Names of groups, each line of one kind within one language.
IDENTITY_TERMS = tuple(tuple(line.split()) for line in """
women men girls boys
woman man girl boy
christian muslim jewish hindu buddhist atheist
christians muslims jews hindus buddhists atheists
black white asian african european latino arab
gay straight lesbian bisexual trans queer
immigrant refugee foreigner native
immigrants refugees foreigners natives
deaf blind disabled elderly
frauen männer mädchen jungen
christen muslime juden hindus
ausländer flüchtlinge einwanderer
mujeres hombres niñas niños
cristianos musulmanes judíos
extranjeros refugiados inmigrantes
femmes hommes filles garçons
chrétiens musulmans juifs
étrangers réfugiés immigrés
""".strip().splitlines())


def words(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def features_of(word: str) -> list[str]:
    """The word itself and its beginnings; a beginning ends in a star."""
    return [word, *(word[:n] + "*" for n in PREFIXES if len(word) >= n)]


def swaps(found: list[str], groups: tuple[tuple[str, ...], ...]) -> list[list[str]]:
    """``found`` with the names of groups swapped, once for each step along their kind."""
    place = {term: (group, k) for group in groups for k, term in enumerate(group)}
    named = [place[w] for w in found if w in place]
    steps = max((len(group) for group, _ in named), default=1) - 1
    return [[place[w][0][(place[w][1] + step) % len(place[w][0])] if w in place else w
             for w in found] for step in range(1, steps + 1)]


@dataclass
class ToxicityModel:
    """Bias and one weight per feature; small enough to travel with a task."""

    bias: float
    weights: dict[str, float] = field(default_factory=dict)

    def scorer(self):
        """Score of one text. Weights of words are remembered while few enough."""
        known: dict[str, dict[str, float]] = {}
        nothing: dict[str, float] = {}

        def weights_of(word: str) -> dict[str, float]:
            if len(known) > CACHE_WORDS:
                known.clear()
            found = {f: self.weights[f] for f in features_of(word) if f in self.weights}
            known[word] = found or nothing
            return known[word]

        def score(text: str | None) -> float:
            present: dict[str, float] = {}
            for word in set(words(text)):
                own = known.get(word)
                if own is None:
                    own = weights_of(word)
                if own:
                    present.update(own)
            logit = self.bias + math.fsum(present.values())
            return 1 / (1 + math.exp(-max(-30.0, min(30.0, logit))))

        return score

    def score(self, text: str | Column) -> Column:
        @F.pandas_udf("double")
        @as_task
        def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            score = self.scorer()
            for texts in batches:
                yield pd.Series([score(t) for t in texts], dtype="float64")

        return scores(F.col(text) if isinstance(text, str) else text)


def may_learn(doc_id: str = "doc_id") -> Column:
    """True for documents whose labels may be learned; the others are held out."""
    fold = F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3
    return F.coalesce(fold != 1, F.lit(False))


def _sample(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """At most ``rows`` learnable labelled texts (toxic, text), those of the least hashes.

    A range of the hash that holds about twice as many and a thousand is cut out first, so that one
    task does not merge ``rows`` of every partition. Only the bounded sample of ids is broadcast; no text is
    shuffled. The sample is staged, as two passes read it.
    """
    ids = labels.where(may_learn() & F.col("toxic").isin(0, 1)).select("doc_id", "toxic")
    total = ids.count()
    cut = 2 * rows + 1000
    if total > 2 * cut:
        ids = ids.where(F.pmod(F.xxhash64("doc_id"), F.lit(HASHES)) < HASHES * cut // total)
        order = [F.pmod(F.xxhash64("doc_id"), F.lit(HASHES))]
    else:
        order = []
    ids = ids.orderBy(*order, F.xxhash64("doc_id"), "doc_id", "toxic").limit(rows)
    return stage(docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
                 .select("toxic", "text"), "toxicity-sample")


def _choose_features(sample: DataFrame, limit: int) -> list[str]:
    """Features associated with the label, the strongest first; at most ``limit``."""
    @as_task
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        docs: tuple[Counter, Counter] = Counter(), Counter()
        for batch in batches:
            for toxic, text in zip(batch["toxic"], batch["text"]):
                docs[toxic].update({"", *(f for w in set(words(text)) for f in features_of(w))})
                if len(docs[0]) + len(docs[1]) > COUNTED_FEATURES:
                    yield counted(docs)
        if docs[0] or docs[1]:  # a task may see no row, or have handed on all it counted
            yield counted(docs)

    def counted(docs: tuple[Counter, Counter]) -> pd.DataFrame:
        keys = list(docs[0].keys() | docs[1].keys())
        out = pd.DataFrame({"feature": keys, "clean": [docs[0][k] for k in keys],
                            "toxic": [docs[1][k] for k in keys]})
        for counter in docs:
            counter.clear()
        return out

    counts = stage(
        sample.mapInPandas(count, "feature string, clean long, toxic long").groupBy("feature")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .where((F.col("feature") == "") | (F.col("clean") + F.col("toxic") >= LEAST_DOCS)),
        "toxicity-counts")
    total = counts.where("feature = ''").first()
    names: list[str] = []
    if total:
        a, b = F.col("toxic") + 0.5, total["toxic"] - F.col("toxic") + F.lit(0.5)
        c, d = F.col("clean") + 0.5, total["clean"] - F.col("clean") + F.lit(0.5)
        z = F.abs(F.log(a * d / (b * c)) / F.sqrt(1 / a + 1 / b + 1 / c + 1 / d))
        strong = (counts.where("feature <> ''").withColumn("z", z).where(F.col("z") >= LEAST_Z)
                  .orderBy(F.desc("z"), "feature").limit(limit))
        names = [r.feature for r in strong.collect()]
    unstage(counts)
    return names


def _encoded(sample: DataFrame, names: list[str],
             groups: tuple[tuple[str, ...], ...]) -> pd.DataFrame:
    """(toxic, own, gone, come): numbers of a text's chosen features, and for each swap of its
    group names that changes them the features that go and those that come."""
    place = {name: k for k, name in enumerate(names)}

    def present(found: list[str]) -> set[int]:
        return {place[f] for w in set(found) for f in features_of(w) if f in place}

    @as_task
    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for toxic, text in zip(batch["toxic"], batch["text"]):
                found = words(text)
                own = present(found)
                others = [other for other in map(present, swaps(found, groups)) if other != own]
                rows.append((toxic, sorted(own), [sorted(own - other) for other in others],
                             [sorted(other - own) for other in others]))
            if rows:
                yield pd.DataFrame(rows, columns=["toxic", "own", "gone", "come"])

    return sample.mapInPandas(encode, "toxic double, own array<int>, gone array<array<int>>, "
                                      "come array<array<int>>").toPandas()


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Objective:
    """Mean log loss, plus ``fairness`` times the mean squared change of the score under swapped
    group names, plus a ridge; weights come first, the bias last."""

    def __init__(self, rows: pd.DataFrame, columns: int, fairness: float, ridge: float) -> None:
        self.y = rows["toxic"].to_numpy(float)
        self.own = _Rows(rows["own"], columns)
        self.pairs = np.repeat(np.arange(len(rows)), [len(g) for g in rows["gone"]])
        self.gone = _Rows([s for g in rows["gone"] for s in g], columns)
        self.come = _Rows([s for g in rows["come"] for s in g], columns)
        self.fairness, self.ridge = fairness, ridge

    def _scores(self, w: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        logit = self.own.dot(w[:-1]) + w[-1]
        moved = logit[self.pairs] - self.gone.dot(w[:-1]) + self.come.dot(w[:-1])
        scores = _sigmoid(logit)
        return scores, scores[self.pairs], _sigmoid(moved)

    def loss(self, w: np.ndarray) -> float:
        scores, before, after = self._scores(w)
        out = -(self.y * np.log(scores) + (1 - self.y) * np.log(1 - scores)).mean()
        out += self.ridge / 2 * (w[:-1] ** 2).sum()
        if len(self.pairs):
            out += self.fairness * ((before - after) ** 2).mean()
        return float(out)

    def gradient(self, w: np.ndarray) -> np.ndarray:
        scores, before, after = self._scores(w)
        error = (scores - self.y) / len(self.y)
        out = np.append(self.ridge * w[:-1], 0.0)
        if len(self.pairs):
            change = 2 * self.fairness * (before - after) / len(self.pairs)
            first, second = change * before * (1 - before), change * after * (1 - after)
            error += np.bincount(self.pairs, first - second, len(self.y))
            out[:-1] += self.gone.back(second) - self.come.back(second)
        out[:-1] += self.own.back(error)
        out[-1] += error.sum()
        return out


def _fit(sample: DataFrame, names: list[str], groups: tuple[tuple[str, ...], ...],
         fairness: float, ridge: float) -> ToxicityModel:
    """Fit on the bounded sample; only numbers of chosen features reach the driver."""
    rows = _encoded(sample, names, groups)
    toxic = rows["toxic"].sum()
    bias = math.log((toxic + 1) / (len(rows) - toxic + 1))
    if not names:
        return ToxicityModel(bias)
    goal = Objective(rows, len(names), fairness, ridge)
    w = np.zeros(len(names) + 1)
    w[-1] = bias
    mean, square = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, 601):  # Adam on the whole sample, with a falling rate
        g = goal.gradient(w)
        mean, square = 0.9 * mean + 0.1 * g, 0.999 * square + 0.001 * g * g
        rate = 0.1 * (1 - step / 700)
        w -= rate * (mean / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.999 ** step)) + 1e-8)
    return ToxicityModel(float(w[-1]), dict(zip(names, map(float, w[:-1]))))


class _Rows:
    """Rows of a 0/1 matrix, as lists of their columns."""

    def __init__(self, lists: Sequence, columns: int) -> None:
        sizes = [len(a) for a in lists]
        self.rows = np.repeat(np.arange(len(sizes)), sizes)
        self.columns = np.concatenate([np.asarray(a, np.int64) for a in lists] or
                                      [np.empty(0, np.int64)])
        self.shape = len(sizes), columns

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.rows, w[self.columns], self.shape[0])

    def back(self, v: np.ndarray) -> np.ndarray:
        return np.bincount(self.columns, v[self.rows], self.shape[1])


def fit_toxicity(docs: DataFrame, labels: DataFrame,
                 groups: tuple[tuple[str, ...], ...] = IDENTITY_TERMS, fairness: float = 3.0,
                 ridge: float = 1e-5, rows: int = FIT_ROWS, features: int = FEATURES,
                 ) -> ToxicityModel:
    """Model from the learnable rows of ``labels`` (doc_id, toxic) and their texts.

    Rows with a null label or id are passed over, null texts are empty, and repeated labels count
    as often as they come. Without labels every text gets 0.5; without associated features every
    text gets the share of toxic rows.
    """
    sample = _sample(docs, labels, rows)
    model = _fit(sample, _choose_features(sample, features), groups, fairness, ridge)
    unstage(sample)
    return model


def score_documents(docs: DataFrame, model: ToxicityModel,
                    threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on).

    Whole texts are scored where they are read. Columns of these names are replaced.
    """
    return docs.withColumn("score", model.score("text")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int"))


def drop_toxic(docs: DataFrame, model: ToxicityModel,
               threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the documents that the model calls toxic."""
    return docs.where(model.score("text") < threshold)
