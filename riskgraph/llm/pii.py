"""Personal data: fixed patterns, and candidates that boosted trees decide on.

Fixed patterns give the base spans. Beside them, loose generators propose overlapping spans of the
same kinds (written-out addresses, numbers with other separators or without a plus), and boosted
trees score each by its format and what stands around it. The trees are trained on the corpus
itself: base spans and base spans rewritten into looser forms are right, spoiled ones (a wrong check
digit, a part above 255, too few digits) and all other candidates are wrong. Thresholds are set per
kind on documents that the trees have not seen, so that a given share of what they select is right.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, functions as F

from riskgraph.llm.memory import as_task
from riskgraph.llm.secret_scan import redact
from riskgraph.operators import evaluate
from riskgraph.operators.model import tree_nodes
from riskgraph.sources.staging import drop_path, new_path, stage, unstage

KINDS = ("email", "ip", "card", "phone")
#: Share of right spans among those above a threshold, on documents not trained on.
PRECISION = 0.98
#: Right candidates of both folds that training needs; with fewer only base spans are found.
LEAST_RIGHT = 40
TREES = {"maxIter": 12, "maxDepth": 4, "stepSize": 0.3, "minInstancesPerNode": 5, "seed": 11}
SEED = 17
HASHES = 1 << 32

# ------------------------------------------------------------------ base spans
# The base patterns. Each is written so that a search takes time in proportion to
# the text: a number is only tried at its first digit.
NAME_CHARS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
HOST = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# Digits with up to three separators between them: every number lies in one such region.
DIGITS = re.compile("[0-9]+")
REGION = re.compile(r"[0-9](?:[\x20().,:/\[\]-]{0,3}[0-9])*+")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = int(d) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(DIGITS.findall(text))


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Addresses; each @ is taken with what stands before and after it."""
    done, at = 0, text.find("@")
    while at >= 0:
        after = at + 1
        name = at - done - len(text[done:at].rstrip(NAME_CHARS))
        done = after
        if name and (host := HOST.match(text, after)):
            yield at - name, host.end()
            done = host.end()
        at = text.find("@", done)


def base_spans(text: str, regions: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """(start, rank, end) of the base kinds, by start, then kind."""
    out = [(a, 0, b) for a, b in _emails(text)]
    for first, end in regions:
        if end - first < 7:
            continue
        for m in IP.finditer(text, first, end):
            parts = m[0].split(".")
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in parts):
                out.append((m.start(), 1, m.end()))
        for m in CARD.finditer(text, first, end):
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(digits_of(m[0])) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


# ------------------------------------------------------------------ candidates
AT = re.compile(r"\s*[\[({<]\s*(?:at|@)\s*[\])}>]\s*|\s+(?:at|@)\s+|\s*@\s*", re.I)
LOOSE_HOST = re.compile(
    r"[A-Za-z0-9-]++(?:(?:\s?[\[({<]\s?(?:dot|\.)\s?[\])}>]\s?|\s(?:dot|\.)\s|\.)[A-Za-z0-9-]++)++",
    re.I)
AT_WORDS = ("@", "(at", "[at", "{at", "<at", " at ")
# Characters of a proposed address before the @, and groups of digits of a proposed number, at most.
NAME, GROUPS = 64, 6
CUES = tuple(re.compile(p, re.I) for p in (
    r"mail|contact|write to|schreib|correo|courriel", r"\bip\b|host|server|address|adresse",
    r"card|visa|credit|karte|tarjeta|carte|pay", r"phone|call|tel|fax|mobile|ruf|llam|appel"))
# What a candidate's features say, in their order.
FEATURES = (
    *(f"is_{k}" for k in KINDS), "length", "digits", "groups", "least_group", "most_group",
    "separators", "kinds_of_separators", "plus", "opens_with_zero", "check_digit", "most_part",
    "char_before", "char_after", "digits_before", "digits_after", "own_cue", "other_cue",
    "has_at_sign", "brackets", "labels", "last_label", "name_length", "name_is_lower")


def _char(text: str, at: int) -> float:
    """Kind of the character at a place: 0 none, 1 space, 2 letter, 3 digit, 4 other."""
    if not 0 <= at < len(text):
        return 0.0
    c = text[at]
    return 1.0 if c.isspace() else 2.0 if c.isalpha() else 3.0 if c.isdigit() else 4.0


def propose(text: str, regions: list[tuple[int, int]]) -> Iterator[tuple[int, int, int]]:
    """(start, rank, end) of loose candidates; they may overlap.

    Addresses need something like an @ between a name and a host with dots; numbers are up to
    ``GROUPS`` groups of digits of a region in a row, as every kind that their digits allow.
    """
    done = 0
    for at in sorted({m for w in AT_WORDS for m in _places(text, w)}):
        if at < done:
            continue
        m = AT.search(text, max(at - 2, done), at + 8)
        if not m or m.start() > at:
            continue
        before = text[max(done, m.start() - NAME):m.start()]
        name = len(before) - len(before.rstrip(NAME_CHARS))
        host = LOOSE_HOST.match(text, m.end()) if name else None
        if host:
            yield m.start() - name, 0, host.end()
            done = host.end()
    for first, end in regions:
        if end - first < 7:
            continue
        groups = [m.span() for m in DIGITS.finditer(text, first, end)]
        for k in range(len(groups)):
            digits = 0
            for j in range(k, min(k + GROUPS, len(groups))):
                digits += groups[j][1] - groups[j][0]
                if digits > 19:
                    break
                a, b = groups[k][0], groups[j][1]
                if 7 <= digits <= 15:
                    opened = a - (text[max(a - 1, 0):a] == "(")
                    yield opened - (text[max(opened - 1, 0):opened] == "+"), 3, b
                if 12 <= digits:
                    yield a, 2, b
                if j == k + 3 and all(y - x <= 3 for x, y in groups[k:j + 1]):
                    yield a, 1, b


def _places(text: str, word: str) -> Iterator[int]:
    at = text.find(word)
    while at >= 0:
        yield at
        at = text.find(word, at + 1)


def features(text: str, start: int, rank: int, end: int) -> list[float]:
    """Format and context of a candidate, in the order of ``FEATURES``."""
    own = text[start:end]
    groups = DIGITS.findall(own)
    sizes = [len(g) for g in groups] or [0]
    digits = "".join(groups)
    gaps = re.findall("[^0-9]+", own.strip("+()"))
    before, after = text[max(0, start - 40):start], text[end:end + 24]
    cues = [bool(c.search(before)) for c in CUES]
    out = [float(rank == k) for k in range(len(KINDS))]
    out += [len(own), len(digits), len(groups), min(sizes), max(sizes), len(gaps), len(set(gaps)),
            own.startswith(("+", "(+")), digits.startswith("0"),
            rank == 2 and luhn(digits), max((int(g[:4]) for g in groups), default=0),
            _char(text, start - 1), _char(text, end), sum(c.isdigit() for c in before[-24:]),
            sum(c.isdigit() for c in after), cues[rank], any(cues[:rank] + cues[rank + 1:])]
    if rank == 0:
        middle = AT.search(own)
        name = own[:middle.start()] if middle else ""
        labels = re.findall("[A-Za-z0-9-]+", LOOSE_HOST.search(own, middle.end())[0]) \
            if middle else []
        words = [x for x in labels if x.lower() != "dot"]
        out += ["@" in own, len(re.findall(r"[\[({<]", own)), len(words),
                len(words[-1]) if words else 0, len(name), name.islower()]
    else:
        out += [0, len(re.findall(r"[\[({<]", own)), 0, 0, 0, 0]
    return [float(x) for x in out]


def regions_of(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in REGION.finditer(text)]


# -------------------------------------------------------------------- training
def _rewritten(value: str, rank: int, turn: int) -> str:
    """A base span's value in a looser form that still says the same."""
    if rank == 0:
        name, host = value.rsplit("@", 1)
        at = (" at ", "(at)", " [at] ", " @ ", "{at}", " (at) ")[turn % 6]
        dot = (" dot ", ".", "[dot]", ".", " (dot) ")[turn % 5]
        return name + at + dot.join(host.split("."))
    if rank == 1:
        return ("[.]", " . ", "(.)", ",")[turn % 4].join(value.split("."))
    digits = digits_of(value)
    if rank == 2:
        gap = (".", "/", "  ", " - ", ":")[turn % 5]
        return gap.join(digits[k:k + 4] for k in range(0, len(digits), 4))
    gap = (" ", "-", ".", "/", "")[turn % 5]
    lead = ("", "00", "(", "0")[turn % 4]
    body = gap.join([digits[:2], digits[2:5], digits[5:8], digits[8:]][:4]).rstrip(gap or None)
    return lead + (body.replace(gap, ")", 1) if lead == "(" and gap else body.lstrip("("))


def _spoiled(value: str, rank: int, turn: int) -> str:
    """Something of a base span's look that is not what it was."""
    if rank == 0:
        name, host = value.rsplit("@", 1)
        return (f"{name} at {host.split('.')[0]}", f"{name} @{host.split('.')[0]}",
                f"{name}. At {host.split('.')[0]}.the")[turn % 3]
    if rank == 1:
        parts = value.split(".")
        parts[turn % 4] = str(300 + turn % 600)
        return (".".join(parts), ".".join(parts[:3]), ".".join(parts + parts[:2]))[turn % 3]
    digits = digits_of(value)
    if rank == 2:
        wrong = digits[:-1] + str((int(digits[-1]) + 1 + turn % 9) % 10)
        gap = (" ", "-", "", ".")[turn % 4]
        return gap.join(wrong[k:k + 4] for k in range(0, len(wrong), 4))
    return (digits[:6], f"{digits[:4]}-{digits[4:6]}-{digits[6:8]}", f"{digits}{digits}"[:18],
            f"{digits[:5]}.{digits[5:9]}")[turn % 4]


def examples(text: str, turn: int) -> list[tuple[int, int, list[float]]]:
    """(rank, right, features) of the candidates of a text, of the text with its base spans
    rewritten, and of the text with them spoiled."""
    regions = regions_of(text)
    base = base_spans(text, regions)
    right = set(base)
    out = [(s[1], int(s in right), features(text, *s)) for s in propose(text, regions)]
    for change, good in ((_rewritten, 1), (_spoiled, 0)):
        parts, at, changed = [], 0, []
        for k, (start, rank, end) in enumerate(base):
            if start < at:
                continue
            parts.append(text[at:start])
            first = sum(map(len, parts))
            parts.append(change(text[start:end], rank, turn + k))
            changed.append((first, rank, first + len(parts[-1])))
            at = end
        new = "".join([*parts, text[at:]])
        regions = regions_of(new) if changed else []
        still = set(base_spans(new, regions))
        place = 0
        for s in sorted(propose(new, regions)) if changed else ():
            while place < len(changed) and changed[place][2] <= s[0]:
                place += 1
            if place < len(changed) and changed[place][0] < s[2] and s not in still:
                out.append((s[1], int(good and s == changed[place]), features(new, *s)))
    return out


@dataclass
class PiiModel:
    """Boosted trees as arrays, and the least score of each kind; no trees find base spans only.

    ``nodes[t]`` holds feature, threshold, left, right and value of the nodes of tree t; a leaf
    leads to itself.
    """

    nodes: list[tuple[np.ndarray, ...]]
    weights: list[float]
    thresholds: tuple[float, ...] = (2.0,) * len(KINDS)
    depth: int = TREES["maxDepth"]

    def scores(self, rows: np.ndarray) -> np.ndarray:
        margin = np.zeros(len(rows))
        each = np.arange(len(rows))
        for (feature, threshold, left, right, value), weight in zip(self.nodes, self.weights):
            at = np.zeros(len(rows), np.int64)
            for _ in range(self.depth):
                at = np.where(rows[each, feature[at]] <= threshold[at], left[at], right[at])
            margin += weight * value[at]
        return 1 / (1 + np.exp(-2 * margin))


def _trees(fitted) -> PiiModel:
    """The fitted model's node table as arrays: a fixed number of trees of bounded depth."""
    spark = SparkSession.active()
    path = new_path(spark, "pii-trees")
    rows = tree_nodes(fitted, path).toPandas()
    drop_path(spark, path)
    nodes = []
    for _, tree in rows.sort_values(["tree", "node"]).groupby("tree"):
        own, leaf = tree["node"].to_numpy(), tree["left"].to_numpy() < 0
        nodes.append(tuple(np.where(leaf, instead, tree[name].to_numpy()) for name, instead in (
            ("feature", 0), ("threshold", 0.0), ("left", own), ("right", own)))
            + (tree["value"].to_numpy(),))
    return PiiModel(nodes, list(fitted.treeWeights))


def calibrated(scores: np.ndarray, right: np.ndarray, precision: float) -> float:
    """Least score from which at least ``precision`` of the candidates are right; 2 if none is."""
    order = np.argsort(-scores, kind="stable")
    s, hits = scores[order], np.cumsum(right[order])
    share = hits / np.arange(1, len(s) + 1)
    last = np.append(s[1:] != s[:-1], True)  # equal scores are selected together
    fit = np.flatnonzero(last & (share >= precision)) if len(s) else []
    return float(s[fit[-1]]) if len(fit) else 2.0


def least_scores(scored: DataFrame, precision: float) -> tuple[float, ...]:
    """``calibrated`` of each kind for rows of (rank, label, score), none of which is gathered."""
    out = []
    for rank in range(len(KINDS)):
        cum = evaluate.cumulative(evaluate.score_counts(scored.where(F.col("rank") == rank)))
        share = F.col("tp") / (F.col("tp") + F.col("fp"))
        least = cum.where(share >= precision).agg(F.min("score")).first()[0]
        out.append(2.0 if least is None else least)
    return tuple(out)


def fit_pii(docs: DataFrame, precision: float = PRECISION) -> PiiModel:
    """Trees and thresholds from all of ``docs`` (doc_id, text).

    A hash of the doc_id keeps a quarter of them for the thresholds. Null texts are empty. With too
    few right candidates, as in an empty table, only base spans will be found.
    """
    key = F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(HASHES))
    keyed = docs.select(F.coalesce("text", F.lit("")).alias("text"), key.alias("key"))

    @as_task
    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [(key % 4 == 0, *example) for key, text in zip(batch["key"], batch["text"])
                   for example in examples(text, int(key) >> 2)]
            if out:
                yield pd.DataFrame(out, columns=["kept_back", "rank", "right", "features"])

    data = stage(keyed.mapInPandas(
        make, "kept_back boolean, rank int, right int, features array<double>"), "pii-examples")
    counts = {(r.kept_back, r.right): r["count"]
              for r in data.groupBy("kept_back", "right").count().collect()}
    if min(counts.get((k, r), 0) for k in (False, True) for r in (0, 1)) < LEAST_RIGHT // 4:
        unstage(data)
        return PiiModel([], [])
    learn = data.where("not kept_back").select(
        F.col("right").cast("double").alias("label"), array_to_vector("features").alias("features"))
    model = _trees(GBTClassifier(**TREES).fit(learn))

    @as_task
    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield pd.DataFrame({"rank": batch["rank"], "label": batch["right"],
                                    "score": model.scores(np.array(batch["features"].tolist()))})

    scored = stage(data.where("kept_back").mapInPandas(
        score, "rank int, label int, score double"), "pii-scores")
    unstage(data)
    model.thresholds = least_scores(scored, precision)
    unstage(scored)
    return model


# -------------------------------------------------------------------- scanning
SPANS = "array<struct<start:int,rank:int,end:int,score:double>>"


class _Covered:
    """Stretches of a text that spans cover, in order."""

    def __init__(self, spans: list[tuple[int, int, int]]) -> None:
        self.starts: list[int] = []
        self.ends: list[int] = []
        for start, _, end in spans:
            if self.ends and start < self.ends[-1]:
                self.ends[-1] = max(end, self.ends[-1])
            else:
                self.starts.append(start)
                self.ends.append(end)

    def free(self, start: int, end: int) -> bool:
        at = bisect_left(self.starts, end)
        return at == 0 or self.ends[at - 1] <= start

    def add(self, start: int, end: int) -> None:
        at = bisect_right(self.starts, start)
        self.starts.insert(at, start)
        self.ends.insert(at, end)


def _chosen(spans: list[tuple], covered: _Covered) -> list[tuple]:
    """Of candidates (score, start, rank, end) those of the highest scores that overlap nothing
    covered and none chosen before; ties go to the longer, then the earlier one."""
    out = []
    for score, start, rank, end in sorted(spans, key=lambda s: (-s[0], s[1] - s[3], s[1], s[2])):
        if covered.free(start, end):
            covered.add(start, end)
            out.append((start, len(KINDS) + rank, end, score))
    return out


def find_pii(docs: DataFrame, model: PiiModel, column: str = "pii") -> DataFrame:
    """``docs`` with ``column``: array of (start, rank, end, kind, score) by start, then kind.

    Base spans have the score 1 and are always reported; spans that the trees add are of the kinds
    ``model_...``, overlap no base span and not each other. Places are code points, end exclusive.
    A null or empty text has an empty array. All columns are kept; one named ``column`` is replaced.
    Repeated rows are scanned each on its own.
    """
    @F.pandas_udf(SPANS)
    @as_task
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            out: list[list[tuple]] = []
            rows: list[list[float]] = []
            proposed: list[tuple[int, int, int, int]] = []
            covered: dict[int, _Covered] = {}
            for k, text in enumerate(texts):
                text = text or ""
                regions = regions_of(text)
                base = base_spans(text, regions)
                out.append([(*s, 1.0) for s in base])
                if not model.nodes:
                    continue
                covered[k] = _Covered(base)
                for s in propose(text, regions):
                    if model.thresholds[s[1]] <= 1 and covered[k].free(s[0], s[2]):
                        rows.append(features(text, *s))
                        proposed.append((k, *s))
            found: dict[int, list[tuple]] = {}
            for (k, start, rank, end), score in zip(
                    proposed, model.scores(np.array(rows)).tolist() if rows else ()):
                if score >= model.thresholds[rank]:
                    found.setdefault(k, []).append((score, start, rank, end))
            for k, spans in found.items():
                out[k] = sorted(out[k] + _chosen(spans, covered[k]))
            yield pd.Series([[dict(zip(("start", "rank", "end", "score"), s)) for s in spans]
                             for spans in out], dtype=object)

    names = F.array(*[F.lit(k) for k in KINDS + tuple(f"model_{k}" for k in KINDS)])
    spans = F.transform(scan("text"), lambda s: F.struct(
        s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"),
        F.get(names, s["rank"]).alias("kind"), s["score"].alias("score")))
    return docs.withColumn(column, spans)


def redact_pii(docs: DataFrame, mark: str = "[PII]", column: str = "pii") -> DataFrame:
    """``docs`` without ``column`` and with every span of it replaced by ``mark`` in the text."""
    return redact(docs, mark, column)
