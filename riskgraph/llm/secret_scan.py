"""Secret scan: fixed patterns, and sliding-window Shannon entropy per character class.

Everything is a column expression; a document is scanned where it is read and nothing is shuffled.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

# The base kinds in their listed order, with pattern, group whose length counts,
# and least length of that group. A run of hex digits is one match, so its least length can
# stand in the pattern; the same holds for access keys.
BASE_KINDS = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
               r"""([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]{16,}", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
)


@dataclass(frozen=True)
class CharacterClass:
    """Runs of ``alphabet`` are candidates where ``window`` characters hold ``bits`` of entropy."""

    kind: str
    pattern: str
    alphabet: str
    window: int
    bits: float


LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
CLASSES = (
    CharacterClass("entropy_hex", r"[0-9A-Fa-f]{20,}", DIGITS + "ABCDEFabcdef", 20, 3.2),
    CharacterClass("entropy_base64", r"[A-Za-z0-9+/_-]{24,}", UPPER + LOWER + DIGITS + "+/_-",
                   24, 4.1),
)
# Candidates that are no secrets: words and paths without a digit, UUIDs, sample keys, one
# repeated character, and runs in which a counting sequence shows that somebody typed them.
ALLOWED = (
    r"^[^0-9]*$",
    r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
    r"(?i)example|sample|dummy|changeme|placeholder|x{6,}",
    r"^(.)\1*$",
    r"(?i)0123456789|abcdefghij",
)
SLACK = 1e-9

SPAN = "struct<start:int,rank:int,end:int,kind:string,value:string>"


# Values that one running pass goes through, code points of a piece of text that is cut from its
# start, and windows whose entropy one pass follows: what a pass carries stays small, so that the
# time is in proportion to the text.
RUN, PIECE, WINDOWS = 256, 1024, 2048
# Columns of intermediate steps; they are dropped at the end.
STEP = "__scan_"


def _bind(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once. A column that a lambda reads is bound as well:
    the optimizer may put its expression in place of its name, and so into every step."""
    return F.transform(F.array(value), use)[0]


def _with_running(df: DataFrame, names: list[str], join, levels: int = 2) -> DataFrame:
    """The arrays of integers in the columns ``names`` turned into running totals under ``join``
    (a sum or a maximum).

    A pass that appends to its state copies it each time, so an array is cut into runs of ``RUN``;
    the last totals of the runs are taken together in the same way, level by level, and each run
    starts from the total before it.
    """
    empty = "cast(array() as array<{}>)"

    def step(acc: Column, x: Column) -> Column:
        return F.concat(acc, F.array(F.when(F.size(acc) > 0, join(F.get(acc, F.size(acc) - 1), x))
                                     .otherwise(x)))

    def run(part) -> Column:
        return F.aggregate(part, F.expr(empty.format("bigint")), step)

    def runs(name: str) -> Column:
        def cut(values: Column) -> Column:
            firsts = F.sequence(F.lit(0), F.floor((F.size(values) - 1) / RUN).cast("int"))
            return F.transform(firsts, lambda k: run(F.slice(values, k * RUN + 1, F.lit(RUN))))

        return _bind(F.col(name), lambda values: F.when(F.size(values) > 0, cut(values)).otherwise(
            F.expr(empty.format("array<bigint>"))))

    def carried(name: str, level: int) -> Column:
        return _bind(F.col(f"{name}_{level + 1}"), lambda upto: F.flatten(F.transform(
            F.col(f"{name}_{level}_runs"), lambda p, k: F.when(
                k > 0, F.transform(p, lambda x: join(F.get(upto, k - 1), x))).otherwise(p))))

    df = df.withColumns({f"{n}_0": F.col(n) for n in names})
    for level in range(levels):
        df = df.withColumns({f"{n}_{level}_runs": runs(f"{n}_{level}") for n in names})
        df = df.withColumns({f"{n}_{level + 1}": F.transform(
            f"{n}_{level}_runs", lambda p: F.get(p, F.size(p) - 1)) for n in names})
    df = df.withColumns({f"{n}_{levels}": run(F.col(f"{n}_{levels}")) for n in names})
    for level in reversed(range(levels)):
        df = df.withColumns({f"{n}_{level}": carried(n, level) for n in names})
    df = df.withColumns({n: F.col(f"{n}_0") for n in names})
    return df.drop(*[f"{n}_{k}" for n in names for k in range(levels + 1)],
                   *[f"{n}_{k}_runs" for n in names for k in range(levels)])


def _with_matches(df: DataFrame, text: Column, patterns: dict[str, tuple[str, int]]) -> DataFrame:
    """For each name a column array<struct<start, end, value, part>> of the leftmost
    non-overlapping matches of its pattern; ``part`` is the given group.

    Ends are running totals of the lengths of the text between matches and of the matches; places
    are code points, end exclusive.
    """
    def steps(name: str, pattern: str) -> Column:
        found = F.col(name)
        gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
        return F.when(F.size(found) > 0, F.zip_with(gaps, found, lambda g, v: (
            F.length(g) + F.length(v)).cast("long"))).otherwise(
                F.expr("cast(array() as array<bigint>)"))

    def placed(name: str, pattern: str, group: int) -> Column:
        found = F.col(name)
        parts = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
        rows = F.arrays_zip(F.col(f"{name}_end").alias("end"), found.alias("value"),
                            parts.alias("part"))
        return F.transform(rows, lambda r: F.struct(
            (r["end"] - F.length(r["value"])).cast("int").alias("start"),
            r["end"].cast("int").alias("end"), r["value"].alias("value"),
            r["part"].alias("part")))

    df = df.withColumns({n: F.regexp_extract_all(text, F.lit(p), F.lit(0))
                         for n, (p, _) in patterns.items()})
    df = df.withColumns({f"{n}_end": steps(n, p) for n, (p, _) in patterns.items()})
    df = _with_running(df, [f"{n}_end" for n in patterns], lambda a, b: a + b)
    df = df.withColumns({n: placed(n, p, g) for n, (p, g) in patterns.items()})
    return df.drop(*[f"{n}_end" for n in patterns])


def _with_joined(df: DataFrame, names: list[str]) -> DataFrame:
    """Arrays of spans (s, e), in order of their start, with those that overlap or touch made one.

    A span opens a new one where it starts after all ends before it.
    """
    def joined(spans: Column, upto: Column) -> Column:
        opens = F.filter(spans, lambda x, k: (k == 0) | (x["s"] > F.get(upto, k - 1)))
        closes = F.filter(upto, lambda e, k: (k == F.size(upto) - 1)
                          | (F.get(spans, k + 1)["s"] > e))
        return F.zip_with(opens, closes, lambda x, e: F.struct(
            x["s"].alias("s"), e.cast("int").alias("e")))

    def bound(name: str) -> Column:
        return _bind(F.col(name), lambda spans: _bind(
            F.col(f"{name}_upto"), lambda upto: joined(spans, upto)))

    df = df.withColumns({f"{n}_upto": F.transform(n, lambda x: x["e"].cast("long"))
                         for n in names})
    df = _with_running(df, [f"{n}_upto" for n in names], F.greatest)
    return df.withColumns({n: bound(n) for n in names}).drop(*[f"{n}_upto" for n in names])


def _pieces(text: Column) -> Column:
    """``text`` in pieces of ``PIECE`` code points."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))


def _cut(pieces: Column, start: Column, end: Column) -> Column:
    """The text from code point ``start`` to ``end``: only the pieces that hold it are read."""
    first = F.floor(start / PIECE).cast("int")
    held = F.slice(pieces, first + 1, F.floor(end / PIECE).cast("int") - first + 1)
    return F.substring(F.array_join(held, ""), start - first * PIECE + 1, end - start)


def _base_spans(matches: str, rank: int) -> Column:
    kind, _, _, least = BASE_KINDS[rank]
    kept = F.filter(matches, lambda m: F.length(m["part"]) >= least)
    return F.transform(kept, lambda m: F.struct(
        m["start"].alias("start"), F.lit(rank).alias("rank"), m["end"].alias("end"),
        F.lit(kind).alias("kind"), m["value"].alias("value")))


def entropy_spans(value: Column, cls: CharacterClass) -> Column:
    """array<struct<s, e>>: where windows of ``value`` reach the entropy, joined if they touch.

    A pass over the characters keeps the count of each symbol in the window and the sum of
    c * log2(c); a step changes the two counts of the characters that enter and leave. Then
    H = log2(window) - sum / window. A pass follows ``WINDOWS`` windows; a longer value is taken in
    parts that overlap by a window, and spans of neighbouring parts may still overlap or touch.
    """
    width, size = cls.window, len(cls.alphabet)
    weight = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(width + 2)])
    most = F.lit(width * (math.log2(width) - cls.bits) + SLACK)
    start = F.expr(f"named_struct('n', array_repeat(0, {size + 1}), 'sum', 0.0D, 's', -1, "
                   "'e', -1, 'out', cast(array() as array<struct<s:int,e:int>>))")

    def spans(codes: Column, base: Column) -> Column:
        def step(acc: Column, i: Column) -> Column:
            enters = F.get(codes, i)
            leaves = F.when(i >= width, F.get(codes, i - width)).otherwise(F.lit(-1))
            now, gone = F.get(acc["n"], enters), F.get(acc["n"], F.greatest(leaves, F.lit(0)))
            same = enters == leaves
            total = F.when(same, acc["sum"]).otherwise(
                acc["sum"] + F.get(weight, now + 1) - F.get(weight, now)
                + F.when(leaves >= 0, F.get(weight, gone - 1) - F.get(weight, gone))
                .otherwise(F.lit(0.0)))
            counts = F.when(same, acc["n"]).otherwise(F.transform(
                acc["n"], lambda c, k: c + F.when(k == enters, 1).when(k == leaves, -1)
                .otherwise(0)))
            hit = (i >= width - 1) & (total <= most)
            first = base + i - (width - 1)
            fresh = hit & (first > acc["e"])
            close = fresh & (acc["e"] >= 0)
            return F.struct(
                counts.alias("n"), total.alias("sum"),
                F.when(fresh, first).otherwise(acc["s"]).alias("s"),
                F.when(hit, base + i + 1).otherwise(acc["e"]).alias("e"),
                F.when(close, F.concat(acc["out"], F.array(F.struct(
                    acc["s"].alias("s"), acc["e"].alias("e"))))).otherwise(acc["out"])
                .alias("out"))

        def finish(acc: Column) -> Column:
            last = F.array(F.struct(acc["s"].alias("s"), acc["e"].alias("e")))
            return F.when(acc["e"] >= 0, F.concat(acc["out"], last)).otherwise(acc["out"])

        return F.aggregate(F.sequence(F.lit(0), F.size(codes) - 1), start, step, finish)

    def parts(codes: Column) -> Column:
        firsts = F.sequence(F.lit(0), F.floor(F.greatest(F.size(codes) - width, F.lit(0))
                                              / WINDOWS).cast("int"))
        return F.flatten(F.transform(firsts, lambda k: _bind(
            F.slice(codes, k * WINDOWS + 1, F.lit(WINDOWS + width - 1)),
            lambda part: spans(part, k * WINDOWS))))

    letters = F.filter(F.split(value, ""), lambda c: c != "")
    codes = F.transform(letters, lambda c: F.instr(F.lit(cls.alphabet), c))
    return _bind(codes, parts)


def _candidate_spans(matches: str, cls: CharacterClass, allowed: tuple[str, ...]) -> Column:
    """Spans (s, e) of the candidates that no pattern of the allow-list holds back."""
    def refused(m: Column) -> Column:
        hit = F.lit(False)
        for pattern in allowed:
            hit = hit | F.rlike(m["value"], F.lit(pattern))
        return hit

    candidates = F.filter(matches, lambda m: ~refused(m))
    return F.flatten(F.transform(candidates, lambda m: F.transform(
        entropy_spans(m["value"], cls), lambda w: F.struct(
            (m["start"] + w["s"]).alias("s"), (m["start"] + w["e"]).alias("e")))))


def find_secrets(docs: DataFrame, classes: tuple[CharacterClass, ...] = CLASSES,
                 allowed: tuple[str, ...] = ALLOWED, column: str = "secrets") -> DataFrame:
    """``docs`` with ``column``: array of (start, rank, end, kind, value) by start, then kind.

    Base kinds are always reported; the allow-list holds back candidates of the entropy kinds
    only. A null or empty text has an empty array. All columns are kept as they are; one that
    is named ``column`` already is replaced. Repeated rows are scanned each on its own. The time
    is in proportion to a text's length, however many matches it holds.
    """
    text, pieces = F.coalesce(F.col("text"), F.lit("")), F.col(f"{STEP}pieces")
    base = {f"{STEP}{kind}": (pattern, group) for kind, pattern, group, _ in BASE_KINDS}
    runs = {f"{STEP}{cls.kind}": (cls.pattern, 0) for cls in classes}
    df = _with_matches(docs.withColumn(f"{STEP}pieces", _pieces(text)), text, base | runs)
    df = df.withColumns({n: _candidate_spans(n, cls, allowed) for n, cls in zip(runs, classes)})
    # Candidates are whole runs, so only spans of one candidate touch.
    df = _with_joined(df, list(runs))

    def entropy_kind(name: str, cls: CharacterClass, rank: int) -> Column:
        return _bind(pieces, lambda held: F.transform(name, lambda w: F.struct(
            w["s"].alias("start"), F.lit(rank).alias("rank"), w["e"].alias("end"),
            F.lit(cls.kind).alias("kind"), _cut(held, w["s"], w["e"]).alias("value"))))

    kinds = [_base_spans(name, rank) for rank, name in enumerate(base)]
    kinds += [entropy_kind(name, cls, len(base) + k)
              for k, (name, cls) in enumerate(zip(runs, classes))]
    return df.withColumn(column, F.array_sort(F.concat(*kinds))).drop(
        f"{STEP}pieces", *base, *runs)


def redact(docs: DataFrame, mark: str = "[SECRET]", column: str = "secrets") -> DataFrame:
    """``docs`` without ``column`` and with every secret in ``text`` replaced by ``mark`` and
    ``n_chars`` counted anew.

    Spans that overlap or touch become one mark; what lies between is cut out once and joined by
    marks. Texts without a secret, null ones included, stay as they are.
    """
    text, marked, pieces = F.col("text"), F.col(f"{STEP}marked"), F.col(f"{STEP}pieces")
    some = F.size(column) > 0
    df = docs.withColumns({
        f"{STEP}marked": F.transform(column, lambda s: F.struct(s["start"].alias("s"),
                                                                s["end"].alias("e"))),
        f"{STEP}pieces": F.when(some, _pieces(text))})
    df = _with_joined(df, [f"{STEP}marked"])
    ends = F.concat(F.array(F.lit(0)), F.transform(marked, lambda x: x["e"]))
    starts = F.concat(F.transform(marked, lambda x: x["s"]), F.array(F.length(text)))
    clean = _bind(pieces, lambda held: F.array_join(
        F.zip_with(ends, starts, lambda a, b: _cut(held, a, b)), mark))
    df = df.withColumn("text", F.when(some, clean).otherwise(text))
    if "n_chars" in docs.columns:
        df = df.withColumn("n_chars", F.when(some, F.length("text").cast("long"))
                           .otherwise(F.col("n_chars")))
    return df.drop(column, f"{STEP}marked", f"{STEP}pieces")


def span_text(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
