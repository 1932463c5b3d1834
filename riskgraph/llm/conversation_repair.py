"""Repair of conversation structure by a secondary-sorted stream.

Turns are shuffled once, by conversation, and sorted by turn; a task then reads one conversation
after the other and carries the state of a dynamic program from one Arrow batch to the next. The
program finds the cheapest edits after which the roles read ``(s?(ua)+)?``. Its state is where the
roles stand (nothing yet, after system, user or assistant); for each it keeps the least cost, the
place of its edits among those of the other states in ASCII order, and a running digest of the
repaired text. Which state a row's edits came from goes to a list of backpointers of four bytes a
row, which is spilled beyond a bound, so that a giant conversation needs little memory.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from riskgraph.llm.memory import as_task

# What the edits cost; a truncated row that stays costs as much as TRUNCATED more.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
BLANKS = " \t\n\x0b\x0c\r"
ENDS = ".!?"
ROLES = {"u": "user", "a": "assistant"}

START, SYSTEM, USER, ASSISTANT = range(4)
# The state that an initial leads to, and the initial that a new or reroled row has in a state.
LEGAL = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER,
         (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
EXPECTED = ("u", "u", "a", "u")
# Inserts after which a state is complete.
TO_FINISH = {START: 0, ASSISTANT: 0, USER: 1, SYSTEM: 2}
LETTERS = "KRD"
#: Bytes of backpointers that a task keeps in memory.
SPILL_BYTES = 1 << 20
#: Finished conversations that a task hands on together, and their audits' characters.
OUT_ROWS, OUT_CHARS = 10_000, 1 << 22


def _moves(initial: str, doomed: bool, truncated: bool) -> list[list[tuple]]:
    """For each next state the (state before, cost, inserts, letter) of a row's edits.

    Inserts come before the row's own edit; of those with the same two states only the best stays.
    More than two inserts lead back to a state at a price.
    """
    best: dict[tuple[int, int], tuple[int, str]] = {}
    for before in range(4):
        state = before
        for inserts in range(3):
            edits = [("D", DELETE, state)]
            if not doomed:
                stays = TRUNCATED if truncated else 0
                if (state, initial) in LEGAL:
                    edits.append(("K", stays, LEGAL[state, initial]))
                edits.append(("R", REROLE + stays, LEGAL[state, EXPECTED[state]]))
            for letter, cost, after in edits:
                found = INSERT * inserts + cost, "I" * inserts + letter
                if found < best.get((before, after), (1 << 60, "")):
                    best[before, after] = found
            state = LEGAL[state, EXPECTED[state]]
    out: list[list[tuple]] = [[] for _ in range(4)]
    for (before, after), (cost, edits) in best.items():
        out[after].append((before, cost, edits))
    return out


MOVES = {(initial, doomed, truncated): _moves(initial, doomed, truncated)
         for initial in ("s", "u", "a", "") for doomed in (False, True)
         for truncated in (False, True)}


class _Pointers:
    """Records of four bytes, one a row: for each state the state before, inserts and letter.

    Records beyond ``SPILL_BYTES`` go to a file in the folder of the executor that Spark itself
    spills to; nobody but the task reads it, and it is gone with the task.
    """

    def __init__(self) -> None:
        self.held, self.file = bytearray(), None

    def add(self, record: bytes) -> None:
        self.held += record
        if len(self.held) >= SPILL_BYTES:
            if self.file is None:
                folder = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0]
                self.file = tempfile.TemporaryFile(dir=folder or None)
            self.file.write(self.held)
            self.held = bytearray()

    def backwards(self) -> Iterator[bytes]:
        """Parts of the records, the last part first."""
        yield bytes(self.held)
        if self.file is not None:
            end = self.file.tell()
            while end:
                start = max(0, end - SPILL_BYTES)
                self.file.seek(start)
                yield self.file.read(end - start)
                end = start
            self.file.close()

    def edits(self, state: int) -> str:
        """The edits' letters on the way to ``state``."""
        out = bytearray()
        for part in self.backwards():
            for at in range(len(part) - 4, -1, -4):
                code = part[at + state]
                out += b"KRD"[code >> 4:(code >> 4) + 1] + b"I" * (code >> 2 & 3)
                state = code & 3
        out.reverse()
        return out.decode()


class Conversation:
    """One conversation as its rows arrive in order."""

    def __init__(self) -> None:
        self.first = self.last = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.before: str | None = None
        self.cost: list[int | None] = [0, None, None, None]
        self.rank = [0, 0, 0, 0]
        self.digests: list = [hashlib.sha256(), None, None, None]
        self.pointers = _Pointers()

    def add(self, turn: int | None, role: str, text: str, again: bool) -> None:
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last = turn
            self.turns += 1
        seen = text.rstrip(BLANKS)
        blank = not seen
        duplicate = again and not blank
        truncated = not blank and not duplicate and seen[-1] not in ENDS
        self.blank += blank
        self.duplicate += duplicate
        self.truncated += truncated
        initial = role[:1]
        if self.before is not None:
            self.illegal += self.before + initial not in ("su", "ua", "au")
        self.before = initial
        known = initial if initial in ("s", "u", "a") else ""
        self._step(MOVES[known, blank or duplicate, truncated], role, text)

    def _step(self, moves: list[list[tuple]], role: str, text: str) -> None:
        cost, rank = self.cost, self.rank
        found: list[tuple | None] = [None] * 4
        for after in range(4):
            best = None
            for before, more, edits in moves[after]:
                if cost[before] is not None:
                    way = cost[before] + more, rank[before], edits, before
                    if best is None or way < best:
                        best = way
            found[after] = best
        # Two ways are no beginnings of each other, as both end with this row's letter: the one
        # whose edits came first, then the one whose new letters do, is first for good.
        live = sorted((w[1], w[2], after) for after, w in enumerate(found) if w)
        self.rank = [0, 0, 0, 0]
        for place, (_, _, after) in enumerate(live):
            self.rank[after] = place
        digests, record = [None] * 4, bytearray(b"\xff" * 4)
        own = None
        for after, way in enumerate(found):
            if way is None:
                continue
            _, _, edits, before = way
            inserts, letter = len(edits) - 1, edits[-1]
            record[after] = LETTERS.index(letter) << 4 | inserts << 2 | before
            digest = self.digests[before]
            if inserts or letter != "D":
                digest, state = digest.copy(), before
                for _ in range(inserts):
                    state = _put(digest, state, ROLES[EXPECTED[state]], b"")
                if letter != "D":
                    own = own if own is not None else text.encode("utf-8", "surrogatepass")
                    _put(digest, state, role if letter == "K" else ROLES[EXPECTED[state]], own)
            digests[after] = digest
        self.cost = [w[0] if w else None for w in found]
        self.digests = digests
        self.pointers.add(record)

    def result(self) -> tuple:
        """(gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256)"""
        cost, _, edits, state = min(
            (self.cost[s] + INSERT * n, self.rank[s], "I" * n, s)
            for s, n in TO_FINISH.items() if self.cost[s] is not None)
        digest = self.digests[state]
        at = state
        for _ in edits:
            at = _put(digest, at, ROLES[EXPECTED[at]], b"")
        gaps = self.last - self.first + 1 - self.turns if self.turns else 0
        return (gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost,
                self.pointers.edits(state) + edits, digest.hexdigest())


def _put(digest, state: int, role: str, text: bytes) -> int:
    """Add a turn to a repaired text; the state after it."""
    digest.update((b"" if state == START else b"\n") + role.encode("utf-8", "surrogatepass")
                  + b":" + text)
    return LEGAL[state, role[:1]]


NAMES = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def _streamed(rows: DataFrame, absent: Column | None) -> DataFrame:
    """Rows dealt out by conversation and sorted by turn, role and text, with ``again`` for those
    whose role and text came before. The mark needs no shuffle of its own."""
    turn = F.col("turn").cast("long")
    rows = rows.select(
        F.col("conv_id"), turn.alias("turn"), F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
        (F.lit(False) if absent is None else F.coalesce(absent, F.lit(False))).alias("absent"))
    alike = Window.partitionBy("conv_id", "absent", "role", "text").orderBy(
        F.asc_nulls_first("turn"))
    return (rows.repartition("conv_id").withColumn("again", F.row_number().over(alike) > 1)
            .sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "text"))


def audit_conversations(rows: DataFrame, absent: Column | None = None) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256): one row
    for each conversation of ``rows`` (conv_id, turn, role, text).

    ``audit`` has the letters of the cheapest edits in order: K(eep), R(erole), D(elete) for each
    row and I for each inserted turn; of equally cheap ones the first in ASCII order. The digest is
    that of the repaired ``role:text`` lines. Rows for which ``absent`` holds only name their
    conversation; one that has no other rows gets zeros, an empty audit and the digest of nothing.
    Rows with a null conv_id are one conversation. A null turn comes first; rows of one turn are
    taken by role, then by text. Null roles and texts are empty; a role counts by its first
    character. Rows repeated in whole are duplicates. Other columns are not looked at.
    """
    schema = ", ".join(f"{n} {'string' if n in ('audit', 'repaired_sha256') else 'long'}"
                       for n in NAMES)

    @as_task
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out: list[tuple] = []
        chars = 0
        name, talk = None, None
        for batch in batches:
            columns = (batch[c].tolist() for c in ("conv", "dated", "turn", "role", "text",
                                                   "again", "absent"))
            for conv, dated, turn, role, text, again, gone in zip(*columns):
                if talk is None or conv != name:
                    if talk is not None:
                        out.append((name, *talk.result()))
                        chars += len(out[-1][7])
                    name, talk = conv, Conversation()
                if not gone:
                    talk.add(turn if dated else None, role, text, again)
                if len(out) >= OUT_ROWS or chars >= OUT_CHARS:
                    yield pd.DataFrame(out, columns=["conv", *NAMES])
                    out, chars = [], 0
        if talk is not None:
            out.append((name, *talk.result()))
            yield pd.DataFrame(out, columns=["conv", *NAMES])

    stream = _streamed(rows, absent).select(
        F.col("conv_id").cast("string").alias("conv"), F.col("turn").isNotNull().alias("dated"),
        F.coalesce("turn", F.lit(0)).alias("turn"), "role", "text", "again", "absent")
    done = stream.mapInPandas(run, f"conv string, {schema}")
    return done.select(F.col("conv").cast(rows.schema["conv_id"].dataType).alias("conv_id"), *NAMES)


def repaired_turns(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """(conv_id, place, edit, role, text): the repaired conversations, place by place from 0.

    ``audits`` comes from ``audit_conversations`` of the same ``rows``; each audit travels as the
    first row of its conversation, and the letters are carried out as the rows arrive.
    """
    kind = rows.schema["conv_id"].dataType
    head = audits.select(
        "conv_id", F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"),
        F.col("audit").alias("text"), F.lit(True).alias("head"))
    body = rows.select("conv_id", F.col("turn").cast("long").alias("turn"),
                       F.coalesce("role", F.lit("")).alias("role"),
                       F.coalesce("text", F.lit("")).alias("text"), F.lit(False).alias("head"))
    stream = (head.unionByName(body).repartition("conv_id").sortWithinPartitions(
        "conv_id", F.desc("head"), F.asc_nulls_first("turn"), "role", "text")
        .select(F.col("conv_id").cast("string").alias("conv"), "head", "role", "text"))

    @as_task
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        conv, letters, at, state, place = None, "", 0, START, 0
        for batch in batches:
            out: list[tuple] = []

            def inserted() -> None:
                nonlocal at, state, place
                while at < len(letters) and letters[at] == "I":
                    out.append((conv, place, "I", ROLES[EXPECTED[state]], ""))
                    state = LEGAL[state, EXPECTED[state]]
                    at, place = at + 1, place + 1

            for name, is_head, role, text in zip(*(batch[c].tolist() for c in (
                    "conv", "head", "role", "text"))):
                if is_head:
                    conv, letters, at, state, place = name, text, 0, START, 0
                    inserted()
                    continue
                letter = letters[at]
                at += 1
                if letter != "D":
                    new = role if letter == "K" else ROLES[EXPECTED[state]]
                    out.append((conv, place, letter, new, text))
                    state, place = LEGAL[state, new[:1]], place + 1
                inserted()
            if out:
                yield pd.DataFrame(out, columns=["conv", "place", "edit", "role", "text"])

    done = stream.mapInPandas(run, "conv string, place long, edit string, role string, text string")
    return done.select(F.col("conv").cast(kind).alias("conv_id"), "place", "edit", "role", "text")


def damaged(rows: DataFrame) -> tuple[DataFrame, Column]:
    """(rows, absent): ``rows`` with faults dealt out by a hash of conversation and turn.

    Of each 20 hashes one drops the row, one empties its text, one takes its sentence ends away,
    one repeats it and one makes its role user. Nulls are one space, in the hashed text as well.
    Dropped rows are marked absent, so that their conversation is not forgotten.
    """
    def told(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    case = F.crc32(F.concat(told("conv_id"), F.lit(":"), told("turn")).cast("binary")) % 20
    text = (F.when(F.col("case") == 1, "")
            .when(F.col("case") == 2, F.regexp_replace(told("text"), "[.!?]", ""))
            .otherwise(told("text")))
    copies = F.when(F.col("case") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    cases = rows.select("conv_id", "turn", "role", "text", case.alias("case"))
    out = cases.select(
        "conv_id", "turn", F.when(F.col("case") == 4, "user").otherwise(told("role")).alias("role"),
        text.alias("text"), (F.col("case") == 0).alias("dropped"), F.explode(copies).alias("copy"))
    return out, F.col("dropped")
