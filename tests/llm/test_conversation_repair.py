import hashlib
import random
import re
import zlib
from itertools import product

import pytest

from riskgraph.llm import conversation_repair as repair, queries

SPACE = " \t\n\x0b\x0c\r"


def cheapest(rows):
    """(cost, audit, digest) by going through all edits of a short conversation."""
    marks, seen = [], set()
    for role, text in rows:
        inner = text.strip(SPACE)
        fault = ("blank" if not inner else "duplicate" if (role, text) in seen
                 else "truncated" if inner[-1] not in ".!?" else "")
        seen.add((role, text))
        marks.append(fault)
    best = None

    def close(out, cost, audit):
        nonlocal best
        if re.fullmatch("(s?(ua)+)?", "".join(r[:1] or "-" for r, _ in out)):
            digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
            best = min(best or (1 << 30, "", ""), (cost, audit, digest))

    def go(k, out, cost, audit, inserts):
        if cost > 4 * len(rows):  # all rows can be deleted at this price
            return
        if k == len(rows):
            close(out, cost, audit)
        if inserts < 2:
            for role in ("user", "assistant"):
                go(k, out + [(role, "")], cost + 3, audit + "I", inserts + 1)
        if k == len(rows):
            return
        (role, text), fault = rows[k], marks[k]
        go(k + 1, out, cost + 4, audit + "D", 0)
        if fault in ("blank", "duplicate"):
            return
        more = 3 if fault else 0
        go(k + 1, out + [(role, text)], cost + more, audit + "K", 0)
        for new in ("user", "assistant"):
            go(k + 1, out + [(new, text)], cost + 3 + more, audit + "R", 0)

    go(0, [], 0, "", 0)
    pairs = zip(rows, rows[1:])
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in pairs)
    return (marks.count("blank"), marks.count("duplicate"), marks.count("truncated"), illegal,
            *best)


def talks():
    """All role sequences up to four rows, and random ones with faults."""
    out = [[(r, f"{k}.") for k, r in enumerate(c)] for n in range(1, 4)
           for c in product(["system", "user", "assistant"], repeat=n)]
    rng = random.Random(4)
    roles = ["system", "user", "assistant", "tool", "", "unknown"]
    texts = ["a.", "b!", "c?", "d", "", " \n", "é", "x. \t", " ", "a.b"]
    out += [[(rng.choice(roles), rng.choice(texts)) for _ in range(rng.randrange(1, 5))]
            for _ in range(60)]
    return out


def test_against_all_edits(spark):
    rows = [(c, k, role, text, "x") for c, talk in enumerate(talks())
            for k, (role, text) in enumerate(talk)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, cost string")
    got = {r.conv_id: r for r in repair.audit_conversations(df).collect()}
    for c, talk in enumerate(talks()):
        r = got[c]
        assert (r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit,
                r.repaired_sha256) == cheapest(talk), talk
        assert r.gaps == 0
    turns = {}
    for r in repair.repaired_turns(df, repair.audit_conversations(df)).collect():
        turns.setdefault(r.conv_id, []).append((r.place, r.role, r.text))
    for c in got:
        lines = [f"{role}:{text}" for _, role, text in sorted(turns.get(c, []))]
        assert [p for p, *_ in sorted(turns.get(c, []))] == list(range(len(lines)))
        assert hashlib.sha256("\n".join(lines).encode()).hexdigest() == got[c].repaired_sha256


def test_long_conversations_spill_and_cross_batches(spark, monkeypatch):
    """The same conversation in one batch and spilled over many, with turns far apart."""
    rng = random.Random(1)
    rows = [(rng.choice(["user", "assistant", "system"]), rng.choice(["Fine.", "No", "", str(i)]))
            for i in range(3000)]
    one = repair.Conversation()
    seen = set()
    for k, (role, text) in enumerate(rows):
        one.add(2 * k, role, text, (role, text) in seen)
        seen.add((role, text))
    whole = one.result()
    monkeypatch.setattr(repair, "SPILL_BYTES", 64)
    two = repair.Conversation()
    seen = set()
    for k, (role, text) in enumerate(rows):
        two.add(2 * k, role, text, (role, text) in seen)
        seen.add((role, text))
    assert two.pointers.file is not None and two.result() == whole
    assert whole[0] == 2 * 2999 + 1 - 3000 and len(whole[6].replace("I", "")) == 3000
    df = spark.createDataFrame([("c", 2 * k, role, text) for k, (role, text) in enumerate(rows)],
                               "conv_id string, turn long, role string, text string")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        got = repair.audit_conversations(df).first()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert tuple(got)[1:] == whole


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        case = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if case == 1:
            text = ""
        if case == 2:
            text = re.sub("[.!?]", "", text)
        if case == 4:
            role = "user"
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(case, 1)
    return out


def test_query_on_a_table(spark, tmp_path):
    rng = random.Random(8)
    rows = [(c, t, rng.choice(["system", "user", "assistant", None]),
             rng.choice(["One.", "Two!", "three", None, "", "Four? "]))
            for c in [*range(150), None] for t in [None, *range(rng.randrange(3))]]
    rows += [(1000 + c, 0, "user", "x.") for c in range(60)]      # some lose their only row
    rows += [(5, 0, "user", "tied."), (5, 0, "assistant", "tied.")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(
        str(tmp_path / "conversations.parquet"))
    got = {r.conv_id: r for r in queries.QUERIES["op13_conversation_repair"](
        spark, str(tmp_path)).collect()}
    assert set(got) == {r[0] for r in rows}
    left = {}
    for conv, turn, role, text in damage(rows):
        left.setdefault(conv, []).append((turn is not None, turn or 0, role, text))
    for conv, r in got.items():
        own = sorted(left.get(conv, []))
        turns = [t for dated, t, *_ in own if dated]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        assert tuple(r)[1:] == (gaps, *cheapest([(role, text) for *_, role, text in own])), own
    assert any(not left.get(c) for c in got)
    nothing = next(got[c] for c in got if not left.get(c))
    assert tuple(nothing)[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_empty_table(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert repair.audit_conversations(none).count() == 0
    assert repair.audit_conversations(repair.damaged(none)[0]).count() == 0


@pytest.mark.parametrize("kind", ["string", "int"])
def test_ids_of_other_types(spark, kind):
    df = spark.sql(f"select cast(7 as {kind}) conv_id, 1 turn, 'user' role, 'Hi.' text")
    row = repair.audit_conversations(df).first()
    assert str(row.conv_id) == "7" and row.audit == "KI" and row.cost == 3
