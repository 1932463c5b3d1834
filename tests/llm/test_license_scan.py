import random
import re

import pytest

from riskgraph.llm import license_scan as lic


def tokens(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def shingles(ws):
    return {tuple(ws[i:i + lic.SHINGLE]) for i in range(len(ws) - lic.SHINGLE + 1)}


@pytest.fixture(scope="module")
def docs(spark):
    rng, rows = random.Random(9), []
    def words(n):
        return [rng.choice("klmnop") + str(rng.randrange(500)) for _ in range(n)]
    for k in range(200):
        ws = words(rng.randrange(0, 90))
        if k % 2:
            notice = tokens(lic.TEMPLATES[k % len(lic.TEMPLATES)][1])
            if k % 3 == 0 and len(notice) > 16:  # one replaced word
                notice[len(notice) // 2] = "other"
            at = rng.randrange(len(ws) + 1)
            ws[at:at] = notice
        rows.append((k, ", ".join(ws).title(), "own", 1))
    rows += [(900, None, "own", 1), (901, "", "own", 1), (902, "MIT License", "own", 1),
             (1, rows[1][1], "own", 1), (None, "x", "own", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, license string, at int"), rows


def test_against_brute_force(spark, docs):
    df, rows = docs
    want = {}
    for doc_id, text, *_ in rows:
        ws = tokens(text)
        for k, (_, notice) in enumerate(lic.TEMPLATES):
            parts = tokens(notice)
            own, size = shingles(parts), len(parts)
            best = max((len(own & shingles(ws[i:i + 2 * size + lic.WINDOW + lic.SHINGLE]))
                        for i in range(len(ws))), default=0) / len(own)
            if best >= lic.CONTAINMENT:
                want[doc_id, k] = best
    assert len(want) > 90
    for bound in (lic.BROADCAST_KEYS, 0):
        got = lic.scan_licenses(df, lic.templates(spark), bound).collect()
        found = {(r.doc_id, r.template_id): r.containment for r in got}
        assert len(found) == len(got) and found.items() <= want.items()
        assert len(found) >= 0.99 * len(want)
        assert all(r.license == lic.TEMPLATES[r.template_id][0] for r in got)


def test_bands_keep_their_promise():
    assert lic.bands_for(0.5, 0.99) == 7
    assert 1 - (1 - lic.LEAST_SHINGLES / lic.WINDOW) ** lic.BANDS >= lic.COLLISION


def test_ends_of_texts_share_no_key(spark):
    """Windows at the end of a text or template lack shingles, and what they lack is no hash."""
    known = lic.templates(spark)
    own = {r.template_id: shingles(tokens(r.text)) for r in known.collect()}
    keys = {}
    for r in lic._template_keys(known.select(
            "template_id", lic.token_hashes("text").alias("tokens"))).collect():
        keys.setdefault(r.key, set()).add(r.template_id)
    assert all(own[a] & own[b] for ids in keys.values() for a in ids for b in ids)
    texts = spark.createDataFrame([(k, " ".join(f"w{k}x{j}" for j in range(3 + k % 10)))
                                   for k in range(300)], "doc_id long, text string")
    places = texts.select("doc_id", lic.token_hashes("text").alias("tokens")).selectExpr(
        "doc_id", "tokens", "explode(sequence(0, size(tokens) - 1)) as at")
    own = lic._banded(places, ["doc_id", "at"]).where("key is null or key in (%s)" % ", ".join(
        f"{k}L" for k in keys))
    assert own.count() == 0


def test_empty_tables_and_short_templates(spark, docs):
    df, _ = docs
    known = lic.templates(spark)
    assert lic.scan_licenses(df.limit(0), known).count() == 0
    assert lic.scan_licenses(df, known.limit(0)).count() == 0
    with pytest.raises(Exception, match="a template needs"):
        lic.scan_licenses(df, spark.createDataFrame(
            [(1, "x", "too short")], "template_id int, license string, text string"))


def test_templates_of_three_and_four_words(spark):
    known = [(0, "A", "All rights reserved"), (1, "B", "Use at own risk"),
             (2, "C", "Released under the MIT License")]
    rng, rows, want = random.Random(5), [], set()
    for k in range(160):
        ws = [rng.choice("klmnop") + str(rng.randrange(500)) for _ in range(k // 8)]
        at, part = rng.randrange(len(ws) + 1), tokens(known[k % 3][2])
        if k % 5 == 0:
            part = part[:-1]
        else:
            want.add((k, k % 3, at))
        ws[at:at] = part
        rows.append((k, " ".join(ws)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame(known, "template_id int, license string, text string")
    for bound in (lic.BROADCAST_KEYS, 0):
        got = lic.scan_licenses(df, known, bound).collect()
        assert all(r.containment == 1.0 for r in got)
        short = {(r.doc_id, r.template_id, r.at) for r in got if r.template_id < 2}
        assert short == {w for w in want if w[1] < 2}
        assert len(got) >= 0.97 * len(want)
    found = lic.scan_licenses(spark.createDataFrame(
        [(1, "(c) Someone. All Rights Reserved.")], "doc_id long, text string"),
        lic.templates(spark)).collect()
    assert [(r.license, r.at) for r in found] == [("All-Rights-Reserved", 2)]


def test_whole_license_texts(spark, tmp_path):
    """Texts within others, with some words replaced, and with half of the text only."""
    rng, rows, want = random.Random(3), [], {}
    files = sorted(lic.TEXTS.glob("*.txt"))
    folder = tmp_path / "texts"
    folder.mkdir()
    (folder / "empty.txt").write_text(" \n")
    (folder / "own terms.txt").write_text("You may read this text but never sing it aloud.")
    for k, file in enumerate(files):
        (folder / file.name).write_text(file.read_text())
        ws = file.read_text().split()
        around = [f"w{rng.randrange(900)}" for _ in range(200)]
        changed = list(ws)
        for at in range(9, len(ws), 40):
            changed[at] = "Someone"
        for j, part in enumerate((ws, changed, ws[:len(ws) // 2])):
            rows.append((3 * k + j, " ".join(around[:90] + part + around[90:])))
            want[3 * k + j] = file.stem if j < 2 else None
    rows.append((900, "you may READ this text, but never sing it aloud"))
    want[900] = "own terms"
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for bound in (lic.BROADCAST_KEYS, 0):
        found = lic.scan_licenses(df, lic.read_templates(spark, str(folder)), bound).collect()
        names = {}
        for r in found:
            names.setdefault(r.doc_id, set()).add(r.license)
        for doc_id, name in want.items():
            assert name in names.get(doc_id, {None}), doc_id
            if name is None:
                assert doc_id not in names
    built_in = lic.scan_licenses(df, lic.templates(spark)).where("containment = 1").collect()
    for k, file in enumerate(files):
        assert any(r.doc_id == 3 * k and r.license == file.stem
                   and r.template_id == len(lic.TEMPLATES) + k for r in built_in)
