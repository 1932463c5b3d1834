import math
import random

import numpy as np
import pytest

from riskgraph.llm import embedding_dedup as emb, groups, ngram_join as join


def reach(ids, pairs):
    """Smallest id reachable from each id."""
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_components(spark):
    rng = random.Random(3)
    pairs = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)]
    pairs += [(1000 + i, 1001 + i) for i in range(60)] + [(5000, 5001 + i) for i in range(300)]
    df = spark.createDataFrame(pairs + pairs[:20] + [(7, 7)], "a long, b long")
    got = {r.id: r.component for r in groups.components(df).collect()}
    want = reach({i for p in pairs for i in p}, pairs)
    assert got == {i: c for i, c in want.items() if i in got}
    assert all(want[i] == i for i in want.keys() - got.keys())
    assert groups.components(df.limit(0)).count() == 0


def test_local_roots():
    rng = np.random.default_rng(5)
    for _ in range(50):
        n, m = rng.integers(1, 40), rng.integers(0, 50)
        a, b = rng.integers(0, n, (2, m))
        want = reach(range(n), zip(a.tolist(), b.tolist()))
        assert groups.local_roots(n, a, b).tolist() == [want[i] for i in range(n)]


def shingles(text):
    words = (text or "").lower().split()
    if not words:
        return set()
    return {tuple(words[i:i + 5]) for i in range(max(len(words) - 4, 1))}


@pytest.fixture(scope="module")
def documents():
    rng = random.Random(11)

    def words(n):
        return [rng.choice("abcdef") + str(rng.randrange(900)) for _ in range(n)]

    texts, hot = [], words(200)
    for k in range(240):
        base = words(rng.randrange(1, 120))
        texts.append(" ".join(base))
        if k % 3 == 0:  # near copies at all distances
            for _ in range(rng.randrange(1, 5)):
                copy = list(base)
                for _ in range(rng.randrange(0, 4)):
                    copy[rng.randrange(len(copy))] = "new" + str(rng.randrange(99))
                texts.append(" ".join(copy))
        if k % 10 == 0:
            texts.append(" ".join(words(200) + hot))
    for k in range(150):  # one large group of near copies
        copy = list(hot)
        copy[k] = "other"
        texts.append(" ".join(copy))
    texts += [texts[5]] * 7 + ["", None, "  ", "That it.", "that  IT.", "That is it."]
    return {i: t for i, t in enumerate(rng.sample(texts, len(texts)))}


def brute(texts):
    sets = {i: shingles(t) for i, t in texts.items()}
    ids = sorted(i for i in sets if sets[i])
    return [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:]
            if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) - 1e-9]


def check(got, ids, pairs):
    links, root = dict.fromkeys(ids, 0), reach(ids, pairs)
    for a, b in pairs:
        links[a] += 1
        links[b] += 1
    assert {k: v[0] for k, v in got.items()} == links
    assert {k: v[1] for k, v in got.items()} == root
    assert all(v[2] == (root[k] == k) for k, v in got.items())


def test_similar_documents(spark, documents, monkeypatch):
    monkeypatch.setattr(join, "BUCKET", 20)
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in documents.items()]
                               + [(5, documents[5], "x", "y"), (None, documents[6], "x", "y")],
                               "doc_id long, text string, sketch string, id string")
    pairs = brute(documents)
    assert len(pairs) > 5000
    for bound in (join.BROADCAST_IDS, 0):
        monkeypatch.setattr(join, "BROADCAST_IDS", bound)
        rows = join.similar_documents(df).collect()
        got = {r.doc_id: (r.n_links, r.class_id, r.kept) for r in rows if r.doc_id is not None}
        assert len(rows) == len(got) + 1
        check(got, set(documents), pairs)
    kept = join.one_of_each(df).collect()
    root = reach(set(documents), pairs)
    assert sorted(str(r.doc_id) for r in kept) == sorted(
        [str(i) for i in root if root[i] == i] + ["None"])
    assert join.similar_documents(df.limit(0)).count() == 0


def test_runs_reach_the_recall():
    assert join.runs_for(0.8, 0.99999) == 5 and join.runs_for(0.8, 0.9) == 1
    a, b = join.shingle_set("a b c d e f g h i j"), join.shingle_set("a b c d e f g h i j k")
    equal = (join.min_hashes(a) == join.min_hashes(b)).mean()
    assert abs(equal - len(np.intersect1d(a, b)) / len(np.union1d(a, b))) < 0.15


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(8)
    rows = []
    for label in (0, 1, 2):
        for _ in range(150):
            v = rng.standard_normal(24)
            rows.append((label, v.tolist()))
            for _ in range(rng.integers(0, 3)):
                near = v + rng.standard_normal(24) * np.linalg.norm(v) / 24 ** 0.5 * 0.3
                rows.append((label, near.tolist()))
    hot = rng.standard_normal(24)
    rows += [(1, (hot + rng.standard_normal(24) * 0.2).tolist()) for _ in range(200)]
    rows += [(2, hot.tolist())] * 90 + [(2, (hot * 3).tolist()), (None, hot.tolist())]
    rows += [(1, None), (1, []), (1, [0.0] * 24), (1, [-0.0] * 24), (1, [math.nan] * 24),
             (1, [math.inf, *hot[1:].tolist()]), (1, [None, *hot[1:].tolist()]),
             (1, [1.0, 2.0]), (1, [2.0, 4.0]), (2, [-0.0, 1.0]), (2, [0.0, 1.0]),
             (0, [1e200] * 3), (0, [1e-200] * 3)]
    order = rng.permutation(len(rows))
    return [(int(i), *rows[k]) for i, k in enumerate(order)]


def test_near_duplicate_vectors(spark, vectors, monkeypatch):
    monkeypatch.setattr(emb, "BLOCK", 128)
    unit = {}
    for i, label, v in vectors:
        if label is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        x = np.array(v)
        if np.abs(x).max() > 0:
            x /= np.abs(x).max()
            unit[i] = label, x / np.linalg.norm(x)
    ids = sorted(unit)
    pairs = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:]
             if unit[a][0] == unit[b][0] and len(unit[a][1]) == len(unit[b][1])
             and unit[a][1] @ unit[b][1] >= 0.93]
    assert len(pairs) > 5000
    df = spark.createDataFrame([(*r, 1.0) for r in vectors],
                               "vec_id long, label int, embedding array<double>, id double")
    rows = emb.near_duplicates(df).collect()
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in rows}
    assert len(rows) == len(vectors)
    check(got, {r[0] for r in vectors}, pairs)
    assert emb.near_duplicates(df.limit(0)).count() == 0


def test_vectors_without_an_id_take_no_part(spark):
    rows = [(1, 0, [1.0, 0.0]), (2, 0, [1.0, 0.01]), (None, 0, [1.0, 0.0]),
            (None, 0, [1.0, 0.005]), (4, 0, [0.0, 1.0]), (None, 0, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    got = sorted(map(tuple, emb.near_duplicates(df).collect()), key=str)
    assert got == [(1, 1, 1, True), (2, 1, 1, False), (4, 0, 4, True)] + [
        (None, 0, None, True)] * 3


def test_passes_grow_with_the_rows():
    sizes = [emb.passes_for(n) for n in (0, 1, emb.NEIGHBOURS, 5_000, 500_000)]
    assert sizes[0] == sizes[2] == 1 and sizes == sorted(sizes)


def test_few_vectors_need_one_pass(spark, vectors):
    df = spark.createDataFrame([r for r in vectors if r[1] == 0][:40],
                               "vec_id long, label int, embedding array<double>")
    assert emb.near_duplicates(df).count() == 40


@pytest.mark.parametrize("common, exact", [(0.8, (4096, 4)), (0.85, (0, 4)), (0.3, (0, 0))])
def test_vectors_off_centre(spark, monkeypatch, common, exact):
    """Pairs just above the threshold among vectors with a common direction of that mean cosine."""
    monkeypatch.setattr(emb, "EXACT_ROWS", exact[0], raising=False)
    monkeypatch.setattr(emb, "EXACT_FACTOR", exact[1], raising=False)
    rng, n, pairs = np.random.default_rng(21), 5000, 400
    base = rng.standard_normal(64)
    own = rng.standard_normal((n, 64))
    unit = common ** 0.5 * base / np.linalg.norm(base) + (
        1 - common) ** 0.5 * own / np.linalg.norm(own, axis=1, keepdims=True)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    off = rng.standard_normal((pairs, 64))
    off -= (off * unit[:pairs]).sum(axis=1, keepdims=True) * unit[:pairs]
    off /= np.linalg.norm(off, axis=1, keepdims=True)
    unit = np.vstack([unit, 0.935 * unit[:pairs] + (1 - 0.935 ** 2) ** 0.5 * off])
    near = np.argwhere(np.triu(unit @ unit.T >= emb.COSINE, 1))
    assert pairs <= len(near) < 10 * pairs
    links = np.zeros(len(unit), int)
    np.add.at(links, near.ravel(), 1)
    df = spark.createDataFrame([(i, 1, v) for i, v in enumerate(unit.tolist())],
                               "vec_id long, label int, embedding array<double>")
    got = {r.vec_id: r.n_links for r in emb.near_duplicates(df).collect()}
    assert len(got) == len(unit) and all(got[i] <= n for i, n in enumerate(links))
    assert sum(got.values()) >= 0.995 * links.sum()


def test_equal_keys_meet_by_no_bits():
    key = np.zeros(200, np.int64)
    kind = np.zeros((200, 3), np.int64)
    assert (emb._missed(key, kind, 0.93, 64) == 0).all()
    assert (emb._missed(key[:64], kind[:64], 0.93, 64) < -50).all()
    assert emb._shared_bits(np.array([0, 1, -1]), np.array([0, 0, 0])).tolist() == [64, 63, 0]


def test_rows_with_gaps_between_them():
    """Only a row just ``window`` ranks away tells how far keys must agree."""
    rng = np.random.default_rng(3)
    key, kind = np.sort(rng.integers(-1 << 62, 1 << 62, 300)), np.zeros((300, 3), np.int64)
    whole = emb._missed(key, kind, 0.93, 16)
    some = np.r_[0:64, 200:300]
    part = emb._missed(key[some], kind[some], 0.93, 16, some)
    inner = (some < 48) | (some >= 216)
    assert (part[inner] == whole[some[inner]]).all()


def test_sketches_keep_pairs_at_the_threshold():
    n, p, most = 64 * emb.SKETCH, math.acos(0.93) / math.pi, emb.most_differing(0.93)
    lost = [sum(math.comb(n, k) * p ** k * (1 - p) ** (n - k) for k in range(m + 1, n + 1))
            for m in (most, most - 1)]
    assert lost[0] <= emb.SKETCH_LOSS < lost[1]
    words = np.array([[0] * 4, [-1, 0, 0, 0], [1, 0, 0, 0], [0] * 4], np.int64)
    near = np.zeros(4, bool)
    emb._mark_alike(near, words, np.array([[0], [0], [0], [1]]), np.arange(4), 1, 2)
    assert near.tolist() == [True, False, True, False]


@pytest.mark.parametrize("parts", [1, 40])
def test_ranges_of_any_size(spark, monkeypatch, parts):
    """Streams with little ahead, and ranges that are smaller than a window."""
    rng = np.random.default_rng(4)
    base = rng.standard_normal((700, 16))
    rows = np.vstack([base, base + 0.02 * rng.standard_normal(base.shape)])
    df = spark.createDataFrame([(i, i % 700 % 3, v) for i, v in enumerate(rows.tolist())],
                               "vec_id long, label int, embedding array<double>")
    monkeypatch.setattr(emb, "EXACT_ROWS", 0)
    monkeypatch.setattr(emb, "EXACT_FACTOR", 0)
    was = {k: spark.conf.get(k) for k in (
        "spark.sql.shuffle.partitions", "spark.sql.execution.arrow.maxRecordsPerBatch",
        "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        for k, v in zip(was, (str(parts), "50", "false")):
            spark.conf.set(k, v)
        got = emb.near_duplicates(df, window=32).collect()
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)
    assert all(r.n_links >= 1 and r.component_id <= r.vec_id % 700 for r in got)


def test_filter_and_runs_keep_the_recall():
    n, t = join.COORDINATES, join.JACCARD
    least = math.ceil((t - join.MARGIN) * n)
    dropped = sum(math.comb(n, k) * t ** k * (1 - t) ** (n - k) for k in range(least))
    meet = 1.0
    for _ in range(join.LEVELS):
        meet = 1 - (1 - t * meet) ** join.SAMPLED
    assert dropped + (1 - meet) ** join.runs_for() <= 1 - join.RECALL
