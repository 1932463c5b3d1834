import functools
import gzip
import hashlib
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from riskgraph.llm import files, packing, token_files, token_ids, warc

WORDS, BYTES = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))
TEXTS = ["", None, " ", "That it.", "one  two\n\n three\t four ", "Ünï çode ΣΑΣ İstanbul 😀 don't",
         "<|endoftext|> as text", "a\x1cb \x85 c", "word " * 3000, "That it."]


@functools.cache
def tokenizer(path):
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return t


def ids_of(path, text, end):
    return tokenizer(path).encode(text or "", add_special_tokens=False).ids + [end]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(
    st.sampled_from("     \n\n\t\x1c\x85\xa0'.,!sStTdD09éÉßİΣςñ<|>"),
    st.characters(codec="utf-8")), max_size=30), max_size=6))
def test_pieces_give_the_ids_of_the_whole_text(texts):
    for path in (WORDS, BYTES):
        got = list(token_ids.token_coder(path).encode(pa.array([*texts, None], pa.string())))
        assert [np.frombuffer(x, "<u4").tolist() for x in got] == [
            ids_of(path, t, 0)[:-1] for t in [*texts, None]]


@given(st.lists(st.integers(0, 2 ** 17 - 1), max_size=70), st.integers(17, 23))
def test_bit_packing_round_trip(ids, bits):
    data = token_files.pack_bits(np.array(ids, np.uint32), bits)
    assert len(data) == -(-len(ids) * bits // 8)
    assert token_files.unpack_bits(data, len(ids), bits).tolist() == ids


def test_many_lines_without_a_space():
    words = [f"word{k % 700}" + ".,;"[k % 3] * (k % 2) for k in range(5000)]
    texts = ["\n".join(words), "a " + "\n".join(words) + " b",
             "\n".join([*words[:900], "", *words[:900]]),
             "\n".join([*words[:900], "\tx", *words[:900]])]
    for path in (WORDS, BYTES):
        coder = token_ids.TokenCoder(path)
        assert list(coder.encode(pa.array(texts))) == [coder.whole(t) for t in texts]


def test_token_file_random_access():
    rng = np.random.default_rng(1)
    docs = [rng.integers(0, 50257, n).astype("<u4") for n in (0, 5, 70_000, 1, 140_001)]
    bits = token_files.bits_for(50257)
    assert bits == 16 and token_files.bits_for(65537) == 17 and token_files.bits_for(1) == 1
    for width in (16, 19):
        content = token_files.file_bytes([3, 4, 5, 6, 9], [d.tobytes() for d in docs], width)
        file = token_files.TokenFile(content + b"\n")
        for k in (4, 0, 2):
            assert file.document(k).tolist() == docs[k].tolist()
        assert [d.tolist() for d in file.documents()] == [d.tolist() for d in docs]
    with pytest.raises(ValueError):
        token_files.TokenFile(content)


@pytest.fixture(scope="module")
def documents(spark):
    rows = [(i * 3, t, "e", 5) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string, length int")


def test_token_files_query(spark, documents, tmp_path, monkeypatch):
    from riskgraph.llm import queries
    nameless = [(None, t, "e", 5) for t in ("a b", "c d e", None)]
    documents.unionAll(spark.createDataFrame(nameless, documents.schema)).write.parquet(
        str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(token_files, "FILE_IDS", 900)
    got = queries.QUERIES["op9_token_files"](spark, str(tmp_path)).collect()
    start, want = 0, []
    for doc_id, t in [*((i * 3, t) for i, t in enumerate(TEXTS)), (None, None), (None, "a b"),
                      (None, "c d e")]:
        ids = np.array(ids_of(BYTES, t, 0), "<u4")
        want.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want
    none = spark.createDataFrame([], "doc_id long, text string")
    token_files.write_token_files(none, str(tmp_path / "none"), BYTES)
    rows = token_files.read_token_files(spark, str(tmp_path / "none"))
    assert token_files.with_global_start(rows).count() == 0


def test_packing_query(spark, documents, tmp_path):
    from riskgraph.llm import queries
    documents.union(documents.withColumn("doc_id", F.col("doc_id") + 1000)).write.parquet(
        str(tmp_path / "documents.parquet"))
    rows = queries.QUERIES["op3_packing"](spark, str(tmp_path)).collect()
    ids = {i * 3: np.array(ids_of(WORDS, t, 1), "<u4") for i, t in enumerate(TEXTS)}
    ids |= {k + 1000: v for k, v in ids.items()}
    for k, v in ids.items():
        own = sorted((r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows
                     if r.doc_id == k)
        at = 0
        for start, length, crc, total in own:
            assert (start, total, length <= 2048) == (at, len(v), True)
            assert crc == zlib.crc32(v[start:start + length].tobytes())
            at += length
        assert at == len(v)
    places = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sorted(places) == list(range(len(places)))
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 2048
    none = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(packing.pieces(none, WORDS).drop("ids")).count() == 0


def test_packed_sequences_hold_the_ids(spark, documents):
    packed = packing.pack(packing.pieces(documents, WORDS))
    for s in packing.sequences(packed).collect():
        want = b"".join(
            np.array(ids_of(WORDS, TEXTS[d // 3], 1)[a:a + n], "<u4").tobytes()
            for d, a, n in zip(s.doc_ids, s.starts, s.lengths))
        assert bytes(s.ids) == want


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 50), min_size=1))
def test_patterns_hold_the_histogram(counts):
    patterns = packing.packing_patterns(counts, 64)
    seen = dict.fromkeys(counts, 0)
    for repeats, lengths in patterns:
        assert sum(lengths) <= 64 and lengths == sorted(lengths, reverse=True)
        for n in lengths:
            seen[n] += repeats
    assert seen == counts


def one_by_one(counts, size):
    """Fills of the packs when pieces are placed one after the other, the longest first, each in the
    shortest pack that was there before its length; new ones are opened when none has room."""
    packs = []
    for length in sorted(counts, reverse=True):
        opened = []
        for _ in range(counts[length]):
            room = [k for k, fill in enumerate(packs) if fill + length <= size]
            if room:
                packs[min(room, key=packs.__getitem__)] += length
            else:
                opened.append(length)
        packs += opened
    return sorted(packs)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 9), min_size=1))
def test_patterns_are_those_of_single_pieces(counts):
    patterns = packing.packing_patterns(counts, 40)
    fills = [sum(lengths) for repeats, lengths in patterns for _ in range(repeats)]
    assert sorted(fills) == one_by_one(counts, 40)


def test_padding_is_little():
    rng = np.random.default_rng(0)
    counts = {int(n): int(c) for n, c in zip(range(1, 2049), rng.integers(1, 60, 2048))}
    packs = sum(repeats for repeats, _ in packing.packing_patterns(counts, 2048))
    assert 1 - sum(n * c for n, c in counts.items()) / (packs * 2048) < 0.01


def test_ranks_of_a_hot_length(spark, monkeypatch):
    monkeypatch.setattr(packing, "RANK_ROWS", 10)
    rows = spark.range(300).select(F.col("id").alias("doc_id"), F.lit(0).alias("start"),
                                   F.when(F.col("id") < 200, 7).otherwise(F.col("id") % 3)
                                   .cast("long").alias("length"))
    got = packing.rank_in_length(rows, 300).collect()
    for n in (0, 1, 2, 7):
        ranks = sorted(r.rank for r in got if r.length == n)
        assert ranks == list(range(len(ranks)))


BIG = "<p>" + "x y " * 400
PAGES = [(1, "http://a/1", BIG), (2, "http://a/2", BIG), (5, None, BIG), (3, "u v\n", "short"),
         (4, "http://a/4", "short"), (6, "http://a/6", None), (7, "http://a/7", ""),
         (8, "http://a/8", "é" * 499), (9, "http://a/9", "é" * 499), (10, "h", "é" * 500),
         (11, "h", "é" * 500), (None, "h", "é" * 500), (None, "h", "y" * 1000),
         (None, "h", "y" * 1000), (5, "again", BIG),
         (12, "h", "WARC/1.1\r\n\r\nContent-Length: 3\r\n\r\n" * 50)]


def test_warc_query(spark, tmp_path, monkeypatch):
    from riskgraph.llm import queries
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 3000)
    spark.createDataFrame([(*p, "x") for p in PAGES],
                          "page_id long, url string, html string, digest string").write.parquet(
        str(tmp_path / "pages.parquet"))
    got = sorted((tuple(r) for r in queries.QUERIES["op6_warc"](spark, str(tmp_path)).collect()),
                 key=str)
    want = []
    for page_id, _, html in PAGES:
        data = (html or "").encode()
        same = [p for p, _, h in PAGES if (h or "").encode() == data and p is not None]
        last = max(same, default=None)
        revisit = len(data) >= 1000 and last is not None and page_id != last
        want.append((page_id, len(data), hashlib.sha1(data).hexdigest(),
                     "revisit" if revisit else "response", last if revisit else None))
    assert got == sorted(want, key=str)


def test_normalised_archives(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    mono, norm = str(tmp_path / "m"), str(tmp_path / "n")
    warc.write_monolithic(warc.plan_records(pages), mono, archive_bytes=4000)
    warc.normalise(spark, mono, norm, archive_bytes=2500)
    before = [gzip.decompress(bytes(r.content)) for r in files.read_files(spark, mono).collect()]
    content = {r.archive: bytes(r.content) for r in warc.archives_below(spark, norm).where(
        "kind = 'warc'").collect()}
    after = [gzip.decompress(c) for c in content.values()]
    assert sorted(b"".join(before)) == sorted(b"".join(after))
    index = warc.read_index(spark, norm).collect()
    assert len(index) == len(PAGES)
    for r in index:
        fields, record = warc.record_at(content[r.archive], r.offset, r.length)
        assert (fields["warc-record-id"], fields["warc-type"]) == (r.id, r.type)
        assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
    rows = {(r.page_id, r.url): r for r in warc.read_records(spark, norm).collect()}
    assert bytes(rows[10, "h"].payload or b"") == b"" and rows[10, "h"].refers_to == 11
    assert bytes(rows[11, "h"].payload) == ("é" * 500).encode()
    assert rows[3, "uv"].payload_bytes == 5


def test_streams_of_several_members_and_broken_ones():
    record = warc.record_bytes(1, "http://a", b"x" * 200_000, "00" * 20, None, "d")
    stream = gzip.compress(record) + gzip.compress(b"") + gzip.compress(record) + b"\0" * 9
    found = list(warc.split_records(warc.inflated(stream)))
    assert [r for _, r in found] == [record, record]
    for broken in (record[:-9], record[:30]):
        with pytest.raises(ValueError):
            list(warc.split_records([broken]))


def test_empty_pages(spark, tmp_path):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.round_trip(none, str(tmp_path / "w")).count() == 0
