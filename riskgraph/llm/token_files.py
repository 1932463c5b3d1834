"""Token files: ids packed at a fixed number of bits, in blocks that can be read on their own.

Layout of a file, all integers little-endian:

* block 0, block 1, ...: ``BLOCK_IDS`` ids each (the last may be shorter), ``bits`` bits per id,
  least significant bit first, each block filled up to whole bytes;
* footer: document ids (int64), first id of each document and the end (uint64), byte offset of
  each block and the end (uint64);
* tail: documents, blocks, ids (uint64 each), bits (uint8), ``MAGIC``, line feed.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from riskgraph.llm.files import read_files, write_files
from riskgraph.llm.memory import as_task
from riskgraph.llm.token_ids import token_coder
from riskgraph.sources.staging import stage

BLOCK_IDS = 1 << 16
FILE_IDS = 1 << 21
# Stands for a null doc_id in a file.
NO_ID = -(1 << 63)
# Pieces that a worker remembers; more than elsewhere, as a task holds little besides.
CACHE_PIECES = 1_200_000
MAGIC = b"FIXBITS1"
TAIL = struct.Struct("<QQQB8s")
END = b"\n"


def bits_for(vocabulary_size: int) -> int:
    """The fewest bits that hold every id of a vocabulary."""
    return max(1, (vocabulary_size - 1).bit_length())


def pack_bits(ids: np.ndarray, bits: int) -> bytes:
    """Ids below 2**bits, ``bits`` bits each. Eight ids fill ``bits`` whole bytes."""
    n = len(ids)
    lanes = np.zeros((-(-n // 8), 8), np.uint64)
    lanes.reshape(-1)[:n] = ids
    out = np.zeros((len(lanes), bits), np.uint8)
    for lane in range(8):
        byte, shift = divmod(lane * bits, 8)
        value = lanes[:, lane] << np.uint64(shift)
        for k in range(byte, (lane * bits + bits - 1) // 8 + 1):
            out[:, k] |= (value >> np.uint64(8 * (k - byte))).astype(np.uint8)
    return out.tobytes()[:-(-n * bits // 8)]


def unpack_bits(data: bytes, n: int, bits: int) -> np.ndarray:
    """The first ``n`` ids of a packed block, as uint32."""
    groups = -(-n // 8)
    raw = np.zeros(groups * bits, np.uint8)
    raw[:len(data)] = np.frombuffer(data, np.uint8)[:groups * bits]
    raw = raw.reshape(groups, bits)
    out = np.empty((groups, 8), np.uint32)
    mask = np.uint64((1 << bits) - 1)
    for lane in range(8):
        byte, shift = divmod(lane * bits, 8)
        value = np.zeros(groups, np.uint64)
        for k in range(byte, (lane * bits + bits - 1) // 8 + 1):
            value |= raw[:, k].astype(np.uint64) << np.uint64(8 * (k - byte))
        out[:, lane] = (value >> np.uint64(shift)) & mask
    return out.reshape(-1)[:n]


def file_bytes(doc_ids: list[int], documents: list[bytes], bits: int) -> bytes:
    """One file (without the end mark) of documents given as little-endian uint32 ids."""
    ids = np.frombuffer(b"".join(documents), "<u4")
    starts = np.cumsum([0] + [len(d) // 4 for d in documents]).astype("<u8")
    blocks = [pack_bits(ids[i:i + BLOCK_IDS], bits) for i in range(0, len(ids), BLOCK_IDS)]
    offsets = np.cumsum([0] + [len(b) for b in blocks]).astype("<u8")
    return b"".join([*blocks, np.array(doc_ids, "<i8").tobytes(), starts.tobytes(),
                     offsets.tobytes(),
                     TAIL.pack(len(doc_ids), len(blocks), len(ids), bits, MAGIC)])


class TokenFile:
    """Random access to the bytes of a token file."""

    def __init__(self, content: bytes) -> None:
        if not content.endswith(END):
            raise ValueError("token file without its end mark")
        tail = len(content) - len(END) - TAIL.size
        docs, blocks, self.n_ids, self.bits, magic = TAIL.unpack_from(content, tail)
        if magic != MAGIC:
            raise ValueError("not a token file")
        at = tail - 8 * (2 * docs + 1 + blocks + 1)
        self.doc_ids = np.frombuffer(content, "<i8", docs, at)
        self.starts = np.frombuffer(content, "<u8", docs + 1, at + 8 * docs).astype(np.int64)
        self.offsets = np.frombuffer(
            content, "<u8", blocks + 1, at + 8 * (2 * docs + 1)).astype(np.int64)
        self.content = content

    def ids(self, start: int, end: int) -> np.ndarray:
        """Ids ``start`` to ``end`` (exclusive); only the blocks that hold them are unpacked."""
        if end <= start:
            return np.empty(0, np.uint32)
        first, last = start // BLOCK_IDS, (end - 1) // BLOCK_IDS
        parts = [unpack_bits(self.content[self.offsets[b]:self.offsets[b + 1]],
                             min(BLOCK_IDS, self.n_ids - b * BLOCK_IDS), self.bits)
                 for b in range(first, last + 1)]
        return np.concatenate(parts)[start - first * BLOCK_IDS:end - first * BLOCK_IDS]

    def document(self, k: int) -> np.ndarray:
        return self.ids(int(self.starts[k]), int(self.starts[k + 1]))

    def documents(self) -> Iterator[np.ndarray]:
        """All documents in order; each block is unpacked once."""
        ids = self.ids(0, self.n_ids)
        for a, b in zip(self.starts[:-1], self.starts[1:]):
            yield ids[a:b]


def write_token_files(docs: DataFrame, path: str, vocabulary: str, end_id: int = 0,
                      file_ids: int | None = None) -> None:
    """Encode every whole text, append ``end_id`` and write token files in order of doc_id.

    Null text is empty. Rows with a null doc_id come after all others; the files hold ``NO_ID`` in
    its place, the least 64-bit integer, which is therefore no id of a document. Texts are shuffled
    once, by ranges of doc_id; a task holds one file of ``file_ids`` ids (``FILE_IDS`` by default).
    """
    from tokenizers import Tokenizer
    bits = bits_for(max(Tokenizer.from_file(vocabulary).get_vocab_size(), end_id + 1))
    end = end_id.to_bytes(4, "little")
    file_ids = file_ids or FILE_IDS

    @as_task
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = token_coder(vocabulary, CACHE_PIECES)
        doc_ids, documents, size = [], [], 0
        for batch in batches:
            for doc_id, ids in zip(batch["doc_id"].to_pylist(), coder.encode(batch["text"])):
                doc_ids.append(doc_id)
                documents.append(ids + end)
                size += len(documents[-1]) // 4
                if size >= file_ids:
                    yield one_file(doc_ids, documents)
                    doc_ids, documents, size = [], [], 0
        if doc_ids:
            yield one_file(doc_ids, documents)

    def one_file(doc_ids: list[int], documents: list[bytes]) -> pa.RecordBatch:
        content = pa.array([file_bytes(doc_ids, documents, bits)], pa.binary())
        return pa.RecordBatch.from_arrays([content], ["content"])

    by = ["nameless", "doc_id", "text"]
    ordered = (docs.select(F.col("doc_id").isNull().alias("nameless"),
                           F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"),
                           "text")
               .repartitionByRange(*by[:2]).sortWithinPartitions(*by).select("doc_id", "text"))
    write_files(ordered.mapInArrow(encode, "content binary"), path, END)


def little_endian(ids: np.ndarray) -> bytes:
    return ids.astype("<u4").tobytes()


def read_token_files(spark: SparkSession, path: str, value: Callable = little_endian,
                     kind: str = "binary") -> DataFrame:
    """(part, chunk, doc_id, at, n_tokens, value): documents of the files below ``path``.

    ``part`` and ``chunk`` number the files, ``at`` counts the ids before the document in its
    file (see ``with_global_start``). ``value`` is made from a document's ids where they are
    unpacked and has the SQL type ``kind``; by default it is the ids as little-endian uint32.
    """
    @as_task
    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part, chunk, content in zip(batch["part"], batch["chunk"], batch["content"]):
                file = TokenFile(content)
                yield pd.DataFrame({
                    "part": part, "chunk": chunk, "doc_id": file.doc_ids,
                    "at": file.starts[:-1], "n_tokens": np.diff(file.starts),
                    "value": [value(d) for d in file.documents()]})

    name = F.regexp_extract
    files = read_files(spark, path).select(
        name("path", r"/part-(\d+)-[^/]*$", 1).cast("long").alias("part"),
        name("path", r"-c(\d+)\.[a-z]+$", 1).cast("long").alias("chunk"), "content")
    rows = files.mapInPandas(
        decode, f"part long, chunk long, doc_id long, at long, n_tokens long, value {kind}")
    return rows.withColumn("doc_id", F.nullif(F.col("doc_id"), F.lit(NO_ID)))


def with_global_start(rows: DataFrame) -> DataFrame:
    """Replace file-wise places by ``start``, the ids of all documents before, over all files.

    One row per file goes through the running total; documents are joined to it by file.
    """
    rows = stage(rows, "token-rows")
    totals = rows.groupBy("part", "chunk").agg(F.sum("n_tokens").alias("n"))
    before = F.sum("n").over(Window.orderBy("part", "chunk")) - F.col("n")
    return (rows.join(totals.select("part", "chunk", before.alias("before")), ["part", "chunk"])
            .withColumn("start", F.col("before") + F.col("at"))
            .drop("part", "chunk", "before", "at"))
