"""Removal of repeated byte strings by bucket-pointer refinement of sparse suffixes.

Every string of ``LENGTH`` bytes is a suffix start; where it begins, it owns one anchor, the least
q-gram inside it, so equal strings own equal anchors at equal distances. Starts in a row with the
same anchor are one unit.

1. Initial buckets: units by the bucket identifier of the q-gram at their anchor. Identifiers of
   longer strings come from those at later offsets, id(2k)[p] = (id(k)[p], id(k)[p + k]), and are
   reused for the next length. Buckets with one unit hold nothing repeated and go.
2. Refinement: a bucket's units are split by the identifiers of the first and last string they
   begin, which together see all bytes of the unit. Equal units repeat each other start by start,
   so only the first of each kind is refined on.
3. Buckets in which kinds still differ are refined to the identifiers of the single strings, dealt
   out by identifier where a bucket is large; the first start of each string is new. A task sends
   each string of a bucket once for all the units it looks at together, and the strings of a bucket
   are read in order, so that only the identifiers met so far are held.

A start in a bucket of step 1 that is not new repeats an earlier one, and its bytes are removed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from riskgraph.llm.memory import as_task
from riskgraph.sources.staging import broadcast_below, stage, unstage

LENGTH, GRAM = 100, 32
#: Starts worked on at a time; places fit into PLACE_BITS bits.
CHUNK, PLACE_BITS = 1 << 17, 20
#: Kinds of a bucket that one task refines together; more are dealt out by identifier.
KINDS = 1024
#: Bits of the number of shares of a bucket, and units whose strings a task sorts together.
SHARE_BITS, UNITS = 24, 4_000
#: Rows up to which documents' units and spans are broadcast to the texts.
BROADCAST_ROWS = 2_000_000

_RNG = np.random.default_rng(100)
BYTE_IDS = _RNG.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
STEPS = _RNG.integers(0, 1 << 62, 64, dtype=np.uint64) * np.uint64(4) + np.uint64(1)
MIX = np.array([0xBF58476D1CE4E5B9, 0x94D049BB133111EB], np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX[0]
    x = (x ^ (x >> np.uint64(27))) * MIX[1]
    return x ^ (x >> np.uint64(31))


def identifiers(data: np.ndarray, lengths: tuple[int, ...]) -> list[np.ndarray]:
    """Bucket identifiers of the strings of each length at every place, mixed.

    The identifier of a length is put together from its powers of two, each taken at its offset.
    """
    ids = {1: BYTE_IDS[data]}
    while 2 * max(ids) <= max(lengths):
        k = max(ids)
        ids[2 * k] = ids[k][:-k] * STEPS[k.bit_length()] + ids[k][k:]
    out = []
    for length in lengths:
        whole, offset = None, 0
        for k in sorted(ids, reverse=True):
            if length & k:
                part = ids[k][offset:len(data) - length + offset + 1]
                whole = (part if whole is None else
                         whole[:len(part)] * STEPS[32 + k.bit_length()] + part)
                offset += k
        out.append(_mixed(whole[:len(data) - length + 1]))
    return out


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """Least value of each window of ``width`` values."""
    k, n = 1, len(x) - width + 1
    while 2 * k <= width:
        x = np.minimum(x[:-k], x[k:])
        k *= 2
    return np.minimum(x[:n], x[width - k:width - k + n])


def units(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
    """(bucket, kind, document, start, length) of the units of documents laid end to end.

    ``bounds`` has the first byte of each document and the end. Chunks may cut a unit in two,
    which splits a kind but no string.
    """
    mask = np.uint64((1 << PLACE_BITS) - 1)
    found = []
    for first in range(0, len(data) - LENGTH + 1, CHUNK):
        part = data[first:first + CHUNK + LENGTH - 1]
        gram, string = identifiers(part, (GRAM, LENGTH))
        key = (gram & ~mask) | np.arange(len(gram), dtype=np.uint64)
        anchor = (_least(key, LENGTH - GRAM + 1) & mask).astype(np.int64)
        n = len(anchor)
        inside = np.ones(n + 1, bool)  # false where a string would cross documents, and at the end
        inside[n] = False
        own = bounds[np.searchsorted(bounds, first):
                     np.searchsorted(bounds, first + n + LENGTH)] - first
        for end in own:
            inside[max(end - LENGTH + 1, 0):max(min(end, n), 0)] = False
        begins = inside[:n] & np.append(True, (anchor[1:] != anchor[:-1]) | ~inside[:n - 1])
        lo = np.flatnonzero(begins)
        if not len(lo):
            continue
        breaks = np.flatnonzero(np.append(begins | ~inside[:n], True))
        hi = breaks[np.searchsorted(breaks, lo, "right")] - 1
        distance = (anchor[lo] - lo).astype(np.uint64)
        kind = _mixed(string[lo] * STEPS[1] + string[hi] + distance * STEPS[2]
                      + (hi - lo).astype(np.uint64) * STEPS[3])
        place = lo + first
        doc = np.searchsorted(bounds, place, "right") - 1
        found.append((gram[anchor[lo]], kind, doc, place - bounds[doc], hi - lo + 1))
    if not found:
        return tuple(np.empty(0, t) for t in (np.uint64, np.uint64, int, int, int))
    return tuple(np.concatenate(x) for x in zip(*found))


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of an Arrow array of strings, end to end, and the bounds of each string."""
    return _flat(pc.fill_null(texts, "").cast(pa.large_binary()))


def _flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of an Arrow array of large binaries, end to end, and the bounds of each."""
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[
        texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[bounds[0]:bounds[-1]], bounds - bounds[0]


def _find_units(docs: DataFrame) -> DataFrame:
    """(bucket, kind, doc_id, start, n, again): units of all documents. ``again`` marks those of
    a kind that began earlier in their document; they repeat it whatever else there is."""
    @as_task
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = _bytes_of(batch["text"])
            bucket, kind, doc, start, n = units(data, bounds)
            whole = _mixed(bucket * STEPS[4] + kind) + doc.astype(np.uint64) * STEPS[5]
            again = np.ones(len(whole), bool)
            again[np.unique(whole, return_index=True)[1]] = False
            ids = batch["doc_id"].to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket.view(np.int64)), pa.array(kind.view(np.int64)),
                 pa.array(ids[doc].astype(np.int64)), pa.array(start.astype(np.int32)),
                 pa.array(n.astype(np.int32)), pa.array(again)],
                ["bucket", "kind", "doc_id", "start", "n", "again"])

    return docs.select("doc_id", "text").mapInArrow(
        find, "bucket long, kind long, doc_id long, start int, n int, again boolean")


def _strings(kinds: DataFrame, docs: DataFrame) -> DataFrame:
    """(bucket, share, doc_id, start, ids, places): identifiers of the strings that the first unit
    of each kind begins, dealt out over the bucket's shares by identifier. Of the strings alike in
    units that are looked at together only the first is left."""
    place = F.expr(f"shiftleft(cast(start as bigint) * 128 + n, {SHARE_BITS}) + shares")
    units = F.flatten(F.transform("u", lambda u: F.array(u["bucket"], u["place"])))
    own = stage(kinds.groupBy("doc_id").agg(
        F.collect_list(F.struct("bucket", place.alias("place"))).alias("u")).select(
        "doc_id", units.alias("units")), "kinds-of-documents")
    texts = docs.select("doc_id", "text").join(
        broadcast_below(own, BROADCAST_ROWS, "units"), "doc_id")

    @as_task
    def refine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = _bytes_of(batch["text"])
            ids = batch["doc_id"].to_pylist()
            rows: list[tuple] = []
            for k, found in enumerate(batch["units"].to_pylist()):
                text = data[bounds[k]:bounds[k + 1]]
                for bucket, place in zip(found[::2], found[1::2]):
                    shares, unit = place & (1 << SHARE_BITS) - 1, place >> SHARE_BITS
                    start, n = unit >> 7, unit & 127
                    rows.append((bucket, shares, ids[k], start, text[start:start + n + LENGTH - 1]))
                    if len(rows) >= UNITS:
                        yield dealt(rows)
                        rows = []
            yield dealt(rows)

    def dealt(rows: list[tuple]) -> pa.RecordBatch:
        out: list[tuple] = []
        if rows:
            sizes = np.array([len(r[4]) for r in rows])
            strings, = identifiers(np.concatenate([r[4] for r in rows]), (LENGTH,))
            counts = sizes - (LENGTH - 1)
            row = np.repeat(np.arange(len(rows)), counts)
            ends = np.cumsum(counts)
            place = np.arange(len(row)) - (ends - counts)[row]
            own = strings[(np.cumsum(sizes) - sizes)[row] + place]
            bucket, doc, start = (np.array([r[k] for r in rows], np.int64) for k in (0, 2, 3))
            order = np.lexsort((start[row] + place, doc[row], own, bucket[row]))
            same = ((own[order[1:]] == own[order[:-1]])
                    & (bucket[row[order[1:]]] == bucket[row[order[:-1]]]))
            first = np.ones(len(order), bool)
            first[order[1:][same]] = False
            for k, (of, shares, doc_id, at, _) in enumerate(rows):
                places = np.flatnonzero(first[ends[k] - counts[k]:ends[k]])
                ids = own[ends[k] - counts[k] + places]
                share = (ids % np.uint64(shares)).astype(np.int64)
                for s in [0] if shares == 1 and len(ids) else np.unique(share).tolist():
                    some = share == s
                    out.append((of, s, doc_id, at, ids[some].tobytes(),
                                places[some].astype(np.uint8).tobytes()))
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary())
        columns = list(zip(*out)) or [()] * len(kinds)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds)],
            ["bucket", "share", "doc_id", "start", "ids", "places"])

    return texts.mapInArrow(refine, "bucket long, share int, doc_id long, start int, ids binary, "
                                    "places binary")


def _new_starts(strings: DataFrame) -> DataFrame:
    """(doc_id, start, places): the starts whose string begins nowhere earlier."""
    by = ["bucket", "share", "doc_id", "start"]

    @as_task
    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, seen = None, np.empty(0, np.uint64)  # the group that may go on, its identifiers
        for batch in batches:
            if not batch.num_rows:
                continue
            bucket, share, doc, start = (batch[k].to_numpy(zero_copy_only=False) for k in by)
            ids = _flat(batch["ids"].cast(pa.large_binary()))[0].view(np.uint64)
            places, bounds = _flat(batch["places"].cast(pa.large_binary()))
            row = np.repeat(np.arange(len(doc)), np.diff(bounds))
            group = np.cumsum(np.append(False, (bucket[1:] != bucket[:-1])
                                        | (share[1:] != share[:-1])))
            of = group[row]
            order = np.lexsort((ids, of))  # rows alike stay in the order of their starts
            new = order[np.append(True, (ids[order[1:]] != ids[order[:-1]])
                                  | (of[order[1:]] != of[order[:-1]]))]
            if last != (bucket[0], share[0]):
                seen = seen[:0]
            new = new[(of[new] > 0) | ~np.isin(ids[new], seen)]
            own = ids[new[of[new] == group[-1]]]
            seen = np.append(seen, own) if group[-1] == 0 else own
            last = bucket[-1], share[-1]
            new.sort()
            cuts = np.searchsorted(row[new], np.arange(len(doc) + 1))
            some = np.flatnonzero(np.diff(cuts))
            found = places[new]
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc[some]), pa.array(start[some]),
                 pa.array([found[cuts[k]:cuts[k + 1]].tobytes() for k in some], pa.binary())],
                ["doc_id", "start", "places"])

    return (strings.repartition("bucket", "share").sortWithinPartitions(*by)
            .mapInArrow(first, "doc_id long, start int, places binary"))


def _marks(docs: DataFrame) -> DataFrame:
    """(doc_id, repeated, whole, parts): units in shared buckets as start * 128 + length, those of
    them that are new as a whole, and (start, places) of those that are new in part."""
    found = stage(_find_units(docs.where("doc_id is not null")), "units")
    once = found.where("not again")
    buckets = stage(once.groupBy("bucket").agg(F.count(F.lit(1)).alias("units")).where("units > 1")
                    .select("bucket"), "shared-buckets")
    code = (F.col("start").cast("long") * 128 + F.col("n")).alias("code")
    kept = stage(once.join(buckets, "bucket").drop("again"), "shared-units")
    again = stage(found.where("again").select("doc_id", code), "units-again")
    unstage(found)
    kinds = stage(kept.groupBy("bucket", "kind").agg(
        F.min_by("start", "doc_id").alias("start"), F.min_by("n", "doc_id").alias("n"),
        F.min("doc_id").alias("doc_id")), "kinds")
    sizes = kinds.groupBy("bucket").agg(F.count(F.lit(1)).alias("kinds"))
    sized = stage(kinds.join(stage(sizes, "bucket-sizes"), "bucket"), "sized-kinds")
    differing = sized.where("kinds > 1").withColumn(
        "shares", F.least(F.ceil(F.col("kinds") / KINDS), F.lit((1 << SHARE_BITS) - 1)).cast("int"))
    parts = _new_starts(_strings(differing, docs))
    repeated = (kept.select("doc_id", code).unionAll(again).groupBy("doc_id")
                .agg(F.collect_list("code").alias("repeated")))
    whole = (sized.where("kinds = 1").select("doc_id", code).groupBy("doc_id")
             .agg(F.collect_list("code").alias("whole")))
    parts = parts.groupBy("doc_id").agg(F.collect_list(F.struct("start", "places")).alias("parts"))
    return repeated.join(whole, "doc_id", "left").join(parts, "doc_id", "left")


def removed_spans(repeated: np.ndarray, whole: np.ndarray, parts: list | None) -> np.ndarray:
    """(first, end) of the runs of bytes that repeated strings cover, for one document's marks."""
    n = int(((repeated >> 7) + (repeated & 127)).max())
    starts = np.zeros(n + 1, np.int32)
    for codes, step in ((repeated, 1), (whole, -1)):
        np.add.at(starts, codes >> 7, step)
        np.add.at(starts, (codes >> 7) + (codes & 127), -step)
    dup = np.cumsum(starts[:n]) > 0
    for part in parts or ():
        dup[part["start"] + np.frombuffer(part["places"], np.uint8).astype(np.int64)] = False
    at = np.flatnonzero(dup)
    if not len(at):
        return np.empty((0, 2), np.int64)
    breaks = np.flatnonzero(np.diff(at) > LENGTH)
    first = at[np.append(0, breaks + 1)]
    return np.stack([first, at[np.append(breaks, len(at) - 1)] + LENGTH], axis=1)


def _lists(column: pa.Array) -> Iterator[np.ndarray]:
    """The lists of an Arrow column of numbers; a null list is empty."""
    bounds, values = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
    for a, b in zip(bounds[:-1], bounds[1:]):
        yield values[a:b]


def _spans(marks: DataFrame) -> DataFrame:
    """(doc_id, spans): the removed runs of each document as pairs of int64."""
    @as_task
    def cover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [removed_spans(*mark).astype("<i8").tobytes() for mark in zip(
                _lists(batch["repeated"]), _lists(batch["whole"]), batch["parts"].to_pylist())]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(spans, pa.binary())],
                                             ["doc_id", "spans"])

    return marks.mapInArrow(cover, "doc_id long, spans binary").where(F.octet_length("spans") > 0)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept): bytes of each text that stay.

    Texts are UTF-8 bytes, null ones empty. Each byte goes that a string of ``LENGTH`` bytes covers
    which also begins earlier: in a document of smaller doc_id, or earlier in the same one. Strings
    are judged on the input. ``kept`` may begin or end within a character. Rows that repeat doc_id
    and text are one document and get the same result each. Of a doc_id with several texts the one
    of the least ``xxhash64`` is the document. Rows with its other texts, like rows with a null
    doc_id, stay as they are and repeat nothing.
    """
    docs = docs.select("doc_id", "text", F.col("doc_id").alias("shown"))
    text = F.xxhash64(F.coalesce("text", F.lit("")))
    own = stage(docs.where("doc_id is not null").select("doc_id", text.alias("h")).groupBy("doc_id")
                .agg(F.min("h").alias("least"), F.max("h").alias("most"),
                     F.count(F.lit(1)).alias("n")).where("n > 1"), "repeated-ids")
    several = own.where("least <> most").select("doc_id", "least")
    repeated, odd = own.agg(F.count(F.lit(1)), F.count_if(F.col("least") != F.col("most"))).first()
    if odd:
        docs = docs.join(broadcast_below(several, BROADCAST_ROWS), "doc_id", "left").select(
            F.when(F.col("least").isNull() | (text == F.col("least")), F.col("doc_id"))
            .alias("doc_id"), "text", "shown")
    # Rows of one document take part once.
    once = docs.where("doc_id is not null").dropDuplicates(["doc_id"]) if repeated else docs
    spans = stage(_spans(_marks(once)), "spans")
    rows = docs.join(broadcast_below(spans, BROADCAST_ROWS, "spans"), "doc_id", "left")

    @as_task
    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = _bytes_of(batch["text"])
            out = []
            for k, marked in enumerate(batch["spans"].to_pylist()):
                own = data[bounds[k]:bounds[k + 1]]
                gone = np.frombuffer(marked or b"", "<i8").reshape(-1, 2)
                stay = zip(np.append(0, gone[:, 1]), np.append(gone[:, 0], len(own)))
                out.append((len(own), int((gone[:, 1] - gone[:, 0]).sum()), len(gone),
                            b"".join([own[a:b].tobytes() for a, b in stay])))
            columns = list(zip(*out)) or [()] * 4
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch["shown"], *(pa.array(c, t) for c, t in zip(columns, kinds))],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return rows.mapInArrow(
        remove, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
