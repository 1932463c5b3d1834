"""WARC archives: writing, and normalising whole-file gzip streams to one member per record.

A normalised archive holds one gzip member per record and an empty member at its end. Its sidecar
lies in the neighbour folder: one JSON line per record with offset and length of the member.
"""

from __future__ import annotations

import base64
import hashlib
import json
import zlib
from collections.abc import Iterable, Iterator
from uuid import uuid4

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from riskgraph.llm.files import read_files, write_files
from riskgraph.llm.memory import as_task

#: Equal payloads of at least so many bytes are stored once and revisited.
REVISIT_BYTES = 1000
#: Uncompressed bytes of records after which a task begins the next archive.
ARCHIVE_BYTES = 24 << 20
INFLATE_BYTES = 1 << 16
#: An empty gzip member, the end mark of every archive.
END_MEMBER = bytes.fromhex("1f8b08000000000000ff03000000000000000000")
GZIP = 16 + zlib.MAX_WBITS
BLANK = b"\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SALTS = 16


def plan_records(pages: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """(page_id, url, html, digest, refers_to): ``refers_to`` is set for revisits only.

    Of equal payloads of at least ``least`` bytes the largest page_id is the response; rows that
    repeat that page_id are responses too. A row without page_id is a revisit of that response,
    or a response if no equal payload has an id. Digests are counted map-side; a payload that
    very many pages share meets its response in ``SALTS`` tasks.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", "url", html.alias("html"), F.sha1(html.cast("binary"))
                        .alias("digest"), F.octet_length(html).alias("bytes"))
    shared = (rows.where(F.col("bytes") >= least).groupBy("digest")
              .agg(F.count(F.lit(1)).alias("n"), F.max("page_id").alias("response"))
              .where("n > 1 and response is not null").select("digest", "response"))
    salted = shared.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    spread = F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int")
    other = ~F.col("page_id").eqNullSafe(F.col("response")) & F.col("response").isNotNull()
    return (rows.withColumn("salt", spread).join(salted, ["digest", "salt"], "left")
            .select("page_id", "url", "html", "digest",
                    F.when(other, F.col("response")).alias("refers_to")))


def _urn(page_id: int | None) -> str:
    return "<urn:page:none>" if page_id is None else f"<urn:page:{page_id}>"


def _page(urn: str) -> int | None:
    name = urn.strip("<>").rsplit(":", 1)[1]
    return None if name == "none" else int(name)


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str,
                 refers_to: int | None, date: str) -> bytes:
    """One WARC/1.1 record; a revisit has the HTTP head of the full payload and no payload."""
    head = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}").encode() + BLANK
    block = head + payload if refers_to is None else head
    uri = "".join(url.split()) if url and url.strip() else _urn(page_id).strip("<>")
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
             f"WARC-Record-ID: {_urn(page_id)}", f"WARC-Date: {date}", f"WARC-Target-URI: {uri}",
             f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
             "Content-Type: application/http; msgtype=response",
             f"Content-Length: {len(block)}"]
    if refers_to is not None:
        lines[2:2] = [f"WARC-Refers-To: {_urn(refers_to)}", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join(lines).encode() + BLANK + block + BLANK


def write_monolithic(records: DataFrame, path: str, date: str = "1970-01-01T00:00:00Z",
                     archive_bytes: int | None = None, level: int = 1) -> None:
    """Write records (page_id, url, html, digest, refers_to) as whole-file gzip streams.

    A null html is an empty payload. A task holds one compressed archive and one record.
    """
    archive_bytes = archive_bytes or ARCHIVE_BYTES

    @as_task
    def archives(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts, size, gzip = [], 0, None
        for batch in batches:
            for page_id, url, html, digest, refers in batch.itertuples(index=False, name=None):
                record = record_bytes(None if pd.isna(page_id) else int(page_id), url,
                                      (html or "").encode(), digest,
                                      None if pd.isna(refers) else int(refers), date)
                gzip = gzip or zlib.compressobj(level, zlib.DEFLATED, GZIP)
                parts.append(gzip.compress(record))
                size += len(record)
                if size >= archive_bytes:
                    yield pd.DataFrame({"content": [b"".join([*parts, gzip.flush()])]})
                    parts, size, gzip = [], 0, None
        if gzip:
            yield pd.DataFrame({"content": [b"".join([*parts, gzip.flush()])]})

    ids = records.select(F.col("page_id").cast("string"), "url", "html", "digest",
                         F.col("refers_to").cast("string"))
    write_files(ids.mapInPandas(archives, "content binary"), path, END_MEMBER)


def inflated(content: bytes) -> Iterator[bytes]:
    """The bytes of a gzip file of one or more members, in bounded parts."""
    at, gzip = 0, zlib.decompressobj(GZIP)
    while at < len(content):
        part = content[at:at + INFLATE_BYTES]
        at += len(part)
        while part:
            out = gzip.decompress(part, 4 * INFLATE_BYTES)
            if out:
                yield out
            if gzip.eof:
                part, gzip = gzip.unused_data, zlib.decompressobj(GZIP)
                if not part.strip(b"\0"):  # padding
                    part = b""
            else:
                part = gzip.unconsumed_tail
                if not part and not out:
                    break


def split_records(parts: Iterable[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, whole record) of a stream of WARC records, reading each byte once."""
    buffer, at = bytearray(), 0
    stream = iter(parts)

    def fill() -> bool:
        part = next(stream, None)
        if part is not None:
            buffer.extend(part)
        return part is not None

    while True:
        searched = at
        while (end := buffer.find(BLANK, max(at, searched - 3))) < 0:
            searched = len(buffer)
            if not fill():
                if buffer[at:].strip():
                    raise ValueError("the archive ends within a record's header")
                return
        lines = buffer[at:end].decode("utf-8", "replace").lstrip().split("\r\n")
        fields = {k.strip().lower(): v.strip() for k, _, v in
                  (line.partition(":") for line in lines[1:])}
        if not lines[0].startswith("WARC/") or "content-length" not in fields:
            raise ValueError("not a WARC record")
        stop = end + 2 * len(BLANK) + int(fields["content-length"])
        while len(buffer) < stop:
            if not fill():
                raise ValueError("the archive ends within a record")
        yield fields, bytes(buffer[at:stop])
        at = stop
        if at > INFLATE_BYTES:
            del buffer[:at]
            at = 0


def normalise(spark: SparkSession, source: str, target: str,
              archive_bytes: int | None = None, level: int = 6) -> None:
    """Rewrite the archives below ``source`` with one gzip member per record, below ``target``.

    Each stream is inflated once, in parts. Archives and sidecars are written by the same tasks
    and committed together, as ``archive=<id>/kind=warc`` and ``archive=<id>/kind=index``. A file
    is read as one value, which Spark bounds at 2 GB compressed; a new archive is begun after
    ``archive_bytes``, however long the source is.
    """
    archive_bytes = archive_bytes or ARCHIVE_BYTES

    @as_task
    def rewrite(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                members, index, size, raw = [], [], 0, 0
                for fields, record in split_records(inflated(content)):
                    gzip = zlib.compressobj(level, zlib.DEFLATED, GZIP)
                    member = gzip.compress(record) + gzip.flush()
                    index.append(json.dumps({"id": fields.get("warc-record-id"),
                                             "type": fields.get("warc-type"),
                                             "offset": size, "length": len(member)}))
                    members.append(member)
                    size, raw = size + len(member), raw + len(record)
                    if raw >= archive_bytes:
                        yield pair(members, index)
                        members, index, size, raw = [], [], 0, 0
                if members:
                    yield pair(members, index)

    def pair(members: list[bytes], index: list[str]) -> pd.DataFrame:
        gzip = zlib.compressobj(level, zlib.DEFLATED, GZIP)
        sidecar = gzip.compress("\n".join(index).encode()) + gzip.flush()
        return pd.DataFrame({"archive": uuid4().hex, "kind": ["warc", "index"],
                             "content": [b"".join(members), sidecar]})

    files = read_files(spark, source).select("content")
    write_files(files.mapInPandas(rewrite, "archive string, kind string, content binary"),
                target, END_MEMBER, by=("archive", "kind"))


def member_at(content: bytes, offset: int) -> tuple[bytes, int]:
    """The inflated member that begins at ``offset``, and where it ends."""
    parts, at, gzip = [], offset, zlib.decompressobj(GZIP)
    while not gzip.eof:
        part = content[at:at + INFLATE_BYTES]
        if not part:
            raise ValueError("the archive ends within a member")
        parts.append(gzip.decompress(part))
        at += len(part)
    return b"".join(parts), at - len(gzip.unused_data)


def record_at(content: bytes, offset: int, length: int) -> tuple[dict[str, str], bytes]:
    """Random access: the record whose member lies at ``offset``."""
    record = zlib.decompress(content[offset:offset + length], GZIP)
    return next(split_records([record]))


def archives_below(spark: SparkSession, path: str) -> DataFrame:
    folder = r"/archive=([^/]+)/kind=([^/]+)/"
    return read_files(spark, path).withColumns({
        "archive": F.regexp_extract("path", folder, 1),
        "kind": F.regexp_extract("path", folder, 2)})


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """(archive, id, type, offset, length) from the sidecars of normalised archives."""
    def lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for archive, content in zip(batch["archive"], batch["content"]):
                text = b"".join(inflated(content)).decode()
                rows = pd.DataFrame([json.loads(line) for line in text.split("\n")])
                yield rows.assign(archive=archive)[["archive", "id", "type", "offset", "length"]]

    files = archives_below(spark, path).where("kind = 'index'").select("archive", "content")
    return files.mapInPandas(
        lines, "archive string, id string, type string, offset long, length long")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """(archive, offset, page_id, url, record_type, refers_to, payload, payload_bytes,
    payload_digest) of normalised archives, member by member.

    ``payload`` is null for revisits; its size and digest are those of the full payload. The
    digest of a response is computed from its payload and must agree with the header.
    """
    @as_task
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for archive, content in zip(batch["archive"], batch["content"]):
                yield pd.DataFrame(members(archive, content), columns=names)

    def members(archive: str, content: bytes) -> Iterator[tuple]:
        at = 0
        while at < len(content) - len(END_MEMBER):
            record, end = member_at(content, at)
            fields, record = next(split_records([record]))
            head, _, rest = record.partition(BLANK)[2].partition(BLANK)
            http = dict(line.lower().split(": ", 1) for line in
                        head.decode().split("\r\n")[1:])
            digest = base64.b32decode(
                fields["warc-payload-digest"].removeprefix("sha1:")).hex()
            size = int(http["content-length"])
            refers, payload = fields.get("warc-refers-to"), None
            if refers is None:
                payload = rest[:size]
                if hashlib.sha1(payload).hexdigest() != digest:
                    raise ValueError(f"digest of {fields['warc-record-id']} differs")
            page_id = _page(fields["warc-record-id"])
            yield (archive, at, None if page_id is None else str(page_id),
                   fields["warc-target-uri"], fields["warc-type"],
                   None if refers is None else str(_page(refers)), payload, size, digest)
            at = end

    names = ["archive", "offset", "page_id", "url", "record_type", "refers_to", "payload",
             "payload_bytes", "payload_digest"]
    files = archives_below(spark, path).where("kind = 'warc'").select("archive", "content")
    found = files.mapInPandas(rows, (
        "archive string, offset long, page_id string, url string, record_type string, "
        "refers_to string, payload binary, payload_bytes long, payload_digest string"))
    return found.withColumns({c: F.col(c).cast("long") for c in ("page_id", "refers_to")})


def round_trip(pages: DataFrame, folder: str) -> DataFrame:
    """Write ``pages`` below ``folder`` as whole-file streams, normalise them and read them back.

    Each record read must lie where the sidecar says. An empty table gives an empty table.
    """
    spark = pages.sparkSession
    write_monolithic(plan_records(pages), f"{folder}/monolithic")
    normalise(spark, f"{folder}/monolithic", f"{folder}/records")
    rows = read_records(spark, f"{folder}/records")
    index = read_index(spark, f"{folder}/records").select("archive", "offset", "length")
    return rows.join(index, ["archive", "offset"], "left").withColumn(
        "length", F.coalesce("length", F.expr("raise_error('record missing in the sidecar')")))
