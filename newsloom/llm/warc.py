"""WARC archives: writing with payload deduplication, and a salvage reader.

Archives are rows of (archive, body): ``body`` holds gzip members of one record
each, as in a ``.warc.gz`` file, and is bounded in bytes.  Spark has no binary
file sink, so they are stored as a Parquet table; files made elsewhere are read
with ``archive_files``.  The reader takes plain and gzipped records; after a
failed check it searches for the next member or version line that parses,
goes on there, and logs the bytes in between as a quarantined gap.  A member of
several records is searched in the same way inside its unpacked bytes, as far
as they can be had, and its gaps carry their place in there.

Defined cases: a null payload is empty; rows with the same id and payload are
all written, alike; a null id never is the largest (if a payload has no other
id, its rows are responses without an id); equal payloads shorter than the
least size are all responses; an empty table gives no archives; a damaged
archive gives the records that are whole and one gap per damaged stretch; in a
member that does not unpack, only records with a block digest that fits count,
and a lone record is given up, as it must hold the damage.
Other columns are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage

ARCHIVE_BYTES = 4 << 20
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_START = re.compile(rb"\x1f\x8b\x08|WARC/1\.[01]\r\n")
_MEMBER, _LINE = re.compile(rb"\x1f\x8b\x08"), re.compile(rb"WARC/1\.[01]\r\n")
_BROKEN = "member does not unpack"
_WRITTEN = datetime(2026, 1, 1, tzinfo=timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


# --- writing ---------------------------------------------------------------

def record(headers: list[tuple[str, str]], block: bytes, level: int = 1) -> bytes:
    """One record as a gzip member."""
    lines = [VERSION, *(f"{k}: {v}".encode() for k, v in headers),
             b"Content-Length: %d" % len(block), b"", b""]
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(b"\r\n".join(lines) + block + b"\r\n\r\n") + packer.flush()


def _page_record(page_id, url: str | None, payload: bytes, digest: str, refers_to) -> bytes:
    revisit = refers_to is not None
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            b"Content-Length: %d\r\n\r\n" % len(payload))
    block = http if revisit else http + payload
    headers = [("WARC-Type", "revisit" if revisit else "response"),
               ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
               ("WARC-Date", _WRITTEN),
               ("WARC-Target-URI", re.sub(r"\s", "%20", url or "")),
               ("Content-Type", "application/http; msgtype=response"),
               ("WARC-Payload-Digest", f"sha1:{digest}"),
               ("WARC-Block-Digest", f"sha1:{sha1_base32(block)}")]
    if revisit:
        headers += [("WARC-Profile", REVISIT_PROFILE),
                    ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    return record(headers, block)


def archives(pages: DataFrame, least_bytes: int = 0, id_column: str = "page_id",
             url_column: str = "url", payload_column: str = "html",
             archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """(archive, body) rows that hold one record per page.

    Of equal payloads of ``least_bytes`` or more, the page with the largest id
    is stored; the others refer to it.  Payload copies meet only as digests:
    one row per task and digest, so a page with very many copies is no burden.
    """
    payload = F.coalesce(F.col(payload_column), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_column).alias("page_id"), F.col(url_column).alias("url"),
                        payload.alias("payload")).withColumn("sha1", F.sha1("payload"))
    ids = rows.select("page_id", "sha1", (F.length("payload") >= least_bytes).alias("large"))
    stored = (ids.where("large").groupBy("sha1")
              .agg(F.max("page_id").alias("stored_id"), F.count("*").alias("times"))
              .where("times > 1").select("sha1", "stored_id"))
    decided = (ids.distinct().join(stored, "sha1")
               .where(~F.col("page_id").eqNullSafe(F.col("stored_id")))
               .select(F.col("page_id").alias("copy_id"), F.col("sha1").alias("copy_sha1"),
                       "stored_id"))
    planned = (rows.join(decided, F.col("page_id").eqNullSafe(F.col("copy_id"))
                         & (F.col("sha1") == F.col("copy_sha1")), "left")
               .select("page_id", "url", "payload", "stored_id"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        body: list[bytes] = []
        size = 0

        def archive() -> pa.RecordBatch:
            whole = b"".join(body)
            return pa.RecordBatch.from_arrays(
                [pa.array([hashlib.sha1(whole).hexdigest()]), pa.array([whole], pa.binary())],
                ["archive", "body"])

        for batch in batches:
            for page_id, url, data, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                body.append(_page_record(page_id, url, data, sha1_base32(data), refers_to))
                size += len(body[-1])
                if size >= archive_bytes:
                    yield archive()
                    body, size = [], 0
        if body:
            yield archive()

    return planned.mapInArrow(write, "archive string, body binary")


def archive_files(spark: SparkSession, path: str) -> DataFrame:
    """(archive, body) rows of archive files below a path."""
    return spark.read.format("binaryFile").load(path).select(
        F.col("path").alias("archive"), F.col("content").alias("body"))


# --- reading ---------------------------------------------------------------

@dataclass
class Found:
    """A record with the bytes it takes, or a gap (``why`` is set)."""

    start: int
    end: int
    headers: dict[str, str]
    block: bytes
    why: str = ""
    #: Place in the unpacked bytes of a gzip member.
    inner: tuple[int | None, int | None] = (None, None)


class Damaged(ValueError):
    pass


def _parse(data: bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    """Headers, block and end of the record at ``at``."""
    if not re.compile(rb"WARC/1\.[01]\r\n").match(data, at):
        raise Damaged("no version line")
    head = data.find(b"\r\n\r\n", at)
    if head < 0:
        raise Damaged("headers do not end")
    headers: dict[str, str] = {}
    for line in data[at:head].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damaged("bad header line")
        headers[name.strip().decode("utf-8", "replace").lower()] = value.strip().decode(
            "utf-8", "replace")
    length = headers.get("content-length", "")
    if not length.isdigit():
        raise Damaged("no content length")
    end = head + 4 + int(length)
    if data[end:end + 4] != b"\r\n\r\n":
        raise Damaged("content length does not fit")
    block = data[head + 4:end]
    said = headers.get("warc-block-digest", "")
    if said.startswith("sha1:") and said[5:] != sha1_base32(block):
        raise Damaged("block digest differs")
    payload_said = headers.get("warc-payload-digest", "")
    if (payload_said.startswith("sha1:") and headers.get("warc-type") == "response"
            and payload_said[5:] != sha1_base32(http_payload(block)[1])):
        raise Damaged("payload digest differs")
    return headers, block, end + 4


def http_payload(block: bytes) -> tuple[dict[str, str], bytes]:
    """HTTP headers and body of a response block."""
    head, blank, body = block.partition(b"\r\n\r\n")
    if not blank or not head.startswith(b"HTTP/"):
        return {}, block
    pairs = (line.partition(b":") for line in head.split(b"\r\n")[1:])
    return {k.strip().decode("latin-1").lower(): v.strip().decode("latin-1")
            for k, _, v in pairs}, body


def _unpack(data: bytes, at: int) -> tuple[bytes, int, str]:
    """Unpacked bytes of the gzip member at ``at``, as far as they can be had,
    where it ends, and what is wrong with it."""
    packed = memoryview(data)[at:]
    unpacker = zlib.decompressobj(31)
    try:
        plain = unpacker.decompress(packed)
    except zlib.error:
        plain, taken = _unpacked_part(packed)
        return plain, at + taken, _BROKEN
    if not unpacker.eof:
        return plain, len(data), "member is cut off"
    return plain, len(data) - len(unpacker.unused_data), ""


def _unpacked_part(packed: memoryview, piece: int = 1024) -> tuple[bytes, int]:
    """What a damaged member gives up to its fault, and how many bytes that took."""
    unpacker, out, taken = zlib.decompressobj(31), [], 0
    try:
        while True:
            out.append(unpacker.decompress(packed[taken:taken + piece]))
            taken += piece
    except zlib.error:
        pass
    unpacker = zlib.decompressobj(31)
    out = [unpacker.decompress(packed[:taken])]
    try:
        while True:
            out.append(unpacker.decompress(packed[taken:taken + 1]))
            taken += 1
    except zlib.error:
        return b"".join(out), taken


def _inside(plain: bytes, digest_needed: bool) -> Iterator[Found]:
    """Records and gaps of a member's unpacked bytes, with their place in there."""
    at, lost, why = 0, -1, ""
    while at < len(plain):
        try:
            headers, block, end = _parse(plain, at)
            if digest_needed and not headers.get("warc-block-digest", "").startswith("sha1:"):
                raise Damaged("no digest to check it by")
        except Damaged as bad:
            if lost < 0:
                lost, why = at, str(bad)
            found = _LINE.search(plain, at + 1)
            at = found.start() if found else len(plain)
            continue
        if lost >= 0:
            yield Found(lost, at, {}, b"", why)
            lost = -1
        yield Found(at, end, headers, block)
        at = end
    if lost >= 0:
        yield Found(lost, len(plain), {}, b"", why)


def _member(data: bytes, at: int) -> tuple[list[Found], int]:
    """Records and gaps of the gzip member at ``at``, and where to go on."""
    plain, end, wrong = _unpack(data, at)
    found = list(_inside(plain, wrong == _BROKEN))
    whole = sum(not x.why for x in found)
    if found and not whole or wrong and (not whole or wrong == _BROKEN and len(found) == 1):
        raise Damaged(wrong or found[0].why)
    if wrong:
        if not found[-1].why:
            found.append(Found(len(plain), len(plain), {}, b"", wrong))
        # Version lines in what was unpacked are known already.
        later = _MEMBER.search(data, at + 1, end) or _START.search(data, end)
        end = later.start() if later else len(data)
    return [Found(at, end, x.headers, x.block, x.why, (x.start, x.end)) for x in found], end


def salvage(data: bytes) -> Iterator[Found]:
    """All whole records in order, and the gaps between them."""
    at, lost, why = 0, -1, ""
    while at < len(data):
        try:
            if data.startswith(b"\x1f\x8b", at):
                found, end = _member(data, at)
            else:
                headers, block, end = _parse(data, at)
                found = [Found(at, end, headers, block)]
        except Damaged as bad:
            if lost < 0:
                lost, why = at, str(bad)
            start = _START.search(data, at + 1)
            at = start.start() if start else len(data)
            continue
        if lost >= 0:
            yield Found(lost, at, {}, b"", why)
            lost = -1
        yield from found
        at = end
    if lost >= 0:
        yield Found(lost, len(data), {}, b"", why)


def read_archives(stored: DataFrame, with_payload: bool = True) -> DataFrame:
    """Records and gaps of (archive, body) rows.

    Returns archive, start, stop, inner_start, inner_stop (places in the unpacked
    bytes of a gzip member, else null), kind (record or gap), why (of a gap), record_type, record_id, target_uri, refers_to, payload_bytes,
    payload_digest and, unless left out, payload.  Size and digest are those of
    the full payload: counted for responses, as noted in the record for
    revisits.
    """
    schema = ("archive string, start long, stop long, inner_start long, inner_stop long, kind string, why string, "
              "record_type string, record_id string, target_uri string, refers_to string, "
              "payload_bytes long, payload_digest string" + ", payload binary" * with_payload)
    names = [part.split()[0] for part in schema.split(", ")]
    kinds = [pa.string(), *[pa.int64()] * 4, *[pa.string()] * 6, pa.int64(), pa.string(),
             pa.binary()]

    def row(archive: str, x: Found) -> tuple:
        if x.why:
            return (archive, x.start, x.end, *x.inner, "gap", x.why, *[None] * 7)
        http, body = http_payload(x.block)
        kind = x.headers.get("warc-type")
        if kind == "revisit":
            size = int(http["content-length"]) if http.get("content-length", "").isdigit() else None
            digest = x.headers.get("warc-payload-digest", "").removeprefix("sha1:") or None
        else:
            size, digest = len(body), sha1_base32(body)
        return (archive, x.start, x.end, *x.inner, "record", None, kind, x.headers.get("warc-record-id"),
                x.headers.get("warc-target-uri"), x.headers.get("warc-refers-to"), size, digest,
                body)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows = [row(archive, x) for x in salvage(body.as_py() or b"")]
                columns = list(zip(*rows)) or [()] * len(kinds)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)][:len(names)], names)

    return stored.select("archive", "body").mapInArrow(read, schema)


def page_id_of(record_id: Column, kind: str = "long") -> Column:
    """The page id in a record id of ``archives``."""
    return F.nullif(F.regexp_extract(record_id, "^<urn:page:(.*)>$", 1), F.lit("")).cast(kind)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write one record per page, read the archives back, one row per page."""
    stored = cut_lineage(archives(pages), "archives")
    return (read_archives(stored, with_payload=False).where("kind = 'record'")
            .select(page_id_of(F.col("record_id")).alias("page_id"), "payload_bytes",
                    "payload_digest", "record_type",
                    page_id_of(F.col("refers_to")).alias("refers_to")))


SQL = """
WITH p AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS hex
  FROM pages),
m AS (SELECT hex, max(page_id) AS stored FROM p GROUP BY hex)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         CAST((CAST('0x' || substr(p.hex, CAST(5 * (i // 4) + 1 AS INT), 5) AS INT) >> CAST(15 - 5 * (i % 4) AS INT)) & 31 AS INT) + 1, 1)), '')
         AS payload_digest,
       CASE WHEN page_id = stored THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = stored THEN NULL ELSE stored END AS refers_to
FROM p JOIN m ON p.hex = m.hex
"""
