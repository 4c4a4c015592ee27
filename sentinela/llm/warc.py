"""WARC archives: one gzip member per record, and a salvage reader.

Archives are files of concatenated gzip members, written through Spark's own
writer to any store. The reader takes members and plain records alike. After a
failed check (member, version line, header, length, digest) it searches for the
next member or version line that parses, goes on from there, and reports the
bytes in between as a quarantined gap. Members of several records are searched in
the same way inside, up to where they are cut or damaged.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from sentinela.llm.common import written
from sentinela.session import scratch_path

#: Compressed bytes after which a task begins another archive file.
SEGMENT_BYTES = 4 << 20

_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_END = b"\r\n\r\n"


def payload_digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_bytes(page_id, url: str | None, payload: bytes, refers_to=None) -> bytes:
    """One record. A revisit carries the HTTP header (with the payload's length)
    and the digest, not the payload."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    uri = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else "urn:x-page:unknown"
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:x-page:{'' if page_id is None else page_id}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Target-URI: {uri}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{payload_digest(payload)}",
        f"WARC-Block-Digest: sha1:{payload_digest(block)}",
    ]
    if revisit:
        head += [f"WARC-Profile: {_REVISIT}", f"WARC-Refers-To: <urn:x-page:{refers_to}>"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + _END + block + _END


def gzip_member(data: bytes, level: int = 4) -> bytes:
    deflate = zlib.compressobj(level, zlib.DEFLATED, 31)
    return deflate.compress(data) + deflate.flush()


def write_archives(
    spark: SparkSession,
    pages: DataFrame,
    path: str | None = None,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    min_revisit_bytes: int = 0,
    segment_bytes: int = SEGMENT_BYTES,
) -> str:
    """Write one record per page below ``path`` (default: the shared folder) and
    return it. Of pages with equal payloads of at least ``min_revisit_bytes``
    bytes, those with the smallest id are responses, the others revisits of it.

    Null html is an empty payload; a null id never is referred to (a group of
    null ids only: all responses); rows repeating the smallest id are all
    responses; an empty table gives no records; further columns are ignored.
    Only (digest, id) is grouped; payloads are shuffled only if repeated digests
    outgrow the session's broadcast threshold.
    """
    base = pages.select(
        F.col(f"`{page_id}`").alias("page_id"),
        F.col(f"`{url}`").alias("url"),
        F.coalesce(F.col(f"`{html}`"), F.lit("")).alias("html"),
    ).withColumn("sha", F.sha1(F.encode("html", "UTF-8")))
    repeated = (
        base.where(F.octet_length("html") >= min_revisit_bytes)
        .groupBy("sha")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select(F.col("sha").alias("again"), "first")
    )
    repeated = written(spark, repeated, "digests")
    big = F.octet_length("html") >= min_revisit_bytes
    chosen = base.join(repeated, big & (F.col("sha") == F.col("again")), "left").select(
        "page_id", "url", "html", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in batches:
            ids, urls, texts, refers = (b.column(i) for i in range(4))
            for i, u, t, r in zip(ids.to_pylist(), urls.to_pylist(), texts, refers.to_pylist()):
                member = gzip_member(record_bytes(i, u, t.as_buffer().to_pybytes(), r))
                held.append(member)
                size += len(member)
                if size >= segment_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], ["content"])
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], ["content"])

    path = path or scratch_path(spark, "llm", "warc")
    # The text writer puts a row's bytes out as they are. One row is one file; the
    # closing NUL is the zero padding that gzip readers skip.
    chosen.mapInArrow(run, "content binary").select(F.col("content").cast("string").alias("value")).write.option(
        "maxRecordsPerFile", 1
    ).option("lineSep", "\0").text(path)
    return path


class _Bad(Exception):
    pass


def _member(data: memoryview, at: int) -> tuple[bytes, int, str]:
    """The gzip member at ``at``: content, end, fault. With a fault (not empty), the
    content is what was inflated before it, and ``end`` the place where it showed."""
    inflate, out, pos = zlib.decompressobj(31), [], at
    while not inflate.eof:
        piece = data[pos : pos + 65536]
        if not piece:
            return b"".join(out), pos, "truncated member"
        before = inflate.copy()
        try:
            out.append(inflate.decompress(piece))
        except zlib.error as e:
            for i in range(len(piece)):  # a failing call gives nothing: byte by byte up to the fault
                try:
                    out.append(before.decompress(piece[i : i + 1]))
                except zlib.error:
                    return b"".join(out), pos + i, f"member: {e}"
            return b"".join(out), pos + len(piece), f"member: {e}"
        pos += len(piece)
    return b"".join(out), pos - len(inflate.unused_data), ""


def _plain(data, at: int) -> tuple[dict, int]:
    """The record whose version line stands at ``at``: fields, end."""
    stop = data.find(_END, at)
    if stop < 0:
        raise _Bad("header without end")
    lines = data[at:stop].split(b"\r\n")
    if not re.fullmatch(rb"WARC/1\.[01]", lines[0]):
        raise _Bad("version line")
    head = {}
    for line in lines[1:]:
        name, sep, value = line.partition(b":")
        if not sep:
            raise _Bad("header line")
        head[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    length = head.get("content-length", "")
    if not (length.isascii() and length.isdigit() and len(length) < 16):
        raise _Bad("content length")
    start, end = stop + 4, stop + 4 + int(length)
    if data[end : end + 4] != _END:
        raise _Bad("block does not end where its length says")
    block = data[start:end]
    http, sep, payload = block.partition(_END)
    if head.get("content-type", "").startswith("application/http"):
        if not sep:
            raise _Bad("HTTP header without end")
    else:
        http, payload = b"", block
    for name, part in (("warc-block-digest", block), ("warc-payload-digest", payload)):
        told = head.get(name, "")
        if told.startswith("sha1:") and not (name == "warc-payload-digest" and head.get("warc-type") == "revisit"):
            if told[5:] != payload_digest(part):
                raise _Bad(name.removeprefix("warc-").replace("-", " "))
    size = re.search(rb"(?im)^content-length:[ \t]*([0-9]{1,18})[ \t]*\r?$", http)
    kind = head.get("warc-type", "")
    revisit = kind == "revisit"
    return {
        "record_type": kind,
        "record_id": head.get("warc-record-id"),
        "target_uri": head.get("warc-target-uri"),
        "refers_to": head.get("warc-refers-to"),
        "payload": None if revisit else payload,
        "payload_bytes": int(size[1]) if revisit and size else len(payload),
        "payload_digest": head.get("warc-payload-digest", "").removeprefix("sha1:") if revisit else payload_digest(payload),
    }, end + 4


_VERSION = re.compile(rb"WARC/1\.[01]\r\n")


def _records(content: bytes) -> tuple[list[dict], list[tuple[int, int, str]]]:
    """The records of a member's content, and its gaps (from, to, reason) between them."""
    out, gaps, at, bad_from, reason = [], [], 0, None, ""
    while at < len(content):
        try:
            record, end = _plain(content, at)
        except _Bad as e:
            if bad_from is None:
                bad_from, reason = at, str(e)
            found = _VERSION.search(content, at + 1)
            at = found.start() if found else len(content)
            continue
        if bad_from is not None:
            gaps.append((bad_from, at, reason))
            bad_from = None
        out.append(record)
        at = end
    if bad_from is not None:
        gaps.append((bad_from, len(content), reason))
    return out, gaps


_START = re.compile(rb"\x1f\x8b\x08|WARC/1\.[01]\r\n")


def salvage(data: bytes) -> Iterator[dict]:
    """Records and gaps of one archive in order. Every byte belongs to a record,
    to zero padding, or to a gap (``reason`` set) that is quarantined.

    A member of several records is searched inside: its good records have the offset
    and length of the member, or, if it is truncated or damaged, of the gap that it
    leaves, and so do its inner gaps. What a fault leaves of a member of one record
    is not taken, as that record's own checksum or end is missing.
    """
    view, at, bad_from, reason = memoryview(data), 0, None, ""
    padding = re.compile(rb"\0+")
    inside: list[dict] = []  # what damaged members of the open gap gave
    again: list[dict] = []  # the same, as long as the search may meet them uncompressed
    again_to = 0

    def gap(end: int) -> Iterator[dict]:
        for r in inside:
            yield {"offset": bad_from, "length": end - bad_from, "reason": None, **r}
        yield {"offset": bad_from, "length": end - bad_from, "reason": reason}

    while at < len(data):
        if bad_from is None and (pad := padding.match(data, at)):
            at = pad.end()
            continue
        gaps = []
        try:
            if data[at : at + 3] == b"\x1f\x8b\x08":
                content, end, fault = _member(view, at)
                records, gaps = _records(content)
                if fault:
                    if len(records) + len(gaps) > 1:
                        fresh = [r for r in records if r not in again]
                        inside, again, again_to = inside + fresh, again + fresh, max(again_to, end)
                    raise _Bad(fault)
                if not records:
                    raise _Bad(gaps[0][2] if gaps else "empty member")
            else:
                record, end = _plain(data, at)
                records = [record]
        except _Bad as e:
            if bad_from is None:
                bad_from, reason = at, str(e)
            found = _START.search(data, at + 1)
            at = found.start() if found else len(data)
            continue
        if bad_from is not None:
            yield from gap(at)
            bad_from, inside = None, []
        for r in records:
            if at < again_to and r in again:  # in a stored block of a damaged member: given with its gap
                again.remove(r)
                continue
            yield {"offset": at, "length": end - at, "reason": None, **r}
        for a, b, why in gaps:
            yield {"offset": at, "length": end - at, "reason": f"{why} (bytes {a} to {b} of the member's content)"}
        at = end
    if bad_from is not None:
        yield from gap(len(data))


_READ = pa.schema(
    [
        ("archive", pa.string()),
        ("offset", pa.int64()),
        ("length", pa.int64()),
        ("reason", pa.string()),
        ("record_type", pa.string()),
        ("record_id", pa.string()),
        ("target_uri", pa.string()),
        ("refers_to", pa.string()),
        ("payload", pa.binary()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
    ]
)


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """Records and quarantined gaps (``reason`` not null) of every file below
    ``path``. One file is read by one task, so files should be far smaller than
    an executor's memory. Empty files give no rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for archive, content in zip(b.column(0).to_pylist(), b.column(1)):
                rows, size = [], 0
                for r in salvage(content.as_buffer().to_pybytes() if content.is_valid else b""):
                    if not with_payload:
                        r.pop("payload", None)
                    rows.append({"archive": archive, **r})
                    size += len(r.get("payload") or b"") + 500
                    if size > 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, _READ)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, _READ)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")
    return files.mapInArrow(run, from_arrow_schema(_READ))


def page_number(uri: str):
    """The page id in a record URI written by ``write_archives``, as text."""
    return F.nullif(F.regexp_extract(uri, r"^<urn:x-page:(.*)>$", 1), F.lit(""))
