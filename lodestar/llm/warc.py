"""WARC archives: a writer with revisit records and a splittable reader.

The reader cuts archives into byte ranges. A task looks for gzip magic in its range,
takes a candidate for a record only if its header decodes to that of a WARC record, and
owns every record that begins inside its range, reading on beyond the end for the last
one. Ranges need no index and no order. Payloads are held one record at a time.

Files are reached through Arrow's file systems (local, HDFS, S3, GCS), in tasks only. A
task writes under a name of its own, and only what Spark commits to the manifest is ever
read, so a lost executor or a repeated task leaves no record twice.

Defined cases: a null payload is an empty one. A null page id gets a random record id, is
a response, and nothing refers to it. Rows that repeat a page id are all responses if it
is the least of their payload. White space and control characters in a URL are
percent-encoded; a null URL has no header. Bytes that are no record are passed over, and
so is a damaged or cut-off member. A stored gzip member inside a payload is
indistinguishable from a record if a range begins between the two.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lodestar.llm.common import bound_arrow_batches, cut_lineage

#: Payloads from this size on are stored once.
REVISIT_BYTES = 100
#: Buckets that the copies of one payload are spread over.
SALTS = 64
SPLIT_BYTES, FILE_BYTES, STEP = 4 << 20, 128 << 20, 1 << 18
MAGIC = b"\x1f\x8b\x08"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_PAGE_URN = "urn:x-page:"


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """Arrow file system and path of a URI or a plain path."""
    uri = re.sub(r"^s3[an]:", "s3:", re.sub(r"^file:/+", "file:///", uri))
    return pafs.FileSystem.from_uri(uri) if ":" in uri else (pafs.LocalFileSystem(), uri)


def mark_revisits(pages: DataFrame, least_bytes: int = REVISIT_BYTES) -> DataFrame:
    """``page_id, url, payload, digest, refers_to`` of every page.

    ``refers_to`` is the least page id with an equal payload, unless that is the page's
    own. Minima are taken per payload and salt, so that copies of one payload neither meet
    in one task nor are they joined in one.
    """
    payload = F.coalesce("html", F.lit(""))
    rows = pages.select(F.col("page_id").cast("long"), "url", payload.alias("payload"))
    rows = rows.withColumns({"digest": F.sha2("payload", 256), "salt": F.pmod(F.xxhash64("page_id"), F.lit(SALTS))})
    large = rows.filter(F.col("page_id").isNotNull() & (F.octet_length("payload") >= least_bytes))
    salted = large.groupBy("digest", "salt").agg(F.min("page_id").alias("least"), F.count("*").alias("n"))
    groups = salted.groupBy("digest").agg(F.min("least").alias("first"), F.sum("n").alias("n"), F.collect_set("salt").alias("salts"))
    firsts = groups.filter("n > 1").select("digest", "first", F.explode("salts").alias("salt"))
    other = F.col("page_id").isNotNull() & (F.col("first") != F.col("page_id"))
    joined = rows.join(firsts, ["digest", "salt"], "left")
    return joined.select("page_id", "url", "payload", "digest", F.when(other, F.col("first")).alias("refers_to"))


def _record(page: int | None, url: str | None, payload: str, digest: str, refers_to: int | None, date: str) -> bytes:
    """One record, compressed as a gzip member of its own."""
    body = payload.encode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + body
    urn = f"urn:uuid:{uuid.uuid4()}" if page is None else f"{_PAGE_URN}{page}"
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <{urn}>", f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    head.append(f"WARC-Payload-Digest: sha256:{digest}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: <{_PAGE_URN}{refers_to}>", f"WARC-Profile: {PROFILE}"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    squeeze = zlib.compressobj(4, zlib.DEFLATED, 31)
    return squeeze.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + squeeze.flush()


def _write(folder: str, date: str, file_bytes: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, name, size, done = None, "", 0, []
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "digest", "refers_to"))):
                if out is None:
                    name, size = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0
                    system, path = file_system(name)
                    system.create_dir(path.rpartition("/")[0], recursive=True)
                    out = system.open_output_stream(path, compression=None)
                record = _record(*row, date)
                out.write(record)
                size += len(record)
                if size >= file_bytes:
                    out.close()
                    done.append((name, size))
                    out = None
        if out is not None:
            out.close()
            done.append((name, size))
        yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.int64())], ["path", "length"])

    return run


def write_warc(pages: DataFrame, folder: str, date: str = "2024-01-01T00:00:00Z", file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write ``pages`` (``page_id, url, html``) as archives and return their manifest (``path, length``)."""
    bound_arrow_batches(pages.sparkSession)
    return cut_lineage(mark_revisits(pages).mapInArrow(_write(folder, date, file_bytes), "path string, length long"))


def list_archives(spark: SparkSession, folder: str) -> DataFrame:
    """Manifest of the archives in a folder that something else has written; reads no content."""
    return spark.read.format("binaryFile").load(folder).select("path", "length")


@dataclass
class Record:
    start: int
    head: dict[str, str]
    block: bytes

    def payload(self) -> tuple[int, bytes | None]:
        """Length of the full payload, and its bytes unless this is a revisit."""
        http, mark, body = self.block.partition(b"\r\n\r\n")
        if not self.head.get("content-type", "").startswith("application/http") or not mark:
            return len(self.block), self.block
        if self.head.get("warc-type") != "revisit":
            return len(body), body
        found = re.search(rb"(?im)^content-length:\s*(\d+)", http)
        return int(found[1]) if found else 0, None


class _Range:
    """Bytes of a file from ``start`` on, read as they are asked for."""

    def __init__(self, file: pa.NativeFile, start: int, end: int) -> None:
        self.file, self.start, self.size = file, start, file.size()
        self.data = bytearray(file.read_at(min(end, self.size) - start, start))

    def upto(self, end: int) -> int:
        """Read on to ``end`` and return where the bytes at hand end."""
        at = self.start + len(self.data)
        if end > at and at < self.size:
            self.data += self.file.read_at(min(max(end - at, STEP), self.size - at), at)
        return self.start + len(self.data)


def _member(source: _Range, at: int) -> tuple[Record, int] | None:
    """The record whose gzip member begins at ``at``, and where it ends."""
    inflate, out, pos = zlib.decompressobj(31), bytearray(), at
    while not inflate.eof:
        have = min(source.upto(pos + (1 << 14)), pos + (1 << 14))
        if have <= pos:
            return None
        try:
            out += inflate.decompress(memoryview(source.data)[pos - source.start : have - source.start].tobytes())
        except zlib.error:
            return None
        if len(out) >= 8 and not out.startswith(b"WARC/1."):
            return None
        pos = have
    head, mark, rest = bytes(out).partition(b"\r\n\r\n")
    if not mark or not head.startswith(b"WARC/1."):
        return None
    lines = [line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:]]
    fields = {k.strip().lower(): v.strip() for k, _, v in lines}
    length = fields.get("content-length", "")
    if not length.isdigit() or int(length) > len(rest):
        return None
    return Record(at, fields, rest[: int(length)]), pos - len(inflate.unused_data)


def records_in(file: pa.NativeFile, start: int, end: int) -> Iterator[Record]:
    """Records that begin in ``[start, end)``."""
    # two bytes more, as magic may begin at the last byte of the range
    source, at = _Range(file, start, end + len(MAGIC) - 1), start
    while at < end:
        at = source.data.find(MAGIC, at - start)
        if at < 0 or at + start >= end:
            return
        at += start
        found = _member(source, at)
        if found is None:
            at += 1
        else:
            yield found[0]
            at = found[1]


_RECORD = (
    "path string, start long, record_id string, record_type string, target_uri string, date string, "
    "payload_digest string, refers_to string, payload_bytes long, payload binary"
)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in _RECORD.split(", ")]
    types = [pa.string(), pa.int64(), *[pa.string()] * 6, pa.int64(), pa.binary()]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)

    for splits in batches:
        for path, start, end in zip(*(splits.column(c).to_pylist() for c in ("path", "start", "end"))):
            system, place = file_system(path)
            rows, held = [], 0
            with system.open_input_file(place) as file:
                for r in records_in(file, start, end):
                    length, payload = r.payload()
                    h = r.head
                    rows.append((path, r.start, h.get("warc-record-id"), h.get("warc-type"), h.get("warc-target-uri"), h.get("warc-date"),
                                 h.get("warc-payload-digest"), h.get("warc-refers-to"), length, payload))
                    held += len(payload or b"")
                    if held >= 1 << 21:
                        yield batch(rows)
                        rows, held = [], 0
            yield batch(rows)


def read_warc(archives: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Records of archives (``path, length``), read in ranges of ``split_bytes``.

    Columns: ``path, start, record_id, record_type, target_uri, date, payload_digest,
    refers_to, payload_bytes, payload``; a revisit has the length of the full payload and
    null for its bytes.
    """
    step = F.lit(split_bytes).cast("long")
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, step))
    splits = archives.filter("length > 0").select("path", "length", starts.alias("start"))
    splits = splits.select("path", "start", F.least(F.col("start") + step, F.col("length")).alias("end"))
    total = archives.agg(F.sum(F.ceil(F.col("length") / split_bytes))).first()[0] or 1
    return splits.repartition(int(total), "path", "start").mapInArrow(_read, _RECORD)


def page_of(urn: str) -> Column:
    """Page id in a record id written by :func:`write_warc`; null for others."""
    return F.expr(f"try_cast(regexp_extract({urn}, '^<{_PAGE_URN}(-?[0-9]+)>$', 1) as long)")
