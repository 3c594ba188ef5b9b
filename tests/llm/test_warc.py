"""WARC archives: round trips, revisits and splits of every size."""

from __future__ import annotations

import gzip
import hashlib
import io

import pyarrow as pa
import pytest

from lodestar.llm.warc import list_archives, page_of, read_warc, records_in, write_warc

SCHEMA = "page_id long, url string, html string, payload string, salt int"
LONG = "<p>é" * 60
PAGES = [
    (5, "http://a/x", LONG), (3, "http://a/y z\r\n", LONG), (9, None, LONG), (1, "u", "short"), (2, "u", "short"), (7, "u", None), (8, "u", ""),
    (None, "n", LONG), (3, "again", LONG), (11, "u", "\r\n\r\nWARC/1.1\r\n" * 30), (12, "u", "x" * 300_000), (13, "u", "x" * 300_000),
]


def want():
    out = []
    for page, _, html in PAGES:
        body = (html or "").encode()
        same = [p for p, _, h in PAGES if (h or "") == (html or "") and p is not None]
        first = min(same) if len(body) >= 100 and page is not None else page
        kind = "response" if first == page else "revisit"
        out.append((page, len(body), hashlib.sha256(body).hexdigest(), kind, None if first == page else first))
    return sorted(out, key=repr)


@pytest.mark.parametrize("split", [64, 1000, 1 << 22])
def test_round_trip(spark, tmp_path, split):
    frame = spark.createDataFrame([(p, u, h, "c", 1) for p, u, h in PAGES], SCHEMA).repartition(3)
    archives = write_warc(frame, str(tmp_path / "w"), file_bytes=400)
    rows = read_warc(archives, split).select("*", page_of("record_id").alias("page"), page_of("refers_to").alias("target")).collect()
    got = []
    for r in rows:
        digest = r["payload_digest"].removeprefix("sha256:")
        if r["record_type"] == "response":
            assert hashlib.sha256(r["payload"]).hexdigest() == digest and len(r["payload"]) == r["payload_bytes"]
        else:
            assert r["payload"] is None
        got.append((r["page"], r["payload_bytes"], digest, r["record_type"], r["target"]))
    assert sorted(got, key=repr) == want()
    assert {r["page"]: r["target_uri"] for r in rows if r["page"] in (5, 9)} == {5: "http://a/x", 9: None}
    listed = read_warc(list_archives(spark, str(tmp_path / "w")), split)
    assert listed.count() == len(PAGES)


def test_ranges_own_each_record_once_among_damage():
    def member(k):
        return gzip.compress(f"WARC/1.0\r\nWARC-Type: resource\r\nContent-Length: {len(str(k))}\r\n\r\n{k}\r\n\r\n".encode())

    parts = [b"junk\x1f\x8b\x08junk", member(1), member(2), gzip.compress(b"no record"), b"\x1f\x8b", member(3), member(4)[:-12]]
    data = b"".join(parts)
    file = pa.PythonFile(io.BytesIO(data), "r")
    for size in (1, 2, 3, 7, 50, 10_000):
        found = [r for a in range(0, len(data), size) for r in records_in(file, a, min(a + size, len(data)))]
        assert [r.block for r in found] == [b"1", b"2", b"3"]
        assert [r.start for r in found] == sorted({r.start for r in found})


def test_empty_table(spark, tmp_path):
    archives = write_warc(spark.createDataFrame([], SCHEMA), str(tmp_path / "w"))
    assert archives.isEmpty() and read_warc(archives).isEmpty()
