import base64
import hashlib

import pytest

from rawgate.llm import warc

ROWS = [
    (1, "u", "a" * 10),
    (2, None, None),
    (3, "x y\r\nz", ""),
    (4, "q", "WARC/1.1\r\n" * 7 + "é" * 50 + "\r\n"),
    (5, "q", "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n"),
    (6, "q", "ü" * 1000),
    (7, "", "\r\n"),
    (8, "b", "ü" * 1000),
    (8, "b", "ü" * 1000),
    (None, "b", "zz"),
    (None, "c", "a" * 10),
    (9, "WARC/1.1", "\x00\x01" + "\U0001f600" * 300),
]
SCHEMA = "page_id long, url string, html string"


def brute(rows, least=0):
    data = [(i, (h or "").encode()) for i, _, h in rows]
    out = []
    for i, b in data:
        same = [j for j, c in data if c == b and j is not None]
        top = max(same, default=None)
        revisit = len(b) >= least and top is not None and i != top
        digest = base64.b32encode(hashlib.sha1(b).digest()).decode()
        out.append((i, len(b), digest, "revisit" if revisit else "response", top if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("chunk_bytes, least", [(7, 0), (64, 0), (1 << 20, 0), (64, 5), (1 << 20, 10_000)])
def test_round_trip(spark, tmp_path, chunk_bytes, least):
    pages = spark.createDataFrame(ROWS, SCHEMA).selectExpr("*", "'x' AS digest", "'y' AS record_type", "'z' AS bytes")
    got = warc.archive(pages, f"{tmp_path}/a", chunk_bytes=chunk_bytes, min_revisit=least).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.digest, r.record_type, r.refers_to) for r in got), key=str) == brute(ROWS, least)
    assert all(r.digest == r.stated_digest and r.payload_bytes == r.stated_bytes for r in got)


def test_chunks_are_bounded_records(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "é" * 5000)], SCHEMA)
    warc.write_archive(warc.record_types(warc.digested(pages, "page_id", "html", "url")), f"{tmp_path}/a", chunk_bytes=999)
    rows = warc.read_chunks(spark, f"{tmp_path}/a").orderBy("chunk_no").collect()
    assert [r.chunk_no for r in rows] == list(range(1, 12)) and all(len(r.bytes) <= 999 for r in rows)
    assert b"".join(bytes(r.bytes) for r in rows) == ("é" * 5000).encode()
    assert len({r.record_id for r in rows}) == 1


def test_files_are_plain_warc(spark, tmp_path):
    import gzip
    import glob

    pages = spark.createDataFrame(ROWS, SCHEMA).coalesce(1)
    warc.write_archive(warc.record_types(warc.digested(pages, "page_id", "html", "url")), f"{tmp_path}/a", chunk_bytes=64)
    seen = 0
    for name in glob.glob(f"{tmp_path}/a/*.gz"):
        data = gzip.open(name).read()
        while data:
            head, _, rest = data.partition(b"\r\n\r\n")
            assert head.startswith(b"WARC/1.1\r\n")
            fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
            size = int(fields["Content-Length"])
            assert rest[size : size + 4] == b"\r\n\r\n"
            data, seen = rest[size + 4 :], seen + 1
    assert seen > len(ROWS)


def test_empty_table(spark, tmp_path):
    assert warc.archive(spark.createDataFrame([], SCHEMA), f"{tmp_path}/a").count() == 0
