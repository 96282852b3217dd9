"""WARC archives as a chunked record table.

A record is kept as rows (record id, chunk number, last flag, bytes). A payload
longer than `chunk_bytes` becomes several rows; in the archive these are a
record and its `continuation` records (WARC segmentation), so every row is one
WARC record of bounded size and Spark's text writer and reader carry them: the
archive is written and read in parallel, on any file system Spark knows. The
reader cuts files at the version line of the next record. A chunk is cut where
the payload itself holds a version line, so that this cut is always right.

Digests are carried from chunk to chunk: after reading, the rows of records
with several chunks are brought together, sorted by chunk number, and streamed
through one running SHA-1 per record. Records of one chunk, nearly all, are
digested in place without a shuffle. No step holds a whole payload but the
input row itself.

Among records with equal payloads of at least `min_revisit` bytes, the one with
the largest id is written as `response`, all others as `revisit` without
payload. Equal payloads are found by digest; counts are combined on the map
side, so a payload that a third of all pages share is one row per task.

Defined cases: a null payload is empty; equal rows that share the largest id
are all responses; a null id is written as an empty field and counts as smaller
than any id; control signs and blanks in URLs, and a version line that would end one,
are percent-coded; a null URL gives
a record without target; an empty table gives an archive without records;
other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rawgate.llm.common import arrow_map, broadcast_if_small, staged, table
from rawgate.llm.registry import query
from rawgate.session import scratch_path

VERSION = "WARC/1.1"
#: what a record begins with; it occurs nowhere else in an archive written here
VERSION_LINE = f"{VERSION}\r\n"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\n\r\n"
CHUNK_BYTES = 1 << 20
WARC_DATE = "1970-01-01T00:00:00Z"

BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
BASE32_HEX = "0123456789ABCDEFGHIJKLMNOPQRSTUV"


def base32_sha1(data: Column) -> Column:
    """Bare upper-case base32 SHA-1 of binary data, by JVM functions: 40 bits at a time."""
    digest = F.sha1(data)
    parts = [F.lpad(F.conv(F.substring(digest, 10 * i + 1, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), BASE32_HEX, BASE32)


def chunks(payload: Column, chunk_bytes: int = CHUNK_BYTES) -> Column:
    """Array of the payload's chunks: every `chunk_bytes`, and inside each version line, after its `WARC/`."""
    # ISO-8859-1 maps bytes to characters one by one, so that any payload survives
    cut = F.split(F.decode(payload, "ISO-8859-1"), r"(?<=WARC/)(?=1\.1)", -1)
    lines = F.transform(cut, lambda p: F.encode(p, "ISO-8859-1"))
    pieces = F.when(F.instr(payload.cast("string"), VERSION) > 0, lines).otherwise(F.array(payload))
    starts = lambda p: F.sequence(F.lit(0), F.greatest(F.octet_length(p) - 1, F.lit(0)), F.lit(chunk_bytes))
    return F.flatten(F.transform(pieces, lambda p: F.transform(starts(p), lambda at: F.substring(p, at + 1, F.lit(chunk_bytes)))))


def digested(pages: DataFrame, id_col: str, payload_col: str, url_col: str) -> DataFrame:
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    return pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload")
    ).select("page_id", "url", "payload", base32_sha1(F.col("payload")).alias("digest"), F.octet_length("payload").cast("long").alias("payload_bytes"))


def record_types(records: DataFrame, min_revisit: int = 0) -> DataFrame:
    """Adds record_type and refers_to. Digests that occur once need no row on the other side."""
    original = (
        records.filter(F.col("payload_bytes") >= min_revisit)
        .groupBy("digest")
        .agg(F.max("page_id").alias("original"), F.count("*").alias("copies"))
        .filter(F.col("copies") > 1)
        .select(F.col("digest").alias("_digest"), "original")
    )
    original = broadcast_if_small(staged(original, "warc-originals"), row_bytes=96)
    revisit = (F.col("payload_bytes") >= min_revisit) & F.col("original").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("original"))
    return records.join(original, F.col("digest") == F.col("_digest"), "left").select(
        *records.columns, F.when(revisit, "revisit").otherwise("response").alias("record_type"), F.when(revisit, F.col("original")).alias("refers_to")
    )


def _field(name: str, value: Column) -> Column:
    """A header line, or nothing where the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n")), F.lit(""))


def record_rows(records: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The archive's rows: one WARC record per chunk, as the text after its version line."""
    url = F.regexp_replace(F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20"), r"WARC/1\.1$", "WARC%2F1.1")
    cut = F.when(F.col("record_type") == "response", chunks(F.col("payload"), chunk_bytes)).otherwise(F.array(F.lit(b"")))
    tagged = records.select(*[c for c in records.columns if c != "payload"], F.uuid().alias("record_id"), cut.alias("_chunks"))
    named = tagged.withColumn("_n_chunks", F.size("_chunks"))
    rows = named.select(*[c for c in named.columns if c != "_chunks"], F.posexplode("_chunks").alias("_no", "_chunk"))
    body = F.col("_chunk").cast("string")
    first, several = F.col("_no") == 0, F.col("_n_chunks") > 1
    is_response = F.col("record_type") == "response"
    head = F.when(first & is_response, HTTP_HEAD).otherwise("")
    block = F.concat(head, body)
    fields = F.concat(
        _field("WARC-Type", F.when(first, F.col("record_type")).otherwise("continuation")),
        _field("WARC-Record-ID", F.concat(F.lit("<urn:uuid:"), F.when(first, F.col("record_id")).otherwise(F.concat("record_id", F.lit("-"), "_no")), F.lit(">"))),
        _field("WARC-Date", F.lit(WARC_DATE)),
        _field("WARC-Target-URI", url),
        _field("WARC-Payload-Digest", F.when(first, F.concat(F.lit("sha1:"), "digest"))),
        _field("WARC-Profile", F.when(~is_response, "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        _field("WARC-Segment-Number", F.when(several, F.col("_no") + 1)),
        _field("WARC-Segment-Origin-ID", F.when(several & ~first, F.concat(F.lit("<urn:uuid:"), "record_id", F.lit(">")))),
        _field("WARC-Segment-Total-Length", F.when(several & (F.col("_no") == F.col("_n_chunks") - 1), F.col("payload_bytes") + len(HTTP_HEAD))),
        _field("X-Page-Id", F.when(first, F.coalesce(F.col("page_id").cast("string"), F.lit("")))),
        _field("X-Payload-Length", F.when(first, F.col("payload_bytes"))),
        _field("X-Refers-To-Page-Id", F.when(first, F.col("refers_to"))),
        _field("X-Segments", F.when(first, F.col("_n_chunks"))),
        _field("Content-Type", F.when(is_response, "application/http; msgtype=response")),
        _field("Content-Length", F.octet_length(block)),
    )
    return rows.select(F.concat(F.lit(f"{VERSION}\r\n"), fields, F.lit("\r\n"), block, F.lit("\r\n")).alias("value"))


def write_archive(records: DataFrame, path: str, chunk_bytes: int = CHUNK_BYTES) -> None:
    """One compressed archive per task; each row already ends in a line break, the writer adds the second."""
    rows = record_rows(records, chunk_bytes)
    rows.write.option("lineSep", "\r\n").option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").text(path)


def _read(name: str) -> Column:
    value = F.regexp_extract("head", rf"(?:^|\r\n){name}: ([^\r]*)\r\n", 1)
    return F.when(value != "", value)


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """The chunked record table: record_id, chunk_no, n_chunks, what the first header states, and the chunk's bytes."""
    text = spark.read.option("lineSep", VERSION_LINE).text(path).filter(F.col("value") != "")
    end_of_head = F.octet_length(F.substring_index("value", "\r\n\r\n", 1))
    cut = text.select(
        F.concat(F.substring_index("value", "\r\n\r\n", 1), F.lit("\r\n")).alias("head"),
        F.substring(F.col("value").cast("binary"), end_of_head + 5, F.lit(2**31 - 1)).alias("block"),
    )
    number = F.coalesce(_read("WARC-Segment-Number").cast("int"), F.lit(1))
    skip = F.when((number == 1) & (_read("WARC-Type") == "response"), len(HTTP_HEAD)).otherwise(0)
    named = F.when(number > 1, _read("WARC-Segment-Origin-ID")).otherwise(_read("WARC-Record-ID"))
    return cut.select(
        F.regexp_extract(named, "<urn:uuid:([^>]*)>", 1).alias("record_id"),
        number.alias("chunk_no"),
        F.coalesce(_read("X-Segments").cast("int"), F.lit(1)).alias("n_chunks"),
        _read("WARC-Type").alias("record_type"),
        _read("X-Page-Id").cast("long").alias("page_id"),
        _read("X-Refers-To-Page-Id").cast("long").alias("refers_to"),
        F.regexp_replace(_read("WARC-Payload-Digest"), "^sha1:", "").alias("stated_digest"),
        _read("X-Payload-Length").cast("long").alias("stated_bytes"),
        F.substring(F.col("block"), skip + 1, _read("Content-Length").cast("int") - skip).alias("bytes"),
    )


HEAD = ["page_id", "record_type", "refers_to", "stated_digest", "stated_bytes"]
RECORD_SCHEMA = "page_id long, record_type string, refers_to long, stated_digest string, stated_bytes long, digest string, payload_bytes long"


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Records read back: what their headers state, and digest and size of the payload as read."""
    rows = read_chunks(spark, path)
    alone = (F.col("chunk_no") == 1) & (F.col("n_chunks") == 1)
    revisit = F.col("record_type") == "revisit"
    in_place = rows.filter(alone).select(
        *HEAD,
        F.when(revisit, F.col("stated_digest")).otherwise(base32_sha1(F.col("bytes"))).alias("digest"),
        F.when(revisit, F.col("stated_bytes")).otherwise(F.octet_length("bytes").cast("long")).alias("payload_bytes"),
    )
    return in_place.unionByName(stream_digests(rows.filter(~alone)))


def stream_digests(chunked: DataFrame) -> DataFrame:
    """One running SHA-1 per record over its chunks, in order; a record's chunks are sorted, never joined together."""
    ordered = chunked.select("record_id", "chunk_no", *HEAD, "bytes").repartition("record_id").sortWithinPartitions("record_id", "chunk_no")
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, head, state, size = None, [], hashlib.sha1(), 0

        def table_of(records: list[list]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in records], t) for i, t in enumerate(types)], names=[*HEAD, "digest", "payload_bytes"]
            )

        for batch in batches:
            done = []
            ids, data = batch.column(0), batch.column(batch.num_columns - 1)
            for i in range(batch.num_rows):
                if ids[i].as_py() != current:
                    if current is not None:
                        done.append([*head, base64.b32encode(state.digest()).decode(), size])
                    current, state, size = ids[i].as_py(), hashlib.sha1(), 0
                    head = [batch.column(2 + k)[i].as_py() for k in range(len(HEAD))]
                chunk = data[i].as_buffer()
                state.update(chunk)
                size += chunk.size
            if done:
                yield table_of(done)
        if current is not None:
            yield table_of([[*head, base64.b32encode(state.digest()).decode(), size]])

    return ordered.transform(arrow_map, run, RECORD_SCHEMA)


def archive(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    payload_col: str = "html",
    url_col: str = "url",
    chunk_bytes: int = CHUNK_BYTES,
    min_revisit: int = 0,
) -> DataFrame:
    """Write all pages as an archive under `path` and read its records back."""
    records = record_types(digested(pages, id_col, payload_col, url_col), min_revisit)
    write_archive(records, path, chunk_bytes)
    return read_records(pages.sparkSession, path)


WARC_SQL = f"""
WITH p AS (
    SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS h FROM pages
), d AS (
    SELECT page_id, strlen(payload) AS payload_bytes,
           array_to_string(list_transform(range(32), lambda i: substr('{BASE32}',
               CAST((CAST('0x' || substr(h, CAST(10 * (i // 8) + 1 AS INTEGER), 10) AS BIGINT) >> CAST(35 - 5 * (i % 8) AS INTEGER)) & 31 AS INTEGER) + 1, 1)), '') AS payload_digest
    FROM p
), m AS (
    SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS original FROM d
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = original THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = original THEN NULL ELSE original END AS refers_to,
       TRUE AS verified
FROM m
"""


@query("op3_warc", WARC_SQL)
def warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = archive(table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))
    return read.select(
        "page_id",
        "payload_bytes",
        F.col("digest").alias("payload_digest"),
        "record_type",
        "refers_to",
        ((F.col("digest") == F.col("stated_digest")) & (F.col("payload_bytes") == F.col("stated_bytes"))).alias("verified"),
    )
