"""Text kernels over Arrow buffers, and small Spark helpers shared by the operators.

Both word classes treat every byte from 0x80 as part of a word, so words of
UTF-8 text can be found byte by byte, without decoding.
"""

from __future__ import annotations

import ctypes
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rawgate.session import scratch_path

#: words of letters and digits: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing A-Z
ALNUM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: words between ASCII white space
SPACED_WORD = r"[^\x20\x09-\x0D]+"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: bytes of text that a kernel works on at once; its arrays take some forty times as much
SLICE_BYTES = 512 << 10


def _alnum_table() -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    for lo, hi in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
        table[lo : hi + 1] = True
    return table


def _spaced_table() -> np.ndarray:
    table = np.ones(256, dtype=bool)
    table[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
    return table


IS_ALNUM = _alnum_table()
IS_SPACED = _spaced_table()

LOWER_BYTES = np.arange(256, dtype=np.uint8)
LOWER_BYTES[0x41:0x5B] += 32

BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the whole value (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE_CODES = mix64(np.arange(1, 257, dtype=np.uint64))
BYTE_CODES_LOWER = BYTE_CODES[LOWER_BYTES]


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Data bytes and offsets of a string or binary column; null counts as empty."""
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offset_buffer, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offset_buffer, dtype=np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    buf = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return buf, offsets - offsets[0]


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows with at most `limit` bytes, or one longer row: (first, stop, bytes, offsets)."""
    buf, offsets = bytes_of(column)
    first, n = 0, len(offsets) - 1
    while first < n:
        stop = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        stop = min(max(stop, first + 1), n)
        yield first, stop, buf[offsets[first] : offsets[stop]], offsets[first : stop + 1] - offsets[first]
        first = stop


def find_words(buf: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, pointer): byte spans of all words; words of row i are pointer[i]:pointer[i + 1]."""
    n = len(buf)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = is_word[buf]
    before = np.zeros(n, dtype=bool)
    before[1:] = inside[:-1]
    cuts = offsets[(offsets > 0) & (offsets < n)]
    before[cuts] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.zeros(n, dtype=bool)
    after[:-1] = inside[1:]
    after[cuts - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: list[np.ndarray], codes: np.ndarray = BYTE_CODES_LOWER) -> list[np.ndarray]:
    """64-bit hashes of byte spans, by prefix sums of a polynomial over the bytes.

    All spans of a word begin at its start; `ends` lists one or more ends for
    each, the longest first. The work goes in tiles of SLICE_BYTES, so that
    memory does not grow with the longest text. `codes` maps bytes (by default
    lower-casing A-Z).
    """
    out = [np.empty(len(starts), dtype=np.uint64) for _ in ends]
    i = 0
    while i < len(starts):
        origin = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends[0], origin + SLICE_BYTES, side="right")))
        size = int(ends[0][j - 1]) - origin
        power = np.full(size, BASE, dtype=np.uint64)
        power[0] = 1
        np.multiply.accumulate(power, out=power)
        sums = np.zeros(size + 1, dtype=np.uint64)
        np.cumsum(codes[buf[origin : origin + size]] * power, out=sums[1:])
        power.fill(BASE_INVERSE)
        power[0] = 1
        np.multiply.accumulate(power, out=power)
        s = starts[i:j] - origin
        for hashes, end in zip(out, ends, strict=True):
            e = end[i:j] - origin
            hashes[i:j] = mix64((sums[e] - sums[s]) * power[s] + (e - s).astype(np.uint64))
        i = j
    return out


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, codes: np.ndarray = BYTE_CODES_LOWER) -> np.ndarray:
    """A 64-bit hash per word."""
    return span_hashes(buf, starts, [ends], codes)[0]


def row_of(pointer: np.ndarray) -> np.ndarray:
    """For each word the row it stands in."""
    return np.repeat(np.arange(len(pointer) - 1), np.diff(pointer))


def hash_words(words: list[str]) -> np.ndarray:
    """Hashes of given (lower-case) words, as `word_hashes` makes them."""
    data = [w.encode() for w in words]
    buf = np.frombuffer(b" ".join(data), dtype=np.uint8) if data else np.zeros(0, np.uint8)
    sizes = np.array([len(d) for d in data], dtype=np.int64)
    starts = np.concatenate(([0], np.cumsum(sizes + 1)[:-1])) if data else np.zeros(0, np.int64)
    return word_hashes(buf, starts, starts + sizes)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only, whatever the locale; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def words_of(text: Column, pattern: str) -> Column:
    """All words that a pattern `[^...]+` finds, as an array (JVM side).

    They are what stands between the runs of the other characters: cutting
    there costs a tenth of searching for each word. Only the first and the
    last piece can be empty.
    """
    if not re.fullmatch(r"\[\^[^\[\]]+\]\+", pattern):
        raise ValueError(f"not a pattern of the form [^...]+: {pattern}")
    return F.array_remove(F.split(text, f"[{pattern.removeprefix('[^')}", -1), "")


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as the text 'null'."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("null")).cast("binary")), F.lit(modulus)).cast("int")


#: bytes of one Arrow batch, where the session has Spark's own default
BATCH_BYTES = 8 << 20
_BATCH_KEY, _BATCH_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", 64 << 20


def give_back() -> None:
    """Return freed memory to the system: Python workers are reused, and several share an executor's memory."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def arrow_map(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType | str) -> DataFrame:
    """`mapInArrow` over batches of bounded size, whatever the length of the texts."""
    conf = df.sparkSession.conf
    if conf.get(_BATCH_KEY, None) in (str(_BATCH_DEFAULT), f"{_BATCH_DEFAULT}b", "64MB", "64m"):
        conf.set(_BATCH_KEY, str(BATCH_BYTES))

    def bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return df.mapInArrow(bounded, schema)


def staged(df: DataFrame, label: str, compression: str = "zstd") -> DataFrame:
    """Write once to the shared folder and read back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_row(docs: DataFrame) -> Column:
    """All columns as one struct, so that columns added beside it cannot clash with them."""
    return F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in docs.columns])


#: a side is broadcast only if its measured size is below this
BROADCAST_BYTES = 16 << 20


def small(df: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> bool:
    """Whether a written table is known to be small: its rows are counted."""
    return df.count() * row_bytes <= limit


def broadcast_if_small(df: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """The side with a broadcast hint if its counted rows fit; else as it is, and the join shuffles."""
    return F.broadcast(df) if small(df, row_bytes, limit) else df
