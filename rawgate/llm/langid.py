"""Language identification: averaged hashed subword embeddings and a linear softmax.

A text is the mean of the embeddings of its subwords (runs of 1 to 3 bytes
inside a word, with a mark at the word's edge), hashed into buckets. Embeddings
and softmax are trained by stochastic gradient descent in numpy on a bounded
sample: about `per_language` labelled texts of each language, chosen by a hash
of the id, whole texts of at most `max_train_chars`. A fifth of the sample is
kept out of the training; it sets the softmax temperature and the score below
which a prediction is marked as rejected.

Prediction goes over every whole text. Since both layers are linear, each
bucket's contribution to each language is one table, and a text's logits are
the mean of the table rows of its subwords: no shuffle, memory bounded by a
tile of bytes.

Defined cases: null text or a text without a letter is `und` with score 0; so
is every text when no labelled text is there to learn from. Null or repeated
ids are passed through, one row each. Other columns are neither read nor
returned.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rawgate.llm.common import LOWER_BYTES, arrow_map, bytes_of, remainder, slices, table
from rawgate.llm.registry import query

BUCKET_BITS = 16
DIMENSIONS = 16
SIZES = (1, 2, 3)
TILE = 128 << 10
NO_BUCKET = 1 << BUCKET_BITS

UNKNOWN = "und"

#: letters and bytes of non-ASCII characters as they are (A-Z lower-cased), all else 0, the edge mark
LETTER = np.where([chr(b).isascii() and chr(b).isalpha() or b >= 0x80 for b in range(256)], LOWER_BYTES, 0).astype(np.uint8)


def subwords(buf: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first byte, stop, buckets): per size and tile the bucket of the subword that begins at each byte.

    Bytes where no subword begins get NO_BUCKET. `buf` holds one text or texts
    with at least one edge byte between them.
    """
    n = len(buf)
    letters = LETTER[buf]
    for at in range(0, n, TILE):
        stop = min(n, at + TILE)
        here = letters[at : min(n, stop + max(SIZES) - 1)].astype(np.uint32)
        inside = here > 0
        for size in SIZES:
            m = min(stop - at, len(here) - size + 1)
            if m <= 0:
                continue
            value = np.full(m, np.uint32(0x811C9DC5 + size), dtype=np.uint32)
            for k in range(size):
                value ^= here[k : k + m]
                value *= np.uint32(0x01000193)
            good = inside[:m] | inside[size - 1 : size - 1 + m]
            for k in range(1, size - 1):
                good &= inside[k : k + m]
            value *= np.uint32(0x9E3779B1)
            value >>= np.uint32(32 - BUCKET_BITS)
            value[~good] = NO_BUCKET
            yield at, at + m, value.astype(np.intp)


def with_edges(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same texts with an edge byte before each and at the end."""
    n_rows = len(offsets) - 1
    out = np.zeros(len(buf) + n_rows + 1, dtype=np.uint8)
    kept = np.ones(len(out), dtype=bool)
    moved = offsets + np.arange(n_rows + 1)
    kept[moved] = False
    out[kept] = buf
    return out, moved


@dataclass
class LanguageModel:
    languages: list[str]
    contributions: np.ndarray  # language x bucket, divided by the temperature; 0 for NO_BUCKET
    bias: np.ndarray
    reject_below: float

    def predict(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best language number and its probability for each row."""
        n_rows, n_languages = len(offsets) - 1, len(self.languages)
        sums = np.zeros((n_rows, n_languages))
        counts = np.zeros(n_rows)
        edged, begins = with_edges(buf, offsets)
        for at, stop, buckets in subwords(edged):
            rows = np.arange(max(0, np.searchsorted(begins, at, side="right") - 1), min(n_rows, np.searchsorted(begins, stop)))
            if not len(rows):
                continue
            first = np.maximum(begins[rows] - at, 0)
            counts[rows] += np.add.reduceat(buckets != NO_BUCKET, first, dtype=np.int64)
            for k, of_language in enumerate(self.contributions):
                sums[rows, k] += np.add.reduceat(of_language[buckets], first)
        logits = sums / np.maximum(counts, 1)[:, None] + self.bias
        shares = np.exp(logits - logits.max(axis=1, keepdims=True))
        shares /= shares.sum(axis=1, keepdims=True)
        best = shares.argmax(axis=1)
        return best, shares[np.arange(n_rows), best]


def _features(text: str) -> tuple[np.ndarray, np.ndarray]:
    edged, _ = with_edges(*bytes_of(pa.array([text])))
    parts = np.concatenate([buckets for _, _, buckets in subwords(edged)])
    buckets, counts = np.unique(parts[parts != NO_BUCKET], return_counts=True)
    return buckets, (counts / max(counts.sum(), 1)).astype(np.float32)


def fit(texts: list[str], labels: list[str], epochs: int = 8, rate: float = 4.0, seed: int = 7) -> LanguageModel:
    """SGD over single texts and, so that short texts are known too, over one line of each."""
    languages = sorted(set(labels))
    rng = np.random.default_rng(seed)
    n_languages = len(languages)
    number = {x: i for i, x in enumerate(languages)}
    kept_out = [i % 5 == 4 for i in range(len(texts))] if len(texts) >= 50 else [False] * len(texts)
    train, calibrate = [], []
    for text, label, out in zip(texts, labels, kept_out, strict=True):
        lines = [x for x in text.split("\n") if x.strip()] or [text]
        for piece in (text, lines[rng.integers(len(lines))]):
            (calibrate if out else train).append((*_features(piece), number[label]))
    embed = rng.normal(0, 0.1, (1 << BUCKET_BITS, DIMENSIONS)).astype(np.float32)
    out_layer = np.zeros((DIMENSIONS, n_languages), dtype=np.float32)
    bias = np.zeros(n_languages, dtype=np.float32)
    steps, step = max(1, epochs * len(train)), 0
    for _ in range(epochs):
        for i in rng.permutation(len(train)):
            buckets, weights, label = train[i]
            step += 1
            if not len(buckets):
                continue
            now = rate * (1 - step / steps)
            mean = weights @ embed[buckets]
            logits = mean @ out_layer + bias
            error = np.exp(logits - logits.max())
            error /= error.sum()
            error[label] -= 1
            back = out_layer @ error
            out_layer -= now * np.outer(mean, error)
            bias -= 0.02 * now * error
            embed[buckets] -= now * weights[:, None] * back
    contributions = embed @ out_layer
    held = [(w @ contributions[b] + bias, y) for b, w, y in (calibrate or train) if len(b)]
    temperature, reject_below = 1.0, 0.0
    if held:
        logits, truth = np.array([x for x, _ in held], dtype=np.float64), np.array([y for _, y in held])

        def shares(t: float) -> np.ndarray:
            e = np.exp((logits - logits.max(axis=1, keepdims=True)) / t)
            return e / e.sum(axis=1, keepdims=True)

        def loss(t: float) -> float:
            return -np.log(np.maximum(shares(t)[np.arange(len(truth)), truth], 1e-12)).mean()

        temperature = min(np.geomspace(0.05, 20, 60), key=loss)
        calibrated = shares(temperature)
        right = calibrated.argmax(axis=1) == truth
        if right.any():
            reject_below = float(np.quantile(calibrated.max(axis=1)[right], 0.01))
    return LanguageModel(languages, np.append(contributions.T / temperature, np.zeros((n_languages, 1)), axis=1).astype(np.float32), bias / temperature, reject_below)


def train(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    id_col: str = "doc_id",
    per_language: int = 600,
    max_train_chars: int = 100_000,
) -> LanguageModel | None:
    """Fit on a bounded sample of the labelled rows; None if there are none.

    About `per_language` texts of each language are taken, by a hash of the
    id; each is at most `max_train_chars` long, so the sample's size has a bound
    that does not depend on the corpus.
    """
    labelled = docs.select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"), F.xxhash64(F.col(id_col)).alias("h")
    ).filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & (F.length("text") <= max_train_chars))
    counts = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # a row per language
    if not counts:
        return None
    steps = 1 << 30
    limit = F.create_map(*[x for lang, n in counts.items() for x in (F.lit(lang), F.lit(min(steps, steps * per_language // n)))])
    sample = labelled.filter(F.pmod("h", F.lit(steps)) < limit[F.col("lang")]).collect()
    sample.sort(key=lambda r: (r["h"], r["lang"], r["text"]))
    return fit([r["text"] for r in sample], [r["lang"] for r in sample])


def has_letter(text: bytes) -> bool:
    return any(c.isalpha() for c in text.decode("utf-8", "replace"))


ASCII_LETTER = np.array([chr(b).isascii() and chr(b).isalpha() for b in range(256)])


def predict(docs: DataFrame, model: LanguageModel | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, lang_pred, score, rejected: one row per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*(model.languages if model else []), UNKNOWN], dtype=object)
        for batch in batches:
            for first, stop, buf, offsets in slices(batch.column(1)):
                n = stop - first
                best, score = model.predict(buf, offsets) if model else (np.zeros(n, np.int64), np.zeros(n))
                ascii_before = np.concatenate(([0], np.cumsum(ASCII_LETTER[buf])))
                for i in np.flatnonzero(ascii_before[offsets[1:]] == ascii_before[offsets[:-1]]):
                    if not has_letter(buf[offsets[i] : offsets[i + 1]].tobytes()):
                        best[i], score[i] = len(names) - 1, 0.0
                rejected = score < (model.reject_below if model else 1.0)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, n), pa.array(names[best], pa.string()), pa.array(score, pa.float64()), pa.array(rejected)],
                    names=[id_col, "lang_pred", "score", "rejected"],
                )

    schema = T.StructType(
        [
            T.StructField(id_col, docs.schema[id_col].dataType),
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("rejected", T.BooleanType()),
        ]
    )
    return docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text")).transform(arrow_map, run, schema)


@query("op7_language_id")
def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs.filter(remainder(F.col("doc_id"), 4) != 2))
    found = predict(docs, model)
    return found.select("doc_id", (remainder(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score", "rejected")
