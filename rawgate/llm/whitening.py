"""Embedding whitening: the leading principal components of all embeddings, each scaled to unit variance.

1. Rows whose vector is null, or holds null, NaN or infinite entries, are left
   out. Each remaining entry c becomes the integer floor(256 * c).
2. The fit list is each distinct integer vector once. Duplicates are combined on
   the map side, so a vector that a third of the rows share costs one row a task.
3. Distributed centred covariance: tasks add up integer sums by dimension, which
   are exact; with them each vector is centred and only then multiplied, into one
   d x d partial per task. Partials are summed row by row of the matrix, by Spark.
4. On the driver, from the d x d matrix alone: Householder tridiagonalisation,
   Sturm counts and bisection for the leading eigenvalues, inverse iteration with
   reorthogonalisation inside clusters for their vectors, and the way back.
5. The components (k x d numbers) go out with the tasks, which project all rows.
6. The identity error is measured on what was projected: covar_pop of the whitened
   fit list against the identity.

What reaches the driver or is sent to tasks is bounded by the dimension d, not by
the rows: 8 d^2 bytes for the covariance, 8 k d for the components.

Defined cases: vectors whose length is not the most frequent one (of equally
frequent ones the longest) are left out, as are empty vectors; null and repeated
ids are rows as any other; components without variance (eigenvalue at most 1e-12
of the trace) do not exist, so a table of one distinct vector, or an empty one,
gives no rows; entries beyond what a long holds end at its limits; a deviation
beyond a long is kept as decimal(38, 0) by `whitened` and null in the query;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rawgate.llm.common import arrow_map, staged, table
from rawgate.llm.registry import query

SCALE = 256
COMPONENTS = 4
#: eigenvalues up to this share of the trace are no components
NO_VARIANCE = 1e-12
#: eigenvalues closer than this share of the norm are one cluster
CLUSTER = 1e-3

EPS = np.finfo(np.float64).eps


# --- eigenpairs of a symmetric matrix -------------------------------------------------


def tridiagonalise(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, off-diagonal, q) with a = q t q', by Householder reflections."""
    a = np.array(a, dtype=np.float64)
    d = len(a)
    q = np.eye(d)
    for k in range(d - 2):
        x = a[k + 1 :, k].copy()
        scale = np.abs(x).max()
        if scale == 0.0 or not np.abs(x[1:]).any():
            continue
        v = x / scale
        v[0] += np.copysign(np.linalg.norm(v), v[0])
        v /= np.linalg.norm(v)
        inner = a[k + 1 :, k + 1 :]
        p = inner @ v
        w = p - (v @ p) * v
        inner -= 2.0 * (np.outer(v, w) + np.outer(w, v))
        length = -np.copysign(np.linalg.norm(x / scale) * scale, x[0])
        a[k + 1 :, k] = a[k, k + 1 :] = 0.0
        a[k + 1, k] = a[k, k + 1] = length
        q[:, k + 1 :] -= 2.0 * np.outer(q[:, k + 1 :] @ v, v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), q


def count_below(diagonal: np.ndarray, off: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """For each shift the number of eigenvalues below it: negative pivots of t - shift (Sturm)."""
    tiny = EPS * max(np.abs(diagonal).max(initial=0.0), np.abs(off).max(initial=0.0), np.finfo(np.float64).tiny)
    counts = np.zeros(len(shifts), dtype=np.int64)
    pivot = np.ones(len(shifts))
    squares = np.concatenate(([0.0], off * off))
    for a, b2 in zip(diagonal, squares, strict=True):
        pivot = (a - shifts) - b2 / pivot
        pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
        counts += pivot < 0
    return counts


def leading_eigenvalues(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The k largest eigenvalues of a tridiagonal matrix, falling, by bisection until the bounds meet."""
    d = len(diagonal)
    reach = np.concatenate((np.abs(off), [0.0])) + np.concatenate(([0.0], np.abs(off)))
    low = np.full(k, (diagonal - reach).min())
    high = np.full(k, (diagonal + reach).max())
    margin = EPS * max(abs(low[0]), abs(high[0]))
    low, high = low - margin, high + margin
    wanted = d - np.arange(k)  # so many eigenvalues lie below anything above the one sought
    for _ in range(2_000):
        mid = low + (high - low) / 2
        open_ = (mid > low) & (mid < high)
        if not open_.any():
            break
        above = count_below(diagonal, off, mid) >= wanted
        high, low = np.where(open_ & above, mid, high), np.where(open_ & ~above, mid, low)
    return low + (high - low) / 2


def _solve(diagonal: np.ndarray, off: np.ndarray, shift: float, b: np.ndarray, tiny: float) -> np.ndarray:
    """x with (t - shift) x = b, by elimination with row exchanges; pivots of nothing become `tiny`."""
    d = len(diagonal)
    x = b.copy()
    main, up, up2 = diagonal - shift, np.append(off, 0.0), np.zeros(d)
    for i in range(d - 1):
        below = off[i]
        if abs(main[i]) >= abs(below):
            if main[i] == 0.0:
                main[i] = tiny
            f = below / main[i]
            main[i + 1] -= f * up[i]
            x[i + 1] -= f * x[i]
        else:
            f = main[i] / below
            main[i], (up[i], main[i + 1]) = below, (main[i + 1], up[i] - f * main[i + 1])
            up2[i], up[i + 1] = up[i + 1], -f * up[i + 1]
            x[i], x[i + 1] = x[i + 1], x[i] - f * x[i + 1]
    for i in range(d - 1, -1, -1):
        rest = x[i] - (up[i] * x[i + 1] if i + 1 < d else 0.0) - (up2[i] * x[i + 2] if i + 2 < d else 0.0)
        x[i] = rest / (main[i] if abs(main[i]) > tiny else np.copysign(tiny, main[i]))
        if abs(x[i]) > 1e200:
            x /= abs(x[i])
    return x


def inverse_iteration(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray, rounds: int = 6) -> np.ndarray:
    """Unit eigenvectors (columns) of falling eigenvalues; inside a cluster each is kept orthogonal to those before it."""
    d = len(diagonal)
    norm = max(np.abs(diagonal).max(initial=0.0) + 2 * np.abs(off).max(initial=0.0), np.finfo(np.float64).tiny)
    tiny = EPS * norm
    vectors = np.zeros((d, len(values)))
    start = np.random.default_rng(17)
    first, shift = 0, np.inf
    for j, value in enumerate(values):
        if j and values[j - 1] - value > CLUSTER * norm:
            first = j
        shift = min(value, shift - 10 * tiny) if j > first else value  # equal values get shifts of their own
        x = start.standard_normal(d)
        for _ in range(rounds):
            x = _solve(diagonal, off, shift, x / np.linalg.norm(x), tiny)
            x /= np.abs(x).max()
            for _ in range(2):
                x -= vectors[:, first:j] @ (vectors[:, first:j].T @ x)
        vectors[:, j] = x / np.linalg.norm(x)
    return vectors


def leading_eigenpairs(a: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues of a symmetric matrix, falling, and unit eigenvectors as columns."""
    k = min(k, len(a))
    if k == 0:
        return np.zeros(0), np.zeros((len(a), 0))
    size = np.abs(a).max()
    if size == 0.0:
        return np.zeros(k), np.eye(len(a))[:, :k]
    diagonal, off, q = tridiagonalise(a / size)
    values = leading_eigenvalues(diagonal, off, k)
    vectors = q @ inverse_iteration(diagonal, off, values)
    return values * size, vectors / np.linalg.norm(vectors, axis=0)


# --- Spark ------------------------------------------------------------------------------


@dataclass
class Whitening:
    """What is fitted: n distinct vectors, their sums, and the components (k x d) with eigenvalues and shares of the trace."""

    n: int
    sums: list[int]
    components: np.ndarray
    values: np.ndarray
    explained: np.ndarray
    identity_error: float = 0.0


def integer_vectors(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, x: rows with finite vectors of the table's length, as integers."""
    vector = F.col(vector_col).cast("array<double>")

    def finite(c: Column) -> Column:
        return F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False))

    usable = embeddings.select(F.col(id_col).alias("vec_id"), vector.alias("_v")).filter(
        F.col("_v").isNotNull() & (F.size("_v") > 0) & F.forall("_v", finite)
    )
    lengths = usable.groupBy(F.size("_v").alias("d")).agg(F.count("*").alias("n"))
    best = lengths.orderBy(F.desc("n"), F.desc("d")).limit(1).collect()
    d = best[0]["d"] if best else 0
    return usable.filter(F.size("_v") == d).select("vec_id", F.transform("_v", lambda c: F.floor(c * SCALE).cast("long")).alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as rows."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1) if len(column) else np.zeros((0, 0), np.int64)


def _scaled(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - sums, exactly: int64 if all fit, else Python integers."""
    largest = int(np.abs(x.astype(np.float64)).max(initial=0.0)) + 1
    if largest * n + max(map(abs, sums)) < 1 << 62:
        return x * np.int64(n) - np.array(sums, dtype=np.int64)
    return x.astype(object) * n - np.array(sums, dtype=object)


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    return (_scaled(x, n, sums) / n).astype(np.float64)


def dimension_sums(fit_list: DataFrame) -> tuple[int, list[int]]:
    """Number of vectors and their exact sums by dimension (-1 counts the vectors)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for batch in batches:
            x = _matrix(batch.column(0))
            if not len(x):
                continue
            fits = (int(np.abs(x.astype(np.float64)).max(initial=0.0)) + 1) * len(x) < 1 << 62
            part = np.array((x if fits else x.astype(object)).sum(axis=0), dtype=object)
            n, total = n + len(x), part if total is None else total + part
        if n:
            sums = [Decimal(n), *(Decimal(int(s)) for s in total)]
            yield pa.RecordBatch.from_arrays([pa.array(range(-1, len(total)), pa.int32()), pa.array(sums, pa.decimal128(38, 0))], ["i", "s"])

    partial = arrow_map(fit_list.select("x"), run, "i int, s decimal(38,0)")
    rows = {r["i"]: int(r["s"]) for r in partial.groupBy("i").agg(F.sum("s").cast("decimal(38,0)").alias("s")).collect()}
    return rows.get(-1, 0), [rows[i] for i in range(len(rows) - 1)]


def centred_covariance(fit_list: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """Covariance with divisor n of vectors centred on the exact mean; partials of tasks are summed by Spark."""
    d = len(sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d))
        for batch in batches:
            x = _matrix(batch.column(0))
            for at in range(0, len(x), 4096):
                y = _centred(x[at : at + 4096], n, sums)
                total += y.T @ y
        rows = pa.FixedSizeListArray.from_arrays(pa.array(total.ravel()), d).cast(pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(d, dtype=np.int32)), rows], ["i", "v"])

    def add_up(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(d)
        for batch in batches:
            total += _matrix(batch.column("v")).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([total.tolist()], pa.list_(pa.float64()))], ["i", "v"])

    schema = "i int, v array<double>"
    summed = arrow_map(fit_list.select("x"), run, schema).groupBy("i").applyInArrow(add_up, schema)
    v = np.zeros((d, d))
    for row in summed.collect():
        v[row["i"]] = row["v"]
    return (v + v.T) / (2 * n)


def project(vectors: DataFrame, model: Whitening) -> DataFrame:
    """vec_id, deviation (decimal), whitened (an array, a value per component): no shuffle."""
    n, sums, scaling = model.n, model.sums, model.components.T / np.sqrt(model.values)
    k = len(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1))
            for at in range(0, len(x), 4096):
                y = _scaled(x[at : at + 4096], n, sums)
                w = (y / n).astype(np.float64) @ scaling
                fits = y.dtype != object and (int(np.abs(y).max(initial=0)) + 1) ** 2 * y.shape[1] < 1 << 63
                squares = (y * y).sum(axis=1) if fits else (y.astype(object) ** 2).sum(axis=1)
                if fits:
                    deviation = pa.array(squares, pa.int64()).cast(pa.decimal128(38, 0))
                else:
                    deviation = pa.array([Decimal(int(s)) if s < 10**38 else None for s in squares], pa.decimal128(38, 0))
                whitened = pa.FixedSizeListArray.from_arrays(pa.array(w.ravel()), k).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(y)), deviation, whitened], ["vec_id", "deviation", "whitened"])

    kind = vectors.schema["vec_id"].dataType.simpleString()
    return arrow_map(vectors.select("vec_id", "x"), run, f"vec_id {kind}, deviation decimal(38,0), whitened array<double>")


def fit(vectors: DataFrame, n_components: int = COMPONENTS) -> Whitening | None:
    """Components of the distinct vectors, with the identity error measured; None if nothing varies."""
    fit_list = staged(vectors.select("x").distinct(), "whiten-fit")
    n, sums = dimension_sums(fit_list)
    if n < 2:
        return None
    covariance = centred_covariance(fit_list, n, sums)
    trace = float(np.trace(covariance))
    values, components = leading_eigenpairs(covariance, n_components)
    real = values > NO_VARIANCE * trace
    if trace <= 0.0 or not real.any():
        return None
    values, components = values[real], components[:, real].T
    model = Whitening(n, sums, np.ascontiguousarray(components), values, values / trace)
    model.identity_error = identity_error(project(fit_list.select(F.lit(None).cast("int").alias("vec_id"), "x"), model), len(values))
    return model


def identity_error(projected: DataFrame, k: int) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity."""
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    w = [F.get("whitened", F.lit(i)) for i in range(k)]
    row = projected.agg(*[F.covar_pop(w[i], w[j]).alias(f"c{i}_{j}") for i, j in pairs]).collect()[0]
    return max(abs(row[f"c{i}_{j}"] - (i == j)) for i, j in pairs)


def whitened(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", n_components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation (decimal), whitened, explained, identity_error: a row per usable row and component."""
    vectors = integer_vectors(embeddings, id_col, vector_col)
    model = fit(vectors, n_components)
    kind = vectors.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    if model is None:
        return embeddings.sparkSession.createDataFrame([], schema)
    shares = F.array(*[F.lit(float(e)) for e in model.explained])
    rows = project(vectors, model).select("vec_id", "deviation", F.posexplode("whitened").alias("_i", "whitened"))
    return rows.select(
        "vec_id",
        (F.col("_i") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("_i")).alias("explained"),
        F.lit(float(model.identity_error)).alias("identity_error"),
    )


@query("op11_embedding_whitening")
def embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(table(spark, sf_dir, "embeddings")).withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))
