"""Eigenpairs against numpy, whole results against a plain computation, odd rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from rawgate.llm.registry import QUERIES
from rawgate.llm.whitening import leading_eigenpairs, tridiagonalise, whitened

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k=4):
    """{(vec_id, component): (n, deviation, |whitened|, explained)} by numpy's own solver."""
    kept = [(i, [math.floor(256 * float(np.float32(c))) for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = np.array(sorted({tuple(x) for _, x in kept}), dtype=np.int64)
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    v = centred.T @ centred / n
    e, q = np.linalg.eigh(v)
    e, q = e[::-1], q[:, ::-1]
    out = []
    for i, x in kept:
        scaled = n * np.array(x) - sums
        for c in range(min(k, len(e))):
            out.append((i, c + 1, n, int((scaled.astype(object) ** 2).sum()), abs((scaled / n) @ q[:, c]) / math.sqrt(e[c]), e[c] / np.trace(v)))
    return sorted(out, key=lambda x: (x[0] is None, x[0] or 0, x[1], x[3]))


@pytest.mark.parametrize("kind", ["random", "equal", "blocks", "cluster", "zero"])
@pytest.mark.parametrize("d", [1, 2, 3, 7, 64])
def test_eigenpairs(kind, d):
    rng = np.random.default_rng(d)
    a = rng.standard_normal((d, 3 * d))
    if kind == "random":
        a = a @ a.T
    elif kind == "equal":
        a = 5.0 * np.eye(d)
    elif kind == "blocks":
        a = np.diag(np.resize([7.0, 7.0, 2.0], d))
    elif kind == "cluster":
        q = np.linalg.qr(a[:, :d])[0]
        a = q @ np.diag(np.r_[[9.0, 9.0 - 1e-13, 9.0 - 1e-9, 9.0 - 1e-5][:d], np.ones(max(d - 4, 0))]) @ q.T
        a = (a + a.T) / 2
    else:
        a = np.zeros((d, d))
    values, vectors = leading_eigenpairs(a, 4)
    k = min(d, 4)
    size = max(np.abs(a).max(), 1e-300)
    assert np.abs(values - np.linalg.eigvalsh(a)[::-1][:k]).max() <= 1e-13 * size
    assert np.abs(vectors.T @ vectors - np.eye(k)).max() <= 1e-12
    assert np.abs(a @ vectors - vectors * values).max() <= 1e-13 * size * d


def test_tridiagonal_form():
    a = np.random.default_rng(1).standard_normal((20, 20))
    a = a + a.T
    diagonal, off, q = tridiagonalise(a)
    t = np.diag(diagonal) + np.diag(off, 1) + np.diag(off, -1)
    assert np.abs(q @ t @ q.T - a).max() < 1e-12
    assert np.abs(q.T @ q - np.eye(20)).max() < 1e-13


def test_query_against_brute_force(spark, tables):
    rng = np.random.default_rng(4)
    mixing = rng.standard_normal((9, 9))
    rows = [(int(i), [float(np.float32(c)) for c in rng.standard_normal(9) @ mixing]) for i in range(300)]
    rows += [(1000 + i, rows[0][1]) for i in range(150)]  # one vector that a third of the rows share
    rows += [(5, rows[5][1]), (5, rows[5][1]), (None, rows[6][1]), (2000, None), (2001, []), (2002, [1.0]), (2003, [None] * 9)]
    rows += [(2004, [float("nan"), *rows[1][1][1:]]), (2005, [*rows[1][1][:8], float("inf")]), (2006, [-0.0] * 9)]
    frame = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA).withColumn("x", F.lit("clash")).withColumn("n", F.lit(0)).repartition(5)
    got = QUERIES["op11_embedding_whitening"](spark, tables(embeddings=frame)).collect()
    want = brute([r for r in rows if r[1] is None or len(r[1]) == 9])
    got = sorted(got, key=lambda r: (r["vec_id"] is None, r["vec_id"] or 0, r["component"], r["deviation"]))
    assert [(r["vec_id"], r["component"], r["n"], r["deviation"]) for r in got] == [w[:4] for w in want]
    assert np.allclose([abs(r["whitened"]) for r in got], [w[4] for w in want], rtol=1e-9, atol=1e-11)
    assert np.allclose([r["explained"] for r in got], [w[5] for w in want], rtol=1e-10)
    assert {r["identity_error"] for r in got} == {got[0]["identity_error"]}
    assert 0 <= got[0]["identity_error"] < 1e-9


def test_signs_agree_between_rows(spark):
    """Opposite vectors get opposite values: one sign per component for all rows."""
    rows = [(i, [float(i), float(i * i % 7), 0.0]) for i in range(-20, 21)]
    got = {(r["vec_id"], r["component"]): r["whitened"] for r in whitened(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert {c for _, c in got} == {1, 2}  # the third dimension does not vary
    assert got[(-20, 1)] * got[(20, 1)] < 0


def test_large_entries_stay_exact(spark):
    rows = [(0, [1e12, -1e12]), (1, [-1e12, 1e12]), (2, [0.0, 5.0])]
    got = whitened(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).filter("component = 1").collect()
    x = [[math.floor(256 * c) for c in v] for _, v in rows]
    sums = [sum(c) for c in zip(*x, strict=True)]
    assert {r["vec_id"]: int(r["deviation"]) for r in got} == {i: sum((3 * c - s) ** 2 for c, s in zip(v, sums, strict=True)) for i, v in enumerate(x)}


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [0.5, 0.5]), (2, [0.5, 0.5])], [(1, [])]])
def test_nothing_varies(spark, rows):
    assert whitened(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect() == []
