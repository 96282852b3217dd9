import hashlib
import math
import time

import pytest
from pyspark.sql import functions as F

from rawgate.llm import mixing
from tests.llm.conftest import SCHEMA, odd_rows


def uniform(*parts):
    text = "/".join("" if p is None else str(p) for p in parts)
    return int(hashlib.md5(text.encode()).hexdigest()[:13], 16) / 16**13


def quantile(rate, u):
    k, p = 0, math.exp(-rate)
    total = p
    while total <= u:
        k += 1
        p *= rate / k
        total += p
    return k


def brute(rows, weights=None):
    size = {}
    for _, text, _, source, _ in rows:
        size[source] = size.get(source, 0) + len(text or "")
    w = {s: (n**0.5 if weights is None else weights.get(s, 0)) for s, n in size.items()}
    total, chars = sum(w.values()), sum(size.values())
    out = []
    for i, text, _, source, _ in rows:
        rate = w[source] / total * chars / size[source] if size[source] else 1
        u = uniform(mixing.SEED, "count", i, hashlib.md5((text or "").encode()).hexdigest())
        out += [(i, k) for k in range(1, (quantile(rate, u) if rate > 0 else 0) + 1)]
    return sorted(out, key=str)


def test_odd_rows(odd_docs, no_docs):
    got = mixing.mix(odd_docs)
    assert sorted(((r.doc_id, r.copy) for r in got.collect()), key=str) == brute(odd_rows())
    assert [c for c in odd_docs.columns] == got.columns[:-2]
    keys = [(r.doc_id, r.copy, r.shuffle_key) for r in got.collect()]
    assert all(key == uniform(mixing.SEED, "order", i, c) for i, c, key in keys)
    assert mixing.mix(no_docs).count() == 0


def test_weights(spark):
    rows = [(i, "x" * 100, "en", "big" if i % 4 else "small", 100) for i in range(4000)]
    docs = spark.createDataFrame(rows, SCHEMA)
    weights = {"big": 0.4, "small": 0.6, "absent": 9.0}
    got = {r.source: r["count"] for r in mixing.mix(docs, weights).groupBy("source").count().collect()}
    share = got["small"] / sum(got.values())
    assert abs(share - 0.6) < 0.03 and abs(sum(got.values()) - 4000) < 250
    assert sorted(((r.doc_id, r.copy) for r in mixing.mix(docs, weights).collect()), key=str) == brute(rows, weights)
    assert {r.source for r in mixing.mix(docs, {"small": 1.0}).collect()} == {"small"}
    for bad in ({"big": -1.0}, {"big": math.nan}):
        with pytest.raises(ValueError):
            mixing.mix(docs, bad)


def test_counts_do_not_depend_on_partitions_or_order(spark):
    docs = spark.createDataFrame([(i, "y" * (i % 7), "en", "s%d" % (i % 3), 1) for i in range(500)], SCHEMA)
    once = sorted((r.doc_id, r.copy, r.shuffle_key) for r in mixing.mix(docs).collect())
    again = sorted((r.doc_id, r.copy, r.shuffle_key) for r in mixing.mix(docs.orderBy(F.rand()).repartition(7)).collect())
    assert once == again


@pytest.mark.parametrize("rate", [0.01, 1.0, 7.5, 200.0, 2000.0])
def test_cumulative_table(spark, rate):
    row = mixing.cumulative(spark.createDataFrame([("s", rate)], "source string, rate double")).collect()[0]
    table = [0.0] * row["first"] + row["cdf"]
    assert all(a <= b for a, b in zip(table, table[1:])) and abs(table[-1] - 1) < 1e-9
    mean = sum(1 - c for c in table)
    assert abs(mean - rate) < 1e-6 * max(1, rate)


def test_counts_at_every_rate(spark):
    """Tables and lookups against sums of logarithms, from a rate of 0.01 to 1,000,000, in linear time."""
    rates = [0.01, 0.7, 5.0, 24.0, 140.0, 220.0, 500.0, 8_000.0, 1_000_000.0]
    frame = spark.createDataFrame([(f"s{i}" if i else None, r) for i, r in enumerate(rates)], "source string, rate double")
    start = time.time()
    tables = {r["source"]: (r["first"], r["cdf"]) for r in mixing.cumulative(frame).collect()}
    assert time.time() - start < 15
    us = [(i + 0.5) / 97 for i in range(97)] + [0.0, 1 - 2**-52]
    for i, rate in enumerate(rates):
        first, cdf = tables[f"s{i}" if i else None]
        assert len(cdf) <= 20 * math.sqrt(rate) + 300
        assert cdf == sorted(cdf) and abs(cdf[-1] - 1) < 1e-9
        total, k, at = 0.0, max(0, int(rate - 40 * math.sqrt(rate)) - 1), {}
        steps = sorted(us)
        for u in steps:
            while True:
                more = total + math.exp(k * math.log(rate) - rate - math.lgamma(k + 1))
                if more > u or (more == total and k > rate):
                    break
                total, k = more, k + 1
            at[u] = (k, min(abs(total - u), abs(more - u)))
        found = spark.createDataFrame([(u, first, cdf) for u in us], "u double, first int, cdf array<double>")
        got = {r["u"]: r["n"] for r in found.select("u", mixing.count_at(F.col("u"), F.col("first"), F.col("cdf")).alias("n")).collect()}
        assert all(got[u] == at[u][0] or at[u][1] < 1e-7 for u in us), rate
        assert all(got[u] == first + sum(c <= u for c in cdf) for u in us)
