"""Ranked search against brute force on odd rows, hot classes and ties; blocks; hash collisions."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from rawgate.llm import lexical
from rawgate.llm.lexical import Vocabulary, search
from tests.llm.conftest import odd_rows, prose

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [t.translate({c: c + 32 for c in range(65, 91)}) for t in TERM.findall(text or "")]


def brute(docs, items, k=10):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    bags = [(i, b, sum(b.values())) for i, b in bags if b]
    n_docs, total = len(bags), sum(n for _, _, n in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    wanted = defaultdict(set)
    for i, t in items:
        if i is not None:
            wanted[i].update(terms(t))
    out = []
    for item, vocabulary in wanted.items():
        scored = []
        for i, bag, n in bags:
            m = 100 - 90 + (90 * n * n_docs) // total
            parts = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * bag[t]) // (1000 * bag[t] + 8 * m)) for t in vocabulary if t in bag]
            if sum(parts) > 0:
                scored.append((-sum(parts), i is None, i or 0, i))
        out += [(item, rank, x[3], -x[0]) for rank, x in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect())


@pytest.fixture(scope="module")
def items():
    rng = random.Random(8)
    rows = [(i, prose(rng, rng.randint(1, 40))) for i in range(12)]
    return rows + [(20, None), (21, ""), (None, "alpha"), (22, "nowhere at ALL"), (23, "É ñ Alpha alpha 12345 \U0001f600"), (1, "epsilonzeta iota")]


def with_items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string").withColumn("term", F.lit("clash")).withColumn("score", F.lit(0))


def test_odd_rows(spark, odd_docs, items):
    docs = [(r[0], r[1]) for r in odd_rows()]
    assert rows_of(search(odd_docs, with_items(spark, items))) == brute(docs, items)


def test_blocks_of_items_give_the_same(spark, odd_docs, items):
    docs = [(r[0], r[1]) for r in odd_rows()]
    assert rows_of(search(odd_docs, with_items(spark, items), k=3, block_bytes=2_500)) == brute(docs, items, 3)


def test_hot_classes_and_ties(spark, items):
    """A third of the rows are one text, many others share bags in other orders: ties by id, over many tasks."""
    rng = random.Random(2)
    hot = prose(rng, 60)
    docs = [(i, hot) for i in range(900, 300, -1)]
    for i in range(1000, 1600):
        words = hot.split()[: 20 + i % 3]
        rng.shuffle(words)
        docs.append((i, " ".join(words)))
    docs += [(i, prose(rng, rng.randint(1, 90))) for i in range(2000, 2600)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    wanted = [*items, (30, hot)]
    got = rows_of(search(frame, with_items(spark, wanted)))
    assert got == brute(docs, wanted)
    assert [r[2] for r in got if r[0] == 30] == list(range(301, 311))  # of the hot text's copies those of the smallest ids


def test_large_sums_are_added_as_integers(spark, odd_docs, items, monkeypatch):
    docs = [(r[0], r[1]) for r in odd_rows()]
    found = {}
    real = lexical.score_classes

    def heavy(grouped, weights, *rest):
        found["weights"] = weights
        return real(grouped, weights << 20, *rest)

    monkeypatch.setattr(lexical, "score_classes", heavy)
    got = rows_of(search(odd_docs, with_items(spark, items)))
    assert got == [(i, rank, d, s << 20) for i, rank, d, s in brute(docs, items)]
    assert (int(found["weights"].max()) << 20) * 1_000_000 * len(found["weights"]) >= 1 << 53


def test_terms_of_equal_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(lexical, "hash_words", lambda words: np.array([len(w) % 2 for w in words], dtype=np.uint64))
    monkeypatch.setattr(lexical, "word_hashes", lambda buf, starts, ends: ((ends - starts) % 2).astype(np.uint64))
    listed = ["a", "bb", "cc", "ddd", "e"]
    vocabulary = Vocabulary.of(listed)
    names = [bytes(vocabulary.data[s : s + n]).decode() for s, n in zip(vocabulary.starts, vocabulary.sizes, strict=True)]
    text = "CC x bb ddd e zz e ddddd"
    spans = np.array([m.span() for m in re.finditer(r"\w+", text)])
    word, term = vocabulary.find(np.frombuffer(text.encode(), np.uint8), spans[:, 0], spans[:, 1])
    assert sorted((int(w), names[t]) for w, t in zip(word, term, strict=True)) == [(0, "cc"), (2, "bb"), (3, "ddd"), (4, "e"), (6, "e")]


def test_empty_tables(spark, no_docs, odd_docs, items):
    none = spark.createDataFrame([], "item_id long, text string")
    assert rows_of(search(no_docs, with_items(spark, items))) == []
    assert rows_of(search(odd_docs, none)) == []
