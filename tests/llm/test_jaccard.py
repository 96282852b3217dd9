import random
import re
from collections import Counter, defaultdict

import pytest

from rawgate.llm import jaccard
from rawgate.llm.common import LOWER, SPACED_WORD, UPPER
from rawgate.llm.components import connected_components
from tests.llm.conftest import WORDS, odd_rows, prose


def brute(docs, percent=90, size=3):
    """(id, set size, smallest id reachable, number of linked rows), row by row."""
    lower = str.maketrans(UPPER, LOWER)
    sets = []
    for _, text in docs:
        w = re.findall(SPACED_WORD, (text or "").translate(lower))
        sets.append({tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set()))
    holders, parent, links = defaultdict(list), list(range(len(docs))), [0] * len(docs)

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a, s in enumerate(sets):
        shared = Counter(b for x in s for b in holders[x])
        for x in s:
            holders[x].append(a)
        for b, k in shared.items():
            if 100 * k >= percent * (len(s) + len(sets[b]) - k):
                links[a] += 1
                links[b] += 1
                parent[root(a)] = root(b)
    least = {}
    for a, (i, _) in enumerate(docs):
        r = root(a)
        least[r] = i if least.get(r) is None else least[r] if i is None else min(least[r], i)
    return sorted(((i, len(sets[a]), least[root(a)], links[a]) for a, (i, _) in enumerate(docs)), key=str)


def near_copies(rng, first, n, length, most):
    base = prose(rng, length).split()
    for i in range(n):
        words = list(base)
        for _ in range(rng.randint(0, most)):
            at = rng.randrange(len(words))
            words[at : at + rng.choice([0, 1])] = [rng.choice(WORDS) + str(rng.randrange(9))]
        yield first + i, " ".join(words)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    docs = [(i, t) for i, t, *_ in odd_rows()]
    for k, (length, most) in enumerate([(9, 1), (11, 1), (12, 2), (25, 2), (60, 3), (150, 8), (150, 3), (600, 30)]):
        docs += list(near_copies(rng, 1000 + 100 * k, 45, length, most))
    passage = prose(rng, 70)
    docs += [(3000 + i, passage + " " + prose(rng, rng.randint(1, 60))) for i in range(60)]
    docs += [(4000 + i, prose(rng, rng.randint(1, 12))) for i in range(60)] + [(5000 + i, "one common line of words here") for i in range(40)]
    rng.shuffle(docs)
    return docs


def run(spark, docs, **options):
    frame = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS n", "'x' AS digest", "'y' AS grp").repartition(5)
    return sorted((tuple(r) for r in jaccard.ngram_jaccard(frame, **options).collect()), key=str)


def test_equals_brute_force(spark, rows):
    assert run(spark, rows) == brute(rows)


@pytest.mark.parametrize(
    "limits",
    [
        {"GROUP_MEMBERS": 3, "SALT_ABOVE": 5, "QUERIES_PER_PART": 4},
        {"GROUP_TOKENS": 500, "HEAVY_ABOVE": 2, "HEAVY_TOKENS": 100_000},
        {"HEAVY_ABOVE": 1, "HEAVY_TOKENS": 50, "GROUP_MEMBERS": 7},
    ],
)
def test_bounds_do_not_change_the_result(spark, rows, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(jaccard, name, value)
    monkeypatch.setattr(jaccard.OpenGroup, "WIDTH", 64)
    assert run(spark, rows) == brute(rows)


@pytest.mark.parametrize("percent, shingle", [(50, 3), (80, 5), (100, 3), (70, 1)])
def test_other_thresholds(spark, rows, percent, shingle):
    some = rows[::3]
    assert run(spark, some, percent=percent, shingle=shingle) == brute(some, percent, shingle)


def test_stage_keeps_one_of_each_component(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS id", "'y' AS row")
    kept = sorted((r.doc_id for r in jaccard.keep_one(spark, frame, "").collect()), key=str)
    want = [i for i, n, c, _ in brute(rows, percent=80, size=5) if not n or i == c]
    assert kept == sorted(want, key=str)


def test_empty_table(spark, no_docs):
    assert jaccard.ngram_jaccard(no_docs).count() == 0
    assert jaccard.keep_one(spark, no_docs, "").count() == 0


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 300)] + [(1000, 1000 + i) for i in range(1, 200)]
    edges += [(rng.randrange(2000, 2600), rng.randrange(2000, 2600)) for _ in range(250)]
    rng.shuffle(edges)
    parent = {x: x for e in edges for x in e}

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for x in parent if any(x in e and e[0] != e[1] for e in edges)}
