import math
import random
import re
import time

import numpy as np
import pytest

from rawgate.llm import licenses
from rawgate.llm.common import ALNUM_WORD, LOWER, UPPER
from tests.llm.conftest import odd_rows

PHRASES = [(p.split(), label) for p, label in licenses.BASE_PHRASES]


def brute(text):
    words = re.findall(ALNUM_WORD, (text or "").translate(str.maketrans(UPPER, LOWER)))
    hits = [(i, label) for p, label in PHRASES for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]
    starts = [i for i, _ in hits]
    return len(words), len(hits), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in hits}))


def row(r):
    return r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels


def test_odd_rows(spark, odd_docs, tables):
    got = licenses.license_scan(spark, tables(documents=odd_docs.drop("weird.name"))).collect()
    want = sorted(((t[0], brute(t[1])) for t in odd_rows()), key=str)
    assert sorted(((r.doc_id, row(r)) for r in got), key=str) == want
    nine = next(r for r in got if r.doc_id == 9)
    assert nine.labels == "apache,apache-2.0,mit,mit-notice" and nine.score == pytest.approx(1, abs=0.5)
    assert all(0 <= r.score <= 1 for r in got)


def test_empty_table(spark, no_docs):
    assert licenses.scan_licenses(no_docs).count() == 0


@pytest.mark.parametrize(
    "text, labels",
    [
        ("MIT license MIT License", ["mit", "mit"]),
        ("mit. \n license", ["mit"]),
        ("mit the license", []),
        ("the GNU general public license, Version 3 of it", ["gpl"]),
        ("apache", []),
    ],
)
def test_phrases(spark, text, labels):
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    found = licenses.scan_licenses(docs).collect()[0].matches
    assert [m.label for m in found if m.base] == labels


def test_key_phrases_are_mandatory(spark):
    templates = [licenses.make_template("x", "under the terms of the green licence version 7", ("green licence", "version 7"))]
    texts = ["under the terms of the green licence version 7", "under the terms of the green licence version 8", "green licence version 7", "a b the green licence version 7"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: [(m.start, round(m.coverage, 2)) for m in r.matches] for r in licenses.scan_licenses(docs, templates, min_coverage=0.3).collect()}
    assert got[0] == [(0, 1.0)] and got[1] == [] and len(got[2]) == 1 and got[2][0][1] < 1 and got[3][0][0] == -2


def brute_matches(docs, templates, min_coverage):
    """{id: sorted (label, start, coverage)}: every template at every place, word by word."""
    words = {i: re.findall(ALNUM_WORD, (t or "").translate(str.maketrans(UPPER, LOWER))) for i, t in docs}
    idf = {w: math.log((len(docs) + 1) / (sum(w in set(x) for x in words.values()) + 1)) + 1 for t in templates for w in t.words}
    out = {}
    for i, text in words.items():
        found = out.setdefault(i, [])
        for t in templates:
            total = sum(idf[w] for w in t.words)
            for s in range(-len(t.words) + 1, len(text)):
                equal = [0 <= s + j < len(text) and text[s + j] == w for j, w in enumerate(t.words)]
                coverage = sum(idf[w] for w, e in zip(t.words, equal, strict=True) if e) / total
                if all(equal[j] for j in t.required) and coverage >= min_coverage - 1e-12:
                    found.append((t.label, s, round(coverage, 9)))
        found.sort()
    return out


def test_labels_and_scores_against_brute_force(spark, tables):
    rng = random.Random(31)
    pieces = [t[1] for t in licenses.TEMPLATES] + [p for p, _ in licenses.BASE_PHRASES] + ["version 2", "the License", "some other words"]
    docs = []
    for i in range(80):
        words = " ".join(rng.choice(pieces) for _ in range(rng.randint(0, 4))).split()
        for _ in range(rng.randint(0, 3)):
            if words:
                words[rng.randrange(len(words))] = rng.choice(["changed", "License", "MIT"])
        docs.append((i, " ".join(words)))
    templates = licenses.templates_of()
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    want = brute_matches(docs, templates, licenses.MIN_COVERAGE)
    got = {r.doc_id: sorted((m.label, m.start, round(m.coverage, 9)) for m in r.matches) for r in licenses.scan_licenses(frame).collect()}
    assert got == want
    base = {label for _, label in licenses.BASE_PHRASES}
    for r in licenses.license_scan(spark, tables(documents=frame)).collect():
        best = max((c for label, _, c in want[r.doc_id] if label not in base), default=0.0)
        assert r.labels == ",".join(sorted({label for label, _, _ in want[r.doc_id]}))
        assert r.score == pytest.approx(max(best, 0.5 if r.n_base else 0.0))


def test_time_does_not_grow_with_the_templates():
    """2,000 templates, or twenty of them: the same matches of those, in about the same time."""
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(9_000)]

    def made(i):
        own = [f"mark{i}a", f"mark{i}b"]
        text = [words[j] for j in rng.integers(0, len(words), 40)]
        text[7:9] = own
        return licenses.make_template(f"t{i}", " ".join(text), (" ".join(own),))

    many = [made(i) for i in range(2_000)]
    frequency = {w: 50 for w in words}
    text = [words[j] for j in rng.integers(0, len(words), 60_000)]
    for i in range(20):
        text[i * 2_500 : i * 2_500 + 40] = many[i].words

    def run(templates):
        index = licenses.LicenseIndex(templates, frequency, 100)
        terms = index.terms_at(licenses.hash_words(text))
        rows = np.zeros(len(terms), dtype=np.int64)
        seconds = []
        for _ in range(5):
            start = time.perf_counter()
            found = index.matches(terms, rows, 0.6)
            seconds.append(time.perf_counter() - start)
        return sorted((templates[t].label, int(s)) for t, s in zip(found[0], found[2], strict=True)), min(seconds)

    few, fast = run(many[:20])
    all_, slow = run(many)
    assert all_ == few == sorted((f"t{i}", i * 2_500) for i in range(20))
    assert slow < 5 * fast + 0.02
