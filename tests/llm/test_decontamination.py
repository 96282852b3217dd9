import hashlib
import random
import re
from collections import Counter

import pytest

from rawgate.llm import decontamination as de
from rawgate.llm.common import ALNUM_WORD, LOWER, UPPER
from tests.llm.conftest import WORDS, odd_rows, prose


def words(text):
    return re.findall(ALNUM_WORD, (text or "").translate(str.maketrans(UPPER, LOWER)))


def brute(docs, items):
    windows = {}
    for i, text in items:
        w = words(text)
        if w and i is not None:
            n = min(10, len(w))
            for s in range(len(w) - n + 1):
                windows.setdefault(n, {}).setdefault(tuple(w[s : s + n]), set()).add(i)
    out = []
    for i, text in docs:
        w, hit, found = words(text), set(), set()
        for n, by_window in windows.items():
            for s in range(len(w) - n + 1):
                got = by_window.get(tuple(w[s : s + n]))
                if got:
                    hit.update(range(s, s + n))
                    found |= got
        ids = ",".join(sorted(map(str, found)))
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def planted():
    rng = random.Random(9)
    items = [(i, prose(rng, rng.choice([1, 3, 9, 10, 11, 40]))) for i in range(12)]
    items += [(100, "the " * 30), (101, "Alpha, BETA gamma!"), (102, None), (103, " ?! "), (None, "kappa mu"), (12, items[0][1]), (10, items[5][1] + " extra")]
    docs = []
    for i in range(60):
        text = prose(rng, rng.randint(0, 80)).split()
        for _ in range(rng.randint(0, 3)):
            source = (rng.choice([t for _, t in items if t and words(t)])).split()
            at, n = rng.randrange(len(source)), rng.randint(1, 40)
            text[rng.randint(0, len(text)) : 0] = source[at : at + n]
        docs.append((1000 + i, " ".join(text)))
    docs += [(2000, "the " * 25), (2001, "the " * 9), (2002, "alpha beta gamma alpha beta gamma")]
    return items, docs + docs[:3] + [(i, t) for i, t, *_ in odd_rows()]


def test_planted_and_odd(spark, planted, tables):
    items, docs = planted
    documents = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'x' AS item_id", "1 AS pos", "'y' AS term")
    path = tables(documents=documents, benchmark=spark.createDataFrame(items, "item_id long, text string"))
    got = sorted((tuple(r) for r in de.decontamination(spark, path).collect()), key=str)
    assert got == brute(docs, items)
    clean = {(r.doc_id, r.text) for r in de.drop_contaminated(spark, documents, path).collect()}
    hit = {i for i, *_, contaminated in brute(docs, items) if contaminated}
    assert {i for i, _ in clean if i is not None and 1000 <= i} == {i for i, _ in docs if i is not None and 1000 <= i} - hit


def test_other_windows(spark, planted, monkeypatch):
    items, docs = planted
    documents = spark.createDataFrame(docs, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = de.contamination(documents, benchmark, window=3).collect()
    assert sum(r.n_hit for r in got) > sum(r.n_hit for r in de.contamination(documents, benchmark).collect())


def test_empty_tables(spark, no_docs, odd_docs):
    empty = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "alpha beta")], "item_id long, text string")
    assert de.contamination(no_docs, some).count() == 0
    got = de.contamination(odd_docs, empty).collect()
    assert len(got) == len(odd_rows()) and all(r.n_hit == 0 and r.items == [] for r in got)


def test_proximity(spark):
    rng = random.Random(3)
    phrase = [rng.choice(WORDS) + str(i) for i in range(12)]
    near = phrase[:4] + ["x", "y"] + phrase[4:8] + ["z"] + phrase[8:]
    texts = [phrase, near, phrase[:2] + ["filler"] * 200 + phrase[9:], ["nothing"] * 30]
    docs = spark.createDataFrame([(i, " ".join(["pad"] * 50 + t + ["pad"] * 50)) for i, t in enumerate(texts)], "doc_id long, text string")
    index, items = de.index_corpus(docs, spark.createDataFrame([(7, " ".join(phrase))], "item_id long, text string"))
    assert {r.doc_id for r in de.phrase_matches(index, items).collect()} == {0}
    assert {r.doc_id for r in de.proximity_matches(index, items, min_probes=2).collect()} == {0, 1}


def brute_near(docs, items, slop=20, least=3):
    """Per row: the items of which enough probe words begin less than `slop` apart."""
    counts = Counter(w for _, t in docs for w in words(t))
    probes = []
    for i, text in items:
        w, found = words(text), set()
        n = min(10, len(w))
        for s in range(len(w) - n + 1) if w and i is not None else []:
            inside = sorted((counts[x], s + k, x) for k, x in enumerate(w[s : s + n]) if counts[x])
            found.update((o, x) for _, o, x in inside[:1])
            found.update([(o, x) for _, o, x in inside if x != inside[0][2]][:1])
        if found:
            probes.append((i, found, min(least, len({x for _, x in found}))))
    out = []
    for i, text in docs:
        at = {}
        for pos, x in enumerate(words(text)):
            at.setdefault(x, []).append(pos)
        near = set()
        for item, found, needed in probes:
            begins = sorted({(pos - o, x) for o, x in found for pos in at.get(x, [])})
            if item not in near and any(len({x for c, x in begins[k : k + 800] if c < b + slop}) >= needed for k, (b, _) in enumerate(begins)):
                near.add(item)
        out.append((i, len(near), hashlib.sha256(",".join(sorted(map(str, near))).encode()).hexdigest()))
    return sorted(out, key=str)


def test_near_query_against_brute_force(spark, planted, tables):
    """Passages with a word changed, dropped or inserted in every seven hold no window, and are found near."""
    items, docs = planted
    rng = random.Random(12)
    items = items + [(200 + i, " ".join(f"{w}{rng.randrange(40)}" for w in prose(rng, 40).split())) for i in range(4)]
    changed = []
    for i in range(24):
        text = items[len(items) - 4 + i % 4][1].split()
        for at in range(35, -1, -7):
            text[at : at + (2 if i % 3 == 1 else i % 3 < 1)] = [] if i % 3 == 1 else [f"other{i}"]
        changed.append((4000 + i, prose(rng, 30) + " " + " ".join(text) + " " + prose(rng, 30)))
    docs = [d for d in docs if len(d[1] or "") < 100_000] + changed
    path = tables(documents=spark.createDataFrame(docs, "doc_id long, text string"), benchmark=spark.createDataFrame(items, "item_id long, text string"))
    got = [tuple(r) for r in de.near_decontamination(spark, path).collect()]
    assert sorted((r[:6] for r in got), key=str) == brute(docs, items)
    assert sorted(((r[0], r[6], r[7]) for r in got), key=str) == brute_near(docs, items)
    of_changed = [r for r in got if r[0] is not None and 4000 <= r[0]]
    assert len(of_changed) == 24 and not any(r[5] and r[3] > 4 for r in of_changed) and all(r[6] for r in of_changed)
