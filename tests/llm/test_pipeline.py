import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from tests.compare import compare, connect
from tests.llm.conftest import SCHEMA, odd_rows, prose
from tests.llm.test_decontamination import brute as brute_hits
from tests.llm.test_jaccard import brute as brute_links
from tests.llm.test_mixing import brute as brute_mix

SMALL = "/root/testdata/sf0.001"
NAMES = (
    "license_scan toxicity warc source_mixing decontamination secret_scan language_id quality_rules chat_format ngram_jaccard "
    "embedding_whitening ranked_search html_extraction"
).split()


def test_every_operator_is_registered():
    assert [f"op{i}_{n}" for i, n in enumerate(NAMES, 1)] == sorted((q for q in entry.queries() if q.startswith("op")), key=lambda q: int(q[2:].split("_")[0]))
    assert "pipeline" in entry.queries()


@pytest.mark.parametrize("name", sorted(q for q in entry.oracle_sql() if q.startswith("op")))
def test_equals_sql(spark, name):
    problem, rows, _ = compare(spark, connect(SMALL), SMALL, entry.queries()[name], entry.oracle_sql()[name])
    assert problem is None and rows


def test_stages_against_brute_force(spark, tables):
    """A corpus whose toxic words, copies, benchmark passages and secrets are known."""
    rng = random.Random(8)
    texts = [prose(rng, 60) for _ in range(120)]
    items = [(i, prose(rng, 25)) for i in range(4)]
    docs = [(i, t, "en", "a" if i % 3 else "b", len(t)) for i, t in enumerate(texts)]
    toxic = [(500 + i, prose(rng, 30) + " you idiot. " + prose(rng, 10), "en", "a", 1) for i in range(10)]
    copies = [(600 + i, texts[i % 5] + (" tail" if i % 2 else ""), "en", "a", 1) for i in range(20)]
    leaks = [(700 + i, prose(rng, 20) + " " + items[i % 4][1] + " " + prose(rng, 20), "en", "b", 1) for i in range(8)]
    keyed = [(800 + i, prose(rng, 20) + f' token = "{i:02d}4b0733c9e5f5b6339402906a10728cdbee55c{i:02d}" ' + prose(rng, 20), "en", "b", 1) for i in range(8)]
    rows = docs + toxic + copies + leaks + keyed + [r for r in odd_rows() if r[0] != 9]
    rng.shuffle(rows)
    path = tables(
        documents=spark.createDataFrame(rows, SCHEMA),
        benchmark=spark.createDataFrame(items, "item_id long, text string"),
        labels=spark.createDataFrame([], "doc_id long, quality int, toxic int"),
    )
    now = spark.read.parquet(f"{path}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, path)
        now.write.parquet(f"{path}/{name}")
        now = spark.read.parquet(f"{path}/{name}")
        seen[name] = sorted((tuple(r) for r in now.collect()), key=str)
        if name != "mixing":
            assert now.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    want = [r for r in rows if " you idiot. " not in (r[1] or "")]
    assert seen["toxicity"] == sorted(want, key=str)
    one = {(i, n, c) for i, n, c, _ in brute_links([(r[0], r[1]) for r in want], percent=80, size=5)}
    dropped = {i for i, n, c in one if n and i != c}
    want = [r for r in want if r[0] not in dropped]
    assert seen["ngram_jaccard"] == sorted(want, key=str)
    hit = {(i) for i, *_, bad in brute_hits([(r[0], r[1]) for r in want], items) if bad}
    want = [r for r in want if r[0] not in hit]
    assert seen["decontamination"] == sorted(want, key=str) and {r[0] for r in leaks} <= hit
    masked = {r[0]: r for r in seen["secrets"] if r[1] and "[SECRET]" in r[1]}
    assert set(masked) == {r[0] for r in keyed} and len(seen["secrets"]) == len(want)
    assert [r for r in seen["secrets"] if r[0] not in masked] == sorted((r for r in want if r[0] not in masked), key=str)
    assert sorted(((r[0], r[5]) for r in seen["mixing"]), key=str) == brute_mix(seen["secrets"])


def test_near_copies_go_from_five_words_and_four_fifths(spark):
    """Pairs of 100 words: two changed words link at 5 words and 0.8 only, one links at both, four at neither."""
    rng = random.Random(21)
    rows = []
    for i in range(40):
        words = [f"{w}{k}" for k, w in enumerate(prose(rng, 100).split())]
        rows.append((i, " ".join(words)))
        for k, at in enumerate(([20, 60], [50], [10, 30, 50, 70])):
            changed = list(words)
            for a in at:
                changed[a + rng.randrange(5)] = f"other{i}{k}"
            rows.append((1000 * (k + 1) + i, " ".join(changed)))
    rng.shuffle(rows)
    want = brute_links(rows, percent=80, size=5)
    dropped = {i for i, n, c, _ in want if n and i != c}
    assert dropped == set(range(1000, 1040)) | set(range(2000, 2040))
    assert not set(range(1000, 1040)) & {i for i, n, c, _ in brute_links(rows) if n and i != c}
    docs = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in rows], SCHEMA)
    kept = dict(corpus_pipeline.STAGES)["ngram_jaccard"](spark, docs, "")
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, _ in rows if i not in dropped)


def test_run_reads_back_what_each_stage_wrote(spark):
    out = corpus_pipeline.run(spark, SMALL)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "copy", "shuffle_key"] and out.count() > 0
    assert out.filter(F.col("doc_id").isNull()).count() == 0


def test_empty_tables(spark, tables, no_docs):
    path = tables(
        documents=no_docs,
        benchmark=spark.createDataFrame([], "item_id long, text string"),
        labels=spark.createDataFrame([], "doc_id long, quality int, toxic int"),
    )
    assert corpus_pipeline.run(spark, path).count() == 0
