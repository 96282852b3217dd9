"""Queries that SQL cannot state: each is held by a named test; accuracy of the learned ones on rows held out."""

import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from rawgate.llm import decontamination, secrets
from rawgate.llm.registry import QUERIES
from tests.llm import (
    test_chat,
    test_decontamination,
    test_extraction,
    test_jaccard,
    test_licenses,
    test_pipeline,
    test_quality,
    test_secrets,
    test_whitening,
)
from tests.llm.conftest import SCHEMA, odd_rows, prose

CHECKED_BY = {
    "op1_license_scan": test_licenses.test_labels_and_scores_against_brute_force,
    "op6_secret_scan": test_secrets.test_candidates_against_brute_force,
    "op8_quality_rules": test_quality.test_limits_follow_the_group,
    "op9_chat_format": test_chat.test_read_back,
    "op10_ngram_jaccard": test_jaccard.test_equals_brute_force,
    "op11_embedding_whitening": test_whitening.test_query_against_brute_force,
    "op13_html_extraction": test_extraction.test_query_on_pages,
    "near_decontamination": test_decontamination.test_near_query_against_brute_force,
    "pipeline": test_pipeline.test_stages_against_brute_force,
}
#: column of the prediction, of the truth, and the least share of held-out rows that agree
LEARNED = {"op2_toxicity": ("predicted", "toxic", 0.98), "op7_language_id": ("lang_pred", "lang", 0.97)}


def test_every_query_has_sql_or_a_test_of_its_own():
    assert set(entry.LLM_QUERIES) - set(entry.LLM_SQL) == set(CHECKED_BY) | set(LEARNED)


@pytest.mark.parametrize("name", sorted(LEARNED))
def test_held_out_accuracy(spark, name):
    predicted, truth, least = LEARNED[name]
    path = "/root/testdata/sf0.1"
    known = spark.read.parquet(f"{path}/{'labels' if truth == 'toxic' else 'documents'}.parquet").select("doc_id", truth).filter(F.col(truth).isNotNull())
    held = QUERIES[name](spark, path).filter("held_out AND " + predicted + " <> 'und'" if predicted == "lang_pred" else "held_out")
    same, n = held.join(known, "doc_id").agg(F.count_if(F.col(predicted) == F.col(truth)), F.count("*")).collect()[0]
    assert n > 100, n
    assert same >= least * n, (same, n)


def test_secret_query_finds_planted_keys(spark, tables):
    """The whole query over a table: findings of planted keys are secrets, those of look-alikes are not."""
    rng = random.Random(60)
    kinds = (test_secrets.REAL + test_secrets.FALSE) * 30
    docs = [(i, f"{prose(rng, 12)} {kind(i)} {prose(rng, 12)}", "en", "s", 1) for i, kind in enumerate(kinds)]
    path = tables(documents=spark.createDataFrame(docs + [(None, None, None, None, None)], SCHEMA).repartition(4))
    found = {r.doc_id for r in secrets.secret_scan(spark, path).filter("is_secret").collect()}
    wrong = [docs[i][1] for i in range(len(docs)) if (i in found) != (i % 10 < 5)]
    assert len(wrong) <= len(docs) // 30, wrong


def test_near_query_on_odd_tables(spark, tables, tmp_path):
    """Clashing columns, nulls, very long texts and repeated rows: one row each; empty tables: no items."""
    rng = random.Random(61)
    item = prose(rng, 24, "zz")
    changed = item.split()
    changed[7], changed[16] = "zzother", "zzwords"
    rows = odd_rows() + [(9000, " ".join(prose(rng, 20_000).split() + changed + prose(rng, 20_000).split()), "en", "a", 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    for name in ("item_id", "begin", "band", "places", "near", "words", "n_near_items"):
        docs = docs.withColumn(name, F.lit("clash"))
    benchmark = spark.createDataFrame([(1, item), (2, None), (None, item), (3, "")], "item_id long, text string").withColumn("term", F.lit(0))
    got = QUERIES["near_decontamination"](spark, tables(documents=docs, benchmark=benchmark)).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in rows)
    assert {r.doc_id for r in got if r.n_near_items} == {9000}
    none = decontamination.contamination(docs.limit(0), benchmark, near=True)
    assert none.count() == 0 and decontamination.contamination(docs, benchmark.limit(0), near=True).filter("size(near_items) > 0").count() == 0
