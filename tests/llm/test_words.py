"""Words of whole texts on the JVM, and that they are looked for once."""

import pytest
from pyspark.sql import functions as F

from rawgate.llm import decontamination as de
from rawgate.llm.common import ALNUM_WORD, SPACED_WORD, words_of

TEXTS = ["", None, " ", "a", " a ", "--a--b", "É é x\x00y", "A-b_c 9\t\nz", "\U0001f600 \x7f\x1f", "x\x85y\xa0z", "\n\r\x0b\x0c", "漢字 x" * 300]


@pytest.mark.parametrize("pattern", [ALNUM_WORD, SPACED_WORD])
def test_pieces_between_gaps_are_the_words_that_the_pattern_finds(spark, pattern):
    found = spark.createDataFrame([(t,) for t in TEXTS], "text string").select(
        "text", words_of(F.col("text"), pattern).alias("got"), F.regexp_extract_all("text", F.lit(pattern), F.lit(0)).alias("want")
    )
    rows = found.collect()
    assert len(rows) == len(TEXTS) and all(r.got == r.want for r in rows)
    # cut, not searched word by word
    assert "regexp_extract_all" not in found.select("got")._jdf.queryExecution().optimizedPlan().toString()


def test_other_patterns_are_refused():
    with pytest.raises(ValueError):
        words_of(F.lit("a"), "[a-z]+")


def test_frequencies_find_the_words_of_a_text_once(spark, tmp_path):
    path = str(tmp_path / "documents.parquet")
    rows = [(1, "one two two"), (2, None), (3, ""), (4, "two.three")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(path)
    tokens = de._tokens(spark.read.parquet(path), "doc_id", "text")
    items = de.benchmark_items(spark.createDataFrame([(1, "two three four")], "item_id long, text string"))
    counted = de.term_frequencies(tokens, items)
    plan = counted._jdf.queryExecution().executedPlan().toString()
    # neither in the plan's filters nor a second time in a projection
    assert plan.count("translate(") == 1
    names = spark.createDataFrame([("two",), ("three",)], "w string").select("w", F.xxhash64("w").alias("term"))
    assert sorted(tuple(r) for r in counted.join(names, "term").select("w", "n").collect()) == [("three", 1), ("two", 3)]
    assert counted.count() == 2
