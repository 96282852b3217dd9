"""What the plans look like, and that both ways of a join agree."""

import pytest
from pyspark.sql import functions as F

from catalog import rawfiles as raw
from catalog.intake_queries import orders_intake
from rawgate.joins import fits_broadcast, join_per_file
from rawgate.operators import checks, records
from rawgate.sources import lines

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def result(spark):
    return orders_intake(spark, SF_DIR)


@pytest.mark.parametrize("frame", ["published", "quarantine", "statuses", "schema_failures"])
def test_no_python_workers_in_the_data_path(result, frame):
    text = plan(getattr(result, frame))
    for word in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "MapPartitions", "Scan ExistingRDD"):
        assert word not in text
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text


def test_publishing_needs_no_shuffle(result):
    text = plan(result.published)
    assert "Exchange hashpartitioning" not in text
    assert "SinglePartition" not in text
    assert "BroadcastHashJoin" in text


def test_published_rows_do_not_read_the_raw_line(result):
    scan = [line for line in plan(result.published).split("\n") if "FileScan" in line and "/records-" in line]
    assert scan and all("value" not in line.split("Location")[0] for line in scan)


def test_filters_reach_the_staged_table(spark):
    found = lines.delimited_records(lines.read_lines(spark, raw.orders_files(spark, SF_DIR), folders=True), "|")
    from rawgate.session import stage

    text = plan(records.trailer_rows(stage(found, "t")))
    assert "In(ident, [T,t])" in text


def test_counts_shuffle_one_row_per_split(spark):
    found = lines.delimited_records(lines.read_lines(spark, raw.orders_files(spark, SF_DIR), folders=True), "|")
    per_split = [line for line in plan(records.file_counts(found)).split("\n") if "partial_count" in line]
    # the aggregate over the rows keeps its buffers in a hash table, keyed by file and split
    assert per_split and all("HashAggregate" in line and "block#" in line for line in per_split)


def test_rank_is_limited_before_the_shuffle(spark):
    found = lines.delimited_records(lines.read_lines(spark, raw.orders_files(spark, SF_DIR), folders=True), "|")
    assert "WindowGroupLimit" in plan(records.head_positions(found, 2))


def test_salted_join_equals_broadcast(spark):
    rows = spark.range(5000).selectExpr("if(id % 3 = 0, 'hot', concat('f', id % 50)) file_nm", "0L block", "id line_id")
    facts = spark.range(50).selectExpr("concat('f', id) file_nm", "id fact").unionByName(
        spark.sql("SELECT 'hot' file_nm, 99L fact")
    )
    one = join_per_file(rows, facts, small=True)
    two = join_per_file(rows, facts, small=False)
    assert "BroadcastHashJoin" in plan(one)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.select(one.columns).collect()))
    assert one.count() == 5000
    assert fits_broadcast(facts) and not fits_broadcast(facts, 100)


def test_keys_are_counted_before_the_parent_join(spark):
    rows = spark.range(100).selectExpr("'f' file_nm", "id k")
    text = plan(checks.orphan_counts(rows, F.col("k"), spark.range(10), "id"))
    assert "LeftAnti" in text
    assert text.count("HashAggregate") >= 3
