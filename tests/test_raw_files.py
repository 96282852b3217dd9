"""Writing raw files: how many tasks share the work, how often the table is read, what lies beside the files."""

import glob
import os

from catalog import rawfiles as raw
from pyspark.sql import functions as F

FILES = 100


def orders(spark, path):
    rows = spark.range(2 * FILES).selectExpr(
        "id div 2 * 1000 + id % 2 o_orderkey", "id o_custkey", "if(id < 2, 'P', 'O') o_orderstatus", "id + 0.5D o_totalprice",
        "timestamp'2024-01-01' o_orderdate", "if(id < 2, '1-URGENT', '3-MEDIUM') o_orderpriority",
    )
    rows.write.parquet(f"{path}/orders.parquet")
    return str(path)


def test_small_files_are_written_by_as_many_tasks_as_there_are_cores(spark, tmp_path):
    folder = raw.orders_files(spark, orders(spark, tmp_path)).removeprefix("file:")
    parts = glob.glob(f"{folder}/file_nm=*/part-*")
    assert len(parts) == FILES
    # by size, all of them would be one task's
    assert len({os.path.basename(p).split("-")[1] for p in parts}) >= spark.sparkContext.defaultParallelism // 2
    assert not glob.glob(f"{folder}/**/.*.crc", recursive=True)


def test_lines_of_files_read_the_table_twice_at_most(spark, tmp_path):
    lines = raw.orders_lines(spark, orders(spark, tmp_path))
    plan = lines._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") <= 2
    first = [r.value for r in lines.filter("file_nm = 'orders_000000.csv'").orderBy("ord").collect()]
    assert (first[:3], first[-1]) == (["H|20240101", "H|ORDERKEY|CUSTKEY|STATUS|TOTAL|ORDERDATE|PRIORITY|NOTE", ""], "T|2|0.00")
    # one row and one unit too many
    third = [r.value for r in lines.filter("file_nm = 'orders_000003.csv'").orderBy("ord").collect()]
    assert (len(third), third[-1]) == (6, "T|3|15.00")


def test_fixed_lines_of_files_without_name_or_number(spark):
    files = spark.createDataFrame([("a", 1), ("b", None), (None, 2)], "file_nm string, n long")
    got = raw.fixed_lines(files, (raw.FIRST, "'H'"), (raw.LAST, "concat('T|', n)"))
    assert got.dtypes == [("file_nm", "string"), ("ord", "bigint"), ("value", "string")]
    assert sorted(map(tuple, got.select(F.coalesce("file_nm", F.lit("")), "ord", F.coalesce("value", F.lit(""))).collect())) == sorted(
        [("a", raw.FIRST, "H"), ("a", raw.LAST, "T|1"), ("b", raw.FIRST, "H"), ("b", raw.LAST, ""), ("", raw.FIRST, "H"), ("", raw.LAST, "T|2")]
    )
