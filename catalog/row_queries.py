"""Row validation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import rawfiles as raw
from catalog.registry import query
from catalog.source_queries import cell, fixed_records, orders_records
from rawgate.operators import records, rows
from rawgate.session import scratch_path, stage


def judged_orders(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    data = records.data_rows(orders_records(spark, sf_dir))
    return rows.split_good_bad(data, rows.width_reason(8))


@query(
    "split_good_bad",
    f"""WITH {raw.ORDERS_SQL} SELECT file_nm, k,
      CASE WHEN is_malformed THEN 'malformed' WHEN is_short THEN 'short' ELSE 'good' END AS reason FROM o""",
)
def split_good_bad(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, bad = judged_orders(spark, sf_dir)
    both = good.withColumn("reason", F.lit("good")).unionByName(bad)
    return both.select("file_nm", cell(1).alias("k"), "reason")


@query(
    "fw_good_bad",
    f"""WITH {raw.ORDERS_SQL} SELECT file_nm, CASE WHEN is_short THEN 'short' ELSE 'good' END AS reason,
      CAST(count(*) AS BIGINT) AS n FROM o GROUP BY ALL""",
)
def fw_good_bad(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = records.data_rows(fixed_records(spark, sf_dir))
    body = F.substring(cell(0), F.lit(2), F.length(cell(0)))
    reason = rows.length_reason(body, sum(raw.FIXED_LENGTHS))
    return data.groupBy("file_nm", F.coalesce(reason, F.lit("good")).alias("reason")).agg(F.count("*").alias("n"))


@query(
    "bad_row_report",
    f"""WITH {raw.ORDERS_SQL}, b AS (
      SELECT file_nm, k, row_number() OVER (PARTITION BY file_nm ORDER BY o_orderkey) AS rn FROM o WHERE is_short OR is_malformed)
    SELECT file_nm, CAST(count(*) AS BIGINT) AS bad_rows, string_agg(k, ',' ORDER BY rn) FILTER (rn <= 10) AS samples
    FROM b GROUP BY file_nm""",
)
def bad_row_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = records.data_rows(stage(orders_records(spark, sf_dir), "orders"))
    _, bad = rows.split_good_bad(data, rows.width_reason(8))
    report = rows.bad_row_report(bad, cell(1))
    return report.select("file_nm", "bad_rows", F.array_join("samples", ",").alias("samples"))


@query(
    "good_row_count",
    f"WITH {raw.ORDERS_SQL} SELECT CAST(count(*) AS BIGINT) AS good_rows FROM o WHERE NOT (is_short OR is_malformed)",
)
def good_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counted while the good rows are written, without a job of its own."""
    good, _ = judged_orders(spark, sf_dir)
    counted, seen = rows.counted(good, "good")
    counted.write.parquet(scratch_path(spark, "good"))
    return spark.createDataFrame([(seen.get["rows"],)], "good_rows bigint")


@query(
    "quarantine",
    f"""WITH {raw.ORDERS_SQL} SELECT file_nm, CASE WHEN is_malformed THEN 'malformed' ELSE 'short' END AS reason,
      'D|' || k || '|' || ck || '|' || o_orderstatus || '|' || total || '|' || d
      || CASE WHEN is_malformed THEN '|5-LOW|"x"y' ELSE '' END AS value
    FROM o WHERE is_short OR is_malformed""",
)
def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rawgate.sources.lines import original_line

    _, bad = judged_orders(spark, sf_dir)
    return rows.quarantine(bad.withColumn("line", original_line("|"))).select("file_nm", "reason", "value")
