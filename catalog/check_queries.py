"""Rules, checks and outcomes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import rawfiles as raw
from catalog.registry import query, table
from catalog.row_queries import judged_orders
from catalog.source_queries import cell, orders_records
from rawgate import model
from rawgate.operators import checks, records, rows
from rawgate.session import stage
from rawgate.sources import control


def _column(rule: checks.Rule) -> F.Column:
    return F.col(f"`{rule.part(0).upper()}`")


#: `quantileCheck` (column, share, most) and `distinctCheck` (column, least), as a user would register them
CUSTOM_CHECKS = {
    **checks.CHECKS,
    "quantilecheck": checks.Check(
        lambda r, m: F.when(m["quantile"] <= float(r.part(2)), checks.PASS).otherwise(checks.FAIL),
        lambda r, good: {"quantile": F.percentile(F.when(good, _column(r).try_cast("double")), F.lit(float(r.part(1))))},
    ),
    "distinctcheck": checks.Check(
        lambda r, m: F.when(m["n"] >= int(r.part(1)), checks.PASS).otherwise(checks.FAIL),
        lambda r, good: {"n": F.size(F.collect_set(F.when(good, _column(r))))},
    ),
}


@query(
    "rule_list",
    """SELECT file_prefix_nm, file_chck_typ, arguments, priority,
      CAST(row_number() OVER (PARTITION BY file_prefix_nm
        ORDER BY CAST(priority AS INTEGER), priority, file_chck_typ, arguments) AS INTEGER) AS seq
    FROM (SELECT DISTINCT 'order_' || CAST(l_orderkey AS VARCHAR) AS file_prefix_nm, l_returnflag AS file_chck_typ,
      CASE WHEN l_linestatus = 'O' THEN '' ELSE l_linestatus END AS arguments,
      CAST(l_linenumber * 3 AS VARCHAR) AS priority FROM lineitem)""",
)
def rule_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order is a prefix; priorities such as 9 and 12 sort as numbers."""
    checklist = table(spark, sf_dir, "lineitem").selectExpr(
        "concat(if(l_quantity > 25, 'ORDER_', 'order_'), l_orderkey) file_prefix_nm",
        "l_returnflag file_chck_typ",
        "CASE WHEN l_linestatus <> 'O' THEN l_linestatus END arguments",
        "cast(l_linenumber * 3 as string) priority",
    )
    rules = checks.rule_list(control.conform(checklist, model.CHECKLIST))
    return rules.select("file_prefix_nm", "file_chck_typ", "arguments", "priority", "seq")


RESULTS_SQL = """r AS (
  SELECT 'order_' || CAST(l_orderkey AS VARCHAR) AS file_nm, l_linenumber AS seq, 'check_' || CAST(l_linenumber AS VARCHAR) AS "check",
    CASE max(CASE WHEN l_tax = 0.08 THEN 3 WHEN l_tax = 0.07 THEN 2 WHEN l_tax = 0.06 THEN 1 ELSE 0 END)
      WHEN 3 THEN 'Fail' WHEN 2 THEN 'Waiting' WHEN 1 THEN 'Skipped' ELSE 'Pass' END AS outcome
  FROM lineitem GROUP BY l_orderkey, l_linenumber),
s AS (
  SELECT r.file_nm, r.seq, r."check", CASE WHEN EXISTS (SELECT 1 FROM r q WHERE q.file_nm = r.file_nm AND q.seq < r.seq
      AND q.outcome IN ('Fail', 'Waiting')) THEN 'Skipped' ELSE r.outcome END AS status FROM r)"""


def rule_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order is a file, its line numbers are rules, the tax says how they went."""
    rank = "CASE WHEN l_tax = 0.08 THEN 3 WHEN l_tax = 0.07 THEN 2 WHEN l_tax = 0.06 THEN 1 ELSE 0 END"
    worst = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.expr(f"max({rank})").alias("w"))
    return worst.selectExpr(
        "concat('order_', l_orderkey) file_nm",
        "l_linenumber seq",
        "concat('check_', l_linenumber) check",
        "CASE w WHEN 3 THEN 'Fail' WHEN 2 THEN 'Waiting' WHEN 1 THEN 'Skipped' ELSE 'Pass' END outcome",
    )


def outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.short_circuit(rule_results(spark, sf_dir))


@query("rule_outcomes", f"""WITH {RESULTS_SQL} SELECT file_nm, seq, "check", status FROM s""")
def rule_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outcomes(spark, sf_dir).select("file_nm", "seq", "check", "status")


@query(
    "outcome_status",
    f"""WITH {RESULTS_SQL} SELECT file_nm, 'Filelevelcheck' AS action_type, "check" AS action_typ_details, status FROM s
    UNION ALL SELECT file_nm, 'FileTransfer', "check", 'Pass' FROM s WHERE status = 'Fail'""",
)
def outcome_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.outcome_status(outcomes(spark, sf_dir)).drop("seq")


@query("waiting_files", f"WITH {RESULTS_SQL} SELECT DISTINCT file_nm FROM s WHERE status = 'Waiting'")
def waiting_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.waiting_files(outcomes(spark, sf_dir))


@query(
    "passing_files",
    f"""WITH {RESULTS_SQL} SELECT 'order_' || CAST(o_orderkey AS VARCHAR) AS file_nm FROM orders
    WHERE 'order_' || CAST(o_orderkey AS VARCHAR) NOT IN (SELECT file_nm FROM s WHERE status IN ('Fail', 'Waiting'))""",
)
def passing_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = table(spark, sf_dir, "orders").selectExpr("concat('order_', o_orderkey) file_nm")
    return checks.passing_files(files, outcomes(spark, sf_dir))


def orders_measures(spark: SparkSession, sf_dir: str, rules: list[checks.Rule]) -> DataFrame:
    """One row of measures for each file of orders."""
    found = stage(orders_records(spark, sf_dir), "orders")
    data = records.data_rows(found)
    judged = data.select(
        "file_nm", rows.width_reason(8).alias("reason"), cell(2).alias("CUSTKEY"), cell(4).alias("TOTAL")
    )
    good = F.col("reason").isNull()
    sums = [checks.sum_measure(r, good) for r in rules if r.check.lower() == "sumcheckvalidation"]
    counts = judged.groupBy("file_nm").agg(
        F.count_if(good).alias("n_good"), F.count_if(~good).alias("n_bad"), *sums
    )
    files = records.file_counts(found).join(counts, "file_nm").join(records.last_trailer(found), "file_nm", "left")
    return files.withColumns({"no_ident": F.lit(False), "fmt_head": F.lit(2), "fmt_tail": F.lit(1)})


def run_rule(spark: SparkSession, sf_dir: str, name: str, argument: str) -> DataFrame:
    rules = [checks.Rule(1, name, argument)]
    return checks.evaluate(orders_measures(spark, sf_dir, rules), rules).select("file_nm", "check", "outcome")


def _fifth(name: str) -> str:
    return f"""WITH {raw.ORDERS_SQL} SELECT DISTINCT file_nm, '{name}' AS "check",
      CASE WHEN file_no % 5 = 3 THEN 'Fail' ELSE 'Pass' END AS outcome FROM o"""


@query("check_row_count", _fifth("rowCountCheck"))
def check_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_rule(spark, sf_dir, "rowCountCheck", "")


@query("check_sum", _fifth("sumCheckValidation"))
def check_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_rule(spark, sf_dir, "sumCheckValidation", "total")


@query(
    "check_file_content",
    """SELECT 'part_' || CAST(p_partkey AS VARCHAR) AS file_nm, 'fileContentCheck' AS "check",
      CASE WHEN (CASE WHEN p_size <= 25 THEN 1 ELSE 0 END) + coalesce(ones, 0) = 1 AND coalesce(others, 0) >= 1 THEN 'Pass' ELSE 'Fail' END AS outcome
    FROM part LEFT JOIN (SELECT l_partkey, count(*) FILTER (l_quantity = 1) AS ones, count(*) FILTER (l_quantity <> 1) AS others
      FROM lineitem GROUP BY l_partkey) ON p_partkey = l_partkey""",
)
def check_file_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file per part, format HDT: small parts have a trailer; a line item is a data row, or one more trailer if it is a single piece."""
    edges = table(spark, sf_dir, "part").selectExpr(
        "concat('part_', p_partkey) file_nm", "explode(if(p_size <= 25, array('H', 'T'), array('H'))) ident"
    )
    items = table(spark, sf_dir, "lineitem").selectExpr("concat('part_', l_partkey) file_nm", "if(l_quantity = 1, 'T', 'D') ident")
    known = table(spark, sf_dir, "part").selectExpr("concat('part_', p_partkey) file_nm")
    found = edges.unionByName(items.join(known, "file_nm", "left_semi")).withColumns(
        {"block": F.lit(0).cast("bigint"), "line_id": F.monotonically_increasing_id()}
    )
    files = records.file_counts(found).withColumns(
        {"no_ident": F.lit(False), "fmt_head": F.lit(1), "fmt_tail": F.lit(1)}
    )
    return checks.evaluate(files, [checks.Rule(1, "fileContentCheck", "HDT")]).select("file_nm", "check", "outcome")


@query(
    "check_custom",
    f"""WITH {raw.ORDERS_SQL}, g AS (SELECT file_nm, CAST(total AS DOUBLE) AS t, o_orderstatus AS s FROM o WHERE NOT is_short AND NOT is_malformed),
    m AS (SELECT file_nm, quantile_cont(t, 0.9) AS q, count(DISTINCT s) AS n FROM g GROUP BY file_nm),
    f AS (SELECT DISTINCT o.file_nm, q, coalesce(n, 0) AS n FROM o LEFT JOIN m USING (file_nm))
    SELECT file_nm, 1 AS seq, 'quantileCheck' AS "check", CASE WHEN q <= 275000 THEN 'Pass' ELSE 'Fail' END AS outcome,
      CASE WHEN q <= 275000 THEN 'Pass' ELSE 'Fail' END AS status FROM f
    UNION ALL SELECT file_nm, 2, 'distinctCheck', CASE WHEN n >= 3 THEN 'Pass' ELSE 'Fail' END,
      CASE WHEN q <= 275000 THEN CASE WHEN n >= 3 THEN 'Pass' ELSE 'Fail' END ELSE 'Skipped' END FROM f""",
)
def check_custom(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two registered checks that bring their own measures: a quantile of the totals, and the number of different statuses."""
    found = stage(orders_records(spark, sf_dir), "orders")
    data = records.data_rows(found).select("file_nm", rows.width_reason(8).alias("reason"), cell(3).alias("STATUS"), cell(4).alias("TOTAL"))
    rules = [checks.Rule(1, "quantileCheck", "total,0.9,275000"), checks.Rule(2, "distinctCheck", "status,3")]
    files = checks.with_measures(records.file_counts(found), data, rules, CUSTOM_CHECKS)
    return checks.evaluate(files, rules, CUSTOM_CHECKS).select("file_nm", "seq", "check", "outcome", "status")


@query(
    "check_row_variance",
    """WITH runs AS (SELECT event_type AS file_prefix_nm, strftime(ts, '%Y%m%d') AS snap_dt, count(*) AS n FROM events GROUP BY ALL),
    v AS (SELECT *, lag(n) OVER (PARTITION BY file_prefix_nm ORDER BY snap_dt) AS prev FROM runs)
    SELECT file_prefix_nm, snap_dt, CAST(n AS BIGINT) AS row_count,
      CASE WHEN prev IS NULL THEN 'Skipped' WHEN abs(n - prev) * 100 <= 10 * prev THEN 'Pass' ELSE 'Fail' END AS outcome FROM v""",
)
def check_row_variance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event type is a prefix with one run per day."""
    runs = (
        table(spark, sf_dir, "events")
        .groupBy(F.col("event_type").alias("file_prefix_nm"), F.date_format("ts", "yyyyMMdd").alias("snap_dt"))
        .agg(F.count("*").alias("row_count"))
        .withColumn("run_id", F.lit("1"))
    )
    files = stage(runs.withColumns({"n_good": F.col("row_count"), "n_bad": F.lit(0), "file_nm": F.concat_ws("_", "file_prefix_nm", "snap_dt")}), "runs")
    # every run finds those before it in the history, as a run of the intake does
    found = files.join(checks.latest_before(files, files), "file_nm", "left")
    outcome = checks.row_variance_check(checks.Rule(1, "rowCountVarianceCheck", "", "10"))
    return found.select("file_prefix_nm", "snap_dt", "row_count", outcome.alias("outcome"))


@query(
    "check_integrity",
    f"""WITH {raw.ORDERS_SQL} SELECT file_nm,
      CAST(count(*) FILTER (NOT is_short AND NOT is_malformed
        AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)) AS BIGINT) AS orphans,
      CASE WHEN orphans = 0 THEN 'Pass' ELSE 'Fail' END AS outcome FROM o GROUP BY file_nm""",
)
def check_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of customers with a negative balance have no parent."""
    parent = table(spark, sf_dir, "customer").filter("c_acctbal >= 0")
    good, _ = judged_orders(spark, sf_dir)
    orphans = checks.orphan_counts(good, cell(2), parent, "c_custkey")
    files = records.file_counts(orders_records(spark, sf_dir)).select("file_nm").join(orphans, "file_nm", "left")
    files = files.na.fill(0, ["orphans"]).withColumns({"parent_ready_1": F.lit(True), "orphans_1": F.col("orphans")})
    outcome = checks.integrity_check(checks.Rule(1, "integrityCheck", "custkey=customer.c_custkey"))
    return files.select("file_nm", "orphans", outcome.alias("outcome"))


@query(
    "files_with_checks",
    """SELECT o_orderstatus AS src_sys_nm, 'order_' || CAST(o_orderkey AS VARCHAR) AS file_prefix_nm,
      'f_' || CAST(o_orderkey AS VARCHAR) AS file_nm, l_returnflag AS file_chck_typ, strftime(o_orderdate, '%Y%m%d') AS snap_dt,
      'r1' AS run_id
    FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey""",
)
def files_with_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = table(spark, sf_dir, "orders").selectExpr(
        "o_orderstatus src_sys_nm",
        "concat('order_', o_orderkey) file_prefix_nm",
        "concat('f_', o_orderkey) file_nm",
        "date_format(o_orderdate, 'yyyyMMdd') snap_dt",
        "'r1' run_id",
    )
    checklist = table(spark, sf_dir, "lineitem").selectExpr(
        "concat('order_', l_orderkey) file_prefix_nm", "l_returnflag file_chck_typ"
    )
    return checks.files_with_checks(files, checklist)
