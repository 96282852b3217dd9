"""The whole intake over files written from the test tables."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import rawfiles as raw
from catalog.registry import query, table
from rawgate import ControlTables, IntakeOptions, IntakeResult, ingest, model
from rawgate.sources import control as ct
from rawgate.sources.listing import list_names

ORDER_COLUMNS = [
    ("orders", "orderkey", 1, 12, "bigint", False),
    ("orders", "custkey", 2, 10, "bigint", False),
    ("orders", "status", 3, 1, "string", False),
    ("orders", "total", 4, 16, "decimal(18,2)", False),
    ("orders", "orderdate", 5, 10, "date", False),
    ("orders", "priority", 6, 15, "string", False),
    ("orders", "note", 7, 40, "string", False),
]


def manifest_of(spark: SparkSession, folder: str, prefix: str, absent: str | None = None) -> DataFrame:
    names = list_names(spark, folder)
    if absent:
        names = names.unionByName(spark.createDataFrame([(absent,)], "file_nm string"))
    rows = names.selectExpr("file_nm", "'shop' src_sys_nm", "'r1' run_id", "'20240101' snap_dt", f"'{prefix}' file_prefix_nm")
    return ct.conform(rows, model.MANIFEST)


def orders_intake(spark: SparkSession, sf_dir: str, gzip: bool = False) -> IntakeResult:
    folder = raw.orders_gzip(spark, sf_dir) if gzip else raw.orders_files(spark, sf_dir)
    control = ControlTables.from_rows(
        spark,
        expected_files=[("orders", "shop", None, None, "n", "n", "|", "Y", "n", "Y")],
        checklist=[
            ("orders", "fileContentCheck", "HHDT", "1", None, 1, "A", None),
            ("orders", "rowCountCheck", None, "2", None, 1, "A", None),
            ("orders", "sumCheckValidation", "total", "10", None, 1, "A", None),
        ],
        file_schema=ORDER_COLUMNS,
    )
    control.manifest = manifest_of(spark, folder, "orders", "orders_never.csv")
    return ingest(spark, control, "orders", folder, IntakeOptions(src_sys_nm="shop", folders=True))


ORDERS_PUBLISHED = f"""WITH {raw.ORDERS_SQL}
SELECT o_orderkey AS "ORDERKEY", o_custkey AS "CUSTKEY", o_orderstatus AS "STATUS", CAST(total AS DECIMAL(18,2)) AS "TOTAL",
  CAST(o_orderdate AS DATE) AS "ORDERDATE", o_orderpriority AS "PRIORITY", note AS "NOTE", '20240101' AS snap_dt, 'r1' AS run_id
FROM o WHERE NOT is_short AND NOT is_malformed AND file_no % 5 <> 3"""


@query("intake_orders", ORDERS_PUBLISHED)
def intake_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which orders in the raw files are valid, and do the trailers agree?"""
    return orders_intake(spark, sf_dir).published


@query("intake_orders_gzip", ORDERS_PUBLISHED)
def intake_orders_gzip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_intake(spark, sf_dir, gzip=True).published


@query(
    "intake_quarantine",
    f"""WITH {raw.ORDERS_SQL} SELECT file_nm, CASE WHEN is_malformed THEN 'malformed' ELSE 'short' END AS reason,
      CAST(count(*) AS BIGINT) AS n FROM o WHERE is_short OR is_malformed GROUP BY ALL""",
)
def intake_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = orders_intake(spark, sf_dir).quarantine
    return bad.groupBy("file_nm", "reason").agg(F.count("*").alias("n"))


@query(
    "intake_statuses",
    f"""WITH {raw.ORDERS_SQL}, files AS (
      SELECT DISTINCT file_nm, file_no % 5 = 3 AS wrong, bool_or(is_short OR is_malformed) OVER (PARTITION BY file_nm) AS bad FROM o)
    SELECT file_nm, 'Filelevelcheck' AS action_type, 'IndividualRowLength' AS action_typ_details, 'Fail' AS status FROM files WHERE bad
    UNION ALL SELECT file_nm, 'Filelevelcheck', 'fileContentCheck', 'Pass' FROM files
    UNION ALL SELECT file_nm, 'Filelevelcheck', 'rowCountCheck', CASE WHEN wrong THEN 'Fail' ELSE 'Pass' END FROM files
    UNION ALL SELECT file_nm, 'Filelevelcheck', 'sumCheckValidation', CASE WHEN wrong THEN 'Skipped' ELSE 'Pass' END FROM files
    UNION ALL SELECT file_nm, 'FileTransfer', 'rowCountCheck', 'Pass' FROM files WHERE wrong
    UNION ALL SELECT file_nm, 'Filelevelcheck', 'Parquetconversion', 'Pass' FROM files WHERE NOT wrong
    UNION ALL SELECT file_nm, 'DataTypeCheck', 'DataTypeHandling', 'Pass' FROM files WHERE NOT wrong
    UNION ALL SELECT file_nm, 'PublishToStage', 'PublishToStage', 'Pass' FROM files WHERE NOT wrong""",
)
def intake_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_intake(spark, sf_dir).statuses.select("file_nm", "action_type", "action_typ_details", "status")


@query(
    "intake_files",
    f"""WITH {raw.ORDERS_SQL}
    SELECT file_nm, 'two_heads' AS layout, 'equal' AS match, CAST(count(*) FILTER (NOT is_short AND NOT is_malformed) AS BIGINT) AS n_good,
      CAST(count(*) FILTER (is_short OR is_malformed) AS BIGINT) AS n_bad,
      CASE WHEN file_no % 5 = 3 THEN 'rejected' ELSE 'accepted' END AS disposition FROM o GROUP BY file_nm, file_no
    UNION ALL SELECT 'orders_never.csv', NULL, NULL, NULL, NULL, 'missing'""",
)
def intake_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = orders_intake(spark, sf_dir).files
    return files.select("file_nm", "layout", "match", "n_good", "n_bad", "disposition")


@query(
    "intake_fixed_width",
    f"""WITH {raw.ORDERS_SQL}
    SELECT o_orderkey AS "ORDERKEY", o_custkey AS "CUSTKEY", o_orderstatus AS "STATUS", CAST(total AS DECIMAL(18,2)) AS "TOTAL",
      CAST(o_orderdate AS DATE) AS "ORDERDATE", rpad(replace(o_orderpriority, ' ', ','), 15, ' ') AS "PRIORITY",
      '20240101' AS snap_dt, 'r1' AS run_id
    FROM o WHERE NOT is_short""",
)
def intake_fixed_width(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = raw.fixed_width_files(spark, sf_dir)
    control = ControlTables.from_rows(
        spark,
        expected_files=[("orders", "shop", "orders_fw", "fixed_width", "n", "n", "", "Y", "n", "Y")],
        checklist=[
            ("orders", "fileContentCheck", "HHDT", "1", None, 1, "A", None),
            ("orders", "rowCountCheck", None, "2", None, 1, "A", None),
        ],
        file_schema=ORDER_COLUMNS[:6],
    )
    control.manifest = manifest_of(spark, folder, "ORDERS")
    return ingest(spark, control, "orders", folder, IntakeOptions(folders=True)).published


@query(
    "intake_documents",
    """SELECT CAST(doc_id AS BIGINT) AS "DOC_ID", lang AS "LANG", source AS "SOURCE", trim(trim(text, '"'), '''') AS "TEXT",
      '20240101' AS snap_dt, 'r1' AS run_id FROM documents""",
)
def intake_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multi-line CSV without an indicator on the data rows."""
    folder = raw.documents_files(spark, sf_dir)
    settings = {"file_prefix_nm": {"documents": {"total_column": 4, "escape": '"'}}}
    control = ControlTables.from_rows(
        spark,
        expected_files=[("documents", "shop", None, None, "n", "n", "|", "N", "n", "Y")],
        checklist=[("documents", "rowCountCheck", None, "1", None, 1, "A", None)],
        mapping=[("listOfMultilineFiles", "k", None, json.dumps(settings), None, 1, "A", None)],
        file_schema=[
            ("documents", "doc_id", 1, 0, "bigint", False),
            ("documents", "lang", 2, 0, "string", False),
            ("documents", "source", 3, 0, "string", False),
            ("documents", "text", 4, 0, "string", False),
        ],
    )
    control.manifest = manifest_of(spark, folder, "documents")
    return ingest(spark, control, "documents", folder, IntakeOptions(folders=True)).published


@query(
    "intake_parts",
    """SELECT p_partkey AS "PARTKEY", p_name AS "NAME", p_brand AS "BRAND", '20240101' AS snap_dt, 'r1' AS run_id FROM part""",
)
def intake_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines without identifiers: two header lines and a trailer, found by position."""
    folder = raw.parts_files(spark, sf_dir)
    control = ControlTables.from_rows(
        spark,
        expected_files=[("parts", "shop", None, None, "n", "y", "7c", "N", "n", "Y")],
        checklist=[
            ("parts", "fileContentCheck", "HHDT_no", "1", None, 1, "A", None),
            ("parts", "rowCountCheck", None, "2", None, 1, "A", None),
        ],
        file_schema=[
            ("parts", "partkey", 1, 0, "bigint", False),
            ("parts", "name", 2, 0, "string", False),
            ("parts", "brand", 3, 0, "string", False),
        ],
    )
    control.manifest = manifest_of(spark, folder, "parts")
    return ingest(spark, control, "parts", folder, IntakeOptions(folders=True)).published


@query(
    "intake_customers_manual",
    f"""WITH {raw.CUSTOMERS_SQL} SELECT c_custkey AS "CUSTKEY", c_name AS "NAME", CAST(bal AS DECIMAL(18,2)) AS "ACCT_BAL",
      '20240101' AS snap_dt, 'r1' AS run_id FROM c
      WHERE file_nm NOT IN (SELECT file_nm FROM c WHERE c_custkey IN (SELECT o_custkey FROM orders) AND c_acctbal < -900
        AND c_mktsegment = 'BUILDING')""",
)
def intake_customers_manual(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manual files; a file with a key that has no parent is rejected."""
    folder = raw.manual_files(spark, sf_dir)
    parent = (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "orders").selectExpr("o_custkey c_custkey", "true ordered").distinct(), "c_custkey", "left")
        .filter("NOT (ordered IS NOT NULL AND c_acctbal < -900 AND c_mktsegment = 'BUILDING')")
    )
    control = ControlTables.from_rows(
        spark,
        expected_files=[("customers", "shop", None, None, "n", "n", "|", None, "n", "Y")],
        checklist=[("customers", "integrityCheck", "custkey=parent.c_custkey", "1", None, 1, "A", None)],
        mapping=[("tabcol_repmapping", " ", None, "_", None, 1, "A", None)],
        file_schema=[
            ("customers", "custkey", 1, 0, "bigint", False),
            ("customers", "name", 2, 0, "string", False),
            ("customers", "acct_bal", 3, 0, "decimal(18,2)", False),
        ],
    )
    control.manifest = manifest_of(spark, folder, "customers")
    return ingest(
        spark, control, "customers", folder, IntakeOptions(folders=True, parents={"parent": parent})
    ).published


@query(
    "intake_xml",
    """SELECT CAST(c_custkey AS VARCHAR) AS "CUSTKEY", c_name || ' & co' AS "NAME",
      CASE WHEN c_nationkey < 5 THEN '' ELSE c_mktsegment END AS "SEGMENT", '20240101' AS snap_dt, 'r1' AS run_id FROM customer""",
)
def intake_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = raw.xml_files(spark, sf_dir)
    settings = {"file_prefix_nm": {"customers": {"row_tag": "row"}}}
    control = ControlTables.from_rows(
        spark,
        expected_files=[("customers", "shop", None, None, "n", "n", "|", "Y", "n", "N")],
        mapping=[("xml_configuration", "k", None, json.dumps(settings), None, 1, "A", None)],
        file_schema=[
            ("customers", "custkey", 1, 0, "string", False),
            ("customers", "name", 2, 0, "string", False),
            ("customers", "segment", 3, 0, "string", False),
        ],
    )
    control.manifest = manifest_of(spark, folder, "customers")
    return ingest(spark, control, "customers", folder, IntakeOptions(folders=True)).published
