"""Schema matching and projection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import rawfiles as raw
from catalog.registry import query, table
from catalog.source_queries import cell, fixed_records, orders_records
from rawgate import model
from rawgate.functions import headers
from rawgate.operators import records, rows, schema
from rawgate.sources import control


@query(
    "expected_columns",
    """SELECT 'order_' || CAST(l_orderkey AS VARCHAR) AS file_prefix_nm,
      string_agg('C' || CAST(l_partkey AS VARCHAR), ',' ORDER BY l_linenumber, 'C' || CAST(l_partkey AS VARCHAR)) AS names,
      CAST(sum(CAST(l_quantity AS INTEGER)) AS BIGINT) AS total_length
    FROM lineitem GROUP BY l_orderkey""",
)
def expected_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order is a prefix, its line items are the registered columns."""
    registered = table(spark, sf_dir, "lineitem").selectExpr(
        "concat(if(l_returnflag = 'R', 'ORDER_', 'order_'), l_orderkey) file_prefix_nm",
        "concat('c', l_partkey) column_name",
        "l_linenumber col_seq",
        "cast(l_quantity as int) col_length",
    )
    found = control.expected_columns(control.conform(registered, model.FILE_SCHEMA))
    total = F.aggregate("lengths", F.lit(0).cast("bigint"), lambda a, n: a + n)
    return found.select("file_prefix_nm", F.array_join("names", ",").alias("names"), total.alias("total_length"))


@query(
    "fw_header_slice",
    """SELECT c_custkey, substr(c_name, 1, 8) AS a, substr(c_name, 9, 4) AS b, substr(c_name, 13, 6) AS c FROM customer""",
)
def fw_header_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = headers.slice_text(F.col("c_name"), [8, 4, 6])
    found = table(spark, sf_dir, "customer").select("c_custkey", cut.alias("cells"))
    return found.select("c_custkey", cell(0).alias("a"), cell(1).alias("b"), cell(2).alias("c"))


@query(
    "normalise_header",
    """SELECT p_partkey, regexp_replace(regexp_replace(upper(replace(replace(p_name || '__' || p_brand || '_x#', ' ', '_'), '#', '_')),
      '_+', '_', 'g'), '_$', '') AS name FROM part""",
)
def normalise_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "part").selectExpr("p_partkey", "concat(p_name, '__', p_brand, '_x#') name")
    return schema.normalised_names(names, "name", [(" ", "_"), ("#", "_")])


@query(
    "rename_cols",
    """SELECT p_partkey AS "part.key", p_name AS "part.name", p_brand AS "part.brand" FROM part""",
)
def rename_cols(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand")
    return schema.rename_cols(parts, [("p_part", "p_"), ("p_", "part.")])


HEADERS = """CASE o_orderpriority WHEN '1-URGENT' THEN 'Key,Status,Total' WHEN '2-HIGH' THEN 'Key,Status,Total,More'
  WHEN '3-MEDIUM' THEN 'Key,More,Status,Total' WHEN '4-NOT SPECIFIED' THEN 'Status,Key,Total' ELSE 'Key,Total' END"""


def headers_with_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order is a file whose header is one of five."""
    names = F.array(*[F.lit(n) for n in ("KEY", "STATUS", "TOTAL")])
    files = table(spark, sf_dir, "orders").select(
        "o_orderkey", headers.normalise_header(F.split(F.expr(HEADERS), ",")).alias("header"), names.alias("expected")
    )
    return files.withColumns(
        {
            "match": headers.schema_match(F.col("header"), F.col("expected")),
            "place": headers.pick_positions(F.col("header"), F.col("expected")),
        }
    )


@query(
    "schema_match",
    """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'equal' WHEN '2-HIGH' THEN 'extra'
      WHEN '3-MEDIUM' THEN 'extra' ELSE 'fail' END AS match FROM orders""",
)
def schema_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return headers_with_match(spark, sf_dir).select("o_orderkey", "match")


@query(
    "project_expected",
    """SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS "KEY", o_orderstatus AS "STATUS",
      CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS "TOTAL"
    FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')""",
)
def project_expected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By header name where a file has an additional column in the middle."""
    found = headers_with_match(spark, sf_dir).filter("match <> 'fail'")
    body = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.split(
            F.expr("""concat(o_orderkey, if(o_orderpriority = '3-MEDIUM', ',m,', ','), o_orderstatus, ',',
              cast(o_totalprice as decimal(18,2)), if(o_orderpriority = '2-HIGH', ',m', ''))"""),
            ",",
        ).alias("cells"),
    )
    return schema.project_expected(
        body.join(found, "o_orderkey"), ["KEY", "STATUS", "TOTAL"], ["o_orderkey"], F.col("place")
    )


@query(
    "project_positional",
    f"""WITH {raw.ORDERS_SQL}
    SELECT file_nm, k AS "KEY", ck AS "CUST", o_orderstatus AS "STATUS" FROM o""",
)
def project_positional(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = records.indicator_rows(orders_records(spark, sf_dir))
    return schema.project_expected(data, ["KEY", "CUST", "STATUS"], ["file_nm"])


@query("rename_to_target", "SELECT s_suppkey AS supplier_id, s_name AS supplier_name, s_nationkey, s_acctbal FROM supplier")
def rename_to_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schema.rename_to_target(table(spark, sf_dir, "supplier"), ["supplier_id", "supplier_name"])


@query(
    "fw_extract",
    f"""WITH {raw.ORDERS_SQL}
    SELECT file_nm, lpad(k, 12, '0') AS "ORDERKEY", lpad(ck, 10, '0') AS "CUSTKEY", o_orderstatus AS "STATUS",
      lpad(total, 16, ' ') AS "TOTAL", d AS "ORDERDATE", rpad(replace(o_orderpriority, ' ', ','), 15, ' ') AS "PRIORITY"
    FROM o WHERE NOT is_short""",
)
def fw_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = records.data_rows(fixed_records(spark, sf_dir))
    body = records.restore_line(data.withColumn("value", cell(0)), F.lit(False))
    good, _ = rows.split_good_bad(body, rows.length_reason(F.col("data"), sum(raw.FIXED_LENGTHS)))
    return schema.fixed_width_columns(good, F.col("data"), raw.FIXED_NAMES, raw.FIXED_LENGTHS, ["file_nm"])


def config_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer is a prefix; some settings are missing."""
    rows_ = table(spark, sf_dir, "customer").selectExpr(
        "if(c_nationkey > 12, upper(c_name), lower(c_name)) file_prefix_nm",
        "cast(c_nationkey as string) src_sys_nm",
        "CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE concat('t_', c_custkey) END trgt_tbl_nm",
        "CASE WHEN c_mktsegment = 'MACHINERY' THEN 'Fixed_Width' ELSE 'csv' END file_type",
        "'|' field_delimiter",
        "CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'N' END col_header_flag",
        "CASE WHEN c_mktsegment = 'FURNITURE' THEN 'Y' END intraday_flag",
    )
    return control.conform(rows_, model.EXPECTED_FILES)


@query(
    "target_name",
    """SELECT CASE WHEN c_nationkey > 12 THEN upper(c_name) ELSE lower(c_name) END AS file_prefix_nm,
      CASE WHEN c_mktsegment = 'BUILDING' THEN CASE WHEN c_nationkey > 12 THEN upper(c_name) ELSE lower(c_name) END
        ELSE 't_' || CAST(c_custkey AS VARCHAR) END AS target FROM customer""",
)
def target_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return config_rows(spark, sf_dir).select("file_prefix_nm", control.target_name().alias("target"))


@query(
    "config_defaults",
    """SELECT lower(c_name) AS file_prefix_nm, c_mktsegment = 'MACHINERY' AS fixed_width,
      CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'N' ELSE 'Y' END AS col_header_flag,
      CASE WHEN c_mktsegment = 'FURNITURE' THEN 'y' ELSE 'n' END AS intraday_flag, 'N' AS typecasting_flag, '|' AS sep
    FROM customer""",
)
def config_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = control.with_defaults(config_rows(spark, sf_dir))
    return found.select(
        F.lower("file_prefix_nm").alias("file_prefix_nm"),
        *["fixed_width", "col_header_flag", "intraday_flag", "typecasting_flag", "sep"],
    )


@query(
    "distinct_config",
    "SELECT DISTINCT lower(p_brand) AS file_prefix_nm, p_type AS typecasting_flag FROM part",
)
def distinct_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").selectExpr(
        "if(p_size > 25, upper(p_brand), p_brand) file_prefix_nm", "p_type typecasting_flag"
    )
    return control.distinct_config(parts, "typecasting_flag")
