"""Stamps, obfuscation, casting, publishing and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from catalog import rawfiles as raw
from catalog.registry import query, table
from catalog.row_queries import judged_orders
from catalog.schema_queries import headers_with_match
from catalog.source_queries import cell
from rawgate.functions.obfuscation import deobfuscate, obfuscate
from rawgate.operators import enrich, publish
from rawgate.session import scratch_path
from rawgate.sources.lines import partition_plan as planned

# key of the examples only; a real one comes from the caller's secret store
KEY = b"not-a-secret"


@query(
    "stamp_rows",
    f"""WITH {raw.ORDERS_SQL} SELECT file_nm, k, '20240101' AS snap_dt, 'run_' || CAST(file_no AS VARCHAR) AS run_id
    FROM o WHERE NOT is_short AND NOT is_malformed""",
)
def stamp_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = judged_orders(spark, sf_dir)
    number = F.regexp_extract("file_nm", "_([0-9]+)", 1).cast("int").cast("string")
    rows = good.select("file_nm", cell(1).alias("k"))
    return enrich.stamp_rows(rows, "20240101", F.concat(F.lit("run_"), number))


@query(
    "intraday_stamp",
    """SELECT 'f_' || CAST(event_id AS VARCHAR) AS file_nm, strftime(ts, '%Y%m%d') AS snap_dt,
      CASE WHEN event_type = 'error' THEN NULL ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS snap_dt_ts FROM events""",
)
def intraday_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event is a file; the details have the stamp in another place for each kind of event."""
    events = table(spark, sf_dir, "events")
    files = events.selectExpr("concat('f_', event_id) file_nm", "date_format(ts, 'yyyyMMdd') snap_dt")
    stamp = "concat('snap_dt_timestamp:', date_format(ts, 'yyyy-MM-dd HH:mm:ss'))"
    metadata = events.selectExpr(
        "date_format(ts, 'yyyyMMdd') snap_dt",
        "concat('f_', event_id) file_nm",
        f"""CASE event_type WHEN 'error' THEN 'file_size:1,rows:2' WHEN 'view' THEN {stamp}
          ELSE concat('file_size:1,rows:2,', {stamp}) END meta_data_details""",
    )
    return enrich.intraday_stamp(files, metadata).select("file_nm", "snap_dt", "snap_dt_ts")


@query("snap_date", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS snap_date FROM orders")
def snap_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = table(spark, sf_dir, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyyMMdd").alias("snap_dt"))
    return text.select("o_orderkey", enrich.snap_date(F.col("snap_dt")).cast("string").alias("snap_date"))


def _xor_sql(text: str) -> str:
    """Byte by byte over the hex digits: data XOR repeating key, as base64."""
    key = KEY.hex().upper()
    byte = "('0x' || substr({h}, {i}, 2))::INTEGER"
    data = byte.format(h=f"hex(encode({text}))", i="2 * i + 1")
    mask = byte.format(h=f"'{key}'", i=f"2 * (i % {len(KEY)}) + 1")
    # printf keeps both digits of a byte
    coded = f"array_to_string([printf('%02X', xor({data}, {mask})) FOR i IN range(octet_length(encode({text})))], '')"
    return f"CASE WHEN {text} IS NULL OR {text} = '' THEN '' ELSE to_base64(unhex({coded})) END"


@query("obfuscate", f"SELECT c_custkey, {_xor_sql('c_name || c_mktsegment')} AS code FROM customer")
def obfuscate_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat("c_name", "c_mktsegment")
    return table(spark, sf_dir, "customer").select("c_custkey", obfuscate(text, KEY).alias("code"))


@query(
    "deobfuscate",
    """SELECT conv_id, turn, CASE WHEN role = 'user' THEN coalesce(text, '') ELSE 'decrypt_fail' END AS text FROM conversations""",
)
def deobfuscate_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """There and back for whole texts; what is not base64 does not come back."""
    coded = table(spark, sf_dir, "conversations").select(
        "conv_id",
        "turn",
        F.when(F.col("role") == "user", obfuscate(F.col("text"), KEY)).otherwise(F.concat(F.lit("?!"), "text")).alias("code"),
    )
    return coded.select("conv_id", "turn", deobfuscate(F.col("code"), KEY).alias("text"))


@query("obfuscate_columns", f"SELECT s_suppkey, {_xor_sql('s_name')} AS s_name, s_nationkey FROM supplier")
def obfuscate_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    return enrich.obfuscate_columns(rows, ["s_name"], KEY)


@query(
    "obfuscate_by_date",
    f"""WITH config AS (SELECT CASE WHEN n_nationkey % 2 = 0 THEN 'PRIORITY' ELSE 'STATUS' END AS c,
      CAST(1992 + n_nationkey % 7 AS VARCHAR) || '0601' AS since, n_nationkey % 3 <> 0 AS active FROM nation),
    dates AS (SELECT DISTINCT strftime(o_orderdate, '%Y%m%d') AS snap_dt FROM orders),
    latest AS (SELECT snap_dt, c, max(since || CASE WHEN active THEN '1' ELSE '0' END) AS l FROM dates, config WHERE since <= snap_dt GROUP BY ALL),
    hides AS (SELECT snap_dt, c FROM latest WHERE l LIKE '%1')
    SELECT o_orderkey,
      CASE WHEN EXISTS (SELECT 1 FROM hides h WHERE h.snap_dt = strftime(o_orderdate, '%Y%m%d') AND c = 'STATUS') THEN {_xor_sql("o_orderstatus")} ELSE o_orderstatus END AS STATUS,
      CASE WHEN EXISTS (SELECT 1 FROM hides h WHERE h.snap_dt = strftime(o_orderdate, '%Y%m%d') AND c = 'PRIORITY') THEN {_xor_sql("o_orderpriority")} ELSE o_orderpriority END AS PRIORITY,
      (SELECT max(substr(l, 1, 8)) FROM latest l WHERE l.snap_dt = strftime(o_orderdate, '%Y%m%d') AND l LIKE '%1') AS config_snap_dt
    FROM orders""",
)
def obfuscate_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations say from which date on a column is hidden, or no longer; each order is hidden by what holds at its date."""
    config = table(spark, sf_dir, "nation").selectExpr(
        "if(n_nationkey % 2 = 0, 'priority', 'status') column_name",
        "concat(1992 + n_nationkey % 7, '0601') config_snap_dt",
        "cast(null as string) reset_snap_dt",
        "n_nationkey % 3 <> 0 active",
    )
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "date_format(o_orderdate, 'yyyyMMdd') snap_dt", "o_orderstatus STATUS", "o_orderpriority PRIORITY"
    )
    files = enrich.hidden_columns(orders, config.collect())
    return enrich.obfuscate_columns(files, ["STATUS", "PRIORITY"], KEY, F.col("hidden")).select("o_orderkey", "STATUS", "PRIORITY", "config_snap_dt")


@query(
    "obfuscation_log",
    """SELECT 'db.orders_parquet' AS table_nm, 'snap_dt' AS partition_col, strftime(o_orderdate, '%Y-%m-%d') AS partition_value,
      '20240101' AS config_snap_dt, '20240102' AS reset_snap_dt, 'OBFUSCATION_COMPLETED' AS status,
      strftime(o_orderdate, '%Y%m%d') || ';r1;f_' || CAST(o_orderkey AS VARCHAR) AS file_info FROM orders""",
)
def obfuscation_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = table(spark, sf_dir, "orders").selectExpr(
        "concat('f_', o_orderkey) file_nm", "date_format(o_orderdate, 'yyyyMMdd') snap_dt", "'r1' run_id"
    )
    return enrich.obfuscation_log(files, "db.Orders_parquet", "20240101", "20240102").drop("run_dt", "time")


TEXT_NAMES = ["KEY", "TOTAL", "ORDERDATE", "FLAG"]
TEXT_TYPES = ["bigint", "decimal(18,2)", "date", "string"]


def text_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as text, some of it not a number or a date, some blank."""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "concat(' ', o_orderkey) KEY",
        "CASE o_orderpriority WHEN '1-URGENT' THEN 'n/a' WHEN '2-HIGH' THEN '' ELSE cast(cast(o_totalprice as decimal(18,2)) as string) END TOTAL",
        "if(o_orderstatus = 'P' AND o_orderpriority = '3-MEDIUM', '2024-13-45', date_format(o_orderdate, 'yyyy-MM-dd')) ORDERDATE",
        "o_orderstatus FLAG",
    )


REJECTED = "(o_orderpriority = '1-URGENT' OR (o_orderstatus = 'P' AND o_orderpriority = '3-MEDIUM'))"


@query(
    "cast_types",
    f"""SELECT o_orderkey, o_orderkey AS "KEY", CASE WHEN o_orderpriority = '2-HIGH' THEN NULL
      ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS "TOTAL", CAST(o_orderdate AS DATE) AS "ORDERDATE", o_orderstatus AS "FLAG"
    FROM orders WHERE NOT {REJECTED}""",
)
def cast_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.cast_with_rejects(text_rows(spark, sf_dir), TEXT_NAMES, TEXT_TYPES)[0]


@query(
    "cast_rejects",
    f"""SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 'TOTAL' ELSE 'ORDERDATE' END AS reject_cols
    FROM orders WHERE {REJECTED}""",
)
def cast_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejects = enrich.cast_with_rejects(text_rows(spark, sf_dir), TEXT_NAMES, TEXT_TYPES)[1]
    return rejects.select("o_orderkey", "reject_cols")


STATUS_SQL = """SELECT strftime(o_orderdate, '%Y%m%d') AS snap_dt, 'r1' AS run_id, 'f_' || CAST(o_orderkey AS VARCHAR) AS file_nm,
  o_orderstatus AS src_sys_nm, o_orderpriority AS file_prefix_nm, 'NA' AS glue_table_nm"""


def order_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order as a file."""
    return table(spark, sf_dir, "orders").selectExpr(
        "date_format(o_orderdate, 'yyyyMMdd') snap_dt",
        "'r1' run_id",
        "concat('f_', o_orderkey) file_nm",
        "o_orderstatus src_sys_nm",
        "o_orderpriority file_prefix_nm",
        "o_orderkey",
    )


@query(
    "cast_skipped",
    f"""{STATUS_SQL}, 'DataTypeCheck' AS action_type, 'TypeCastingSkipped' AS action_typ_details, 'Pass' AS status FROM orders""",
)
def cast_skipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = order_files(spark, sf_dir)
    return publish.status_rows(files, "DataTypeCheck", "TypeCastingSkipped", "Pass").drop("time", "run_dt")


@query(
    "publish_stage",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y') AS snap_dt, 'r1' AS run_id,
      CASE WHEN strftime(o_orderdate, '%Y') = '1996' THEN 'second' ELSE 'first' END AS load
    FROM orders WHERE strftime(o_orderdate, '%Y') <> '1996' OR o_orderstatus = 'F'""",
)
def publish_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All years are published, then one of them again: only that one is replaced."""
    path = scratch_path(spark, "stage")
    rows = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "o_orderstatus", "date_format(o_orderdate, 'yyyy') snap_dt", "'r1' run_id"
    )
    publish.publish(rows.selectExpr("o_orderkey", "'first' load", "snap_dt", "run_id"), path)
    again = rows.filter("snap_dt = '1996' AND o_orderstatus = 'F'")
    publish.publish(again.selectExpr("o_orderkey", "'second' load", "snap_dt", "run_id"), path)
    return spark.read.schema("o_orderkey bigint, load string, snap_dt string, run_id string").parquet(path)


@query(
    "publish_to_typed_table",
    """SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, CAST(CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS VARCHAR) AS total,
      strftime(o_orderdate, '%Y-%m-%d') AS d, CAST(NULL AS VARCHAR) AS added, '' AS reject_cols FROM orders WHERE o_orderstatus <> 'F' OR o_orderpriority <> '5-LOW'
    UNION ALL SELECT o_orderkey, 'much', strftime(o_orderdate, '%Y-%m-%d'), NULL, 'TOTAL' FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '5-LOW'""",
)
def publish_to_typed_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of text meet the types of a table; blank numbers are null, words are rejected, a column of the table only is null."""
    target = StructType.fromDDL("O_ORDERKEY bigint, TOTAL decimal(18,2), D date, ADDED int, snap_dt string, run_id string")
    total = "CASE WHEN o_orderstatus = 'P' THEN ' ' WHEN o_orderstatus = 'F' AND o_orderpriority = '5-LOW' THEN 'much' ELSE cast(cast(o_totalprice as decimal(18,2)) as string) END"
    rows = table(spark, sf_dir, "orders").selectExpr(
        "cast(o_orderkey as string) o_orderkey", f"{total} total", "date_format(o_orderdate, 'yyyy-MM-dd') d", "date_format(o_orderdate, 'yyyy') snap_dt", "'r1' run_id"
    )
    good, bad = publish.reconcile(rows, target)
    path = scratch_path(spark, "typed")
    publish.publish(good, path)
    written = spark.read.schema(target).parquet(path)
    shown = ["cast(O_ORDERKEY as bigint) o_orderkey", "cast(TOTAL as string) total", "cast(D as string) d"]
    return written.selectExpr(*shown, "cast(ADDED as string) added", "'' reject_cols").unionByName(
        bad.selectExpr(*shown, "cast(null as string) added", "reject_cols")
    )


@query("publish_parts", "SELECT l_orderkey, l_returnflag AS part, 's' AS snap_dt, 'r1' AS run_id FROM lineitem")
def publish_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One load in several parts, some of which come with a later job of the run."""
    path = scratch_path(spark, "parts")
    rows = table(spark, sf_dir, "lineitem").selectExpr("l_orderkey", "l_returnflag part", "'s' snap_dt", "'r1' run_id")
    publish.publish(rows.filter("part <> 'R'"), path)
    publish.publish(rows.filter("part = 'R'"), path, part_files=True)
    return spark.read.schema("l_orderkey bigint, part string, snap_dt string, run_id string").parquet(path)


@query(
    "dq_copy",
    """SELECT s_suppkey AS supplier_id, s_name AS supplier_name, '20240101' AS snap_dt, 'r1' AS run_id FROM supplier""",
)
def dq_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Renamed and stamped rows, not cast, kept for the quality step."""
    from rawgate.operators.schema import rename_to_target

    path = scratch_path(spark, "dq")
    rows = rename_to_target(table(spark, sf_dir, "supplier").select("s_suppkey", "s_name"), ["supplier_id", "supplier_name"])
    publish.publish(enrich.stamp_rows(rows, "20240101", "r1"), path)
    return spark.read.schema("supplier_id bigint, supplier_name string, snap_dt string, run_id string").parquet(path)


@query("write_csv", "SELECT conv_id, turn, text FROM conversations")
def write_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    publish.write_csv(table(spark, sf_dir, "conversations").select("conv_id", "turn", "text"), path)
    reader = spark.read.schema("conv_id bigint, turn bigint, text string")
    return reader.option("multiLine", True).option("escape", '"').csv(path)


@query(
    "status_log",
    f"""{STATUS_SQL}, 'Filelevelcheck' AS action_type, 'Emptyfilecheck' AS action_typ_details, 'Fail' AS status
    FROM orders WHERE o_orderstatus = 'P'
    UNION ALL {STATUS_SQL}, 'FileTransfer', 'EmptyfileTransfer', 'Pass' FROM orders WHERE o_orderstatus = 'P'
    UNION ALL {STATUS_SQL}, 'Filelevelcheck', 'Parquetconversion', 'Pass' FROM orders WHERE o_orderstatus <> 'P'""",
)
def status_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = order_files(spark, sf_dir)
    empty, full = files.filter("src_sys_nm = 'P'"), files.filter("src_sys_nm <> 'P'")
    log = publish.status_log(
        [
            publish.status_rows(empty, "Filelevelcheck", "Emptyfilecheck", "Fail"),
            publish.status_rows(empty, "FileTransfer", "EmptyfileTransfer", "Pass"),
            publish.status_rows(full, "Filelevelcheck", "Parquetconversion", "Pass"),
        ]
    )
    path = scratch_path(spark, "status")
    publish.append_status(log, path)
    return spark.read.schema(log.schema).parquet(path).drop("time", "run_dt")


@query(
    "schema_failures",
    f"""SELECT snap_dt, run_id, file_prefix_nm, src_sys_nm, file_nm, 'Schemavalidation' AS check_nm, 'Fail' AS status,
      'Schema Matching failed' AS reason FROM ({STATUS_SQL} FROM orders WHERE o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW'))""",
)
def schema_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = headers_with_match(spark, sf_dir).filter("match = 'fail'").select("o_orderkey")
    report = publish.schema_failures(order_files(spark, sf_dir).join(failed, "o_orderkey"))
    return report.select(
        "snap_dt", "run_id", "file_prefix_nm", "src_sys_nm", "file_nm", "check_nm", "status", "reason"
    )


@query(
    "partition_plan",
    """SELECT o_orderkey, CAST(CAST(o_totalprice AS BIGINT) * 10000
      // CASE WHEN o_orderstatus = 'F' THEN 20971520 ELSE 209715200 END + 1 AS INTEGER) AS partitions FROM orders""",
)
def partition_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order is a file, its price gives the size."""
    files = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "cast(round(o_totalprice, 0) as bigint) * 10000 size",
        "concat('f_', o_orderkey, if(o_orderstatus = 'F', '.csv.gz', '.csv')) name",
    )
    return files.select("o_orderkey", planned(F.col("size"), F.col("name")).alias("partitions"))


@query(
    "dq_routing",
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'A' THEN 'publish' ELSE 'dq' END AS route FROM lineitem""",
)
def dq_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A missing flag and one that is not a number mean 1."""
    flags = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey",
        "l_linenumber",
        "CASE l_returnflag WHEN 'A' THEN ' 0' WHEN 'N' THEN if(l_linestatus = 'O', NULL, 'no') ELSE '1' END flag",
    )
    return flags.select("l_orderkey", "l_linenumber", publish.dq_route_column(F.col("flag")).alias("route"))


@query(
    "file_disposition",
    """SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 'missing' WHEN o_totalprice < 50000 THEN 'empty'
      WHEN o_orderpriority = '2-HIGH' OR o_orderstatus = 'F' THEN 'rejected' WHEN o_orderpriority = '3-MEDIUM' THEN 'waiting'
      ELSE 'accepted' END AS disposition FROM orders""",
)
def file_disposition(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = publish.disposition(
        missing=F.col("o_orderpriority") == "1-URGENT",
        empty=F.col("o_totalprice") < 50000,
        schema_fail=F.col("o_orderpriority") == "2-HIGH",
        failed=F.col("o_orderstatus") == "F",
        waiting=F.col("o_orderpriority") == "3-MEDIUM",
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", chosen.alias("disposition"))
