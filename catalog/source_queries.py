"""Scans, sources and control tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import rawfiles as raw
from catalog.registry import SQL, query, table
from rawgate import model
from rawgate.functions.delimiters import decode_delimiter
from rawgate.session import scratch_path, stage
from rawgate.sources import control, csvfiles, lines, listing, multiline, xmlfiles


def cell(i: int) -> F.Column:
    return F.get("cells", F.lit(i))


def orders_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.delimited_records(lines.read_lines(spark, raw.orders_files(spark, sf_dir), folders=True), "|")


ORDERS_RECORDS_SQL = f"""WITH {raw.ORDERS_SQL}
SELECT file_nm, CASE WHEN is_lower THEN 'd' ELSE 'D' END AS ident,
  CAST(CASE WHEN is_short THEN 6 WHEN is_long THEN 9 ELSE 8 END AS INTEGER) AS n_fields, is_malformed AS malformed,
  k AS second, CASE WHEN is_short THEN NULL WHEN is_malformed THEN '"x"y' ELSE note END AS note
FROM o
UNION ALL SELECT DISTINCT file_nm, 'H', 2, false, '20240101', NULL FROM o
UNION ALL SELECT DISTINCT file_nm, 'H', 8, false, 'ORDERKEY', 'NOTE' FROM o
UNION ALL SELECT file_nm, 'T', 3, false, CAST(count(*) + CASE WHEN file_no % 5 = 3 THEN 1 ELSE 0 END AS VARCHAR), NULL
FROM o GROUP BY file_nm, file_no"""


@query("scan_delimited", ORDERS_RECORDS_SQL)
def scan_delimited(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_records(spark, sf_dir).select(
        "file_nm", "ident", "n_fields", "malformed", cell(1).alias("second"), cell(7).alias("note")
    )


@query("scan_gzip", ORDERS_RECORDS_SQL)
def scan_gzip(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = raw.orders_gzip(spark, sf_dir)
    size = listing.list_files(spark, folder).agg(F.sum("file_size")).first()[0]
    records = lines.delimited_records(lines.read_gzip_lines(spark, folder, size, folders=True), "|")
    return records.select(
        "file_nm", "ident", "n_fields", "malformed", cell(1).alias("second"), cell(7).alias("note")
    )


@query("strip_nul", "SELECT doc_id, replace(text, ' ', '') AS text FROM documents")
def strip_nul(spark: SparkSession, sf_dir: str) -> DataFrame:
    dirty = table(spark, sf_dir, "documents").select("doc_id", F.translate("text", " ", "\x00").alias("text"))
    return dirty.select("doc_id", lines.strip_nul(F.col("text")).alias("text"))


def documents_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multiline.multiline_records(spark, [raw.documents_files(spark, sf_dir)], 4, "|", folders=True)


@query(
    "scan_multiline",
    """SELECT CAST(doc_id AS VARCHAR) AS c0, lang AS c1, coalesce(source, '') AS c2, coalesce(text, '') AS c3 FROM documents
    UNION ALL SELECT 'H', '20240101', '', '' FROM (SELECT DISTINCT doc_id // 50 FROM documents)
    UNION ALL SELECT 'T', CAST(count(*) AS VARCHAR), '', '' FROM documents GROUP BY doc_id // 50""",
)
def scan_multiline(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = documents_records(spark, sf_dir)
    return records.select(*[F.coalesce(cell(i), F.lit("")).alias(f"c{i}") for i in range(4)])


SCAN_MULTILINE_SQL = SQL["scan_multiline"]


@query("scan_multiline_split", SCAN_MULTILINE_SQL)
def scan_multiline_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same records by their texts, cut into cells by Spark's own line parser."""
    quoting = multiline.Quoting("|", '"', '"')
    texts = multiline.record_texts(multiline.placed_lines(spark, [raw.documents_files(spark, sf_dir)], quoting, True), quoting)
    cells = F.from_csv("value", csvfiles.string_schema(4), {"sep": "|", "quote": '"', "escape": '"'}).alias("p")
    return texts.select(cells).select(*[F.coalesce(F.col(f"p.col_{i}"), F.lit("")).alias(f"c{i}") for i in range(4)])


@query(
    "scan_multiline_dirty",
    f"""WITH {raw.DIRTY_SQL}
    SELECT CAST(doc_id AS VARCHAR) AS c0, CASE WHEN bad THEN '' ELSE tongue END AS c1, CASE WHEN bad THEN '' ELSE coalesce(source, '') END AS c2,
      CASE WHEN bad THEN '' ELSE coalesce(text, '') END AS c3, bad AS malformed FROM d
    UNION ALL SELECT 'T', CAST(count(*) AS VARCHAR), '', '', false FROM d GROUP BY doc_id // 50""",
)
def scan_multiline_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text behind closing quotes, quotes inside of cells, lone carriage returns, quotes that are never closed."""
    records = multiline.multiline_records(spark, [raw.dirty_files(spark, sf_dir)], 4, "|", folders=True)
    shown = [F.when(F.col("malformed"), "").otherwise(F.coalesce(cell(i), F.lit(""))).alias(f"c{i}") for i in range(1, 4)]
    return records.select(cell(0).alias("c0"), *shown, "malformed")


def events_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return csvfiles.read_csv_records(
        spark, raw.events_files(spark, sf_dir), 5, ";", escape="\\", quote="'", folders=True
    )


@query("scan_quoted", "SELECT CAST(event_id AS VARCHAR) AS event_id, event_type, props FROM events")
def scan_quoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events_records(spark, sf_dir).filter(F.col("ident") == "D")
    return rows.select(cell(1).alias("event_id"), cell(2).alias("event_type"), cell(3).alias("props"))


@query(
    "scan_drop_malformed",
    f"""SELECT CAST(event_id AS VARCHAR) AS event_id, event_type, props, '1' AS flag FROM events
    WHERE NOT ({raw.EVENT_BAD})""",
)
def scan_drop_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = csvfiles.drop_malformed(events_records(spark, sf_dir)).filter(F.col("ident") == "D")
    wide = csvfiles.cell_columns(rows, 5)
    return wide.select(
        F.col("col_1").alias("event_id"),
        F.col("col_2").alias("event_type"),
        F.col("col_3").alias("props"),
        F.col("col_4").alias("flag"),
    )


def fixed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.fixed_width_records(lines.read_lines(spark, raw.fixed_width_files(spark, sf_dir), folders=True))


@query(
    "scan_fixed_width",
    f"""WITH {raw.ORDERS_SQL}, {raw.FIXED_SQL}
    SELECT file_nm, 'D' AS ident, 'D' || body AS line FROM f
    UNION ALL SELECT DISTINCT file_nm, 'H', 'H20240101' FROM f
    UNION ALL SELECT DISTINCT file_nm, 'H', 'H{"".join(raw.FIXED_NAMES)}' FROM f
    UNION ALL SELECT file_nm, 'T', 'T' || lpad(CAST(count(*) AS VARCHAR), 10, '0') FROM f GROUP BY file_nm""",
)
def scan_fixed_width(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixed_records(spark, sf_dir).select("file_nm", "ident", cell(0).alias("line"))


@query(
    "scan_xml",
    """SELECT CAST(c_custkey AS VARCHAR) AS custkey, c_name || ' & co' AS name,
      CASE WHEN c_nationkey < 5 THEN '' ELSE c_mktsegment END AS segment FROM customer""",
)
def scan_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["CUSTKEY", "NAME", "SEGMENT"]
    records = xmlfiles.xml_records(spark, [raw.xml_files(spark, sf_dir)], "row", columns, folders=True)
    return records.select(*[cell(i).alias(c.lower()) for i, c in enumerate(columns)])


@query("scan_xml_split", SQL["scan_xml"])
def scan_xml_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same files by Spark's own reader, a task per file."""
    columns = ["CUSTKEY", "NAME", "SEGMENT"]
    records = xmlfiles.read_xml_records(spark, raw.xml_files(spark, sf_dir), "row", columns, folders=True)
    return records.select(*[cell(i).alias(c.lower()) for i, c in enumerate(columns)])


@query(
    "scan_xml_nested",
    """SELECT CAST(c_custkey AS VARCHAR) AS custkey, c_name || ' & co' AS name,
      CASE WHEN c_nationkey % 5 = 3 THEN '</row> & <row>' ELSE c_mktsegment END AS segment FROM customer""",
)
def scan_xml_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row elements in row elements, end tags with blanks, tags in comments and CDATA sections."""
    columns = ["CUSTKEY", "NAME", "SEGMENT"]
    records = xmlfiles.xml_records(spark, [raw.nested_xml_files(spark, sf_dir)], "row", columns, folders=True)
    return records.filter("NOT malformed").select(*[cell(i).alias(c.lower()) for i, c in enumerate(columns)])


@query(
    "decode_delimiter",
    """SELECT event_id, CASE event_type WHEN 'view' THEN '|' WHEN 'click' THEN chr(9) WHEN 'error' THEN '~' || chr(1)
      WHEN 'signup' THEN chr(CAST(33 + user_id % 90 AS INTEGER)) ELSE chr(1) END AS sep FROM events""",
)
def decode_delimiters(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = table(spark, sf_dir, "events").select(
        "event_id",
        F.expr(r"""CASE event_type WHEN 'view' THEN '|' WHEN 'click' THEN '\\t' WHEN 'error' THEN '~\\x01'
          WHEN 'signup' THEN lower(hex(33 + user_id % 90)) ELSE '1' END""").alias("field_delimiter"),
        F.expr("CASE event_type WHEN 'signup' THEN 'Y' WHEN 'purchase' THEN 'y' ELSE 'n' END").alias("flag"),
    )
    return coded.select("event_id", decode_delimiter(F.col("field_delimiter"), F.col("flag")).alias("sep"))


@query(
    "control_tables",
    """SELECT 'order_' || CAST(l_orderkey AS VARCHAR) AS file_prefix_nm, l_returnflag AS file_chck_typ,
      CAST(l_linenumber AS VARCHAR) AS priority, CAST(l_quantity AS INTEGER) AS eff_seq,
      CAST(NULL AS VARCHAR) AS status_flag FROM lineitem""",
)
def control_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A checklist kept as text with its columns in another order."""
    path = scratch_path(spark, "checklist")
    table(spark, sf_dir, "lineitem").selectExpr(
        "cast(cast(l_quantity as int) as string) EFF_SEQ",
        "cast(l_linenumber as string) priority",
        "concat('order_', l_orderkey) file_prefix_nm",
        "l_returnflag file_chck_typ",
        "'' arguments",
    ).write.parquet(path)
    loaded = control.conform(spark.read.parquet(path), model.CHECKLIST)
    return loaded.select("file_prefix_nm", "file_chck_typ", "priority", "eff_seq", "status_flag")


@query("mapping_lookup", "SELECT p_name AS key1, p_type AS val1 FROM part WHERE lower(p_brand) = 'brand#7'")
def mapping_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapping = table(spark, sf_dir, "part").selectExpr(
        "CASE WHEN p_size > 25 THEN upper(p_brand) ELSE p_brand END group_name",
        "p_name key1",
        "p_type val1",
        "cast(p_partkey as int) eff_seq",
    )
    return control.mapping_lookup(control.conform(mapping, model.MAPPING), "bRAND#7")


@query(
    "json_config",
    """SELECT c_name AS file_prefix_nm,
      CASE WHEN c_nationkey < 5 THEN 'multiline' WHEN c_nationkey < 10 OR c_acctbal < 0 THEN 'clean'
           WHEN c_nationkey < 15 THEN 'xml' ELSE 'plain' END AS mode,
      CASE WHEN (c_nationkey BETWEEN 5 AND 9 OR c_acctbal < 0) AND c_mktsegment = 'BUILDING' THEN 'Y' ELSE 'N' END AS quote_flag
    FROM customer""",
)
def json_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    settings = """concat('{"file_prefix_nm": {"', c_name, '": {"total_column": ', c_nationkey,
      CASE WHEN c_mktsegment = 'BUILDING' THEN ', "quote_flag": "Y"' ELSE '' END, ', "escape": "\\\\\\\\"}}}')"""

    def group(name: str, where: str) -> DataFrame:
        return customers.filter(where).selectExpr(f"'{name}' group_name", f"{settings} val1")

    mapping = (
        group("listOfMultilineFiles", "c_nationkey < 5")
        .unionByName(group("data_clean_configuration", "c_nationkey BETWEEN 5 AND 9 OR c_acctbal < 0"))
        .unionByName(group("XML_configuration", "c_nationkey BETWEEN 10 AND 14"))
    )
    modes = control.reading_modes(
        customers.select(F.col("c_name").alias("file_prefix_nm")), control.conform(mapping, model.MAPPING)
    )
    return modes.select("file_prefix_nm", "mode", "quote_flag")


@query(
    "pending_files",
    """SELECT 'order_' || CAST(o_orderkey AS VARCHAR) AS file_nm, strftime(o_orderdate, '%Y%m%d') AS snap_dt
    FROM orders WHERE o_orderstatus = 'F' AND lower(o_orderpriority) = '2-high'""",
)
def pending_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = table(spark, sf_dir, "orders").selectExpr(
        "concat('order_', o_orderkey) file_nm",
        "o_orderstatus src_sys_nm",
        "'r1' run_id",
        "date_format(o_orderdate, 'yyyyMMdd') snap_dt",
        "o_orderpriority file_prefix_nm",
    )
    return control.pending_files(manifest, "F", "2-High").select("file_nm", "snap_dt")


@query(
    "pending_after_runs",
    """SELECT 'order_' || CAST(o_orderkey AS VARCHAR) AS file_nm, strftime(o_orderdate, '%Y%m%d') AS snap_dt FROM orders
    WHERE coalesce((SELECT CASE WHEN max(l_linenumber * 2 + CASE WHEN l_tax < 0.03 THEN 1 ELSE 0 END) % 2 = 1 THEN false ELSE true END
      FROM lineitem WHERE l_orderkey = o_orderkey), true)""",
)
def pending_after_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order is a file, its lines are attempts to load it, low taxes say that one succeeded: pending unless the last did."""
    manifest = table(spark, sf_dir, "orders").selectExpr(
        "concat('order_', o_orderkey) file_nm", "'s' src_sys_nm", "'r1' run_id", "date_format(o_orderdate, 'yyyyMMdd') snap_dt", "'p' file_prefix_nm"
    )
    steps = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "cast(l_linenumber as string) time", "explode(if(l_tax < 0.03, array('Filelevelcheck', 'PublishToStage'), array('Filelevelcheck'))) action_type"
    )
    orders = table(spark, sf_dir, "orders").selectExpr("o_orderkey l_orderkey", "date_format(o_orderdate, 'yyyyMMdd') snap_dt")
    statuses = steps.join(orders, "l_orderkey").selectExpr(
        "concat('order_', l_orderkey) file_nm", "'s' src_sys_nm", "'r1' run_id", "snap_dt", "'P' file_prefix_nm", "action_type", "'Pass' status", "time"
    )
    return control.pending_files(manifest, "s", "p", control.finished_files(statuses)).select("file_nm", "snap_dt")


@query(
    "missing_files",
    """SELECT DISTINCT 'orders_' || lpad(CAST(l_orderkey // 1000 AS VARCHAR), 6, '0') || '_' || lower(l_returnflag) || '.csv'
      AS file_nm FROM lineitem""",
)
def missing_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files per key range are there; files per key range and return flag are not."""
    listed = stage(listing.list_files(spark, raw.orders_files(spark, sf_dir)), "listing")
    name = "concat('orders_', lpad(cast(l_orderkey div 1000 as string), 6, '0')"
    items = table(spark, sf_dir, "lineitem")
    manifest = (
        items.selectExpr(f"{name}, '.csv') file_nm")
        .unionByName(items.selectExpr(f"{name}, '_', lower(l_returnflag), '.csv') file_nm"))
        .distinct()
    )
    return listing.missing_files(manifest, listed)
