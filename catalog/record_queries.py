"""Record classification."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import rawfiles as raw
from catalog.registry import query, table
from catalog.source_queries import cell, documents_records, orders_records
from rawgate.functions.delimiters import content_format as format_of
from rawgate.functions.headers import normalise_header
from rawgate.operators import records
from rawgate.session import stage
from rawgate.sources import csvfiles, lines


def parts_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.read_lines(spark, raw.parts_files(spark, sf_dir), folders=True)
    return stage(lines.delimited_records(found, "|"), "parts")


def line() -> F.Column:
    return lines.original_line("|").alias("line")


PART_HEADS = """SELECT DISTINCT file_nm, CAST(1 AS INTEGER) AS nth, '20240101' AS line FROM p
    UNION ALL SELECT DISTINCT file_nm, 2, 'PARTKEY|NAME|BRAND' FROM p"""


@query(
    "identifier_split",
    f"""WITH {raw.ORDERS_SQL}, {raw.FIXED_SQL}
    SELECT file_nm, 'D' AS identifier, body AS data FROM f
    UNION ALL SELECT DISTINCT file_nm, 'H', '20240101' FROM f
    UNION ALL SELECT DISTINCT file_nm, 'H', '{"".join(raw.FIXED_NAMES)}' FROM f
    UNION ALL SELECT file_nm, 'T', lpad(CAST(count(*) AS VARCHAR), 10, '0') FROM f GROUP BY file_nm""",
)
def identifier_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.read_lines(spark, raw.fixed_width_files(spark, sf_dir), folders=True)
    return records.identifier_split(found).select("file_nm", "identifier", "data")


@query(
    "record_type_counts",
    f"""WITH {raw.ORDERS_SQL}
    SELECT file_nm, CAST(count(*) + 3 AS BIGINT) AS n_lines, CAST(2 AS BIGINT) AS n_head, CAST(count(*) AS BIGINT) AS n_ind,
      CAST(1 AS BIGINT) AS n_trail, CAST(count(*) AS BIGINT) AS n_data FROM o GROUP BY file_nm""",
)
def record_type_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = records.file_counts(orders_records(spark, sf_dir))
    return counts.select("file_nm", "n_lines", "n_head", "n_ind", "n_trail", "n_data")


@query(
    "content_format",
    """SELECT p_partkey, CAST(p_size % 3 AS INTEGER) AS n_head, CAST(p_size % 2 AS INTEGER) AS n_tail,
      p_size > 25 AS no_ident FROM part""",
)
def content_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    formats = table(spark, sf_dir, "part").select(
        "p_partkey",
        F.expr("concat(repeat('H', p_size % 3), 'D', repeat('T', p_size % 2), if(p_size > 25, '_no', ''))").alias("f"),
    )
    return formats.select("p_partkey", format_of(F.col("f")).alias("c")).select("p_partkey", "c.*")


@query("take_headers", f"WITH {raw.PARTS_SQL} {PART_HEADS}")
def take_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.take_headers(parts_records(spark, sf_dir), 2).select("file_nm", "nth", line())


@query(
    "drop_headers",
    f"""WITH {raw.PARTS_SQL} SELECT file_nm, line FROM p
    UNION ALL SELECT file_nm, CAST(count(*) AS VARCHAR) FROM p GROUP BY file_nm""",
)
def drop_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.drop_edges(parts_records(spark, sf_dir), 2, 0).select("file_nm", line())


@query(
    "last_record",
    f"WITH {raw.PARTS_SQL} SELECT file_nm, CAST(count(*) AS VARCHAR) AS line FROM p GROUP BY file_nm",
)
def last_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.last_records(parts_records(spark, sf_dir)).select("file_nm", line())


@query("first_record", f"WITH {raw.PARTS_SQL} SELECT DISTINCT file_nm, '20240101' AS line FROM p")
def first_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.first_records(parts_records(spark, sf_dir)).select("file_nm", line())


@query(
    "drop_trailer",
    f"""WITH {raw.PARTS_SQL} SELECT file_nm, line FROM p
    UNION ALL SELECT file_nm, line FROM ({PART_HEADS})""",
)
def drop_trailer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.drop_edges(parts_records(spark, sf_dir), 0, 1).select("file_nm", line())


@query(
    "trailer_rows",
    f"""WITH {raw.ORDERS_SQL}
    SELECT file_nm, CAST(count(*) + CASE WHEN file_no % 5 = 3 THEN 1 ELSE 0 END AS VARCHAR) AS declared_rows,
      CAST(sum(CASE WHEN is_short OR is_malformed THEN 0 ELSE CAST(total AS DECIMAL(18,2)) END)
        + CASE WHEN file_no % 5 = 3 THEN 1 ELSE 0 END AS VARCHAR) AS declared_total
    FROM o GROUP BY file_nm, file_no""",
)
def trailer_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = records.trailer_rows(orders_records(spark, sf_dir))
    return found.select("file_nm", cell(1).alias("declared_rows"), cell(2).alias("declared_total"))


@query("data_rows", f"WITH {raw.ORDERS_SQL} SELECT file_nm, k, total FROM o")
def data_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = records.data_rows(orders_records(spark, sf_dir))
    return found.select("file_nm", cell(1).alias("k"), cell(4).alias("total"))


@query(
    "sample_detect",
    f"""WITH {raw.ORDERS_SQL}, s AS (
      SELECT file_nm, k, is_lower, row_number() OVER (PARTITION BY file_nm ORDER BY o_orderkey) AS rn FROM o)
    SELECT file_nm, CASE WHEN is_lower THEN 'd' ELSE 'D' END AS ident, k AS second FROM s WHERE rn <= 8
    UNION ALL SELECT DISTINCT file_nm, 'H', '20240101' FROM o
    UNION ALL SELECT DISTINCT file_nm, 'H', 'ORDERKEY' FROM o""",
)
def sample_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = records.sample_rows(stage(orders_records(spark, sf_dir), "orders"), 10)
    return found.select("file_nm", "ident", cell(1).alias("second"))


@query(
    "classify_layout",
    """SELECT DISTINCT 'v' || CAST(c_nationkey % 8 AS VARCHAR) || '_' || CAST(c_custkey // 250 AS VARCHAR) || '.csv' AS file_nm,
      CASE c_nationkey % 8 WHEN 0 THEN 'no_head' WHEN 1 THEN 'no_head' WHEN 2 THEN 'one_head_no_ind' WHEN 3 THEN 'one_head_ind'
        WHEN 4 THEN 'column_head' WHEN 6 THEN 'manual' ELSE 'two_heads' END AS layout,
      c_nationkey % 8 NOT IN (0, 2, 6) AS lead,
      CASE c_nationkey % 8 WHEN 4 THEN 'head_1' WHEN 5 THEN 'head_2' WHEN 7 THEN 'head_2' WHEN 6 THEN 'line_1'
        ELSE 'none' END AS header_from
    FROM customer""",
)
def classify_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.read_lines(spark, raw.layout_files(spark, sf_dir), folders=True)
    flagged = [v for v, (_, flag, _) in raw.LAYOUTS.items() if flag == "Y"]
    files = records.file_counts(lines.delimited_records(found, "|")).withColumns(
        {
            "col_header_flag": F.when(F.substring("file_nm", 2, 1).isin([str(v) for v in flagged]), "Y").otherwise("N"),
            "no_ident": F.lit(False),
            "fmt_head": F.lit(0),
            "fmt_tail": F.lit(0),
        }
    )
    return records.classify_layout(files).select("file_nm", "layout", "lead", "header_from")


@query(
    "empty_files",
    """SELECT 'part_' || CAST(p_partkey AS VARCHAR) AS file_nm, p_size > 25 AS no_lines FROM part
    WHERE p_size > 25 OR p_partkey IN (SELECT l_partkey FROM lineitem GROUP BY l_partkey HAVING max(l_quantity) <= 49)
      OR p_partkey NOT IN (SELECT l_partkey FROM lineitem)""",
)
def empty_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file per part: header, trailer, and a row per line item, a D row if it is large, else one more trailer; nothing at all for large parts."""
    parts = table(spark, sf_dir, "part")
    manifest = parts.selectExpr("concat('part_', p_partkey) file_nm", "p_size")
    edges = parts.filter("p_size <= 25").selectExpr("concat('part_', p_partkey) file_nm", "explode(array('H', 'T')) ident")
    items = (
        table(spark, sf_dir, "lineitem")
        .join(parts.filter("p_size <= 25").selectExpr("p_partkey l_partkey"), "l_partkey", "left_semi")
        .selectExpr("concat('part_', l_partkey) file_nm", "if(l_quantity > 49, 'D', 'T') ident")
    )
    found = edges.unionByName(items).withColumns(
        {"block": F.lit(0).cast("bigint"), "line_id": F.monotonically_increasing_id()}
    )
    files = records.with_counts(manifest, records.file_counts(found))
    return records.empty_files(files).select("file_nm", (F.col("n_lines") == 0).alias("no_lines"))


@query(
    "drop_indicator",
    f"""WITH {raw.ORDERS_SQL}
    SELECT file_nm, k, CAST(CASE WHEN is_short THEN 5 WHEN is_long THEN 8 ELSE 7 END AS INTEGER) AS n_fields FROM o""",
)
def drop_indicator(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = records.indicator_rows(orders_records(spark, sf_dir))
    return found.select("file_nm", cell(0).alias("k"), "n_fields")


@query(
    "restore_line",
    """SELECT c_custkey, CASE WHEN c_nationkey < 10 THEN lpad(CAST(c_custkey AS VARCHAR), 10, '0') || c_name
      ELSE c_name || c_mktsegment END AS data FROM customer""",
)
def restore_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey",
        "c_nationkey < 10 no_indicator",
        """if(c_nationkey < 10, concat(lpad(c_custkey, 10, '0'), c_name), concat('D', c_name, c_mktsegment)) value""",
    )
    return records.restore_line(found, F.col("no_indicator")).select("c_custkey", "data")


@query(
    "manual_header",
    f"""WITH {raw.CUSTOMERS_SQL}
    SELECT file_nm, 'data' AS kind, CAST(c_custkey AS VARCHAR) || '|' || c_name || '|' || bal AS line FROM c
    UNION ALL SELECT DISTINCT file_nm, 'header', 'CUSTKEY|NAME|ACCT_BAL' FROM c""",
)
def manual_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = stage(
        lines.delimited_records(lines.read_lines(spark, raw.manual_files(spark, sf_dir), folders=True), "|"), "manual"
    )
    header = records.first_records(found).select(
        "file_nm",
        F.lit("header").alias("kind"),
        F.array_join(normalise_header(F.col("cells"), [(" ", "_")]), "|").alias("line"),
    )
    data = records.drop_edges(found, 1, 0).select("file_nm", F.lit("data").alias("kind"), line())
    return data.unionByName(header)


@query(
    "extract_records",
    "SELECT CAST(conv_id AS VARCHAR) AS col_0, CAST(turn AS VARCHAR) AS col_1, role AS col_2, text AS col_3 FROM conversations",
)
def extract_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = csvfiles.read_csv_records(
        spark, raw.conversations_files(spark, sf_dir), 4, "|", multi_line=True, folders=True
    )
    kept = records.drop_edges(stage(found, "conversations"), 1, 1)
    return csvfiles.cell_columns(kept, 4).select("col_0", "col_1", "col_2", "col_3")


@query("strip_first_last", "SELECT CAST(doc_id AS VARCHAR) AS doc_id, text FROM documents")
def strip_first_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = stage(documents_records(spark, sf_dir), "documents")
    return records.drop_edges(found, 1, 1).select(cell(0).alias("doc_id"), cell(3).alias("text"))
