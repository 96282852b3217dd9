"""Cleaning of cells and malformed records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import rawfiles as raw
from catalog.registry import query, table
from catalog.source_queries import cell, events_records
from rawgate.functions import cleaning
from rawgate.operators import rows
from rawgate.session import stage


@query(
    "clean_cells",
    """SELECT doc_id,
      CASE WHEN lang = 'en' THEN coalesce('"''' || replace(text, 'e', '"') || '''"', '')
           ELSE trim(trim(coalesce('"''' || replace(text, 'e', '"') || '''"', ''), '"'), '''') END AS text,
      coalesce(CASE WHEN source LIKE '%e%' THEN NULL ELSE source END, '') AS source FROM documents""",
)
def clean_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text in both kinds of quotes, each `e` turned into U+FFFD."""
    dirty = table(spark, sf_dir, "documents").select(
        "doc_id",
        "lang",
        F.concat(F.lit("\"'"), F.translate("text", "e", "�"), F.lit("'\"")).alias("text"),
        F.expr("CASE WHEN source LIKE '%e%' THEN NULL ELSE source END").alias("source"),
    )
    return dirty.select(
        "doc_id",
        cleaning.clean_cell(F.col("text"), F.col("lang") == "en").alias("text"),
        cleaning.clean_cell(F.col("source")).alias("source"),
    )


@query(
    "remove_chars",
    r"""SELECT page_id, replace(regexp_replace(html, '[^\x20-\x7e]', '', 'g'), '&amp;', '') AS html,
      replace(regexp_replace(url, '[^\x20-\x7e]', '', 'g'), '&amp;', '') AS url FROM pages""",
)
def remove_chars(spark: SparkSession, sf_dir: str) -> DataFrame:
    patterns = [r"[^\x20-\x7e]", "&amp;"]
    return table(spark, sf_dir, "pages").select(
        "page_id", *[cleaning.remove_chars(F.col(c), patterns).alias(c) for c in ("html", "url")]
    )


@query("drop_by_index", "SELECT l_orderkey, l_suppkey, l_linenumber, l_returnflag FROM lineitem")
def drop_by_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.drop_by_index(table(spark, sf_dir, "lineitem"), [2, 5, 6, 7, 8, 10, 11])


NULLED = "CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderstatus END"


@query("fill_blank", f"SELECT o_orderkey, coalesce({NULLED}, '') AS status FROM orders")
def fill_blank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.fill_blank(table(spark, sf_dir, "orders").selectExpr("o_orderkey", f"{NULLED} status"))


@query(
    "unquote_pair",
    """SELECT conv_id, turn, CASE role WHEN 'user' THEN text WHEN 'assistant' THEN '"' || text ELSE NULL END AS text
    FROM conversations""",
)
def unquote_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    quoted = table(spark, sf_dir, "conversations").selectExpr(
        "conv_id",
        "turn",
        """CASE role WHEN 'user' THEN concat('"', text, '"') WHEN 'assistant' THEN concat('"', text) END text""",
    )
    return quoted.withColumn("text", cleaning.unquote_pair(F.col("text")))


@query(
    "drop_all_null",
    """SELECT CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_orderkey END AS k,
      CASE WHEN l_linestatus = 'O' THEN NULL ELSE l_partkey END AS p
    FROM lineitem WHERE NOT (l_returnflag = 'R' AND l_linestatus = 'O')""",
)
def drop_all_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.drop_all_null(
        table(spark, sf_dir, "lineitem").selectExpr(
            "CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_orderkey END k",
            "CASE WHEN l_linestatus = 'O' THEN NULL ELSE l_partkey END p",
        )
    )


BAD_EVENTS = f"SELECT CAST(event_id AS VARCHAR) AS event_id, event_type FROM events WHERE {raw.EVENT_BAD}"


@query("bad_records_auto", BAD_EVENTS)
def bad_records_auto(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = rows.bad_records(events_records(spark, sf_dir), "automated")
    return bad.select(cell(1).alias("event_id"), cell(2).alias("event_type"))


@query("bad_records_manual", BAD_EVENTS)
def bad_records_manual(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = rows.bad_records(stage(events_records(spark, sf_dir), "events"), "manual")
    return bad.select(cell(1).alias("event_id"), cell(2).alias("event_type"))


@query(
    "bad_records_distinct",
    f"""SELECT DISTINCT 'events_' || lpad(CAST(event_id // 2000 AS VARCHAR), 6, '0') || '.csv' AS file_nm, event_type, props
    FROM events WHERE {raw.EVENT_BAD}""",
)
def bad_records_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equal bad records count once: here rows are looked at without their id."""
    found = events_records(spark, sf_dir).withColumn("cells", F.slice("cells", 3, 2))
    bad = rows.bad_records(found, "automated", distinct=True)
    return bad.select("file_nm", cell(0).alias("event_type"), cell(1).alias("props"))
