"""Control tables: file definitions, rules, mappings, registered columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from rawgate import model
from rawgate.functions.delimiters import decode_delimiter

_SCHEMAS = {
    "expected_files": model.EXPECTED_FILES,
    "checklist": model.CHECKLIST,
    "mapping": model.MAPPING,
    "file_schema": model.FILE_SCHEMA,
    "manifest": model.MANIFEST,
    "file_metadata": model.FILE_METADATA,
    "row_count_history": model.ROW_COUNT_HISTORY,
}
_OPTIONAL = {"statuses": model.STATUS, "obfuscation": model.OBFUSCATION}


@dataclass
class ControlTables:
    """The seven tables that describe a run, and what earlier runs have left.

    With `statuses`, the log that runs append to, files that it says are finished
    are not loaded again. `obfuscation` says by date which columns are hidden.
    """

    expected_files: DataFrame
    checklist: DataFrame
    mapping: DataFrame
    file_schema: DataFrame
    manifest: DataFrame
    file_metadata: DataFrame
    row_count_history: DataFrame
    statuses: DataFrame | None = None
    obfuscation: DataFrame | None = None

    @classmethod
    def from_rows(cls, spark: SparkSession, **rows: list[tuple]) -> ControlTables:
        """Tables from Python rows; a table that is not given is empty."""
        kept = {n: spark.createDataFrame(rows[n], ddl) for n, ddl in _OPTIONAL.items() if n in rows}
        return cls(**{n: spark.createDataFrame(rows.get(n, []), ddl) for n, ddl in _SCHEMAS.items()}, **kept)

    @classmethod
    def from_tables(cls, spark: SparkSession, **tables: str) -> ControlTables:
        """Tables of the catalog, by name; columns are cast to the known types."""
        kept = {n: conform(spark.table(tables[n]), ddl) for n, ddl in _OPTIONAL.items() if n in tables}
        return cls(**{n: conform(spark.table(tables[n]), ddl) for n, ddl in _SCHEMAS.items()}, **kept)


def conform(df: DataFrame, ddl: str) -> DataFrame:
    """The columns of `ddl`, in order, cast; a column that is not there is null."""
    have = {c.lower(): c for c in df.columns}
    wanted = [part.rsplit(" ", 1) for part in ddl.split(", ")]
    return df.select(
        *[
            (F.col(f"`{have[name]}`") if name in have else F.lit(None)).cast(kind).alias(name)
            for name, kind in wanted
        ]
    )


def for_prefix(table: DataFrame, prefix: str) -> DataFrame:
    return table.filter(F.lower("file_prefix_nm") == prefix.lower())


def distinct_config(table: DataFrame, *columns: str) -> DataFrame:
    """One row per prefix (in lower case) and set of values."""
    return table.select(F.lower("file_prefix_nm").alias("file_prefix_nm"), *columns).dropDuplicates()


def target_name() -> Column:
    return F.coalesce(F.col("trgt_tbl_nm"), F.col("file_prefix_nm"))


def with_defaults(expected: DataFrame) -> DataFrame:
    """Nulls replaced by their defaults and the delimiter decoded."""
    return expected.select(
        "file_prefix_nm",
        "src_sys_nm",
        target_name().alias("target"),
        F.coalesce(F.lower("file_type") == "fixed_width", F.lit(False)).alias("fixed_width"),
        F.coalesce(F.lower("part_file_flag") == "y", F.lit(False)).alias("part_files"),
        decode_delimiter(F.col("field_delimiter"), F.coalesce("hexacodes_flag", F.lit("n"))).alias("sep"),
        F.coalesce("col_header_flag", F.lit("Y")).alias("col_header_flag"),
        F.lower(F.coalesce("intraday_flag", F.lit("n"))).alias("intraday_flag"),
        F.coalesce("typecasting_flag", F.lit("N")).alias("typecasting_flag"),
    )


def mapping_lookup(mapping: DataFrame, group: str) -> DataFrame:
    """key1 and val1 of a group, whatever its case, in order of `eff_seq`."""
    return (
        mapping.filter(F.lower("group_name") == group.lower())
        .select("key1", "val1", "eff_seq")
        .orderBy(F.col("eff_seq").asc_nulls_last(), "key1")
        .select("key1", "val1")
    )


MODE_GROUPS = {
    "multiline": "listOfMultilineFiles",
    "clean": "data_clean_configuration",
    "xml": "xml_configuration",
}


def prefix_settings(mapping: DataFrame) -> DataFrame:
    """One row per prefix (in lower case) that a JSON object of the three groups names: its settings by mode, null where it has none.

    Of several objects of a group that name a prefix, the last in order of `eff_seq` counts.
    """
    groups = F.lower("group_name")
    mode = F.lit(None).cast("string")
    for name, group in MODE_GROUPS.items():
        mode = F.when(groups == group.lower(), name).otherwise(mode)
    order = F.struct(F.col("eff_seq").isNull().alias("last"), F.col("eff_seq"), F.col("key1"))
    parsed = mapping.select(mode.alias("mode"), order.alias("order"), F.from_json("val1", model.PREFIX_CONFIG)["file_prefix_nm"].alias("by_prefix"))
    named = parsed.filter(F.col("mode").isNotNull()).select("mode", "order", F.explode("by_prefix").alias("prefix", "settings"))

    def own(name: str) -> Column:
        return F.max_by("settings", F.when(F.col("mode") == name, F.col("order"))).alias(name)

    return named.groupBy(F.lower("prefix").alias("file_prefix_nm")).agg(*[own(name) for name in MODE_GROUPS])


def reading_mode() -> Column:
    """Multi-line before clean before XML before plain."""
    mode = F.lit("plain")
    for name in reversed(MODE_GROUPS):
        mode = F.when(F.col(name).isNotNull(), name).otherwise(mode)
    return mode


def reading_modes(prefixes: DataFrame, mapping: DataFrame) -> DataFrame:
    """Mode and quote flag of each prefix, from the JSON settings of the three groups."""
    found = prefix_settings(mapping).withColumnRenamed("file_prefix_nm", "_prefix")
    joined = prefixes.join(found, F.lower("file_prefix_nm") == F.col("_prefix"), "left")
    return joined.select("file_prefix_nm", reading_mode().alias("mode"), F.coalesce("clean.quote_flag", F.lit("N")).alias("quote_flag"))


@dataclass
class PrefixMapping:
    """What the mapping table says about one prefix."""

    mode: str
    settings: dict[str, Row]
    pairs: list[tuple[str, str]]


def mapping_of(mapping: DataFrame, prefix: str) -> PrefixMapping:
    """Mode, JSON settings and name pairs of one prefix."""
    rows = prefix_settings(mapping).filter(F.col("file_prefix_nm") == prefix.lower()).withColumn("mode", reading_mode()).collect()
    settings = {name: row[name] for row in rows for name in MODE_GROUPS if row[name] is not None}
    pairs = [(r["key1"], r["val1"]) for r in mapping_lookup(mapping, "tabcol_repmapping").collect()]
    return PrefixMapping(rows[0]["mode"] if rows else "plain", settings, pairs)


def expected_columns(file_schema: DataFrame) -> DataFrame:
    """Registered columns per prefix in order: upper-case names, lengths, types."""
    entry = F.struct(
        F.col("col_seq"),
        F.upper("column_name").alias("name"),
        F.length(F.trim("column_name")).alias("name_length"),
        "col_length",
        F.coalesce("data_type", F.lit("string")).alias("data_type"),
        F.coalesce("obfuscate", F.lit(False)).alias("obfuscate"),
    )
    return (
        file_schema.groupBy(F.lower("file_prefix_nm").alias("file_prefix_nm"))
        .agg(F.array_sort(F.collect_list(entry)).alias("columns"))
        .select(
            "file_prefix_nm",
            F.col("columns.name").alias("names"),
            F.col("columns.name_length").alias("name_lengths"),
            F.col("columns.col_length").alias("lengths"),
            F.col("columns.data_type").alias("types"),
            F.col("columns.obfuscate").alias("obfuscate"),
        )
    )


def with_lead(names: Column, lead: Column) -> Column:
    """The expected list, with the pseudo-column H first for an indicator."""
    return F.when(lead, F.concat(F.array(F.lit("H")), names)).otherwise(names)


#: what tells one delivery of a file from another
DELIVERY = ["file_nm", "src_sys_nm", "snap_dt", "run_id"]
#: steps that end the way of a file
FINAL_STEPS = ("PublishToStage", "DqInputCopy")


def finished_files(statuses: DataFrame) -> DataFrame:
    """DELIVERY and prefix (in lower case) of the files whose latest attempt was published, from the status log.

    The log may be of any length: it is reduced to one row per delivery on the
    map side. A rejected or waiting file is not finished: it may come again.
    """
    done = F.col("action_type").isin(*FINAL_STEPS)
    if "action_typ_details" in statuses.columns:
        done = done | F.col("action_typ_details").isin(*FINAL_STEPS)
    latest = F.max(F.struct("time", F.coalesce(done & (F.col("status") == "Pass"), F.lit(False)).alias("done")))
    by = [*DELIVERY, F.lower("file_prefix_nm").alias("file_prefix_nm")]
    return statuses.groupBy(*by).agg(latest.alias("l")).filter("l.done").drop("l")


def pending_files(manifest: DataFrame, src_sys_nm: str | None, prefix: str, finished: DataFrame | None = None) -> DataFrame:
    """Files of a source and prefix that wait to be loaded: those of the manifest without the `finished` ones."""
    files = for_prefix(manifest, prefix)
    files = files.filter(F.col("src_sys_nm") == src_sys_nm) if src_sys_nm else files
    return files if finished is None else files.join(for_prefix(finished, prefix).select(*DELIVERY), DELIVERY, "left_anti")


def metadata_value(details: Column, key: str) -> Column:
    """Value of `key` in text such as `file_size:1,rows:2,key:value`; null if not there."""
    return F.nullif(F.regexp_extract(details, rf"(?:^|,)\s*{key}:([^,]*)", 1), F.lit(""))
