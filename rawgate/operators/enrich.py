"""Stamps, obfuscation and casting of good rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from rawgate.functions.casting import cast_failed, cast_text
from rawgate.functions.obfuscation import obfuscate
from rawgate.sources.control import metadata_value


def stamp_rows(rows: DataFrame, snap_dt: str | Column, run_id: str | Column) -> DataFrame:
    def value(v: str | Column) -> Column:
        return v if isinstance(v, Column) else F.lit(v)

    return rows.withColumns({"snap_dt": value(snap_dt), "run_id": value(run_id)})


def intraday_stamp(files: DataFrame, metadata: DataFrame) -> DataFrame:
    """Files with `snap_dt_ts`, looked up by (snap_dt, file_nm); null if missing.

    One value per file: of several metadata rows the least is taken.
    """
    stamps = metadata.groupBy("snap_dt", "file_nm").agg(
        F.min(metadata_value(F.col("meta_data_details"), "snap_dt_timestamp")).alias("snap_dt_ts")
    )
    return files.join(stamps, ["snap_dt", "file_nm"], "left")


def snap_date(snap_dt: Column) -> Column:
    return F.to_date(snap_dt, "yyyyMMdd")


def obfuscate_columns(rows: DataFrame, columns: Sequence[str], key: bytes, hidden: Column | None = None) -> DataFrame:
    """Rows with the named columns obfuscated; with `hidden`, an array of names, only where it has the name."""

    def changed(name: str) -> Column:
        text = F.col(f"`{name}`").cast("string")
        new = obfuscate(text, key)
        return new if hidden is None else F.when(F.array_contains(hidden, name), new).otherwise(text)

    return rows.withColumns({c: changed(c) for c in columns}) if columns else rows


def hidden_columns(files: DataFrame, dated: Sequence[Row]) -> DataFrame:
    """Files with `hidden`, `config_snap_dt` and `reset_snap_dt`: what the configuration says at their snapshot.

    A configuration row says from when on a column is hidden, or no longer. Of
    each column the latest row up to the snapshot counts (of several of one date
    the one that hides). The rows are control data of one prefix, and become
    expressions: an as-of lookup without a join.
    """
    by_column: dict[str, list[Column]] = {}
    for r in dated:
        if r["config_snap_dt"] is not None:
            entry = (r["config_snap_dt"], r["active"] is not False, r["reset_snap_dt"])
            named = [F.lit(v).cast(t).alias(n) for v, t, n in zip(entry, ("string", "boolean", "string"), ("since", "active", "reset"), strict=True)]
            by_column.setdefault(r["column_name"].upper(), []).append(F.struct(*named))
    if not by_column:
        none = {"hidden": F.array().cast("array<string>"), "config_snap_dt": F.lit(None).cast("string"), "reset_snap_dt": F.lit(None).cast("string")}
        return files.withColumns(none)
    latest = [
        F.struct(F.lit(name).alias("name"), F.array_max(F.filter(F.array(*rows), lambda r: r["since"] <= F.col("snap_dt"))).alias("l"))
        for name, rows in sorted(by_column.items())
    ]
    now = files.withColumn("_now", F.filter(F.array(*latest), lambda x: F.coalesce(x["l"]["active"], F.lit(False))))
    return now.withColumns(
        {
            "hidden": F.transform("_now", lambda x: x["name"]),
            "config_snap_dt": F.array_max(F.transform("_now", lambda x: x["l"]["since"])),
            "reset_snap_dt": F.array_max(F.transform("_now", lambda x: x["l"]["reset"])),
        }
    ).drop("_now")


def obfuscation_log(
    files: DataFrame, table: str, config_dt: str | Column, reset_dt: str | Column
) -> DataFrame:
    """Nine text values per loaded file."""

    def value(v: str | Column) -> Column:
        return v if isinstance(v, Column) else F.lit(v)

    return files.select(
        F.lit(table.lower()).alias("table_nm"),
        F.lit("snap_dt").alias("partition_col"),
        F.date_format(snap_date(F.col("snap_dt")), "yyyy-MM-dd").alias("partition_value"),
        value(config_dt).cast("string").alias("config_snap_dt"),
        value(reset_dt).cast("string").alias("reset_snap_dt"),
        F.date_format(F.current_date(), "yyyy-MM-dd").alias("run_dt"),
        F.lit("OBFUSCATION_COMPLETED").alias("status"),
        F.concat_ws(";", "snap_dt", "run_id", "file_nm").alias("file_info"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss").alias("time"),
    )


def reject_reason(names: Sequence[str], types: Sequence[str]) -> Column:
    """Names of the columns whose text does not convert, joined; null for a good row."""
    failed = [
        F.when(cast_failed(F.col(f"`{n}`"), t), F.lit(n)) for n, t in zip(names, types, strict=True) if t != "string"
    ]
    return F.nullif(F.concat_ws(",", *failed), F.lit("")) if failed else F.lit(None).cast("string")


def cast_rows(rows: DataFrame, names: Sequence[str], types: Sequence[str]) -> DataFrame:
    """Typed columns in place of the named text columns, others unchanged."""
    kinds = dict(zip(names, types, strict=True))
    return rows.select(
        *[
            cast_text(F.col(f"`{c}`"), kinds[c]).alias(c) if c in kinds else F.col(f"`{c}`")
            for c in rows.columns
        ]
    )


def cast_with_rejects(rows: DataFrame, names: Sequence[str], types: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(typed rows, rows with text that does not convert and `reject_cols`)."""
    marked = rows.withColumn("reject_cols", reject_reason(names, types))
    good = marked.filter(F.col("reject_cols").isNull()).drop("reject_cols")
    return cast_rows(good, names, types), marked.filter(F.col("reject_cols").isNotNull())
