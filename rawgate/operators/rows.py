"""Row validation: good rows, quarantine, reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from rawgate.operators.records import drop_edges, is_data


def width_reason(need: Column | int) -> Column:
    """Why a delimited row is bad: `malformed`, `short`, or null for a good one.
    A row with more fields than needed is good and will be cut."""
    need = need if isinstance(need, Column) else F.lit(need)
    return F.when(F.col("malformed"), "malformed").when(F.col("n_fields") < need, "short")


def length_reason(text: Column, total: int) -> Column:
    """Why a fixed-width line is bad: shorter than the registered lengths."""
    return F.when(F.length(text) < total, "short")


def split_good_bad(rows: DataFrame, reason: Column) -> tuple[DataFrame, DataFrame]:
    marked = rows.withColumn("reason", reason)
    return marked.filter(F.col("reason").isNull()).drop("reason"), marked.filter(F.col("reason").isNotNull())


def bad_row_report(bad: DataFrame, text: Column, n: int = 10) -> DataFrame:
    """Per file: number of bad rows and the first `n` of them.

    Counting is a plain aggregate; the rank filter lets each task pass on at
    most `n` rows per file, so no task ever gathers all the bad rows of a file.
    """
    counts = bad.groupBy("file_nm").agg(F.count("*").alias("bad_rows"))
    order = Window.partitionBy("file_nm").orderBy("block", "line_id")
    first = (
        bad.select("file_nm", "block", "line_id", text.alias("text"))
        .withColumn("nth", F.row_number().over(order))
        .filter(F.col("nth") <= n)
        .groupBy("file_nm")
        .agg(F.array_sort(F.collect_list(F.struct("nth", "text"))).alias("s"))
        .select("file_nm", F.col("s.text").alias("samples"))
    )
    return counts.join(first, "file_nm")


def quarantine(bad: DataFrame) -> DataFrame:
    """Bad rows with their position, raw line and reason."""
    return bad.select(
        "file_nm", F.struct("block", F.col("line_id").alias("id")).alias("pos"), F.col("line").alias("value"), "reason"
    )


def counted(df: DataFrame, name: str, where: Column | None = None) -> tuple[DataFrame, Observation]:
    """`df` with a count of its rows (`where` holds) that is taken while it is written, at no extra job."""
    seen = Observation(name)
    return df.observe(seen, F.count_if(F.lit(True) if where is None else where).alias("rows")), seen


def bad_records(records: DataFrame, config_type: str, distinct: bool = False, need: Column | int = 0) -> DataFrame:
    """Bad records of a configured file: malformed ones, and those with fewer than `need` fields.

    `automated` files look at rows marked D, `manual` ones at all but the first
    row. `distinct` counts equal rows once.
    """
    if config_type == "automated":
        rows = records.filter(is_data(F.lit(True)))
    elif config_type == "manual":
        rows = drop_edges(records, 1, 0)
    else:
        raise ValueError(f"file type must be automated or manual, not {config_type!r}")
    _, bad = split_good_bad(rows, width_reason(need))
    return bad.select("file_nm", "cells").distinct() if distinct else bad
