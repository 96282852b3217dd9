"""CSV readers with a registered all-string schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rawgate.session import many_files
from rawgate.sources.lines import numbered

BAD = "_bad"


def string_schema(width: int, prefix: str = "col_") -> str:
    return ", ".join(f"{prefix}{i} string" for i in range(width))


def read_csv_records(
    spark: SparkSession,
    paths: str | list[str],
    width: int,
    sep: str,
    escape: str = '"',
    quote: str = '"',
    multi_line: bool = False,
    folders: bool = False,
) -> DataFrame:
    """Records of `width` string cells, in the shape of `model.RECORD`.

    A row with another number of fields is flagged by the corrupt-record
    column and keeps its text in `value`. Column pruning is off for this
    reader: a parser that is asked for some columns only does not see that a
    row has too many or too few of them, in dropping mode either. With
    `multi_line`, quoted line breaks are kept inside cells; Spark then reads
    one file per task.
    """
    cols = [f"col_{i}" for i in range(width)]
    reader = (
        spark.read.schema(f"{string_schema(width)}, {BAD} string")
        .option("header", False)
        .option("sep", sep)
        .option("quote", quote)
        .option("escape", escape)
        .option("multiLine", multi_line)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", BAD)
        .option("columnPruning", False)
    )
    with many_files(spark):
        rows = reader.csv(paths)
    return numbered(
        rows,
        folders,
        F.col("col_0").alias("ident"),
        F.lit(width).alias("n_fields"),
        # with a data column, as Spark refuses to read the corrupt-record column alone
        F.concat(F.coalesce("col_0", F.lit("")), BAD).isNotNull().alias("malformed"),
        F.array(*cols).alias("cells"),
        F.col(BAD).alias("value"),
    )


def drop_malformed(records: DataFrame) -> DataFrame:
    return records.filter(~F.col("malformed"))


def cell_columns(records: DataFrame, width: int, prefix: str = "col_") -> DataFrame:
    """`cells` spread over named columns (missing ones null), the rest kept."""
    return records.select(
        *[c for c in records.columns if c != "cells"],
        *[F.get("cells", F.lit(i)).alias(f"{prefix}{i}") for i in range(width)],
    )
