"""Writing results, statuses and reports."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from rawgate.functions.casting import cast_failed, cast_text
from rawgate.model import STATUS_COLUMNS

PARTITION = ["snap_dt", "run_id"]


def publish(rows: DataFrame, path: str, part_files: bool = False) -> None:
    """Write rows under (snap_dt, run_id) and, where `rows` have it, file_nm.

    Only the partitions that are in `rows` are replaced. With file_nm, a file
    that comes later in a run leaves the others alone, and a repeated one
    replaces itself, part files too. Without it, `part_files` adds to what an
    earlier job of the same run has written. There is no shuffle: a task holds
    rows of one or a few files, and so writes to one or a few partitions.
    """
    by_file = ["file_nm"] if "file_nm" in rows.columns else []
    writer = rows.write.partitionBy(*PARTITION, *by_file)
    if part_files and not by_file:
        writer.mode("append").parquet(path)
    else:
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def reconcile(rows: DataFrame, target: StructType) -> tuple[DataFrame, DataFrame]:
    """(rows with the columns and types of `target`, in its order; rows with a value that does not fit, and `reject_cols`).

    Columns are told by name, whatever its case. A column of the target that rows
    lack is null; one that rows have and the target lacks is an error, as it would
    be lost. Blank text is null for a type that is no text.
    """
    have = {c.lower(): c for c in rows.columns}
    lost = sorted(have.keys() - {f.name.lower() for f in target})
    if lost:
        raise ValueError(f"the target has no column for {', '.join(lost)}")

    def of(field: StructField) -> tuple[Column, Column]:
        """(value, whether the source has one that does not fit)"""
        kind = field.dataType.simpleString()
        if field.name.lower() not in have:
            return F.lit(None).cast(kind), F.lit(False)
        source = F.col(f"`{have[field.name.lower()]}`")
        given = rows.schema[have[field.name.lower()]].dataType.simpleString()
        if given == kind:
            return source, F.lit(False)
        if given == "string":
            return cast_text(source, kind), cast_failed(source, kind)
        value = source.try_cast(kind)
        return value, source.isNotNull() & value.isNull()

    told = [(f.name, *of(f)) for f in target]
    failed = F.nullif(F.concat_ws(",", *[F.when(bad, F.lit(name)) for name, _, bad in told]), F.lit(""))
    marked = rows.withColumn("reject_cols", failed)
    good = marked.filter(F.col("reject_cols").isNull()).select(*[value.alias(name) for name, value, _ in told])
    return good, marked.filter(F.col("reject_cols").isNotNull())


def publish_table(rows: DataFrame, table: str, part_files: bool = False) -> None:
    """The same for a table of the catalog, which is made if it is not there; see `reconcile` for one with other types."""
    spark = rows.sparkSession
    by_file = ["file_nm"] if "file_nm" in rows.columns else []
    if not spark.catalog.tableExists(table):
        rows.write.partitionBy(*PARTITION, *by_file).format("parquet").saveAsTable(table)
        return
    ordered = rows.select(*spark.table(table).columns)
    if part_files and "file_nm" not in ordered.columns:
        ordered.write.insertInto(table)
    else:
        ordered.write.option("partitionOverwriteMode", "dynamic").insertInto(table, overwrite=True)


def table_columns(spark: SparkSession, table: str) -> list[str]:
    """Names of the data columns of a target table, for the positional rename."""
    return [c for c in spark.table(table).columns if c not in (*PARTITION, "file_nm")]


def write_csv(rows: DataFrame, path: str, sep: str = ",") -> None:
    rows.write.mode("append").option("sep", sep).option("escape", '"').option(
        "ignoreLeadingWhiteSpace", False
    ).option("ignoreTrailingWhiteSpace", False).option("emptyValue", "").csv(path)


def dq_route(flag: int | str | None) -> str:
    """`publish` for 0, else `dq`: a missing or unreadable flag means 1."""
    try:
        return "publish" if int(flag) == 0 else "dq"
    except (TypeError, ValueError):
        return "dq"


def dq_route_column(flag: Column) -> Column:
    return F.when(F.trim(flag).try_cast("int") == 0, "publish").otherwise("dq")


def status_rows(files: DataFrame, action_type: str | Column, detail: str | Column, status: str | Column) -> DataFrame:
    """Status rows in the stored shape for each row of `files`
    (file_nm, snap_dt, run_id, src_sys_nm, file_prefix_nm)."""

    def value(v: str | Column) -> Column:
        return v if isinstance(v, Column) else F.lit(v)

    return files.select(
        *STATUS_COLUMNS[:5],
        F.lit("NA").alias("glue_table_nm"),
        value(action_type).alias("action_type"),
        value(detail).alias("action_typ_details"),
        value(status).alias("status"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss").alias("time"),
        F.date_format(F.current_date(), "yyyy-MM-dd").alias("run_dt"),
    )


def status_events(files: DataFrame, entries: Column) -> DataFrame:
    """Status rows from an array of (action_type, action_typ_details, status)
    per file: one scan of the file table, whatever the number of steps."""
    each = files.select(*STATUS_COLUMNS[:5], F.explode(entries).alias("e"))
    return status_rows(each, F.col("e.action_type"), F.col("e.action_typ_details"), F.col("e.status"))


def event(when: Column, action_type: str, detail: str, status: str) -> Column:
    """One entry for `status_events`, null unless `when`."""
    return F.when(
        when,
        F.struct(
            F.lit(action_type).alias("action_type"),
            F.lit(detail).alias("action_typ_details"),
            F.lit(status).alias("status"),
        ),
    )


def status_log(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def append_status(statuses: DataFrame, path: str) -> None:
    statuses.select(*STATUS_COLUMNS).write.mode("append").parquet(path)


def schema_failures(files: DataFrame) -> DataFrame:
    """Eighteen values per file whose header does not match."""
    na = {f"detail_{i}": F.lit("NA") for i in range(1, 7)}
    return files.select(
        *["snap_dt", "run_id", "file_prefix_nm", "src_sys_nm", "file_nm"],
        F.lit("File").alias("object_type"),
        F.lit("NA").alias("object_nm"),
        F.lit("Schemavalidation").alias("check_nm"),
        F.lit("Fail").alias("status"),
        *[v.alias(k) for k, v in na.items()],
        F.lit("Schema Matching failed").alias("reason"),
        F.date_format(F.current_date(), "yyyy-MM-dd").alias("run_dt"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss").alias("time"),
    )


def disposition(
    missing: Column, empty: Column, schema_fail: Column, failed: Column, waiting: Column
) -> Column:
    """Where a file belongs; exactly one answer per file."""
    return (
        F.when(missing, "missing")
        .when(empty, "empty")
        .when(schema_fail | failed, "rejected")
        .when(waiting, "waiting")
        .otherwise("accepted")
    )
