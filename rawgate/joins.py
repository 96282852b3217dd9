"""Joining all rows with small per-file facts without betting on their size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_LIMIT = 64 * 1024 * 1024
SALTS = 64


def measured_bytes(df: DataFrame) -> int:
    """Size of the rows as JSON text, counted by Spark (one small aggregate)."""
    size = df.agg(F.sum(F.octet_length(F.to_json(F.struct(*df.columns)))).alias("b")).collect()[0]["b"]
    return int(size or 0)


def fits_broadcast(facts: DataFrame, limit: int = BROADCAST_LIMIT) -> bool:
    return measured_bytes(facts) <= limit


def join_per_file(
    rows: DataFrame, facts: DataFrame, small: bool | None = None, how: str = "inner", salts: int = SALTS
) -> DataFrame:
    """Join `rows` with one-row-per-file `facts` on `file_nm`.

    `facts` is measured (or `small` says what a measurement of a wider table
    gave). Small facts are broadcast and the rows are not shuffled. Otherwise
    the join key is salted: the rows of one file are spread over `salts` keys
    and each fact row is repeated for every salt, so that a file which holds a
    third of all rows does not end in one task.
    """
    if fits_broadcast(facts) if small is None else small:
        return rows.join(F.broadcast(facts), "file_nm", how)
    spread = rows.withColumn("_salt", F.pmod(F.xxhash64("block", "line_id"), F.lit(salts)).cast("int"))
    repeated = facts.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return spread.join(repeated, ["file_nm", "_salt"], how).drop("_salt")
