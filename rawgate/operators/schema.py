"""Projection of records to the registered columns."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rawgate.functions.headers import normalise_name


def project_expected(
    records: DataFrame, names: Sequence[str], keep: Sequence[str], place: Column | None = None
) -> DataFrame:
    """The first cells by position under the registered names, the rest cut off.

    With `place` (1-based place of each name in the row) cells are taken by
    header name, so that an additional column in the middle of a file does not
    shift the values after it.
    """

    def cell(i: int) -> Column:
        return F.get("cells", F.lit(i) if place is None else F.get(place, F.lit(i)) - 1)

    return records.select(*keep, *[cell(i).alias(n) for i, n in enumerate(names)])


def rename_cols(df: DataFrame, pairs: Iterable[tuple[str, str]]) -> DataFrame:
    """Ordered replacements in all column names, in one projection."""
    names = list(df.columns)
    for old, new in pairs:
        names = [n.replace(old, new) for n in names]
    return df.toDF(*names)


def rename_to_target(df: DataFrame, target_columns: Sequence[str]) -> DataFrame:
    """Positional rename to the names of the target table."""
    extra = list(df.columns)[len(target_columns) :]
    return df.toDF(*[*target_columns[: len(df.columns)], *extra])


def fixed_width_columns(df: DataFrame, text: Column, names: Sequence[str], lengths: Sequence[int], keep: Sequence[str]) -> DataFrame:
    """Fields cut out of a line by the registered lengths."""
    starts = [1 + sum(lengths[:i]) for i in range(len(lengths))]
    parts = zip(names, starts, lengths, strict=True)
    return df.select(*keep, *[F.substring(text, start, n).alias(name) for name, start, n in parts])


def normalised_names(df: DataFrame, column: str, pairs: Iterable[tuple[str, str]]) -> DataFrame:
    return df.withColumn(column, normalise_name(F.col(column), pairs))
