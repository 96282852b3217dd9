"""Cell cleaners."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def clean_cell(cell: Column, keep_quotes: Column | bool = False) -> Column:
    """Null to blank, U+FFFD to a double quote, then outer double quotes and
    outer single quotes off unless the configuration keeps them."""
    given = F.coalesce(cell, F.lit(""))
    text = F.when(F.instr(given, "�") > 0, F.replace(given, F.lit("�"), F.lit('"'))).otherwise(given)
    # trimming walks the whole text: only texts with a quote at an end are trimmed
    quoted = text.startswith('"') | text.endswith('"') | text.startswith("'") | text.endswith("'")
    bare = F.when(quoted, F.btrim(F.btrim(text, F.lit('"')), F.lit("'"))).otherwise(text)
    keep = keep_quotes if isinstance(keep_quotes, Column) else F.lit(keep_quotes)
    return F.when(keep, text).otherwise(bare)


def remove_chars(cell: Column, patterns: Sequence[str]) -> Column:
    """Every configured character or regular expression, removed in one pass."""
    return F.regexp_replace(cell, "|".join(patterns), "") if patterns else cell


def unquote_pair(cell: Column) -> Column:
    """One pair of enclosing double quotes off; null stays null. A text of a
    single quote character loses it, as it both starts and ends with one."""
    quoted = cell.startswith('"') & cell.endswith('"')
    return F.when(quoted, cell.substr(F.lit(2), F.greatest(F.length(cell) - 2, F.lit(0)))).otherwise(cell)


def blank_to_null(cell: Column) -> Column:
    return F.nullif(cell, F.lit(""))


def drop_by_index(df: DataFrame, one_based: Sequence[int]) -> DataFrame:
    """The columns that are left when the given ordinals (from 1) are dropped."""
    dropped = set(one_based)
    return df.select(*[F.col(f"`{c}`") for i, c in enumerate(df.columns, 1) if i not in dropped])


def fill_blank(df: DataFrame) -> DataFrame:
    return df.na.fill("")


def drop_all_null(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop("all", subset=list(subset) if subset else None)
