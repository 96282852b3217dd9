"""Typed columns from text, with a flag for text that does not convert."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_SIMPLE = {"string", "int", "bigint", "double", "date", "timestamp", "boolean"}
_DECIMAL = re.compile(r"decimal\(\d+,\s*\d+\)")


def check_type(name: str) -> str:
    """The type name in lower case; an unknown one is an error in the control table."""
    lowered = (name or "string").strip().lower()
    if lowered not in _SIMPLE and not _DECIMAL.fullmatch(lowered):
        raise ValueError(f"unknown data type {name!r}")
    return lowered


def cast_text(cell: Column, type_name: str) -> Column:
    """Blank becomes null for all types but string; text that does not convert becomes null."""
    wanted = check_type(type_name)
    if wanted == "string":
        return cell
    return F.nullif(F.trim(cell), F.lit("")).try_cast(wanted)


def cast_failed(cell: Column, type_name: str) -> Column:
    """True when there was text and nothing came of it."""
    if check_type(type_name) == "string":
        return F.lit(False)
    return F.coalesce(F.trim(cell) != "", F.lit(False)) & cast_text(cell, type_name).isNull()
