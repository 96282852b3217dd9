"""Splitting one delimited line into an array of fields of any length."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# a quoted field; possessive, so that a very long cell needs no stack
_QUOTED = '"[^"]*+(?:""[^"]*+)*+"'


def java_quote(text: str) -> str:
    return "".join(f"\\x{{{ord(ch):x}}}" if not ch.isalnum() else ch for ch in text)


def _split_pattern(sep: str) -> str:
    """Pattern for a plain split: one character, escaped with a backslash only
    where it means something, is split without a regular expression."""
    if len(sep) > 1:
        return java_quote(sep)
    return f"\\{sep}" if sep in ".$|()[{^?*+\\" else sep


def split_cells(value: Column, sep: str) -> Column:
    """struct(cells array<string>, malformed boolean) for one line.

    Lines without a quote are split directly. Others go through a regular
    expression: a field is either fully quoted (closing quote followed by the
    delimiter or the end) or runs up to the next delimiter. A field of the
    second kind that starts with a quote is unbalanced, or has text after its
    closing quote: the line is `malformed`.
    """
    delim = java_quote(sep)
    other = f"[^{delim}]*+" if len(sep) == 1 else f"(?:(?!{delim}).)*+"
    quoted = f"{_QUOTED}(?={delim}|$)"
    has_quote = F.instr(value, '"') > 0
    raw = F.regexp_extract_all(F.concat(F.lit(sep), value), F.lit(f"(?s){delim}({quoted}|{other})"), F.lit(1))

    def unquote(field: Column) -> Column:
        inner = F.replace(field.substr(F.lit(2), F.length(field) - 2), F.lit('""'), F.lit('"'))
        enclosed = field.startswith('"') & field.endswith('"') & (F.length(field) > 1)
        return F.when(enclosed, inner).otherwise(field)

    proper = f"(?s)^(?:{quoted}|(?!\"){other})(?:{delim}(?:{quoted}|(?!\"){other}))*+$"
    cells = F.when(has_quote, F.transform(raw, unquote)).otherwise(F.split(value, _split_pattern(sep), -1))
    return F.struct(cells.alias("cells"), (has_quote & ~value.rlike(proper)).alias("malformed"))
