"""Header normalisation, fixed-width slicing and the schema match."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalise_name(name: Column, pairs: Iterable[tuple[str, str]] = ()) -> Column:
    """Ordered replacements, upper case, runs of `_` to one, one trailing `_` off."""
    for old, new in pairs:
        name = F.replace(name, F.lit(old), F.lit(new))
    return F.regexp_replace(F.regexp_replace(F.upper(name), "_+", "_"), "_$", "")


def normalise_header(names: Column, pairs: Iterable[tuple[str, str]] = ()) -> Column:
    pairs = list(pairs)
    return F.transform(names, lambda n: normalise_name(n, pairs))


def slice_text(text: Column, lengths: Sequence[int]) -> Column:
    """array<string> of consecutive pieces of `text`."""
    starts = [1 + sum(lengths[:i]) for i in range(len(lengths))]
    return F.array(*[F.substring(text, start, n) for start, n in zip(starts, lengths, strict=True)])


def schema_match(header: Column, expected: Column) -> Column:
    """`equal`; `extra` when the expected names are left, in order, once the
    others are taken out of the header; else `fail`."""
    kept = F.filter(header, lambda h: F.array_contains(expected, h))
    return F.when(header == expected, "equal").when(kept == expected, "extra").otherwise("fail")


def pick_positions(header: Column, expected: Column) -> Column:
    """1-based place in the header of each expected name."""
    return F.transform(expected, lambda e: F.array_position(header, e).cast("int"))
