"""Multi-line CSV files of any size, read by many tasks.

A file is cut at line ends. Whether a line ends inside quotes depends on whether
it starts inside them, so each line is a function from one of two states to
another. The functions of a split compose to one, those of the splits of a file
to the state that each split starts in (one small row per split). No text has to
be read twice, and no file is read by one task, whatever its size or quoting.

What the quotes mean is fixed here, and is the same for every cut:

* A quote opens a cell only at the start of the cell; elsewhere in a cell without
  quotes it is a character. Inside quotes the escape character takes the next
  character as it is; a doubled quote is one where the quote is its own escape.
* Line breaks inside quotes belong to the cell (`\\r\\n` as `\\n`); outside, a record
  ends at `\\n`, with or without `\\r`. A lone `\\r` is a character. Lines without
  any text are no records.
* A record with text between a closing quote and the next delimiter is malformed
  and ends where it would otherwise; reading goes on behind it.
* A quote that is never closed, or a record of more than `max_chars` characters,
  has no end that could be trusted. The line that opens it is a malformed
  record; the lines behind it are records of their own, up to where the record
  would have ended (malformed, where such a line ends inside quotes).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

from rawgate.functions.ragged import java_quote
from rawgate.session import many_files, stage
from rawgate.sources.csvfiles import BAD, string_schema
from rawgate.sources.lines import numbered

#: a longer record is taken for the effect of a quote that should not be there
MAX_RECORD_CHARS = 64 * 1024 * 1024


class Quoting:
    """Patterns of lines and records for a delimiter, a quote and an escape character."""

    def __init__(self, sep: str, quote: str, escape: str) -> None:
        d, q, e = java_quote(sep), java_quote(quote), java_quote(escape)
        inner = f"[^{q}]*+(?:{q}{q}[^{q}]*+)*+" if escape == quote else f"[^{q}{e}]*+(?:{e}.[^{q}{e}]*+)*+"
        rest = f"(?:(?!{d}).)*+"
        cell = f"(?:{q}{inner}{q}{rest}|(?!{q}){rest})"
        proper = f"(?:{q}{inner}{q}(?={d}|\\z)|(?!{q}){rest})"
        self.quote = quote
        self.from_outside = f"(?s)^{cell}(?:{d}{cell})*+\\z"
        self.from_inside = f"(?s)^{inner}{q}{rest}(?:{d}{cell})*+\\z"
        self.whole = f"(?s)^{proper}(?:{d}{proper})*+\\z"

    def _has_quote(self, text: Column) -> Column:
        return F.instr(text, self.quote) > 0

    def opens(self, line: Column) -> Column:
        """Whether a line that starts outside of quotes ends inside."""
        return self._has_quote(line) & ~line.rlike(self.from_outside)

    def stays(self, line: Column) -> Column:
        """Whether a line that starts inside quotes ends inside."""
        return ~(self._has_quote(line) & line.rlike(self.from_inside))

    def proper(self, record: Column) -> Column:
        """Whether every cell that starts with a quote ends with one."""
        return ~self._has_quote(record) | record.rlike(self.whole)


def starts_inside(rows: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Rows with `in_0` and `in_1`: whether each starts inside quotes if the first of its `keys` starts outside, or inside.

    `opens` and `stays` say where a row ends. A row is constant (both equal), the
    identity, or swaps the states: the state is that of the last constant row
    before, turned once for each swap since.
    """
    by = Window.partitionBy(*keys).orderBy(order)
    swap = (F.col("opens") & ~F.col("stays")).cast("int")
    counted = rows.withColumn("_n", F.sum(swap).over(by.rowsBetween(Window.unboundedPreceding, 0)))
    reset = F.when(F.col("opens") == F.col("stays"), F.struct(F.col("opens").alias("to"), "_n"))
    known = counted.withColumn("_r", F.last(reset, ignorenulls=True).over(by.rowsBetween(Window.unboundedPreceding, -1)))
    before = F.col("_n") - swap
    turned = (before - F.coalesce("_r._n", F.lit(0))) % 2 == 1

    def given(first: bool) -> Column:
        return F.coalesce("_r.to", F.lit(first)) != turned

    return known.withColumns({"in_0": given(False), "in_1": given(True)}).drop("_n", "_r")


def _ends(state: str) -> Column:
    return F.when(F.col(state), F.col("stays")).otherwise(F.col("opens"))


def _up_to_here(keys: Sequence[str], order: str) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)


def placed_lines(spark: SparkSession, paths: Sequence[str], quoting: Quoting, folders: bool) -> DataFrame:
    """file_nm, block, line_id, value, starts, ends (inside quotes) and `rec`, the position of the line that its record starts at."""
    value = F.col("value")
    with many_files(spark):
        scan = spark.read.option("lineSep", "\n").text(list(paths))
    lines = numbered(scan, folders, "value")
    lines = lines.withColumns({"opens": quoting.opens(value), "stays": quoting.stays(value)})
    inside = starts_inside(lines, ["file_nm", "block"], "line_id")
    so_far = _up_to_here(["file_nm", "block"], "line_id")
    # for both states that the split may start in, so that the text is dealt out once
    rec = {f"rec_{i}": F.last(F.when(~F.col(f"in_{i}"), F.col("line_id")), ignorenulls=True).over(so_far) for i in (0, 1)}
    placed = stage(inside.withColumns({"end_0": _ends("in_0"), "end_1": _ends("in_1"), **rec}).drop("opens", "stays"), "lines")

    last = {f"end_{i}": F.max_by(f"end_{i}", "line_id").alias(name) for i, name in enumerate(("opens", "stays"))}
    blocks = placed.groupBy("file_nm", "block").agg(*last.values(), F.max("rec_0").alias("rec_0"), F.max("rec_1").alias("rec_1"))
    known = starts_inside(blocks, ["file_nm"], "block")  # a file starts outside
    here = F.when(F.col("in_0"), F.col("rec_1")).otherwise(F.col("rec_0"))
    here = F.when(here.isNotNull(), F.struct("block", here.alias("line_id")))
    earlier = Window.partitionBy("file_nm").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = known.select("file_nm", "block", F.col("in_0").alias("inside"), F.last(here, ignorenulls=True).over(earlier).alias("carry"))
    joined = placed.join(stage(splits, "splits"), ["file_nm", "block"])

    def chosen(name: str) -> Column:
        return F.when(F.col("inside"), F.col(f"{name}_1")).otherwise(F.col(f"{name}_0"))

    own = F.when(chosen("rec").isNotNull(), F.struct("block", chosen("rec").alias("line_id")))
    return joined.select("file_nm", "block", "line_id", "value", (~chosen("in")).alias("starts"), chosen("end").alias("ends"), F.coalesce(own, "carry").alias("rec"))


def record_texts(lines: DataFrame, quoting: Quoting, max_chars: int = MAX_RECORD_CHARS) -> DataFrame:
    """file_nm, block, line_id, value (the whole text of a record), untrusted: lines put together to records."""
    # a record on one line is complete; only the others are brought together
    whole = F.col("starts") & ~F.col("ends")
    rest = lines.filter(~whole)
    sizes = rest.groupBy("file_nm", "rec").agg(
        F.sum(F.length("value") + 1).alias("n"), F.max_by("ends", F.struct("block", "line_id")).alias("unclosed")
    )
    untrusted = stage(sizes.filter((F.col("n") > max_chars) | F.col("unclosed")).select("file_nm", "rec", F.lit(True).alias("untrusted")), "untrusted")
    told = rest.join(untrusted, ["file_nm", "rec"], "left")
    alone = told.filter("untrusted").select("file_nm", "block", "line_id", "value", (F.col("starts") | quoting.opens(F.col("value"))).alias("untrusted"))
    several = (
        told.filter("untrusted IS NULL")
        .groupBy("file_nm", "rec")
        .agg(F.array_sort(F.collect_list(F.struct("block", "line_id", "value"))).alias("l"))
        .select("file_nm", "rec.block", "rec.line_id", F.array_join("l.value", "\n").alias("value"), F.lit(False).alias("untrusted"))
    )
    single = lines.filter(whole).select("file_nm", "block", "line_id", "value", F.lit(False).alias("untrusted"))
    text = F.replace(F.col("value"), F.lit("\r\n"), F.lit("\n"))
    text = F.when(F.endswith("value", F.lit("\r")), F.substring(text, F.lit(1), F.length(text) - 1)).otherwise(text)
    # of the raw value, as a filter on the new one would make every text once more
    some = ~F.col("value").isin("", "\r")
    return single.unionByName(several).unionByName(alone).filter(some).withColumn("value", text)


def multiline_records(
    spark: SparkSession,
    paths: Sequence[str],
    width: int,
    sep: str,
    escape: str = '"',
    quote: str = '"',
    folders: bool = False,
    max_chars: int = MAX_RECORD_CHARS,
) -> DataFrame:
    """Records of `width` string cells, in the shape of `model.RECORD`; a malformed one keeps its text in `value`."""
    quoting = Quoting(sep, quote, escape)
    texts = record_texts(placed_lines(spark, paths, quoting, folders), quoting, max_chars)
    options = {"sep": sep, "quote": quote, "escape": escape, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD}
    parsed = texts.withColumn("p", F.from_csv("value", f"{string_schema(width)}, {BAD} string", options))
    cells = [f"p.col_{i}" for i in range(width)]
    malformed = F.col("untrusted") | ~quoting.proper(F.col("value")) | F.col(f"p.{BAD}").isNotNull()
    return parsed.select(
        "file_nm",
        "block",
        "line_id",
        F.col(cells[0]).alias("ident"),
        F.lit(width).alias("n_fields"),
        malformed.alias("malformed"),
        F.array(*cells).alias("cells"),
        F.when(malformed, F.col("value")).alias("value"),
    )
