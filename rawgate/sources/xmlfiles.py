"""XML rows as records, from files of any size.

A file is cut before each end tag of the row element. What a piece between two
cuts means depends on whether it starts in a comment or a CDATA section, so each
piece is a function of three states; those of a file are composed (`scan`). With
the states known, start and end tags that count are known too, and the depth of
row elements is a running sum over pieces and splits. All of that works on a few
numbers per piece; the text is dealt out once. No file is read by one task.

What is a record is fixed here, and is the same for every cut:

* An outermost row element, or one that closes itself outside of others. A row
  element inside of another belongs to it. End tags may have blanks.
* Tags in comments and CDATA sections are none.
* An end tag without a start is passed over.
* An element that is never closed, or has more than `max_chars` characters, has no
  end that could be trusted: it is a malformed record up to the next end tag, and
  the row elements behind it are records of their own, up to theirs.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rawgate.model import POSITION
from rawgate.session import many_files, stage
from rawgate.sources import scan
from rawgate.sources.csvfiles import BAD
from rawgate.sources.lines import PART_BITS, numbered

MAX_RECORD_CHARS = 64 * 1024 * 1024

OUT, COMMENT, CDATA = 0, 1, 2
_HIDDEN = r"<!--.*?(?:-->|\z)|<!\[CDATA\[.*?(?:\]\]>|\z)"
_MARKS = ("<!--", "-->", "<![CDATA[", "]]>")


def read_xml_records(
    spark: SparkSession,
    paths: str | list[str],
    row_tag: str,
    columns: Sequence[str],
    folders: bool = False,
) -> DataFrame:
    """The same by Spark's own reader, a task per file: one record per `row_tag` element, its child elements by name.

    The registered names are the schema, so nothing is inferred and no row of
    names has to be put in front of the data.
    """
    reader = (
        spark.read.schema(", ".join(f"`{c}` string" for c in columns) + ", _bad string")
        .option("rowTag", row_tag)
        .option("columnNameOfCorruptRecord", "_bad")
    )
    with many_files(spark):
        rows = reader.xml(paths)
    return numbered(
        rows,
        folders,
        F.lit("D").alias("ident"),
        F.lit(len(columns)).alias("n_fields"),
        F.col("_bad").isNotNull().alias("malformed"),
        F.array(*[F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in columns]).alias("cells"),
        F.col("_bad").alias("value"),
    )


class RowTags:
    """Patterns of the row element's tags in text without comments and CDATA sections."""

    def __init__(self, row_tag: str) -> None:
        tag = re.escape(row_tag)
        attributes = r"(?:\s(?:[^<>\"'/]++|/(?!>)|\"[^\"<]*+\"|'[^'<]*+')*+)?+"
        self.end = f"</{row_tag}"
        self.open, self.empty = f"<{tag}{attributes}>", f"<{tag}{attributes}/>"

    def opens(self, text: Column) -> Column:
        return F.regexp_count(text, F.lit(self.open))


def _escaped(text: Column) -> Column:
    for sign, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(sign), F.lit(name))
    return text


def _behind(text: Column, closer: str) -> Column:
    """What stands behind the first `closer`; null if there is none."""
    at = F.instr(text, closer)
    return F.when(at > 0, F.substring(text, at + len(closer), F.length(text)))


def _visible(text: Column) -> Column:
    """Text that starts outside, without comments, CDATA sections as escaped text."""
    tokens = F.regexp_extract_all(text, F.lit(rf"(?s){_HIDDEN}|[^<]++|<"), F.lit(0))

    def plain(token: Column) -> Column:
        inner = F.regexp_replace(F.substring(token, F.lit(10), F.length(token)), r"\]\]>\z", "")
        return F.when(token.startswith("<!--"), "").when(token.startswith("<![CDATA["), _escaped(inner)).otherwise(token)

    return F.when(text.contains("<!--") | text.contains("<![CDATA["), F.array_join(F.transform(tokens, plain), "")).otherwise(text)


def _state_after(text: Column) -> Column:
    """State at the end of text that starts outside."""
    last = F.try_element_at(F.regexp_extract_all(text, F.lit(f"(?s){_HIDDEN}"), F.lit(0)), F.lit(-1))
    comment = last.startswith("<!--") & ~(last.endswith("-->") & (F.length(last) >= 7))
    cdata = last.startswith("<![CDATA[") & ~last.endswith("]]>")
    return F.when(comment, COMMENT).when(cdata, CDATA).otherwise(OUT)


def _from_each_state(value: Column) -> tuple[Column, list[Column]]:
    """(function of states, visible text by the state that the piece starts in)."""
    after_comment, after_cdata = _behind(value, "-->"), _behind(value, "]]>")
    marked = value.contains(_MARKS[0])
    for mark in _MARKS[1:]:
        marked = marked | value.contains(mark)
    f = scan.code(
        [
            _state_after(value),
            F.when(after_comment.isNull(), COMMENT).otherwise(_state_after(after_comment)),
            F.when(after_cdata.isNull(), CDATA).otherwise(_state_after(after_cdata)),
        ]
    )
    data = F.when(after_cdata.isNull(), value).otherwise(F.substring(value, F.lit(1), F.instr(value, "]]>") - 1))
    texts = [
        _visible(value),
        F.coalesce(_visible(after_comment), F.lit("")),
        F.concat(_escaped(data), F.coalesce(_visible(after_cdata), F.lit(""))),
    ]
    return F.when(marked, f).otherwise(scan.IDENTITY), texts


def _pieces(spark: SparkSession, paths: Sequence[str], tags: RowTags, folders: bool) -> DataFrame:
    """Numbered pieces with their function, start tags by state, and whether they begin as what follows an end tag's name."""
    value = F.col("value")
    with many_files(spark):
        scan = spark.read.option("lineSep", tags.end).text(list(paths))
    pieces = numbered(scan, folders, "value")
    f, texts = _from_each_state(value)
    counted = pieces.withColumns({"f": f, "opens": F.array(*[tags.opens(t) for t in texts]), "ends": value.rlike(r"^\s*>")})
    return stage(counted, "pieces")


def _with_states(pieces: DataFrame) -> DataFrame:
    """Positions with `state`, `ends` (an end tag that counts) and `opens` (start tags that count), without the text."""
    first = F.row_number().over(Window.partitionBy("file_nm", "block").orderBy("line_id")) == 1
    at_start = F.col("block").bitwiseAND(F.lit((1 << PART_BITS) - 1)) == 0
    # there is no tag before the first piece of a file
    facts = pieces.select(*POSITION, "f", "opens", (F.col("ends") & ~(at_start & first)).alias("ends"))
    events = facts.filter(F.col("f") != scan.IDENTITY)
    if not events.take(1):
        known = facts.withColumn("state", F.lit(OUT))
    else:
        before = scan.functions_before(events)
        known = facts.join(before, POSITION, "left").withColumn("_after", scan.from_first(scan.then(F.col("before"), F.col("f"))))
        inside = Window.partitionBy("file_nm", "block").orderBy("line_id").rowsBetween(Window.unboundedPreceding, -1)
        known = stage(known.withColumn("_last", F.last("_after", ignorenulls=True).over(inside)), "states")
        blocks = known.groupBy("file_nm", "block").agg(F.max_by("_after", F.when(F.col("_after").isNotNull(), F.col("line_id"))).alias("_end"))
        earlier = Window.partitionBy("file_nm").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
        carried = stage(blocks.select("file_nm", "block", F.last("_end", ignorenulls=True).over(earlier).alias("_carry")), "carried")
        state = F.coalesce(scan.from_first(F.col("before")), F.col("_last"), F.col("_carry"), F.lit(OUT))
        known = known.join(carried, ["file_nm", "block"]).withColumn("state", state)
    counts = F.when((F.col("state") == OUT) & F.col("ends"), 1).otherwise(0)
    return known.select(*POSITION, "state", counts.alias("ends"), F.get("opens", F.col("state")).alias("opens"))


def _with_depth(facts: DataFrame) -> DataFrame:
    """Facts with `mid`, the depth behind the end tag before a piece, and `rec`, the position that its record starts at.

    The depth never falls below 0: it is the running sum less the least it has
    been so far, both carried over the splits of a file.
    """
    by = Window.partitionBy("file_nm", "block").orderBy("line_id")
    so_far = by.rowsBetween(Window.unboundedPreceding, 0)
    total = F.sum(F.col("opens") - F.col("ends")).over(so_far)
    summed = facts.withColumn("_sum", total).withColumn("_mid", F.col("_sum") - F.col("opens"))
    placed = stage(summed.withColumn("_least", F.min("_mid").over(so_far)), "depths")
    blocks = placed.groupBy("file_nm", "block").agg(F.sum(F.col("opens") - F.col("ends")).alias("_all"), F.min("_mid").alias("_low"))
    earlier = Window.partitionBy("file_nm").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offset = blocks.withColumn("_offset", F.coalesce(F.sum("_all").over(earlier), F.lit(0)))
    offset = offset.withColumn("_floor", F.coalesce(F.min(F.col("_low") + F.col("_offset")).over(earlier), F.lit(0)))
    known = placed.join(stage(offset.select("file_nm", "block", "_offset", "_floor"), "offsets"), ["file_nm", "block"])
    low = F.least(F.lit(0), F.col("_floor"), F.col("_least") + F.col("_offset"))
    known = known.withColumn("mid", F.col("_mid") + F.col("_offset") - low)
    starts = F.when((F.col("mid") == 0) & (F.col("opens") > 0), F.col("line_id"))
    known = stage(known.withColumn("_start", F.last(starts, ignorenulls=True).over(so_far)).select(*facts.columns, "mid", "_start"), "records-of")
    here = F.when(F.max("_start").isNotNull(), F.struct("block", F.max("_start").alias("line_id")))
    last = known.groupBy("file_nm", "block").agg(here.alias("_here"))
    carried = stage(last.select("file_nm", "block", F.last("_here", ignorenulls=True).over(earlier).alias("_carry")), "record-starts")
    own = F.when(F.col("_start").isNotNull(), F.struct("block", F.col("_start").alias("line_id")))
    return known.join(carried, ["file_nm", "block"]).withColumn("rec", F.coalesce(own, "_carry")).drop("_start", "_carry")


def xml_records(
    spark: SparkSession,
    paths: Sequence[str],
    row_tag: str,
    columns: Sequence[str],
    folders: bool = False,
    max_chars: int = MAX_RECORD_CHARS,
) -> DataFrame:
    """One record per row element, its child elements by name, all text, in the shape of `model.RECORD`."""
    tags = RowTags(row_tag)
    pieces = _pieces(spark, paths, tags, folders)
    facts = _with_depth(_with_states(pieces))
    sized = pieces.select(*POSITION, "value").join(facts, POSITION)
    text = F.element_at(F.array(*_from_each_state(F.col("value"))[1]), F.col("state") + 1)
    prefix = F.when(F.col("state") == OUT, tags.end).when(F.col("state") == CDATA, _escaped(F.lit(tags.end))).otherwise("")
    parts = stage(sized.withColumn("text", text).withColumn("prefix", prefix).drop("value"), "parts")

    # records of several pieces; the others are complete as they are
    middle = F.col("mid") > 0
    open_at_end = parts.groupBy("file_nm").agg(F.max_by(F.struct("rec", (F.col("mid") + F.col("opens") > 0).alias("open")), F.struct("block", "line_id")).alias("l"))
    unclosed = open_at_end.filter("l.open").select("file_nm", F.col("l.rec").alias("rec"), F.lit(True).alias("unclosed"))
    sizes = parts.filter(middle & F.col("rec").isNotNull()).groupBy("file_nm", "rec").agg(F.sum(F.length("text")).alias("n"))
    several = sizes.join(unclosed, ["file_nm", "rec"], "full")
    several = several.select("file_nm", "rec", (F.coalesce("unclosed", F.lit(False)) | (F.coalesce("n", F.lit(0)) > max_chars)).alias("untrusted"))
    told = parts.join(stage(several, "several"), ["file_nm", "rec"], "left")
    untrusted, long = F.coalesce("untrusted", F.lit(False)), F.col("untrusted").isNotNull()
    main = F.regexp_extract("text", f"(?s){tags.open}.*", 0)
    told = told.withColumns({"untrusted": untrusted, "long": long, "main": main})
    starts = ~middle & (F.col("opens") > 0)

    grouped = told.filter(F.col("long") & ~F.col("untrusted") & (starts | middle))
    piece = F.when(starts, F.col("main")).otherwise(F.concat("prefix", "text"))
    joined = (
        grouped.groupBy("file_nm", "rec")
        .agg(F.array_sort(F.collect_list(F.struct("block", "line_id", piece.alias("x")))).alias("l"))
        .select("file_nm", "rec.block", "rec.line_id", F.array_join("l.x", "").alias("x"), F.lit(False).alias("bad"))
    )
    alone = told.filter(~(F.col("long") & ~F.col("untrusted")) & (F.col("opens") > 0)).select(
        *POSITION, F.col("main").alias("x"), (F.col("untrusted") & starts).alias("bad")
    )
    closed = joined.unionByName(alone).withColumn("x", F.concat("x", F.lit(f"{tags.end}>")))
    # elements that close themselves, outside of others
    outside = told.filter(~middle | F.col("untrusted"))
    before = F.substring("text", F.lit(1), F.length("text") - F.length("main"))
    empty = outside.select(*POSITION, F.explode(F.regexp_extract_all(before, F.lit(tags.empty), F.lit(0))).alias("x"), F.lit(False).alias("bad"))
    schema = ", ".join(f"`{c}` string" for c in columns) + f", {BAD} string"
    options = {"rowTag": row_tag, "columnNameOfCorruptRecord": BAD}
    parsed = closed.unionByName(empty).withColumn("p", F.from_xml("x", schema, options))
    malformed = F.col("bad") | F.col(f"p.{BAD}").isNotNull()
    return parsed.select(
        *POSITION,
        F.lit("D").alias("ident"),
        F.lit(len(columns)).alias("n_fields"),
        malformed.alias("malformed"),
        F.array(*[F.coalesce(F.col(f"p.`{c}`"), F.lit("")) for c in columns]).alias("cells"),
        F.when(malformed, F.col("x")).alias("value"),
    )
