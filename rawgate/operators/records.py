"""Header, trailer and data records of a file.

Every step that counts or looks for an edge of a file aggregates per split
(file_nm, block) first and then per file, so that what is shuffled is one row
per split, however many rows one file holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rawgate.model import POSITION
from rawgate.session import stage

MARKS = {"H": ("H", "h"), "D": ("D", "d"), "T": ("T", "t")}


def record_type() -> Column:
    """H, D or T from the identifier, any case; `?` for everything else."""
    upper = F.upper("ident")
    return F.when(upper.isin("H", "D", "T"), upper).otherwise("?")


def marked(kind: str) -> Column:
    """Rows of one kind; plain values, so that the filter reaches the scan."""
    return F.col("ident").isin(*MARKS[kind])


def identifier_split(lines: DataFrame) -> DataFrame:
    """First character and the rest of each line."""
    return lines.withColumns(
        {"identifier": F.substring("value", 1, 1), "data": F.expr("substring(value, 2)")}
    )


def file_counts(records: DataFrame) -> DataFrame:
    """Per file: lines, H, D, T rows, rows that are neither H nor T, first and last position."""
    kind = record_type()
    per_block = records.groupBy("file_nm", "block").agg(
        F.count("*").alias("n_lines"),
        F.count_if(kind == "H").alias("n_head"),
        F.count_if(kind == "D").alias("n_ind"),
        F.count_if(kind == "T").alias("n_trail"),
        F.min("line_id").alias("first_id"),
        F.max("line_id").alias("last_id"),
    )
    per_file = per_block.groupBy("file_nm").agg(
        *[F.sum(c).alias(c) for c in ("n_lines", "n_head", "n_ind", "n_trail")],
        F.min(F.struct("block", F.col("first_id").alias("line_id"))).alias("first_pos"),
        F.max(F.struct("block", F.col("last_id").alias("line_id"))).alias("last_pos"),
    )
    return per_file.withColumn("n_data", F.col("n_lines") - F.col("n_head") - F.col("n_trail"))


def head_positions(records: DataFrame, k: int) -> DataFrame:
    """Positions of the first `k` records of each file, with their rank `nth`.

    One record is a minimum per split and file. For more the rank filter is
    pushed below the shuffle by Spark (window group limit): each task passes
    on at most `k` positions per file.
    """
    if k == 1:
        per_block = records.groupBy("file_nm", "block").agg(F.min("line_id").alias("line_id"))
        first = per_block.groupBy("file_nm").agg(F.min(F.struct("block", "line_id")).alias("p"))
        return first.select("file_nm", "p.block", "p.line_id", F.lit(1).alias("nth"))
    order = Window.partitionBy("file_nm").orderBy("block", "line_id")
    ranked = records.select(*POSITION).withColumn("nth", F.row_number().over(order))
    return ranked.filter(F.col("nth") <= k)


def tail_positions(records: DataFrame) -> DataFrame:
    """Position of the last record of each file."""
    per_block = records.groupBy("file_nm", "block").agg(F.max("line_id").alias("line_id"))
    last = per_block.groupBy("file_nm").agg(F.max(F.struct("block", "line_id")).alias("p"))
    return last.select("file_nm", "p.block", "p.line_id")


def at_positions(records: DataFrame, positions: DataFrame, how: str = "inner") -> DataFrame:
    """Records at the given positions (or, with `left_anti`, all others).

    The few positions are written out first. Spark then knows their size when
    it plans the join, and broadcasts them only if they are small; the join
    key is unique, so that without a broadcast no key is hot.
    """
    return records.join(stage(positions, "positions"), POSITION, how)


def first_records(records: DataFrame) -> DataFrame:
    return take_headers(records, 1).drop("nth")


def last_records(records: DataFrame) -> DataFrame:
    return at_positions(records, tail_positions(records))


def take_headers(records: DataFrame, k: int) -> DataFrame:
    """The first `k` records of each file with their rank."""
    if k not in (0, 1, 2):
        raise ValueError(f"unsupported number of header lines: {k}")
    return at_positions(records, head_positions(records, k))


def drop_edges(records: DataFrame, n_head: int, n_tail: int, by_value: bool = False) -> DataFrame:
    """Records without the first `n_head` and the last `n_tail` of each file.

    The edges are found by position, so a data record that happens to be equal
    to one is kept; `by_value` takes equal records out as well.
    """
    if n_head not in (0, 1, 2) or n_tail not in (0, 1):
        raise ValueError(f"unsupported format: {n_head} header and {n_tail} trailer lines")
    edges = None
    if n_head:
        edges = head_positions(records, n_head).select(*POSITION)
    if n_tail:
        tails = tail_positions(records)
        edges = tails if edges is None else edges.unionByName(tails)
    if edges is None:
        return records
    if not by_value:
        return at_positions(records, edges, "left_anti")
    values = at_positions(records, edges, "left_semi").select("file_nm", "cells").dropDuplicates()
    return records.join(stage(values, "edges"), ["file_nm", "cells"], "left_anti")


def header_rows(records: DataFrame, k: int = 2) -> DataFrame:
    """The first `k` H rows of each file with their rank."""
    order = Window.partitionBy("file_nm").orderBy("block", "line_id")
    heads = records.filter(marked("H"))
    return heads.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= k)


def trailer_rows(records: DataFrame) -> DataFrame:
    return records.filter(marked("T"))


def last_trailer(records: DataFrame) -> DataFrame:
    """(file_nm, trailer): cells of the last T row of each file."""
    return trailer_rows(records).groupBy("file_nm").agg(
        F.max_by("cells", F.struct("block", "line_id")).alias("trailer")
    )


def is_data(indicator: Column | None = None) -> Column:
    """Rows that are neither header nor trailer; where there is an `indicator`, rows marked D."""
    neither = ~record_type().isin("H", "T")
    return neither if indicator is None else neither & (~indicator | marked("D"))


def data_rows(records: DataFrame) -> DataFrame:
    return records.filter(is_data())


def indicator_rows(records: DataFrame) -> DataFrame:
    """Rows marked D, without the mark."""
    return (
        records.filter(is_data(F.lit(True)))
        .withColumn("cells", F.slice("cells", 2, F.greatest(F.size("cells") - 1, F.lit(0))))
        .withColumn("n_fields", F.col("n_fields") - 1)
    )


def restore_line(lines: DataFrame, no_indicator: Column) -> DataFrame:
    """`data` as the whole line where there is no indicator, else without it."""
    return lines.withColumn(
        "data", F.when(no_indicator, F.col("value")).otherwise(F.expr("substring(value, 2)"))
    )


def sample_rows(records: DataFrame, n: int = 10) -> DataFrame:
    """The first `n` records of each file, for a look at its contents."""
    return at_positions(records, head_positions(records, n))


def classify_layout(files: DataFrame, fixed_width: bool = False, compat: bool = False) -> DataFrame:
    """Layout of each file.

    Takes one row per file with n_lines, n_head, n_ind, col_header_flag,
    no_ident (the format says that lines have no identifier), fmt_head and
    fmt_tail (header and trailer lines of that format). Adds

    layout          name of the case
    lead            rows start with an indicator that is not data
    header_from     none, head_1, head_2 (H rows), line_1, line_2 (any rows)
    header_checked  the header must match the registered columns
    keep_all        rows are not filtered by identifier
    """
    flag_y = F.col("col_header_flag") == "Y"
    has_ind = F.col("n_ind") > 0
    heads = F.col("n_head")
    # without identifiers a D in some rows is data; an indicator is in all of them
    all_ind = has_ind & (F.col("n_ind") >= F.col("n_lines") - F.col("fmt_head") - F.col("fmt_tail"))
    no_head_lead = F.lit(True) if compat and not fixed_width else has_ind
    supported = F.col("fmt_head").between(0, 2) & F.col("fmt_tail").between(0, 1)
    plain = F.col("no_ident") & supported
    # (name, condition, lead, header_from, checked, keep_all)
    manual = (
        ("manual", heads == 0, has_ind, "none", False, False)
        if fixed_width
        else ("manual", heads == 0, F.lit(False), "line_1", True, True)
    )
    cases = [
        ("no_ident_0", plain & (F.col("fmt_head") == 0), all_ind, "none", None, True),
        ("no_ident_1", plain & (F.col("fmt_head") == 1) & flag_y, all_ind, "line_1", True, True),
        ("no_ident_1_plain", plain & (F.col("fmt_head") == 1), all_ind, "none", False, True),
        ("no_ident_2", plain & (F.col("fmt_head") == 2), all_ind, "line_2", True, True),
        ("unsupported", F.col("no_ident"), F.lit(False), "none", False, True),
        ("one_head_no_ind", (heads == 1) & ~flag_y & ~has_ind, F.lit(False), "none", False, False),
        ("one_head_ind", (heads == 1) & ~flag_y, F.lit(True), "none", False, False),
        ("no_head", (heads == 0) & ~flag_y, no_head_lead, "none", False, False),
        ("column_head", heads == 1, F.lit(True), "head_1", True, False),
        ("two_heads", heads > 1, F.lit(True), "head_2", True, False),
        manual,
    ]

    def choose(index: int) -> Column:
        out = None
        for case in cases:
            value = case[index]
            if value is None:
                # a delimited format without header lines fails when a header is expected
                value = F.lit(False) if fixed_width else flag_y
            value = value if isinstance(value, Column) else F.lit(value)
            out = F.when(case[1], value) if out is None else out.when(case[1], value)
        return out

    return files.withColumns(
        {
            "layout": choose(0),
            "lead": choose(2),
            "header_from": choose(3),
            "header_checked": choose(4),
            "keep_all": choose(5),
        }
    )


def with_counts(manifest: DataFrame, counts: DataFrame) -> DataFrame:
    """Manifest rows with the counts of their file, zero where it has no rows."""
    numbers = ["n_lines", "n_head", "n_ind", "n_trail", "n_data"]
    return manifest.join(counts, "file_nm", "left").na.fill(0, numbers)


def empty_files(files: DataFrame, edge_lines: Column | None = None) -> DataFrame:
    """Files with no data row left once header and trailer are taken off.

    Starts from the manifest (see `with_counts`), as a file without rows does
    not show in any scan. `edge_lines` is the number of header and trailer
    lines that carry no identifier.
    """
    left = F.col("n_data") - (edge_lines if edge_lines is not None else F.lit(0))
    return files.filter(left <= 0)
