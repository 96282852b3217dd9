"""Line readers: plain, gzip and fixed-width text with file name and position."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rawgate.functions.ragged import split_cells
from rawgate.session import many_files

GZIP_BYTES_PER_PARTITION = 20 * 1024 * 1024
PLAIN_BYTES_PER_PARTITION = 200 * 1024 * 1024


def strip_nul(text: Column) -> Column:
    return F.replace(text, F.lit("\x00"), F.lit(""))


def source_name(folders: bool = False) -> Column:
    """Name of the file a row comes from. With `folders`, a file was landed as
    a folder of parts and the folder's name counts (after `=`, if it has one).

    Spark gives names as they stand in a URI: other characters are coded by %.
    """
    name = F.col("_metadata.file_name")
    if folders:
        folder = F.substring_index(F.substring_index("_metadata.file_path", "/", -2), "/", 1)
        name = F.substring(folder, F.instr(folder, "=") + 1, F.length(folder))
    # a plus sign is itself in a URI
    decoded = F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))
    return F.when(F.instr(name, "%") > 0, decoded).otherwise(name)


def literal_path(path: str) -> str:
    """A path that Spark takes as it is, whatever glob characters its name has."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


#: bytes of a part that its place in the folder is counted above
PART_BITS = 44


def numbered(scan: DataFrame, folders: bool, *columns: Column | str) -> DataFrame:
    """file_nm, block, line_id and `columns` of a file scan.

    `block` orders the splits of a file. It is the split's byte offset; where
    files were landed as folders of parts, the part's place by name comes
    first, as offsets begin anew in every part and Spark deals splits by size.
    Places come from the names that the scan has listed; folders of one part,
    the usual case, need no lookup.
    """
    rows = scan.select(
        source_name(folders).alias("file_nm"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line_id"),
        *columns,
        *([F.col("_metadata.file_path").alias("_path")] if folders else []),
    )
    if not folders:
        return rows
    by_folder: dict[str, list[str]] = {}
    for path in sorted(scan.inputFiles()):
        by_folder.setdefault(path.rsplit("/", 1)[0], []).append(path)
    later = [(path, place) for paths in by_folder.values() for place, path in enumerate(paths) if place]
    if not later:
        return rows.drop("_path")

    def plain(c: Column) -> Column:
        return F.regexp_replace(c, "^([a-z0-9]+):/+", "$1:/")

    places = scan.sparkSession.createDataFrame(later, "_part string, _place bigint").withColumn("_part", plain(F.col("_part")))
    placed = rows.join(F.broadcast(places) if len(later) <= 100_000 else places, plain(F.col("_path")) == F.col("_part"), "left")
    first = F.shiftleft(F.coalesce("_place", F.lit(0).cast("bigint")), PART_BITS)
    return placed.withColumn("block", first + F.col("block")).drop("_path", "_part", "_place")


def read_lines(spark: SparkSession, paths: str | list[str], folders: bool = False) -> DataFrame:
    """One row per line: file_nm, block, line_id, value.

    (block, line_id) orders the lines of one file: a split is read by one task
    from front to back, and `block` orders the splits (`numbered`). The ids belong
    to one scan; `session.stage` the result before joining positions found in
    one step with the rows of another.
    """
    with many_files(spark):
        scan = spark.read.text(paths)
    return numbered(scan, folders, F.make_valid_utf8(strip_nul(F.col("value"))).alias("value"))


def read_gzip_lines(
    spark: SparkSession, paths: str | list[str], compressed_bytes: int, folders: bool = False
) -> DataFrame:
    """Gzip lines: one task per file unpacks (gzip cannot be split), then the
    numbered lines are spread so that parsing runs on all cores."""
    partitions = compressed_bytes // GZIP_BYTES_PER_PARTITION + 1
    return read_lines(spark, paths, folders).repartition(partitions)


def delimited_records(lines: DataFrame, sep: str) -> DataFrame:
    """Split each non-blank line into its fields, however many there are.

    `value` keeps the line only where it has a quote: elsewhere it is the
    cells joined by the delimiter (see `original_line`), and storing both
    would double the staged data.
    """
    raw = lines.filter(F.length("value") > 0).withColumn("_parsed", split_cells(F.col("value"), sep))
    return raw.select(
        "file_nm",
        "block",
        "line_id",
        F.get(F.col("_parsed.cells"), F.lit(0)).alias("ident"),
        F.size("_parsed.cells").alias("n_fields"),
        F.col("_parsed.malformed").alias("malformed"),
        F.col("_parsed.cells").alias("cells"),
        F.when(F.instr("value", '"') > 0, F.col("value")).alias("value"),
    )


def original_line(sep: str = "") -> Column:
    """The raw line of a record."""
    return F.coalesce(F.col("value"), F.array_join("cells", sep))


def fixed_width_records(lines: DataFrame) -> DataFrame:
    """Non-blank lines with their first character as the identifier; the
    fields are cut later, when the layout of the file is known."""
    return lines.filter(F.length("value") > 0).select(
        "file_nm",
        "block",
        "line_id",
        F.substring("value", 1, 1).alias("ident"),
        F.lit(1).alias("n_fields"),
        F.lit(False).alias("malformed"),
        F.array("value").alias("cells"),
        F.lit(None).cast("string").alias("value"),
    )


def partition_plan(size: Column, name: Column) -> Column:
    """Partitions for a file of `size` bytes: one per 200 MB, gzip one per 20 MB, plus one."""
    per = F.when(name.endswith(".gz"), GZIP_BYTES_PER_PARTITION).otherwise(PLAIN_BYTES_PER_PARTITION)
    return (F.floor(size / per) + 1).cast("int")
