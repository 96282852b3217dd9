"""What is really in the landing folder."""

from __future__ import annotations

from collections.abc import Iterator

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession

LISTING = "file_nm string, path string, file_size bigint"


def _entries(spark: SparkSession, folder: str) -> tuple[JavaObject, Iterator[tuple[JavaObject, JavaObject, str, bool]]]:
    """The file system, and status, path, name and kind of each entry.

    Every call crosses from Python to the JVM and back, one entry after the other, so none is made twice.
    """
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def each() -> Iterator[tuple[JavaObject, JavaObject, str, bool]]:
        for entry in fs.listStatus(path) if fs.exists(path) else ():
            place = entry.getPath()
            name = place.getName()
            if name.startswith(("_", ".")):
                continue
            is_folder = entry.isDirectory()
            yield entry, place, name.split("=", 1)[-1] if is_folder else name, is_folder

    return fs, each()


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """Name, path and size of each entry of `folder` (names and sizes only).

    A listing is needed because no scan shows a file without rows: zero-length
    files are left out by Spark's file sources. A folder entry stands for a
    file landed in parts; its size is the sum of the parts and its name what follows
    `=`, if there is one.
    """
    fs, entries = _entries(spark, folder)
    found = []
    for entry, path, name, is_folder in entries:
        size = fs.getContentSummary(path).getLength() if is_folder else entry.getLen()
        found.append((name, path.toString(), int(size)))
    return spark.createDataFrame(found, LISTING)


def list_names(spark: SparkSession, folder: str) -> DataFrame:
    """The names of `list_files` alone: one request, whatever the number of entries, as no sizes are asked for."""
    _, entries = _entries(spark, folder)
    return spark.createDataFrame([(name,) for _, _, name, _ in entries], "file_nm string")


def missing_files(manifest: DataFrame, listing: DataFrame) -> DataFrame:
    """Files that are expected but not there."""
    return manifest.join(listing.select("file_nm"), "file_nm", "left_anti")


def present_files(manifest: DataFrame, listing: DataFrame) -> DataFrame:
    """Expected files that are there, with path and size."""
    return manifest.join(listing, "file_nm", "inner")
