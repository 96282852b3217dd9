"""Spark session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # the JVM never compiles methods beyond this size, and a row then costs ten
    # times as much; Spark's own limit lets far larger generated methods pass
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # plain files: 200 MB per task, no shuffle to get there
    "spark.sql.files.maxPartitionBytes": str(200 * 1024 * 1024),
}


def build_session(master: str | None = None, app_name: str = "rawgate", **extra: str) -> SparkSession:
    """A session with the settings above; `extra` uses `__` for the dots of a key."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in extra.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


#: Spark's own default, which a session from elsewhere has if nobody chose
DEFAULT_PARTITION_BYTES = 128 * 1024 * 1024


def tune(spark: SparkSession) -> None:
    """What a session from elsewhere must not lack: the codegen limit, and 200 MB
    per task unless somebody has chosen another size."""
    size = "spark.sql.files.maxPartitionBytes"
    if spark.conf.get(size) in (str(DEFAULT_PARTITION_BYTES), f"{DEFAULT_PARTITION_BYTES}b", "128MB", "128m"):
        spark.conf.set(size, SETTINGS[size])
    limit = "spark.sql.codegen.hugeMethodLimit"
    if int(spark.conf.get(limit)) > int(SETTINGS[limit]):
        spark.conf.set(limit, SETTINGS[limit])


#: Spark's own defaults: bytes that opening a file is taken for, and tasks that list folders
DEFAULT_OPEN_BYTES, DEFAULT_LISTING_TASKS = 4 * 1024 * 1024, 10_000
OPEN_BYTES = 512 * 1024
_OPEN_KEY = "spark.sql.files.openCostInBytes"
_LISTING_KEY = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


@contextmanager
def many_files(spark: SparkSession) -> Iterator[None]:
    """While it holds, readers list folders with four tasks per core, not with one for each folder; from
    then on, a task reads some hundred small files, not four. Where somebody has chosen other figures, those count.

    A landing folder of thousands of small files costs more in tasks than in rows.
    """
    if spark.conf.get(_OPEN_KEY) in (str(DEFAULT_OPEN_BYTES), f"{DEFAULT_OPEN_BYTES}b", "4MB", "4m"):
        spark.conf.set(_OPEN_KEY, str(OPEN_BYTES))
    before = spark.conf.get(_LISTING_KEY)
    if before == str(DEFAULT_LISTING_TASKS):
        spark.conf.set(_LISTING_KEY, str(4 * spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.set(_LISTING_KEY, before)


_LOCAL_ROOTS: dict[str, str] = {}
_STAGED: ContextVar[list[str] | None] = ContextVar("staged", default=None)


@contextmanager
def registered_staging() -> Iterator[list[str]]:
    """While it holds, collects the folders that `scratch_path` gives out."""
    paths: list[str] = []
    token = _STAGED.set(paths)
    try:
        yield paths
    finally:
        _STAGED.reset(token)


def remove(spark: SparkSession, paths: list[str]) -> None:
    """Delete staged folders, whatever file system they are on; what is not there is no error."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for path in paths:
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(conf).delete(place, True)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder name under the shared folder of `spark.checkpoint.dir`.

    A temporary folder of this machine is used only where the setting is
    missing and the session is local, as in tests.
    """
    app = spark.sparkContext.applicationId
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        root = _LOCAL_ROOTS.setdefault(app, tempfile.mkdtemp(prefix="run-"))
    path = f"{root.rstrip('/')}/rawgate/{app}/{label}-{uuid.uuid4().hex[:12]}"
    registered = _STAGED.get()
    if registered is not None:
        registered.append(path)
    return path


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once to the shared folder and read it back.

    This cuts the lineage in a way that survives lost executors: later steps
    read the written table and never recompute what came before it. It also
    freezes generated values (line positions), which must not be made twice.
    Cells of all columns share one array, so a dictionary of them is no use.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.option("compression", "zstd").option("parquet.enable.dictionary#cells.list.element", "false").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
