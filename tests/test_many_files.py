"""Landing folders of many small files."""

import uuid

import pytest

from rawgate.session import DEFAULT_OPEN_BYTES, OPEN_BYTES, many_files
from rawgate.sources import csvfiles, lines, listing, multiline, xmlfiles

LISTING_KEY = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
OPEN_KEY = "spark.sql.files.openCostInBytes"
FILES = 80


@pytest.fixture(scope="module")
def folders(tmp_path_factory):
    """One folder per file, more of them than four for each of the session's eight cores."""
    root = tmp_path_factory.mktemp("many")
    for i in range(FILES):
        (root / f"file_nm=f{i}.csv").mkdir()
        (root / f"file_nm=f{i}.csv" / "part-0").write_text(f"D|{i}\nD|{i + 1}\n")
    return str(root)


READERS = {
    "lines": lambda spark, path: lines.read_lines(spark, path, folders=True),
    "csv": lambda spark, path: csvfiles.read_csv_records(spark, path, 2, "|", folders=True),
    "multiline": lambda spark, path: multiline.placed_lines(spark, [path], multiline.Quoting("|", '"', '"'), True),
    "xml": lambda spark, path: xmlfiles._pieces(spark, [path], xmlfiles.RowTags("row"), True),
}


@pytest.mark.parametrize("kind", sorted(READERS))
def test_listing_takes_few_tasks_however_many_folders(spark, folders, kind):
    context, group = spark.sparkContext, uuid.uuid4().hex
    context.setJobGroup(group, kind)
    before = spark.conf.get(LISTING_KEY)
    try:
        found = READERS[kind](spark, folders)
    finally:
        context._jsc.clearJobGroup()
    tracker = context.statusTracker()
    jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup(group)]
    tasks = [tracker.getStageInfo(s).numTasks for job in jobs for s in job.stageIds if tracker.getStageInfo(s)]
    assert tasks and max(tasks) <= 4 * context.defaultParallelism < FILES
    assert spark.conf.get(LISTING_KEY) == before
    assert found.select("file_nm").distinct().count() == FILES


def test_figures_that_somebody_has_chosen_count(spark):
    before = {k: spark.conf.get(k) for k in (LISTING_KEY, OPEN_KEY)}
    try:
        spark.conf.set(LISTING_KEY, "7")
        spark.conf.set(OPEN_KEY, "1234567")
        with many_files(spark):
            assert (spark.conf.get(LISTING_KEY), spark.conf.get(OPEN_KEY)) == ("7", "1234567")
        spark.conf.set(OPEN_KEY, str(DEFAULT_OPEN_BYTES))
        with many_files(spark):
            assert spark.conf.get(OPEN_KEY) == str(OPEN_BYTES)
        assert spark.conf.get(LISTING_KEY) == "7"
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_scans_of_small_files_take_few_tasks(spark, folders):
    size = "spark.sql.files.maxPartitionBytes"
    before = {k: spark.conf.get(k) for k in (size, OPEN_KEY)}
    try:
        spark.conf.set(size, "16m")
        spark.conf.set(OPEN_KEY, str(DEFAULT_OPEN_BYTES))
        # four files a task by Spark's own figure, and as many files in each staged table
        assert lines.read_lines(spark, folders, folders=True).rdd.getNumPartitions() < FILES // 4
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_names_are_those_of_the_listing_without_asking_for_sizes(spark, tmp_path):
    for name in ("b=x y.csv", "plain", "_hidden", ".dot"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "part-0").write_text("12345")
    (tmp_path / "a=b.csv").write_text("1")
    (tmp_path / "empty").write_text("")
    listed = sorted((r.file_nm, r.path.rsplit("/", 1)[1]) for r in listing.list_files(spark, str(tmp_path)).collect())
    assert listed == [("a=b.csv", "a=b.csv"), ("empty", "empty"), ("plain", "plain"), ("x y.csv", "b=x y.csv")]
    assert {r.file_nm: r.file_size for r in listing.list_files(spark, str(tmp_path)).collect()}["a=b.csv"] == 1
    assert sorted(r.file_nm for r in listing.list_names(spark, str(tmp_path)).collect()) == [n for n, _ in listed]
    for find in (listing.list_files, listing.list_names):
        assert find(spark, str(tmp_path / "absent")).count() == 0


def test_record_texts_are_made_once_and_end_without_a_carriage_return(spark, tmp_path):
    raw = b"1|a\r\n\r\n\r\r\n2|b\r\r\n\n3|\"x\r\ny\"\r\n4|\"u\r\rv\"\r\n5|c\r"
    (tmp_path / "f.csv").write_bytes(raw)
    quoting = multiline.Quoting("|", '"', '"')
    texts = multiline.record_texts(multiline.placed_lines(spark, [str(tmp_path)], quoting, False), quoting)
    got = [r.value for r in texts.orderBy("block", "line_id").collect()]
    assert got == ["1|a", "\r", "2|b\r", '3|"x\ny"', '4|"u\r\rv"', "5|c"]
    plan = texts._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.split("\n") if "Filter " in line]
    assert filters and all("replace(" not in line for line in filters)
