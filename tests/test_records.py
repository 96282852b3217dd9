"""Edges, layouts and row validation on hand-written lines."""

import pytest
from pyspark.sql import functions as F

from rawgate.operators import records, rows
from rawgate.session import stage
from rawgate.sources import csvfiles, lines


def read(spark, folder, sep="|"):
    return stage(lines.delimited_records(lines.read_lines(spark, folder), sep), "t")


def text(df):
    return sorted(r["l"] for r in df.select(lines.original_line("|").alias("l")).collect())


def test_positions_hold_over_many_splits(spark, landing):
    """Files cut into many splits, packed with others: first and last lines stay right."""
    folder = landing(
        a__csv="first|a\n" + "".join(f"{i}|{'x' * (i % 50)}\n" for i in range(3000)) + "last|a\n",
        b__csv="first|b\n" + "".join(f"{i}|y\n" for i in range(700)) + "last|b",
        c__csv="only|c\n",
    )
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        found = lines.read_lines(spark, folder)
        assert found.rdd.getNumPartitions() > 15
        found = stage(lines.delimited_records(found, "|"), "t")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert text(records.first_records(found)) == ["first|a", "first|b", "only|c"]
    assert text(records.last_records(found)) == ["last|a", "last|b", "only|c"]
    seconds = records.take_headers(found, 2).filter("nth = 2")
    assert text(seconds) == ["0|", "0|y"]
    kept = records.drop_edges(found, 1, 1)
    assert kept.count() == 3700
    order = [r["cells"][0] for r in kept.filter("file_nm = 'a.csv'").orderBy("block", "line_id").collect()]
    assert order == [str(i) for i in range(3000)]


def test_edges_by_position_or_by_value(spark, landing):
    folder = landing(a__csv="k|v\n1|2\nk|v\n2\n3|4\n2\n")
    found = read(spark, folder)
    assert text(records.drop_edges(found, 1, 1)) == ["1|2", "2", "3|4", "k|v"]
    assert text(records.drop_edges(found, 1, 1, by_value=True)) == ["1|2", "3|4"]


@pytest.mark.parametrize("head, tail", [(3, 0), (0, 2), (-1, 0)])
def test_unsupported_edges(spark, landing, head, tail):
    found = read(spark, landing(a__csv="1|2\n"))
    with pytest.raises(ValueError):
        records.drop_edges(found, head, tail)


def test_blank_lines_nul_and_bad_bytes(spark, landing):
    folder = landing(a__csv=b"a|b\n\n\x00c|d\x00\n\xff|e\n")
    found = read(spark, folder)
    assert text(found) == ["a|b", "c|d", "�|e"]


def test_counts_ignore_case(spark, landing):
    folder = landing(a__csv="h|1\nd|2\nD|3\nx|4\nt|5\n", b__csv="D|1\n")
    rows_ = {r["file_nm"]: r for r in records.file_counts(read(spark, folder)).collect()}
    a = rows_["a.csv"]
    assert (a["n_lines"], a["n_head"], a["n_ind"], a["n_trail"], a["n_data"]) == (5, 1, 2, 1, 3)
    assert rows_["b.csv"]["n_data"] == 1


CASES = [
    # n_head, flag, n_ind, fixed, compat -> layout, lead, header_from, checked, keep_all
    (1, "N", 0, False, False, ("one_head_no_ind", False, "none", False, False)),
    (1, "N", 3, False, False, ("one_head_ind", True, "none", False, False)),
    (0, "N", 3, False, False, ("no_head", True, "none", False, False)),
    (0, "N", 0, False, False, ("no_head", False, "none", False, False)),
    (0, "N", 0, False, True, ("no_head", True, "none", False, False)),
    (1, "Y", 3, False, False, ("column_head", True, "head_1", True, False)),
    (2, "N", 3, False, False, ("two_heads", True, "head_2", True, False)),
    (2, "Y", 3, False, False, ("two_heads", True, "head_2", True, False)),
    (0, "Y", 0, False, False, ("manual", False, "line_1", True, True)),
    (1, "N", 0, True, False, ("one_head_no_ind", False, "none", False, False)),
    (1, "N", 3, True, False, ("one_head_ind", True, "none", False, False)),
    (0, "N", 3, True, False, ("no_head", True, "none", False, False)),
    (0, "N", 0, True, False, ("no_head", False, "none", False, False)),
    (1, "Y", 3, True, False, ("column_head", True, "head_1", True, False)),
    (2, "N", 3, True, False, ("two_heads", True, "head_2", True, False)),
    (0, "Y", 0, True, False, ("manual", False, "none", False, False)),
]


@pytest.mark.parametrize("n_head, flag, n_ind, fixed, compat, want", CASES)
def test_layouts_with_identifiers(spark, n_head, flag, n_ind, fixed, compat, want):
    files = spark.range(1).selectExpr(
        "10L n_lines", f"{n_head}L n_head", f"{n_ind}L n_ind", f"'{flag}' col_header_flag", "false no_ident", "0 fmt_head", "0 fmt_tail"
    )
    row = records.classify_layout(files, fixed, compat).first()
    assert (row["layout"], row["lead"], row["header_from"], row["header_checked"], row["keep_all"]) == want


NO_IDENT = [
    # fmt_head, fmt_tail, flag, n_ind of 10 lines, fixed -> layout, lead, header_from, checked
    (0, 1, "N", 0, False, ("no_ident_0", False, "none", False)),
    (0, 1, "Y", 0, False, ("no_ident_0", False, "none", True)),
    (0, 1, "Y", 0, True, ("no_ident_0", False, "none", False)),
    (1, 1, "Y", 8, False, ("no_ident_1", True, "line_1", True)),
    (1, 1, "Y", 2, False, ("no_ident_1", False, "line_1", True)),
    (1, 0, "N", 0, False, ("no_ident_1_plain", False, "none", False)),
    (2, 1, "N", 0, True, ("no_ident_2", False, "line_2", True)),
    (3, 1, "N", 0, False, ("unsupported", False, "none", False)),
    (1, 2, "N", 0, False, ("unsupported", False, "none", False)),
]


@pytest.mark.parametrize("head, tail, flag, n_ind, fixed, want", NO_IDENT)
def test_layouts_without_identifiers(spark, head, tail, flag, n_ind, fixed, want):
    files = spark.range(1).selectExpr(
        "10L n_lines", "0L n_head", f"{n_ind}L n_ind", f"'{flag}' col_header_flag", "true no_ident", f"{head} fmt_head", f"{tail} fmt_tail"
    )
    row = records.classify_layout(files, fixed).first()
    assert (row["layout"], row["lead"], row["header_from"], row["header_checked"]) == want


def test_width_and_report(spark, landing):
    folder = landing(a__csv="1|2|3\n1|2\n1|2|3|4\n" + '1|"x"y|3\n' + "".join(f"s{i}\n" for i in range(12)))
    good, bad = rows.split_good_bad(read(spark, folder), rows.width_reason(3))
    assert text(good) == ["1|2|3", "1|2|3|4"]
    assert sorted({r["reason"] for r in bad.collect()}) == ["malformed", "short"]
    report = rows.bad_row_report(bad, lines.original_line("|")).first()
    assert report["bad_rows"] == 14
    assert report["samples"] == ["1|2", '1|"x"y|3', *[f"s{i}" for i in range(8)]]


def test_malformed_rows_are_seen_when_columns_are_pruned(spark, landing):
    folder = landing(a__csv="D;1;x\nD;2\nD;3;x;y\nD;4;z\n")
    found = csvfiles.read_csv_records(spark, folder, 3, ";")
    assert [r["i"] for r in found.filter("malformed").selectExpr("cells[1] i").collect()] == ["2", "3"]
    assert csvfiles.drop_malformed(found).select("file_nm").count() == 2


def test_bad_records(spark, landing):
    folder = landing(a__csv="H;a\nD;2\nD;2\nD;3;x\nT;1\n")
    found = stage(csvfiles.read_csv_records(spark, folder, 3, ";"), "t")
    assert rows.bad_records(found, "automated").count() == 2
    assert rows.bad_records(found, "automated", distinct=True).count() == 1
    assert rows.bad_records(found, "manual").count() == 3
    with pytest.raises(ValueError):
        rows.bad_records(found, "other")


def test_good_rows_are_counted_by_the_write(spark, tmp_path):
    counted, seen = rows.counted(spark.range(77), "n")
    counted.write.parquet(str(tmp_path / "out"))
    assert seen.get["rows"] == 77


def test_empty_files_start_from_the_manifest(spark, landing):
    found = read(spark, landing(a__csv="H|1\nT|0\n", b__csv="H|1\nD|1\nT|1\n"))
    manifest = spark.createDataFrame([("a.csv",), ("b.csv",), ("c.csv",)], "file_nm string")
    files = records.with_counts(manifest, records.file_counts(found))
    assert sorted(r["file_nm"] for r in records.empty_files(files).collect()) == ["a.csv", "c.csv"]
    assert records.empty_files(files, F.lit(1)).count() == 3
