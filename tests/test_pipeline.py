"""Whole runs over hand-written files."""

import gzip
import json
import os
import uuid

import pytest
from pyspark.sql import functions as F

from rawgate import ControlTables, IntakeOptions, ingest
from rawgate.model import STATUS_COLUMNS
from rawgate.session import remove

SCHEMA = [("p", "k", 1, 3, "bigint", False), ("P", "v", 2, 2, "string", False)]


def control(spark, files, checks=(), flag="N", casting="Y", sep="|", hex_flag="n", file_type=None, schema=SCHEMA, intraday=None, mapping=(), part=None, **tables):
    return ControlTables.from_rows(
        spark,
        expected_files=[("P", "s", "tgt", file_type, part, hex_flag, sep, flag, intraday, casting)],
        checklist=[("p", name, arg, str(i), "10", 1, "A", None) for i, (name, arg) in enumerate(checks)],
        file_schema=schema,
        manifest=[(n, "s", "r1", "20240101", "p") for n in files],
        mapping=[(g, k, None, v, None, i, "A", None) for i, (g, k, v) in enumerate(mapping)],
        **tables,
    )


def out(df):
    return sorted(tuple(r) for r in df.drop("snap_dt", "run_id").collect())


def where(result):
    return {r["file_nm"]: r["disposition"] for r in result.files.collect()}


def steps(result, name):
    rows = result.statuses.filter(F.col("file_nm") == name).collect()
    return [(r["action_typ_details"], r["status"]) for r in rows]


def reasons(result):
    return sorted((r["file_nm"], r["value"], r["reason"]) for r in result.quarantine.collect())


LAYOUTS = {
    "hhdt": ("N", "H|1\nH|K|V\nD|1|a\nD|2|b\nT|2\n"),
    "hhd": ("Y", "H|1\nH|K|V\nD|1|a\nD|2|b\n"),
    "column_head": ("Y", "H|K|V\nD|1|a\nD|2|b\nT|2\n"),
    "one_head_ind": ("N", "H|1\nD|1|a\nd|2|b\nT|2\n"),
    "one_head_plain": ("N", "h|1\n1|a\n2|b\nt|2\n"),
    "no_head_ind": ("N", "D|1|a\nD|2|b\nT|2\n"),
    "no_head_plain": ("N", "1|a\n2|b\nT|2\n"),
    "manual": ("Y", "K|V\n1|a\n2|b\n"),
}


def by_flag(cases, flag):
    return {name: case[-1] for name, case in cases.items() if case[0] == flag}


@pytest.mark.parametrize("flag", ["N", "Y"])
def test_delimited_layouts(spark, landing, flag):
    """Files of different layouts in one run."""
    files = {f"{name}__csv": text for name, text in by_flag(LAYOUTS, flag).items()}
    names = [n.replace("__", ".") for n in files]
    result = ingest(spark, control(spark, names, flag=flag), "p", landing(**files))
    assert out(result.published) == sorted([(1, "a"), (2, "b")] * len(files))
    assert where(result) == dict.fromkeys(names, "accepted")
    assert {r["n_good"] for r in result.files.collect()} == {2}


NO_IDENT = {
    "DT_no": ("N", "1|a\n2|b\n2\n"),
    "HDT_no": ("Y", "K|V\n\n1|a\n2|b\n2\n"),
    "HD_no": ("N", "20240101\n1|a\n2|b\n"),
    "HHDT_no": ("N", "20240101\nK|V\n1|a\n2|b\n2\n"),
    "HHD_no": ("Y", "x\nK|V\nD|1|a\nD|2|b\n"),
}


@pytest.mark.parametrize("fmt", NO_IDENT)
def test_delimited_without_identifiers(spark, landing, fmt):
    flag, text = NO_IDENT[fmt]
    checks = [("fileContentCheck", fmt)] + ([("rowCountCheck", "")] if "T" in fmt else [])
    result = ingest(spark, control(spark, ["f.csv"], checks, flag=flag), "p", landing(f__csv=text))
    assert out(result.published) == [(1, "a"), (2, "b")]
    assert ("fileContentCheck", "Pass") in steps(result, "f.csv")


FIXED = {
    "hhdt": ("N", "H20240101\nHKV\nD001aa\nD002b,\nT0000000002\n"),
    "one_head_plain": ("N", "H20240101\n001aa\n002b,\nT2\n"),
    "no_head_plain": ("N", "001aa\n002b,\n"),
    "no_head_ind": ("N", "D001aa\nD002b,zz\nT2\n"),
    "column_head": ("Y", "HKV\nD001aa\nD002b,\nT0000000002\n"),
    "manual": ("Y", "001aa\n002b,\n"),
}


@pytest.mark.parametrize("flag", ["N", "Y"])
def test_fixed_width_layouts(spark, landing, flag):
    files = {f"{name}__txt": text for name, text in by_flag(FIXED, flag).items()}
    names = [n.replace("__", ".") for n in files]
    conf = control(spark, names, flag=flag, file_type="FIXED_WIDTH", sep=None)
    result = ingest(spark, conf, "p", landing(**files))
    assert out(result.published) == sorted([(1, "aa"), (2, "b,")] * len(files))


def test_fixed_width_without_identifiers(spark, landing):
    checks = [("fileContentCheck", "HDT_no"), ("rowCountCheck", "")]
    conf = control(spark, ["f.txt"], checks, flag="Y", file_type="fixed_width", sep=None)
    result = ingest(spark, conf, "p", landing(f__txt="KV\n001aa\n002b,\n2\n"))
    assert out(result.published) == [(1, "aa"), (2, "b,")]


def test_fixed_width_short_and_long(spark, landing):
    folder = landing(f__txt="H1\nHKV\nD001aa\nD002\nD003cclong\nT3\n")
    result = ingest(spark, control(spark, ["f.txt"], [("rowCountCheck", "")], file_type="fixed_width"), "p", folder)
    assert out(result.published) == [(1, "aa"), (3, "cc")]
    assert reasons(result) == [("f.txt", "D002", "short")]


def test_one_bad_file_does_not_stop_the_others(spark, landing):
    folder = landing(
        good__csv="H|1\nH|K|V\nD|1|a\nT|1\n",
        count__csv="H|1\nH|K|V\nD|1|a\nT|7\n",
        order__csv="H|1\nH|V|K\nD|1|a\nT|1\n",
        nodata__csv="H|1\nH|K|V\nT|0\n",
        zero__csv="",
        other__csv="D|not|pending\n",
    )
    names = ["good.csv", "count.csv", "order.csv", "nodata.csv", "zero.csv", "gone.csv"]
    result = ingest(spark, control(spark, names, [("rowCountCheck", ""), ("fileContentCheck", "HHDT")]), "p", folder)
    assert out(result.published) == [(1, "a")]
    assert where(result) == {
        "good.csv": "accepted",
        "count.csv": "rejected",
        "order.csv": "rejected",
        "nodata.csv": "empty",
        "zero.csv": "empty",
        "gone.csv": "missing",
    }
    assert steps(result, "count.csv") == [("rowCountCheck", "Fail"), ("rowCountCheck", "Pass"), ("fileContentCheck", "Skipped")]
    assert steps(result, "order.csv") == [("Schemavalidation", "Fail"), ("Schemavalidation", "Pass")]
    assert steps(result, "zero.csv") == [("Emptyfilecheck", "Fail"), ("EmptyfileTransfer", "Pass")]
    assert [r["file_nm"] for r in result.schema_failures.collect()] == ["order.csv"]
    assert result.statuses.columns == STATUS_COLUMNS
    assert len(result.schema_failures.columns) == 18


def test_every_line_has_one_place(spark, landing):
    text = 'H|1\nH|K|V\n\nD|1|a\nD|2\nD|x|b\nD|3|"q"z\nD|4|c|more\n\nD|1|a\nT|6\n'
    result = ingest(spark, control(spark, ["f.csv"], [("rowCountCheck", "")]), "p", landing(f__csv=text))
    assert out(result.published) == [(1, "a"), (1, "a"), (4, "c")]
    assert reasons(result) == [
        ("f.csv", "D|2", "short"),
        ("f.csv", 'D|3|"q"z', "malformed"),
        ("f.csv", "D|x|b", "cast"),
    ]
    lines = [line for line in text.split("\n") if line]
    assert len(lines) == result.published.count() + result.quarantine.count() + 3
    assert ("IndividualRowLength", "Fail") in steps(result, "f.csv")


def test_data_equal_to_header_or_trailer_is_kept(spark, landing):
    text = "K|V\n1|a\nK|V\n3\n2|b\n3\n"
    conf = control(spark, ["f.csv"], [("fileContentCheck", "HDT_no")], flag="Y", casting="N")
    result = ingest(spark, conf, "p", landing(f__csv=text))
    assert out(result.published) == [("1", "a"), ("2", "b"), ("K", "V")]
    assert reasons(result) == [("f.csv", "3", "short")]


def test_additional_columns_go_by_name(spark, landing):
    folder = landing(
        end__csv="H|1\nH|K|V|Z\nD|1|a|z\n", mid__csv="H|1\nH|K|Z|V\nD|2|z|b\nD|3|z\n", start__csv="H|1\nH|Z|K|V\nD|z|4|d\n"
    )
    names = ["end.csv", "mid.csv", "start.csv"]
    result = ingest(spark, control(spark, names), "p", folder)
    assert out(result.published) == [(1, "a"), (2, "b"), (4, "d")]
    assert reasons(result) == [("mid.csv", "D|3|z", "short")]
    cut = ingest(spark, control(spark, names, casting="N"), "p", folder, IntakeOptions(positional=True))
    assert out(cut.published) == [("1", "a"), ("2", "z"), ("3", "z"), ("z", "4")]


def test_header_names_are_normalised(spark, landing):
    schema = [("p", "order_no", 1, 3, "int", False), ("p", "note_text", 2, 2, "string", False)]
    conf = control(
        spark, ["f.csv"], flag="Y", schema=schema, mapping=[("TabCol_RepMapping", " ", "_"), ("tabcol_repmapping", "#", "no")]
    )
    result = ingest(spark, conf, "p", landing(f__csv="Order  #|Note--text_\n1|a\n".replace("--", "  ")))
    assert out(result.published) == [(1, "a")]


def test_hex_delimiter_and_gzip_next_to_plain(spark, landing):
    text = "H\x01q\nD\x011\x01a\nT\x011\n"
    folder = landing(a__csv=text, b__csv__gz=gzip.compress(text.replace("1\x01a", "2\x01b").encode()))
    conf = control(spark, ["a.csv", "b.csv.gz"], [("rowCountCheck", "")], sep="1", hex_flag="Y")
    assert out(ingest(spark, conf, "p", folder).published) == [(1, "a"), (2, "b")]


def mapped(group, **settings):
    return (group, "k", json.dumps({"file_prefix_nm": {"P": settings}}))


def test_multi_line(spark, landing):
    text = 'H|1||\nD|1|"a\n""b""|c"|x\nD|2|plain|y\nD|3|short\nT|3||\n'
    schema = [*SCHEMA, ("p", "w", 3, 1, "string", False)]
    conf = control(
        spark, ["f.csv"], [("rowCountCheck", "")], schema=schema, mapping=[mapped("listOfMultilineFiles", total_column=4, escape='"')]
    )
    result = ingest(spark, conf, "p", landing(f__csv=text))
    assert out(result.published) == [(1, 'a\n"b"|c', "x"), (2, "plain", "y")]
    assert [(r[0], r[2]) for r in reasons(result)] == [("f.csv", "malformed")]


def test_clean_mode(spark, landing):
    text = "H;1;x;\nD;1;'a!b';drop\nD;2;''c'';drop\nT;2;;\n"
    settings = {"total_column": 4, "escape": "\\", "quote": "~", "type": "automated", "drop_field_index": [4], "hex_list": ["!", "\\xa1"]}
    conf = control(spark, ["f.csv"], [("rowCountCheck", "")], sep=";", mapping=[mapped("data_clean_configuration", **settings)])
    assert out(ingest(spark, conf, "p", landing(f__csv=text)).published) == [(1, "ab"), (2, "c")]
    settings["quote_flag"] = "Y"
    conf = control(spark, ["f.csv"], sep=";", mapping=[mapped("data_clean_configuration", **settings)])
    assert out(ingest(spark, conf, "p", landing(f__csv=text)).published) == [(1, "'ab'"), (2, "''c''")]


def test_xml(spark, landing):
    text = "<rs><r><K>1</K><V>a &lt; b</V></r><r><K>2</K></r></rs>"
    conf = control(spark, ["f.xml"], flag="Y", mapping=[mapped("xml_configuration", row_tag="r")])
    assert out(ingest(spark, conf, "p", landing(f__xml=text)).published) == [(1, "a < b"), (2, "")]


def test_obfuscation_and_target_names(spark, landing):
    schema = [("p", "k", 1, 3, "bigint", True), ("p", "v", 2, 2, "string", True)]
    conf = control(spark, ["f.csv"], schema=schema)
    options = IntakeOptions(obfuscation_key=b"\x01", target_columns=["id", "secret"])
    result = ingest(spark, conf, "p", landing(f__csv="1|b\n2|\n"), options)
    assert result.published.columns == ["id", "secret", "snap_dt", "run_id"]
    assert out(result.published) == [("MA==", "Yw=="), ("Mw==", "")]
    assert ("", "Pass") in steps(result, "f.csv")


def test_intraday(spark, landing):
    folder = landing(a__csv="1|x\n", b__csv="2|y\n")
    meta = [("20240101", "a.csv", "file_size:1,rows:2,snap_dt_timestamp:2024-01-01 10:11:12"), ("20240101", "b.csv", "rows:1")]
    conf = control(spark, ["a.csv", "b.csv"], intraday="Y", file_metadata=meta)
    result = ingest(spark, conf, "p", folder)
    assert out(result.published) == [(1, "x", "2024-01-01 10:11:12")]
    assert where(result) == {"a.csv": "accepted", "b.csv": "rejected"}
    assert ("Intradaystamp", "Fail") in steps(result, "b.csv")


def test_integrity_waits_fails_and_passes(spark, landing):
    folder = landing(a__csv="1|x\n2|y\n", b__csv="1|x\n9|y\n")
    conf = control(spark, ["a.csv", "b.csv"], [("integrityCheck", "k=parent.id")])
    parent = spark.createDataFrame([(1,), (2,)], "id bigint")
    result = ingest(spark, conf, "p", folder, IntakeOptions(parents={"parent": parent}))
    assert where(result) == {"a.csv": "accepted", "b.csv": "rejected"}
    waiting = ingest(spark, conf, "p", folder, IntakeOptions(parents={"parent": parent.filter("id > 5")}))
    assert where(waiting) == {"a.csv": "waiting", "b.csv": "waiting"}
    assert steps(waiting, "a.csv") == [("integrityCheck", "Waiting")]
    assert waiting.published.count() == 0


def test_variance_and_sum(spark, landing):
    folder = landing(f__csv="H|1\nD|10|a\nD|5|b\nT|2|15\n")
    conf = control(
        spark,
        ["f.csv"],
        [("rowCountVarianceCheck", None), ("sumCheckValidation", "k")],
        row_count_history=[("P", "20231231", "r1", 2)],
    )
    result = ingest(spark, conf, "p", folder)
    assert steps(result, "f.csv")[:2] == [("rowCountVarianceCheck", "Pass"), ("sumCheckValidation", "Pass")]


def test_unsupported_format(spark, landing):
    conf = control(spark, ["f.csv"], [("fileContentCheck", "HHHDT_no")])
    result = ingest(spark, conf, "p", landing(f__csv="1|a\n2|b\n3|c\n4|d\n5|e\n"))
    assert where(result) == {"f.csv": "rejected"}
    assert steps(result, "f.csv") == [("Unsupported content format", "Fail")]


def test_nothing_to_do(spark, landing):
    result = ingest(spark, control(spark, ["gone.csv"]), "p", landing())
    assert where(result) == {"gone.csv": "missing"}
    assert result.published.count() == result.quarantine.count() == result.statuses.count() == 0
    with pytest.raises(ValueError):
        ingest(spark, control(spark, []), "unknown", landing())


def test_write_twice_replaces_and_quality_route(spark, landing, tmp_path):
    folder = landing(f__csv="1|a\n2|b\n")
    conf = control(spark, ["f.csv"])
    base = str(tmp_path / "out")
    for _ in range(2):
        ingest(spark, conf, "p", folder).write(base)
    assert spark.read.parquet(f"{base}/tgt").count() == 2
    assert spark.read.parquet(f"{base}/tgt/snap_dt=20240101/run_id=r1").count() == 2
    assert spark.read.parquet(f"{base}/status").count() == 6
    for flag in (None, "x", 1):
        result = ingest(spark, conf, "p", folder, IntakeOptions(dq_flag=flag))
        assert result.route == "dq"
    result.write(base)
    assert spark.read.parquet(f"{base}/tgt_dq_input").count() == 2


@pytest.mark.parametrize(
    "group, settings, step",
    [
        ("data_clean_configuration", {"total_column": 2, "type": "other"}, "DataCleanProcess"),
        ("data_clean_configuration", {"type": "manual"}, "DataCleanProcess"),
        ("listOfMultilineFiles", {"escape": "x"}, "MultiLineProcesssing"),
    ],
)
def test_settings_that_cannot_work(spark, landing, group, settings, step):
    conf = control(spark, ["f.csv", "gone.csv"], mapping=[mapped(group, **settings)])
    result = ingest(spark, conf, "p", landing(f__csv="1|a\n"))
    assert where(result) == {"f.csv": "rejected", "gone.csv": "missing"}
    assert steps(result, "f.csv") == [(step, "Fail")]
    assert result.published.count() == result.quarantine.count() == result.schema_failures.count() == 0


def test_names_of_files_may_have_any_characters(spark, tmp_path):
    names = ["my file+1%20.csv", "plain=2.csv", "é#.csv"]
    for name in names:
        (tmp_path / name).write_text("1|a\n")
    result = ingest(spark, control(spark, names), "p", str(tmp_path))
    assert where(result) == dict.fromkeys(names, "accepted")


def jobs_of(spark, action):
    """Number of Spark jobs of an action, counted in a job group of its own."""
    group = f"jobs-{uuid.uuid4()}"
    spark.sparkContext.setJobGroup(group, "counted")
    try:
        action()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_the_number_of_jobs_does_not_grow_with_the_files(spark, landing):
    text = "H|1\nH|K|V\nD|1|a\nT|1\n"
    names = [f"f{i}.csv" for i in range(25)]
    folder = landing(**{n.replace(".", "__"): text for n in names})
    checks = [("rowCountCheck", ""), ("fileContentCheck", "HHDT")]

    def run(chosen):
        assert ingest(spark, control(spark, chosen, checks), "p", folder).published.count() == len(chosen)

    one, many = jobs_of(spark, lambda: run(names[:1])), jobs_of(spark, lambda: run(names))
    assert 0 < one
    assert many <= one + 3


def test_table_of_the_catalog(spark):
    from rawgate.operators import publish

    name = "stage_test_table"
    rows = spark.createDataFrame([(1, "a", "20240101", "r1"), (2, "b", "20240102", "r1")], "id int, v string, snap_dt string, run_id string")
    try:
        publish.publish_table(rows, name)
        assert publish.table_columns(spark, name) == ["id", "v"]
        publish.publish_table(rows.filter("id = 1").selectExpr("7 id", "v", "snap_dt", "run_id"), name)
        publish.publish_table(rows.filter("id = 2"), name, part_files=True)
        assert sorted(r["id"] for r in spark.table(name).collect()) == [2, 2, 7]
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_keep_bad_rows(spark, landing):
    conf = control(spark, ["f.csv"], casting="N")
    result = ingest(spark, conf, "p", landing(f__csv="1|a\n2\n"), IntakeOptions(keep_bad=True))
    assert out(result.published) == [("1", "a"), ("2", None)]
    assert result.quarantine.count() == 0


def test_blank_cells_stay_blank_text_and_null_numbers(spark, landing):
    result = ingest(spark, control(spark, ["f.csv"]), "p", landing(f__csv="1|a\n|\n"))
    assert sorted(out(result.published.fillna(-1))) == [(-1, ""), (1, "a")]
    assert result.quarantine.count() == 0


def test_a_file_that_two_runs_list(spark, landing):
    conf = control(spark, ["f.csv"], [("rowCountCheck", None)])
    conf.manifest = spark.createDataFrame(
        [("f.csv", "s", "r1", "20240101", "p"), ("f.csv", "s", "r2", "20240101", "p"), ("g.csv", "s", "r1", "20240101", "p")], conf.manifest.schema
    )
    result = ingest(spark, conf, "p", landing(f__csv="D|1|a\nD|2|b\nT|2\n", g__csv="D|3|c\nT|1\n"))
    files = sorted((r["file_nm"], r["run_id"], r["n_good"], r["disposition"]) for r in result.files.collect())
    assert files == [("f.csv", "r1", 2, "accepted"), ("f.csv", "r2", 2, "accepted"), ("g.csv", "r1", 1, "accepted")]
    rows = sorted((r["K"], r["run_id"], r["file_nm"]) for r in result.rows.collect())
    assert rows == [(1, "r1", "f.csv"), (1, "r2", "f.csv"), (2, "r1", "f.csv"), (2, "r2", "f.csv"), (3, "r1", "g.csv")]


def test_later_files_and_reruns_leave_others_alone(spark, landing, tmp_path):
    base = str(tmp_path / "out")
    folder = landing(a__csv="1|a\n", b__csv="2|b\nbad\n")
    for names in (["a.csv"], ["b.csv"], ["b.csv"]):
        ingest(spark, control(spark, names, part="y"), "p", folder).write(base)
    rows = spark.read.parquet(f"{base}/tgt").collect()
    assert sorted((r["K"], r["file_nm"]) for r in rows) == [(1, "a.csv"), (2, "b.csv")]
    assert spark.read.parquet(f"{base}/quarantine").count() == 1


def test_bad_row_report_of_a_run(spark, landing):
    result = ingest(spark, control(spark, ["f.csv"]), "p", landing(f__csv="1|a\n" + "bad\n" * 12))
    report = result.bad_row_report.collect()
    assert [(r["file_nm"], r["bad_rows"], len(r["samples"])) for r in report] == [("f.csv", 12, 10)]


def test_names_with_glob_characters(spark, tmp_path):
    names = ["f[1].csv", "g{a}*?.csv", "h.csv"]
    for name in names:
        (tmp_path / name).write_text("1|a\n")
    result = ingest(spark, control(spark, names), "p", str(tmp_path))
    assert where(result) == dict.fromkeys(names, "accepted") and result.published.count() == 3


def test_hidden_columns_are_never_published_in_clear(spark, landing):
    schema = [("p", "k", 1, 3, "bigint", False), ("p", "v", 2, 6, "string", True)]
    folder = landing(f__csv="1|secret\nx|secret\nsecret\n")
    refused = ingest(spark, control(spark, ["f.csv"], schema=schema), "p", folder)
    assert where(refused) == {"f.csv": "rejected"} and refused.published.count() == 0
    assert steps(refused, "f.csv") == [("ObfuscationKey", "Fail")]
    result = ingest(spark, control(spark, ["f.csv"], schema=schema), "p", folder, IntakeOptions(obfuscation_key=b"key"))
    text = str([result.published.collect(), result.quarantine.collect(), result.bad_row_report.collect()])
    assert "secret" not in text and result.quarantine.count() == 2 and result.published.count() == 1
    assert result.obfuscation_log.count() == 1


def test_integrity_compares_values_of_a_snapshot(spark, landing):
    conf = control(spark, ["f.csv", "g.csv"], [("integrityCheck", "k=parent.id")])
    folder = landing(f__csv="001|x\n 2|y\n", g__csv="abc|x\n")
    parent = spark.createDataFrame([(1, "20240101"), (2, "20240101"), (9, "20231231")], "id bigint, snap_dt string")
    result = ingest(spark, conf, "p", folder, IntakeOptions(parents={"parent": parent}))
    assert where(result) == {"f.csv": "accepted", "g.csv": "rejected"}
    old = parent.filter("snap_dt < '20240101'")
    assert where(ingest(spark, conf, "p", folder, IntakeOptions(parents={"parent": old}))) == {"f.csv": "waiting", "g.csv": "waiting"}
    assert where(ingest(spark, conf, "p", folder)) == {"f.csv": "waiting", "g.csv": "waiting"}  # no such table


def test_unknown_check_and_several_configurations(spark, landing):
    folder = landing(f__csv="1|a\n")
    result = ingest(spark, control(spark, ["f.csv"], [("noSuchCheck", None)]), "p", folder)
    assert where(result) == {"f.csv": "rejected"} and ("noSuchCheck", "Fail") in steps(result, "f.csv")
    conf = control(spark, ["f.csv"])
    conf.expected_files = conf.expected_files.union(conf.expected_files.withColumn("src_sys_nm", F.lit("t")))
    with pytest.raises(ValueError):
        ingest(spark, conf, "p", folder)
    assert where(ingest(spark, conf, "p", folder, IntakeOptions(src_sys_nm="s"))) == {"f.csv": "accepted"}


def test_multiline_files_keep_rows_marked_d(spark, landing):
    schema = [("p", "k", 1, 3, "bigint", False), ("p", "v", 2, 2, "string", False)]
    mapping = [mapped("listOfMultilineFiles", total_column=3, escape='"', quote='"')]
    conf = control(spark, ["f.csv"], schema=schema, mapping=mapping)
    result = ingest(spark, conf, "p", landing(f__csv='H|1|x\nD|1|"a\nb"\nX|9|z\nT|1|x\n'))
    assert out(result.published) == [(1, "a\nb")]


def test_order_in_files_of_several_parts(spark, tmp_path):
    """A later part that is larger is dealt first by Spark; the order is that of the names."""
    folder = tmp_path / "f.csv"
    folder.mkdir()
    (folder / "part-00000.csv").write_text("K|V\n1|a\n")
    (folder / "part-00001.csv").write_text("2|" + "b" * 500 + "\n3|c\n3\n")
    conf = control(spark, ["f.csv"], [("fileContentCheck", "HDT_no")], flag="Y")
    result = ingest(spark, conf, "p", str(tmp_path), IntakeOptions(folders=True))
    assert where(result) == {"f.csv": "accepted"} and [k for k, _ in out(result.published)] == [1, 2, 3]


def test_target_names_from_the_table(spark, landing):
    spark.sql("DROP TABLE IF EXISTS final_target")
    spark.sql("CREATE TABLE final_target (number bigint, letter string, snap_dt string, run_id string) USING parquet PARTITIONED BY (snap_dt, run_id)")
    result = ingest(spark, control(spark, ["f.csv"]), "p", landing(f__csv="1|a\n"), IntakeOptions(target_table="final_target"))
    result.write_table("final_target")
    assert [(r["number"], r["letter"]) for r in spark.table("final_target").collect()] == [(1, "a")]
    spark.sql("DROP TABLE final_target")


def logged(spark, base):
    return spark.read.option("basePath", base).parquet(f"{base}/status")


def test_finished_files_are_not_loaded_again(spark, landing, tmp_path):
    """A second run loads what waited and what is new, not what was published."""
    parent = spark.createDataFrame([("1", "20230101")], "key string, snap_dt string")
    folder = landing(a__csv="1|a\nT|1\n", b__csv="1|b\nT|1\n", c__csv="1|c\n")
    checks = [("integrityCheck", "k=parents.key")]
    first = ingest(spark, control(spark, ["a.csv"]), "p", folder)
    first.write(str(tmp_path / "out"))
    waits = ingest(spark, control(spark, ["b.csv"], checks), "p", folder, IntakeOptions(parents={"parents": parent}))
    assert where(waits) == {"b.csv": "waiting"}
    waits.write(str(tmp_path / "out"))
    log = logged(spark, str(tmp_path / "out"))
    both = control(spark, ["a.csv", "b.csv", "c.csv"])
    both.statuses = log
    assert where(ingest(spark, both, "p", folder)) == {"b.csv": "accepted", "c.csv": "accepted"}
    # the same name of another run is another delivery
    other = ControlTables(**{**vars(both), "manifest": both.manifest.withColumn("run_id", F.lit("r2"))})
    assert set(where(ingest(spark, other, "p", folder))) == {"a.csv", "b.csv", "c.csv"}


def test_latest_attempt_counts(spark):
    def status(time, step, outcome="Pass"):
        return ("20240101", "r1", "f.csv", "s", "P", "NA", "PublishToStage" if step else "Filelevelcheck", "", outcome, time, "")

    from rawgate.model import STATUS
    from rawgate.sources.control import finished_files

    def done(*rows):
        return finished_files(spark.createDataFrame(list(rows), STATUS)).count() == 1

    assert done(status("1", True))
    assert done(status("1", False, "Fail"), status("1", True))
    assert done(status("1", False, "Waiting"), status("2", True))
    assert not done(status("1", True), status("2", False, "Fail"))
    assert not done(status("1", True, "Fail"))
    assert not done(status("1", False))


def test_row_counts_are_kept_for_later_runs(spark, landing, tmp_path):
    """The second run's variance check sees the first; a rerun adds nothing."""
    base, checks = str(tmp_path / "out"), [("rowCountVarianceCheck", "")]
    folder = landing(a__csv="".join(f"{i}|a\n" for i in range(10)), b__csv="".join(f"{i}|b\n" for i in range(14)), c__csv="1|c\n" * 9)

    def run(name, snap, history):
        conf = control(spark, [name], checks)
        conf.manifest = conf.manifest.withColumn("snap_dt", F.lit(snap))
        if history:
            conf.row_count_history = spark.read.parquet(f"{base}/row_count_history")
        return ingest(spark, conf, "p", folder)

    first = run("a.csv", "20240101", False)
    assert where(first) == {"a.csv": "accepted"}
    first.write(base)
    run("a.csv", "20240101", True).write(base)
    kept = spark.read.parquet(f"{base}/row_count_history").collect()
    assert [(r["file_prefix_nm"], str(r["snap_dt"]), r["row_count"], r["file_nm"]) for r in kept] == [("p", "20240101", 10, "a.csv")]
    assert where(run("b.csv", "20240102", True)) == {"b.csv": "rejected"}  # 40 % more than the day before
    assert where(run("c.csv", "20240102", True)) == {"c.csv": "accepted"}


def test_reruns_do_not_double_reports(spark, landing, tmp_path):
    folder = landing(a__csv="1|a\n2\n3\n")
    base = str(tmp_path / "out")
    schema = [("p", "k", 1, 3, "string", False), ("P", "v", 2, 2, "string", True)]
    for _ in range(2):
        ingest(spark, control(spark, ["a.csv"], schema=schema), "p", folder, IntakeOptions(obfuscation_key=b"k")).write(base)
    assert [r["bad_rows"] for r in spark.read.parquet(f"{base}/bad_row_report").collect()] == [2]
    assert [r["file_info"] for r in spark.read.parquet(f"{base}/obfuscation_log").collect()] == ["20240101;r1;a.csv"]


def test_checks_of_the_user(spark, landing):
    """A check brings an aggregate, another a lookup; both are judged with the built-in ones."""
    from rawgate.operators.checks import FAIL, PASS, Check

    def most(rule, good):
        return {"top": F.max(F.when(good, F.col("`K`").try_cast("int")))}

    def known(files, data, rule):
        return files.withColumn(f"known_{rule.seq}", F.col("file_nm") == "a.csv")

    own = {
        "mostcheck": Check(lambda r, m: F.when(m["top"] <= int(r.argument), PASS).otherwise(FAIL), most),
        "knowncheck": Check(lambda r, m: F.when(F.col(f"known_{r.seq}"), PASS).otherwise(FAIL), lookup=known),
    }
    folder = landing(a__csv="1|a\n7|b\n", b__csv="1|a\n9|b\n", c__csv="2|a\n", d__csv="x|a\n")
    conf = control(spark, ["a.csv", "b.csv", "c.csv", "d.csv"], [("MostCheck", "7"), ("KnownCheck", ""), ("rowCountVarianceCheck", "")], casting="N")
    result = ingest(spark, conf, "p", folder, IntakeOptions(checks=own))
    assert where(result) == {"a.csv": "accepted", "b.csv": "rejected", "c.csv": "rejected", "d.csv": "rejected"}


def test_hidden_columns_by_date(spark, landing):
    """Each file is hidden by the configuration of its snapshot."""
    from rawgate.functions.obfuscation import deobfuscate

    dated = [("p", "v", "20240101", "20231201", True), ("P", "V", "20240103", None, False), ("p", "k", "20240104", None, True), ("p", "gone", "20200101", None, True)]
    folder = landing(**{f"f{d}__csv": f"{d}|v{d}\n" for d in range(1, 5)})
    conf = control(spark, [f"f{d}.csv" for d in range(1, 5)], casting="N", obfuscation=dated)
    conf.manifest = conf.manifest.withColumn("snap_dt", F.concat(F.lit("2024010"), F.substring("file_nm", 2, 1)))
    refused = ingest(spark, conf, "p", folder)
    assert set(where(refused).values()) == {"rejected"}  # no key, nothing in clear text
    result = ingest(spark, conf, "p", folder, IntakeOptions(obfuscation_key=b"key"))
    plain = {r["snap_dt"][-1]: (r["K"], r["V"], r["k"], r["v"]) for r in result.published.select("snap_dt", "K", "V", deobfuscate(F.col("K"), b"key").alias("k"), deobfuscate(F.col("V"), b"key").alias("v")).collect()}
    assert {d: (k if k == d else "hidden", v if v == f"v{d}" else "hidden") for d, (k, v, _, _) in plain.items()} == {
        "1": ("1", "hidden"), "2": ("2", "hidden"), "3": ("3", "v3"), "4": ("hidden", "v4")
    }
    assert plain["1"][3] == "v1" and plain["4"][2] == "4"
    log = {r["partition_value"]: (r["config_snap_dt"], r["reset_snap_dt"]) for r in result.obfuscation_log.collect()}
    assert log == {"2024-01-01": ("20240101", "20231201"), "2024-01-02": ("20240101", "20231201"), "2024-01-04": ("20240104", None)}
    assert steps(result, "f3.csv").count(("", "Pass")) == 0


def test_staged_data_is_removed(spark, landing, tmp_path, monkeypatch):
    """By `close` or `with` after a run, and by a run that fails."""
    from rawgate.plans import ingest as plan

    def there(paths):
        return [p for p in paths if os.path.exists(p.removeprefix("file:"))]

    folder = landing(a__csv="1|a\n")
    with ingest(spark, control(spark, ["a.csv"]), "p", folder) as result:
        result.write(str(tmp_path / "out"))
        paths = list(result.staged)
        assert len(there(paths)) == len(paths) > 3
    assert not there(paths) and spark.read.parquet(str(tmp_path / "out/tgt")).count() == 1
    seen = []
    monkeypatch.setattr(plan, "remove", lambda spark, staged: (seen.extend(there(staged)), remove(spark, staged)))
    monkeypatch.setattr(plan, "_judge", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        ingest(spark, control(spark, ["a.csv"]), "p", folder)
    assert seen and not there(seen)


def test_a_lost_row_fails_publishing(spark, landing, tmp_path):
    """Rows that are written are counted, and compared with those that were checked."""
    from dataclasses import replace

    base = str(tmp_path / "out")
    folder = landing(a__csv="1|a\n2|b\nx|c\n3\n")
    result = ingest(spark, control(spark, ["a.csv"]), "p", folder)  # one bad row, one that does not convert
    result.write(base)
    publishing = "action_type = 'PublishToStage'"
    assert [r["status"] for r in logged(spark, base).filter(publishing).collect()] == ["Pass"]
    assert result.quarantine.count() == 2
    replace(result, rows=result.rows.filter("K > 1")).write(str(tmp_path / "less"))
    log = logged(spark, str(tmp_path / "less"))
    assert [r["status"] for r in log.filter(publishing).collect()] == ["Fail"]
    from rawgate.sources.control import finished_files

    assert finished_files(log).count() == 0 and finished_files(logged(spark, base)).count() == 1


def test_publish_to_a_table_with_types(spark, landing, tmp_path):
    name = "typed_target"
    folder = landing(a__csv="1|20\n2|many\n")
    result = ingest(spark, control(spark, ["a.csv"], casting="N"), "p", folder)
    try:
        spark.sql(f"CREATE TABLE {name} (k BIGINT, v INT, more STRING, snap_dt STRING, run_id STRING) USING parquet PARTITIONED BY (snap_dt, run_id)")
        with pytest.raises(ValueError, match="do not fit"):
            result.write_table(name)
        assert spark.table(name).count() == 0
        result.write_table(name, str(tmp_path / "rejects"))
        assert [tuple(r) for r in spark.table(name).collect()] == [(1, 20, None, "20240101", "r1")]
        rejected = spark.read.parquet(str(tmp_path / "rejects")).collect()
        assert [(r["K"], r["V"], r["reject_cols"], r["file_nm"]) for r in rejected] == [("2", "many", "v", "a.csv")]
        with pytest.raises(ValueError, match="no column for file_nm, v"):
            from rawgate.operators.publish import reconcile

            reconcile(result.rows, spark.table(name).drop("v").schema)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
