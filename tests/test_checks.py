"""Check outcomes, one by one, and the short circuit."""

import pytest
from pyspark.sql import functions as F

from rawgate import model
from rawgate.operators import checks
from rawgate.operators.checks import Rule

BASE = {
    "file_nm": "'f'",
    "trailer": "array('T', '3', '10.5')",
    "no_ident": "false",
    "n_good": "2L",
    "n_bad": "1L",
    "n_head": "1L",
    "n_trail": "1L",
    "n_data": "3L",
    "n_lines": "5L",
    "fmt_head": "1",
    "fmt_tail": "1",
    "sum_1": "cast(10.5 as decimal(38,6))",
    "prev_count": "3L",
    "parent_ready_1": "true",
    "orphans_1": "0L",
}


def files(spark, **changes):
    return spark.range(1).selectExpr(*[f"{v} {k}" for k, v in {**BASE, **changes}.items()])


CASES = [
    (Rule(1, "rowCountCheck", ""), {}, "Pass"),
    (Rule(1, "ROWCOUNTCHECK", "2"), {}, "Pass"),
    (Rule(1, "rowCountCheck", "3"), {}, "Fail"),
    (Rule(1, "rowCountCheck", ""), {"n_bad": "0L"}, "Fail"),
    (Rule(1, "rowCountCheck", ""), {"trailer": "array('T', 'x')"}, "Fail"),
    (Rule(1, "rowCountCheck", ""), {"trailer": "cast(null as array<string>)"}, "Fail"),
    (Rule(1, "rowCountCheck", ""), {"trailer": "array('3')", "no_ident": "true"}, "Pass"),
    (Rule(1, "fileContentCheck", "HDT"), {}, "Pass"),
    (Rule(1, "fileContentCheck", "HDT"), {"n_trail": "0L"}, "Fail"),
    (Rule(1, "fileContentCheck", "HDT"), {"n_data": "0L"}, "Fail"),
    (Rule(1, "fileContentCheck", "HDT_no"), {"no_ident": "true", "n_head": "0L", "n_lines": "3L"}, "Pass"),
    (Rule(1, "fileContentCheck", "HDT_no"), {"no_ident": "true", "n_lines": "2L"}, "Fail"),
    (Rule(1, "sumCheckValidation", "total"), {}, "Pass"),
    (Rule(1, "sumCheckValidation", "total,3"), {"sum_1": "cast(10 as decimal(38,6))"}, "Fail"),
    (Rule(1, "sumCheckValidation", "total,2"), {"sum_1": "cast(3 as decimal(38,6))"}, "Pass"),
    (Rule(1, "rowCountVarianceCheck", "", "0"), {}, "Pass"),
    (Rule(1, "rowCountVarianceCheck", "", "50"), {"prev_count": "2L"}, "Pass"),
    (Rule(1, "rowCountVarianceCheck", "", "49"), {"prev_count": "2L"}, "Fail"),
    (Rule(1, "rowCountVarianceCheck", "", "10"), {"prev_count": "cast(null as bigint)"}, "Skipped"),
    (Rule(1, "integrityCheck", "a=p.b"), {}, "Pass"),
    (Rule(1, "integrityCheck", "a=p.b"), {"orphans_1": "2L"}, "Fail"),
    (Rule(1, "integrityCheck", "a=p.b"), {"parent_ready_1": "false", "orphans_1": "2L"}, "Waiting"),
]


@pytest.mark.parametrize("rule, changes, want", CASES)
def test_outcome(spark, rule, changes, want):
    assert checks.evaluate(files(spark, **changes), [rule]).first()["outcome"] == want


def test_unknown_check_fails_its_files(spark):
    assert checks.evaluate(files(spark), [Rule(1, "noSuchCheck", "")]).first()["status"] == "Fail"


def test_own_checks_can_be_registered(spark):
    own = {"always": lambda rule: F.lit(rule.argument)}
    assert checks.evaluate(files(spark), [Rule(1, "Always", "Pass")], own).first()["status"] == "Pass"


def test_short_circuit_is_the_same_both_ways(spark):
    own = {n: (lambda rule, n=n: F.lit(n)) for n in ("Pass", "Fail", "Waiting", "Skipped")}
    own = {k.lower(): v for k, v in own.items()}
    for order in (["Pass", "Skipped", "Fail", "Pass", "Fail"], ["Pass", "Waiting", "Fail"], ["Pass"], []):
        rules = [Rule(i, n, "") for i, n in enumerate(order, 1)]
        found = checks.evaluate(files(spark), rules, own)
        by_window = checks.short_circuit(found.drop("status"))
        want = sorted((r["seq"], r["status"]) for r in by_window.collect())
        assert sorted((r["seq"], r["status"]) for r in found.collect()) == want
        judged = checks.run_rules(files(spark), rules, own).first()
        statuses = [s for _, s in want]
        assert (judged["failed"], judged["waiting"]) == ("Fail" in statuses, "Waiting" in statuses)


def test_failure_adds_a_transfer(spark):
    own = {"a": lambda r: F.lit("Pass"), "b": lambda r: F.lit("Fail"), "c": lambda r: F.lit("Pass")}
    outcomes = checks.evaluate(files(spark), [Rule(1, "a", ""), Rule(2, "b", ""), Rule(3, "c", "")], own)
    got = [tuple(r)[2:] for r in checks.outcome_status(outcomes).orderBy("seq", "action_type").collect()]
    assert got == [
        ("Filelevelcheck", "a", "Pass"),
        ("FileTransfer", "b", "Pass"),
        ("Filelevelcheck", "b", "Fail"),
        ("Filelevelcheck", "c", "Skipped"),
    ]


def test_rules_sort_by_number_without_case_and_repetition(spark):
    rows = [("P", "c", None, "10"), ("p", "a", "", "2"), ("p", "a", None, "2"), ("P", "b", "x", "1"), ("p", "d", "", "zz")]
    checklist = spark.createDataFrame([(p, t, a, pr, None, 1, "A", None) for p, t, a, pr in rows], model.CHECKLIST)
    found = checks.rule_list(checklist).orderBy("seq").collect()
    assert [r["file_chck_typ"] for r in found] == ["b", "a", "c", "d"]


def test_latest_run_before(spark):
    history = spark.createDataFrame(
        [("P", "20240101", "1", 5), ("p", "20240102", "1", 7), ("p", "20240103", "2", 9), ("p", "20240105", "1", 99)],
        model.ROW_COUNT_HISTORY,
    )
    runs = [("a", "20240103", "1"), ("b", "20240103", "2"), ("c", "20240101", "1"), ("d", "20240104", "1")]
    pending = spark.createDataFrame([(f, "p", s, r) for f, s, r in runs], "file_nm string, file_prefix_nm string, snap_dt string, run_id string")
    got = {r["file_nm"]: r["prev_count"] for r in checks.latest_before(pending, history).collect()}
    assert got == {"a": 7, "b": 7, "c": None, "d": 9}


def test_orphans_with_a_hot_key(spark):
    rows = spark.range(9000).selectExpr("'f' file_nm", "if(id % 3 = 0, '7', cast(id as string)) k")
    parent = spark.range(4000).withColumnRenamed("id", "key_id")
    got = checks.orphan_counts(rows, F.col("k"), parent, "key_id").first()["orphans"]
    assert got == sum(1 for i in range(9000) if i % 3 and i >= 4000)
