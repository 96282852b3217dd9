"""File-level checks: rules, measures, outcomes.

All measures of all files come from a few aggregates. A check is then one
expression over a row of measures, and the rule that nothing runs after the
first failure is a window over the rules of a file.

A check may bring aggregates of its own over the rows of a file, and lookups of
its own (`Check`). The aggregates of all rules are merged into one pass over the
rows, those of the built-in checks too.

The bodies of the five named checks are our own definitions; replace them
through `CHECKS`.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PASS, FAIL, WAITING, SKIPPED = "Pass", "Fail", "Waiting", "Skipped"
# fifteen places, so that amounts are added as they are written
AMOUNT = "decimal(38,15)"


@dataclass(frozen=True)
class Rule:
    """One rule of a prefix; `seq` numbers the rules in the order they apply."""

    seq: int
    check: str
    argument: str
    threshold: str | None = None

    def part(self, i: int) -> str:
        """The i-th comma-separated part of the argument, or blank."""
        parts = [p.strip() for p in (self.argument or "").split(",")]
        return parts[i] if i < len(parts) else ""


def rule_list(checklist: DataFrame) -> DataFrame:
    """Rules per prefix in order: priority as a number, its text as tie-break,
    without repetitions of (type, arguments, priority)."""
    rules = checklist.select(
        F.lower("file_prefix_nm").alias("file_prefix_nm"),
        "file_chck_typ",
        F.coalesce("arguments", F.lit("")).alias("arguments"),
        "priority",
        "threshold_pre",
    ).dropDuplicates(["file_prefix_nm", "file_chck_typ", "arguments", "priority"])
    order = Window.partitionBy("file_prefix_nm").orderBy(
        F.col("priority").try_cast("int").asc_nulls_last(), "priority", "file_chck_typ", "arguments"
    )
    return rules.withColumn("seq", F.row_number().over(order))


def rules_of(checklist: DataFrame) -> list[Rule]:
    """The rules of one prefix as Python objects: control data of a few rows."""
    rows = rule_list(checklist).orderBy("seq").collect()
    return [Rule(r["seq"], r["file_chck_typ"], r["arguments"], r["threshold_pre"]) for r in rows]


# ---- measures --------------------------------------------------------------


def declared(field: str, default: int) -> Column:
    """A number of the trailer, by 1-based field; without identifiers the
    fields start one place earlier."""
    index = F.lit(int(field) - 1) if field else F.lit(default - 1) - F.col("no_ident").cast("int")
    return F.trim(F.get("trailer", index)).try_cast(AMOUNT)


def row_count_check(rule: Rule) -> Column:
    """Trailer count equals good plus bad data rows."""
    same = declared(rule.argument, 2) == (F.col("n_good") + F.col("n_bad")).cast(AMOUNT)
    return F.when(same, PASS).otherwise(FAIL)


def file_content_check(rule: Rule) -> Column:
    """H and T rows as the format says and at least one data row; without
    identifiers at least one line more than header and trailer."""
    with_ident = (
        (F.col("n_head") == F.col("fmt_head"))
        & (F.col("n_trail") == F.col("fmt_tail"))
        & (F.col("n_data") >= 1)
    )
    plain = F.col("n_lines") >= F.col("fmt_head") + F.col("fmt_tail") + 1
    return F.when(F.when(F.col("no_ident"), plain).otherwise(with_ident), PASS).otherwise(FAIL)


def sum_check(rule: Rule) -> Column:
    """Sum of a column (`column[,trailer field]`) equals the trailer's total."""
    total = F.coalesce(F.col(_measure_name(rule, "sum")), F.lit(0).cast(AMOUNT))
    return F.when(total == declared(rule.part(1), 3), PASS).otherwise(FAIL)


def row_variance_check(rule: Rule) -> Column:
    """Row count within `threshold` percent of the run before; skipped without one."""
    n, before = F.col("n_good") + F.col("n_bad"), F.col("prev_count")
    moved = F.abs(n - before).cast("double") * 100
    within = moved <= F.lit(float(rule.threshold or 0)) * before
    return F.when(before.isNull() | (before == 0), SKIPPED).when(within, PASS).otherwise(FAIL)


def integrity_check(rule: Rule) -> Column:
    """No child key without a parent; waits while the parent has no rows."""
    return (
        F.when(~F.col(f"parent_ready_{rule.seq}"), WAITING)
        .when(F.col(f"orphans_{rule.seq}") == 0, PASS)
        .otherwise(FAIL)
    )


Measures = Mapping[str, Column]


@dataclass(frozen=True)
class Check:
    """A check that brings what it looks at.

    `outcome(rule, measures)` gives Pass, Fail, Waiting or Skipped from the
    columns of a file and the check's own measures. `measures(rule, good)` names
    aggregates over the rows of a file; `good` is true for rows without a fault.
    An aggregate must be mergeable, and choose its own bound. `lookup(files,
    rows, rule)` returns files with further columns, for what is no aggregate of
    the file's rows (another table); the columns are told apart by `rule.seq`.
    """

    outcome: Callable[[Rule, Measures], Column]
    measures: Callable[[Rule, Column], Measures] = field(default=lambda rule, good: {})
    lookup: Callable[[DataFrame, DataFrame, Rule], DataFrame] | None = None


def sum_measure(rule: Rule, where: Column) -> Column:
    """Sum of the rule's column over the rows of a file that satisfy `where`."""
    amount = F.trim(F.col(f"`{rule.part(0).upper()}`")).try_cast(AMOUNT)
    return F.coalesce(F.sum(F.when(where, amount)), F.lit(0).cast(AMOUNT)).alias(f"sum_{rule.seq}")


CHECKS: dict[str, Callable[[Rule], Column] | Check] = {
    "rowcountcheck": row_count_check,
    "filecontentcheck": file_content_check,
    "sumcheckvalidation": Check(lambda rule, _: sum_check(rule), lambda rule, good: {"sum": sum_measure(rule, good)}),
    "rowcountvariancecheck": row_variance_check,
    "integritycheck": integrity_check,
}

Checks = Mapping[str, Callable[[Rule], Column] | Check]


def _measure_name(rule: Rule, name: str) -> str:
    return f"{name}_{rule.seq}"


def _own(rules: Sequence[Rule], checks: Checks) -> list[tuple[Rule, Check]]:
    return [(r, c) for r in rules if isinstance(c := checks.get(r.check.lower()), Check)]


def measures_of(rules: Sequence[Rule], good: Column, checks: Checks = CHECKS) -> list[Column]:
    """The aggregates that the checks of all rules ask for, to be computed together."""
    return [m.alias(_measure_name(r, name)) for r, c in _own(rules, checks) for name, m in c.measures(r, good).items()]


def with_measures(files: DataFrame, data: DataFrame, rules: Sequence[Rule], checks: Checks = CHECKS) -> DataFrame:
    """Files with n_good, n_bad and every measure of the rules: one aggregate over `data`
    (file_nm, `reason` of bad rows, columns), then the lookups that checks bring."""
    good = F.col("reason").isNull()
    counted = data.groupBy("file_nm").agg(F.count_if(good).alias("n_good"), F.count_if(~good).alias("n_bad"), *measures_of(rules, good, checks))
    out = files.join(counted, "file_nm", "left").na.fill(0, ["n_good", "n_bad"])
    for rule, check in _own(rules, checks):
        if check.lookup is not None:
            out = check.lookup(out, data, rule)
    return out


def previous_counts(runs: DataFrame) -> DataFrame:
    """Each run with the row count of the prefix's run before it."""
    order = Window.partitionBy("file_prefix_nm").orderBy("snap_dt", "run_id")
    return runs.withColumn("prev_count", F.lag("row_count").over(order))


def latest_before(files: DataFrame, history: DataFrame) -> DataFrame:
    """(file_nm, prev_count): row count of the latest run of the prefix before
    the file's own run. Both sides hold run keys and counts only."""
    key = [F.lower("file_prefix_nm").alias("file_prefix_nm"), "snap_dt", "run_id"]
    runs = history.select(*key, "row_count").unionByName(files.select(*key), allowMissingColumns=True)
    counted = runs.groupBy("file_prefix_nm", "snap_dt", "run_id").agg(F.max("row_count").alias("row_count"))
    before = (
        Window.partitionBy("file_prefix_nm").orderBy("snap_dt", "run_id").rowsBetween(Window.unboundedPreceding, -1)
    )
    known = counted.withColumn("prev_count", F.last("row_count", ignorenulls=True).over(before)).drop("row_count")
    return files.select("file_nm", *key).join(known, ["file_prefix_nm", "snap_dt", "run_id"]).select("file_nm", "prev_count")


def orphan_counts(rows: DataFrame, child: Column, parent: DataFrame, parent_col: str) -> DataFrame:
    """Rows per file whose key has no parent.

    Keys are compared as values of the parent's type, without blanks around
    them; text that is no such value has no parent. A parent with `snap_dt` is
    compared by snapshot, where the rows have one. Keys are counted per file
    before anything is joined, so a key that holds a third of all rows is one
    row when it meets the parent.
    """
    by_snapshot = ["snap_dt"] if "snap_dt" in parent.columns and "snap_dt" in rows.columns else []
    known = parent.select(F.col(parent_col).alias("key"), *by_snapshot)
    kind = known.schema["key"].dataType.simpleString()
    text = F.trim(child.cast("string"))
    given = F.coalesce(text.try_cast(kind).cast("string"), F.concat(F.lit("?"), text)) if kind != "string" else text
    keys = rows.select("file_nm", *by_snapshot, given.alias("key")).filter(text != "")
    per_key = keys.groupBy("file_nm", *by_snapshot, "key").agg(F.count("*").alias("n"))
    parents = known.withColumn("key", F.trim(F.col("key").cast("string"))).distinct()
    return per_key.join(parents, ["key", *by_snapshot], "left_anti").groupBy("file_nm").agg(F.sum("n").alias("orphans"))


def parent_ready(files: DataFrame, parent: DataFrame | None, name: str) -> DataFrame:
    """Files with the flag `name`: whether the parent is there and has rows (of the file's snapshot, if it has snapshots)."""
    if parent is None:
        return files.withColumn(name, F.lit(False))
    if "snap_dt" not in parent.columns:
        return files.withColumn(name, F.lit(bool(parent.take(1))))
    there = parent.select("snap_dt").distinct().withColumn(name, F.lit(True))
    return files.join(there, "snap_dt", "left").na.fill(False, [name])


# ---- outcomes --------------------------------------------------------------


def _check_of(rule: Rule, checks: Checks) -> Column:
    """The check's expression; a name that nobody has registered fails its files and no others."""
    check = checks.get(rule.check.lower())
    if check is None:
        return F.lit(FAIL)
    if not isinstance(check, Check):
        return check(rule)
    names = check.measures(rule, F.lit(True))
    return F.coalesce(check.outcome(rule, {name: F.col(_measure_name(rule, name)) for name in names}), F.lit(FAIL))


def run_rules(files: DataFrame, rules: list[Rule], checks: Checks = CHECKS) -> DataFrame:
    """Files with `results`, an array of (seq, check, outcome, status) in the
    order of the rules, and the flags `failed` and `waiting`.

    `outcome` is what the check says by itself. `status` is `Skipped` after
    the first rule that failed or waits. One projection, nothing is shuffled.
    """
    ordered = sorted(rules, key=lambda r: r.seq)
    judged = files.withColumns({f"_rule_{r.seq}": _check_of(r, checks) for r in ordered}) if ordered else files
    stopped, results = F.lit(False), []
    for r in ordered:
        outcome = F.col(f"_rule_{r.seq}")
        results.append(
            F.struct(
                F.lit(r.seq).alias("seq"),
                F.lit(r.check).alias("check"),
                outcome.alias("outcome"),
                F.when(stopped, SKIPPED).otherwise(outcome).alias("status"),
            )
        )
        stopped = stopped | outcome.isin(FAIL, WAITING)
    kind = "array<struct<seq:int,check:string,outcome:string,status:string>>"
    done = judged.withColumn("results", F.array(*results).cast(kind))
    return done.withColumns(
        {
            "failed": F.exists("results", lambda r: r["status"] == FAIL),
            "waiting": F.exists("results", lambda r: r["status"] == WAITING),
        }
    ).drop(*[f"_rule_{r.seq}" for r in ordered])


def evaluate(files: DataFrame, rules: list[Rule], checks: Checks = CHECKS) -> DataFrame:
    """(file_nm, seq, check, outcome, status), one row per file and rule."""
    return run_rules(files, rules, checks).select("file_nm", F.explode("results").alias("r")).select("file_nm", "r.*")


def short_circuit(results: DataFrame) -> DataFrame:
    """The same for outcomes that come as rows: `Skipped` for every rule after
    the first that failed or waits. The window holds the rules of one file."""
    before = Window.partitionBy("file_nm").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    stopped = F.coalesce(F.max(F.col("outcome").isin(FAIL, WAITING)).over(before), F.lit(False))
    return results.withColumn("status", F.when(stopped, SKIPPED).otherwise(F.col("outcome")))


def status_entries(check: Column, status: Column) -> Column:
    """array of (action_type, action_typ_details, status) for one rule: its
    own entry, and a file transfer after a failure."""

    def entry(action: str, value: Column) -> Column:
        return F.struct(
            F.lit(action).alias("action_type"), check.alias("action_typ_details"), value.alias("status")
        )

    own = entry("Filelevelcheck", status)
    return F.when(status == FAIL, F.array(own, entry("FileTransfer", F.lit(PASS)))).otherwise(F.array(own))


def outcome_status(outcomes: DataFrame) -> DataFrame:
    """(file_nm, seq, action_type, action_typ_details, status) for outcomes as rows."""
    rows = F.explode(status_entries(F.col("check"), F.col("status"))).alias("r")
    return outcomes.select("file_nm", "seq", rows).select("file_nm", "seq", "r.*")


def file_verdict(outcomes: DataFrame) -> DataFrame:
    """Per file: `failed` and `waiting`."""
    return outcomes.groupBy("file_nm").agg(
        F.max(F.col("status") == FAIL).alias("failed"),
        F.max(F.col("status") == WAITING).alias("waiting"),
    )


def waiting_files(outcomes: DataFrame) -> DataFrame:
    return file_verdict(outcomes).filter(F.col("waiting")).select("file_nm")


def passing_files(files: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Files with no failed or waiting rule; a file without rules passes."""
    stopped = file_verdict(outcomes).filter(F.col("failed") | F.col("waiting"))
    return files.join(stopped, "file_nm", "left_anti")


def files_with_checks(files: DataFrame, checklist: DataFrame) -> DataFrame:
    """Pending files with the types of their checks; files without any are kept."""
    checks = checklist.select("file_prefix_nm", "file_chck_typ")
    return files.join(checks, "file_prefix_nm", "left").select(
        "src_sys_nm", "file_prefix_nm", "file_nm", "file_chck_typ", "snap_dt", "run_id"
    )
