"""Intake of all pending files of one prefix in one plan.

    lines of all files -> parsed once, staged -> counts per file -> layouts
    -> header match -> good rows | quarantine -> measures per file -> rules
    -> accepted files -> stamped, obfuscated, cast rows -> partitioned table

Rows are parsed and written to the shared staging folder once; what follows
reads that table (columns it needs only). No step loops over files, and no data
row reaches the driver: it sees the configuration of the prefix and the names
and sizes of files.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from rawgate import model
from rawgate.functions.cleaning import clean_cell, drop_all_null, remove_chars
from rawgate.functions.delimiters import content_format
from rawgate.functions.headers import normalise_header, pick_positions, schema_match, slice_text
from rawgate.functions.obfuscation import obfuscate
from rawgate.joins import fits_broadcast, join_per_file
from rawgate.operators import checks as ck
from rawgate.operators import enrich, publish, records, rows, schema
from rawgate.session import registered_staging, remove, stage, tune
from rawgate.sources import control as ct
from rawgate.sources import csvfiles, lines, listing, multiline, xmlfiles

FILE_KEYS = ["file_nm", "src_sys_nm", "file_prefix_nm", "snap_dt", "run_id"]

# a position before every record
BEFORE_ALL = "named_struct('block', -1L, 'line_id', -1L)"


@dataclass
class IntakeOptions:
    """What is not in the control tables.

    `parents` holds the parent tables of integrity checks by name, with the
    rows of the snapshot, or of several with `snap_dt`; others are read from the
    catalog, and files wait for a table that is not there. `checks` are checks by
    name (lower case) beside those of `checks.CHECKS`, or in their place. `positional` cuts
    rows by place even where the header has additional columns. `keep_bad`
    publishes bad rows too. `folders` says that each file is a folder of parts.
    `target_table` is a table of the catalog; if it is there, its columns give
    the final names (unless `target_columns` does).
    """

    src_sys_nm: str | None = None
    dq_flag: int | str | None = 0
    obfuscation_key: bytes | None = None
    target_columns: list[str] | None = None
    target_table: str | None = None
    parents: Mapping[str, DataFrame] = field(default_factory=dict)
    checks: ck.Checks = field(default_factory=dict)
    keep_bad: bool = False
    positional: bool = False
    folders: bool = False


@dataclass
class IntakeResult:
    """Frames of one run; all read staged tables, so each can be written on its own.

    `rows` and `bad_rows` are `published` and `quarantine` with the file and run
    they belong to. `bad_row_report` has the number of bad rows per file and the
    first ten, `obfuscation_log` a row per loaded file if columns were obfuscated,
    `row_counts` the number of rows of each accepted file, for later runs to compare with.
    """

    published: DataFrame
    quarantine: DataFrame
    statuses: DataFrame
    files: DataFrame
    schema_failures: DataFrame
    route: str
    part_files: bool
    target: str
    rows: DataFrame
    bad_rows: DataFrame
    bad_row_report: DataFrame
    obfuscation_log: DataFrame
    row_counts: DataFrame
    keeps_bad: bool = False
    staged: list[str] = field(default_factory=list)

    def write(self, base: str) -> None:
        """Publish (or leave for the quality step), then quarantine, reports and statuses.

        Everything but the status log lies under snapshot, run and file: a
        repeated run replaces its own files and leaves all others alone. Rows are
        counted while they are written; if they are not those that the checks have
        counted, publishing has failed in the log, and the files stay pending.
        """
        folder = self.target if self.route == "publish" else f"{self.target}_dq_input"
        published, written = rows.counted(self.rows, "published")
        publish.publish(published, f"{base}/{folder}")
        set_aside, rejected = rows.counted(self.bad_rows, "quarantined", F.col("reason") == "cast")
        publish.publish(set_aside, f"{base}/quarantine")
        publish.publish(self.schema_failures, f"{base}/schema_failures")
        publish.publish(self.bad_row_report, f"{base}/bad_row_report")
        publish.publish(self.obfuscation_log, f"{base}/obfuscation_log")
        publish.publish(self.row_counts, f"{base}/row_count_history")
        statuses = self.statuses
        if not self.keeps_bad and not self._agrees(written.get["rows"] or 0, rejected.get["rows"] or 0):
            lost = F.col("action_type").isin("PublishToStage") | F.col("action_typ_details").isin("DqInputCopy")
            statuses = statuses.withColumn("status", F.when(lost, "Fail").otherwise(F.col("status")))
        publish.append_status(statuses, f"{base}/status")

    def _agrees(self, written: int, rejected: int) -> bool:
        """Whether the rows that were written, and those that the casts set aside, are the good rows that the checks have counted."""
        known = self.files.filter("disposition = 'accepted'").agg(F.sum("n_good").alias("n")) if "n_good" in self.files.columns else None
        expected = 0 if known is None else known.collect()[0]["n"] or 0
        return written + rejected == expected

    def close(self) -> None:
        """Remove what the run has staged; its frames cannot be read any more."""
        remove(self.published.sparkSession, self.staged)
        self.staged.clear()

    def __enter__(self) -> IntakeResult:
        return self

    def __exit__(self, *_: object) -> None:
        self.close()

    def write_table(self, table: str, rejects: str | None = None) -> None:
        """Publish to a table of the catalog, which is made if it is not there.

        One that is there keeps its types: values are converted, and rows with
        one that does not fit go to the folder `rejects`, under snapshot, run and
        file. Without a folder they are an error, and nothing is written.
        """
        spark = self.rows.sparkSession
        if not spark.catalog.tableExists(table):
            publish.publish_table(self.rows, table)
            return
        target = spark.table(table).schema
        named = "file_nm" in target.names
        good, bad = publish.reconcile(self.rows if named else self.rows.drop("file_nm"), target)
        if rejects is None:
            if bad.take(1):
                raise ValueError(f"rows do not fit the types of {table}; name a folder for them")
        else:
            _, bad = publish.reconcile(self.rows, target if named else StructType([*target.fields, StructField("file_nm", StringType())]))
            publish.publish(bad, rejects)
        publish.publish_table(good, table)


@dataclass
class _Prefix:
    """Configuration of one prefix: one row of control data."""

    conf: Row
    names: list[str]
    name_lengths: list[int]
    lengths: list[int]
    types: list[str]
    obfuscated: list[str]
    rules: list[ck.Rule]
    n_head: int
    n_tail: int
    no_ident: bool
    mode: str
    settings: Row | None
    clean: Row | None
    pairs: list[tuple[str, str]]
    dated: list[Row] = field(default_factory=list)

    def problem(self, opt: IntakeOptions) -> str | None:
        """Name of the step that the settings make impossible."""
        if self.obfuscated and not opt.obfuscation_key:
            return "ObfuscationKey"  # never in clear text
        if self.mode == "multiline" and not self.settings["total_column"]:
            return "MultiLineProcesssing"
        if self.clean is not None and (
            self.clean["type"] not in ("automated", "manual") or not self.clean["total_column"]
        ):
            return "DataCleanProcess"
        return None

    @property
    def intraday(self) -> bool:
        return self.conf["intraday_flag"] == "y"

    @property
    def casting(self) -> bool:
        return self.conf["typecasting_flag"] == "Y"

    @property
    def header_expected(self) -> bool:
        return self.conf["col_header_flag"] == "Y"


def _read_prefix(control: ct.ControlTables, prefix: str, src: str | None) -> _Prefix:
    """Four small reads, one per control table."""
    expected = ct.with_defaults(ct.for_prefix(control.expected_files, prefix))
    confs = (expected.filter(F.col("src_sys_nm") == src) if src else expected).collect()
    registered = ct.expected_columns(ct.for_prefix(control.file_schema, prefix)).collect()
    if not confs or not registered:
        raise ValueError(f"prefix {prefix!r} is not registered")
    if len(set(confs)) > 1:
        raise ValueError(f"prefix {prefix!r} has several configurations; name one source in IntakeOptions.src_sys_nm")
    conf, cols = confs[0], registered[0]
    checklist = ck.rule_list(ct.for_prefix(control.checklist, prefix))
    listed = checklist.withColumn("fmt", content_format(F.col("arguments"))).orderBy("seq").collect()
    formats = [r["fmt"] for r in listed if r["file_chck_typ"].lower() == "filecontentcheck"]
    mapped = ct.mapping_of(control.mapping, prefix)
    fixed = conf["fixed_width"]
    return _Prefix(
        conf=conf,
        names=list(cols["names"]),
        name_lengths=list(cols["name_lengths"]),
        lengths=[n or 0 for n in cols["lengths"]],
        types=list(cols["types"]),
        obfuscated=[n for n, o in zip(cols["names"], cols["obfuscate"], strict=True) if o],
        rules=[ck.Rule(r["seq"], r["file_chck_typ"], r["arguments"], r["threshold_pre"]) for r in listed],
        n_head=formats[0]["n_head"] if formats else 0,
        n_tail=formats[0]["n_tail"] if formats else 0,
        no_ident=formats[0]["no_ident"] if formats else False,
        mode="fixed_width" if fixed else mapped.mode,
        settings=mapped.settings.get(mapped.mode),
        clean=None if fixed else mapped.settings.get("clean"),
        pairs=mapped.pairs,
    )


# ---- reading ---------------------------------------------------------------


def _read_records(spark: SparkSession, p: _Prefix, paths: list[tuple[str, int]], opt: IntakeOptions) -> DataFrame:
    """Records of all files (path and size), whatever their form."""
    if not paths:
        return spark.createDataFrame([], model.RECORD)
    names = [path for path, _ in paths]
    if p.mode == "fixed_width":
        return lines.fixed_width_records(lines.read_lines(spark, names, opt.folders))
    if p.mode == "xml":
        return xmlfiles.xml_records(spark, names, p.settings["row_tag"] or "row", p.names, opt.folders)
    sep = p.conf["sep"]
    if p.mode in ("multiline", "clean"):
        width, escape, quote = p.settings["total_column"], p.settings["escape"] or '"', p.settings["quote"] or '"'
        if p.mode == "multiline":
            found = multiline.multiline_records(spark, names, width, sep, escape, quote, opt.folders)
        else:
            found = csvfiles.read_csv_records(spark, names, width, sep, escape, quote, folders=opt.folders)
        return _clean_records(found, p)
    gzip = [(path, size) for path, size in paths if path.endswith(".gz")]
    plain = [path for path, _ in paths if not path.endswith(".gz")]
    readers = []
    if plain:
        readers.append(lines.read_lines(spark, plain, opt.folders))
    if gzip:
        size = sum(size for _, size in gzip)
        readers.append(lines.read_gzip_lines(spark, [path for path, _ in gzip], size, opt.folders))
    return lines.delimited_records(publish.status_log(readers), sep)


def _clean_records(found: DataFrame, p: _Prefix) -> DataFrame:
    """Configured cleaning of the cells: dropped fields, removed characters, outer quotes."""
    width = p.settings["total_column"]
    dropped, patterns, keep_quotes = set(), [], False
    if p.clean is not None:
        dropped = {i - 1 for i in (p.clean["drop_field_index"] or [])}
        patterns = list(p.clean["hex_list"] or [])
        keep_quotes = p.clean["quote_flag"] == "Y"
    kept = [i for i in range(width) if i not in dropped]

    def cell(i: int) -> Column:
        text = F.coalesce(F.get("cells", F.lit(i)), F.lit(""))
        return clean_cell(remove_chars(text, patterns), keep_quotes)

    out = found.withColumn("cells", F.array(*[cell(i) for i in kept]))
    return out.withColumns({"ident": F.get("cells", F.lit(0)), "n_fields": F.lit(len(kept))})


# ---- layouts ---------------------------------------------------------------


def _with_layout(files: DataFrame, p: _Prefix) -> DataFrame:
    files = files.withColumns(
        {
            "col_header_flag": F.lit(p.conf["col_header_flag"]),
            "no_ident": F.lit(p.no_ident or p.mode == "xml"),
            "fmt_head": F.lit(0 if p.mode == "xml" else p.n_head),
            "fmt_tail": F.lit(0 if p.mode == "xml" else p.n_tail),
        }
    )
    if p.mode != "xml":
        return records.classify_layout(files, p.mode == "fixed_width")
    # rows come by element: no header or trailer records, no indicator
    return files.withColumns(
        {
            "layout": F.lit("xml"),
            "lead": F.lit(False),
            "header_from": F.lit("none"),
            "header_checked": F.lit(False),
            "keep_all": F.lit(True),
        }
    )


def _edges(found: DataFrame, files: DataFrame, p: _Prefix) -> DataFrame:
    """Files with `line_1`, `line_2`, `head_1`, `head_2` (position and cells, as
    far as the layout asks for them) and the `trailer` cells.

    Positions of first and last records come from the counts, so that only the
    records at these positions, and H and T rows, are looked up.
    """
    none = "struct<pos:struct<block:bigint,line_id:bigint>,cells:array<string>>"
    here = F.struct("block", "line_id").alias("pos")
    parts = []
    if p.mode != "xml":
        first = files.filter(F.col("header_from").startswith("line") | (F.col("no_ident") & (F.col("fmt_head") > 0)))
        first = first.select("file_nm", "first_pos.*", F.lit("line_1").alias("kind"))
        last = files.filter(F.col("no_ident") & (F.col("fmt_tail") == 1))
        positions = first.unionByName(last.select("file_nm", "last_pos.*", F.lit("last").alias("kind")))
        if p.no_ident and p.n_head == 2:
            second = records.head_positions(found, 2).filter("nth = 2")
            positions = positions.unionByName(second.select(*model.POSITION, F.lit("line_2").alias("kind")))
        parts.append(records.at_positions(found, positions).select("file_nm", "kind", here, "cells"))
        if not p.no_ident:
            heads = records.header_rows(found)
            parts.append(heads.select("file_nm", F.concat(F.lit("head_"), "nth").alias("kind"), here, "cells"))
            tails = records.last_trailer(found)
            parts.append(tails.select("file_nm", F.lit("last").alias("kind"), F.expr("NULL").alias("pos"), F.col("trailer").alias("cells")))
    kinds = ("line_1", "line_2", "head_1", "head_2", "last")
    if not parts:
        return files.withColumns({kind: F.lit(None).cast(none) for kind in kinds})
    # at most five rows per file
    edges = publish.status_log(parts).groupBy("file_nm").agg(
        *[F.max(F.when(F.col("kind") == kind, F.struct("pos", "cells"))).alias(kind) for kind in kinds]
    )
    return files.join(edges, "file_nm", "left")


def _layouts(found: DataFrame, manifest: DataFrame, p: _Prefix, positional: bool) -> DataFrame:
    """One row per present file: counts, layout, header, trailer, where its data
    lies, and the place of each registered column in a row."""
    fixed = p.mode == "fixed_width"
    counted = stage(records.with_counts(manifest, records.file_counts(found)), "counts")
    files = _edges(found, _with_layout(counted, p), p)
    trailer = F.col("last.cells")
    if fixed and not p.no_ident:
        text = F.get(trailer, F.lit(0))
        trailer = F.when(text.isNotNull(), F.array(F.substring(text, 1, 1), F.substring(text, F.lit(2), F.length(text))))
    has_tail = F.col("no_ident") & (F.col("fmt_tail") == 1)
    # header lines without an identifier, which data comes after
    skip = (
        F.when(F.col("layout") == "manual", F.lit(0 if fixed else 1)).when(F.col("no_ident"), F.col("fmt_head")).otherwise(0)
    )
    source = F.when(F.col("header_from") == "line_1", F.col("line_1.cells"))
    for name in ("line_2", "head_1", "head_2"):
        source = source.when(F.col("header_from") == name, F.col(f"{name}.cells"))
    files = files.withColumns(
        {
            "header": F.coalesce(source, F.array().cast("array<string>")),
            "trailer": F.when(~F.col("no_ident") | has_tail, trailer),
            "has_tail": has_tail,
            "after": F.when(skip == 1, F.col("line_1.pos")).when(skip == 2, F.col("line_2.pos")).otherwise(F.expr(BEFORE_ALL)),
            # rows that are left: no filter by identifier where there is none
            "n_data": F.when(F.col("keep_all"), F.col("n_lines") - skip - has_tail.cast("int")).otherwise(F.col("n_data")),
        }
    ).drop("line_1", "line_2", "head_1", "head_2", "last")
    return _match_schema(files, p, fixed, positional)


def _match_schema(files: DataFrame, p: _Prefix, fixed: bool, positional: bool) -> DataFrame:
    header, by_line = F.col("header"), F.col("header_from").startswith("line")
    if fixed:
        line = F.get("header", F.lit(0))
        body = F.when(by_line, line).otherwise(F.substring(line, F.lit(2), F.length(line)))
        cut = ct.with_lead(slice_text(body, p.name_lengths), F.col("lead"))
        header = F.when(F.size("header") > 0, cut).otherwise(header)
    else:
        # a header line without identifier has no mark of its own
        header = ct.with_lead(header, F.col("lead") & by_line)
    width, first = len(p.names), F.col("lead").cast("int")
    expected = ct.with_lead(F.array(*[F.lit(n) for n in p.names]), F.col("lead"))
    files = files.withColumns({"header": normalise_header(header, p.pairs), "expected": expected})
    match = F.when(~F.col("header_checked"), "unchecked").otherwise(schema_match(F.col("header"), F.col("expected")))
    by_place = F.transform(F.sequence(F.lit(1), F.lit(width)), lambda i: i + first)
    place = by_place
    if not positional and not fixed:
        pick = pick_positions(F.col("header"), F.col("expected"))
        place = F.when(match == "extra", F.slice(pick, first + 1, width)).otherwise(by_place)
    files = files.withColumns({"match": match, "empty": F.col("n_data") <= 0, "place": place})
    loads = ~F.col("empty") & (F.col("match") != "fail") & (F.col("layout") != "unsupported")
    return files.withColumns({"need": F.array_max("place"), "loads": loads})


# ---- rows ------------------------------------------------------------------

ROW_FACTS = ["file_nm", "lead", "keep_all", "after", "last_pos", "has_tail", "place", "need"]


def _with_hidden(files: DataFrame, p: _Prefix, control: ct.ControlTables) -> DataFrame:
    """Files with `hidden` (names of the columns to obfuscate), `config_snap_dt` and `reset_snap_dt`.

    With dated configurations, those valid at the file's snapshot; else the
    columns that are registered as hidden, from the file's own date.
    """
    if control.obfuscation is None:
        own = {"hidden": F.array(*[F.lit(n) for n in p.obfuscated]).cast("array<string>"), "config_snap_dt": F.col("snap_dt"), "reset_snap_dt": F.col("snap_dt")}
        return files.withColumns(own)
    return enrich.hidden_columns(files, p.dated)


def _hidden_log(loaded: DataFrame, p: _Prefix) -> DataFrame:
    """The log, kept by snapshot, run and file."""
    log = enrich.obfuscation_log(loaded, p.conf["target"], F.col("config_snap_dt"), F.col("reset_snap_dt"))
    parts = F.split("file_info", ";")
    return log.withColumns({"snap_dt": F.get(parts, F.lit(0)), "run_id": F.get(parts, F.lit(1)), "file_nm": F.array_join(F.slice(parts, 3, 1 << 20), ";")})


def _data_rows(found: DataFrame, facts: DataFrame, p: _Prefix, small: bool) -> DataFrame:
    """Data records of the files in `facts`, with `reason` for the bad ones, the
    registered columns as text, and whatever else `facts` has."""
    stamps = [c for c in facts.columns if c not in ROW_FACTS]
    pos = F.struct("block", "line_id")
    # of multi-line files with an indicator only rows marked D are data
    typed = records.is_data(F.col("lead") if p.mode == "multiline" else None)
    data = join_per_file(found, facts, small).filter(
        (F.col("keep_all") | typed)
        & (pos > F.col("after"))
        & ~(F.col("has_tail") & (pos == F.col("last_pos")))
    )
    keep = [*model.POSITION, "line", "reason", *stamps]
    if p.mode == "fixed_width":
        line = F.get("cells", F.lit(0))
        text = F.when(F.col("lead"), F.substring(line, F.lit(2), F.length(line))).otherwise(line)
        marked = data.withColumn("_text", text).withColumns(
            {"line": line, "reason": rows.length_reason(F.col("_text"), sum(p.lengths))}
        )
        return schema.fixed_width_columns(marked, F.col("_text"), p.names, p.lengths, keep)
    marked = data.withColumns(
        {"line": lines.original_line(p.conf["sep"] or ""), "reason": rows.width_reason(F.col("need"))}
    )
    return schema.project_expected(marked, p.names, keep, F.col("place"))


def _measures(data: DataFrame, files: DataFrame, p: _Prefix, control: ct.ControlTables, opt: IntakeOptions) -> DataFrame:
    """Files with everything the rules of the prefix look at."""

    def rules(name: str) -> list[ck.Rule]:
        return [r for r in p.rules if r.check.lower() == name]

    good = F.col("reason").isNull()
    out = ck.with_measures(files, data, p.rules, _checks(opt))
    if rules("rowcountvariancecheck"):
        history = ct.for_prefix(control.row_count_history, p.conf["file_prefix_nm"])
        out = out.join(ck.latest_before(out, history), "file_nm", "left")
    for r in rules("integritycheck"):
        child, parent_column = (s.strip() for s in r.argument.split("=", 1))
        table, column = parent_column.rsplit(".", 1)
        parent, spark = opt.parents.get(table), data.sparkSession
        if parent is None and spark.catalog.tableExists(table):
            parent = spark.table(table)
        out = ck.parent_ready(out, parent, f"parent_ready_{r.seq}")
        if parent is None:
            out = out.withColumn(f"orphans_{r.seq}", F.lit(0).cast("bigint"))
            continue
        orphans = ck.orphan_counts(data.filter(good), F.col(f"`{child.upper()}`"), parent, column)
        out = out.join(orphans.withColumnRenamed("orphans", f"orphans_{r.seq}"), "file_nm", "left").na.fill(0, [f"orphans_{r.seq}"])
    return out


def _checks(opt: IntakeOptions) -> ck.Checks:
    return {**ck.CHECKS, **opt.checks}


def _judge(measured: DataFrame, p: _Prefix, opt: IntakeOptions) -> DataFrame:
    """Files with rule results and their disposition."""
    done = ck.run_rules(measured, p.rules, _checks(opt))
    no_stamp = F.col("loads") & F.col("snap_dt_ts").isNull() & F.lit(p.intraday)
    return done.withColumns(
        {
            "no_stamp": no_stamp,
            "disposition": publish.disposition(
                missing=F.lit(False),
                empty=F.col("empty"),
                schema_fail=~F.col("loads"),
                failed=F.col("failed") | no_stamp,
                waiting=F.col("waiting"),
            ),
        }
    )


def _statuses(judged: DataFrame, p: _Prefix, route: str) -> DataFrame:
    empty, accepted = F.col("empty"), F.col("disposition") == "accepted"
    unsupported = ~empty & (F.col("layout") == "unsupported")
    mismatch = ~empty & (F.col("match") == "fail")
    check, move = "Filelevelcheck", "FileTransfer"
    before = [
        publish.event(empty, check, "Emptyfilecheck", "Fail"),
        publish.event(empty, move, "EmptyfileTransfer", "Pass"),
        publish.event(unsupported, check, "Unsupported content format", "Fail"),
        publish.event(mismatch, check, "Schemavalidation", "Fail"),
        publish.event(mismatch, move, "Schemavalidation", "Pass"),
        publish.event(F.col("loads") & (F.col("n_bad") > 0), check, "IndividualRowLength", "Fail"),
    ]
    if p.casting:
        typed = publish.event(accepted, "DataTypeCheck", "DataTypeHandling", "Pass")
    elif route == "publish":
        typed = publish.event(accepted, "DataTypeCheck", "TypeCastingSkipped", "Pass")
    else:
        typed = publish.event(accepted, "DataTypeCheck", "DqInputCopy", "Pass")
    after = [
        publish.event(F.col("no_stamp"), check, "Intradaystamp", "Fail"),
        publish.event(accepted, check, "Parquetconversion", "Pass"),
        publish.event(accepted & (F.size("hidden") > 0), "OBFUSCATION_COMPLETED", "", "Pass"),
        typed,
        publish.event(accepted & F.lit(route == "publish"), "PublishToStage", "PublishToStage", "Pass"),
    ]
    ruled = F.flatten(F.transform("results", lambda r: ck.status_entries(r["check"], r["status"])))
    entries = F.concat(
        F.array_compact(F.array(*before)),
        F.when(F.col("loads"), ruled).otherwise(F.array()),
        F.array_compact(F.array(*after)),
    )
    return publish.status_events(judged, entries)


def _refused(present: DataFrame, missing: DataFrame, p: _Prefix, route: str, problem: str) -> IntakeResult:
    """Nothing can be read: every file is rejected with the step that failed."""
    spark = present.sparkSession
    named = ", ".join(f"`{n}` string" for n in [*p.names, "snap_dt", "run_id"])
    files = present.select(*FILE_KEYS, F.lit("rejected").alias("disposition"))
    statuses = publish.status_rows(present, "Filelevelcheck", problem, "Fail")
    no_rows = spark.createDataFrame([], f"{named}, file_nm string")
    no_bad = spark.createDataFrame([], "file_nm string, pos struct<block:bigint,id:bigint>, value string, reason string, snap_dt string, run_id string")
    return IntakeResult(
        published=no_rows.drop("file_nm"),
        quarantine=no_bad.drop("snap_dt", "run_id"),
        rows=no_rows,
        bad_rows=no_bad,
        bad_row_report=spark.createDataFrame([], "file_nm string, bad_rows bigint, samples array<string>, snap_dt string, run_id string"),
        obfuscation_log=_hidden_log(present.limit(0).withColumns({"config_snap_dt": F.lit(""), "reset_snap_dt": F.lit("")}), p),
        row_counts=spark.createDataFrame([], f"{model.ROW_COUNT_HISTORY}, file_nm string"),
        statuses=statuses,
        files=files.unionByName(missing.select(*FILE_KEYS, F.lit("missing").alias("disposition"))),
        schema_failures=publish.schema_failures(present.limit(0)),
        route=route,
        part_files=bool(p.conf["part_files"]),
        target=p.conf["target"],
    )


# ---- the run ---------------------------------------------------------------

#: between the name of a file that several runs list and the run, inside a run only
ENTRY_MARK = "\u0001"


def _name_of_entry() -> Column:
    return F.substring_index("file_nm", ENTRY_MARK, 1)


def _entries(present: DataFrame) -> tuple[DataFrame, DataFrame | None, list[tuple[str, int]]]:
    """(manifest rows with a `file_nm` of their own, names that stand for several
    rows or None, paths and sizes of the files to read).

    Everything per file is keyed by `file_nm`. A file that is listed once keeps
    its name; one that several runs or sources list gets a name for each.
    """
    present = present.dropDuplicates(FILE_KEYS)
    rows = present.select("path", "file_size", "file_nm", "snap_dt", "run_id", "src_sys_nm").orderBy("path").collect()
    times: dict[str, int] = {}
    for r in rows:
        times[r["file_nm"]] = times.get(r["file_nm"], 0) + 1
    read = sorted({(lines.literal_path(r["path"]), r["file_size"]) for r in rows if r["file_size"] > 0})
    names = [n for n, k in times.items() if k > 1]
    if not names:
        return present, None, read
    spark = present.sparkSession
    twice = spark.createDataFrame([(n,) for n in names], "file_nm string").withColumn("twice", F.lit(True))
    entry = F.concat_ws(ENTRY_MARK, "file_nm", "snap_dt", "run_id", "src_sys_nm")
    keyed = present.join(twice, "file_nm", "left").withColumn("entry", F.when(F.col("twice"), entry).otherwise(F.col("file_nm")))
    again = keyed.filter("twice").select("file_nm", "entry")
    return keyed.withColumn("file_nm", F.col("entry")).drop("twice", "entry"), again, read


def ingest(
    spark: SparkSession,
    control: ct.ControlTables,
    prefix: str,
    folder: str,
    options: IntakeOptions | None = None,
) -> IntakeResult:
    """Read, check and prepare all pending files of `prefix` that lie in `folder`.

    What the run stages is removed by `IntakeResult.close` (or `with`), and here
    if the run fails.
    """
    with registered_staging() as staged:
        try:
            result = _ingest(spark, control, prefix, folder, options or IntakeOptions())
        except BaseException:
            remove(spark, staged)
            raise
    result.staged = staged
    return result


def _ingest(spark: SparkSession, control: ct.ControlTables, prefix: str, folder: str, opt: IntakeOptions) -> IntakeResult:
    tune(spark)
    p = _read_prefix(control, prefix, opt.src_sys_nm)
    if control.obfuscation is not None:
        dated = ct.for_prefix(control.obfuscation, prefix).collect()
        p.dated = [r for r in dated if r["column_name"].upper() in p.names]
        ever = {r["column_name"].upper() for r in p.dated if r["active"] is not False}
        p.obfuscated = [n for n in p.names if n in ever]
    finished = None if control.statuses is None else ct.finished_files(control.statuses)
    manifest = ct.pending_files(control.manifest, opt.src_sys_nm, prefix, finished)
    listed = listing.list_files(spark, folder)
    missing = listing.missing_files(manifest, listed)
    present = listing.present_files(manifest, listed)
    route = publish.dq_route(opt.dq_flag)
    problem = p.problem(opt)
    if problem:
        return _refused(present, missing, p, route, problem)
    present, again, paths = _entries(present)
    found = _read_records(spark, p, paths, opt)
    if again is not None:
        # a file that several runs list is a file of its own in each
        found = found.join(F.broadcast(again) if len(paths) <= 100_000 else again, "file_nm", "left")
        found = found.withColumn("file_nm", F.coalesce("entry", "file_nm")).drop("entry")
    found = stage(found, "records")

    files = _layouts(found, present, p, opt.positional)
    if p.intraday:
        named = files.withColumns({"entry": F.col("file_nm"), "file_nm": _name_of_entry()})
        files = enrich.intraday_stamp(named, control.file_metadata).withColumn("file_nm", F.col("entry")).drop("entry")
    else:
        files = files.withColumn("snap_dt_ts", F.lit(None).cast("string"))
    files = stage(_with_hidden(files, p, control), "layouts")
    small = fits_broadcast(files)
    run = ["snap_dt", "run_id"]
    data = _data_rows(found, files.filter("loads").select(*ROW_FACTS, *run, "hidden"), p, small)
    judged = stage(_judge(_measures(data, files, p, control, opt), p, opt), "judged")

    stamps = run + (["snap_dt_ts"] if p.intraday else [])
    accepted = judged.filter(F.col("disposition") == "accepted").select(*ROW_FACTS, *stamps, "hidden")
    wanted = F.col("reason").isNull() | F.lit(opt.keep_bad)
    out = _data_rows(found, accepted, p, small).filter(wanted)
    if opt.keep_bad:
        # a good row has text, if blank, in every column
        out = drop_all_null(out, p.names)
    hidden = p.obfuscated

    def shown(line: Column) -> Column:
        """A line; one that may hold a hidden value is obfuscated as a whole."""
        return F.when(F.size("hidden") > 0, obfuscate(line, opt.obfuscation_key)).otherwise(line) if hidden else line

    def set_aside(found_bad: DataFrame) -> DataFrame:
        """Quarantined rows."""
        line = shown(F.col("line"))
        pos = F.struct("block", F.col("line_id").alias("id")).alias("pos")
        return found_bad.select(_name_of_entry().alias("file_nm"), pos, line.alias("value"), "reason", *run)

    refused = data.filter(~wanted)
    bad = set_aside(refused)
    if hidden:
        out = enrich.obfuscate_columns(out, hidden, opt.obfuscation_key, F.col("hidden"))
    if p.casting:
        # a column that is hidden in some file is text in all
        kinds = ["string" if n in hidden else t for n, t in zip(p.names, p.types, strict=True)]
        out, rejects = enrich.cast_with_rejects(out, p.names, kinds)
        bad = bad.unionByName(set_aside(rejects.withColumn("reason", F.lit("cast"))))
    out = out.select(*p.names, *stamps, _name_of_entry().alias("file_nm"))
    final = opt.target_columns
    if final is None and opt.target_table and spark.catalog.tableExists(opt.target_table):
        final = [c for c in publish.table_columns(spark, opt.target_table) if c != "snap_dt_ts"]
    if final:
        out = schema.rename_to_target(out, final)
    sample = shown(F.col("line"))
    report = rows.bad_row_report(refused, sample).join(judged.select("file_nm", *run), "file_nm").withColumn("file_nm", _name_of_entry())
    judged = judged.withColumn("file_nm", _name_of_entry())

    known = judged.select(*FILE_KEYS, "layout", "match", "n_good", "n_bad", "disposition")
    absent = missing.select(*FILE_KEYS, F.lit("missing").alias("disposition"))
    accepted_files = judged.filter(F.col("disposition") == "accepted")
    row_count = (F.col("n_good") + F.col("n_bad")).alias("row_count")
    return IntakeResult(
        published=out.drop("file_nm"),
        quarantine=bad.drop(*run),
        rows=out,
        bad_rows=bad,
        bad_row_report=report,
        obfuscation_log=_hidden_log(accepted_files.filter(F.size("hidden") > 0), p),
        row_counts=accepted_files.select("file_prefix_nm", *run, row_count, "file_nm"),
        statuses=_statuses(judged, p, route),
        files=known.unionByName(absent, allowMissingColumns=True),
        schema_failures=publish.schema_failures(judged.filter(~F.col("empty") & (F.col("match") == "fail"))),
        route=route,
        part_files=bool(p.conf["part_files"]),
        target=p.conf["target"],
        keeps_bad=opt.keep_bad,
    )
