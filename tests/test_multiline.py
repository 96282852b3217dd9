"""Multi-line CSV files cut anywhere, against Spark's reader where quotes are proper, and against a character by character reading."""

import random

import pytest

from rawgate.sources import csvfiles
from rawgate.sources.multiline import multiline_records


@pytest.fixture
def splits(spark):
    def of(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")

    yield of
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def rows(df):
    cols = df.select("file_nm", "n_fields", "malformed", "cells").collect()
    return sorted((r["file_nm"], r["n_fields"], r["malformed"], tuple(str(c) for c in r["cells"])) for r in cols)


def csv_text(seed, escape, crlf=False):
    rng = random.Random(seed)
    parts = ["a", "é", " ", "\n", "\n\n", "|", "zz" * 40, '"', "\r\n" if crlf else "\n"]
    out = []
    for i in range(400):
        cell = "".join(rng.choices(parts, k=rng.randint(0, 9)))
        if i % 97 == 5:
            cell += "long\n" * 900
        body = cell.replace("\\", "\\\\") if escape == "\\" else cell
        quoted = '"' + body.replace('"', escape + '"') + '"'
        extra = "|more" if i % 31 == 7 else ""
        plain = ["x", '5" pipe', '""'][i % 3]
        out.append(f"{i}|{quoted}|{plain}{extra}")
    end = "\r\n" if crlf else "\n"
    return end.join(out) + end


@pytest.mark.parametrize("escape, crlf", [('"', False), ("\\", False), ('"', True)])
def test_proper_files_as_spark_reads_them(spark, landing, splits, escape, crlf):
    splits(2000)
    folder = landing(a__csv=csv_text(1, escape, crlf), b__csv=csv_text(2, escape, crlf), c__csv="1|plain|x\n")
    whole = csvfiles.read_csv_records(spark, folder, 3, "|", escape=escape, multi_line=True)
    split = multiline_records(spark, [folder], 3, "|", escape=escape)
    assert rows(split) == rows(whole)
    ids = [int(r["ident"]) for r in split.filter("file_nm = 'a.csv'").orderBy("block", "line_id").collect()]
    assert ids == list(range(400))


def read(text, quote='"', sep="|", escape='"', max_chars=10**9):
    """[(text, malformed)] of the records, one character at a time."""
    lines = text.split("\n")
    if lines and lines[-1] == "":
        lines.pop()

    def scan(line, inside):
        """(ends inside, text behind a closing quote)"""
        state, bad, i = ("Q" if inside else "S"), False, 0
        while i < len(line):
            c = line[i]
            if state == "Q":
                if escape != quote and c == escape:
                    i += 1
                elif c == quote:
                    if escape == quote and line[i + 1 : i + 2] == quote:
                        i += 1
                    else:
                        state = "E"
            elif c == sep:
                state = "S"
            elif state == "S" and c == quote:
                state = "Q"
            else:
                bad |= state == "E" and not (c == "\r" and i == len(line) - 1)
                state = "X" if state == "E" and c != "\r" else ("U" if state == "S" else state)
            i += 1
        return state == "Q", bad

    out, at = [], 0
    while at < len(lines):
        inside, bad, stop = False, False, at
        while True:
            inside, worse = scan(lines[stop], inside)
            bad |= worse
            stop += 1
            if not inside or stop == len(lines):
                break
        if inside or (stop - at > 1 and sum(len(x) + 1 for x in lines[at:stop]) > max_chars):
            for i in range(at, stop):
                ends, improper = scan(lines[i], False)
                out.append((lines[i], improper or ends or i == at))
        else:
            out.append(("\n".join(lines[at:stop]), bad))
        at = stop
    clean = [(t.replace("\r\n", "\n").removesuffix("\r"), b) for t, b in out]
    return [(t, b) for t, b in clean if t]


@pytest.mark.parametrize("size", [1_000, 1 << 30])
@pytest.mark.parametrize("escape", ['"', "\\"])
def test_dirty_files_are_read_alike_at_every_cut(spark, landing, splits, size, escape):
    rng = random.Random(9)
    pieces = ["a", "|", '"', "\n", '|"', '"|', '""', "\r\n", "\r", "é", "word " * 20, "|\n", '"\n', "\\", '\n"x"y|z\n', '|"open\n']
    weights = [9, 9, 2, 6, 2, 2, 1, 2, 1, 3, 9, 3, 3, 0.3 if escape == "\\" else 1, 1, 0.2]
    files = {f"f{i}__csv": "".join(rng.choices(pieces, weights, k=rng.choice([0, 5, 40, 900]))) for i in range(24)}
    files["last__csv"] = csv_text(3, escape) + '7|"never closed|x\n' + "8|plain|y\n9|z" * 50
    folder = landing(**files)
    splits(size)
    for limit in (10**9, 400):
        found = multiline_records(spark, [folder], 3, "|", escape=escape, max_chars=limit)
        got = {}
        for r in sorted(found.collect(), key=lambda r: (r["block"], r["line_id"])):
            got.setdefault(r["file_nm"], []).append((r["value"], r["malformed"], len(r["cells"])))
        for name, text in files.items():
            want = read(text, escape=escape, max_chars=limit)
            have = got.get(name.replace("__", "."), [])
            assert len(have) == len(want), name
            for (value, malformed, n), (record, bad) in zip(have, want, strict=True):
                assert n == 3
                # the number of cells may be wrong too; where it is, the text is kept as well
                assert malformed or not bad, record
                assert value == (record if malformed else None)


def test_one_stray_quote_costs_few_records(spark, landing, splits):
    """A quote that should not be there: what stands behind it in proper quotes is found again."""
    splits(1_000)
    good = [f'{i}|"text {i}\nsecond line"|x' for i in range(300)]
    dirty = good[:100] + ['100|"stray|x', *good[101:]]
    found = multiline_records(spark, [landing(a__csv="\n".join(dirty) + "\n")], 3, "|")
    ids = {int(r["ident"]) for r in found.filter("NOT malformed").collect() if r["ident"].isdigit()}
    assert {i for i in range(300)} - ids <= {100, 101, 102}


def test_unclosed_quote_at_the_end(spark, landing):
    found = multiline_records(spark, [landing(a__csv='1|"a\nb"|x\n2|"open|y\n3|c|z\nT|3|\n')], 3, "|")
    got = [(r["ident"], r["malformed"]) for r in found.orderBy("block", "line_id").collect()]
    assert [g for g in got if not g[1]] == [("1", False), ("3", False), ("T", False)]
    assert sum(m for _, m in got) == 1


def test_lone_carriage_return_is_a_character(spark, landing):
    found = multiline_records(spark, [landing(a__csv="1|a\rb|c\r\n2|d|e\n")], 3, "|")
    assert [r["cells"] for r in found.orderBy("line_id").collect()] == [["1", "a\rb", "c"], ["2", "d", "e"]]


def test_gzip_and_empty(spark, tmp_path):
    import gzip

    (tmp_path / "a.csv.gz").write_bytes(gzip.compress(b'1|"a\nb"|x\n\n'))
    (tmp_path / "e.csv").write_text("")
    found = multiline_records(spark, [str(tmp_path)], 3, "|")
    assert [(r["file_nm"], r["cells"]) for r in found.collect()] == [("a.csv.gz", ["1", "a\nb", "x"])]
