"""XML files cut anywhere, against Spark's reader where it agrees on records, and against a character by character reading."""

import random
import re
from xml.etree import ElementTree

import pytest
from pyspark.sql import functions as F

from rawgate.sources import scan, xmlfiles
from tests.test_multiline import rows, splits  # noqa: F401

COLUMNS = ["A", "B"]


def xml_text(n, extra=""):
    body = "".join(
        f"<row><A>{i}</A><B>{'b' * (i % 60)} &amp; é</B></row>\n" if i % 7 else f'<row>\n <A>{i}</A>\n</row><row/>' for i in range(n)
    )
    return f"<?xml version='1.0'?>\n<!-- made for a test -->\n<rows>\n{body}{extra}</rows>\n"


def test_plain_files_as_spark_reads_them(spark, landing, splits):  # noqa: F811
    splits(2_000)
    folder = landing(a__xml=xml_text(300), b__xml=xml_text(40, "<row><A>q</A><B><![CDATA[<z>]]></B></row>"))
    whole = xmlfiles.read_xml_records(spark, folder, "row", COLUMNS)
    assert rows(xmlfiles.xml_records(spark, [folder], "row", COLUMNS)) == rows(whole)


def read(text):
    """[(A, B) or None for a malformed record], by a reading from front to back."""
    out, at, depth, start = [], 0, 0, None
    token = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<row(?:\s(?:[^<>\"'/]|/(?!>)|'[^']*'|\"[^\"]*\")*)?/?>|</row\s*>", re.S)
    opened = []
    while m := token.search(text, at):
        at = m.end()
        tag = m[0]
        if tag.startswith("<!"):
            continue
        if tag.startswith("</"):
            depth = max(0, depth - 1)
            if depth == 0 and start is not None:
                out.append(text[start:at])
                start = None
        elif tag.endswith("/>"):
            if depth == 0:
                out.append(tag)
        else:
            depth += 1
            if depth == 1:
                start = m.start()
            opened.append(m.start())
    assert start is None

    def cells(record):
        try:
            found = ElementTree.fromstring(record)
        except ElementTree.ParseError:
            return None
        return tuple("".join(x.itertext()).strip() if (x := found.find(c)) is not None else "" for c in COLUMNS)

    return [cells(r) for r in out]


PIECES = [
    "<row><A>{i}</A><B>b &amp; é</B></row>",
    "<row ><A>{i}</A></row >",
    "<row/>",
    "<row a='x>y'/>",
    "<row><A>{i}</A><row><A>in</A></row ><B>after</B></row>",
    "<row><row/><A>{i}</A></row>",
    "<!-- <row><A>no</A></row> -->",
    "<!-- </row> <![CDATA[ -->",
    "<row><A><![CDATA[</row><row> & <!-- ]]></A><B>c{i}</B></row>",
    "<row><A><!-- </row> -->{i}</A></row>",
    "<rowser>x</rowser>",
    "<rows2><x>1</x></rows2>",
    "\n",
    "</row>",
    "<row\n k=\"v\"><A>{i}</A></row\n>",
    "<row><A>" + "long " * 300 + "</A></row>",
]


@pytest.mark.parametrize("size", [1_000, 1 << 30])
def test_nested_spaced_and_hidden_tags(spark, landing, splits, size):  # noqa: F811
    rng = random.Random(12)
    files = {f"f{k}__xml": "<rows>" + "".join(rng.choice(PIECES).replace("{i}", str(i)) for i in range(n)) + "</rows>" for k, n in enumerate([0, 1, 3, 20, 200, 600])}
    files["plain__xml"] = xml_text(50)
    folder = landing(**files)
    splits(size)
    got = {}
    for r in sorted(xmlfiles.xml_records(spark, [folder], "row", COLUMNS).collect(), key=lambda r: (r["file_nm"], r["block"], r["line_id"])):
        got.setdefault(r["file_nm"], []).append(None if r["malformed"] else tuple(r["cells"]))
    for name, text in files.items():
        # elements that close themselves share the position of the piece they stand in
        assert sorted(got.get(name.replace("__", "."), []), key=str) == sorted(read(text), key=str), name


@pytest.mark.parametrize("size", [500, 1 << 30])
@pytest.mark.parametrize("limit", [10**9, 2_000])
def test_an_element_that_is_never_closed_costs_itself(spark, landing, splits, size, limit):  # noqa: F811
    good = [f"<row><A>{i}</A><B>b{i}</B></row>" for i in range(120)]
    text = "<rows>" + "\n".join(good[:60]) + "<row><A>open</A>" + "\n".join(good[60:]) + "</rows>"
    splits(size)
    found = xmlfiles.xml_records(spark, [landing(a__xml=text, b__xml=xml_text(9))], "row", COLUMNS, max_chars=limit).filter("file_nm = 'a.xml'")
    sure = {r["cells"][0] for r in found.filter("NOT malformed").collect()}
    assert {str(i) for i in range(120)} - sure <= {"60"}
    assert found.filter("malformed").count() == 1


def test_prefix_scan_of_many_rows(spark, monkeypatch):
    """Groups in groups in groups: as one composition after the other."""
    monkeypatch.setattr(scan, "SPAN", 3)
    rng = random.Random(3)
    events = [(f, b, i, rng.randrange(27)) for f, n in (("a", 90), ("b", 7), ("c", 1)) for b in range(0, 3000, 1000) for i in range(n)]
    want, now = {}, {}
    for f, b, i, g in sorted(events):
        before = now.setdefault(f, [0, 1, 2])
        want[f, b, i] = sum(s * 3**k for k, s in enumerate(before))
        now[f] = [g // 3**s % 3 for s in before]
    rng.shuffle(events)
    found = scan.functions_before(spark.createDataFrame(events, "file_nm string, block long, line_id long, f int"))
    assert {(r["file_nm"], r["block"], r["line_id"]): r["before"] for r in found.collect()} == want
    assert found.select(scan.from_first(F.col("before"))).distinct().count() <= 3
