"""The line splitter against the CSV reader of the standard library."""

import csv
import random

import pytest
from pyspark.sql import functions as F

from rawgate.functions.ragged import split_cells


def split(spark, lines, sep):
    df = spark.createDataFrame(list(enumerate(lines)), "i int, value string")
    rows = df.select("i", split_cells(F.col("value"), sep).alias("p")).orderBy("i").collect()
    return [(list(r["p"]["cells"]), r["p"]["malformed"]) for r in rows]


@pytest.mark.parametrize("sep", ["|", ",", "\t", "\x01", ";", "^", "."])
def test_written_rows_come_back(spark, sep):
    rng = random.Random(7)
    alphabet = ["a", "b", " ", '"', '""', sep, "\\", "'", "é", "漢", ""]
    rows = [["".join(rng.choices(alphabet, k=rng.randint(0, 8))) for _ in range(rng.randint(2, 6))] for _ in range(500)]
    lines = []
    for row in rows:
        quoted = ['"' + c.replace('"', '""') + '"' if '"' in c or sep in c or rng.random() < 0.2 else c for c in row]
        lines.append(sep.join(quoted))
    assert split(spark, lines, sep) == [(row, False) for row in rows]


def test_soup_equals_the_csv_module_or_is_quarantined(spark):
    rng = random.Random(11)
    lines = ["".join(rng.choices(['"', "|", "x", "y", " "], k=rng.randint(1, 14))) for _ in range(3000)]
    checked = 0
    for line, (cells, malformed) in zip(lines, split(spark, lines, "|"), strict=True):
        if malformed:
            continue
        checked += 1
        assert cells == next(csv.reader([line], delimiter="|", quotechar='"')), line
    assert checked > 1000


@pytest.mark.parametrize(
    "line, cells, malformed",
    [
        ("a|b", ["a", "b"], False),
        ("a||", ["a", "", ""], False),
        ('"a|b"|c', ["a|b", "c"], False),
        ('"say ""hi"""|c', ['say "hi"', "c"], False),
        ('""|c', ["", "c"], False),
        ('5" pipe|c', ['5" pipe', "c"], False),
        ('"x"y|c', ['"x"y', "c"], True),
        ('a|"open', ["a", '"open'], True),
        ('"', ['"'], True),
        ('"""', ['"'], True),
    ],
)
def test_lines(spark, line, cells, malformed):
    assert split(spark, [line], "|") == [(cells, malformed)]


def test_delimiter_of_several_characters(spark):
    assert split(spark, ['a~|~"b~|~c"~|~d|e~f', "x~|~y"], "~|~") == [(["a", "b~|~c", "d|e~f"], False), (["x", "y"], False)]


def test_very_long_cells_need_no_stack(spark):
    many = '"' + '""' * 300_000 + '"|q'
    long = '"' + "z" * 500_000 + '"|q'
    (one, bad1), (two, bad2) = split(spark, [many, long], "|")
    assert (len(one[0]), one[1], bad1) == (300_000, "q", False)
    assert (len(two[0]), two[1], bad2) == (500_000, "q", False)
