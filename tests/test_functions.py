"""Scalar expressions: obfuscation, cleaning, delimiters, headers, casting."""

import base64
import datetime
import decimal

import pytest
from pyspark.sql import functions as F

from rawgate.functions import casting, cleaning, headers
from rawgate.functions.delimiters import content_format, decode_delimiter
from rawgate.functions.obfuscation import deobfuscate, obfuscate
from rawgate.sources.control import metadata_value
from rawgate.sources.lines import partition_plan

KEY = b"k3y-\xc3\xa9"


def one(spark, expression, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return df.select(expression.alias("r")).first()["r"]


def xor(text):
    data = text.encode()
    return base64.b64encode(bytes(b ^ KEY[i % len(KEY)] for i, b in enumerate(data))).decode()


@pytest.mark.parametrize("text", ["a", "hello world", "naïve café", "漢字と仮名", "x" * 1000, "\x00\x01", "é" * 300])
def test_obfuscation_is_bytes_xor_key(spark, text):
    code = one(spark, obfuscate(F.col("t"), KEY), t=text)
    assert code == xor(text)
    assert one(spark, deobfuscate(F.col("t"), KEY), t=code) == text


@pytest.mark.parametrize("text", [None, ""])
def test_nothing_to_obfuscate(spark, text):
    assert one(spark, obfuscate(F.col("t"), KEY), t=text) == ""
    assert one(spark, deobfuscate(F.col("t"), KEY), t=text) == ""


@pytest.mark.parametrize("code", ["?!", "abc", base64.b64encode(bytes([0xFF ^ KEY[0], 0xFE ^ KEY[1]])).decode()])
def test_what_does_not_come_back(spark, code):
    assert one(spark, deobfuscate(F.col("t"), KEY), t=code) == "decrypt_fail"


def test_base64_is_one_line_whatever_the_session_says(spark):
    spark.conf.set("spark.sql.chunkBase64String.enabled", "true")
    try:
        assert one(spark, obfuscate(F.col("t"), KEY), t="y" * 400) == xor("y" * 400)
    finally:
        spark.conf.unset("spark.sql.chunkBase64String.enabled")


def test_long_text_is_linear(spark):
    text = "é漢z" * 60_000
    assert one(spark, obfuscate(F.col("t"), KEY), t=text) == xor(text)


def test_empty_key_is_refused():
    with pytest.raises(ValueError):
        obfuscate(F.col("t"), b"")


@pytest.mark.parametrize(
    "cell, keep, want",
    [
        (None, False, ""),
        ('"a"', False, "a"),
        ("\"'a'\"", False, "a"),
        ("'\"a\"'", False, '"a"'),
        ("�a�", False, "a"),
        ("�a�", True, '"a"'),
        ("'a'", True, "'a'"),
        ('a"b', False, 'a"b'),
        ('""', False, ""),
    ],
)
def test_clean_cell(spark, cell, keep, want):
    assert one(spark, cleaning.clean_cell(F.col("c"), keep), c=cell) == want


@pytest.mark.parametrize("cell, want", [(None, None), ('"a"', "a"), ('""', ""), ('"', ""), ('"a', '"a'), ('""a""', '"a"')])
def test_unquote_pair(spark, cell, want):
    assert one(spark, cleaning.unquote_pair(F.col("c")), c=cell) == want


def test_remove_chars(spark):
    assert one(spark, cleaning.remove_chars(F.col("c"), [r"\xa1", r"[^\S ]"]), c="¡a\tb c\n") == "ab c"
    assert one(spark, cleaning.remove_chars(F.col("c"), []), c="a") == "a"


@pytest.mark.parametrize(
    "text, flag, want",
    [
        ("|", "n", "|"),
        (r"\t", "n", "\t"),
        (r"\x01", "n", "\x01"),
        (r"¦", "n", "¦"),
        (r"~\x02|", "n", "~\x02|"),
        (r"\\", "n", "\\"),
        ("7c", "y", "|"),
        ("7C7c", "Y", "||"),
        ("1", "y", "\x01"),
        ("c2a6", "y", "¦"),
    ],
)
def test_decode_delimiter(spark, text, flag, want):
    assert one(spark, decode_delimiter(F.col("d"), F.col("f")), d=text, f=flag) == want


@pytest.mark.parametrize(
    "text, want", [("HHDT_no", (2, 1, True)), ("HDT", (1, 1, False)), ("D", (0, 0, False)), (None, (0, 0, False)), ("", (0, 0, False))]
)
def test_content_format(spark, text, want):
    assert tuple(one(spark, content_format(F.col("f")), f=text)) == want


@pytest.mark.parametrize(
    "name, want", [("a b", "A_B"), ("a  b_", "A_B"), ("a#", "A_NO"), ("", ""), ("__a__", "_A"), ("_", "")]
)
def test_normalise_name(spark, name, want):
    assert one(spark, headers.normalise_name(F.col("n"), [(" ", "_"), ("#", "_no")]), n=name) == want


@pytest.mark.parametrize(
    "header, want",
    [("A,B", "equal"), ("A,X,B", "extra"), ("A,B,X", "extra"), ("B,A", "fail"), ("A", "fail"), ("", "fail"), ("A,B,B", "fail")],
)
def test_schema_match(spark, header, want):
    match = headers.schema_match(F.split("h", ","), F.split("e", ","))
    assert one(spark, match, h=header, e="A,B") == want


@pytest.mark.parametrize(
    "text, kind, want, failed",
    [
        ("12", "int", 12, False),
        (" 12 ", "bigint", 12, False),
        ("1.5", "decimal(10,2)", decimal.Decimal("1.50"), False),
        ("2024-02-30", "date", None, True),
        ("2024-02-29", "date", datetime.date(2024, 2, 29), False),
        ("yes", "boolean", True, False),
        ("", "int", None, False),
        ("  ", "double", None, False),
        (None, "int", None, False),
        ("x", "double", None, True),
        ("99999999999", "int", None, True),
        ("x", "string", "x", False),
    ],
)
def test_casting(spark, text, kind, want, failed):
    assert one(spark, casting.cast_text(F.col("t"), kind), t=text) == want
    assert one(spark, casting.cast_failed(F.col("t"), kind), t=text) is failed


def test_unknown_type_is_refused():
    with pytest.raises(ValueError):
        casting.check_type("blob")


@pytest.mark.parametrize(
    "size, name, want",
    [(0, "a.csv", 1), (200 * 2**20, "a.csv", 2), (200 * 2**20 - 1, "a.csv", 1), (41 * 2**20, "a.csv.gz", 3)],
)
def test_partition_plan(spark, size, name, want):
    assert one(spark, partition_plan(F.col("s").cast("bigint"), F.col("n")), s=str(size), n=name) == want


def test_metadata_value(spark):
    details = "file_size:1,rows:2,snap_dt_timestamp:2024-01-01 10:11:12"
    assert one(spark, metadata_value(F.col("d"), "snap_dt_timestamp"), d=details) == "2024-01-01 10:11:12"
    assert one(spark, metadata_value(F.col("d"), "snap_dt_timestamp"), d="rows:2") is None


@pytest.mark.parametrize("key", [b"k", b"abc", b"12345678", b"\xff" * 9, b"\x80\x00\x01\x02\x03"])
def test_xor_in_eight_byte_steps(spark, key):
    import base64

    from rawgate.functions.obfuscation import deobfuscate, obfuscate

    texts = ["a", "1234567", "12345678", "123456789", "é" * 11, "x" * 100_000, "\x7f\U0001f600"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", obfuscate(F.col("t"), key).alias("c"))
    for r in df.select("t", "c", deobfuscate(F.col("c"), key).alias("back")).collect():
        data = r["t"].encode()
        want = bytes(b ^ key[i % len(key)] for i, b in enumerate(data))
        assert r["c"] == base64.b64encode(want).decode() and r["back"] == r["t"]
