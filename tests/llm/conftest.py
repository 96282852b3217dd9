import random

import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()


def prose(rng, n, prefix=""):
    return " ".join(prefix + rng.choice(WORDS) + (rng.choice(WORDS) if rng.random() < 0.7 else "") for _ in range(n))


def odd_rows():
    """Nulls in every column, empty and very long texts, ties, repeated rows, signs of all kinds."""
    rng = random.Random(5)
    long_text = prose(rng, 30_000)
    rows = [
        (1, None, "en", "a", None),
        (2, "", "en", "a", 0),
        (3, " \t\n\r\x0b\x0c ", None, None, 7),
        (4, "one", "en", "b", 3),
        (5, "ONE", "en", "b", 3),
        (6, "one two", "en", None, 7),
        (7, long_text, "en", "a", len(long_text)),
        (8, long_text + " tail", "en", "a", None),
        (9, "Released under the MIT License.\nApache-License, version 2.0", "en", "a", 1),
        (10, "É É é ü ñ 漢字 \U0001f600 \x00 \x1f \x7f   x", "fr", "b", 1),
        (None, "a null id and a few words more", "en", "a", 1),
        (None, "a null id and a few words more", "en", "a", 1),
        (11, prose(rng, 200), "en", "a", 1),
        (11, prose(rng, 200), "en", "a", 1),
        (12, "repeated row of some words", "en", "b", 1),
        (12, "repeated row of some words", "en", "b", 1),
        (13, "\n\n\nline\nline\nline\n", "de", "a", 1),
        (14, "#" * 50 + " " + "%" * 20, "de", "c", 1),
        (15, "12345 67890 !!!", "de", "c", 1),
        (-3, "a negative id", "es", "c", 1),
    ]
    base = prose(rng, 300).split()
    for i in range(20, 60):
        words = list(base)
        for _ in range(rng.randint(0, 8)):
            words[rng.randrange(len(words))] = rng.choice(WORDS) + str(i)
        rows.append((i, " ".join(words), "en", "hot", 1))
    return rows


@pytest.fixture(scope="session")
def odd_docs(spark):
    """The odd rows, with extra columns whose names the operators use themselves."""
    docs = spark.createDataFrame(odd_rows(), SCHEMA)
    for name in ("_id", "_text", "score", "row", "n", "words", "tokens", "item_id", "copies", "weird.name"):
        docs = docs.withColumn(name, F.lit("x"))
    return docs.repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture
def tables(tmp_path):
    """Writes DataFrames as the tables of a folder and returns the folder."""

    def write(**frames):
        for name, df in frames.items():
            df.write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write
