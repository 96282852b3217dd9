"""Delimiter decoding and content formats, as expressions over control rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: the one-letter escapes of string literals
LETTER_ESCAPES = {"t": "\t", "n": "\n", "r": "\r", "f": "\f", "v": "\x0b", "a": "\x07", "b": "\b", "\\": "\\"}


def decode_delimiter(text: Column, hex_flag: Column) -> Column:
    """A delimiter given literally, with escapes, or as hex digits when the flag is `y`."""
    tokens = F.regexp_extract_all(
        text, F.lit(r"(?s)(\\x[0-9A-Fa-f]{2}|\\u[0-9A-Fa-f]{4}|\\.|.)"), F.lit(1)
    )

    def one(token: Column) -> Column:
        code = F.decode(F.unhex(F.lpad(F.substring(token, 3, 4), 4, "0")), "UTF-16BE")
        letter = F.substring(token, 2, 1)
        plain = F.when(F.length(token) < 2, token)
        for name, char in LETTER_ESCAPES.items():
            plain = plain.when(letter == name, F.lit(char))
        return F.when(token.rlike(r"^\\[xu][0-9A-Fa-f]{2}"), code).otherwise(plain.otherwise(token))

    literal = F.array_join(F.transform(tokens, one), "")
    coded = F.decode(F.unhex(F.lpad(text, F.greatest(F.length(text), F.lit(2)), F.lit("0"))), "UTF-8")
    return F.when(F.lower(hex_flag) == "y", coded).otherwise(literal)


def content_format(text: Column) -> Column:
    """struct(n_head, n_tail, no_ident): letters before `_` counted, e.g. HHDT_no."""
    letters = F.substring_index(F.coalesce(text, F.lit("")), "_", 1)
    return F.struct(
        F.regexp_count(letters, F.lit("H")).alias("n_head"),
        F.regexp_count(letters, F.lit("T")).alias("n_tail"),
        F.coalesce(text.contains("_no"), F.lit(False)).alias("no_ident"),
    )
