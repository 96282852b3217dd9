"""Reversible XOR obfuscation as a native expression, with no Python workers.

XOR with a repeating key is not encryption. `aes_encrypt` and `sha2` of
`pyspark.sql.functions` are the choice where secrecy is needed.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


#: bytes that one step handles: a bigint
STEP = 8


def _xor_hex(data: Column, key: bytes) -> Column:
    """Hex text of `data` XOR the repeating key, eight bytes a step. Bytes are
    sliced from the binary value, so the cost is linear in its length."""
    repeated = key * (STEP // math.gcd(STEP, len(key)))
    words = [int.from_bytes(repeated[i : i + STEP], "big", signed=True) for i in range(0, len(repeated), STEP)]
    key_words = F.array(*[F.lit(w).cast("bigint") for w in words])

    def one(i: Column, b: Column) -> Column:
        # a negative target base asks for a signed number
        plain = F.conv(F.rpad(F.hex(F.substring(b, i * STEP + 1, F.lit(STEP))), 2 * STEP, "0"), 16, -10).cast("bigint")
        return F.lpad(F.hex(plain.bitwiseXOR(F.get(key_words, i % len(words)))), 2 * STEP, "0")

    def whole(b: Column) -> Column:
        steps = F.sequence(F.lit(0), F.floor((F.length(b) - 1) / STEP).cast("int"))
        return F.substring(F.array_join(F.transform(steps, lambda i: one(i, b)), ""), F.lit(1), 2 * F.length(b))

    # one-element arrays bind the bytes once
    return F.array_join(F.transform(F.array(data), whole), "")


def obfuscate(text: Column, key: bytes) -> Column:
    """UTF-8 bytes XOR key, as base64; null and blank give blank."""
    if not key:
        raise ValueError("the obfuscation key is empty")
    coded = F.base64(F.unhex(_xor_hex(F.encode(text, "UTF-8"), key)))
    # base64 may be broken into lines of 76 characters, depending on the session
    coded = F.translate(coded, "\r\n", "")
    return F.when(text.isNull() | (text == ""), F.lit("")).otherwise(coded)


def deobfuscate(code: Column, key: bytes) -> Column:
    """The inverse; `decrypt_fail` for bad base64 or bytes that are not UTF-8."""
    if not key:
        raise ValueError("the obfuscation key is empty")
    data = F.try_to_binary(code, F.lit("base64"))
    plain = F.when(F.length(data) > 0, F.unhex(_xor_hex(data, key))).otherwise(data)
    text = F.try_validate_utf8(plain.cast("string"))
    return F.when(code.isNull() | (code == ""), F.lit("")).otherwise(F.coalesce(text, F.lit("decrypt_fail")))
