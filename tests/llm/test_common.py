import random
import re

import numpy as np
import pyarrow as pa

from rawgate.llm.common import (
    ALNUM_WORD,
    IS_ALNUM,
    IS_SPACED,
    SPACED_WORD,
    UPPER,
    LOWER,
    find_words,
    hash_words,
    slices,
    word_hashes,
)
from rawgate.llm import common

TEXTS = ["", None, "a", " a ", "É é x\x00y", "A-b_c 9\t\nz", "\U0001f600 \x7f\x1f", "end", "", "start", "x" * 5000 + " y"]


def test_words_are_those_of_the_patterns():
    lower = str.maketrans(UPPER, LOWER)
    for table, pattern in ((IS_ALNUM, ALNUM_WORD), (IS_SPACED, SPACED_WORD)):
        for limit in (1, 7, 1 << 20):
            got = []
            for first, stop, buf, offsets in slices(pa.array(TEXTS), limit):
                starts, ends, pointer = find_words(buf, offsets, table)
                for i in range(stop - first):
                    got.append([buf[s:e].tobytes().decode().translate(lower) for s, e in zip(starts[pointer[i] : pointer[i + 1]], ends[pointer[i] : pointer[i + 1]])])
            assert got == [re.findall(pattern, (t or "").translate(lower)) for t in TEXTS]


def test_hashes_do_not_depend_on_place_or_case(monkeypatch):
    rng = random.Random(1)
    words = sorted({"".join(rng.choice("abcé9") for _ in range(rng.randint(1, 9))) for _ in range(3000)})
    hashes = hash_words(words)
    assert len(set(hashes.tolist())) == len(words)
    text = " ".join(w.upper() if w.isascii() else w for w in words)
    for tile in (16, 1000, 1 << 20):
        monkeypatch.setattr(common, "SLICE_BYTES", tile)
        buf = np.frombuffer(text.encode(), np.uint8)
        starts, ends, _ = find_words(buf, np.array([0, len(buf)]), IS_ALNUM)
        assert (word_hashes(buf, starts, ends) == hashes).all()
