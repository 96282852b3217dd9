import hashlib
import random
from collections import defaultdict

import pyarrow as pa

from rawgate.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"
POOL = [*chat.CONTROL, "\\", "\\\\", "<", "[", "é", "\n", "a", "</", "s>", "|im_end|>", "/INST]", "<\\/s>", "ü\U0001f600", "n", ""]


def piece(rng):
    return "".join(rng.choice(POOL) for _ in range(rng.randint(0, 8)))


def formatted(role, text):
    column, first, last = chat.assemble(pa.array([chat.escape_role(role)]), pa.array([chat.escape(text)]))
    return column[0].as_py(), int(first[0]), int(last[0])


def test_escapes_are_reversible_and_hide_control_strings():
    rng = random.Random(1)
    for _ in range(5000):
        text, role = piece(rng), piece(rng)
        assert chat.unescape(chat.escape(text)) == text and chat.unescape_role(chat.escape_role(role)) == role
        assert not any(c in x for c in chat.CONTROL for x in (chat.escape(text), chat.escape_role(role)))
        line, lo, hi = formatted(role, text)
        assert chat.parse_turn(line) == (role, text)
        assert line.count("<|im_start|>") == line.count("<|im_end|>") == 1
        assert chat.unescape(line[lo:hi]) == text


def brute(rows):
    by_conv = defaultdict(list)
    for conv, turn, role, text in rows:
        by_conv[conv].append((turn is not None, turn or 0, formatted(role or "", text or "")[0], role or "", text or ""))
    out = {}
    for conv, turns in by_conv.items():
        turns.sort()
        all_turns = "".join(f"{r}\n{t}\n" for *_, r, t in turns)
        loss = "".join(t for *_, r, t in turns if r == "assistant")
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (all_turns, loss)]
        out[conv] = (len(turns), sha[0], len(loss), sha[1], sum(len(f) for _, _, f, _, _ in turns))
    return out


def test_read_back(spark, tables):
    rng = random.Random(2)
    rows = [
        (rng.choice([1, 2, 3, None]), rng.choice([0, 1, 2, 3, None]), rng.choice(["user", "assistant", "system", None, "od\nd" + piece(rng)]), rng.choice([None, piece(rng)]))
        for _ in range(300)
    ]
    rows += rows[:10] + [(5, 0, "assistant", "x" * 1_000_000 + "</s>")]
    given = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS formatted", "1 AS loss_start").repartition(4)
    got = {r[0]: tuple(r)[1:] for r in chat.chat_format(spark, tables(conversations=given)).collect()}
    rows += [(-7, 0, "user", chat.HOSTILE), (-7, 1, "assistant", chat.HOSTILE)]
    assert got == brute(rows)
    assert got[-7][2] == len(chat.HOSTILE)


def test_empty_table(spark, tables):
    got = chat.chat_format(spark, tables(conversations=spark.createDataFrame([], SCHEMA))).collect()
    assert [r.conv_id for r in got] == [-7]
