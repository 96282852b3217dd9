import re
from collections import Counter

from rawgate.llm import quality
from tests.llm.conftest import odd_rows, prose


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    counts, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if counts[w] > 1:
            covered.update(range(i, i + 5))
    n, repeated = len(words), len(covered)
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, repeated, n < 10 or 100 * repeated > 20 * n


def row(r):
    return r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed


def test_odd_rows(spark, odd_docs, no_docs, tables):
    got = quality.quality_query(spark, tables(documents=odd_docs.drop("weird.name"))).collect()
    assert sorted((str(r.doc_id), row(r)) for r in got) == sorted((str(i), brute(t)) for i, t, *_ in odd_rows())
    assert not any(r.kept and r.base_failed for r in got)
    assert quality.quality_rules(no_docs).count() == 0


def test_repeats(spark):
    texts = ["a b c d e " * 4, "a b c d e x a b c d e y", "a a a a a a a", "a b c d e f g h i j", "a a a a a", "p q r s t u p q r s t u v"]
    docs = spark.createDataFrame([(i, t, "en", "s") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r.n_repeat_words for r in quality.quality_rules(docs).collect()}
    assert got == {i: brute(t)[4] for i, t in enumerate(texts)}


def test_limits_follow_the_group(spark):
    import random

    rng = random.Random(1)

    def signs(n):
        return " ".join(rng.choice(["<>", "||", "&&"]) + " " + rng.choice("abcdefgh") for _ in range(n))

    rows = [(i, prose(rng, 80), "en", "plain") for i in range(300)]
    code = [(1000 + i, prose(rng, 60) + " " + signs(rng.randint(6, 12)), "en", "code") for i in range(300)]
    odd = [(5000, prose(rng, 60) + " " + "<>|&" * 60, "en", "plain"), (5001, prose(rng, 60) + " " + signs(9), "en", "plain")]
    few = [(6000, prose(rng, 80), "en", "rare"), (6001, prose(rng, 80), "xx", "rare"), (6002, prose(rng, 80), None, None)]
    docs = spark.createDataFrame(rows + code + odd + few, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id: r.kept for r in quality.quality_rules(docs).collect()}
    assert all(kept[i] for i, *_ in rows + few) and not kept[5000] and not kept[5001]
    assert sum(not kept[i] for i, *_ in code) == 0


def test_each_measure_alone_rejects_an_outlier(spark):
    import random

    rng = random.Random(2)

    def repeats(i):
        return prose(rng, 64) + f" r{i} s t u v w x " + prose(rng, 6) + f" r{i} s t u v w x"

    def lines(i):
        return "\n".join(f"same\n{prose(rng, 3)} {i}/{k}" for k in range(12)) + "\nsame"

    def plain():
        return prose(rng, 80)

    usual = [(1000 + i, repeats(i), "en", "songs") for i in range(300)] + [(2000 + i, lines(i), "en", "lists") for i in range(300)]
    rows = [(i, plain(), "en", "plain") for i in range(300)] + usual
    odd = [repeats(1), lines(1), plain() + " " + "<>|&" * 20, " ".join(w * 4 for w in plain().split())]
    docs = spark.createDataFrame(rows + [(5000 + i, t, "en", "plain") for i, t in enumerate(odd)], "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r for r in quality.quality_rules(docs).collect()}
    assert not any(got[5000 + i].base_failed or got[5000 + i].kept for i in range(4))
    assert 0.15 < got[5000].repeat_ratio < 0.2 and got[5000].dup_line_ratio == got[5001].repeat_ratio == 0 and got[5001].dup_line_ratio > 0.4
    assert all(got[i].kept for i, *_ in rows)
