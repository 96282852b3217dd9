import random

import pytest
from pyspark.sql import functions as F

from rawgate.llm import toxicity as tx
from tests.llm.conftest import prose

SCHEMA = "doc_id long, text string"


def emitted(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    return {r.doc_id: (r.emitted, r.score) for r in tx.score(docs, tx.make_grammar(), ["doc_id"]).collect()}


@pytest.mark.parametrize(
    "text, label",
    [
        ("what an idiot", tx.PLAIN),
        ("you are an idiot", tx.TARGETED),
        ("this is not stupid at all", tx.NEGATED),
        ("she said it was stupid", tx.REPORTED),
        ("I will kill you", tx.THREATENED),
        ("I will kill the lights", 0),
        ("he said hello. What an idiot", tx.PLAIN),
        ("not here. An idiot", tx.PLAIN),
        ("nice words only", 0),
        ("", 0),
        (None, 0),
    ],
)
def test_grammar(spark, text, label):
    sums, score = emitted(spark, [text])[0]
    assert [i + 1 for i, x in enumerate(sums) if x] == ([label] if label else [])
    assert (score >= 0.5) == (label in (tx.PLAIN, tx.TARGETED, tx.THREATENED))


@pytest.mark.parametrize(
    "targeted, negated, reported, threat, harmless",
    [
        ("You are an idiot", "You are not an idiot", "He said you are an idiot", "I will kill you", "I will kill the lights"),
        ("Du bist ein Idiot", "Du bist kein Idiot", "Er sagte, du bist ein Idiot", "Ich werde dich töten", "Ich werde die Zeit töten"),
        ("Tu es un imbécile", "Tu n'es pas un imbécile", "Il écrit que tu es un imbécile", "Je vais te tuer", "Il faut tuer le temps"),
        ("Tú eres un idiota", "Tú no eres un idiota", "Dice que tú eres un idiota", "Te voy a matar", "Hay que matar el tiempo"),
    ],
)
def test_the_clause_decides_in_four_languages(spark, targeted, negated, reported, threat, harmless):
    texts = [targeted, negated, reported, threat, harmless]
    got = emitted(spark, texts)
    labels = [[i + 1 for i, x in enumerate(got[k][0]) if x] for k in range(len(texts))]
    assert labels == [[tx.TARGETED], [tx.NEGATED], [tx.REPORTED], [tx.THREATENED], []]
    assert [got[k][1] >= 0.5 for k in range(len(texts))] == [True, False, False, True, False]


def test_a_seed_has_one_class():
    words = [w for c in tx.SEEDS for w in tx.SEEDS[c]]
    assert len(words) == len(set(words))


def test_every_learned_entry_is_kept(spark):
    """More insults than any round number: each stands in documents and contexts of its own."""
    rng = random.Random(8)
    n = 5_000
    rows = [(i, " ".join(f"w{rng.randrange(10**6)} insult{(i * 100 + k) % n:05d}x" for k in range(100)), 1) for i in range(600)]
    rows += [(i, prose(rng, 20), 0) for i in range(600, 700)]
    labelled = spark.createDataFrame(rows, "id long, text string, toxic int").select("text", "toxic")
    assert sum(size == 0 for size, _, _ in tx.learn_insults(labelled)) == n


def brute_labels(classes):
    """Emissions of a clause by looking back from each word, without states."""
    out = []
    for i, c in enumerate(classes):
        threat = c == tx.TARGET and tx.THREAT in classes[max(0, i - tx.THREAT_REACH) : i]
        threat = threat or (c == tx.LATE_THREAT and tx.TARGET in classes[max(0, i - tx.TARGET_REACH) : i])
        if c != tx.INSULT and not threat:
            continue
        before = classes[:i]
        if tx.REPORT in before:
            out.append(tx.REPORTED)
        elif tx.NEGATION in before[-tx.NEGATION_REACH :]:
            out.append(tx.NEGATED)
        elif threat:
            out.append(tx.THREATENED)
        else:
            out.append(tx.TARGETED if tx.TARGET in before[-tx.TARGET_REACH :] else tx.PLAIN)
    return out


def test_product_equals_its_parts():
    rng = random.Random(3)
    for _ in range(3000):
        classes = [rng.randrange(tx.CLASSES) for _ in range(rng.randint(1, 14))]
        state, got = 0, []
        for c in classes:
            if tx.EMIT[state][c]:
                got.append(tx.EMIT[state][c])
            state = tx.MOVE[state][c]
        assert got == brute_labels(classes)


def test_learns_words_and_stems_and_only_from_given_labels(spark):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(1200):
        words, toxic = prose(rng, 60).split(), i % 6 == 0
        if toxic:
            for k in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["zorgish", "brakk" + rng.choice("abcdefgh") * 3]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, SCHEMA)
    labelled = spark.createDataFrame(labels, "doc_id long, toxic int")
    grammar = tx.train(docs, tx.may_learn(labelled))
    got = tx.score(docs, grammar, ["doc_id"]).select("doc_id", (F.col("score") >= 0.5).cast("int").alias("p")).collect()
    wrong = [r.doc_id for r in got if r.p != labels[r.doc_id][1]]
    assert not wrong
    none = tx.train(docs, labelled.filter("doc_id < 0"))
    assert max(r.score for r in tx.score(docs, none, ["doc_id"]).collect()) < 0.5


def test_copies_of_one_document_teach_nothing(spark):
    rng = random.Random(4)
    base = prose(rng, 60, "q")
    rows = [(i, base) for i in range(0, 100)] + [(i, prose(rng, 60)) for i in range(100, 600)]
    labels = [(i, int(i < 100)) for i in range(600)]
    learned = tx.learn_insults(
        tx._labelled(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, toxic int"), "doc_id", "text", "toxic", 10_000)
    )
    assert learned == []


def test_odd_rows(spark, odd_docs, no_docs, tables):
    labels = spark.createDataFrame([(1, None, 1), (None, 1, 1), (7, 1, 0), (7, 1, 1)], "doc_id long, quality int, toxic int")
    path = tables(documents=odd_docs.drop("weird.name"), labels=labels)
    got = tx.toxicity(spark, path).collect()
    assert len(got) == odd_docs.count() and all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in got)
    kept = tx.drop_toxic(spark, odd_docs, path)
    assert kept.columns == odd_docs.columns and kept.count() == sum(1 - r.predicted for r in got)
    assert tx.score(no_docs, tx.make_grammar(), ["doc_id"]).count() == 0
    assert tx.drop_toxic(spark, no_docs, path).count() == 0
