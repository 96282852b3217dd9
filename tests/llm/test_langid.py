import random

from rawgate.llm import langid
from tests.llm.conftest import odd_rows

SYLLABLES = {"xx": "ka lo mi ta ru".split(), "yy": "strö ünd chts pfa".split(), "zz": "éau ille ço ré".split()}


def text(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n)).capitalize()


def test_learns_and_predicts_texts_of_any_length(spark):
    rng = random.Random(1)
    rows = [(i, text(rng, lang, rng.choice([3, 30, 300])), lang) for i in range(300) for lang in SYLLABLES]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(docs, per_language=150)
    fresh = [(i, text(rng, lang, rng.choice([2, 50])), lang) for i in range(60) for lang in SYLLABLES]
    got = langid.predict(spark.createDataFrame([(k, t) for k, (_, t, _) in enumerate(fresh)], "doc_id long, text string"), model).collect()
    right = sum(r.lang_pred == fresh[r.doc_id][2] for r in got)
    assert right >= 0.97 * len(fresh) and all(0 < r.score <= 1 for r in got)
    strange = langid.predict(spark.createDataFrame([(1, "ka éau strö mi ille pfa")], "doc_id long, text string"), model).collect()[0]
    assert strange.lang_pred in SYLLABLES


def test_prediction_does_not_depend_on_tiles(monkeypatch):
    rng = random.Random(2)
    texts = [text(rng, lang, 40) for lang in SYLLABLES for _ in range(30)]
    model = langid.fit(texts, [lang for lang in SYLLABLES for _ in range(30)])
    import numpy as np
    import pyarrow as pa

    for_all = pa.array(["", *texts, "", "a"])
    best, score = model.predict(*langid.bytes_of(for_all))
    one = [model.predict(*langid.bytes_of(pa.array([t]))) for t in for_all.to_pylist()]
    assert np.allclose(score, [s[0] for _, s in one], atol=1e-4) and (best == [b[0] for b, _ in one]).all()
    monkeypatch.setattr(langid, "TILE", 64)
    again, score2 = model.predict(*langid.bytes_of(for_all))
    assert (again == best).all() and np.allclose(score, score2, atol=1e-4)


def test_odd_rows(spark, odd_docs, no_docs, tables):
    got = langid.language_id(spark, tables(documents=odd_docs.drop("weird.name"))).collect()
    assert len(got) == len(odd_rows())
    for r in got:
        texts = [t for i, t, *_ in odd_rows() if i == r.doc_id]
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in texts[0] or "")), r
        assert (r.score == 0) == (r.lang_pred == "und")
    assert langid.train(no_docs) is None
    nothing = langid.predict(odd_docs, None).collect()
    assert {r.lang_pred for r in nothing} == {"und"}
    assert langid.predict(no_docs, None).count() == 0
