"""Toxicity: a weighted finite-state pattern grammar over clauses.

Words are mapped to classes (insult, threat verb, threat verb that comes after
its object, target, negation, reported speech, other), with seeds in English,
German, French and Spanish. Five small transducers read the class sequence of a clause:

* insult    emits at an insult word;
* threat    emits when a target follows a threat verb within three words, or
            a verb of the other kind follows a target (dich töten, te tuer, te mato);
* target    remembers for four words that somebody is addressed;
* negation  remembers for three words that something is negated;
* report    remembers to the end of the clause that somebody else is quoted.

Their product is composed into one table, so that a clause is read in a single
pass; what it emits is labelled plain, targeted, negated, reported or threat.
A clause ends at . ! ? ; or a line break. An insult word's emission carries the
word's weight. A document's score is a logistic function of what its clauses
emitted, by label: single words without their clause are not scored.

Insult words come from a seed list and from labelled documents: words, and
stems of STEMS bytes for inflected forms, that stand in many different contexts
of several toxic documents and hardly in others. Contexts (the word before) are
counted, not occurrences, so that copies of one document count once. The five emission
weights are fitted on the same sample, drawn towards the grammar's defaults.
The sample has at most about `max_labelled` rows, chosen by a hash of the id;
every word and stem that it shows to be an insult is kept.

Defined cases: a null or empty text emits nothing and gets the score of a clean
document; labels that are null, or whose id is null, are not used; a document
labelled twice counts as toxic if one label says so; null or repeated document
ids are passed through, one row each; without labels the defaults hold.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rawgate.llm.common import IS_ALNUM, arrow_map, find_words, hash_words, mix64, remainder, row_of, slices, span_hashes, table, whole_row
from rawgate.llm.registry import query

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, LATE_THREAT = range(7)
CLASSES = 7

#: Seed words by class, English.
ENGLISH = {
    INSULT: "asshole bastard bitch clown cretin cunt disgusting dumbass fool freak idiot imbecile jerk loser moron pathetic scum stupid trash vermin worthless".split(),
    THREAT: "beat burn choke destroy gut hang harm hurt kill murder punch shoot smash stab strangle".split(),
    TARGET: "you your yours yourself u ya they them their he him his she her everyone people".split(),
    NEGATION: "not never no none nobody isn aren wasn weren don doesn didn cannot cant dont isnt arent".split(),
    REPORT: "said says say saying told tells called calls claimed claims wrote writes quoted quote reported reports alleged".split(),
}
#: Seed words by class, German.
GERMAN = {
    INSULT: "abschaum arschloch dummkopf trottel".split(),
    THREAT: "erschieße erschlage ersteche erwürge schlage töte verprügle".split(),
    LATE_THREAT: "erschießen erschlagen erstechen erwürgen töten umbringen verprügeln".split(),
    TARGET: "du dich dir dein deine deinen deiner ihr euch euer eure sie ihn ihm ihnen".split(),
    NEGATION: "nicht nie niemals kein keine keinen keiner nichts niemand".split(),
    REPORT: "sagt sagte sagten behauptet behauptete schreibt schrieb nannte zitiert zitierte angeblich".split(),
}
#: Seed words by class, French.
FRENCH = {
    INSULT: "connard crétin imbécile ordure salaud".split(),
    LATE_THREAT: "étrangler frapper frapperai poignarder tue tuer tuerai".split(),
    TARGET: "tu te toi ton ta tes vous votre vos ils elles lui leur eux".split(),
    NEGATION: "ne pas jamais rien aucun aucune personne".split(),
    REPORT: "dit disait disent affirme affirmait écrit écrivait prétend prétendait selon".split(),
}
#: Seed words by class, Spanish.
SPANISH = {
    INSULT: "cabrón escoria estúpida estúpido idiota imbécil".split(),
    LATE_THREAT: "apuñalar estrangular golpear golpearé matar mataré mato".split(),
    TARGET: "tú ti tus usted ustedes vosotros él ella ellos ellas".split(),
    NEGATION: "nunca jamás nadie nada ningún ninguna tampoco".split(),
    REPORT: "dijo dice dicen decía afirma afirmó escribe escribió llamó según".split(),
}

SEEDS = {c: [w for words in (ENGLISH, GERMAN, FRENCH, SPANISH) for w in words.get(c, ())] for c in range(1, CLASSES)}

PLAIN, TARGETED, NEGATED, REPORTED, THREATENED = range(1, 6)
LABELS = 5

#: sizes of the stems that may be learned, in bytes, longest first
STEMS = (8, 7, 6, 5, 4)

SEED_WEIGHT = 3.0
#: Logistic weights before training: intercept, then the labels in order.
DEFAULTS = np.array([-3.0, 2.4, 2.8, 0.4, 0.3, 3.0])

NEGATION_REACH, TARGET_REACH, THREAT_REACH = 3, 4, 3


def countdown(trigger: int, reach: int) -> list[list[int]]:
    """Transducer that knows how many more words a trigger holds for: next state by (state, class)."""
    return [[reach if c == trigger else max(0, s - 1) for c in range(CLASSES)] for s in range(reach + 1)]


def latch(trigger: int) -> list[list[int]]:
    """Transducer that holds from a trigger to the end of the clause."""
    return [[1 if c == trigger or s else 0 for c in range(CLASSES)] for s in range(2)]


def emission(negated: int, reported: int, addressed: int, threatening: int, word: int) -> int:
    """What the product emits at a word, given the states before it."""
    threat = (word == TARGET and threatening > 0) or (word == LATE_THREAT and addressed > 0)
    if not threat and word != INSULT:
        return 0
    if reported:
        return REPORTED
    if negated:
        return NEGATED
    if threat:
        return THREATENED
    return TARGETED if addressed else PLAIN


def compose() -> tuple[list[list[int]], list[list[int]]]:
    """Product of the transducers: (next state, emission), each by (state, class)."""
    parts = [countdown(NEGATION, NEGATION_REACH), latch(REPORT), countdown(TARGET, TARGET_REACH), countdown(THREAT, THREAT_REACH)]
    states = list(product(*[range(len(p)) for p in parts]))
    number = {s: i for i, s in enumerate(states)}
    move = [[number[tuple(p[x][c] for p, x in zip(parts, s, strict=True))] for c in range(CLASSES)] for s in states]
    emit = [[emission(*s, c) for c in range(CLASSES)] for s in states]
    return move, emit


MOVE, EMIT = compose()

ENDS_CLAUSE = np.zeros(256, dtype=bool)
ENDS_CLAUSE[[ord(c) for c in ".!?;\n"]] = True


@dataclass
class Grammar:
    """Hashes of words with class and weight, hashes of insult stems with weight, and the logistic weights."""

    hashes: np.ndarray
    classes: np.ndarray
    weights: np.ndarray
    stems: dict[int, tuple[np.ndarray, np.ndarray]]
    logistic: np.ndarray

    def classify(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Class and weight of every word: as a listed word, else by its stem."""
        whole, *stems = span_hashes(buf, starts, stem_ends(starts, ends))
        classes, weights = np.full(len(starts), OTHER, dtype=np.int8), np.zeros(len(starts))
        for size, hashes in zip(STEMS, stems, strict=True):
            listed, weight = self.stems.get(size, (np.zeros(0, np.uint64), np.zeros(0)))
            if len(listed):
                at = np.minimum(np.searchsorted(listed, hashes), len(listed) - 1)
                hit = (listed[at] == hashes) & (ends - starts > size)
                classes[hit] = INSULT
                weights[hit] = np.maximum(weights[hit], weight[at[hit]])
        at = np.minimum(np.searchsorted(self.hashes, whole), len(self.hashes) - 1)
        hit = self.hashes[at] == whole
        classes[hit], weights[hit] = self.classes[at[hit]], self.weights[at[hit]]
        return classes, weights

    def emissions(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per row: summed weight by label (rows x LABELS), number of matched clauses, weight of the worst clause."""
        n_rows = len(offsets) - 1
        sums, matched, worst = np.zeros((n_rows, LABELS)), np.zeros(n_rows, np.int64), np.zeros(n_rows)
        starts, ends, pointer = find_words(buf, offsets, IS_ALNUM)
        if not len(starts):
            return sums, matched, worst
        classes, weights = self.classify(buf, starts, ends)
        rows = row_of(pointer)
        breaks = np.cumsum(ENDS_CLAUSE[buf], dtype=np.int64)[starts]
        begins = np.flatnonzero(np.concatenate(([True], (breaks[1:] != breaks[:-1]) | (rows[1:] != rows[:-1]))))
        strong = np.flatnonzero((classes == INSULT) | (classes == THREAT) | (classes == LATE_THREAT))
        for clause in np.unique(np.searchsorted(begins, strong, side="right") - 1):
            first, stop = begins[clause], begins[clause + 1] if clause + 1 < len(begins) else len(starts)
            state, total = 0, 0.0
            row = rows[first]
            for i, c in enumerate(classes[first:stop].tolist(), first):
                label = EMIT[state][c]
                if label:
                    weight = weights[i] if c == INSULT else SEED_WEIGHT
                    sums[row, label - 1] += weight
                    total += weight
                state = MOVE[state][c]
            if total:
                matched[row] += 1
                worst[row] = max(worst[row], total)
        return sums, matched, worst

    def scores(self, sums: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.logistic[0] + np.log1p(sums) @ self.logistic[1:])))


def stem_ends(starts: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """Ends of the whole words and of their stems, longest first."""
    return [ends, *[np.minimum(ends, starts + size) for size in STEMS]]


Learned = list[tuple[int, int, float]]  # (stem size or 0 for a whole word, hash, weight)


def make_grammar(learned: Learned = (), logistic: np.ndarray = DEFAULTS) -> Grammar:
    """Seeds and learned insults. Function words keep their class; a learned weight takes the place of a seed's."""
    seeds = [(w, c) for c, words in SEEDS.items() for w in words]
    of = {int(h): (c, SEED_WEIGHT) for (_, c), h in zip(seeds, hash_words([w for w, _ in seeds]), strict=True)}
    for size, value, weight in learned:
        if size == 0 and (value not in of or of[value][0] == INSULT):
            of[value] = (INSULT, weight)
    hashes = sorted(of)
    stems = {}
    for size in STEMS:
        own = sorted((value, weight) for s, value, weight in learned if s == size)
        stems[size] = (np.array([v for v, _ in own], dtype=np.uint64), np.array([w for _, w in own]))
    return Grammar(
        np.array(hashes, dtype=np.uint64),
        np.array([of[h][0] for h in hashes], dtype=np.int8),
        np.array([of[h][1] for h in hashes]),
        stems,
        np.asarray(logistic, dtype=float),
    )


def _labelled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, max_labelled: int) -> DataFrame:
    """(text, toxic) of a bounded sample of the labelled documents, by a hash of the id."""
    known = (
        labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_toxic"))
        .filter(F.col("_id").isNotNull() & F.col("_toxic").isNotNull())
        .groupBy("_id")
        .agg((F.max("_toxic") > 0).cast("int").alias("toxic"))
    )
    steps = 1 << 30
    n = known.count()
    if n > max_labelled:
        known = known.filter(F.pmod(F.xxhash64("_id"), F.lit(steps)) < steps * max_labelled // n)
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("text"))
    # the sample is bounded by max_labelled: two numbers a row
    return texts.join(F.broadcast(known), "_id").select("text", "toxic")


def learn_insults(labelled: DataFrame, min_contexts: int = 6, min_docs: int = 4, min_log_odds: float = 2.0) -> Learned:
    """Words and stems that stand in many different contexts of toxic documents and hardly in others.

    The context of a word is the word before it. Contexts are dealt into 64
    classes, and what is kept per entry is the set of classes seen in toxic and
    in clean documents, and of classes of toxic documents, as bits: one small row per entry and task is shuffled.
    """
    kinds = (0, *STEMS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic = np.array(batch.column(1).to_pylist(), dtype=bool)
            for first, stop, buf, offsets in slices(batch.column(0)):
                starts, ends, pointer = find_words(buf, offsets, IS_ALNUM)
                if not len(starts):
                    continue
                rows = row_of(pointer)
                hashes = span_hashes(buf, starts, stem_ends(starts, ends))
                before = np.where(np.concatenate(([False], rows[1:] == rows[:-1])), np.roll(hashes[0], 1), 0)
                bit = np.uint64(1) << (before % np.uint64(64))
                # a document's class is its smallest word pair, which near copies share
                pairs, filled = mix64(before * np.uint64(3) + hashes[0]), np.unique(rows)
                document = np.zeros(stop - first, np.uint64)
                document[filled] = np.uint64(1) << (np.minimum.reduceat(pairs, pointer[filled]) % np.uint64(64))
                bad = toxic[first:stop][rows]
                for kind, value in zip(kinds, hashes, strict=True):
                    good = (ends - starts > kind) if kind else np.ones(len(starts), bool)
                    order = np.flatnonzero(good)[np.argsort(value[good], kind="stable")]
                    if not len(order):
                        continue
                    ranked = value[order]
                    at = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1])))
                    masks = [np.bitwise_or.reduceat(np.where(x[order], bit[order], np.uint64(0)), at) for x in (bad, ~bad)]
                    seen_in = np.where(bad[order], document[rows[order]], np.uint64(0))
                    masks.append(np.bitwise_or.reduceat(seen_in, at))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(at), kind, np.int32)), *[pa.array(x.view(np.int64)) for x in (ranked[at], *masks)]],
                        names=["kind", "value", "bad", "good", "docs"],
                    )

    odds = F.log((F.col("bad") + 0.5) / (F.col("good") + 0.5))
    best = (
        labelled.select("text", "toxic")
        .transform(arrow_map, count, "kind int, value long, bad long, good long, docs long")
        .groupBy("kind", "value")
        .agg(*[F.bit_count(F.expr(f"bit_or({c})")).alias(c) for c in ("bad", "good", "docs")])
        .filter((F.col("bad") >= min_contexts) & (F.col("docs") >= min_docs) & (odds >= min_log_odds))
        .select("kind", "value", odds.alias("odds"))
    )
    rows = best.collect()  # words of the labelled sample, each in `min_docs` documents of it
    return [(r["kind"], r["value"] % (1 << 64), float(r["odds"])) for r in rows]


def _features(docs: DataFrame, grammar: Grammar, keep: list[str], text_col: str) -> DataFrame:
    """`keep` columns and, per document, the emissions by label, matched clauses, worst clause and score."""
    fields = [docs.schema[c] for c in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, stop, buf, offsets in slices(batch.column(len(keep))):
                sums, matched, worst = grammar.emissions(buf, offsets)
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(i).slice(first, stop - first) for i in range(len(keep))],
                        pa.ListArray.from_arrays(pa.array(np.arange(0, sums.size + 1, LABELS, dtype=np.int32)), pa.array(sums.ravel())),
                        pa.array(matched),
                        pa.array(worst),
                        pa.array(grammar.scores(sums)),
                    ],
                    names=[*keep, "emitted", "n_clauses", "worst_clause", "score"],
                )

    schema = T.StructType(
        [
            *[T.StructField(c, f.dataType) for c, f in zip(keep, fields, strict=True)],
            T.StructField("emitted", T.ArrayType(T.DoubleType())),
            T.StructField("n_clauses", T.LongType()),
            T.StructField("worst_clause", T.DoubleType()),
            T.StructField("score", T.DoubleType()),
        ]
    )
    return docs.select(*[F.col(c) for c in keep], F.col(text_col).cast("string").alias("_scored_text")).transform(arrow_map, run, schema)


def fit_logistic(sums: np.ndarray, toxic: np.ndarray, pull: float = 2.0, steps: int = 400) -> np.ndarray:
    """Logistic weights, drawn to the defaults so that labels never seen keep theirs; none goes below 0."""
    x = np.concatenate([np.ones((len(sums), 1)), np.log1p(sums)], axis=1)
    w = DEFAULTS.copy()
    scale = 0.25 * (x * x).sum(axis=0) + pull
    for _ in range(steps):
        p = 1 / (1 + np.exp(-(x @ w)))
        w -= (x.T @ (p - toxic) + pull * (w - DEFAULTS)) / scale / 2
        w[1:] = np.maximum(w[1:], 0)
    w[0] = min(w[0], -1.0)
    return w


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    max_labelled: int = 12_000,
) -> Grammar:
    """A grammar from the given labels; pass only those that may be learned from."""
    labelled = _labelled(docs, labels, id_col, text_col, label_col, max_labelled)
    insults = learn_insults(labelled)
    rows = _features(labelled, make_grammar(insults), ["toxic"], "text").select("toxic", "emitted").collect()  # bounded by max_labelled
    if not rows:
        return make_grammar(insults)
    return make_grammar(insults, fit_logistic(np.array([r["emitted"] for r in rows]), np.array([r["toxic"] for r in rows], dtype=float)))


def score(docs: DataFrame, grammar: Grammar, keep: list[str], text_col: str = "text") -> DataFrame:
    """`keep` columns with emitted, n_clauses, worst_clause and score for every document."""
    return _features(docs, grammar, keep, text_col)


def may_learn(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return labels.filter(remainder(F.col(id_col), 5) != 0)


@query("op2_toxicity")
def toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    grammar = train(docs, may_learn(table(spark, sf_dir, "labels")))
    return score(docs, grammar, ["doc_id"]).select(
        "doc_id",
        (remainder(F.col("doc_id"), 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "n_clauses",
        "worst_clause",
    )


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents with a score of 0.5 or more go, all columns of the others stay."""
    grammar = train(docs, may_learn(table(spark, sf_dir, "labels")))
    rows = docs.select(whole_row(docs).alias("row"), F.col("text").alias("text"))
    return score(rows, grammar, ["row"]).filter(F.col("score") < 0.5).select("row.*")
