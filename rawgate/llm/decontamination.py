"""Benchmark decontamination with a positional inverted index, DataFrame functions only.

1. Corpus frequency of every benchmark term, counted over all documents
   (combined on the map side: one row per term and task is shuffled).
2. Every window of `window` consecutive item words gets its probes, the two
   rarest of its distinct terms. A window with a term the corpus does not have
   cannot occur and gets none.
3. The index: postings of all probe terms in all documents, written once as
   (term, document, position, neighbourhood). The neighbourhood is the words
   within a window's reach, so that no text is read again. A mark after the last
   word is posted too and gives each document's length.
4. Phrase matches: postings meet the probes, positions less item offsets say
   where an item would begin, and lists are intersected on (document, item,
   beginning). Where both probes of a window agree, the window is compared word
   by word in the neighbourhood, so matches are exact.
5. Proximity matches, from the same postings: items of which several probes
   stand at beginnings that differ by less than `slop` words. They have a query of
   their own, near_decontamination, as the columns of op5 are fixed by its SQL. A
   changed word may stand nowhere in the corpus, so there the probes are the two
   rarest terms that the corpus has.

Terms are joined by 64-bit hashes; the word by word comparison removes any
collision. Sides are broadcast only if their counted rows are few. Groups are as
large as an item or the matches of one document, never as a term's postings.

Defined cases: null text has no words; items without words or id are left out;
repeated items count once, items of one id with different texts are both
looked for; documents are told apart by id and text, and each input row gives
one result row, also if repeated or its id is null; other columns are not read;
empty tables on either side give no matches.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rawgate.llm.common import ALNUM_WORD, ascii_lower, broadcast_if_small, staged, table, whole_row, words_of
from rawgate.llm.registry import query

WINDOW = 10
#: end-of-document mark; the empty string is never a word
END_MARK = ""


def _tokens(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text_hash, tokens."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), text.alias("_text")).select(
        "doc_id", F.xxhash64("_text").alias("text_hash"), words_of(ascii_lower(F.col("_text")), ALNUM_WORD).alias("tokens")
    )


def benchmark_items(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """item_id, item_key, words of the items that have words and an id."""
    words = words_of(ascii_lower(F.col(text_col).cast("string")), ALNUM_WORD)
    return (
        benchmark.filter(F.col(id_col).isNotNull())
        .select(F.col(id_col).alias("item_id"), words.alias("words"))
        .filter(F.size("words") > 0)
        .distinct()
        .withColumn("item_key", F.xxhash64("item_id", "words"))
    )


def term_frequencies(tokens: DataFrame, items: DataFrame) -> DataFrame:
    """term, n: occurrences in the corpus of every term that an item has and the corpus too."""
    terms = staged(items.select(F.explode("words").alias("w")).select(F.xxhash64("w").alias("term")).distinct(), "decon-terms")
    # outer: else Spark puts a filter on the number of tokens below, and finds the words of every text for it once more
    words = tokens.select(F.explode_outer("tokens").alias("w")).filter(F.col("w").isNotNull())
    occurrences = words.select(F.xxhash64("w").alias("term"))
    return occurrences.join(broadcast_if_small(terms, 16), "term").groupBy("term").agg(F.count("*").alias("n"))


def item_windows(items: DataFrame, frequencies: DataFrame, window: int, near: bool = False) -> DataFrame:
    """Items with their windows: start, size and the offsets of the two rarest distinct terms (second null if there is one term).

    With `near`, terms that the corpus does not have are passed over, and their windows kept.
    """
    placed = items.select("item_id", "item_key", "words", F.posexplode("words").alias("offset", "w")).withColumn("term", F.xxhash64("w"))
    counted = placed.join(frequencies, "term", "left").groupBy("item_id", "item_key", "words")
    ranked = counted.agg(F.sort_array(F.collect_list(F.struct("offset", F.coalesce("n", F.lit(0)).alias("n"), "term"))).alias("ranked"))
    size = F.least(F.lit(window), F.size("words"))

    def probes(start: Column) -> Column:
        inside = F.slice(F.col("ranked"), start + 1, size)
        inside = F.filter(inside, lambda x: x["n"] > 0) if near else inside
        by_rarity = F.transform(inside, lambda x: F.struct(x["n"].alias("n"), x["offset"].alias("offset"), x["term"].alias("term")))
        first = F.array_min(by_rarity)
        second = F.array_min(F.filter(by_rarity, lambda x: x["term"] != first["term"]))
        return F.struct(start.alias("start"), size.alias("size"), first.alias("first"), second.alias("second"))

    windows = F.transform(F.sequence(F.lit(0), F.size("words") - size), probes)
    return ranked.select("item_id", "item_key", "words", F.filter(windows, lambda w: w["first"]["n"] > 0).alias("windows")).filter(
        F.size("windows") > 0
    )


def probes_of(items: DataFrame) -> DataFrame:
    """term, item_key, offset: where the probes of all windows stand in their items."""
    both = items.select("item_key", F.explode("windows").alias("w")).select("item_key", F.explode(F.array("w.first", "w.second")).alias("p"))
    return both.filter(F.col("p").isNotNull()).select(F.col("p.term").alias("term"), "item_key", F.col("p.offset").alias("offset")).distinct()


@dataclass
class PositionalIndex:
    """postings: term, doc_id, text_hash, pos, near_from, near (words from near_from on); lengths: doc_id, text_hash, n_words."""

    postings: DataFrame
    lengths: DataFrame


def build_index(tokens: DataFrame, terms: DataFrame, window: int = WINDOW) -> PositionalIndex:
    """Postings of the given terms (a column of 64-bit hashes) over all documents, written once."""
    mark = F.xxhash64(F.lit(END_MARK))
    wanted = staged(terms.select("term").distinct().unionByName(terms.sparkSession.range(1).select(mark.alias("term"))), "decon-probe-terms")
    # outer as in term_frequencies; there is always the mark
    marked = F.concat("tokens", F.array(F.lit(END_MARK)))
    placed = tokens.select("doc_id", "text_hash", "tokens", F.posexplode_outer(marked).alias("pos", "w")).withColumn(
        "term", F.xxhash64("w")
    )
    near_from = F.greatest(F.col("pos") - (window - 1), F.lit(0))
    near = F.when(F.col("w") != END_MARK, F.slice("tokens", near_from + 1, F.lit(2 * window - 1)))
    index = staged(
        placed.join(broadcast_if_small(wanted, 16), "term").select("term", "doc_id", "text_hash", "pos", near_from.alias("near_from"), near.alias("near")),
        "decon-index",
    )
    return PositionalIndex(
        index.filter(F.col("near").isNotNull()),
        index.filter(F.col("near").isNull()).select("doc_id", "text_hash", F.col("pos").cast("long").alias("n_words")),
    )


def _alignments(index: PositionalIndex, items: DataFrame) -> DataFrame:
    """Postings met with probes: doc_id, text_hash, item_key, begin (position less offset), offset, pos, near_from, near."""
    probes = staged(probes_of(items), "decon-probes")
    return index.postings.join(broadcast_if_small(probes, 32), "term").withColumn("begin", F.col("pos") - F.col("offset"))


def phrase_matches(index: PositionalIndex, items: DataFrame) -> DataFrame:
    """doc_id, text_hash, item_id, first, stop: every place where a window of an item stands, exactly."""
    where = F.struct("offset", "near_from", "near")
    agreed = _alignments(index, items).groupBy("doc_id", "text_hash", "item_key", "begin").agg(F.collect_set(where).alias("found"))
    met = agreed.join(broadcast_if_small(items, 4096), "item_key")

    def at(offset: Column) -> Column:
        return F.get(F.filter("found", lambda x: x["offset"] == offset), 0)

    def stands(w: Column) -> Column:
        here = at(w["first"]["offset"])
        first = F.col("begin") + w["start"]
        intersect = here.isNotNull() & (w["second"].isNull() | at(w["second"]["offset"]).isNotNull()) & (first >= 0)
        same = F.slice(here["near"], F.greatest(first - here["near_from"], F.lit(0)) + 1, w["size"]) == F.slice(
            F.col("words"), w["start"] + 1, w["size"]
        )
        return intersect & F.coalesce(same, F.lit(False))

    return (
        met.select("doc_id", "text_hash", "item_id", "begin", F.explode(F.filter("windows", stands)).alias("w"))
        .withColumn("first", F.col("begin") + F.col("w.start"))
        .select("doc_id", "text_hash", "item_id", "first", (F.col("first") + F.col("w.size")).alias("stop"))
    )


def proximity_matches(index: PositionalIndex, items: DataFrame, slop: int = 20, min_probes: int = 3) -> DataFrame:
    """doc_id, text_hash, item_id, n_probes, first, last: several of an item's probes near each other, in any order.

    Near are beginnings that differ by less than `slop`. They are put into
    overlapping bands of twice `slop`, so any that are near share a band, and
    are compared there. An item with fewer probe terms needs all of them.
    """
    needed = probes_of(items).groupBy("item_key").agg(F.least(F.lit(min_probes), F.countDistinct("term")).alias("needed"))
    band = F.floor(F.col("begin") / slop)
    place = F.struct("begin", "pos", "term")

    def terms_of(places: Column) -> Column:
        return F.array_distinct(F.transform(places, lambda x: x["term"]))

    def run_from(begin: Column) -> Column:
        inside = F.filter("places", lambda x: (x["begin"] >= begin) & (x["begin"] < begin + slop))
        at = F.transform(inside, lambda x: x["pos"])
        return F.struct(F.size(terms_of(inside)).alias("n"), F.array_min(at).alias("first"), F.array_max(at).alias("last"))

    bands = (
        _alignments(index, items)
        .select("doc_id", "text_hash", "item_key", place.alias("place"), F.explode(F.array(band, band + 1)).alias("band"))
        .groupBy("doc_id", "text_hash", "item_key", "band")
        .agg(F.collect_set("place").alias("places"))
        .join(needed, "item_key")
        .filter(F.size(terms_of(F.col("places"))) >= F.col("needed"))
    )
    begins = F.array_distinct(F.transform("places", lambda x: x["begin"]))
    runs = bands.select("doc_id", "text_hash", "item_key", "needed", F.explode(F.transform(begins, run_from)).alias("r")).filter("r.n >= needed")
    by_item = runs.groupBy("doc_id", "text_hash", "item_key").agg(
        F.max("r.n").alias("n_probes"), F.min("r.first").alias("first"), F.max("r.last").alias("last")
    )
    return by_item.join(items.select("item_key", "item_id"), "item_key").drop("item_key")


def covered(spans: Column) -> Column:
    """Number of words inside any of the spans."""
    start = F.struct(F.lit(0).alias("to"), F.lit(0).cast("long").alias("n"))

    def add(state: Column, span: Column) -> Column:
        new = F.greatest(span["stop"] - F.greatest(span["first"], state["to"]), F.lit(0))
        return F.struct(F.greatest(state["to"], span["stop"]).alias("to"), (state["n"] + new).alias("n"))

    return F.aggregate(F.sort_array(spans), start, add, lambda state: state["n"])


def index_corpus(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, near: bool = False
) -> tuple[PositionalIndex, DataFrame]:
    """The index over the corpus for the benchmark's probes, and the items with their windows."""
    tokens = _tokens(docs, id_col, text_col)
    items = staged(benchmark_items(benchmark), "decon-items")
    frequencies = staged(term_frequencies(tokens, items), "decon-frequencies")
    items = staged(item_windows(items, frequencies, window, near), "decon-windows")
    return build_index(tokens, probes_of(items), window), items


def _with_found(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Rows with the other columns of `found`, which has a row per doc_id and text_hash."""
    found = found.withColumnsRenamed({"doc_id": "_id", "text_hash": "_hash"})
    return rows.join(found, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")), "left").drop("_id", "_hash")


def contamination(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, near: bool = False
) -> DataFrame:
    """Per document: doc_id, text_hash, n_words, n_hit, items (sorted as strings); with `near` also near_items, of the proximity matches."""
    index, items = index_corpus(docs, benchmark, id_col, text_col, window, near)
    ids = F.sort_array(F.collect_set(F.col("item_id").cast("string")))
    by_doc = (
        phrase_matches(index, items)
        .groupBy("doc_id", "text_hash")
        .agg(F.collect_set(F.struct("first", "stop")).alias("spans"), ids.alias("items"))
        .select("doc_id", "text_hash", covered(F.col("spans")).alias("n_hit"), "items")
    )
    none = F.array().cast("array<string>")
    found = _with_found(index.lengths, by_doc).select(
        "doc_id", "text_hash", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("items", none).alias("items")
    )
    if not near:
        return found
    by_near = proximity_matches(index, items).groupBy("doc_id", "text_hash").agg(ids.alias("near_items"))
    return _with_found(found, by_near).withColumn("near_items", F.coalesce("near_items", none))


_SQL_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_SQL_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_SQL_WORD}')"

DECONTAMINATION_SQL = f"""
WITH d AS (SELECT doc_id, {_SQL_WORDS} AS w FROM documents),
i AS (SELECT item_id, w, least({WINDOW}, len(w)) AS n FROM (SELECT item_id, {_SQL_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
iw AS (SELECT DISTINCT item_id, n, array_to_string(w[s : s + n - 1], ' ') AS g FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS s FROM i)),
sizes AS (SELECT DISTINCT n FROM i),
dw AS (SELECT doc_id, n, s, array_to_string(w[s : s + n - 1], ' ') AS g FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, sizes WHERE len(w) >= n)),
m AS (SELECT doc_id, item_id, s, dw.n FROM dw JOIN iw ON dw.n = iw.n AND dw.g = iw.g),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM m) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM m) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)
"""


def _counted(items: str) -> tuple[Column, Column]:
    """Number of the listed items and a digest of their ids."""
    return F.size(items).cast("long"), F.sha2(F.array_join(items, ",").cast("binary"), 256)


def _exact_columns() -> list[Column]:
    n_items, digest = _counted("items")
    return [F.col("doc_id"), F.col("n_words"), F.col("n_hit"), n_items.alias("n_items"), digest.alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated")]


@query("op5_decontamination", DECONTAMINATION_SQL)
def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(*_exact_columns())


@query("near_decontamination")
def near_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of op5, and the items of which the document holds probes near each other."""
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), near=True)
    n_items, digest = _counted("near_items")
    return found.select(*_exact_columns(), n_items.alias("n_near_items"), digest.alias("near_items_sha256"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that hold a benchmark window go, all columns of the others stay."""
    found = contamination(docs, table(spark, sf_dir, "benchmark")).filter(F.col("n_hit") > 0)
    hit = broadcast_if_small(staged(found.select("doc_id", "text_hash").distinct(), "decon-hit"), 32)
    rows = docs.select(whole_row(docs).alias("row"), F.col("doc_id").alias("id"), F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("h"))
    return rows.join(hit, rows["id"].eqNullSafe(hit["doc_id"]) & (rows["h"] == hit["text_hash"]), "left_anti").select("row.*")
