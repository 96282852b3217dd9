"""Ranked lexical search with bag deduplication: the best documents for each item of a query set, in integer scores.

1. The vocabulary is the distinct terms of the items. Documents are read once by
   a kernel that counts all their terms and keeps, of the vocabulary's, a bag:
   term numbers and occurrences. Terms are looked up by 64-bit hashes and
   compared byte by byte, so nothing rests on a hash alone. Bags are staged.
2. N and L come from one aggregate over the bags, document frequencies from
   counts per task, summed by Spark.
3. With them each document has its m. Documents with the same bag and m score the
   same for every item: they are one class. Rows are dealt by a hash of both, and
   inside a hash compared whole. Of a class the `k` smallest ids are kept, as no
   other member can be among the best k; they are ranked before the shuffle too,
   so a class of a third of all rows sends k rows from each task.
4. Each class is scored once against all items, by postings (term to items).
   Every task keeps its best k documents per item, expanding members by rising
   id; a last ranking joins those of the tasks.

A vocabulary beyond `block_bytes` is worked off in blocks of whole items, each
against all documents: blocks depend on the items alone. What tasks get is the
vocabulary and postings of one block.

Scores are 64-bit integers. For sums of at most 2^53 they are added as doubles,
exactly; beyond, as integers.

Defined cases: null text has no terms, and such documents count nowhere; rows
are documents of their own, also if an id is repeated or null (null ids come
last among equals); items of one id are one item with the terms of all; items
without an id or terms have no results; other columns are not read; empty
tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rawgate.llm.common import (
    ALNUM_WORD,
    IS_ALNUM,
    LOWER_BYTES,
    arrow_map,
    ascii_lower,
    find_words,
    hash_words,
    row_of,
    slices,
    staged,
    table,
    word_hashes,
    words_of,
)
from rawgate.llm.registry import query

TOP_K = 10
#: bytes of terms that are looked up in one pass over the documents
BLOCK_BYTES = 8 << 20
#: cells of classes times items that are scored at once
CELLS = 1 << 20
LAST_ID = np.iinfo(np.int64).max


@dataclass
class Vocabulary:
    """Terms in order of their hashes; term i is data[starts[i]:starts[i] + sizes[i]]."""

    hashes: np.ndarray
    data: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray

    @classmethod
    def of(cls, terms: list[str]) -> Vocabulary:
        hashes = hash_words(terms)
        order = np.argsort(hashes, kind="stable")
        listed = [terms[i].encode() for i in order]
        sizes = np.array([len(t) for t in listed], dtype=np.int64)
        starts = np.concatenate(([0], np.cumsum(sizes)))[:-1].astype(np.int64)
        return cls(hashes[order], np.frombuffer(b"".join(listed) or b" ", dtype=np.uint8), starts, sizes)

    def find(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(word, term): which of the words are terms, and which ones."""
        if not len(starts) or not len(self.hashes):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        wanted = word_hashes(buf, starts, ends)
        term = np.searchsorted(self.hashes, wanted)
        word = np.flatnonzero(self.hashes[np.minimum(term, len(self.hashes) - 1)] == wanted)
        term = term[word]
        last = np.searchsorted(self.hashes, wanted[word], side="right")
        found_words, found_terms = [word[:0]], [term[:0]]
        while len(word):  # a second round only where two terms share a hash
            same = self._same(buf, starts[word], ends[word] - starts[word], term)
            found_words.append(word[same])
            found_terms.append(term[same])
            again = ~same & (term + 1 < last)
            word, term, last = word[again], term[again] + 1, last[again]
        return np.concatenate(found_words), np.concatenate(found_terms)

    def _same(self, buf: np.ndarray, starts: np.ndarray, sizes: np.ndarray, term: np.ndarray) -> np.ndarray:
        same = self.sizes[term] == sizes
        at = np.flatnonzero(same)
        if len(at):
            n = sizes[at]
            first = np.concatenate(([0], np.cumsum(n)[:-1]))
            step = np.arange(int(n.sum())) - np.repeat(first, n)
            ours = LOWER_BYTES[buf[np.repeat(starts[at], n) + step]]
            theirs = self.data[np.repeat(self.starts[term[at]], n) + step]
            same[at] = np.add.reduceat((ours != theirs).astype(np.int64), first) == 0
        return same


def item_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """item_id, term: the distinct terms of each item."""
    words = words_of(ascii_lower(F.col(text_col).cast("string")), ALNUM_WORD)
    return items.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("item_id"), F.explode(words).alias("term")).distinct()


def _lists(values: np.ndarray, row: np.ndarray, n_rows: int) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(n_rows + 1)).astype(np.int32)), pa.array(values.astype(np.int32)))


def bags(docs: DataFrame, terms: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n (terms of the document), term_nos and tfs (of the vocabulary, by rising number); only documents with terms."""
    vocabulary = Vocabulary.of(terms)
    size = np.int64(max(len(terms), 1))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, stop, buf, offsets in slices(batch.column(1)):
                starts, ends, pointer = find_words(buf, offsets, IS_ALNUM)
                word, term = vocabulary.find(buf, starts, ends)
                pairs, tfs = np.unique(row_of(pointer)[word] * size + term, return_counts=True)
                row, n = pairs // size, np.diff(pointer)
                columns = [batch.column(0).slice(first, stop - first), pa.array(n), _lists(pairs % size, row, len(n)), _lists(tfs, row, len(n))]
                out = pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "term_nos", "tfs"])
                yield out.filter(pa.array(n > 0))

    return arrow_map(rows, run, "doc_id long, n long, term_nos array<int>, tfs array<int>")


def document_frequencies(bagged: DataFrame, n_terms: int) -> np.ndarray:
    """For each term number the number of bags with it: counted in tasks, summed by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_terms, dtype=np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy(zero_copy_only=False), minlength=n_terms)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met.astype(np.int32)), pa.array(total[met])], ["term_no", "df"])

    counted = arrow_map(bagged.select("term_nos"), run, "term_no int, df long").groupBy("term_no").agg(F.sum("df").alias("df"))
    df = np.zeros(n_terms, dtype=np.int64)
    for row in counted.collect():
        df[row["term_no"]] = row["df"]
    return df


def classes(bagged: DataFrame, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """m, term_nos, tfs, members (at most the k smallest ids, rising): a row per class of documents that score alike."""
    m = F.expr(f"100 - 90 + ((90L * n * {n_docs}L) div {n_terms}L)")
    keyed = bagged.filter(F.size("term_nos") > 0).select("doc_id", m.alias("m"), "term_nos", "tfs")
    keyed = keyed.withColumn("class", F.xxhash64("m", "term_nos", "tfs"))
    alike = Window.partitionBy("class", "m", "term_nos", "tfs")
    order = F.coalesce(F.col("doc_id"), F.lit(int(LAST_ID)))
    first = keyed.withColumn("_order", order).withColumn("place", F.row_number().over(alike.orderBy("_order"))).filter(F.col("place") <= k)
    members = F.sort_array(F.collect_list(F.struct("place", "doc_id")))
    grouped = first.groupBy("class", "m", "term_nos", "tfs").agg(members.alias("members"))
    return grouped.select("m", "term_nos", "tfs", F.col("members.doc_id").alias("members"))


class TopK:
    """The best k (score falling, id rising) of each item, over batches of candidates."""

    def __init__(self, n_items: int, k: int) -> None:
        self.k, self.n_items = k, n_items
        self.item, self.score, self.order, self.null = (np.zeros(0, np.int64) for _ in range(4))

    def least(self) -> np.ndarray:
        """By item the score below which nothing can enter."""
        least = np.ones(self.n_items, dtype=np.int64)
        counts = np.bincount(self.item, minlength=self.n_items)
        full = np.flatnonzero(counts >= self.k)
        lowest = np.full(self.n_items, np.iinfo(np.int64).max)
        np.minimum.at(lowest, self.item, self.score)
        least[full] = lowest[full]
        return least

    def add(self, item: np.ndarray, score: np.ndarray, order: np.ndarray, null: np.ndarray) -> None:
        merged = [np.concatenate(x) for x in ((self.item, item), (self.score, score), (self.order, order), (self.null, null))]
        by = np.lexsort((merged[3], merged[2], -merged[1], merged[0]))
        item = merged[0][by]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        self.item, self.score, self.order, self.null = (x[by][place < self.k] for x in merged)


def score_classes(grouped: DataFrame, weights: np.ndarray, posting_starts: np.ndarray, posting_items: np.ndarray, n_items: int, k: int) -> DataFrame:
    """item_no, doc_id, score: the best k documents per item of each task. Term t stands in items posting_items[posting_starts[t]:posting_starts[t + 1]]."""
    sizes = np.diff(posting_starts)
    exact_as_double = int(weights.max(initial=0)) * 1_000_000 * len(weights) < 1 << 53
    step = max(1, CELLS // max(n_items, 1))

    def scores(m: np.ndarray, row: np.ndarray, term: np.ndarray, tf: np.ndarray) -> np.ndarray:
        part = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[row]))
        n = sizes[term]
        first = np.concatenate(([0], np.cumsum(n)[:-1])) if len(n) else np.zeros(0, np.int64)
        at = np.arange(int(n.sum())) - np.repeat(first, n) + np.repeat(posting_starts[term], n)
        cell = np.repeat(row * n_items, n) + posting_items[at]
        values = np.repeat(part, n)
        if exact_as_double:
            return np.bincount(cell, weights=values, minlength=len(m) * n_items).astype(np.int64)
        total = np.zeros(len(m) * n_items, dtype=np.int64)
        np.add.at(total, cell, values)
        return total

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = TopK(n_items, k)
        for whole in batches:
            for at in range(0, whole.num_rows, step):
                batch = whole.slice(at, step)
                m = batch.column("m").to_numpy(zero_copy_only=False)
                terms, members = batch.column("term_nos"), batch.column("members")
                row = np.repeat(np.arange(len(m)), terms.value_lengths().to_numpy(zero_copy_only=False))
                term = terms.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                tf = batch.column("tfs").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                total = scores(m, row, term, tf).reshape(len(m), n_items)
                group, item = np.nonzero(total >= top.least())
                n = members.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
                first = np.concatenate(([0], np.cumsum(n)[:-1]))
                ids = members.flatten()
                order, null = ids.fill_null(int(LAST_ID)).to_numpy(zero_copy_only=False), ids.is_null().to_numpy(zero_copy_only=False)
                each = n[group]  # a class has k members at most
                inside = np.arange(int(each.sum())) - np.repeat(np.cumsum(each) - each, each) + np.repeat(first[group], each)
                top.add(np.repeat(item, each), np.repeat(total[group, item], each), order[inside], null[inside].astype(np.int64))
        ids = pa.array(top.order, pa.int64(), mask=top.null.astype(bool))
        yield pa.RecordBatch.from_arrays([pa.array(top.item.astype(np.int32)), ids, pa.array(top.score)], ["item_no", "doc_id", "score"])

    return arrow_map(grouped, run, "item_no int, doc_id long, score long")


def _search_block(docs: DataFrame, terms_of_items: DataFrame, k: int, id_col: str, text_col: str) -> DataFrame | None:
    spark = docs.sparkSession
    terms = sorted(r["term"] for r in terms_of_items.select("term").distinct().collect())
    if not terms:
        return None
    listed = Vocabulary.of(terms)
    names = [bytes(listed.data[s : s + n]).decode() for s, n in zip(listed.starts, listed.sizes, strict=True)]
    number = {t: i for i, t in enumerate(names)}
    pairs = terms_of_items.collect()
    items = sorted({r["item_id"] for r in pairs})
    item_no = {x: i for i, x in enumerate(items)}
    posted = sorted((number[r["term"]], item_no[r["item_id"]]) for r in pairs)
    posting_items = np.array([i for _, i in posted], dtype=np.int64)
    posting_starts = np.searchsorted(np.array([t for t, _ in posted], dtype=np.int64), np.arange(len(terms) + 1))

    bagged = staged(bags(docs, names, id_col, text_col), "lexical-bags")
    totals = bagged.agg(F.count("*").alias("docs"), F.sum("n").alias("terms")).collect()[0]
    if not totals["docs"]:
        return None
    df = document_frequencies(bagged, len(terms))
    weights = np.floor(1000 * np.log((2 * totals["docs"] + 2) / (2 * df + 1))).astype(np.int64)
    grouped = classes(bagged, totals["docs"], totals["terms"], k)
    best = staged(score_classes(grouped, weights, posting_starts, posting_items, len(items), k), "lexical-best")
    kind = terms_of_items.schema["item_id"].dataType
    schema = T.StructType([T.StructField("item_no", T.IntegerType()), T.StructField("item_id", kind)])
    ids = spark.createDataFrame([(i, x) for x, i in item_no.items()], schema)
    ranked = Window.partitionBy("item_no").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    top = best.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k)
    return top.join(F.broadcast(ids), "item_no").select("item_id", "rank", "doc_id", "score")


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = TOP_K,
    block_bytes: int = BLOCK_BYTES,
    doc_id: str = "doc_id",
    item_id: str = "item_id",
    text_col: str = "text",
) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of each item."""
    spark = docs.sparkSession
    terms = staged(item_terms(items, item_id, text_col), "lexical-items")
    size = terms.agg(F.sum(F.octet_length("term") + 24)).collect()[0][0] or 0
    n_blocks = -(-size // block_bytes)
    block = F.pmod(F.xxhash64("item_id"), F.lit(max(n_blocks, 1)))
    found = None
    for b in range(n_blocks):
        part = _search_block(docs, terms.filter(block == b), k, doc_id, text_col)
        if part is not None:
            found = part if found is None else found.unionByName(part)
    if found is None:
        kind = terms.schema["item_id"].dataType.simpleString()
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    return found


_SQL_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_SQL_TERMS = f"translate(unnest(regexp_extract_all(text, '{_SQL_TERM}')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

RANKED_SQL = f"""
WITH t AS (SELECT doc_id, {_SQL_TERMS} AS term FROM documents),
q AS (SELECT DISTINCT item_id, {_SQL_TERMS} AS term FROM benchmark),
lengths AS (SELECT doc_id, count(*) AS n FROM t GROUP BY doc_id),
totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM lengths),
tf AS (SELECT doc_id, term, count(*) AS tf FROM t WHERE term IN (SELECT term FROM q) GROUP BY doc_id, term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, totals GROUP BY term, docs),
parts AS (SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + ((90 * n * docs) // terms)))) AS part
          FROM tf JOIN w USING (term) JOIN lengths USING (doc_id), totals),
scores AS (SELECT item_id, doc_id, CAST(sum(part) AS BIGINT) AS score FROM q JOIN parts USING (term) GROUP BY item_id, doc_id HAVING sum(part) > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores) WHERE rank <= {TOP_K}
"""


@query("op12_ranked_search", RANKED_SQL)
def ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
