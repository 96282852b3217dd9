"""Mixing sources to target weights by Poisson replication.

Each source has a mean repetition rate: its target share of the budget over
its size. A document's copy count is the Poisson quantile at a number in [0, 1)
that is a hash of seed, id and text, so counts do not depend on partitions, order
or retries, and equal rows get equal counts. Documents are exploded by
their count and dealt out globally by a hash of seed, id and copy number: one
shuffle by a uniform key, then sorted by it within each partition.

Counts come from a table of cumulative probabilities per source, computed once
(in logarithms, so large rates do not underflow) around the rate, and looked up
per document by halving: the count is the number of entries not above the hash.
The table ends where the remaining probability is below 1e-15, beyond any value
of the 52-bit hash.

Defined cases: null text has size 0; a null source is a source; sources
without weight get no copies, weights of absent sources are ignored and those
present are scaled to 1; a source of size 0 gets rate 1; weights must be
finite and not negative; an empty table gives no rows; other columns are
carried along, whatever their names, unless they are `copy` or `shuffle_key`,
which are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rawgate.llm.common import BROADCAST_BYTES, staged, table, whole_row
from rawgate.llm.registry import query

SEED = "mix-1"
#: exponent of the default weights: target shares go with size to this power
TEMPERATURE = 0.5
HASH_DIGITS = 13
HASH_STEPS = float(16**HASH_DIGITS)


def hashed(*parts: Column) -> Column:
    """A number in [0, 1) from 52 bits of the MD5 of the parts."""
    text = F.concat_ws("/", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, HASH_DIGITS), 16, 10).cast("double") / F.lit(HASH_STEPS)


def source_sizes(docs: DataFrame, source_col: str = "source", text_col: str = "text") -> DataFrame:
    """Documents and characters per source, over the whole table."""
    return docs.groupBy(F.col(source_col).alias("source")).agg(
        F.count("*").alias("n_docs"), F.sum(F.coalesce(F.length(text_col), F.lit(0))).cast("long").alias("n_chars")
    )


def rates(sizes: DataFrame, weights: dict[str | None, float] | None = None, temperature: float = TEMPERATURE, budget: float = 1.0) -> DataFrame:
    """Per source its target share, mean repetition rate and cumulative Poisson table (`first`, `cdf`).

    `weights` are target weights by source; without them the target share of a
    source goes with its size to the power `temperature`. `budget` is the size
    of the mixture in corpus sizes.
    """
    if weights is None:
        weight = F.pow(F.col("n_chars").cast("double"), F.lit(temperature))
    else:
        if any(not math.isfinite(w) or w < 0 for w in weights.values()):
            raise ValueError("weights must be finite and not negative")
        weight = F.lit(0.0)
        for name, value in weights.items():
            here = F.col("source").isNull() if name is None else F.col("source") == name
            weight = F.when(here, F.lit(float(value))).otherwise(weight)
    weighed = staged(sizes, "mixing-sizes").withColumn("weight", weight)
    totals = weighed.agg(F.sum("weight").alias("weight"), F.sum("n_chars").alias("chars")).collect()[0]  # one row of numbers
    share = F.col("weight") / F.lit(totals["weight"]) if totals["weight"] else F.lit(0.0)
    rate = F.when(F.col("n_chars") > 0, F.lit(budget) * F.col("share") * F.lit(totals["chars"] or 0) / F.col("n_chars")).otherwise(1.0)
    rated = weighed.withColumn("share", share).withColumn("rate", rate).select("source", "n_docs", "n_chars", "share", "rate")
    tables = cumulative(rated).withColumnRenamed("source", "_of")
    met = rated.join(tables, F.col("source").eqNullSafe(F.col("_of")), "left").drop("_of")
    return met.withColumns({"first": F.coalesce("first", F.lit(0)), "cdf": F.coalesce("cdf", F.array().cast("array<double>"))})


def _log_probability(rate: Column, k: Column) -> Column:
    """Logarithm of the probability of k copies; k! by Stirling's series, whose terms are put together so that nothing large cancels."""
    n = k.cast("double")
    series = 1 / (12 * n) - 1 / (360 * n * n * n) + 1 / (1260 * F.pow(n, F.lit(5.0)))
    far = (n - rate) + n * F.log1p((rate - n) / n) - 0.5 * F.log(2 * math.pi * n) - series
    return F.when(k > 0, far).otherwise(-rate)


def cumulative(by_source: DataFrame) -> DataFrame:
    """source, first, cdf: cumulative probabilities of first, first + 1, ... copies, for the rates above 0.

    The table holds what lies within ten deviations of the rate; what lies below
    or above has no probability that the hash could tell from 0 or 1. It is a
    running sum over exploded rows, so its cost grows with the root of the rate.
    """
    reach = 10 * F.sqrt("rate") + 24
    lowest = F.floor(F.col("rate") - reach)
    first = F.when(lowest < 50, 0).otherwise(lowest).cast("int")  # near 0 the series does not hold
    last = F.ceil(F.col("rate") + reach).cast("int")
    placed = by_source.filter(F.col("rate") > 0).select("source", "rate", first.alias("first"), F.explode(F.sequence(first, last)).alias("k"))
    by = Window.partitionBy("source", "rate").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    step = F.when(F.col("k") == F.col("first"), _log_probability(F.col("rate"), F.col("first"))).otherwise(F.log("rate") - F.log(F.col("k").cast("double")))
    summed = placed.withColumn("p", F.exp(F.sum(step).over(by))).withColumn("total", F.sum("p").over(by))
    listed = summed.groupBy("source", "rate", "first").agg(F.sort_array(F.collect_list(F.struct("k", "total"))).alias("t"))
    return listed.select("source", "first", F.col("t.total").alias("cdf"))


def count_at(at: Column, first: Column, cdf: Column) -> Column:
    """The number of copies at a hash: `first` and the entries not above it, by halving the range that is left."""

    def halve(range_: Column, _: Column) -> Column:
        mid = F.floor((range_["low"] + range_["high"]) / 2).cast("int")
        below = F.get(cdf, mid) <= at
        open_ = range_["low"] < range_["high"]
        return F.struct(
            F.when(open_ & below, mid + 1).otherwise(range_["low"]).alias("low"), F.when(open_ & ~below, mid).otherwise(range_["high"]).alias("high")
        )

    start = F.struct(F.lit(0).alias("low"), F.size(cdf).alias("high"))
    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.size(cdf) + F.lit(1))).cast("int"))
    return first + F.aggregate(steps, start, halve, lambda range_: range_["low"])


def mix(
    docs: DataFrame,
    weights: dict[str | None, float] | None = None,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    seed: str = SEED,
    temperature: float = TEMPERATURE,
    budget: float = 1.0,
) -> DataFrame:
    """The mixture: all columns of `docs`, `copy` (from 1) and `shuffle_key`, in global random order.

    The order is that of shuffle_key within partitions; partitions are by its hash.
    """
    by_source = staged(rates(source_sizes(docs, source_col, text_col), weights, temperature, budget), "mixing-rates")
    by_source = by_source.select(F.col("source").alias("_source"), "rate", "first", "cdf")
    measured = by_source.agg(F.sum(F.size("cdf") * 8 + F.coalesce(F.length("_source"), F.lit(0)) + 64)).collect()[0][0] or 0
    by_source = F.broadcast(by_source) if measured <= BROADCAST_BYTES else by_source  # else AQE splits the hot source
    kept = docs.drop("copy", "shuffle_key")
    id_of, source, text = F.col(id_col), F.col(source_col), F.coalesce(F.col(text_col), F.lit(""))
    at = hashed(F.lit(seed), F.lit("count"), id_of, F.md5(text.cast("binary")))
    rows = kept.select(whole_row(kept).alias("row"), id_of.alias("id"), source.alias("source"), at.alias("at"))
    counted = (
        rows.join(by_source, F.col("source").eqNullSafe(F.col("_source")), "inner")
        .withColumn("n", F.when(F.col("rate") > 0, count_at(F.col("at"), F.col("first"), F.col("cdf"))).otherwise(0))
        .filter(F.col("n") > 0)
    )
    copies = counted.select("row", "id", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("copy"))
    keyed = copies.withColumn("shuffle_key", hashed(F.lit(seed), F.lit("order"), F.col("id"), F.col("copy")))
    return keyed.repartition("shuffle_key").sortWithinPartitions("shuffle_key", "id", "copy").select("row.*", "copy", "shuffle_key")


MIX_SQL = f"""
WITH RECURSIVE s AS (
    SELECT source, count(*) AS n_docs, CAST(sum(coalesce(length(text), 0)) AS BIGINT) AS n_chars FROM documents GROUP BY source
), t AS (
    SELECT sum(pow(CAST(n_chars AS DOUBLE), {TEMPERATURE})) AS all_weight, sum(n_chars) AS all_chars FROM s
), r AS (
    SELECT source, CASE WHEN n_chars > 0 THEN pow(CAST(n_chars AS DOUBLE), {TEMPERATURE}) / all_weight * all_chars / n_chars ELSE 1.0 END AS rate FROM s, t
), c AS (
    SELECT source, rate, 0 AS k, -rate AS logp, exp(-rate) AS total FROM r WHERE rate > 0
    UNION ALL
    SELECT source, rate, k + 1, logp + ln(rate) - ln(CAST(k + 1 AS DOUBLE)), total + exp(logp + ln(rate) - ln(CAST(k + 1 AS DOUBLE)))
    FROM c WHERE k < ceil(rate + 10 * sqrt(rate) + 24)
), d AS (
    SELECT *, CAST(CAST('0x' || substr(md5('{SEED}/count/' || coalesce(CAST(doc_id AS VARCHAR), '') || '/' || md5(coalesce(text, ''))), 1, {HASH_DIGITS}) AS BIGINT) AS DOUBLE) / {HASH_STEPS} AS at
    FROM documents
), n AS (
    SELECT doc_id, text, lang, d.source, n_chars, (SELECT count(*) FROM c WHERE c.source IS NOT DISTINCT FROM d.source AND c.total <= d.at) AS n FROM d
), e AS (
    SELECT doc_id, text, lang, source, n_chars, unnest(range(1, n + 1)) AS copy FROM n
)
SELECT doc_id, text, lang, source, n_chars, CAST(copy AS INTEGER) AS copy,
       CAST(CAST('0x' || substr(md5('{SEED}/order/' || coalesce(CAST(doc_id AS VARCHAR), '') || '/' || copy), 1, {HASH_DIGITS}) AS BIGINT) AS DOUBLE) / {HASH_STEPS} AS shuffle_key
FROM e
"""


@query("op4_source_mixing", MIX_SQL)
def source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage, the last: the mixture of what is left."""
    return mix(docs)
