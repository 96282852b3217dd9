"""Quality rules with adaptive thresholds, DataFrame functions only.

Per text the measures are counted (words, symbols, repeated lines, words in
repeated windows). Instead of fixed cutoffs, the limits of a group of similar
documents come from quantile sketches (KLL) of its own measures. A sketch is
kept per language and source; sketches merge, so a group too small to speak
for itself uses the merged sketch of its language, and a small language that of
the whole corpus. A measure is out of bounds beyond

    upper quantile + reach * max(upper quantile - median, least spread)

of its group (word length also below the mirrored bound). For symbols and word
length the quantile is the upper quartile. Most documents repeat nothing, so the
quartiles of repeats are 0; their quantile is that of 95 %, and what a twentieth
of a group reaches is usual in it. The least spread of repeated words lies below
the base rule, but lets one chance repeat of a window in a short text pass. Limits are joined
back to the documents and all rules are judged in one filter.

Plan: one pass over the texts writes the measures; sketches are aggregated on
the map side, one row per group and task is shuffled; limits are one row per
group, broadcast only if their counted size allows it.

Defined cases: null text has no words and fails the base rule; null language
or source is a group of its own; null or repeated ids are passed through, one
row each; other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rawgate.llm.common import SPACED_WORD, broadcast_if_small, staged, table, words_of
from rawgate.llm.registry import query

WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

#: measures judged: name, least spread, whether there is a lower limit too
RATIOS = (("symbol_ratio", 0.005, False), ("dup_line_ratio", 0.10, False), ("repeat_ratio", 0.15, False), ("word_length", 0.5, True))
REACH = 6.0
#: measures that are 0 in most documents: upper quantile and reach
TAILS = {"dup_line_ratio": (0.95, 1.0), "repeat_ratio": (0.95, 1.0)}
LEAST_GROUP = 200


def with_repeats(df: DataFrame) -> DataFrame:
    """Adds n_repeat_words: words in windows that occur at least twice in `_windows`.

    Windows are ranked by value, then place, so the work is n log n for any
    text. Those equal to a neighbour in that ranking are repeated; each covers
    WINDOW words from its place, less what the next repeated place covers too.
    Texts without a repeated window, nearly all, stop at the first step.
    """
    some = F.size(F.array_distinct("_windows")) < F.size("_windows")
    ranked = F.sort_array(F.transform("_windows", lambda w, i: F.struct(w.alias("w"), i.alias("i"))))

    def repeated(x: Column, i: Column) -> Column:
        near = [F.coalesce(x["w"] == F.get(F.col("_ranked"), k)["w"], F.lit(False)) for k in (i - 1, i + 1)]
        return near[0] | near[1]

    places = F.sort_array(F.transform(F.filter("_ranked", repeated), lambda x: x["i"]))
    covered = F.transform(
        "_places", lambda here, i: F.least(F.lit(WINDOW), F.coalesce(F.get(F.col("_places"), i + 1) - here, F.lit(WINDOW)))
    )
    total = F.aggregate(covered, F.lit(0).cast("long"), lambda n, x: n + x)
    return (
        df.withColumn("_ranked", F.when(some, ranked))
        .withColumn("_places", F.when(F.col("_ranked").isNotNull(), places))
        .withColumn("n_repeat_words", F.coalesce(total, F.lit(0).cast("long")))
        .drop("_ranked", "_places")
    )


def measure(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """`keep` columns with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    lines = F.filter(F.split(F.col("_text"), "\n", -1), lambda x: x.rlike(SPACED_WORD))
    hashed = F.transform("_words", lambda w: F.xxhash64(w))
    starts = F.when(F.size("_h") >= WINDOW, F.sequence(F.lit(1), F.size("_h") - (WINDOW - 1)))
    windows = F.transform(starts, lambda i: F.xxhash64(*[F.element_at(F.col("_h"), i + k) for k in range(WINDOW)]))
    counted = (
        docs.select(*keep, text.alias("_text"))
        .select(*keep, "_text", words_of(F.col("_text"), SPACED_WORD).alias("_words"), lines.alias("_lines"))
        .select(
            *keep,
            F.size("_words").cast("long").alias("n_words"),
            F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
            F.regexp_count(F.col("_text"), F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
            (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
            F.size("_lines").cast("long").alias("n_lines"),
            hashed.alias("_h"),
        )
        .withColumn("_windows", F.coalesce(windows, F.array().cast("array<bigint>")))
    )
    return with_repeats(counted).drop("_h", "_windows")


def with_ratios(measured: DataFrame) -> DataFrame:
    def share(part: str, whole: str) -> Column:
        return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(0.0)

    return measured.withColumns(
        {
            "symbol_ratio": share("n_symbols", "word_chars"),
            "dup_line_ratio": share("n_dup_lines", "n_lines"),
            "repeat_ratio": share("n_repeat_words", "n_words"),
            "word_length": share("word_chars", "n_words"),
        }
    )


def base_rule() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def sketches(measured: DataFrame, group_cols: list[str]) -> DataFrame:
    """One KLL sketch per measure and group, over the documents that pass the base rule."""
    passing = with_ratios(measured).filter(~base_rule())
    return passing.groupBy(*group_cols).agg(
        F.count("*").alias("n"), *[F.expr(f"kll_sketch_agg_double({name})").alias(name) for name, _, _ in RATIOS]
    )


def merged(fine: DataFrame, group_cols: list[str]) -> DataFrame:
    """Sketches of larger groups, from those of their parts."""
    return fine.groupBy(*group_cols).agg(F.sum("n").alias("n"), *[F.expr(f"kll_merge_agg_double({name})").alias(name) for name, _, _ in RATIOS])


def limits_of(sketched: DataFrame, group_cols: list[str], reach: float = REACH) -> DataFrame:
    """Lower and upper limit of each measure for each group."""
    out = []
    for name, least, two_sided in RATIOS:
        upper, times = TAILS.get(name, (0.75, reach))
        low, mid, high = (F.expr(f"kll_sketch_get_quantile_double({name}, {q}D)") for q in (0.25, 0.5, upper))
        out.append((high + times * F.greatest(high - mid, F.lit(least))).alias(f"{name}_most"))
        if two_sided:
            out.append((low - times * F.greatest(mid - low, F.lit(least))).alias(f"{name}_least"))
    return sketched.select(*group_cols, "n", *out)


def adaptive_limits(measured: DataFrame, lang_col: str, source_col: str, reach: float = REACH, least_group: int = LEAST_GROUP) -> DataFrame:
    """One row of limits per (language, source): of its own sketch, its language's or the corpus's, as its size allows."""
    fine = staged(sketches(measured, [lang_col, source_col]), "quality-sketches")
    by_lang = merged(fine, [lang_col])
    names = [f"{n}_most" for n, _, _ in RATIOS] + [f"{n}_least" for n, _, two in RATIOS if two]

    def packed(df: DataFrame, group_cols: list[str], alias: str) -> DataFrame:
        return limits_of(df, group_cols, reach).select(
            *[F.col(c).alias(f"{alias}_{c}") for c in group_cols], F.struct("n", *names).alias(alias)
        )

    own, lang = packed(fine, [lang_col, source_col], "own"), packed(by_lang, [lang_col], "lang")
    whole = limits_of(merged(by_lang, []).filter("n > 0"), [], reach).collect()  # one row of numbers, or none
    corpus = F.struct(*[F.lit(whole[0][c] if whole else None).cast("long" if c == "n" else "double").alias(c) for c in ("n", *names)])
    joined = own.join(lang, F.col(f"own_{lang_col}").eqNullSafe(F.col(f"lang_{lang_col}")), "left")
    chosen = F.when(F.col("own.n") >= least_group, F.col("own")).when(F.col("lang.n") >= least_group, F.col("lang")).otherwise(corpus)
    return joined.select(F.col(f"own_{lang_col}").alias("_lang"), F.col(f"own_{source_col}").alias("_source"), chosen.alias("_limits"))


def verdict() -> Column:
    """Whether every measure lies within the group's limits; true where no group could be formed."""
    good = F.lit(True)
    for name, _, two_sided in RATIOS:
        good = good & (F.col(name) <= F.col(f"_limits.{name}_most"))
        if two_sided:
            good = good & (F.col(name) >= F.col(f"_limits.{name}_least"))
    return F.coalesce(good, F.lit(True))


def quality_rules(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    reach: float = REACH,
    least_group: int = LEAST_GROUP,
) -> DataFrame:
    """Per document: id, measures, ratios, base_failed and kept."""
    keyed = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_raw"), F.col(lang_col).alias("_lang"), F.col(source_col).alias("_source"))
    measured = staged(measure(keyed, ["_id", "_lang", "_source"], "_raw"), "quality-measures")
    limits = staged(adaptive_limits(measured, "_lang", "_source", reach, least_group), "quality-limits")
    limits = broadcast_if_small(limits.withColumnsRenamed({"_lang": "_l", "_source": "_s"}), row_bytes=256)
    joined = with_ratios(measured).join(limits, F.col("_lang").eqNullSafe(F.col("_l")) & F.col("_source").eqNullSafe(F.col("_s")), "left")
    return joined.withColumn("base_failed", base_rule()).select(
        F.col("_id").alias(id_col),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & verdict()).alias("kept"),
        *[n for n, _, _ in RATIOS],
    )


@query("op8_quality_rules")
def quality_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
