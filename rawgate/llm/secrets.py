"""Secret scan with a random forest for false-positive removal, DataFrame functions and spark.ml only.

Candidates are private keys in PEM form (a block is one finding), runs of at
least 16 key characters that hold a digit or begin as a provider's keys do, and
any 8 or more non-blank signs that are assigned to a name with a word such as
`password` in it, in four languages (without quotes they end at a comma,
semicolon or ampersand; after `is` they need a digit and a letter). For each, the
word before it and the signs between them are kept, however long either is; they
stand on the same line or the one before. A name that is joined to its value by =
is that word. Features:

* length, shares of digits and upper case, whether it is a hex or digit string,
  known prefixes of providers, share of distinct characters;
* character transitions: changes between digits, lower and upper case, runs of
  consonants, vowels;
* dictionary coverage: share of its letters that words cover which are frequent
  in a language, counted over all whole documents. The dictionary stays a table:
  the parts of the values' letter runs are joined with it;
* path: separators, dots, extensions;
* neighbouring words: key-like or digest-like word before it, assignment, quote.

The forest is trained on labelled findings (context, candidate, label). Unless
given, these are made here from a bounded sample of documents: the sampled
documents give words and contexts, a hash of their id gives keys of known
formats (label 1) and look-alikes such as checksums, UUIDs, placeholders,
paths, identifiers and numbers (label 0). Nothing of this is a fixed input: it
follows the corpus. The sample has at most about `n_docs` documents, chosen by a
hash of the id, so the training's size does not depend on the corpus.

Scanning goes over every whole text: two cheap tests pass over texts and lines
that cannot hold a candidate, the full pattern reads what is left with the lines
around it, so that it finds what it would find in the whole text. Candidates are
scored as rows. Values never leave as they are: a finding shows their SHA-256.

Defined cases: null text has no candidates; null or repeated ids are passed
through, and each repeated row gives its own findings; equal values score alike;
an empty table trains on nothing but formats and gives no findings; other columns
are not read.
"""

from __future__ import annotations

import re

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rawgate.llm.common import ALNUM_WORD, BROADCAST_BYTES, ascii_lower, broadcast_if_small, staged, table, whole_row, words_of
from rawgate.llm.registry import query

KEY_CHARS = r"[A-Za-z0-9_+/=.-]"
#: characters of a run, and of a value that is assigned to a key word
LEAST, LEAST_NAMED = 16, 8
# Words that name secrets, words that name digests and numbers, prefixes of providers' keys,
# words that assign, and parts of which every name of a secret has one.
KEY_WORDS = (
    "token secret password passwd passwort passphrase passcode pwd apikey api_key access_key accesskey account_key accountkey auth bearer "
    "credential private_key client_secret kennwort geheimnis contraseña clave senha mot_de_passe motdepasse jeton"
)
DIGEST_WORDS = "sha sha1 sha256 md5 commit checksum digest hash revision etag uuid guid id build version order invoice"
PREFIXES = "AKIA ASIA ghp_ gho_ github_pat_ glpat- sk_live_ sk-ant- xoxb- xoxp- AIza eyJ"
ASSIGNING = "is ist est es lautet"
KEY_PARTS = "token secret passw passphrase passcode pwd apikey api_key access account auth bearer credential private_key kennwort geheim contrase clave senha mot_de_passe motdepasse jeton".split()


def _any_of(words: list[str]) -> str:
    """A pattern for any of the words that looks at a first letter once, whatever the case."""
    by_first: dict[str, list[str]] = {}
    for word in words:
        by_first.setdefault(word[0], []).append(word[1:])
    return f"(?i:(?=[{''.join(sorted(by_first))}])(?:" + "|".join(f"{c}(?:{'|'.join(rest)})" for c, rest in sorted(by_first.items())) + "))"


_KEY_WORD, _DIGEST_WORD = KEY_WORDS.replace(" ", "|"), DIGEST_WORDS.replace(" ", "|")
_PREFIX = PREFIXES.replace(" ", "|")

#: what may stand between a word and a value: blanks, quotes and signs, and one line end at most
_GAP = r"(?:[^\S\n]|[\"'=:]){0,8}+(?:\n(?:[^\S\n]|[\"'=:]){0,8}+)?+"
#: a private key
PEM = r"-----BEGIN [A-Z0-9 ]*?PRIVATE KEY-----[A-Za-z0-9+/=\s:,.\\]*+(?:-[A-Za-z0-9+/=\s:,.\\]++){0,16}+-----END [A-Z0-9 ]*?PRIVATE KEY-----"
#: a name with a key word in it, and its assignment
_NAME = rf"(?<![A-Za-z0-9_.-])[A-Za-z0-9_.-]*?{_any_of(KEY_WORDS.split())}[A-Za-z0-9_.-]*+"
NAMED = rf"{_NAME}(?:(?:[^\S\n]|[\"']){{0,4}}+[=:]{_GAP}|[^\S\n]++(?i:{ASSIGNING.replace(' ', '|')})[^\S\n]++(?=[^\s\"',;&]*[0-9])(?=[^\s\"',;&]*[A-Za-z]))"
#: what is assigned to it, unless that is a name with a colon itself
ASSIGNED = rf"(?![A-Za-z0-9_.-]+:\s)(?:(?<=[^\S\n](?:{ASSIGNING.replace(' ', '|')})[^\S\n])[^\s\"',;]{{{LEAST_NAMED},}}+|(?<=[\"'])[^\s\"']{{{LEAST_NAMED},}}+|(?<![\"'])[^\s\"',;&]{{{LEAST_NAMED},}}+)"
#: word before (not itself a candidate), signs between, candidate; possessive, so each text is read once
CANDIDATE = (
    rf"{PEM}|{NAMED}{ASSIGNED}|"
    rf"(?:(?<![^\s\"'=:,;<>(){{}}|])(?:(?!{KEY_CHARS}{{{LEAST}}})[^\s\"'=:,;<>(){{}}|]++|[A-Za-z_.-]{{{LEAST},}}+(?=[\s\"']{{0,4}}[=:]))"
    rf"(?=[\s\"'=:]){_GAP})?(?<!{KEY_CHARS})(?={KEY_CHARS}{{{LEAST}}})(?!{NAMED}{ASSIGNED}){KEY_CHARS}{{{LEAST},}}+"
)
#: names joined to a run by =
JOINED = r"^(?:[A-Za-z_][A-Za-z0-9_.-]*+=)++(?=[^=])"

MASK = "[SECRET]"

#: a word is in the dictionary if it is in this share of a language's documents, and in so many
COMMON_SHARE, COMMON_LEAST = 0.02, 5

FEATURES = [
    "length", "digits", "uppers", "hex_only", "digits_only", "prefixed", "distinct", "changes", "consonants", "vowels",
    "dictionary", "separators", "dots", "extension", "repeats", "key_word", "digest_word", "assigned", "quoted",
]


#: what a line with a candidate holds, whatever stands around it
_RUN, _KEY_PART = rf"(?<!{KEY_CHARS}){KEY_CHARS}{{{LEAST}}}", _any_of(KEY_PARTS)


def _worth_reading(docs: DataFrame, keep: list[str], text_col: str) -> DataFrame:
    """`keep` and `_text`: texts that may hold a candidate, with all lines emptied that are neither near a run nor near a key word."""
    texts = docs.select(*keep, F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_whole"))
    worth = texts.filter(F.col("_whole").rlike(_RUN) | F.col("_whole").rlike(_KEY_PART))
    lines = worth.withColumn("_lines", F.split("_whole", "\n", -1))
    hits = lines.withColumn("_hits", F.transform("_lines", lambda x: x.rlike(_RUN) | x.rlike(_KEY_PART)))

    def near(i: Column) -> Column:
        return F.coalesce(F.get("_hits", i), F.lit(False)) | F.coalesce(F.get("_hits", i - 1), F.lit(False)) | F.coalesce(F.get("_hits", i + 1), F.lit(False))

    kept = F.array_join(F.transform("_lines", lambda x, i: F.when(near(i), x).otherwise(F.lit(""))), "\n")
    whole = F.contains("_whole", F.lit("-----BEGIN "))
    return hits.select(*keep, F.when(whole, F.col("_whole")).otherwise(kept).alias("_text"))


def candidates(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """`keep` columns, place (from 0, in text order), before (word and signs) and value, a row per candidate."""
    found = F.regexp_extract_all("_text", F.lit(CANDIDATE), F.lit(0))
    # outer, so that no filter on the number of matches is put before it, which would look for them twice
    rows = _worth_reading(docs, keep, text_col).select(*keep, F.posexplode_outer(found).alias("place", "_match")).filter("_match IS NOT NULL")
    run = rf"{KEY_CHARS}{{{LEAST},}}+$"
    pem = F.col("_match").startswith("-----BEGIN ")
    assigned = F.regexp_extract("_match", f"^{NAMED}(?={ASSIGNED}$)", 0)
    tail = F.regexp_extract("_match", run, 0)
    joined = F.regexp_extract(tail, JOINED, 0)
    lead = F.when(pem, "").when(assigned != "", assigned).otherwise(F.concat(F.regexp_replace("_match", run, ""), joined))
    before = F.when(~pem & (assigned == "") & (joined != ""), joined).otherwise(F.col("_lead"))
    split = rows.withColumn("_lead", lead).withColumn("before", before).withColumn("value", F.expr("substring(_match, length(_lead) + 1)"))
    quoted = F.col("before").rlike("[\"']$")
    ends = F.when(_assigned_to_key_word() & ~quoted, F.regexp_replace("value", r"[.)\]}>]+$", "")).otherwise(F.regexp_replace("value", r"[.]+$", ""))
    return split.withColumn("value", ends).filter(_is_candidate()).drop("_match", "_lead")


def _assigned_to_key_word() -> Column:
    return F.lower("before").rlike(rf"({_KEY_WORD})[a-z0-9_.-]*(?:[\s\"']*[=:]|\s+(?:{ASSIGNING.replace(' ', '|')})\s+$)")


def _is_candidate() -> Column:
    named = (F.length("value") >= LEAST_NAMED) & _assigned_to_key_word()
    return named | ((F.length("value") >= LEAST) & F.col("value").rlike(f"[0-9]|^(?:{_PREFIX})|^-----BEGIN "))


def dictionary(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """w: the words of 3 to 12 letters that are frequent in a language: those of COMMON_SHARE of its documents, and of COMMON_LEAST.

    Every whole document counts, each word once; counts are combined on the map
    side. The words are a written table. Without a language column all documents
    are of one language.
    """
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit("")) if lang_col in docs.columns else F.lit("")
    keyed = docs.select(lang.alias("_lang"), F.col(text_col).cast("string").alias("_text"))
    sizes = keyed.groupBy("_lang").agg(F.count("*").alias("_docs"))
    words = keyed.select("_lang", F.explode(F.array_distinct(words_of(ascii_lower(F.col("_text")), ALNUM_WORD))).alias("w"))
    counted = words.filter(F.col("w").rlike(r"^\p{L}{3,12}$")).groupBy("_lang", "w").agg(F.count("*").alias("n")).filter(F.col("n") >= COMMON_LEAST)
    common = counted.join(broadcast_if_small(staged(sizes, "secrets-languages"), 64), "_lang").filter(F.col("n") >= COMMON_SHARE * F.col("_docs"))
    return staged(common.select("w").distinct(), "secrets-dictionary")


def coverage(values: DataFrame, words: DataFrame) -> DataFrame:
    """value, covered: for distinct values the letters that words of the dictionary cover, the longest word at the leftmost place first.

    A value's letter runs are cut into parts of 3 to 12 letters, at most ten a
    letter, and joined with the dictionary; what is grouped is one value's parts.
    """
    at = F.explode(F.sequence(F.lit(1), F.length("value") - 2)).alias("at")
    heads = values.filter(F.length("value") >= 3).select("value", F.lower("value").alias("_lower"), at)
    heads = heads.select("value", "at", F.regexp_extract(F.expr("substring(_lower, at, 12)"), r"^\p{L}{3,12}", 0).alias("_head")).filter("_head != ''")
    parts = heads.select("value", "at", "_head", F.explode(F.sequence(F.lit(3), F.length("_head"))).alias("n")).select(
        "value", "at", "n", F.expr("substring(_head, 1, n)").alias("w")
    )
    met = parts.join(broadcast_if_small(words, 64), "w").groupBy("value").agg(F.sort_array(F.collect_list(F.struct("at", (-F.col("n")).alias("m")))).alias("_found"))
    start = F.struct(F.lit(1).alias("to"), F.lit(0).alias("n"))

    def add(state: Column, x: Column) -> Column:
        free = x["at"] >= state["to"]
        return F.struct(F.when(free, x["at"] - x["m"]).otherwise(state["to"]).alias("to"), F.when(free, state["n"] - x["m"]).otherwise(state["n"]).alias("n"))

    return met.select("value", F.aggregate("_found", start, add, lambda state: state["n"]).alias("covered"))


def features(found: DataFrame, words: DataFrame) -> DataFrame:
    """The forest's input columns for rows with `before` and `value`, which are written first."""
    found = staged(found, "secrets-candidates")
    covered = staged(coverage(found.select("value").distinct(), words), "secrets-coverage")
    fits = covered.agg(F.coalesce(F.sum(F.length("value") + 32), F.lit(0)).alias("b")).collect()[0]["b"] <= BROADCAST_BYTES
    rows = found.join(F.broadcast(covered) if fits else covered, "value", "left").select(*found.columns, "covered")
    value, before = F.col("value"), F.lower("before")
    n = F.length("value").cast("double")

    def count(pattern: str) -> Column:
        return F.regexp_count(value, F.lit(pattern)).cast("double")

    def flag(condition: Column) -> Column:
        return condition.cast("double")

    changes = r"(?<=[0-9])(?=[A-Za-z])|(?<=[A-Za-z])(?=[0-9])|(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[a-z])"
    assigned, quoted = r"[=:][\s\"']*$", r"[\"']$"
    columns = {
        "length": F.log2(n),
        "digits": count("[0-9]") / n,
        "uppers": count("[A-Z]") / n,
        "hex_only": flag(value.rlike("^[0-9a-fA-F-]+$")),
        "digits_only": flag(value.rlike("^[0-9.+-]+$")),
        "prefixed": flag(value.rlike(f"^({_PREFIX})")),
        "distinct": F.size(F.array_distinct(F.split(value, ""))) / n,
        "changes": count(changes) / n,
        "consonants": count("[b-df-hj-np-tv-xzB-DF-HJ-NP-TV-XZ]{4}") / n,
        "vowels": count("[aeiouAEIOU]") / n,
        "dictionary": F.coalesce("covered", F.lit(0)) / n,
        "separators": count("[/_-]") / n,
        "dots": count("[.]") / n,
        "extension": flag(value.rlike(r"\.[a-z]{2,5}$")),
        "repeats": count(r"(.)\1\1") / n,
        "key_word": flag(before.rlike(rf"({_KEY_WORD})")),
        "digest_word": flag(before.rlike(rf"(^|[^a-z0-9])({_DIGEST_WORD})[^a-z0-9]*$")),
        "assigned": flag(before.rlike(assigned)),
        "quoted": flag(before.rlike(quoted)),
    }
    return rows.withColumns(columns).drop("covered")


def _pick(options: str, at: Column) -> Column:
    listed = options.split()
    return F.element_at(F.array(*[F.lit(x) for x in listed]), F.pmod(at, F.lit(len(listed))).cast("int") + 1)


def labelled_findings(sample: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """before, value, label: keys of known formats and look-alikes, with words and contexts of the sampled documents."""
    base = (
        sample.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("i"), words_of(ascii_lower(F.col(text_col)), ALNUM_WORD).alias("w"))
        .filter(F.size("w") > 0)
    )

    def numbers(n: int) -> Column:
        return F.sequence(F.lit(0), F.lit(n))

    # made as arrays, so that the many findings below stay small expressions
    base = base.select(
        "i",
        F.transform(numbers(7), lambda k: F.element_at("w", F.pmod(F.xxhash64("i", F.concat(F.lit("word"), k)), F.size("w")).cast("int") + 1)).alias("words"),
        F.transform(numbers(16), lambda k: F.sha1(F.concat("i", F.lit("/"), k).cast("binary"))).alias("hexes"),
        F.transform(
            numbers(24), lambda k: F.regexp_replace(F.base64(F.unhex(F.sha2(F.concat("i", F.lit("/"), k).cast("binary"), 512))), "[+/=\n\r]", "")
        ).alias("mixes"),
    )

    def word(k: int) -> Column:
        return F.get("words", F.lit(k))

    def hexed(k: int) -> Column:
        return F.get("hexes", F.lit(k))

    def mixed(k: int) -> Column:
        """Letters of both cases and digits."""
        return F.get("mixes", F.lit(k))

    key, digest = _pick(KEY_WORDS, F.xxhash64("i", F.lit("key"))), _pick(DIGEST_WORDS, F.xxhash64("i", F.lit("digest")))
    assign = _pick('=" : =', F.xxhash64("i", F.lit("sign")))
    spaced = F.when(assign == '="', F.lit(' = "')).otherwise(F.concat(F.lit(" "), assign, F.lit(" ")))
    named, plain, checked = F.concat(key, spaced), F.concat(word(0), F.lit(" ")), F.concat(digest, F.lit(" "))
    joined_name, long_name = F.concat(F.upper(key), F.lit("=")), F.concat(F.upper(word(5)), F.lit("_PRODUCTION_"), F.upper(key), spaced)
    some_name = F.concat(word(6), F.lit("="))
    few = F.pmod(F.xxhash64("i", F.lit("few")), F.lit(LEAST - LEAST_NAMED)).cast("int") + LEAST_NAMED
    signs = F.translate(F.substring(mixed(15), 1, 22), "aeinrst", "@!$#%^*")
    letters = F.translate(F.substring(mixed(24), 1, 20), "0123456789", "qWxZkVjYbR")
    number = F.conv(F.substring(hexed(9), 1, 14), 16, 10)
    size = F.pmod(F.xxhash64("i", F.lit("size")), F.lit(24)).cast("int") + LEAST
    uuid = F.concat_ws("-", *[F.substring(hexed(8), at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    joined = F.concat_ws("_", word(1), word(2), word(3), word(4))
    kinds = [
        (named, hexed(1), 1),
        (named, F.substring(hexed(2), 1, 32), 1),
        (named, F.substring(mixed(3), F.lit(1), size), 1),
        (named, F.concat(F.substring(mixed(4), 1, 40), F.lit("==")), 1),
        (named, F.substring(mixed(13), 1, LEAST + 4), 1),
        (plain, F.concat(F.lit("AKIA"), F.upper(F.substring(mixed(5), 1, 16))), 1),
        (plain, F.concat(F.lit("ghp_"), F.substring(mixed(6), 1, 36)), 1),
        (plain, F.concat(F.lit("sk_live_"), F.substring(mixed(7), 1, 24)), 1),
        (joined_name, hexed(16), 1),
        (joined_name, F.concat(F.lit("sk_live_"), F.substring(mixed(17), 1, 24)), 1),
        (F.concat(key, F.lit("=")), F.concat(F.lit("ghp_"), F.substring(mixed(18), 1, 36)), 1),
        (some_name, F.concat(F.lit("ghp_"), F.substring(mixed(19), 1, 36)), 1),
        (long_name, F.substring(mixed(20), F.lit(1), size), 1),
        (named, F.substring(mixed(14), F.lit(1), few), 1),
        (named, F.concat(word(7), F.substring(mixed(21), 1, 5)), 1),
        (named, signs, 1),
        (joined_name, F.substring(signs, F.lit(1), few), 1),
        (joined_name, letters, 1),
        (plain, F.concat(F.lit("xoxb-"), F.substring(letters, 1, 10), F.lit("-"), F.substring(letters, 4, 12)), 1),
        (F.concat(key, F.lit(" is ")), F.concat(F.substring(mixed(22), 1, 4), F.lit("4&"), F.substring(mixed(22), 5, 5)), 1),
        (F.lit(""), F.concat(F.lit("-----BEGIN PRIVATE KEY-----\n"), mixed(23), F.lit("\n-----END PRIVATE KEY-----")), 1),
        (checked, hexed(10), 0),
        (checked, F.sha2(F.concat("i", F.lit("/11")).cast("binary"), 256), 0),
        (F.concat(digest, F.lit(": ")), uuid, 0),
        (plain, uuid, 0),
        (plain, F.rpad(number, 16, "7"), 0),
        (checked, F.rpad(number, 18, "3"), 0),
        (named, F.concat(F.repeat(F.substring(hexed(12), 1, 1), 16), F.lit("0")), 0),
        (named, F.concat(F.lit("your_"), key, F.lit("_goes_here_1")), 0),
        (named, F.concat(joined, F.lit("_2")), 0),
        (plain, F.concat(joined, F.lit("_v1")), 0),
        (named, F.concat(word(1), word(2)), 0),
        (joined_name, F.concat(word(3), F.lit("-"), word(4)), 0),
        (named, F.concat(F.lit("${"), F.upper(key), F.lit("}")), 0),
        (some_name, F.rpad(number, 16, "7"), 0),
        (some_name, uuid, 0),
        (plain, F.concat(F.lit("/"), word(1), F.lit("/"), word(2), F.lit("/"), word(3), F.lit("2024.html")), 0),
        (plain, F.concat(F.lit("www."), word(1), word(2), F.lit(".com/"), word(3), F.lit("1")), 0),
        (plain, F.concat(F.lit("2024-05-17T10.22.31."), F.substring(number, 1, 6)), 0),
        (plain, F.concat(word(1), word(2), word(3), word(4), F.lit("1")), 0),
    ]
    rows = F.explode(F.array(*[F.struct(b.alias("before"), v.alias("value"), F.lit(y).alias("label")) for b, v, y in kinds])).alias("x")
    return base.select(rows).select("x.*").filter((F.length("value") >= LEAST) | (_assigned_to_key_word() & (F.length("value") >= LEAST_NAMED)))


def train(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    labelled: DataFrame | None = None,
    n_docs: int = 1_000,
    max_train_chars: int = 100_000,
    n_trees: int = 15,
    depth: int = 6,
) -> tuple[RandomForestClassificationModel | None, DataFrame]:
    """The forest and the dictionary its features use; None if there is nothing to learn from."""
    short = docs.select(id_col, text_col).filter(F.length(text_col).between(1, max_train_chars))
    n, steps = short.count(), 1 << 30
    sample = short if n <= n_docs else short.filter(F.pmod(F.xxhash64(id_col), F.lit(steps)) < steps * n_docs // n)
    sample = staged(sample, "secrets-sample")
    words = dictionary(docs, text_col)
    findings = labelled if labelled is not None else labelled_findings(sample, id_col, text_col)
    prepared = staged(features(findings, words).select(*FEATURES, F.col("label").cast("double").alias("label")), "secrets-labelled")
    if prepared.select("label").distinct().count() < 2:
        return None, words
    forest = RandomForestClassifier(
        featuresCol="_features", labelCol="label", numTrees=n_trees, maxDepth=depth, seed=11
    )
    return forest.fit(VectorAssembler(inputCols=FEATURES, outputCol="_features").transform(prepared)), words


def forest_score(model: RandomForestClassificationModel) -> Column:
    """The share of trees that vote for a secret, over the feature columns.

    Trees are three arrays in heap order (feature, threshold and, for leaves, the
    vote), so that the expression stays small and rows are scored without the
    model object: a row takes one comparison per level and tree. A leaf above the
    last level goes on to the left as itself.
    """
    lines = [line.strip() for line in model.toDebugString.splitlines()]
    starts = [i for i, line in enumerate(lines) if line.startswith("Tree ")]
    levels = max((tree.depth for tree in model.trees), default=0)
    size = 1 << (levels + 1)
    feature, threshold, vote = ([0] * (size * len(starts)) for _ in range(3))

    def fill(i: int, root: int, node: int) -> int:
        """Puts the node that line i describes into its place; returns the line after it."""
        if lines[i].startswith("Predict: "):
            while node < size:
                feature[root + node], threshold[root + node], vote[root + node] = 0, "Infinity", int(float(lines[i].removeprefix("Predict: ")))
                node *= 2
            return i + 1
        number, bound = re.fullmatch(r"If \(feature (\d+) <= (\S+)\)", lines[i]).groups()
        feature[root + node], threshold[root + node] = int(number), repr(float(bound))
        after = fill(i + 1, root, 2 * node)
        return fill(after + 1, root, 2 * node + 1)  # behind its Else

    for t, i in enumerate(starts):
        fill(i + 1, t * size, 1)

    def listed(values: list, kind: str) -> Column:
        return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")

    features_of, bounds, votes, row = listed(feature, "int"), listed(threshold, "double"), listed(vote, "int"), F.array(*FEATURES)

    def step(root: Column, node: Column) -> Column:
        right = F.get(row, F.get(features_of, root + node)) > F.get(bounds, root + node)
        return node * 2 + F.when(right, 1).otherwise(0)

    def voted(t: Column) -> Column:
        leaf = F.aggregate(F.sequence(F.lit(1), F.lit(levels)) if levels else F.array().cast("array<int>"), F.lit(1), lambda node, _: step(t * size, node))
        return F.get(votes, t * size + leaf)

    trees = F.sequence(F.lit(0), F.lit(len(starts) - 1))
    return F.aggregate(trees, F.lit(0), lambda total, t: total + voted(t)) / F.lit(float(len(starts)))


def scan(
    docs: DataFrame, model: RandomForestClassificationModel | None, words: DataFrame, keep: list[str], text_col: str = "text"
) -> DataFrame:
    """`keep` columns, place, before, value, score and is_secret of every candidate."""
    rows = candidates(docs, keep, text_col)
    if model is None:
        return rows.withColumn("score", F.lit(0.0)).withColumn("is_secret", F.lit(False))
    scored = features(rows, words).withColumn("score", forest_score(model))
    return scored.select(*keep, "place", "before", "value", "score", (F.col("score") >= 0.5).alias("is_secret"))


@query("op6_secret_scan")
def secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model, words = train(docs)
    found = scan(docs, model, words, ["doc_id"])
    return found.select(
        "doc_id",
        "place",
        F.sha2(F.col("value").cast("binary"), 256).alias("value_sha256"),
        F.length("value").alias("length"),
        F.regexp_extract("before", r"[^\s\"'=:]+", 0).alias("word_before"),
        "score",
        "is_secret",
    )


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: every found secret is masked in its text, and n_chars, where there is one, follows; all documents stay."""
    model, words = train(docs)
    text = F.col("text").cast("string")
    here = F.xxhash64(F.coalesce(text, F.lit("")))
    found = scan(docs.select("doc_id", here.alias("text_hash"), text.alias("text")), model, words, ["doc_id", "text_hash"]).filter("is_secret")
    by_doc = found.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct(F.length("value").alias("n"), "value")).alias("found"))
    by_doc = staged(by_doc.withColumn("found", F.sort_array("found", asc=False)), "secrets-found")
    measured = by_doc.agg(F.sum(F.length(F.to_json("found")) + 64)).collect()[0][0] or 0
    by_doc = F.broadcast(by_doc) if measured <= BROADCAST_BYTES else by_doc
    rows = docs.select(whole_row(docs).alias("row"), F.col("doc_id").alias("id"), here.alias("h"))
    met = rows.join(by_doc, rows["id"].eqNullSafe(by_doc["doc_id"]) & (rows["h"] == by_doc["text_hash"]), "left")
    masked = F.aggregate("found", F.col("row.text"), lambda text, x: F.replace(text, x["value"], F.lit(MASK)))
    changed = met.select("row", F.when(F.col("found").isNotNull(), masked).alias("masked"))
    new = F.col("row").withField("text", F.coalesce("masked", "row.text"))
    if "n_chars" in docs.columns:
        counted = F.length("masked").cast(docs.schema["n_chars"].dataType)
        new = new.withField("n_chars", F.coalesce(counted, "row.n_chars"))
    return changed.select(new.alias("row")).select("row.*")
