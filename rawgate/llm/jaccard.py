"""N-gram Jaccard join with a token-group matrix.

Documents are sets of hashed word shingles. Two link when their Jaccard
similarity is at least `percent` / 100. The result is exact: candidates are
bounded, never capped, and every candidate is verified on whole sets.

1. Sets. One pass computes each document's set, a 128-bit digest of it and its
   lowest tokens in hash order. Documents with equal sets are one class.
2. Groups. Classes with the same smallest token and nearly the same size stand
   together (near copies nearly always do); they are cut into groups of bounded
   size. A smallest token that very many classes have is salted.
3. Token-group matrix. A row (token, group) says that the token is in the union
   of the group's tokens. Only tokens that can decide are stored, see below.
4. Bound. Two groups that share fewer than SHARED matrix tokens cannot hold a
   linked pair. Pairs of groups that share more are candidates.
5. Open. The members of the smaller group are queries of the larger one. A
   query whose whole set overlaps the group's token union in fewer than
   percent * |query| tokens skips it; for the others the group is opened and all
   its members are compared at once, as a product of incidence matrices.

Which tokens decide: with d(n) = n - ceil(t n), a linked pair of sets shares at
least l tokens among the lowest d(n) + l of each (l = l(n) below). Among these
it must therefore share SHARED tokens within the first |lowest| - l' + SHARED in
any other common order, where l' is the smallest l of any set that can link.
That order puts tokens of very many groups (counted over all data) last, so that
common passages cost nothing unless a document consists of little else. Such
documents are grouped anew, by the smallest of their common tokens: an edit
seldom changes it, so the near copies of a very frequent text, whose edits give
them many different smallest tokens, come together in a few groups.

Sizes: per class some 15 % of its tokens are moved, plus whole sets of the groups
that are opened. Groups are bounded, queries are streamed, hot targets are
salted, and edges sent to the components are at most one per query and local
component. Numbers of links come from the verified comparisons.

Defined cases: null or empty text has an empty set and is linked with nothing,
its component is its own id; rows with null id take part, but a null is no
component id if there is another; rows that are repeated are documents that
link; other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rawgate.llm.common import IS_SPACED, arrow_map, broadcast_if_small, bytes_of, find_words, mix64, slices, staged, table, whole_row, word_hashes
from rawgate.llm.components import connected_components
from rawgate.llm.registry import query

SHINGLE = 3
PERCENT = 90
#: the pipeline's stage links texts from fewer common word runs: five words, 0.8 or more
STAGE_SHINGLE, STAGE_PERCENT = 5, 80
SHARED = 4
#: a group has at most so many members and tokens
GROUP_MEMBERS, GROUP_TOKENS = 1024, 1 << 20
#: classes per smallest token before it is salted
SALT_ABOVE = 1_024
#: tokens in more groups than this come last; raised until at most HEAVY_TOKENS are such
HEAVY_ABOVE, HEAVY_TOKENS = 64, 1 << 20
#: queries that one task streams through a group
QUERIES_PER_PART = 8_192

MULTIPLIERS = mix64(np.arange(1001, 1001 + 64, dtype=np.uint64)) | np.uint64(1)


def least_overlap(n, percent: int):
    """ceil(t n): a linked partner shares at least so many of n tokens."""
    return (percent * n + 99) // 100


def slack(n, percent: int):
    """l(n): tokens shared among the lowest; grows with n."""
    whole = least_overlap(n, percent)
    return np.minimum(whole, (n - whole) // 2 + SHARED + 4)


def n_lowest(n, percent: int):
    return n - least_overlap(n, percent) + slack(n, percent)


def n_probes(n, percent: int):
    """Matrix tokens of a set of n: |lowest| - l' + the number that two groups must share."""
    return n_lowest(n, percent) - slack(least_overlap(n, percent), percent) + n_shared(percent)


def can_link_unequal(n: int, percent: int) -> bool:
    """Whether a set of n tokens can link with a different one: at best with one token more, or one less."""
    return 100 * n >= percent * (n + 1) or 100 * (n - 1) >= percent * n


def n_shared(percent: int) -> int:
    """SHARED, or less where the threshold is so low that very small sets can link."""
    least = next(n for n in range(1, 200) if can_link_unequal(n, percent) or n == 199)
    return int(min(SHARED, slack(least_overlap(least, percent), percent)))


def shingle_sets(buf: np.ndarray, offsets: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """Per row the sorted distinct hashes of its word n-grams; with fewer words, of all of them as one."""
    starts, ends, pointer = find_words(buf, offsets, IS_SPACED)
    words = word_hashes(buf, starts, ends)
    n = max(0, len(words) - size + 1)
    grams = np.zeros(n, np.uint64)
    for k in range(size):
        grams += words[k : k + n] * MULTIPLIERS[k]
    grams = mix64(grams)
    for first, stop in zip(pointer[:-1].tolist(), pointer[1:].tolist(), strict=True):
        if stop - first >= size:
            yield np.unique(grams[first : stop - size + 1])
        elif stop > first:
            few = words[first:stop]
            yield mix64((few * MULTIPLIERS[: len(few)]).sum(dtype=np.uint64, keepdims=True) + np.full(1, len(few), np.uint64))
        else:
            yield np.zeros(0, np.uint64)


def digest(tokens: np.ndarray) -> bytes:
    """128 bits that tell sets apart."""
    sums = np.array([mix64(tokens ^ MULTIPLIERS[40 + k]).sum(dtype=np.uint64) for k in range(2)], dtype=np.uint64)
    return (sums + np.full(2, len(tokens), np.uint64) * MULTIPLIERS[50:52]).tobytes()


def _binary(rows: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([r.nbytes for r in rows]))).astype(np.int32)
    data = np.concatenate(rows) if rows else np.zeros(0, np.uint64)
    return pa.BinaryArray.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def _tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All tokens of a binary column, and where each row's begin."""
    buf, offsets = bytes_of(column)
    return np.frombuffer(buf.tobytes(), dtype=np.uint64), offsets // 8


def document_sets(docs: DataFrame, id_col: str, text_col: str, size: int, percent: int) -> DataFrame:
    """doc_id, n, digest, least (smallest token), low (lowest tokens, as bytes; empty if only equal sets can link)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, stop, buf, offsets in slices(batch.column(1)):
                n, digests, least, low = [], [], [], []
                for tokens in shingle_sets(buf, offsets, size):
                    n.append(len(tokens))
                    digests.append(digest(tokens))
                    wanted = n_lowest(len(tokens), percent) if can_link_unequal(len(tokens), percent) else 0
                    low.append(tokens[:wanted])
                    least.append(tokens[0] if len(tokens) else 0)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, stop - first),
                        pa.array(n, pa.int32()),
                        pa.array(digests, pa.binary()),
                        pa.array(np.array(least, dtype=np.uint64).view(np.int64)),
                        _binary(low),
                    ],
                    names=["doc_id", "n", "digest", "least", "low"],
                )

    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema[id_col].dataType),
            T.StructField("n", T.IntegerType()),
            T.StructField("digest", T.BinaryType()),
            T.StructField("least", T.LongType()),
            T.StructField("low", T.BinaryType()),
        ]
    )
    return docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text")).transform(arrow_map, run, schema)


def band(n: np.ndarray, percent: int) -> np.ndarray:
    """Size band: sets that link lie in the same or neighbouring bands."""
    return np.floor(np.log(np.maximum(n, 1)) / -np.log(percent / 100 if percent < 100 else 0.99)).astype(np.int64)


#: group numbers carry the band of their smallest member in their lowest bits
BAND_BITS = 12


def able_classes(sets: DataFrame, classes: DataFrame) -> DataFrame:
    """key (smallest token), n, digest, rep, copies, low: a row per class that can link with another."""
    several = classes.filter(F.col("copies") > 1).select(F.col("digest").alias("_digest"), "rep", F.col("copies").alias("_copies"))
    able = sets.filter(F.octet_length("low") > 0)
    one = able.join(broadcast_if_small(staged(several, "jaccard-copies"), 64), F.col("digest") == F.col("_digest"), "left").filter(
        F.col("_copies").isNull() | F.col("doc_id").eqNullSafe(F.col("rep"))
    )
    copies = F.coalesce("_copies", F.lit(1).cast("long")).alias("copies")
    return one.select(F.col("least").alias("key"), "n", "digest", F.col("doc_id").alias("rep"), copies, "low")


def group_schema(id_type: T.DataType) -> T.StructType:
    members = (("digest", T.BinaryType()), ("n", T.IntegerType()), ("rep", id_type), ("copies", T.LongType()), ("low", T.BinaryType()))
    return T.StructType(
        [
            T.StructField("grp", T.LongType()),
            T.StructField("n_members", T.IntegerType()),
            *[T.StructField(name, T.ArrayType(kind)) for name, kind in members],
        ]
    )


def groups_to_arrow(groups: list[tuple[int, list[tuple]]], id_kind: pa.DataType) -> pa.RecordBatch:
    """Rows of `group_schema`; a group is its number and its members (digest, n, rep, copies, low)."""
    columns = [pa.array([g for g, _ in groups], pa.int64()), pa.array([len(m) for _, m in groups], pa.int32())]
    for i, kind in enumerate((pa.binary(), pa.int32(), id_kind, pa.int64(), pa.binary())):
        columns.append(pa.array([[x[i] for x in m] for _, m in groups], pa.list_(kind)))
    return pa.RecordBatch.from_arrays(columns, names=["grp", "n_members", "digest", "n", "rep", "copies", "low"])


def build_groups(members: DataFrame, percent: int, hot_label: str) -> DataFrame:
    """Groups of bounded size of the classes with the same key and nearly the same size; keys of very many classes are salted."""
    hot = members.groupBy("key").agg(F.count("*").alias("k")).filter(F.col("k") > SALT_ABOVE)
    hot = staged(hot.select(F.col("key").alias("_key"), F.ceil(F.col("k") / SALT_ABOVE).cast("int").alias("salts")), hot_label)
    salted = members.join(broadcast_if_small(hot, 16), F.col("key") == F.col("_key"), "left").withColumn(
        "salt", F.pmod(F.xxhash64("digest"), F.coalesce("salts", F.lit(1)))
    )
    ordered = salted.select("key", "salt", "digest", "n", "rep", "copies", "low").repartition("key", "salt")
    ordered = ordered.sortWithinPartitions("key", "salt", "n", "digest")
    seed = np.frombuffer(hot_label.encode().ljust(8, b"-")[-8:], np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        members: list[tuple] = []
        key, tokens, last, id_kind = None, 0, None, pa.int64()

        def closed() -> list:
            if not members:
                return []
            number = int(mix64(np.frombuffer(members[0][0][:8], np.uint64) ^ seed)[0]) >> (BAND_BITS + 1)
            return [(number << BAND_BITS | int(band(np.array(members[0][1]), percent)), list(members))]

        for batch in batches:
            id_kind, groups = batch.column(4).type, []
            for token, salt, dig, n, rep, copies, low in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if dig == last:
                    continue  # a repeated row of the class's document
                full = len(members) >= GROUP_MEMBERS or tokens + n > GROUP_TOKENS
                if (token, salt) != key or full or percent * n > 100 * members[0][1]:
                    groups += closed()
                    members.clear()
                    key, tokens = (token, salt), 0
                members.append((dig, n, rep, copies, low))
                tokens, last = tokens + n, dig
            if groups:
                yield groups_to_arrow(groups, id_kind)
        if members:
            yield groups_to_arrow(closed(), id_kind)

    return ordered.transform(arrow_map, run, group_schema(members.schema["rep"].dataType))


def listed(tokens: np.ndarray, heavy: np.ndarray) -> np.ndarray:
    """Which tokens are in the sorted list."""
    if not len(heavy):
        return np.zeros(len(tokens), bool)
    return heavy[np.minimum(np.searchsorted(heavy, tokens), len(heavy) - 1)] == tokens


def hard_members(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, late: np.ndarray, percent: int) -> np.ndarray:
    """Which members have too few lowest tokens that are not heavy."""
    before = np.concatenate(([0], np.cumsum(~late)))
    return before[starts[1:]] - before[starts[:-1]] < n_probes(sizes, percent)


def split_members(groups: DataFrame, heavy: np.ndarray, percent: int, hard: bool) -> DataFrame:
    """The hard members of all groups, to be grouped by their smallest heavy token; or what is left of the groups, a row per member."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                flat, starts, group = _group_tokens(batch.column(6))
                sizes = np.array(batch.column(3).flatten(), dtype=np.int64)
                late = listed(flat, heavy)
                chosen = np.flatnonzero(hard_members(flat, starts, sizes, late, percent) == hard)
                member = [batch.column(i).flatten().take(pa.array(chosen)) for i in ((3, 2, 4, 5, 6) if hard else (2, 4, 5))]
                if hard:
                    late_at = np.flatnonzero(late)
                    first = flat[late_at[np.searchsorted(late_at, starts[chosen])]] if len(chosen) else np.zeros(0, np.uint64)
                    yield pa.RecordBatch.from_arrays([pa.array(first.view(np.int64)), *member], names=["key", "n", "digest", "rep", "copies", "low"])
                else:
                    numbers = np.array(batch.column(0), dtype=np.int64)[group[chosen]]
                    yield pa.RecordBatch.from_arrays([pa.array(numbers), *member], names=["grp", "digest", "rep", "copies"])

    rep = T.StructField("rep", groups.schema["rep"].dataType.elementType)
    digest, copies = T.StructField("digest", T.BinaryType()), T.StructField("copies", T.LongType())
    if hard:
        fields = [T.StructField("key", T.LongType()), T.StructField("n", T.IntegerType()), digest, rep, copies, T.StructField("low", T.BinaryType())]
    else:
        fields = [T.StructField("grp", T.LongType()), digest, rep, copies]
    return groups.transform(arrow_map, run, T.StructType(fields))


#: groups of which tokens are handled at once
ROWS = 500


def _group_tokens(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of all members, where members begin, and in which of the batch's groups each member is."""
    flat, starts = _tokens(column.flatten())
    sizes = np.diff(column.offsets.to_numpy())
    return flat, starts, np.repeat(np.arange(len(column)), sizes)


def _distinct(groups: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((tokens, groups))
    groups, tokens = groups[order], tokens[order]
    keep = np.concatenate(([True], (groups[1:] != groups[:-1]) | (tokens[1:] != tokens[:-1]))) if len(order) else np.zeros(0, bool)
    return groups[keep], tokens[keep]


def heavy_tokens(groups: DataFrame) -> np.ndarray:
    """Tokens that stand in very many groups, counted over all groups; at most HEAVY_TOKENS (8 MiB), else the limit goes up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                flat, starts, group = _group_tokens(batch.column(0).slice(at, ROWS))
                _, tokens = _distinct(np.repeat(group, np.diff(starts)), flat)
                yield pa.RecordBatch.from_arrays([pa.array(tokens.view(np.int64))], names=["token"])

    counts = groups.select("low").transform(arrow_map, run, "token long").groupBy("token").agg(F.count("*").alias("k")).filter(F.col("k") > HEAVY_ABOVE)
    counts = staged(counts, "jaccard-heavy", "none")
    by_size = {r["p"]: r["n"] for r in counts.groupBy(F.floor(F.log2("k")).cast("int").alias("p")).agg(F.count("*").alias("n")).collect()}
    above, limit = 0, HEAVY_ABOVE
    for power in sorted(by_size, reverse=True):
        above += by_size[power]
        if above > HEAVY_TOKENS:
            limit = 2 ** (power + 1) - 1
            break
    rows = counts.filter(F.col("k") > limit).select("token").toArrow()  # at most HEAVY_TOKENS numbers
    return np.sort(rows.column(0).to_numpy().view(np.uint64))


def matrix_rows(groups: DataFrame, heavy: np.ndarray, percent: int, with_hard: bool) -> DataFrame:
    """token, grp, heavy: the deciding tokens in each group's union, with or without its hard members."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                flat, starts, group = _group_tokens(batch.column(2))
                sizes = np.array(batch.column(1).flatten(), dtype=np.int64)
                late = listed(flat, heavy)
                member = np.repeat(np.arange(len(sizes)), np.diff(starts))
                # rank of each token in its member's own order: heavy ones last, else by hash (as they are stored)
                light_before = np.concatenate(([0], np.cumsum(~late)))
                n_light = light_before[starts[1:]] - light_before[starts[:-1]]
                light_rank = light_before[:-1] - light_before[starts[member]]
                heavy_rank = np.arange(len(flat)) - starts[member] - light_rank
                rank = np.where(late, n_light[member] + heavy_rank, light_rank)
                chosen = rank < n_probes(sizes, percent)[member]
                if not with_hard:
                    chosen &= ~hard_members(flat, starts, sizes, late, percent)[member]
                in_group, tokens = _distinct(group[member[chosen]], flat[chosen])
                numbers = np.array(batch.column(0), dtype=np.int64)
                columns = [pa.array(tokens.view(np.int64)), pa.array(numbers[in_group]), pa.array(listed(tokens, heavy))]
                yield pa.RecordBatch.from_arrays(columns, names=["token", "grp", "heavy"])

    return groups.select("grp", "n", "low").transform(arrow_map, run, "token long, grp long, heavy boolean")


def candidate_pairs(matrix: DataFrame, percent: int) -> DataFrame:
    """a, b: pairs of groups (a < b) of fitting sizes that share at least SHARED matrix tokens."""
    mask = (1 << BAND_BITS) - 1

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept_tokens, kept_groups = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def emit(tokens: np.ndarray, groups: np.ndarray) -> Iterator[pa.RecordBatch]:
            for gap in range(1, len(tokens)):
                same = tokens[gap:] == tokens[:-gap]
                if not same.any():
                    return
                a, b = groups[:-gap][same], groups[gap:][same]
                fits = (np.abs((a & mask) - (b & mask)) <= 3) & (a != b)
                a, b = a[fits], b[fits]
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

        for batch in batches:
            tokens = np.concatenate((kept_tokens, np.array(batch.column(0), dtype=np.int64)))
            groups = np.concatenate((kept_groups, np.array(batch.column(1), dtype=np.int64)))
            cut = int(np.searchsorted(tokens, tokens[-1])) if len(tokens) else 0
            yield from emit(tokens[:cut], groups[:cut])
            kept_tokens, kept_groups = tokens[cut:], groups[cut:]
        yield from emit(kept_tokens, kept_groups)

    light = matrix.filter(~F.col("heavy")).select("token", "grp").repartition("token").sortWithinPartitions("token")
    found = light.transform(arrow_map, pairs, "a long, b long")
    heavy = staged(matrix.filter("heavy").select("token", "grp"), "jaccard-heavy-rows")
    x, y = heavy.select("token", F.col("grp").alias("a")), heavy.select("token", F.col("grp").alias("b"))
    fits = F.abs(F.col("a").bitwiseAND(F.lit(mask)) - F.col("b").bitwiseAND(F.lit(mask))) <= 3
    late = x.join(y, "token").filter((F.col("a") < F.col("b")) & fits).select("a", "b")
    return found.unionByName(late).groupBy("a", "b").agg(F.count("*").alias("shared")).filter(F.col("shared") >= n_shared(percent)).select("a", "b")


def whole_sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """grp, digest, n, copies, tokens: whole sets of the wanted classes, from the text of their documents."""
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("_text"))
    wanted = staged(wanted.select("grp", F.col("digest").alias("want"), F.col("rep").alias("_rep"), "copies"), "jaccard-wanted")
    met = texts.join(broadcast_if_small(wanted, 64), F.col("doc_id").eqNullSafe(F.col("_rep"))).select("grp", "want", "copies", "_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, _, buf, offsets in slices(batch.column(3)):
                keep, sets = [], []
                for i, tokens in enumerate(shingle_sets(buf, offsets, size), first):
                    if digest(tokens) == batch.column(1)[i].as_py():
                        keep.append(i)
                        sets.append(tokens)
                if keep:
                    rows = batch.take(pa.array(keep))
                    yield pa.RecordBatch.from_arrays(
                        [rows.column(0), rows.column(1), pa.array([len(s) for s in sets], pa.int32()), rows.column(2), _binary(sets)],
                        names=["grp", "digest", "n", "copies", "tokens"],
                    )

    return met.transform(arrow_map, run, "grp long, digest binary, n int, copies long, tokens binary")


class OpenGroup:
    """The members of one group as a sparse incidence matrix over the group's token union."""

    #: columns that are made dense at once
    WIDTH = 4096

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets], dtype=np.int64)
        self.union, self.column = np.unique(np.concatenate(sets), return_inverse=True)
        self.member = np.repeat(np.arange(len(sets)), self.sizes)

    def overlaps(self, sets: list[np.ndarray], percent: int) -> np.ndarray:
        """Intersection sizes, query x member; rows of queries that the bound rules out are 0."""
        sizes = np.array([len(s) for s in sets], dtype=np.int64)
        out = np.zeros((len(sets), len(self.sizes)), dtype=np.float32)
        flat = np.concatenate(sets)
        query = np.repeat(np.arange(len(sets)), sizes)
        at = np.minimum(np.searchsorted(self.union, flat), len(self.union) - 1)
        inside = self.union[at] == flat
        bound = np.bincount(query[inside], minlength=len(sets))
        use = inside & (bound >= least_overlap(sizes, percent))[query]
        query, at = query[use], at[use]
        if not len(query):
            return out.astype(np.int64)
        used = np.zeros(len(self.union), dtype=bool)
        used[at] = True
        place = np.cumsum(used) - 1
        here = used[self.column]
        member, column = self.member[here], place[self.column[here]]
        asked = place[at]
        by_member, by_query = np.argsort(column, kind="stable"), np.argsort(asked, kind="stable")
        member, column, query, asked = member[by_member], column[by_member], query[by_query], asked[by_query]
        for first in range(0, int(used.sum()), self.WIDTH):
            blocks = []
            for rows, columns, height in ((query, asked, len(sets)), (member, column, len(self.sizes))):
                lo, hi = np.searchsorted(columns, [first, first + self.WIDTH])
                dense = np.zeros((height, self.WIDTH), dtype=np.float32)
                dense[rows[lo:hi], columns[lo:hi] - first] = 1
                blocks.append(dense)
            out += blocks[0] @ blocks[1].T
        return out.astype(np.int64)


def linked(overlap: np.ndarray, sizes: np.ndarray, others: np.ndarray, percent: int) -> np.ndarray:
    union = sizes[:, None] + others[None, :] - overlap
    return (100 * overlap >= percent * union) & (overlap > 0)


def open_groups(rows: DataFrame, percent: int) -> DataFrame:
    """kind ('edge' or 'links'), a, b, n: a spanning set of links, and numbers of linked documents per class.

    `rows`: target, part, role (0 member, 1 query), digest, n, copies, tokens.
    Members are compared with each other in part 0 only.
    """
    ordered = rows.repartition("target", "part").sortWithinPartitions("target", "part", "role", "digest")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, group, parents = None, None, np.zeros(0, np.int64)
        members: list[tuple[bytes, int, np.ndarray]] = []
        queries: list[tuple[bytes, int, np.ndarray]] = []
        out: list[tuple] = []
        waiting, last = 0, None

        def root(i: int) -> int:
            while parents[i] != i:
                parents[i] = parents[parents[i]]
                i = int(parents[i])
            return i

        def open_group() -> None:
            """Compare the members with each other; find the group's own components."""
            nonlocal group, parents
            group, parents = OpenGroup([m[2] for m in members]), np.arange(len(members))
            copies = np.array([m[1] for m in members])
            for at in range(0, len(members), 256):
                block = [m[2] for m in members[at : at + 256]]
                links = linked(group.overlaps(block, percent), group.sizes[at : at + 256], group.sizes, percent)
                links[np.arange(len(block)), np.arange(at, at + len(block))] = False
                if key[1] == 0:
                    out.extend(("links", members[at + i][0], None, int(n)) for i, n in enumerate(links @ copies) if n)
                for i, j in zip(*np.nonzero(links), strict=True):
                    a, b = root(at + int(i)), root(int(j))
                    if a != b:
                        parents[max(a, b)] = min(a, b)
                        if key[1] == 0:
                            out.append(("edge", members[at + i][0], members[j][0], 0))

        def answer() -> None:
            """Compare the waiting queries with all members of the groups their bounds let open."""
            nonlocal waiting
            if group is None and len(members) > (0 if queries or not members or key[1] else 1):
                open_group()
            if queries and members:
                sizes = np.array([len(q[2]) for q in queries])
                links = linked(group.overlaps([q[2] for q in queries], percent), sizes, group.sizes, percent)
                copies = np.array([m[1] for m in members])
                theirs = np.array([q[1] for q in queries])
                out.extend(("links", queries[i][0], None, int(n)) for i, n in enumerate(links @ copies) if n)
                out.extend(("links", members[j][0], None, int(n)) for j, n in enumerate(theirs @ links) if n)
                for i in np.flatnonzero(links.any(axis=1)):
                    for j in {root(int(j)): int(j) for j in np.flatnonzero(links[i])}.values():
                        out.append(("edge", queries[i][0], members[j][0], 0))
            queries.clear()
            waiting = 0

        def table_of() -> pa.RecordBatch:
            columns = [pa.array([r[i] for r in out], t) for i, t in enumerate((pa.string(), pa.binary(), pa.binary(), pa.int64()))]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, names=["kind", "a", "b", "n"])

        for batch in batches:
            flat, starts = _tokens(batch.column(6))
            plain = [batch.column(i).to_pylist() for i in (0, 1, 2, 3, 5)]
            for i, (target, part, role, dig, copies) in enumerate(zip(*plain, strict=True)):
                if (target, part) != key:
                    answer()
                    key, group, last = (target, part), None, None
                    members.clear()
                if (role, dig) == last:
                    continue  # a repeated row of the class's document
                last = (role, dig)
                (queries if role else members).append((dig, copies, flat[starts[i] : starts[i + 1]]))
                if role:
                    waiting += int(starts[i + 1] - starts[i])
                    if len(queries) >= 256 or waiting > GROUP_TOKENS:
                        answer()
            if out:
                yield table_of()
        answer()
        if out:
            yield table_of()

    return ordered.transform(arrow_map, run, "kind string, a binary, b binary, n long")


def ngram_jaccard(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, n_links (other rows it links with), first_of_component."""
    sets = staged(document_sets(docs, id_col, text_col, shingle, percent), "jaccard-sets", "none")
    named = sets.select("doc_id", "n", "digest")
    classes = staged(
        named.filter(F.col("n") > 0).groupBy("digest").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies")), "jaccard-classes"
    )
    first = staged(build_groups(able_classes(sets, classes), percent, "jaccard-hot"), "jaccard-groups", "none")
    heavy = heavy_tokens(first)
    hard = staged(split_members(first, heavy, percent, hard=True), "jaccard-hard", "none")
    regrouped = staged(build_groups(hard, percent, "jaccard-hot-hard"), "jaccard-hard-groups", "none")
    matrix = matrix_rows(first, heavy, percent, with_hard=False).unionByName(matrix_rows(regrouped, heavy, percent, with_hard=True))
    pairs = staged(candidate_pairs(matrix, percent), "jaccard-pairs")
    entries = F.explode(F.arrays_zip("digest", "rep", "copies")).alias("m")
    anew = regrouped.select("grp", entries).select("grp", "m.digest", "m.rep", "m.copies")
    members = staged(split_members(first, heavy, percent, hard=False).unionByName(anew), "jaccard-members")
    return _finish(docs, named, classes, members, pairs, id_col, text_col, shingle, percent)


def _finish(
    docs: DataFrame, named: DataFrame, classes: DataFrame, grouped: DataFrame, pairs: DataFrame,
    id_col: str, text_col: str, shingle: int, percent: int,
) -> DataFrame:
    """Opens the candidate groups and turns links into components."""
    size_of = grouped.groupBy("grp").agg(F.count("*").alias("k"))
    with_sizes = pairs.join(size_of.select(F.col("grp").alias("a"), F.col("k").alias("ka")), "a").join(
        size_of.select(F.col("grp").alias("b"), F.col("k").alias("kb")), "b"
    )
    a_larger = (F.col("ka") > F.col("kb")) | ((F.col("ka") == F.col("kb")) & (F.col("a") < F.col("b")))
    asked = staged(
        with_sizes.select(
            F.when(a_larger, F.col("a")).otherwise(F.col("b")).alias("target"),
            F.when(a_larger, F.col("b")).otherwise(F.col("a")).alias("source"),
            F.least("ka", "kb").alias("n_queries"),
        ),
        "jaccard-asked",
    )
    alone = size_of.filter(F.col("k") > 1).select(F.col("grp").alias("target"), F.lit(0).cast("long").alias("n_queries"))
    targets = asked.select("target", "n_queries").unionByName(alone).groupBy("target").agg(F.sum("n_queries").alias("q"))
    targets = staged(targets.select("target", F.greatest(F.lit(1), F.ceil(F.col("q") / QUERIES_PER_PART)).cast("int").alias("parts")), "jaccard-targets")
    needed = targets.select(F.col("target").alias("grp")).unionByName(asked.select(F.col("source").alias("grp"))).distinct()
    wanted = grouped.join(needed, "grp", "left_semi")
    sets = staged(whole_sets(docs, wanted, id_col, text_col, shingle), "jaccard-whole", "none")
    members = sets.join(targets, F.col("grp") == F.col("target")).select(
        "target", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("role"), "digest", "n", "copies", "tokens"
    )
    asking = asked.select("target", "source").join(targets, "target")
    queries = sets.join(asking, F.col("grp") == F.col("source")).select(
        "target", F.pmod(F.xxhash64("digest"), F.col("parts")).cast("int").alias("part"), F.lit(1).alias("role"), "digest", "n", "copies", "tokens"
    )
    found = staged(open_groups(members.unionByName(queries), percent), "jaccard-links")
    edges = found.filter(F.col("kind") == "edge").select("a", "b")
    roots = connected_components(edges, "jaccard-components")
    labelled = classes.join(roots, F.col("digest") == F.col("node"), "left").withColumn("root", F.coalesce("root", F.col("digest")))
    smallest = labelled.groupBy("root").agg(F.min("rep").alias("component_id"))
    links = found.filter(F.col("kind") == "links").groupBy(F.col("a").alias("digest")).agg(F.sum("n").alias("links"))
    by_class = staged(
        labelled.join(smallest, "root").join(links, "digest", "left").select(
            "digest", "component_id", (F.coalesce("links", F.lit(0).cast("long")) + F.col("copies") - 1).alias("n_links")
        ),
        "jaccard-by-class",
    )
    some = F.col("n") > 0
    return named.join(by_class, "digest", "left").select(
        "doc_id",
        F.col("n").cast("long").alias("n_shingles"),
        F.when(some, F.coalesce("component_id", "doc_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.when(some, F.col("n_links")).otherwise(F.lit(0).cast("long")).alias("n_links"),
    )


@query("op10_ngram_jaccard")
def ngram_jaccard_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard(table(spark, sf_dir, "documents"))


def keep_one(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each component the document with the smallest id stays; documents without words stay.

    Documents link at STAGE_SHINGLE words and STAGE_PERCENT, not at the query's own values.
    Rows with the same id go or stay together. Rows without id stay only if
    their component has no id.
    """
    found = ngram_jaccard(docs, shingle=STAGE_SHINGLE, percent=STAGE_PERCENT).filter((F.col("n_shingles") > 0) & ~F.col("doc_id").eqNullSafe(F.col("component_id")))
    dropped = broadcast_if_small(staged(found.select("doc_id").distinct(), "jaccard-dropped"), 16)
    rows = docs.select(whole_row(docs).alias("row"), F.col("doc_id").alias("id"))
    return rows.join(dropped, rows["id"].eqNullSafe(dropped["doc_id"]), "left_anti").select("row.*")
