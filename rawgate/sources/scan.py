"""Prefix scan of finite state functions over the rows of a file, however many there are.

A function of three states is a number from 0 to 26, its values as digits to base
3. Composing is associative, so rows are composed in groups of bounded size,
groups in groups, and so on; no task gets more than one group's rows at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rawgate.session import stage

STATES = 3
SPAN = 256


def code(values: list[Column]) -> Column:
    """The function that takes state i to values[i]."""
    return sum((v * STATES**i for i, v in enumerate(values)), F.lit(0)).cast("int")


def _apply(f: int, state: int) -> int:
    return f // STATES**state % STATES


IDENTITY = sum(i * STATES**i for i in range(STATES))
_FUNCTIONS = STATES**STATES
_TABLE = [sum(_apply(g, _apply(f, i)) * STATES**i for i in range(STATES)) for f in range(_FUNCTIONS) for g in range(_FUNCTIONS)]


def then(f: Column, g: Column) -> Column:
    """First f, then g."""
    return F.get(F.lit(_TABLE), f * _FUNCTIONS + g)


def from_first(f: Column) -> Column:
    """The state that f takes state 0 to."""
    return f % STATES


def _in_groups(rows: DataFrame, keys: list[str], order: str) -> tuple[DataFrame, DataFrame]:
    """(rows with their group and what comes before them in it, groups with their whole function)."""
    ranked = rows.withColumn("_i", F.row_number().over(Window.partitionBy(*keys).orderBy(order)) - 1)
    ranked = ranked.withColumn("grp", F.floor(F.col("_i") / SPAN).cast("long"))
    listed = ranked.groupBy(*keys, "grp").agg(F.sort_array(F.collect_list(F.struct(order, "f"))).alias("e"))
    start = F.struct(F.lit(IDENTITY).alias("f"), F.array().cast("array<int>").alias("seen"))

    def add(state: Column, x: Column) -> Column:
        return F.struct(then(state["f"], x["f"]).alias("f"), F.concat(state["seen"], F.array(state["f"])).alias("seen"))

    done = stage(listed.withColumn("s", F.aggregate("e", start, add)), "scan")
    each = done.select(*keys, "grp", F.explode(F.arrays_zip(F.col(f"e.{order}").alias(order), F.col("s.seen").alias("before"))).alias("x"))
    return each.select(*keys, "grp", F.col(f"x.{order}").alias(order), F.col("x.before").alias("before")), done.select(*keys, "grp", F.col("s.f").alias("f"))


def _over_file(rows: DataFrame) -> DataFrame:
    """file_nm, pos, before for rows (file_nm, pos, f)."""
    inner, groups = _in_groups(rows, ["file_nm"], "pos")
    if not groups.filter("grp > 0").take(1):
        return inner.drop("grp")
    outer = _over_file(groups.withColumnRenamed("grp", "pos")).withColumnsRenamed({"pos": "grp", "before": "_outer"})
    return inner.join(outer, ["file_nm", "grp"]).select("file_nm", "pos", then(F.col("_outer"), F.col("before")).alias("before"))


def functions_before(rows: DataFrame) -> DataFrame:
    """file_nm, block, line_id, before: for rows (file_nm, block, line_id, f) the functions of all rows of the file before, composed."""
    inner, groups = _in_groups(rows.select("file_nm", "block", "line_id", "f"), ["file_nm", "block"], "line_id")
    outer = _over_file(groups.select("file_nm", F.struct("block", "grp").alias("pos"), "f"))
    outer = outer.select("file_nm", "pos.*", F.col("before").alias("_outer"))
    return inner.join(outer, ["file_nm", "block", "grp"]).select("file_nm", "block", "line_id", then(F.col("_outer"), F.col("before")).alias("before"))
