"""Ordered work on groups of any size: ranges of a group's order, and what is carried over their seams.

A window over a group holds the whole group in one task. Here groups of more than SIZE rows are cut into ranges of equal
width of their order, about SIZE rows each, and windows run over (group, range). What crosses a seam is one row for each
range: counts before it, the last row before it. Small groups are one range, and for them nothing is looked up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..sources.shared import table

#: Rows of a range, about.
SIZE = 4096
#: Columns that in_ranges() adds: the range's number, and the rows of the group if it has several ranges. Without such a
#: group there is no TOTAL, and nothing that crosses seams is planned.
RANGE, TOTAL = "__range", "__total"


def in_ranges(rows: DataFrame, group: str, at: str, size: int | None = None) -> DataFrame:
    """rows with RANGE, which never falls as `at` (a number) rises within the group, and TOTAL. Nulls of `at` are in the
    first range; rows without a group are one range. Counts rows at once, by a job of its own; rows that have their ranges
    already, from an operator before, are not counted again."""
    if RANGE in rows.columns:
        return rows
    size = size or SIZE
    large = rows.groupBy(F.col(group).alias("__group")).agg(F.count("*").alias(TOTAL), F.min(at).cast("double").alias("__low"), F.max(at).cast("double").alias("__high"))
    # at most a row for every `size` rows; written, so that Spark knows whether to broadcast it and rows are not dealt out by group
    large = table(large.filter(F.col(TOTAL) > size), "large-groups")
    if large.isEmpty():
        return rows.withColumn(RANGE, F.lit(0).cast("long"))
    many = F.ceil(F.col(TOTAL) / size)
    share = (F.col(at).cast("double") - F.col("__low")) / F.nullif(F.col("__high") - F.col("__low"), F.lit(0.0))
    number = F.floor(F.least(share * many, many - 1.0)).cast("long")
    out = rows.join(large, F.col(group) == F.col("__group"), "left")
    return out.withColumn(RANGE, F.coalesce(number, F.lit(0).cast("long"))).drop("__group", "__low", "__high")


def window(group: str, *order: str) -> WindowSpec:
    """One range in its order."""
    return Window.partitionBy(group, RANGE).orderBy(*order) if order else Window.partitionBy(group, RANGE)


def with_seams(rows: DataFrame, group: str, **carried: tuple[Column, str]) -> DataFrame:
    """rows (in ranges) with columns carried from the ranges before: name=(aggregate over a range, "sum" or "last"), the sum over
    all ranges of the group before (0 at first) or the value of the last one (null at first). One row a range is looked up,
    and none for groups of one range."""
    if TOTAL not in rows.columns:
        return rows.withColumns({n: F.lit(0).cast("long") if how == "sum" else F.lit(None) for n, (_, how) in carried.items()})
    each = rows.filter(F.col(TOTAL).isNotNull()).groupBy(F.col(group).alias("__group"), F.col(RANGE).alias("__number")).agg(*[a.alias(n) for n, (a, _) in carried.items()])
    w = Window.partitionBy("__group").orderBy("__number")
    before = {n: F.coalesce(F.sum(n).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) if how == "sum" else F.lag(n).over(w) for n, (_, how) in carried.items()}
    out = rows.join(each.withColumns(before), (F.col(group) == F.col("__group")) & (F.col(RANGE) == F.col("__number")), "left").drop("__group", "__number")
    return out.withColumns({n: F.coalesce(n, F.lit(0)) for n, (_, how) in carried.items() if how == "sum"})


def join_at_seams(parts: DataFrame, group: str, edge: Column, order: list[str], joins, merged: list[Column]) -> DataFrame:
    """Islands that were found within ranges, joined over the seams. edge: an island that begins or ends its range; only
    these, two a range at most, meet those of other ranges. joins(previous): whether an island continues the one before, where
    previous(column) is that one's column. merged: aggregates of the islands that are one."""
    key = F.when(edge, F.lit(-1).cast("long")).otherwise(F.col(RANGE))
    parts = parts.withColumn("__seam", key)
    w = Window.partitionBy(group, "__seam").orderBy(RANGE, *order)
    new = F.coalesce((F.col("__seam") < 0) & joins(lambda c: F.lag(c).over(w)), F.lit(False))
    runs = parts.withColumn("__new", (~new).cast("int")).withColumn("__run", F.sum("__new").over(w))
    return runs.groupBy(group, "__seam", "__run").agg(*merged).drop("__seam", "__run")
