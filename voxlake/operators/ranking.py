"""Places of rows in an order, for groups of any size.

A window over a group holds the whole group in one task. Here rows are cut into ranges of group and order by sampled
bounds, each task numbers the rows of its range, and the counts of the ranges before, one row for each range and
group, give every range its offset. A group of a third of all rows is spread over a third of the tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import drop, table

#: Names that placed() uses for a while; rows must not have them.
AT, PART, START, BEFORE = "__at", "__part", "__start", "__before"
#: Rows of one range in monotonically_increasing_id.
BITS = 33


def placed(rows: DataFrame, order: Sequence[str | Column], within: Sequence[str] = (), name: str = "place", of: str | None = None) -> DataFrame:
    """rows with their place from 0 in the order of their group (the columns `within`; nulls are one group), and with `of`
    the number of rows of the group. Rows that are equal in the order get different places.

    Runs at once: the sorted rows are a written table, so that numbers and offsets are of the same ranges."""
    keys = [F.col(c) for c in within]
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    ordered = rows.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    ordered = table(ordered.withColumn(AT, F.monotonically_increasing_id()), "ordered")
    ordered = ordered.withColumn(PART, F.shiftright(AT, BITS))
    runs = ordered.groupBy(*within, PART).agg(F.min(AT).alias(START), F.count("*").alias("n"))
    group = Window.partitionBy(*within)
    runs = runs.withColumn(BEFORE, F.coalesce(F.sum("n").over(group.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    runs = runs.withColumn("__of", F.sum("n").over(group)).drop("n")
    runs = table(runs.withColumnsRenamed({c: f"__{c}" for c in within}), "runs")
    same = F.col(PART) == F.col(f"{PART}2")
    for c in within:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    out = ordered.join(runs.withColumnRenamed(PART, f"{PART}2"), same)
    out = out.withColumn(name, F.col(AT) - F.col(START) + F.col(BEFORE))
    if of:
        out = out.withColumn(of, F.col("__of"))
    return out.select(*rows.columns, name, *([of] if of else []))
