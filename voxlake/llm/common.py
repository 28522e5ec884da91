"""What the training-data operators share: the shared folder, written tables, connected components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import drop, new_path, prepare, shared_dir, table  # noqa: F401

#: The white space that separates words in every operator here: blank and \t \n \v \f \r.
WORD = r"[^\x20\x09-\x0D]+"


def text_key(*cols: str | Column) -> list[Column]:
    """128 bits that stand for the given columns' values: two hashes with different starts."""
    return [F.xxhash64(*cols), F.xxhash64(F.lit(7919), *cols)]


def quoted(name: str) -> Column:
    """The column of just this name, whatever characters it has."""
    return F.col(f"`{name.replace('`', '``')}`")


def whole(df: DataFrame) -> Column:
    """All columns of df as one struct `row`, so that no name of theirs meets a name of an operator's own."""
    return F.struct(*map(quoted, df.columns)).alias("row")


def unpacked(names: list[str]) -> list[Column]:
    """The given fields of `row` as columns again."""
    return [F.col("row").getField(n).alias(n) for n in names]


def rest_key(df: DataFrame, *known: str) -> Column:
    """A hash of all columns but the known ones (maps, which have no order, are left out): tells rows apart whose
    id and text are equal."""
    others = [f.name for f in df.schema if f.name not in known and not any(k in f.dataType.simpleString() for k in ("map<", "variant"))]
    return F.xxhash64(F.lit(1), *map(quoted, others))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of an undirected graph.

    edges: (a long, b long), any order, repeats and loops allowed. Returns (node, root) for every
    node that has an edge to another node; root is one node of its component. Each round every node
    picks the neighbour of least hashed rank (a new hash each round, so chains shrink by a constant
    factor) and the graph is contracted along these picks. All state lives in written tables; joins on
    hub nodes are plain equi joins, which adaptive execution splits when they are skewed.
    """
    e = table(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    found, turn = None, 0
    while not e.isEmpty():
        both = e.select("a", "b").union(e.select("b", "a"))
        rank = lambda c, t=turn: F.struct(F.xxhash64(F.lit(t), c).alias("h"), F.col(c).alias("v"))
        pick = both.groupBy("a").agg(F.min(rank("b")).alias("best"))
        pick = table(pick.select(F.col("a").alias("node"), F.least(F.col("best"), rank("a"))["v"].alias("up")), "picks")
        up = lambda c: pick.select(F.col("node").alias(c), F.col("up").alias(f"{c}2"))
        after = e.join(up("a"), "a").join(up("b"), "b").filter("a2 <> b2")
        after = after.select(F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b")).distinct()
        after = table(after, "edges")
        if found is None:
            moved = pick.select("node", F.col("up").alias("root"))
        else:
            moved = found.join(pick.select(F.col("node").alias("root"), "up"), "root", "left")
            moved = moved.select("node", F.coalesce("up", "root").alias("root"))
        moved = table(moved, "roots")
        for old in filter(None, (e, pick, found)):
            drop(old)
        e, found, turn = after, moved, turn + 1
    return found if found is not None else e.select(F.col("a").alias("node"), F.col("b").alias("root"))
