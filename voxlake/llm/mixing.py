"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source gets the same copy rate. Its whole part is taken at once; the fractional parts
are rounded in pairs: two open documents exchange words, in a random direction that keeps each one's
expectation, until one of them has 0 or 1 extra copies. The sum of words of a source never changes on the
way, so each source misses its target by less than one document. Blocks of a source are rounded in
parallel and the one open document of each block goes up a tree until the source has a single one left.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WORD, prepare, rest_key, table, unpacked, whole

#: Documents in a block, and open documents that meet at the next level of the tree.
BLOCK, FAN = 4096, 64
#: No document is taken more often than this.
MOST = 3
WEIGHTS = (1, 2, 3)


def targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, n, target) from (source, size): see mix(). The level that fills sources up to
    their caps is found by aggregates; no source list reaches the driver."""
    src = table(sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n")), "sources")
    # the rank of each source without one global window: a range partition's offset plus the rank within it
    ranged = table(src.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id()), "ranged")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row a partition, no more
    before = ranged.groupBy("part").count().select("part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    rank = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())) - 1
    ranked = ranged.withColumn("rank", rank).join(F.broadcast(before), "part")  # a row a partition
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.pmod(F.col("rank") + F.col("before"), F.lit(len(WEIGHTS))) + 1).cast("int"))
    src = table(ranked.select("source", "source_size", "n", weight.cast("double").alias("weight")), "weighted")
    cap, level = F.col("source_size") * float(MOST), None
    while True:
        stops = F.lit(False) if level is None else F.col("weight") * level > cap
        r = src.agg(F.sum("source_size").alias("all"), F.sum(F.when(stops, cap).otherwise(0.0)).alias("capped"), F.sum(F.when(stops, 0.0).otherwise(F.col("weight"))).alias("open"), F.sum(stops.cast("long")).alias("n")).first()
        now = (r["all"] - r["capped"]) / r["open"] if r["open"] else 0.0
        if level is not None and (r["n"] == count or not r["open"]):
            break
        level, count = now, r["n"]
    return src.select("source", "source_size", "n", F.least(F.col("weight") * level, cap).alias("target"))


def _round(batches: Iterator[pa.RecordBatch], last: bool) -> Iterator[pa.RecordBatch]:
    """Pivotal rounding of rows that come sorted by block; p is the open fraction, u the row's random number.
    One document is carried at a time, whatever the block's size."""
    block, held = None, None
    for b in batches:
        cols = {n: b.column(n).to_pylist() for n in ("source", "block", "size", "p", "u")}
        out = []  # (row, p)
        for i, key in enumerate(zip(cols["source"], cols["block"], strict=True)):
            row, size, p, u = b.slice(i, 1), cols["size"][i], cols["p"][i], cols["u"][i]
            if key != block:
                if held is not None:
                    out.append((held[0], _close(held) if last else held[2]))
                block, held = key, None
            if not size or p in (0.0, 1.0):
                out.append((row, 0.0 if not size else p))
            elif held is None:
                held = (row, size, p, u)
            else:
                first, s, q, v = held
                gain = min((1 - q) * s, p * size)  # words that the held document can get
                loss = min(q * s, (1 - p) * size)  # and can give
                if u * (gain + loss) < loss:
                    full = (1 - q) * s <= p * size
                    a, c = (1.0, p - gain / size) if full else (q + gain / s, 0.0)
                else:
                    none = q * s <= (1 - p) * size
                    a, c = (0.0, p + loss / size) if none else (q - loss / s, 1.0)
                if a in (0.0, 1.0):
                    out.append((first, a))
                    if c <= 0.0 or c >= 1.0:
                        out.append((row, float(c >= 0.5)))
                        held = None
                    else:
                        held = (row, size, c, v)
                else:
                    out.append((row, c))
                    held = (first, s, a, v)
        if out:
            yield _with(out)
    if held is not None:
        yield _with([(held[0], _close(held) if last else held[2])])


def _close(held: tuple) -> float:
    return float(held[3] < held[2])


def _with(out: list) -> pa.RecordBatch:
    t = pa.Table.from_batches([r for r, _ in out]).combine_chunks()
    return t.set_column(t.schema.get_field_index("p"), "p", pa.array([float(p) for _, p in out])).to_batches()[0]


def row_key(text: Column, rest: Column | None) -> list[Column]:
    """A hash of the text, and one of the text and rest, a hash of other columns."""
    return [F.xxhash64(text), F.xxhash64(F.lit(7919), text, *([] if rest is None else [rest]))]


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 7, rest: Column | None = None) -> DataFrame:
    """(doc_id, t1, t2, source, size, source_size, target, copies, taken) for every input row.

    size: words of the text (null or empty: 0). Sources in code point order, null last, weigh 1, 2, 3,
    repeating, and share all words; a target stops at 3 times its source's words and the rest is shared
    again by weight. copies is 0 to 3 and taken is copies * size. Random numbers come from hashes of id and
    text, so reruns agree; rows repeated in full are interchangeable. t1 and t2 stand for the text and, if given, rest, a
    hash of other columns. Texts may be of any length; other columns, of any name, are
    not looked at. A source without words has target 0;
    an empty table gives an empty result.
    """
    prepare(docs.sparkSession)
    t = F.coalesce(F.col(text_col), F.lit(""))
    t1, t2 = row_key(t, rest)
    rows = docs.select(F.col(id_col).alias("doc_id"), t1.alias("t1"), t2.alias("t2"), F.col(source_col).cast("string").alias("source"), F.regexp_count(t, F.lit(WORD)).cast("long").alias("size"))
    rows = table(rows, "sizes")
    src = table(targets(rows.select("source", "size")), "targets")
    key = src.select(F.col("source").alias("s2"), "source_size", "target", (F.floor(F.col("n") / BLOCK) + 1).alias("blocks"))
    top = src.agg(F.max("n")).first()[0] or 0
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rows = rows.join(key, F.expr("source <=> s2")).drop("s2").withColumn("rate", F.least(rate, F.lit(float(MOST))))
    rows = rows.withColumn("base", F.floor("rate").cast("long")).withColumn("p", F.col("rate") - F.col("base"))
    rows = rows.withColumn("h", F.xxhash64(F.lit(seed), "doc_id", "t1"))
    rows = rows.withColumn("u", F.pmod(F.xxhash64(F.lit(seed + 1), "h"), F.lit(1 << 52)) / F.lit(float(1 << 52)))
    rows = rows.withColumn("block", F.pmod(F.col("h"), F.col("blocks"))).drop("blocks", "rate")
    names = rows.columns
    kind = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    blocks, done, live = top // BLOCK + 1, None, rows
    while True:
        last = blocks == 1
        live = live.repartition("source", "block").sortWithinPartitions("source", "block", "h", "doc_id", "t1", "t2")
        out = table(live.mapInArrow(lambda b, last=last: _round(b, last), kind), "rounded")
        closed = out.filter("p = 0 or p = 1")
        done = closed if done is None else done.union(closed)
        if last:
            break
        live = out.filter("p > 0 and p < 1").withColumn("block", F.floor(F.col("block") / FAN)).select(names)
        blocks = -(-blocks // FAN)
    copies = F.col("base") + F.col("p").cast("long")
    return done.select("doc_id", "t1", "t2", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def take(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of docs as often as the mix takes them, with all their columns, whatever their names. Rows that differ
    in any column are mixed each for itself; of rows repeated in full the copies add up."""
    rest = rest_key(docs, id_col, text_col, source_col)
    got = mix(docs, id_col, text_col, source_col, rest=rest).groupBy("doc_id", "t1", "t2", "source").agg(F.sum("copies").alias("n"))
    got = got.filter("n > 0").withColumnsRenamed({c: f"g_{c}" for c in ("doc_id", "t1", "t2", "source")})
    t1, t2 = row_key(F.coalesce(F.col(text_col), F.lit("")), rest)
    mine = docs.select(whole(docs), F.col(id_col).alias("doc_id"), t1.alias("t1"), t2.alias("t2"), F.col(source_col).cast("string").alias("source"))
    mine = mine.dropDuplicates(["t1", "t2", "doc_id", "source"])
    mine = mine.join(got, F.expr("t1 = g_t1 and t2 = g_t2 and doc_id <=> g_doc_id and source <=> g_source"))
    return mine.select("row", F.explode(F.expr("sequence(1L, n)"))).select(*unpacked(docs.columns))
