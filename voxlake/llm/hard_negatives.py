"""Hard negatives by exact integer scores in a residue number system.

Components become whole numbers, floor(256 * x). The scores of a block of rows with a block of anchors are computed
modulo several primes, each by one float32 matrix product: residues are at most half a prime in size, and at most
DEPTH products are added before the next reduction, so every sum stays below 2 ** 24 and is exact. Chinese remaindering in
balanced mixed radix turns the residues into the signed scores. How many primes a pair of blocks needs follows from the
lengths of its vectors (Cauchy-Schwarz), so nothing is known of the table beforehand.

Rows and anchors are packed into blocks; a slice of row blocks and a slice of anchor blocks meet in one task, which
keeps only each anchor's best candidates. Windows over these select the best of all slices: first the positives, then,
with their scores as bounds, the negatives.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import drop, prepare, quoted, table

#: Components of one partial product: DEPTH * (1021 // 2) ** 2 < 2 ** 24.
DEPTH = 64
#: Rows and anchors of a block at most, and blocks of a slice.
ROWS, ANCHORS = 2048, 1024
ROW_BLOCKS, ANCHOR_BLOCKS = 64, 16
#: Squared length from which a quantised vector takes no part: up to here all scores, and 20 times them, fit in 64 bits.
LONGEST = float(1 << 58)
#: Lengths of vectors up to which the grid's size for each is broadcast.
LENGTHS = 10_000
POSITIVES, NEGATIVES = 5, 3


def primes(most: int = 1021) -> Iterator[int]:
    """Odd primes from `most` down."""
    for n in range(most, 2, -1):
        if n % 2 and all(n % d for d in range(3, isqrt(n) + 1, 2)):
            yield n


def basis(bound: int) -> list[int]:
    """Primes whose product exceeds all numbers from -bound to bound."""
    out, product = [], 1
    for p in primes():
        out.append(p)
        product *= p
        if product > 2 * bound:
            return out
    raise ValueError("no basis for this bound")


def _balanced(x: np.ndarray, p: int) -> np.ndarray:
    """Residues of whole numbers from -(p // 2) to p // 2."""
    return (x + p // 2) % p - p // 2


def _residue_product(a: np.ndarray, b: np.ndarray, p: int) -> np.ndarray:
    """Balanced residues of a @ b.T modulo p, by float32 products of DEPTH components each."""
    total = np.zeros((len(a), len(b)), np.int64)
    for k in range(0, a.shape[1], DEPTH):
        x, y = (_balanced(m[:, k : k + DEPTH], p).astype(np.float32) for m in (a, b))
        total = _balanced(total + (x @ y.T).astype(np.int64), p)
    return total


def exact_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T of int64 matrices whose rows are shorter than the root of LONGEST."""
    longest = [float((m.astype(np.float64) ** 2).sum(axis=1).max(initial=0)) for m in (a, b)]
    moduli = basis(int(np.sqrt(longest[0] * longest[1]) * (1 + 1e-9)) + 1)
    value, product = _residue_product(a, b, moduli[0]), moduli[0]
    for p in moduli[1:]:  # digits of the balanced mixed radix, the least first
        digit = _balanced((_residue_product(a, b, p) - _balanced(value, p)) * pow(product, -1, p), p)
        value = value + digit * np.uint64(product % (1 << 64)).astype(np.int64)  # the last step may pass 2 ** 63 and come back
        product *= p
    return value


def _packed(x: np.ndarray) -> tuple[bytes, int]:
    """Bytes of whole numbers in the narrowest type that holds them, and its width."""
    most = int(np.abs(x).max(initial=0))
    width = next(w for w in (1, 2, 4, 8) if most < 1 << (8 * w - 1))
    return x.astype(f"<i{width}").tobytes(), width


BLOCK = "dim int, n int, width int, vectors binary, ids binary, hashes binary, labels binary, bounds binary"


def pack(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Blocks of at most `size` rows of one length from batches of (vec_id, h, label, v[, bounds]): labels as numbers
    of the row's label code; rows of a block are different and in order of (vec_id, h)."""

    def block(t: pa.Table) -> pa.RecordBatch | None:
        v = t.column("v").combine_chunks()
        q = np.floor(256 * v.flatten().to_numpy(zero_copy_only=False).astype(np.float64)).reshape(len(v), -1) if len(v.values) else np.zeros((len(v), 0))
        ids, hashes = t.column("vec_id").to_numpy(), t.column("h").to_numpy()
        fits = (q**2).sum(axis=1) < LONGEST
        order = np.lexsort((hashes, ids))
        order = order[fits[order]]
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(ids[order]) != 0) | (np.diff(hashes[order]) != 0)
        order = order[new]
        if not len(order):
            return None
        vectors, width = _packed(q[order].astype(np.int64))
        bounds = t.column("bounds").combine_chunks().take(pa.array(order)).flatten().to_numpy().astype("<i8").tobytes() if "bounds" in t.column_names else b""
        out = [[q.shape[1]], [len(order)], [width], [vectors], [ids[order].astype("<i8").tobytes()], [hashes[order].astype("<i8").tobytes()], [t.column("label").to_numpy()[order].astype("<i8").tobytes()], [bounds]]
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, (pa.int32(), pa.int32(), pa.int32(), *[pa.binary()] * 5), strict=True)], ["dim", "n", "width", "vectors", "ids", "hashes", "labels", "bounds"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[pa.Table]] = {}  # rows of each length that do not fill a block yet
        for b in batches:
            dims = pc.list_value_length(b.column("v")).to_numpy()
            for dim in np.unique(dims).tolist():
                t = pa.concat_tables([*held.pop(dim, []), pa.Table.from_batches([b]).filter(pa.array(dims == dim))])
                full = len(t) - len(t) % size
                yield from filter(None, (block(t.slice(k, size)) for k in range(0, full, size)))
                if full < len(t):
                    held[dim] = [t.slice(full)]
            while sum(len(t) for x in held.values() for t in x) > 4 * size:  # many lengths: the largest rest goes as it is
                dim = max(held, key=lambda d: sum(map(len, held[d])))
                yield from filter(None, [block(pa.concat_tables(held.pop(dim)))])
        for x in held.values():
            yield from filter(None, [block(pa.concat_tables(x))])

    return run


class Block:
    """A block as arrays again."""

    def __init__(self, r: dict):
        n = r["n"]
        self.q = np.frombuffer(r["vectors"], f"<i{r['width']}").reshape(n, r["dim"]).astype(np.int64)
        self.ids, self.hashes, self.labels = (np.frombuffer(r[c], "<i8") for c in ("ids", "hashes", "labels"))
        self.bounds = np.frombuffer(r["bounds"], "<i8").reshape(n, -1)


def meet(rows: DataFrame, anchors: DataFrame, kernel: Callable) -> DataFrame:
    """(anchor, anchor_h, place, id, h, score): what kernel(anchors, rows, scores) keeps of every pair of a row block and an
    anchor block of one length (written tables of BLOCK and a block's number); kernel gives (anchor number, place, row
    number) arrays, and of each anchor and place the best `kernel.most` over all blocks of a slice go out.

    Slices of row blocks and slices of anchor blocks are dealt out as a grid. In a cell the anchors come first and stay,
    the row blocks pass by, so a task holds one slice of anchors and one block of rows."""
    parts = 4 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    count = lambda x, name: x.groupBy("dim").agg(F.count("*").alias(name))
    sizes = count(rows, "nr").join(count(anchors, "na"), "dim")
    sizes = table(sizes.select("dim", F.least("nr", F.greatest(F.lit(parts), F.ceil(F.col("nr") / ROW_BLOCKS))).cast("int").alias("across"), F.ceil(F.col("na") / ANCHOR_BLOCKS).cast("int").alias("down")), "grid")
    sizes = F.broadcast(sizes) if sizes.count() <= LENGTHS else sizes  # a row for each length of vectors
    slot = lambda n: F.pmod(F.xxhash64("block"), F.col(n)).cast("int")
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    r = rows.join(sizes, "dim").withColumn("col", slot("across")).withColumn("line", spread("down")).withColumn("side", F.lit(1))
    a = anchors.join(sizes, "dim").withColumn("line", slot("down")).withColumn("col", spread("across")).withColumn("side", F.lit(0))
    cell = ["dim", "line", "col"]
    both = a.unionByName(r).drop("across", "down").repartition(parts, *cell).sortWithinPartitions(*cell, "side")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []  # anchor blocks of the cell, each with its best rows so far

        def kept() -> Iterator[pa.RecordBatch]:
            for block, (at, place, i, h, score) in held:
                if len(at):
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (block.ids[at], block.hashes[at], place.astype(np.int32), i, h, score)], ["anchor", "anchor_h", "place", "id", "h", "score"])

        for b in batches:
            for x in b.to_pylist():
                key = tuple(x[c] for c in cell)
                if key != now:
                    yield from kept()
                    now, held = key, []
                if x["side"] == 0:
                    held.append([Block(x), (*[np.zeros(0, np.int64)] * 5,)])
                    continue
                block = Block(x)
                for one in held:
                    s = exact_products(one[0].q, block.q)
                    at, place, k = kernel(one[0], block, s)
                    new = (at, place, block.ids[k], block.hashes[k], s[at, k])
                    one[1] = _top(*[np.concatenate(p) for p in zip(one[1], new, strict=True)], kernel.most)
        yield from kept()

    return both.mapInArrow(run, "anchor long, anchor_h long, place int, id long, h long, score long")


def _top(at: np.ndarray, place: np.ndarray, i: np.ndarray, h: np.ndarray, score: np.ndarray, most: int) -> tuple[np.ndarray, ...]:
    """The first `most` different rows (i, h) of each (at, place), the highest score first, then the smallest (i, h)."""
    order = np.lexsort((h, i, -score, place, at))
    at, place, i, h, score = (x[order] for x in (at, place, i, h, score))

    def repeats(*cols: np.ndarray) -> np.ndarray:
        out = np.zeros(len(cols[0]), bool)
        out[1:] = np.logical_and.reduce([c[1:] == c[:-1] for c in cols])
        return out

    once = ~repeats(at, place, i, h)
    at, place, i, h, score = (x[once] for x in (at, place, i, h, score))
    first = np.flatnonzero(~repeats(at, place))
    rank = np.arange(len(at)) - np.repeat(first, np.diff([*first, len(at)]))
    return tuple(x[rank < most] for x in (at, place, i, h, score))


class Nearest:
    """Kernel of the positives: rows of the anchor's label, other ids."""

    most = POSITIVES

    def __call__(self, anchors: Block, rows: Block, s: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at, kept = [], []
        for i in range(len(s)):
            own = np.flatnonzero((rows.labels == anchors.labels[i]) & (rows.ids != anchors.ids[i]))
            own = own[np.argsort(-s[i, own], kind="stable")[: self.most]]
            at.append(np.full(len(own), i))
            kept.append(own)
        at = np.concatenate(at)
        return at, np.zeros(len(at), np.int64), np.concatenate(kept)


class Within:
    """Kernel of the negatives: rows of other labels whose score lies in one of the anchor's windows."""

    most = NEGATIVES

    def __call__(self, anchors: Block, rows: Block, s: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at, place, kept = [], [], []
        for i in range(len(s)):
            other = np.flatnonzero((rows.labels != anchors.labels[i]) & (rows.ids != anchors.ids[i]))
            order = other[np.argsort(-s[i, other], kind="stable")]
            down = -s[i, order]
            low, high = anchors.bounds[i, 0::2], anchors.bounds[i, 1::2]
            first, last = np.searchsorted(down, -high, "left"), np.searchsorted(down, -low, "right")
            for k, (x, y) in enumerate(zip(first.tolist(), np.minimum(last, first + self.most).tolist(), strict=True)):
                if y > x:
                    at += [i] * (y - x)
                    place += [k] * (y - x)
                    kept.append(order[x:y])
        return np.array(at, np.int64), np.array(place, np.int64), np.concatenate([np.zeros(0, np.int64), *kept])


def best(found: DataFrame, most: int) -> DataFrame:
    """found with the rank of the first `most` different rows of each anchor and place, over all slices."""
    who = ["anchor", "anchor_h", "place"]
    w = Window.partitionBy(*who).orderBy(F.col("score").desc(), "id", "h")
    return found.withColumn("rank", F.dense_rank().over(w)).filter(F.col("rank") <= most).dropDuplicates([*who, "rank"])


def blocks(rows: DataFrame, size: int, name: str) -> DataFrame:
    return table(rows.mapInArrow(pack(size), BLOCK).withColumn("block", F.monotonically_increasing_id()), name)


def mine(vectors: DataFrame, anchor: Column, id_col: str = "vec_id", label_col: str | Column = "label", vec_col: str = "embedding") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for every row that `anchor` holds for (an
    expression of the table's columns) and each of its POSITIVES best rows of its own label, the NEGATIVES best rows of other
    labels whose score is at least half and at most 95 % of the positive's.

    Scores are inner products of floor(256 * x); higher ones come first, of equal ones the smaller id. Rows with a null id,
    label or vector or with a null, NaN or infinite component take no part, nor do vectors whose quantised squared length is
    2 ** 58 or more (their scores might not fit in 64 bits). Rows equal in id, label and vector count once; rows that share
    only their id are rows of their own, but never positives or negatives of each other. Vectors of different
    lengths have no score; empty ones score 0 with each other. Anchors without positives, and positives without negatives,
    have no rows; an empty table gives an empty result. Other columns, of any name, are not looked at."""
    prepare(vectors.sparkSession)
    label = quoted(label_col) if isinstance(label_col, str) else label_col
    kind = "float" if vectors.schema[vec_col].dataType.simpleString() == "array<float>" else "double"  # as narrow as they come
    rows = vectors.select(quoted(id_col).cast("long").alias("vec_id"), label.alias("label"), quoted(vec_col).cast(f"array<{kind}>").alias("v"), F.coalesce(anchor, F.lit(False)).alias("is_anchor"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(fine, F.lit(False)))
    whole = rows.schema["label"].dataType.simpleString() in ("tinyint", "smallint", "int", "bigint")
    rows = rows.withColumn("label", F.col("label").cast("long") if whole else F.xxhash64("label")).withColumn("h", F.xxhash64("label", "v"))
    row_blocks = blocks(rows.drop("is_anchor"), ROWS, "row-blocks")
    chosen = table(rows.filter("is_anchor").drop("is_anchor").dropDuplicates(["vec_id", "h"]), "anchors")
    dealt = lambda df: blocks(df.repartitionByRange("vec_id", "h"), ANCHORS, "anchor-blocks")
    first = dealt(chosen)
    near = best(meet(row_blocks, first, Nearest()), POSITIVES)
    near = table(near.select("anchor", "anchor_h", (F.col("rank") - 1).alias("place"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    drop(first)
    # a negative's score n keeps to p <= 2 * n and 20 * n <= 19 * p, which no n does for p < 0; a place without p has an empty window
    window = F.array(F.expr("(positive_score + 1) div 2"), F.expr("(19 * positive_score) div 20"))
    windows = near.filter("positive_score >= 0").groupBy("anchor", "anchor_h").agg(F.map_from_entries(F.collect_list(F.struct("place", window))).alias("at"))
    none = F.array(F.lit(1), F.lit(0)).cast("array<bigint>")
    bounds = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(POSITIVES - 1)), lambda k: F.coalesce(F.col("at")[k], none)))
    windows = windows.select(F.col("anchor").alias("vec_id"), F.col("anchor_h").alias("h"), bounds.alias("bounds"))
    hard = best(meet(row_blocks, dealt(chosen.join(windows, ["vec_id", "h"])), Within()), NEGATIVES)
    hard = hard.select("anchor", "anchor_h", "place", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    out = near.join(hard, ["anchor", "anchor_h", "place"])
    return out.select(F.col("anchor").alias("anchor_id"), "positive_id", "rank", "negative_id", "positive_score", "negative_score")


#: All anchors against all rows.
SQL = f"""
WITH v AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, embedding AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
q AS (SELECT vec_id, label, list_transform(x, lambda c: floor(256 * CAST(c AS DOUBLE))) AS e FROM v),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
  FROM q a JOIN q b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE a.vec_id % 50 = 0),
p AS (
  SELECT anchor_id, id, score, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS place FROM s WHERE same
  QUALIFY place <= {POSITIVES}),
n AS (
  SELECT p.anchor_id, p.id AS positive_id, s.id AS negative_id, p.score AS positive_score, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, p.place ORDER BY s.score DESC, s.id) AS r
  FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score
  QUALIFY r <= {NEGATIVES})
SELECT anchor_id, positive_id, CAST(r AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n
"""
