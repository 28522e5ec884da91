"""Near-duplicate vectors by a forest of random-projection trees.

Each tree splits the vectors again and again by a random direction at the median; vectors close to the
split go down both sides (spill), so that near pairs seldom part. Vectors are compared within the leaves of
all trees, every pair is verified by its exact cosine, and links found in any tree are united. Vectors that
are equal are one class from the start and are never compared with each other.

Trees grow in rounds of up to LEVELS levels. In each round the split points of every leaf that is still too
large are fitted by a task of its own, on a sample of bounded size, so leaves stay small at any number of
vectors. All nodes of one level of a tree share their direction. A round is a map over the vectors with their
leaves; they are shuffled once, to the leaves' comparison.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, drop, prepare, table

#: Classes that the split points of one leaf are fitted on, about.
SAMPLE = 8_192
#: Trees, and the size that leaves are split to. Copies of a vector grow with the spill at every level, so many
#: trees with little spill cost less in deep forests than few trees with much.
TREES, LEAF = 6, 1024
#: Half the width of the spill, in standard deviations of a just similar pair's difference along a random direction.
SPILL = 0.4
SIMILAR = 0.95
#: Vectors compared in one block; larger leaves are dealt out as pairs of blocks.
BLOCK = 2048
SEED = 5
#: Levels of a round, and rounds that a leaf's number has room for.
LEVELS, ROUNDS = 8, 7
#: Leaves whose split points are broadcast in a round (2 kB each); where a round splits more, rows meet them by a join.
MODELS = 4096
#: Quantiles that a node may be split at, in order of choice, and the share of a node that a side may hold.
CUTS, SIDE = (0.5, 0.4, 0.6, 0.3, 0.7, 0.2, 0.8), 0.8
#: Share of a node that may lie within the spill of its split. More lies there where the vectors are not spread far
#: wider than the spill; splits of such a dense group part many near pairs, so it is compared in blocks instead.
WITHIN = 0.2


def directions(leaf: int, turn: int, dim: int) -> np.ndarray:
    """Unit directions (as columns) of the levels below a leaf of the given round; leaf >> LEVELS * turn is its tree."""
    d = np.random.default_rng([SEED, leaf >> LEVELS * turn, turn]).standard_normal((dim, LEVELS))
    return d / np.linalg.norm(d, axis=0)


def split_points(x: np.ndarray, depth: int, spill: float) -> np.ndarray:
    """Split points of the nodes of a subtree in heap order, from a sample's projections (row, level). A node
    has NaN, and isn't split at that level, where a side would be nearly as large as itself or too many rows
    would go down both sides."""
    points, at = np.full((1 << depth) - 1, np.nan), {0: np.arange(len(x))}
    for node in range(len(points)):
        own = at.pop(node)
        own_x = x[own, (node + 1).bit_length() - 1]
        for c in np.quantile(own_x, CUTS) if len(own) else ():
            left, right = (own_x <= c + spill).sum(), (own_x > c - spill).sum()
            if max(left, right) <= SIDE * len(own) and left + right <= (1 + WITHIN) * len(own):
                points[node] = c
                break
        right = own_x > points[node]  # never where the point is NaN
        at[2 * node + 1], at[2 * node + 2] = own[~right], own[right]
    return points


def descend(x: np.ndarray, points: np.ndarray, spill: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, leaf of the subtree) of every leaf that the rows reach, from their projections (row, level)."""
    at, node = np.arange(len(x)), np.zeros(len(x), np.int64)
    depth = len(points).bit_length()
    for level in range(depth):
        off = x[at, level] - points[node]
        left, right = ~(off > spill), off > -spill
        at, node = np.concatenate([at[left], at[right]]), np.concatenate([2 * node[left] + 1, 2 * node[right] + 2])
    return at, node - len(points)


def grow_below(at: DataFrame, turn: int, half: float, leaf: int, sample: int) -> DataFrame | None:
    """at (cid, v, leaves and what else it has) after splitting all leaves that are too large; None if there is nothing to split. half is
    half the spill's width times the square root of the dimension. A round reads and writes at once, side by side:
    vectors are shuffled only for the samples."""
    one = at.select("cid", "v", F.size("v").alias("dim"), F.explode("leaves").alias("leaf"))
    large = table(one.groupBy("dim", "leaf").agg(F.count("*").alias("size")).filter(F.col("size") > max(4 * leaf, 1)), "large-leaves")

    def fit(t: pa.Table) -> pa.Table:
        number, size = t.column("leaf")[0].as_py(), t.column("size")[0].as_py()
        unit = _matrix(t.column("v").combine_chunks())
        depth = min(LEVELS, int(np.ceil(np.log2(size / leaf))))
        points = split_points(unit @ directions(number, turn, unit.shape[1]), depth, half / np.sqrt(unit.shape[1]))
        found = [] if np.isnan(points).all() else [points]
        return pa.table({"dim": pa.array([unit.shape[1]][: len(found)], pa.int32()), "leaf": pa.array([number][: len(found)], pa.int64()), "points": pa.array(found, pa.list_(pa.float64()))})

    some = one.join(large, ["dim", "leaf"]).filter(F.pmod(F.xxhash64("cid", "leaf"), F.col("size")) < sample)
    model = table(some.select("dim", "leaf", "size", "v").groupBy("dim", "leaf").applyInArrow(fit, "dim int, leaf long, points array<double>"), "split-points")
    n = model.count()
    if not n:
        return None
    shared = at.sparkSession.sparkContext.broadcast({(r["dim"], r["leaf"]): np.array(r["points"]) for r in model.collect()} if n <= MODELS else {})

    def split(vectors: pa.ListArray, row: np.ndarray, leaves: np.ndarray, points: dict[tuple[int, int], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) of the next round for pairs of a row of vectors and a leaf."""
        rows, out = [], []
        dim = pc.list_value_length(vectors).to_numpy()[row]
        for d, k in np.unique(np.stack([dim, leaves], axis=1), axis=0).tolist():
            mine = row[(dim == d) & (leaves == k)]
            if (d, k) in points:
                unit = _matrix(vectors.take(pa.array(mine)))
                at, child = descend(unit @ directions(k, turn, d), points[d, k], half / np.sqrt(d))
            else:
                at, child = np.arange(len(mine)), 0
            rows.append(mine[at])
            out.append((k << LEVELS) + child + np.zeros(len(at), np.int64))
        return (np.concatenate(rows), np.concatenate(out)) if rows else (np.zeros(0, np.int64),) * 2

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v, leaves = b.column("v"), b.column("leaves")
            row = np.repeat(np.arange(len(b)), pc.list_value_length(leaves).to_numpy())
            row, out = split(v, row, leaves.flatten().to_numpy(), shared.value)
            order = np.argsort(row, kind="stable")
            ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(b)))]).astype(np.int32)
            yield b.set_column(b.schema.get_field_index("leaves"), "leaves", pa.ListArray.from_arrays(pa.array(ends), pa.array(out[order])))

    def single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            points = {(d, k): p.values.to_numpy() for d, k, p in zip(b.column("dim").to_pylist(), b.column("leaf").to_pylist(), b.column("points"), strict=True) if p.is_valid}
            row, out = split(b.column("v"), np.arange(len(b)), b.column("leaf").to_numpy(), points)
            yield pa.RecordBatch.from_arrays([b.column("cid").take(pa.array(row)), pa.array(out)], ["cid", "leaf"])

    if n <= MODELS:
        below = at.mapInArrow(lists, at.schema)
    else:
        new = one.join(model, ["dim", "leaf"], "left").mapInArrow(single, "cid long, leaf long")
        below = at.drop("leaves").join(new.groupBy("cid").agg(F.collect_list("leaf").alias("leaves")), "cid")
    return table(below, "leaves")


def grow(own: DataFrame, similar: float = SIMILAR, trees: int = TREES, leaf: int = LEAF, spill: float = SPILL, sample: int = SAMPLE) -> DataFrame:
    """own (cid, v and what else it has) with `leaves`: all leaves of all trees that each row reaches. Vectors of each length have trees of
    their own, whose leaves are numbered alike."""
    at = table(own.withColumn("leaves", F.sequence(F.lit(0).cast("long"), F.lit(trees - 1).cast("long"))), "leaves")
    for turn in range(ROUNDS):
        below = grow_below(at, turn, spill * np.sqrt(2 - 2 * similar), leaf, sample)
        if below is None:
            break
        drop(at)
        at = below
    return at


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    x = flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)
    big = np.abs(x).max(axis=1, keepdims=True) if len(x) else 1.0
    x = x / big
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _compare(unit: np.ndarray, side: np.ndarray, earlier: list, mixed: bool, similar: float) -> np.ndarray:
    """Boolean links of one block or pair of blocks: similar pairs that share none of the leaves before this one."""
    link = unit @ unit.T >= similar
    np.fill_diagonal(link, False)
    if mixed:
        link &= side[:, None] != side[None, :]
    rows = np.flatnonzero(link.any(axis=1))  # the others have no pair that could be counted twice
    if len(rows):
        size = np.fromiter((len(earlier[r]) for r in rows), np.int64, len(rows))
        flat, owner = np.concatenate([earlier[r] for r in rows]), np.repeat(np.arange(len(rows)), size)
        _, column, count = np.unique(flat, return_inverse=True, return_counts=True)
        column, owner = np.unique(column[count[column] > 1], return_inverse=True)[1], owner[count[column] > 1]
        shared = np.zeros((len(rows), len(rows)), bool)
        for at in range(0, int(column.max(initial=-1)) + 1, BLOCK):  # so many earlier leaves at once
            now = (column >= at) & (column < at + BLOCK)
            member = np.zeros((len(rows), BLOCK), np.float32)
            member[owner[now], column[now] - at] = 1
            shared |= member @ member.T > 0
        link[np.ix_(rows, rows)] &= ~shared
    return link


def _forest_of(link: np.ndarray) -> np.ndarray:
    """For each row the smallest row that links reach within the block."""
    label = np.arange(len(link))
    while True:
        near = np.where(link, label[None, :], len(link)).min(axis=1, initial=len(link))
        new = np.minimum(label, near)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", similar: float = SIMILAR, **forest) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every input row.

    Two rows are linked if the forest meets them and their cosine in double precision is at least `similar`.
    n_links counts other rows that are linked directly, component_id is the smallest id that links reach, kept
    says that the id is that one. Null or zero vectors and vectors with null, NaN or infinite components have
    no links; vectors of different lengths are not linked. Repeated rows link with each other. Vectors may be of any
    length; other columns, of any name, are not looked at. An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    prepare(spark)
    kind = "float" if vectors.schema[vec_col].dataType.simpleString() == "array<float>" else "double"  # as narrow as they come
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.transform(F.col(vec_col), lambda x: F.when(x == 0, F.lit(0)).otherwise(x).cast(kind)).alias("v"))
    fine = F.coalesce(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0), F.lit(False))
    rows = rows.withColumn("good", fine)
    rows = rows.withColumns({"h1": F.when(F.col("good"), F.xxhash64("v")), "h2": F.when(F.col("good"), F.xxhash64(F.lit(7919), "v"))})
    ids = table(rows.select("vec_id", "h1", "h2"), "vectors")
    own = rows.filter("good").groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min("vec_id").alias("least"), F.any_value("v").alias("v"))
    own = table(own.withColumn("cid", F.monotonically_increasing_id()), "classes")
    leaves = grow(own.select("cid", "n", "v"), similar, **forest)
    met = leaves.select("cid", "n", "v", "leaves", F.size("v").alias("dim"), F.explode("leaves").alias("leaf"))
    # only the leaves of several blocks are looked up: few, so vectors need not be shuffled for it
    sizes = met.groupBy("dim", "leaf").count().filter(F.col("count") > BLOCK)
    sizes = table(sizes.select("dim", "leaf", F.expr(f"cast(ceil(count / {BLOCK}) as int)").alias("blocks")), "block-counts")
    met = met.join(sizes, ["dim", "leaf"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    met = met.withColumn("own", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    met = met.select("dim", "leaf", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), "own", "cid", "n", "v", F.expr("filter(leaves, x -> x < leaf)").alias("earlier"))
    met = met.repartition("dim", "leaf", "p", "q").sortWithinPartitions("dim", "leaf", "p", "q")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now = [], None

        def flush() -> pa.RecordBatch:
            t = pa.Table.from_batches(held).combine_chunks()
            cid, n = t.column("cid").to_numpy(), t.column("n").to_numpy()
            *_, p, q = now
            link = _compare(_matrix(t.column("v").combine_chunks()), t.column("own").to_numpy(), [x.values.to_numpy() for x in t.column("earlier")], p != q, similar)
            links = link @ n
            root = _forest_of(link)
            some = np.flatnonzero(links)
            return pa.RecordBatch.from_arrays([pa.array(cid[some]), pa.array(cid[root[some]]), pa.array(links[some].astype(np.int64))], ["cid", "to", "links"])

        for b in batches:
            keys = np.stack([b.column(c).to_numpy() for c in ("dim", "leaf", "p", "q")], axis=1) if b.num_rows else np.zeros((0, 4), int)
            cuts = [0, *(np.flatnonzero((np.diff(keys, axis=0) != 0).any(axis=1)) + 1).tolist(), b.num_rows]
            for a, z in zip(cuts, cuts[1:], strict=False):
                if z > a:
                    key = tuple(keys[a].tolist())
                    if held and key != now:
                        yield flush()
                        held = []
                    now = key
                    held.append(b.slice(a, z - a))
        if held:
            yield flush()

    found = table(met.mapInArrow(compare, "cid long, to long, links long"), "links")
    comp = components(found.select(F.col("cid").alias("a"), F.col("to").alias("b"))).select(F.col("node").alias("cid"), "root")
    own = own.select("h1", "h2", "n", "least", "cid").join(found.groupBy("cid").agg(F.sum("links").alias("links")), "cid", "left").join(comp, "cid", "left")
    own = own.withColumn("root", F.coalesce("root", "cid")).withColumn("links", F.coalesce("links", F.lit(0)) + F.col("n") - 1)
    own = table(own, "linked")
    best = own.groupBy("root").agg(F.min("least").alias("component_id"))
    own = own.join(best, "root").select(F.col("h1").alias("g1"), F.col("h2").alias("g2"), "links", "component_id")
    out = ids.join(own, F.expr("h1 = g1 and h2 = g2"), "left")
    comp = F.when(F.col("g1").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), comp.alias("component_id"), F.col("vec_id").eqNullSafe(comp).alias("kept"))


#: All pairs. A table of at most 4 * LEAF different vectors is one leaf of each tree, so the forest then meets them all.
SQL = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
fine AS (
  SELECT vec_id, e FROM v
  WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM fine a JOIN fine b ON a.vec_id <> b.vec_id
  WHERE len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= {SIMILAR}),
reach AS (
  SELECT vec_id AS a, vec_id AS b FROM v
  UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
degree AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
FROM v JOIN least ON least.a = vec_id LEFT JOIN degree ON degree.a = vec_id
"""
