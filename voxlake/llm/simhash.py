"""Near-duplicate documents by SimHash, linked with the generalised pigeonhole principle.

The 64 fingerprint bits are grouped into parts of correlated bits. Thresholds per part are allotted by
dynamic programming over estimated candidate counts so that they add up to radius - parts + 1; any two
fingerprints within the radius then agree within the threshold in at least one part. Each part's
neighbourhood is probed by masked keys, and every meeting pair is verified on all 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, prepare, rest_key, table, text_key, unpacked, whole

BITS, SEED, RADIUS = 64, 42, 2
#: Shingle hashes that are summed at once, so a very long text needs no memory of its own size.
STEP = 1 << 16
#: Fingerprints of one probe key that are compared in one block; larger buckets are cut into block pairs.
BLOCK = 4096


def fingerprint(text: str | None, width: int = 3) -> int:
    """Unsigned 64-bit SimHash of width-word shingles (ASCII lower case); 0 for a text without words."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
    ends = starts + sizes
    n = max(1, len(words) - width + 1)
    starts, ends = starts[:n], ends[min(width, len(words)) - 1 :][:n]
    total, digest = np.zeros(BITS, np.int64), xxhash.xxh64_intdigest
    for at in range(0, n, STEP):
        pairs = zip(starts[at : at + STEP].tolist(), ends[at : at + STEP].tolist(), strict=True)
        h = np.array([digest(joined[a:b], SEED) for a, b in pairs], dtype="<u8")
        total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * total > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, t1, t2, t3, fp): one row per input row; t1, t2 stand for the whole text, t3 for the other columns;
    fp is signed. Texts may be of any length: a batch's hashes are summed STEP at a time."""
    prepare(docs.sparkSession)
    t = F.coalesce(F.col(text_col), F.lit(""))
    t1, t2 = text_key(t)
    rows = docs.select(F.col(id_col).alias("doc_id"), t1.alias("t1"), t2.alias("t2"), rest_key(docs, id_col, text_col).alias("t3"), t.alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t.as_py()) for t in b.column(4)], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(fp)], ["doc_id", "t1", "t2", "t3", "fp"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, t1 long, t2 long, t3 long, fp long")


def bit_counts(fps: DataFrame) -> np.ndarray:
    """64 x 64: in how many fingerprints both bits are set; summed by Spark, 4,096 numbers reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BITS, BITS))
        for b in batches:
            x = b.column(0).to_numpy().astype("<i8").view(np.uint8).reshape(-1, 8)
            x = np.unpackbits(x, axis=1, bitorder="little").astype(np.float64)
            total += x.T @ x
        at = np.arange(BITS * BITS, dtype=np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total.ravel())], ["at", "n"])

    out = np.zeros(BITS * BITS)
    for r in fps.select("fp").mapInArrow(run, "at int, n double").groupBy("at").agg(F.sum("n").alias("n")).collect():
        out[r["at"]] = r["n"]
    return out.reshape(BITS, BITS)


def group_bits(both: np.ndarray, n: int, parts: int) -> list[list[int]]:
    """Parts of equal width; each starts with the bit most correlated with the rest and takes its closest bits."""
    p = np.diag(both) / max(n, 1)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs((both / max(n, 1) - np.outer(p, p)) / np.outer(sd, sd))
    np.fill_diagonal(corr, 0)
    left, out = list(range(BITS)), []
    for i in range(parts):
        width = (BITS - sum(map(len, out))) // (parts - i)
        part = [max(left, key=lambda b: (corr[b, left].sum(), -b))]
        while len(part) < width:
            part.append(max((b for b in left if b not in part), key=lambda b: (corr[b, part].sum(), -b)))
        left = [b for b in left if b not in part]
        out.append(sorted(part))
    return out


def within(p: np.ndarray, bits: list[int], most: int) -> list[float]:
    """Chance that two independent fingerprints differ in at most 0..most of the given bits."""
    ways = np.zeros(most + 1)
    ways[0] = 1
    for q in 2 * p[bits] * (1 - p[bits]):
        ways[1:] = ways[1:] * (1 - q) + ways[:-1] * q
        ways[0] *= 1 - q
    return list(np.cumsum(ways))


def allot(costs: list[dict[int, float]], total: int) -> tuple[float, list[int]]:
    """Thresholds (one key of each dict, -1 skips the part) that add up to total at the least cost."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for part in costs:
        now: dict[int, tuple[float, list[int]]] = {}
        for s, (cost, chosen) in best.items():
            for t, c in part.items():
                if s + t not in now or cost + c < now[s + t][0]:
                    now[s + t] = (cost + c, [*chosen, t])
        best = now
    return best[total]


def project(bits: list[int]) -> int:
    """Signed mask of the given bits."""
    m = sum(1 << b for b in bits)
    return m - (1 << 64) if m >= 1 << 63 else m


def plan(fps: DataFrame, radius: int = RADIUS) -> list[tuple[list[int], int]]:
    """[(bits, threshold)] of the parts to probe: for 2 to radius + 1 parts, the cheapest allotment."""
    n = fps.count()
    both = bit_counts(fps)
    p = np.diag(both) / max(n, 1)
    choices = [group_bits(both, n, m) for m in range(2, radius + 2)]
    masks = sorted({project(b) for parts in choices for b in parts})
    seen = fps.select(F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col("fp").bitwiseAND(F.lit(m)).alias("v")) for i, m in enumerate(masks)])).alias("x"))
    seen = seen.groupBy("x").count().groupBy(F.col("x.i").alias("i")).agg(F.sum(F.expr("cast(count as double) * (count - 1) / 2")).alias("pairs"))
    equal = {masks[r["i"]]: r["pairs"] for r in seen.collect()}
    best: tuple[float, list] = (float("inf"), [])
    for parts in choices:
        costs = []
        for bits in parts:
            near, w = within(p, bits, radius), len(bits)
            keys = [1, w, w * (w - 1) / 2]
            cost, probes = {-1: 0.0}, 0.0
            for t in range(radius + 1):
                probes += keys[t] if t < 3 else float("inf")
                cost[t] = max(equal.get(project(bits), 0), 1) * near[t] / max(near[0], 1e-300) + n * probes
            costs.append(cost)
        cost, chosen = allot(costs, radius - len(parts) + 1)
        if cost < best[0]:
            best = (cost, list(zip(parts, chosen, strict=True)))
    return [(bits, t) for bits, t in best[1] if t >= 0]


def pairs_in(fps: np.ndarray, other: np.ndarray | None, part: int, cleared: int, radius: int) -> list[tuple[int, int]]:
    """Links between fps (or fps and other) whose difference within the part is exactly the cleared bits; a
    spanning forest of them, never all pairs."""
    nodes = fps if other is None else np.concatenate([fps, other])
    parent = list(range(len(nodes)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out, shift = [], 0 if other is None else len(fps)
    right = nodes[shift:]
    for i, f in enumerate(fps):
        x = np.bitwise_xor(right[i + 1 :] if other is None else right, f)
        ok = (np.bitwise_count(x) <= radius) & ((x & np.uint64(part)) == np.uint64(cleared))
        for j in np.flatnonzero(ok).tolist():
            k = j + i + 1 if other is None else j + shift
            a, b = root(i), root(k)
            if a != b:
                parent[b] = a
                out.append((i, k))
    v = nodes.view(np.int64)
    return [(int(v[a]), int(v[b])) for a, b in out]


def links(fps: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """(a, b): links between distinct fingerprints (column fp) that join exactly the fingerprints within
    the radius. A bucket of two gives its pair by min and max; larger ones are compared in blocks of bounded
    size, and a bucket of many blocks is dealt out as pairs of blocks."""
    probes = []
    for bits, t in plan(fps, radius):
        part = sum(1 << b for b in bits)
        for size in range(t + 1):
            probes += [(part, sum(1 << b for b in c)) for c in combinations(bits, size)]
    signed = lambda m: m - (1 << 64) if m >= 1 << 63 else m
    keys = F.array(*[F.struct(F.lit(i).alias("i"), F.col("fp").bitwiseAND(F.lit(signed(p & ~c))).alias("v")) for i, (p, c) in enumerate(probes)])
    met = fps.select("fp", F.explode(keys).alias("k")).select("fp", "k.i", "k.v")
    sizes = table(met.groupBy("i", "v").agg(F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b")).filter("n > 1"), "buckets")
    part_of = F.element_at(F.array(*[F.lit(signed(p)) for p, _ in probes]), F.col("i") + 1)
    cleared_of = F.element_at(F.array(*[F.lit(signed(c)) for _, c in probes]), F.col("i") + 1)
    x = F.col("a").bitwiseXOR(F.col("b"))
    twos = sizes.filter((F.col("n") == 2) & (F.bit_count(x) <= radius) & (x.bitwiseAND(part_of) == cleared_of)).select("a", "b")

    many = met.join(sizes.filter("n > 2").select("i", "v", F.expr(f"cast(ceil(n / {block}) as int)").alias("blocks")), ["i", "v"])
    many = many.withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    many = many.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    many = many.select("i", "v", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), "own", "fp")
    many = many.groupBy("i", "v", "p", "q").agg(F.collect_list(F.struct("own", "fp")).alias("rows"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = []
            own = b.column("rows")
            for k, (i, p, q) in enumerate(zip(*(b.column(c).to_pylist() for c in ("i", "p", "q")), strict=True)):
                rows = own[k].values
                side = rows.field("own").to_numpy()
                fp = rows.field("fp").to_numpy().view(np.uint64)
                found += pairs_in(fp[side == p], None if p == q else fp[side == q], *probes[i], radius)
            a, c = zip(*found, strict=True) if found else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(c, pa.int64())], ["a", "b"])

    return twos.union(many.mapInArrow(run, "a long, b long"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """(doc_id, t1, t2, t3, fp, root, component_id) for every input row.

    Rows whose fingerprints differ in at most radius bits are linked; component_id is the smallest doc_id that
    links reach (null doc_ids do not count; null only if the whole component has none). Null and empty texts
    and texts without words have fingerprint 0. Repeated rows are returned as often as they come; an empty
    table gives an empty result. Other columns of docs are not touched.
    """
    rows = table(fingerprints(docs, id_col, text_col), "fingerprints")
    own = table(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    comp = components(links(own.select("fp"), radius)).select(F.col("node").alias("fp"), "root")
    own = own.join(comp, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "least")
    best = own.groupBy("root").agg(F.min("least").alias("component_id"))
    return rows.join(own.join(best, "root").select("fp", "root", "component_id"), "fp").select("doc_id", "t1", "t2", "t3", "fp", "root", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs without near duplicates: of each group the row of smallest id (nulls last) stays."""
    found = near_duplicates(docs, id_col, text_col).groupBy("root").agg(F.min(F.expr(FIRST)).alias("k"))
    return first_of(docs, found, id_col, text_col)


#: The order of rows in a group: by id, nulls last, then by hashes of text and other columns. Needs no session.
FIRST = "struct(doc_id is null as none, doc_id, t1, t2, t3)"


def first_of(docs: DataFrame, found: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of docs that are the first of a group; found has k, FIRST of the first row of every group. Of rows
    repeated in full one stays. All columns of docs, whatever their names, come back as they are."""
    kept = found.select(*[F.col(f"k.{c}").alias(f"k_{c}") for c in ("doc_id", "t1", "t2", "t3")])
    t1, t2 = text_key(F.coalesce(F.col(text_col), F.lit("")))
    mine = docs.select(whole(docs), F.col(id_col).alias("doc_id"), t1.alias("t1"), t2.alias("t2"), rest_key(docs, id_col, text_col).alias("t3"))
    mine = mine.join(kept, F.expr("t1 = k_t1 and t2 = k_t2 and t3 = k_t3 and doc_id <=> k_doc_id"), "left_semi")
    return mine.dropDuplicates(["t1", "t2", "t3", "doc_id"]).select(*unpacked(docs.columns))
