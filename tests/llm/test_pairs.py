"""SimHash groups and vector groups against brute force."""

from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from voxlake.llm import common, line_dedup, mixing, near_text, queries, simhash, vector_forest


def plain_fingerprint(text, width=3):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()]
    grams = [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(items, linked):
    """Smallest id that links reach for each item (id, value)."""
    near_by = [[j for j, (_, b) in enumerate(items) if linked(a, b)] for _, a in items]
    label = list(range(len(items)))
    changed = True
    while changed:
        new = [min([label[i], *(label[j] for j in near_by[i])]) for i in range(len(items))]
        changed, label = new != label, new
    out = []
    for k in label:
        ids = [items[i][0] for i in range(len(items)) if label[i] == k and items[i][0] is not None]
        out.append(min(ids) if ids else None)
    return out


def near(a, b):
    return (a ^ b).bit_count() <= 2


def test_fingerprint_is_the_plain_one():
    for t in (None, "", "  ", "One", "one two", "A b C d e", "é ß A b c \x0b d", "a b c " * 40_000):
        assert simhash.fingerprint(t) == plain_fingerprint(t), t


def test_documents(docs):
    got = simhash.near_duplicates(docs)
    want = [(r.doc_id, plain_fingerprint(r.text)) for r in docs.collect()]
    expected = sorted(zip([i for i, _ in want], [f for _, f in want], groups(want, near), strict=True), key=repr)
    found = sorted(((r.doc_id, r.fp % (1 << 64), r.component_id) for r in got.collect()), key=repr)
    assert found == expected


def test_links_in_dense_groups(spark):
    rng = np.random.default_rng(1)
    center = rng.integers(0, 1 << 63, 6, dtype=np.uint64)
    fps = {0}
    for c in center.tolist():
        for _ in range(150):
            f = c
            for b in rng.integers(0, 64, rng.integers(0, 4)).tolist():
                f ^= 1 << b
            fps.add(f)
    fps |= set(rng.integers(0, 1 << 63, 300, dtype=np.uint64).tolist())
    fps = sorted(fps)
    df = spark.createDataFrame([(f - (1 << 64) if f >= 1 << 63 else f,) for f in fps], "fp long")
    for block in (4096, 16):  # whole buckets, and buckets that are cut into blocks
        comp = common.components(simhash.links(df, block=block))
        found = {r.node % (1 << 64): r.root for r in comp.collect()}
        arr, label = np.array(fps, np.uint64), np.arange(len(fps))
        while True:
            new = np.array([label[np.bitwise_count(arr ^ f) <= 2].min() for f in arr])
            if (new == label).all():
                break
            label = new
        for k in set(label.tolist()):
            own = [fps[i] for i in np.flatnonzero(label == k)]
            if len(own) == 1:
                assert own[0] not in found
            else:
                assert len({found[f] for f in own}) == 1
        assert len({r for r in found.values()}) == sum(1 for k in set(label.tolist()) if (label == k).sum() > 1)


def test_thresholds_add_up():
    cost, chosen = simhash.allot([{-1: 0, 0: 5, 1: 50}, {-1: 0, 0: 1, 1: 9}], 1)
    assert (cost, chosen) == (14, [0, 1])
    both = np.full((64, 64), 10.0)
    assert sorted(b for p in simhash.group_bits(both, 20, 3) for b in p) == list(range(64))


def test_components_of_chains_stars_and_rings(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(0, i) for i in range(1, 50)] + [(200 + i, 200 + (i + 1) % 7) for i in range(7)] + [(300, 300)]
    got = {r.node: r.root for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert 300 not in got
    assert len({got[i] for i in range(100, 161)}) == len({got[i] for i in range(50)}) == len({got[200 + i] for i in range(7)}) == 1
    assert len(set(got.values())) == 3


def test_keep_one(docs, clash, none):
    kept = simhash.keep_one(docs).collect()
    assert sorted((r.doc_id for r in kept if r.doc_id is not None)) == [1, 2, 3, 6, 7, 8, 9, 10]
    assert simhash.keep_one(clash).columns == clash.columns
    assert simhash.keep_one(none).count() == 0
    assert simhash.near_duplicates(none).count() == 0


def test_rows_that_differ_elsewhere(spark):
    """Of equal ids and texts one row stays, the same each time, with all its columns; names of the operator's own columns
    come back as they were."""
    rows = [(1, "a b c d e", lang, {"k": lang}, f"t{lang}", None) for lang in "xyz"] + [(2, "other words are here now", "x", None, "t", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, m map<string,string>, t1 string, `row` int")
    df = df.withColumnsRenamed({"lang": "__t1", "m": "a.b"}).withColumn("k_t1", F.lit("own"))
    for keep in (simhash.keep_one, near_text.keep_one):
        got = [sorted((tuple(r) for r in keep(df.repartition(k)).collect()), key=repr) for k in (1, 3)]
        assert got[0] == got[1] and len(got[0]) == 2 and keep(df).columns == df.columns
        assert got[0][0][2] in "xyz" and got[0][0][4] == "t" + got[0][0][2]
    taken = mixing.take(df.withColumn("source", F.lit("s"))).drop("source")
    assert taken.columns == df.columns and {tuple(map(str, r)) for r in taken.collect()} <= {tuple(map(str, r)) for r in df.collect()}
    out = line_dedup.dedup_lines(df.withColumn("source", F.lit("s")))
    assert out.columns == [*df.columns, "source", "n_lines", "n_removed"] and out.count() == 4


VECS = "vec_id long, embedding array<float>, label int"


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(3)
    out = []
    for i in range(40):
        c = rng.standard_normal(16)
        out += [c + rng.standard_normal(16) * s for s in (0, 0.02, 0.1, 0.3)[: 1 + i % 4]]
    out += [out[0], out[0], out[1] * 3]
    rows = [(i, [float(x) for x in v], 0) for i, v in enumerate(out)]
    rows += [(900, None, 0), (901, [0.0] * 16, 0), (902, [float("nan")] * 16, 0), (903, [None] * 16, 0), (904, [1.0], 0), (905, [], 0), (None, [float(x) for x in out[0]], None), (3, [float(x) for x in out[3]], 1), (906, [float("inf")] + [0.0] * 15, 0)]
    return spark.createDataFrame(rows, VECS)


def plain_vectors(rows, similar=0.95):
    def fine(v):
        return v is not None and len(v) == 16 and all(x is not None and np.isfinite(x) for x in v) and any(v)

    def linked(a, b):
        return fine(a) and fine(b) and np.dot(a, b) / np.linalg.norm(a) / np.linalg.norm(b) >= similar

    items = [(r.vec_id, r.embedding and [x if x is None else float(np.float32(x)) for x in r.embedding]) for r in rows]
    links = [sum(linked(a, b) for j, (_, b) in enumerate(items) if i != j) for i, (_, a) in enumerate(items)]
    comp = groups(items, linked)
    return sorted(((i, n, c, i == c) for (i, _), n, c in zip(items, links, comp, strict=True)), key=repr)


@pytest.mark.parametrize("leaf", [1024, 16])
def test_vectors(vectors, leaf):
    got = vector_forest.near_vectors(vectors, leaf=leaf, trees=6)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain_vectors(vectors.collect())


def test_blocks_of_a_large_leaf(vectors, monkeypatch):
    monkeypatch.setattr(vector_forest, "BLOCK", 24)
    got = vector_forest.near_vectors(vectors)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain_vectors(vectors.collect())


def test_vectors_without_rows(spark):
    assert vector_forest.near_vectors(spark.createDataFrame([], VECS)).count() == 0
    assert vector_forest.near_vectors(spark.createDataFrame([(1, None, 0)], VECS)).collect() == [(1, 0, 1, True)]


def test_recall_on_a_deep_forest(spark):
    rng = np.random.default_rng(9)
    base = rng.standard_normal((3000, 32))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    near_by = base[:1000] + rng.standard_normal((1000, 32)) * 0.25 / np.sqrt(32)
    x = np.vstack([base, near_by]).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], VECS)
    got = vector_forest.near_vectors(df, leaf=64).agg(F.sum("n_links")).first()[0]
    u = x.astype(float)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    want = ((u @ u.T) >= 0.95).sum() - len(u)
    assert want > 500 and 0.95 * want <= got <= want


def test_query_columns(spark):
    out = queries.queries()["op2_simhash_near_dedup"](spark, "/root/testdata/sf0.001")
    assert out.columns[:3] == ["doc_id", "fingerprint", "component_id"]
    assert out.filter(~F.rlike("fingerprint", F.lit("^[0-9a-f]{16}$"))).count() == 0


def test_a_forest_of_several_rounds(spark, monkeypatch):
    """Rounds of two levels on small samples: leaves stay small, and hardly a pair is lost."""
    monkeypatch.setattr(vector_forest, "LEVELS", 2)
    rng = np.random.default_rng(11)
    base = rng.standard_normal((1500, 32))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    same = base[0] + rng.standard_normal((300, 32)) * 0.001  # a group that no direction splits
    x = np.vstack([base, base[:500] + rng.standard_normal((500, 32)) * 0.2 / np.sqrt(32), same])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "cid long, v array<double>")
    grown = lambda: sorted((r.cid, sorted(r.leaves)) for r in vector_forest.grow(df, leaf=16, sample=128).collect())
    first = grown()
    sizes = Counter(leaf for _, leaves in first for leaf in leaves)
    assert len(sizes) > 64 and max(sizes.values()) < 700
    monkeypatch.setattr(vector_forest, "MODELS", 0)  # split points by a join instead
    assert grown() == first
    got = vector_forest.near_vectors(df, "cid", "v", leaf=16, sample=128).agg(F.sum("n_links")).first()[0]
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = ((u @ u.T) >= 0.95).sum() - len(u)
    assert 0.98 * want <= got <= want


def test_pairs_that_share_several_leaves_count_once():
    unit = np.eye(6)[[0, 0, 0, 1, 1, 2]]
    earlier = [np.array(x, int) for x in ([1], [1], [2], [3], [3, 4], [])]
    link = vector_forest._compare(unit, np.zeros(6, int), earlier, False, 0.95)
    assert sorted(map(tuple, np.argwhere(link).tolist())) == [(0, 2), (1, 2), (2, 0), (2, 1)]


def test_dense_groups_are_not_split_apart():
    """20,000 near copies of mutual cosine about 0.955, alone and among as many spread vectors: of the pairs of at
    least 0.95, hardly any shares a leaf of no tree."""
    rng = np.random.default_rng(13)
    noise = np.sqrt(1 / 0.955 - 1) / 8
    dense = rng.standard_normal(64)
    dense = dense / np.linalg.norm(dense) + rng.standard_normal((20_000, 64)) * noise
    spread = rng.standard_normal((20_000, 64))
    half = vector_forest.SPILL * np.sqrt(2 - 2 * vector_forest.SIMILAR) / 8
    for x in (dense, np.vstack([dense, spread])):
        x = x / np.linalg.norm(x, axis=1, keepdims=True)
        pick = x[:1000]
        want = np.triu(pick @ pick.T >= 0.95, 1)
        found = np.zeros_like(want)
        for tree in range(vector_forest.TREES):
            level = x @ vector_forest.directions(tree, 0, 64)
            points = vector_forest.split_points(level[:: max(1, len(x) // vector_forest.SAMPLE)], 6, half)
            row, leaf = vector_forest.descend(level[:1000], points, half)
            member = np.zeros((1000, 64), np.float32)
            member[row, leaf] = 1
            found |= member @ member.T > 0
        assert (found & want).sum() >= 0.995 * want.sum() > 100_000


def test_vectors_of_several_lengths(spark):
    """Each length has its own forest, split or not: equal and similar vectors link at every length."""
    rng = np.random.default_rng(17)
    rows = []
    for dim, n in ((16, 60), (8, 40), (3, 1)):
        for v in rng.standard_normal((n, dim)):
            rows += [(len(rows) + k, (v + rng.standard_normal(dim) * s).tolist(), 0) for k, s in enumerate((0, 0, 0.02))]
    df = spark.createDataFrame(rows, VECS)
    got = vector_forest.near_vectors(df, leaf=16, trees=6).collect()
    kept = [(i, np.array(np.float32(v), float)) for i, v, _ in rows]
    linked = lambda a, b: len(a) == len(b) and a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= 0.95
    links = [sum(linked(a, b) for j, b in kept if i != j) for i, a in kept]
    comp = groups(kept, linked)
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == [(i, n, c) for (i, _), n, c in zip(kept, links, comp, strict=True)]


def test_names_of_vectors(vectors):
    """Columns with the operator's own names change nothing."""
    own = vectors
    for c in ("v", "cid", "n", "leaves", "leaf", "dim", "h1", "good", "links", "component_id"):
        own = own.withColumn(c, F.lit("own"))
    key = lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
    assert key(vector_forest.near_vectors(own)) == key(vector_forest.near_vectors(vectors))
