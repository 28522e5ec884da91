"""Groups that outgrow one task: ranges with seams, and places by counted offsets."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from voxlake.operators import curation, ranges, segments, signal, spatial, vectors
from voxlake.operators.ranking import placed

TURN = "recording long, speaker string, start_time double, end_time double, duration double, seq long"


def hot_turns(n, seed=1):
    """A hot recording with long runs of one speaker, bursts, ties of start and gaps; a few small ones; rows out of order."""
    rng = np.random.default_rng(seed)
    start = np.round(np.cumsum(rng.choice([0.0, 0.2, 0.5, 40.0], n, p=[0.1, 0.5, 0.39, 0.01])), 2)
    speaker = np.repeat(["A", "B", "A", "C"], -(-n // 4))[:n]
    speaker = np.where(rng.random(n) < 0.2, rng.choice(["A", "B"], n), speaker)
    x = pd.DataFrame({"recording": np.where(rng.random(n) < 0.95, 1, rng.integers(2, 9, n)), "speaker": speaker, "start_time": start, "duration": np.round(rng.random(n) * 2 - 0.2, 2), "seq": np.arange(n)})
    x.insert(3, "end_time", (x.start_time + x.duration).round(2))
    return x[["recording", "speaker", "start_time", "end_time", "duration", "seq"]].sample(frac=1, random_state=2)


def plain_merge(x, gap):
    out = []
    for rec, speaker, start, end, _, seq in x.sort_values(["recording", "start_time", "seq"]).itertuples(index=False):
        if out and out[-1][0] == rec and out[-1][1] == speaker and start - out[-1][3] <= gap:
            out[-1][3:] = [end, min(out[-1][4], seq), out[-1][5] + 1]
        else:
            out.append([rec, speaker, start, end, seq, 1])
    return sorted(map(tuple, out))


@pytest.mark.parametrize("size", [1, 7, 200, 10**6])
def test_turns_over_seams(spark, monkeypatch, size):
    monkeypatch.setattr(ranges, "SIZE", size)
    x = hot_turns(3000)
    t = spark.createDataFrame(x, TURN)
    got = segments.merge_turns(t, 0.3).select("recording", "speaker", "start_time", "end_time", "seq", "turns")
    assert sorted(map(tuple, got.collect())) == plain_merge(x, 0.3)
    kept, again = (segments.number(segments.merge_turns(t, 0.3, ranged=r)) for r in (True, False))
    assert kept.columns == again.columns and sorted(map(tuple, kept.collect())) == sorted(map(tuple, again.collect()))
    y = x.sort_values(["recording", "start_time", "seq"])
    gap = (y.start_time - y.groupby("recording").end_time.shift()).where(y.recording.eq(y.recording.shift()))
    got = segments.gap_timeline(t).select("seq", "gap").toPandas().set_index("seq").gap
    assert np.allclose(got.loc[y.seq].to_numpy(), gap.to_numpy(), equal_nan=True)
    place = y.groupby("recording").cumcount() + 1
    got = segments.number(t).select("seq", "ordinal").toPandas().set_index("seq").ordinal
    assert (got.loc[y.seq].to_numpy() == place.to_numpy()).all()


def test_a_hot_recording_is_spread(spark):
    """1,000,000 turns of one recording: no task of the ordered work holds more than a few thousand."""
    t = spark.range(1_000_000).select(F.lit(1).alias("recording"), F.when(F.col("id") % 10 < 9, "A").otherwise("B").alias("speaker"), (F.col("id") * 2.0).alias("start_time"), (F.col("id") * 2.0 + 1.5).alias("end_time"), F.lit(1.5).alias("duration"), F.col("id").alias("seq"))
    sizes = ranges.in_ranges(t, "recording", "start_time").groupBy(ranges.RANGE).count().agg(F.max("count"), F.count("*")).first()
    assert sizes[0] < 2 * ranges.SIZE and sizes[1] > 200
    m = segments.merge_turns(t)
    assert m.count() == 200_000 and m.agg(F.sum("turns")).first()[0] == 1_000_000


@pytest.mark.parametrize("size", [1, 5, 64, 10**6])
def test_silence_over_seams(spark, monkeypatch, size):
    monkeypatch.setattr(ranges, "SIZE", size)
    rng = np.random.default_rng(size)
    value = np.repeat(rng.integers(0, 2, 400), rng.integers(1, 30, 400)) * 10
    rows = [(1, 3 * i, int(v)) for i, v in enumerate(value)] + [(2, 5, 0), (2, 9, 0), (3, 1, 10), (4, 1, None), (4, 2, 0)]
    s = spark.createDataFrame(rows, "clip long, at long, value long").repartition(3)
    want = []
    for clip in (1, 2, 3, 4):
        v = [x for c, _, x in rows if c == clip]
        at = 0
        while at < len(v):
            to = at
            while to < len(v) and v[to] is not None and v[to] < 1:
                to += 1
            if to - at >= 2:
                want.append((clip, at, to, to - at, at == 0, to == len(v)))
            at = max(to, at + 1)
    assert sorted(map(tuple, signal.silence_islands(s, 1, 2).collect())) == want


def test_places(spark):
    """Against windows: groups of a third of all rows and of one, a null group, ties."""
    x = spark.range(3000).select(F.when(F.col("id") % 3 > 0, F.col("id") % 3).when(F.col("id") % 2 == 0, F.col("id")).alias("grp"), (F.xxhash64("id") % 500).alias("x"), "id")
    got = placed(x, [F.col("x").desc(), "id"], ["grp"], "n", "of").toPandas().sort_values("id")
    want = x.toPandas().sort_values(["x", "id"], ascending=[False, True])
    want["n"] = want.groupby("grp", dropna=False).cumcount()
    want["of"] = want.groupby("grp", dropna=False)["id"].transform("size")
    want = want.sort_values("id")
    assert (got.n.to_numpy() == want.n.to_numpy()).all() and (got.of.to_numpy() == want.of.to_numpy()).all()
    whole = placed(x, ["id"]).agg(F.max("place"), F.count_distinct("place")).first()
    assert tuple(whole) == (2999, 3000) and placed(x.limit(0), ["id"], ["grp"]).count() == 0
    ties = placed(x.withColumn("same", F.lit(1)), ["same"], ["grp"])
    assert ties.groupBy("grp").agg((F.max("place") + 1 - F.count_distinct("place")).alias("d")).filter("d <> 0").count() == 0


@pytest.mark.parametrize("n", [0, 3, 7, 10, 100])
def test_even_parts(spark, n):
    x = spark.range(n).select("id", F.lit("s").alias("source"))
    sizes = [r["count"] for r in curation.even_partition(x, 7, "id", "source").groupBy("part").count().orderBy("part").collect()]
    assert sizes == [s for s in (n // 7 + (k < n % 7) for k in range(7)) if s]
    assert curation.whole_batches(x, 8, "id", "source").count() == n // 8 * 8


def test_no_window_over_few_groups(spark):
    """Lists are ranked by ranges, so the plan has no window that gathers a source."""
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", F.col("source"), F.col("source").alias("grp"), F.col("doc_id").alias("item"))
    for out in (curation.even_partition(d, 7, "doc_id", "source"), curation.round_robin(d, 4, 3, "doc_id", "source"), curation.whole_batches(d, 8, "doc_id", "source"), curation.random_pairing(d, d, 3)):
        assert "Window" not in out._jdf.queryExecution().executedPlan().toString()


def test_natural_order(spark):
    names = ["b/f_10.png", "b/f_9.png", "b/f_009.png", "a/cover.png", "a/f_2.png", "a/f_" + "9" * 30 + ".png"]
    x = spark.createDataFrame([(n, n[0]) for n in names], "path string, folder string")
    got = [(r.path, r.place) for r in curation.natural_order(x).orderBy("folder", "place").collect()]
    assert got == [("a/cover.png", 1), ("a/f_2.png", 2), (names[-1], 3), ("b/f_009.png", 1), ("b/f_9.png", 2), ("b/f_10.png", 3)]


def plain_suppress(rows, most, before, after):
    out = []
    for image in {r[0] for r in rows}:
        kept = []
        for r in sorted((r for r in rows if r[0] == image and r[2] > 0.05), key=lambda r: (-r[2], r[1]))[:before]:
            area = lambda b: (b[5] - b[3]) * (b[6] - b[4])
            both = lambda a, b: max(0, min(a[5], b[5]) - max(a[3], b[3])) * max(0, min(a[6], b[6]) - max(a[4], b[4]))
            if len(kept) < after and all(both(k, r) / (area(k) + area(r) - both(k, r)) <= most for k in kept):
                kept.append(r)
        out += [r[:3] for r in kept]
    return sorted(out)


@pytest.mark.parametrize("before, after, batch", [(5000, 750, 10_000), (100, 20, 16), (10, 3, 7)])
def test_suppression_of_a_hot_image(spark, before, after, batch):
    rng = np.random.default_rng(4)
    rows = []
    for k in range(900):
        image, x, y, w, h = (1 if k % 3 else int(rng.integers(2, 40))), *rng.integers(0, 300, 2).tolist(), *rng.integers(20, 90, 2).tolist()
        rows.append((image, k, round(float(rng.random()), 2), float(x), float(y), float(x + w), float(y + h)))
    b = spark.createDataFrame(rows, "image long, box long, score double, x1 double, y1 double, x2 double, y2 double").repartition(5)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = spatial.suppress(b, 0.3, before, after)
        assert sorted(map(tuple, got.collect())) == plain_suppress(rows, 0.3, before, after)
        left = spatial.best_of_tasks(b, before, "image", [F.col("score").desc(), "box"]).withColumn("task", F.spark_partition_id())
        assert left.groupBy("image", "task").count().agg(F.max("count")).first()[0] <= before and left.count() >= min(before, 600)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def plain_clusters(points, tolerance):
    sums, out = [], []
    for x, y in points:
        k = next((i for i, (a, b, n) in enumerate(sums) if ((a / n - x) ** 2 + (b / n - y) ** 2) ** 0.5 < tolerance), len(sums))
        sums = [*sums, (0, 0, 0)] if k == len(sums) else sums
        a, b, n = sums[k]
        sums[k] = a + x, b + y, n + 1
        out.append(k)
    return out


@pytest.mark.parametrize("tolerance, width", [(10.0, 60), (10.0, 2000), (0.5, 3), (0.0, 5)])
def test_clusters_on_the_grid(spark, tolerance, width):
    """Few clusters that drift and many that do not; the first that is near wins, not the nearest."""
    points = np.round(np.random.default_rng(8).random((1500, 2)) * width - width / 3, 1)
    df = spark.createDataFrame([(1, i, i, float(x), float(y)) for i, (x, y) in enumerate(points)], "recording long, frame long, det long, center_x double, center_y double")
    got = [r.cluster for r in spatial.leader_clusters(df.repartition(3), tolerance).orderBy("det").collect()]
    assert got == plain_clusters(points.tolist(), tolerance)


def test_many_clusters_cost_what_few_do(spark):
    """30,000 faces each: 10 clusters, and about 20,000."""
    from time import time

    took = []
    for width in (30, 3000, 30):
        x = spark.range(30_000).select(F.lit(1).alias("recording"), F.col("id").alias("frame"), F.col("id").alias("det"), (F.rand(1) * width).alias("center_x"), (F.rand(2) * width).alias("center_y"))
        began = time()
        n = spatial.leader_clusters(x, 10.0).agg(F.count_distinct("cluster")).first()[0]
        took.append((n, time() - began))
    assert took[1][0] > 1000 * took[2][0] / 20 and took[1][1] < 5 * took[2][1] + 2


MOMENTS = "vec array<double>"


def test_moments_far_from_zero(spark):
    rng = np.random.default_rng(6)
    x = rng.standard_normal((1000, 3)) @ rng.standard_normal((3, 3)) + [1e8, -1e8, 5.0]
    df = spark.createDataFrame([(v.tolist(),) for v in x] + [(None,)], MOMENTS).repartition(7)
    want = np.cov(x.T, bias=True)
    for stats in (vectors.feature_sums(df), vectors.merge_sums(vectors.feature_sums(df.limit(400)).union(vectors.feature_sums(df.limit(0))).union(vectors.feature_sums(df.limit(400))))):
        assert stats.count() == 1
    rows = vectors.mean_cov(vectors.feature_sums(df)).collect()
    assert len(rows) == 6 and all(r.n == 1000 and r.cov == pytest.approx(want[r.i, r.j], abs=1e-6) for r in rows)
    assert vectors.frechet_distance(df, df.filter("vec is not null").select(F.transform("vec", lambda c: c + 1).alias("vec"))) == pytest.approx(3, abs=1e-4)


def test_stored_halves_merge_to_the_whole(spark, tmp_path):
    x = np.random.default_rng(7).standard_normal((500, 4)) + 1e8
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], f"id long, {MOMENTS}")
    for k in (0, 1):
        vectors.feature_sums(df.filter(F.col("id") % 2 == k)).write.mode("append").parquet(str(tmp_path / "stats"))
    stored = spark.read.parquet(str(tmp_path / "stats"))
    assert stored.count() == 2
    both, whole = (vectors.mean_cov(s, sample=True).orderBy("i", "j").toPandas() for s in (vectors.merge_sums(stored), vectors.feature_sums(df)))
    assert (both.n == 500).all() and np.allclose(both["cov"], whole["cov"], atol=1e-9, rtol=0) and np.allclose(both.mean_i, whole.mean_i, rtol=1e-15)
    assert vectors.frechet_distance(stored, df) == pytest.approx(0, abs=1e-4)
    assert vectors.feature_sums(df.limit(0)).count() == 0


@pytest.mark.parametrize("tile, most", [(40.0, 0.3), (100.0, 0.05), (10_000.0, 0.5)])
def test_suppression_in_tiles(spark, tile, most):
    """Chains of boxes over many tiles, large boxes, negative places, ties, images of one box and without sides."""
    rng = np.random.default_rng(9)
    rows = []
    for k in range(1200):
        image, x, y = int(rng.integers(0, 3)), *(rng.integers(-400, 600, 2)).tolist()
        w, h = (rng.integers(150, 400, 2) if k % 50 == 0 else rng.integers(10, 60, 2)).tolist()
        rows.append((image, k, round(float(rng.random()), 1), float(x), float(y), float(x + w), float(y + h)))
    rows += [(1, 5000 + k, 0.9 - k / 1000, 10.0 * k, 0.0, 10.0 * k + 24, 24.0) for k in range(100)]  # each depends on the one before
    rows += [(7, 1, 0.5, 0.0, 0.0, 1.0, 1.0), (8, 1, 0.01, 0.0, 0.0, 1.0, 1.0)]
    kind = "image long, box long, score double, x1 double, y1 double, x2 double, y2 double"
    b = spark.createDataFrame(rows, kind).repartition(5)
    assert sorted(map(tuple, spatial.suppress_tiles(b, most, tile=tile).collect())) == plain_suppress(rows, most, None, 10**9)
    best = spatial.suppress_tiles(b, most, after=20, tile=tile)
    assert sorted(map(tuple, best.collect())) == plain_suppress(rows, most, None, 20)
    odd = spark.createDataFrame([(1, 1, 0.5, float("nan"), 0.0, 1.0, 1.0), (1, 2, 0.4, None, 0.0, 1.0, 1.0), (1, 3, 0.3, 0.0, 0.0, float("inf"), 1.0)], kind)
    assert spatial.suppress_tiles(odd, most, tile=tile).count() == 3 and spatial.suppress_tiles(odd.limit(0), most).count() == 0


def test_dense_images_shrink_by_rounds(spark, monkeypatch):
    """Many boxes on few places: what the best boxes overlap goes at once, so rounds write fewer and fewer."""
    rng = np.random.default_rng(5)
    rows = []
    for k in range(6000):
        x, y, w, h = *rng.integers(0, 400, 2).tolist(), *rng.integers(40, 200, 2).tolist()
        rows.append((k % 2, k, round(float(rng.random()), 1), float(x), float(y), float(x + w), float(y + h)))
    b = spark.createDataFrame(rows, "image long, box long, score double, x1 double, y1 double, x2 double, y2 double").repartition(3)
    written = []
    monkeypatch.setattr(spatial, "table", lambda df, name, own=spatial.table: written.append(own(df, name)) or written[-1])
    monkeypatch.setattr(spatial, "drop", lambda df: None)
    got = spatial.suppress_tiles(b, 0.3, tile=600.0)
    assert sorted(map(tuple, got.collect())) == plain_suppress(rows, 0.3, None, 10**9)
    assert sum(t.count() for t in written) < 1.5 * len(rows)
