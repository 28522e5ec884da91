"""Curation of clips: gates, funnels, resumption, sampling and splits.

Random choices order rows by a hash of their key and a seed: the same in every run, in parallel, with no
shared state.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ranking import placed


def shuffle_key(seed: int, *cols) -> Column:
    """32 hex digits that order rows in a seeded random way."""
    return F.md5(F.concat_ws(":", *[F.col(c).cast("string") if isinstance(c, str) else c.cast("string") for c in cols], F.lit(str(seed))))


def seeded(seed: int, n: Column, *cols) -> Column:
    """A seeded number from 0 to n - 1."""
    return F.pmod(F.conv(F.substring(shuffle_key(seed, *cols), 1, 8), 16, 10).cast("long"), n)


def single_face(frames: DataFrame, clips: DataFrame, least: int = 0) -> DataFrame:
    """Clips (clip) whose every frame has exactly one face, of at least so many pixels on both sides. frames:
    (clip, frame, faces, width, height); clips without a frame are rejected."""
    ok = frames.groupBy("clip").agg(F.bool_and((F.col("faces") == 1) & (F.coalesce("width", F.lit(0)) >= least) & (F.coalesce("height", F.lit(0)) >= least)).alias("ok"))
    return clips.join(ok, "clip", "left").withColumn("kept", F.coalesce("ok", F.lit(False))).drop("ok")


def resample_plan(fps: Column, rate: Column, want_fps: float = 25, want_rate: int = 16000) -> Column:
    return F.struct(F.when(fps == want_fps, "copy").otherwise("resample").alias("video"), F.when(rate == want_rate, "copy").otherwise("resample").alias("audio"))


def sync_gate(conf: Column, offset: Column, least: float = 3.0, most: int = 6, fps: float = 25.0) -> Column:
    """keep, and what to do: copy at offset 0, else shift the sound by offset / fps seconds."""
    keep = (conf >= least) & (F.abs(offset) <= most)
    return F.struct(keep.alias("keep"), F.when(~keep, "drop").when(offset == 0, "copy").otherwise("shift").alias("action"), F.when(keep, offset / fps).alias("shift"))


def quality_gate(scores: DataFrame, least: float = 40.0) -> DataFrame:
    """Clips whose mean score over the first, middle and last frame is at least so much."""
    w = Window.partitionBy("clip")
    n = F.count("*").over(w)
    i = F.row_number().over(w.orderBy("frame")) - 1
    probes = scores.withColumns({"n": n, "i": i}).filter((F.col("i") == 0) | (F.col("i") == F.floor(F.col("n") / 2)) | (F.col("i") == F.col("n") - 1))
    return probes.groupBy("clip").agg(F.avg("score").alias("score")).withColumn("kept", F.col("score") >= least)


def probe_frames(frames: DataFrame) -> DataFrame:
    """First, middle and last frame of each clip, one row each; a frame that is two of them counts once."""
    w = Window.partitionBy("clip")
    x = frames.withColumns({"n": F.count("*").over(w), "i": F.row_number().over(w.orderBy("frame")) - 1})
    which = F.when(F.col("i") == 0, "first").when(F.col("i") == F.col("n") - 1, "last").when(F.col("i") == F.floor(F.col("n") / 2), "middle")
    return x.withColumn("probe", which).filter("probe is not null").drop("n", "i")


def length_gate(frames: Column, window: int, stride: int | None = None) -> Column:
    """Which training sets a clip is long enough for."""
    out = [(frames >= 2 * window).alias("sync"), (frames >= 3 * window).alias("reference")]
    return F.struct(*out, *([] if stride is None else [(frames > window * stride).alias("folder")]))


def normalize_index(index: Column, size: Column) -> Column:
    """Negative indexes count from the end; null where it is out of range."""
    at = F.when(index < 0, index + size).otherwise(index)
    return F.when((at >= 0) & (at < size), at)


def stage_funnel(clips: DataFrame, gates: list[tuple[str, Column]]) -> DataFrame:
    """(step, stage, total, kept) of gates applied in order, from one scan."""
    passed, counts = F.lit(True), [F.count("*").alias("n0")]
    for i, (_, gate) in enumerate(gates, 1):
        passed = passed & F.coalesce(gate, F.lit(False))
        counts.append(F.count_if(passed).alias(f"n{i}"))
    rows = F.array(*[F.struct(F.lit(i).alias("step"), F.lit(name).alias("stage"), F.col(f"n{i - 1}").alias("total"), F.col(f"n{i}").alias("kept")) for i, (name, _) in enumerate(gates, 1)])
    return clips.agg(*counts).select(F.inline(rows))


def random_pairing(left: DataFrame, right: DataFrame, seed: int) -> DataFrame:
    """(grp, place, left, right): both lists (grp, item) in seeded random order, cut to the shorter, paired by place."""

    def side(df: DataFrame, name: str, s: int) -> DataFrame:
        return placed(df.select("grp", F.col("item").alias(name), shuffle_key(s, "item").alias("key")), ["key", name], ["grp"]).drop("key")

    out = side(left, "left", seed).join(side(right, "right", seed + 1), ["grp", "place"])
    return out.select("grp", (F.col("place") + 1).alias("place"), "left", "right")


def training_pairs(clips: DataFrame, window: int, seed: int) -> DataFrame:
    """Per clip (clip, frames): a start, another start, the label that says whether the pair matches, and a start
    of a reference window that does not overlap the first. All uniform over what is allowed; clips of fewer than
    3 * window frames are left out."""
    c = clips.filter(F.col("frames") >= 3 * window)
    n = F.col("frames") - window + 1
    c = c.withColumn("start", seeded(seed, n, "clip"))
    c = c.withColumn("wrong", F.pmod(F.col("start") + 1 + seeded(seed + 1, n - 1, "clip"), n)).withColumn("y", seeded(seed + 2, F.lit(2), "clip").cast("int"))
    low, high = F.greatest(F.col("start") - window + 1, F.lit(0)), F.greatest(F.col("frames") - window - (F.col("start") + window) + 1, F.lit(0))
    pick = seeded(seed + 3, low + high, "clip")
    c = c.withColumn("reference", F.when(pick < low, pick).otherwise(F.col("start") + window + pick - low))
    return c.withColumn("other", F.when(F.col("y") == 1, F.col("start")).otherwise(F.col("wrong")))


def one_random_clip(clips: DataFrame, seed: int) -> DataFrame:
    """One clip of each video, so that videos count alike however many clips they have."""
    return clips.groupBy("video").agg(F.min_by("clip", F.struct(shuffle_key(seed, "clip").alias("h"), "clip")).alias("clip"), F.count("*").alias("clips"))


def even_partition(items: DataFrame, parts: int, order: str, within: str) -> DataFrame:
    """Contiguous near-equal parts of each sorted list, numbered from 1; the first ones get one more."""
    x = placed(items, [order], [within], "__place", "__of")
    size, more = F.floor(F.col("__of") / parts), F.col("__of") % parts
    bigger = more * (size + 1)
    part = F.when(F.col("__place") < bigger, F.floor(F.col("__place") / (size + 1))).otherwise(more + F.floor((F.col("__place") - bigger) / F.greatest(size, F.lit(1))))
    return x.withColumn("part", (part + 1).cast("int")).drop("__place", "__of")


def round_robin(items: DataFrame, chunk: int, workers: int, order: str, within: str) -> DataFrame:
    """Chunks of consecutive items dealt to workers in turn."""
    x = placed(items, [order], [within], "__place")
    return x.withColumn("worker", F.pmod(F.floor(F.col("__place") / chunk), F.lit(workers)).cast("int")).drop("__place")


def whole_batches(items: DataFrame, size: int, order: str, within: str) -> DataFrame:
    """The items of each sorted list that fill batches of `size`; the incomplete last batch is left out."""
    x = placed(items, [order], [within], "__place", "__of")
    return x.filter(F.col("__place") < F.floor(F.col("__of") / size) * size).drop("__place", "__of")


def natural_order(frames: DataFrame, path: str = "path", folder: str = "folder") -> DataFrame:
    """frames with their place, from 1, in their folder by the number that ends their name, so frame_10 follows frame_9; of equal
    numbers the first path, names without a number first."""
    number = F.regexp_extract(path, r"([0-9]+)\.[^.\/]+$", 1)
    x = placed(frames.withColumn("__number", F.when(number != "", number).try_cast("decimal(38,0)")), ["__number", path], [folder])
    return x.withColumn("place", F.col("place") + 1).drop("__number")


def stride_sample(frames: DataFrame, most: int = 100) -> DataFrame:
    """Every k-th frame of each clip, k = max(1, frames // most)."""
    w = Window.partitionBy("clip")
    x = frames.withColumns({"n": F.count("*").over(w), "i": F.row_number().over(w.orderBy("frame")) - 1})
    return x.filter(F.col("i") % F.greatest(F.lit(1), F.floor(F.col("n") / most)) == 0).drop("n", "i")


def feature_cache(wanted: DataFrame, cached: DataFrame, compute) -> DataFrame:
    """Wanted (clip, ...) with features from the cache where it has readable ones, else from compute(misses)."""
    hits = cached.filter("feature is not null")
    missing = wanted.join(hits, "clip", "left_anti")
    found = wanted.join(hits.select("clip", "feature"), "clip").withColumn("cached", F.lit(True))
    return found.unionByName(compute(missing).withColumn("cached", F.lit(False)))


def expired(names: Column, begin: str, end: str) -> Column:
    return names.between(begin, end)


def metric_rollup(steps: DataFrame) -> DataFrame:
    """(run, step, rank, micro, loss): sum over micro-steps, mean over ranks, one row a step."""
    ranks = steps.groupBy("run", "step", "rank").agg(F.sum("loss").alias("loss"))
    return ranks.groupBy("run", "step").agg(F.avg("loss").alias("loss"), F.count("*").alias("ranks"))
