"""Sampled series and time alignment: islands, windows, filters, scales, mixes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ranges import RANGE, TOTAL, in_ranges, join_at_seams, window, with_seams


def silence_islands(samples: DataFrame, level: float, least: int, group: str = "clip", order: str = "at") -> DataFrame:
    """Runs of samples below level of at least so many samples: start and end (exclusive) as places in the group,
    length, and whether a run leads or trails. order is a number. Ranges of a long group find their runs alone; runs at
    their edges are joined over the seams, where one ends at the place at which the next begins."""
    w = window(group, order)
    x = with_seams(in_ranges(samples, group, order), group, before=(F.count("*"), "sum"))
    x = x.withColumns({"i": F.row_number().over(w) - 1 + F.col("before"), "here": F.count("*").over(window(group)), "quiet": F.coalesce(F.col("value") < level, F.lit(False))})
    x = x.withColumn("loud", F.sum((~F.col("quiet")).cast("int")).over(w)).filter("quiet")
    parts = x.groupBy(group, RANGE, "loud").agg(F.min("i").alias("start"), (F.max("i") + 1).alias("end"), F.first("before").alias("before"), F.first("here").alias("here"), *[F.first(c).alias(c) for c in x.columns if c == TOTAL])
    if TOTAL in x.columns:
        edge = F.col(TOTAL).isNotNull() & ((F.col("start") == F.col("before")) | (F.col("end") == F.col("before") + F.col("here")))
        total = F.first(F.coalesce(TOTAL, "here")).alias("n")
        runs = join_at_seams(parts, group, edge, ["loud"], lambda before: before("end") == F.col("start"), [F.min("start").alias("start"), F.max("end").alias("end"), total])
    else:
        runs = parts.withColumnRenamed("here", "n")
    runs = runs.withColumn("len", F.col("end") - F.col("start")).filter(F.col("len") >= least)
    return runs.select(group, "start", "end", "len", (F.col("start") == 0).alias("leading"), (F.col("end") == F.col("n")).alias("trailing"))


def difference_filter(value: str, group: str, order: str, k: float = 0.97) -> Column:
    """y[t] = x[t] - k * x[t - 1], with 0 before the first sample."""
    return F.col(value) - k * F.lag(value, 1, 0.0).over(Window.partitionBy(group).orderBy(order))


def histogram(rows: DataFrame, value: str, bins: int = 30) -> DataFrame:
    """(bin, low, high, n) of equal-width bins from least to largest value; the last bin is closed, empty bins
    are shown. The two ends come from one aggregate and stay in the plan."""
    ends = rows.agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    width = (F.col("hi") - F.col("lo")) / bins
    at = F.when(F.col("hi") == F.col("lo"), 0).otherwise(F.least(F.floor((F.col(value) - F.col("lo")) / width), F.lit(bins - 1)))
    counts = rows.filter(F.col(value).isNotNull()).crossJoin(F.broadcast(ends)).groupBy(at.cast("int").alias("bin")).agg(F.count("*").alias("n"))
    every = ends.select(F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"), "lo", width.alias("w"))
    return every.join(counts, "bin", "left").select("bin", (F.col("lo") + F.col("bin") * F.col("w")).alias("low"), (F.col("lo") + (F.col("bin") + 1) * F.col("w")).alias("high"), F.coalesce("n", F.lit(0)).alias("n"))


def overlay(a: DataFrame, b: DataFrame, key: list[str], weight_a: float = 1.0, weight_b: float = 0.3) -> DataFrame:
    """Weighted sum of two aligned series, as long as the longer one."""
    x = a.withColumnRenamed("value", "va").join(b.withColumnRenamed("value", "vb"), key, "full")
    return x.select(*key, (F.coalesce("va", F.lit(0.0)) * weight_a + F.coalesce("vb", F.lit(0.0)) * weight_b).alias("value"))


def ping_pong(frames: DataFrame, targets: DataFrame) -> DataFrame:
    """(clip, at, frame): frames (clip, frame from 0, n) repeated forward and backward until `length` is reached."""
    at = targets.withColumn("at", F.explode(F.expr("sequence(0L, length - 1)")))
    place = F.pmod(F.col("at"), 2 * F.col("n"))
    src = at.withColumn("frame", F.when(place < F.col("n"), place).otherwise(2 * F.col("n") - 1 - place))
    return src.join(frames.select("clip", "frame"), ["clip", "frame"]).select("clip", "at", "frame")


def frame_audio(frames: DataFrame, rate: int = 16000, fps: float = 25.0) -> DataFrame:
    """Sample range of each frame; a frame right after the one before starts where that one ended."""
    w = Window.partitionBy("clip").orderBy("frame")
    start, end = F.floor(F.col("frame") / fps * rate), F.floor((F.col("frame") + 1) / fps * rate)
    x = frames.withColumns({"own": start, "end": end, "before": F.lag("frame").over(w), "before_end": F.lag(end).over(w)})
    return x.select("clip", "frame", F.when(F.col("before") == F.col("frame") - 1, F.col("before_end")).otherwise(F.col("own")).alias("start"), "end")


def frame_samples(ranges: DataFrame, blocks: DataFrame, size: int) -> DataFrame:
    """(clip, frame, samples): the samples of each frame (clip, frame, start, end), from blocks of `size` samples each (clip,
    block, samples), the last one of a clip shorter. A frame meets the blocks that its range touches by their numbers,
    is cut at their seams and put together again; samples that no block has are left out, a frame without any is empty.
    A frame of null or empty range is empty."""
    some = F.col("end") > F.col("start")
    touched = F.when(some, F.sequence(F.floor(F.col("start") / size), F.floor((F.col("end") - 1) / size)))
    cut = ranges.select("clip", "frame", "start", "end", F.explode_outer(touched).alias("block"))
    met = cut.join(blocks.select("clip", "block", "samples"), ["clip", "block"], "left")
    first = F.greatest(F.col("start") - F.col("block") * size, F.lit(0))
    last = F.least(F.col("end") - F.col("block") * size, F.size("samples"))
    piece = F.when(last > first, F.slice("samples", (first + 1).cast("int"), (last - first).cast("int")))
    pieces = met.groupBy("clip", "frame").agg(F.array_sort(F.collect_list(F.when(piece.isNotNull(), F.struct("block", piece.alias("part"))))).alias("pieces"))
    return pieces.select("clip", "frame", F.flatten("pieces.part").alias("samples"))


def sample_blocks(samples: DataFrame, size: int) -> DataFrame:
    """(clip, block, samples): samples (clip, at, value), places from 0 without gaps, in blocks of `size`."""
    block = F.floor(F.col("at") / size)
    out = samples.groupBy("clip", block.alias("block")).agg(F.array_sort(F.collect_list(F.struct("at", "value"))).alias("x"))
    return out.select("clip", "block", F.col("x.value").alias("samples"))


def fixed_windows(rows: DataFrame, size: int, group: str, at: str) -> DataFrame:
    """(group, window, first, last, n, padding) of windows of `size` places, the last one shorter."""
    w = rows.groupBy(group, F.floor(F.col(at) / size).alias("window")).agg(F.min(at).alias("first"), F.max(at).alias("last"), F.count("*").alias("n"))
    return w.withColumn("padding", size - F.col("n"))


def sliding_starts(length: Column, size: int, step: int, guard: int = 0) -> Column:
    """Starts 0, step, 2 * step … of windows with start + size < length - guard."""
    most = F.floor((length - guard - size - 1) / step)
    return F.when(most >= 0, F.transform(F.sequence(F.lit(0).cast("long"), most), lambda i: i * step)).otherwise(F.array().cast("array<bigint>"))


def paired_windows(frames: Column, samples: Column) -> Column:
    """Number of 5-frame windows that both streams can fill: min(frames, samples // 640) - 5, not below 0."""
    return F.greatest(F.lit(0), F.least(frames, F.floor(samples / 640)) - 5)


def window_crop(start: Column, frames: int, length: Column, fps: float = 25.0, hops: int = 80) -> Column:
    """(start, length) in spectrogram columns of `frames` frames from a start; null where the clip is too short."""
    at = F.floor(start * hops / fps)
    n = F.ceil(F.lit(frames / 5 * 16)).cast("long")
    return F.when(at + n <= length, F.struct(at.alias("at"), n.alias("n")))


def frame_pad(length: Column, size: int, hop: int) -> Column:
    """Frames of a signal that is padded by size - hop at both ends, and the samples that the last one lacks: every whole
    hop of length + size but one begins a frame, and so does a hop that the length only begins."""
    frames = F.floor((length + size) / hop) - 1 + F.signum(F.pmod(length, F.lit(hop)).cast("double")).cast("long")
    return F.struct(frames.alias("frames"), ((frames + 1) * hop - size - length).alias("missing"))


def amp_to_db(x: Column, floor: float = -100.0) -> Column:
    return 20 * F.log10(F.greatest(F.pow(F.lit(10.0), F.lit(floor / 20)), x))


def db_to_amp(x: Column) -> Column:
    return F.pow(F.lit(10.0), x * 0.05)


def scale(db: Column, floor: float = -100.0, most: float = 4.0, symmetric: bool = True) -> Column:
    """dB to -most..most, or to 0..most, clipped."""
    unit = (db - floor) / -floor
    return F.greatest(F.lit(-most), F.least(F.lit(most), 2 * most * unit - most)) if symmetric else F.greatest(F.lit(0.0), F.least(F.lit(most), most * unit))


def unscale(x: Column, floor: float = -100.0, most: float = 4.0) -> Column:
    return (F.greatest(F.lit(-most), F.least(F.lit(most), x)) + most) * -floor / (2 * most) + floor


def log_mel(values: Column) -> Column:
    """Log spectrum with a floor 8 below its maximum, then (x + 4) / 4."""
    logs = F.transform(values, lambda v: F.log10(F.greatest(v, F.lit(1e-10))))
    top = F.array_max(logs)
    return F.transform(logs, lambda v: (F.greatest(v, top - 8.0) + 4.0) / 4.0)


def clip_window(boxes: DataFrame, first: int, size: int, width: int, height: int) -> DataFrame:
    """Frames first to first + size - 1 of each clip with their first detection cut to the picture; clips that
    do not have every one of these frames are rejected."""
    x = boxes.filter(F.col("frame").between(first, first + size - 1))
    one = x.groupBy("clip", "frame").agg(F.min_by(F.struct(F.greatest(F.lit(0), F.col("x1")).alias("x1"), F.least(F.lit(width), F.col("x2")).alias("x2")), F.col("det")).alias("b"))
    full = one.withColumn("n", F.count("*").over(Window.partitionBy("clip"))).filter(F.col("n") == size)
    return full.select("clip", "frame", "b.x1", "b.x2")
