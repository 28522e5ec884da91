"""Vectors as arrays: distances, normal forms, offsets between streams, and mergeable statistics."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / (norm(a) * norm(b))


def distance(a: Column, b: Column) -> Column:
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: F.pow(x.cast("double") - y.cast("double"), F.lit(2.0))), F.lit(0.0), lambda s, x: s + x))


def normalize(a: Column) -> Column:
    """Divided by its length; a zero vector stays as it is."""
    n = norm(a)
    return F.when(n == 0, a.cast("array<double>")).otherwise(F.transform(a, lambda x: x.cast("double") / n))


def shifted_distances(video: DataFrame, audio: DataFrame, most: int) -> DataFrame:
    """(clip, shift, distance): mean distance of each video frame's vector to the audio vector shift frames
    later, for shifts from -most to most; a frame without audio meets the zero vector. Both: (clip, frame, vec)."""
    v = video.select("clip", "frame", "vec", F.explode(F.sequence(F.lit(-most), F.lit(most))).alias("shift")).withColumn("at", F.col("frame") + F.col("shift"))
    a = audio.select("clip", F.col("frame").alias("at"), F.col("vec").alias("sound"))
    d = F.when(F.col("sound").isNull(), norm(F.col("vec"))).otherwise(distance(F.col("vec"), F.col("sound")))
    return v.join(a, ["clip", "at"], "left").groupBy("clip", "shift").agg(F.avg(d).alias("distance"))


def av_offset(distances: DataFrame) -> DataFrame:
    """(clip, offset, confidence): minus the shift of least distance (the smallest of equal ones), and how far
    that lies below the median. Distances count to 9 digits, so the order in which means are summed decides nothing."""
    distances = distances.withColumn("distance", F.round("distance", 9))
    best = F.struct("distance", "shift")
    return distances.groupBy("clip").agg((-F.min_by("shift", best)).alias("offset"), (F.percentile("distance", F.lit(0.5)) - F.min("distance")).alias("confidence"))


def pair_accuracy(pairs: DataFrame, least: float = 0.5) -> DataFrame:
    """(a, b, label): percent of pairs whose cosine is over least exactly where the label says so."""
    right = (cosine(F.col("a"), F.col("b")) > least) == F.col("label")
    return pairs.agg(F.count("*").alias("pairs"), (F.avg(right.cast("double")) * 100).alias("accuracy"))


def cosine_bce(pairs: DataFrame) -> DataFrame:
    """Mean binary cross-entropy of the cosine, clamped to 1e-12 and 1, against label 0 or 1."""
    p = F.least(F.greatest(cosine(F.col("a"), F.col("b")), F.lit(1e-12)), F.lit(1.0))
    loss = -(F.col("label") * F.log(p) + (1 - F.col("label")) * F.log(F.greatest(1 - p, F.lit(1e-12))))
    return pairs.agg(F.avg(loss).alias("loss"))


def drift(a: DataFrame, b: DataFrame) -> DataFrame:
    """Mean squared difference of normalized vectors that share an id."""
    x = a.select("id", normalize(F.col("vec")).alias("x")).join(b.select("id", normalize(F.col("vec")).alias("y")), "id")
    d = F.aggregate(F.zip_with("x", "y", lambda p, q: (p - q) * (p - q)), F.lit(0.0), lambda s, v: s + v) / F.size("x")
    return x.agg(F.avg(d).alias("drift"), F.count("*").alias("pairs"))


#: Stored statistics: how many vectors, their mean, and for every pair of components i <= j the sum of products of what lies
#: between a vector and the mean. Any rows of this form merge to one, today's with last year's.
STATS = "n long, s array<double>, ss array<double>"
#: Tasks that merge statistics side by side before the last one.
MERGERS = 32


class Moments:
    """Count, mean and centred products of vectors, merged pairwise; never a difference of large sums."""

    def __init__(self) -> None:
        self.n, self.mean, self.products = 0, None, None

    def add(self, n: int, mean: np.ndarray, products: np.ndarray) -> None:
        if self.n and len(mean) != len(self.mean):
            raise ValueError(f"vectors of {len(mean)} and of {len(self.mean)} components")
        if not self.n:
            self.n, self.mean, self.products = n, mean, products
        elif n:
            apart, total = mean - self.mean, self.n + n
            self.products = self.products + products + np.outer(apart, apart) * (self.n * n / total)
            self.mean, self.n = self.mean + apart * (n / total), total

    def add_vectors(self, x: np.ndarray) -> None:
        mean = x.mean(axis=0)
        mean += (x - mean).mean(axis=0)  # what rounding left
        self.add(len(x), mean, (x - mean).T @ (x - mean))

    def batch(self) -> Iterator[pa.RecordBatch]:
        if self.n:
            yield pa.RecordBatch.from_arrays([pa.array([self.n], pa.int64()), pa.array([self.mean]), pa.array([self.products[np.triu_indices(len(self.mean))]])], ["n", "s", "ss"])


def _square(d: int, half: np.ndarray) -> np.ndarray:
    out = np.zeros((d, d))
    out[np.triu_indices(d)] = half
    return out + np.triu(out, 1).T


def feature_sums(features: DataFrame, vec: str = "vec", most: int | None = None) -> DataFrame:
    """STATS of all vectors, or of at most so many, as one row (none without vectors). Null vectors are left out; all others must
    have as many components. Each task adds up its rows in numpy."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Moments()
        for b in batches:
            if b.num_rows:
                sizes = pc.unique(pc.list_value_length(b.column(0))).to_pylist()
                if len(sizes) > 1:
                    raise ValueError(f"vectors of {sizes} components")
                m.add_vectors(b.column(0).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(b.num_rows, -1))
        yield from m.batch()

    some = features.select(vec).filter(F.col(vec).isNotNull())
    return merge_sums((some if most is None else some.limit(most)).mapInArrow(run, STATS))


def merge_sums(stats: DataFrame) -> DataFrame:
    """Any number of STATS rows as one row. They meet in MERGERS tasks and then in one, which reads a row of each;
    tasks hold two rows at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Moments()
        for b in batches:
            for n, s, ss in zip(*(b.column(c) for c in ("n", "s", "ss")), strict=True):
                mean = s.values.to_numpy()
                m.add(n.as_py(), mean, _square(len(mean), ss.values.to_numpy()))
        yield from m.batch()

    return stats.select("n", "s", "ss").repartition(MERGERS).mapInArrow(run, STATS).repartition(1).mapInArrow(run, STATS)


def mean_cov(stats: DataFrame, sample: bool = False) -> DataFrame:
    """(i, j, n, mean_i, mean_j, cov) of one STATS row, i <= j, with the population covariance or the sample's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for n, s, ss in zip(*(b.column(c) for c in ("n", "s", "ss")), strict=True):
                mean, many = s.values.to_numpy(), n.as_py()
                i, j = np.triu_indices(len(mean))
                with np.errstate(divide="ignore", invalid="ignore"):
                    cov = ss.values.to_numpy() / (np.float64(many) - sample)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (i.astype(np.int32), j.astype(np.int32), np.full(len(i), many), mean[i], mean[j], cov)], ["i", "j", "n", "mean_i", "mean_j", "cov"])

    return stats.select("n", "s", "ss").mapInArrow(run, "i int, j int, n long, mean_i double, mean_j double, cov double")


def frechet_distance(a: DataFrame, b: DataFrame) -> float:
    """Of two feature tables, or of two tables of stored STATS; one row of each reaches the driver, where the matrix root is
    taken. The covariance is the sample's."""

    def read(df: DataFrame) -> tuple[np.ndarray, np.ndarray]:
        stats = merge_sums(df) if df.columns == ["n", "s", "ss"] else feature_sums(df)
        r = stats.first()
        return np.array(r["s"]), _square(len(r["s"]), np.array(r["ss"])) / (r["n"] - 1)

    (m, s), (n, t) = read(a), read(b)
    w, v = np.linalg.eigh(s)
    root = v * np.sqrt(np.maximum(w, 0)) @ v.T
    cross = np.sqrt(np.maximum(np.linalg.eigvalsh(root @ t @ root), 0)).sum()
    return float(((m - n) ** 2).sum() + np.trace(s) + np.trace(t) - 2 * cross)


def context_window(frames: DataFrame, length: DataFrame, back: int = 4, ahead: int = 6, rate: float = 2.0) -> DataFrame:
    """(clip, frame, pos, at): the feature indexes of each frame, int(rate * frame) - back up to ahead, clamped to
    0 and the clip's last feature, so edges repeat."""
    at = F.floor(F.col("frame") * rate)
    x = frames.join(length, "clip").withColumn("raw", F.explode(F.sequence(at - back, at + ahead - 1)))
    return x.select("clip", "frame", (F.col("raw") - (at - back)).cast("int").alias("pos"), F.greatest(F.lit(0), F.least(F.col("raw"), F.col("features") - 1)).alias("at"))


def sparse_window(frames: DataFrame, length: DataFrame, back: int = 2, ahead: int = 2, rate: float = 2.0) -> DataFrame:
    """(clip, frame, pos, at): for each frame from back before to ahead after, its feature and the one before it; beyond
    the clip's edges the edge's feature twice."""
    x = frames.join(length, "clip").withColumn("dt", F.explode(F.sequence(F.lit(-back), F.lit(ahead))))
    raw = ((F.col("frame") + F.col("dt")) * rate).cast("long")
    edge = (raw < 1) | (raw > F.col("features") - 1)
    at = F.greatest(F.lit(0), F.least(raw, F.col("features") - 1))
    two = x.select("clip", "frame", "dt", F.posexplode(F.array(F.when(edge, at).otherwise(at - 1), at)).alias("k", "at"))
    return two.select("clip", "frame", ((F.col("dt") + back) * 2 + F.col("k")).cast("int").alias("pos"), "at")


def window_chunks(length: DataFrame, rate: float = 2.0) -> DataFrame:
    """(clip, frame) of all windows of each clip (clip, features): up to the first frame that begins beyond its end."""
    last = F.ceil((F.col("features") + 1) / rate).cast("int")
    return length.select("clip", F.explode(F.sequence(F.lit(0), last)).alias("frame"))


def frame_stack(starts: DataFrame, frames: int) -> DataFrame:
    """(clip, start, place, frame): the consecutive frames of a stack that begins at each start; context_window gives
    the features of each."""
    x = starts.withColumn("place", F.explode(F.sequence(F.lit(0), F.lit(frames - 1))))
    return x.select("clip", "start", "place", (F.col("start") + F.col("place")).cast("int").alias("frame"))
