"""Boxes: padding, clamping, gates, overlap, suppression, tracks, clusters.

Boxes are x1, y1, x2, y2. What depends on the order of arrival (clusters, suppression, tracks) runs per
group in applyInPandas: a recording, an image, or a shot of a video.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import drop, table


def pad(x: Column, y: Column, w: Column, h: Column, width: int, height: int, share: float = 0.3) -> Column:
    """Box with a margin of int(w * share) and int(h * share), cut to the frame, with center and area."""
    px, py = F.floor(w * share), F.floor(h * share)
    x1, y1 = F.greatest(F.lit(0), x - px), F.greatest(F.lit(0), y - py)
    x2, y2 = F.least(F.lit(width), x + w + px), F.least(F.lit(height), y + h + py)
    return F.struct(x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2"), ((x1 + x2) / 2).alias("center_x"), ((y1 + y2) / 2).alias("center_y"), ((x2 - x1) * (y2 - y1)).alias("area"))


def clamp(x1: Column, y1: Column, x2: Column, y2: Column, width: int, height: int) -> Column:
    """Whole pixels inside the frame, at least one wide and high."""
    a, b = F.greatest(F.lit(0), F.least(x1.cast("int"), F.lit(width - 1))), F.greatest(F.lit(0), F.least(y1.cast("int"), F.lit(height - 1)))
    return F.struct(a.alias("x1"), b.alias("y1"), F.greatest(a + 1, F.least(x2.cast("int"), F.lit(width))).alias("x2"), F.greatest(b + 1, F.least(y2.cast("int"), F.lit(height))).alias("y2"))


def is_face(w: Column, h: Column, score: Column) -> Column:
    return (w >= 50) & (h >= 80) & (w / h).between(0.2, 1.5) & (score >= 0.5)


def primary_face(faces: DataFrame) -> DataFrame:
    """The largest face of each frame that passes is_face, the first of equal ones. (clip, frame, det, w, h, score)"""
    ok = faces.filter(is_face(F.col("w"), F.col("h"), F.col("score")))
    w = Window.partitionBy("clip", "frame").orderBy((F.col("w") * F.col("h")).desc(), "det")
    return ok.withColumn("rn", F.row_number().over(w)).filter("rn = 1").drop("rn")


def top_k(rows: DataFrame, k: int, group: str, score: str, tie: str) -> DataFrame:
    w = Window.partitionBy(group).orderBy(F.col(score).desc(), tie)
    return rows.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= k)


def iou(a: str, b: str) -> Column:
    """Intersection over union of the boxes with these column prefixes."""
    c = lambda p, k: F.col(f"{p}{k}")
    w = F.greatest(F.lit(0.0), F.least(c(a, "x2"), c(b, "x2")) - F.greatest(c(a, "x1"), c(b, "x1")))
    h = F.greatest(F.lit(0.0), F.least(c(a, "y2"), c(b, "y2")) - F.greatest(c(a, "y1"), c(b, "y1")))
    area = lambda p: (c(p, "x2") - c(p, "x1")) * (c(p, "y2") - c(p, "y1"))
    both = area(a) + area(b) - w * h
    return F.when(both > 0, w * h / both).otherwise(0.0)


def frame_overlaps(boxes: DataFrame) -> DataFrame:
    """(frame, a, b, iou) of each pair of boxes (frame, box, x1..y2) within a frame."""
    side = lambda p: boxes.select("frame", *[F.col(c).alias(f"{p}{c}") for c in ("box", "x1", "y1", "x2", "y2")])
    return side("a").join(side("b"), "frame").filter("abox < bbox").select("frame", F.col("abox").alias("a"), F.col("bbox").alias("b"), iou("a", "b").alias("iou"))


def contained(detections: DataFrame, clusters: DataFrame, cell: int = 256) -> DataFrame:
    """Detections (center_x, center_y) with every cluster of their recording whose box holds the center. Boxes are
    laid on a grid, so that the join is by equal cells and neither side is broadcast."""
    span = lambda lo, hi: F.sequence(F.floor(F.col(lo) / cell), F.floor(F.col(hi) / cell))
    c = clusters.withColumn("gx", F.explode(span("x1", "x2"))).withColumn("gy", F.explode(span("y1", "y2")))
    d = detections.withColumns({"gx": F.floor(F.col("center_x") / cell), "gy": F.floor(F.col("center_y") / cell)})
    inside = F.col("center_x").between(F.col("x1"), F.col("x2")) & F.col("center_y").between(F.col("y1"), F.col("y2"))
    return d.join(c, ["recording", "gx", "gy"]).filter(inside).drop("gx", "gy")


def cluster_stats(faces: DataFrame, least: int = 3) -> DataFrame:
    """Clusters (recording, cluster) of at least so many faces; ids keep their number."""
    out = faces.groupBy("recording", "cluster").agg(F.count("*").alias("face_count"), F.avg("center_x").alias("center_x"), F.avg("center_y").alias("center_y"), F.avg("area").alias("avg_area"), F.min("x1").alias("x_low"), F.max("x2").alias("x_high"), F.min("time").alias("t_low"), F.max("time").alias("t_high"))
    return out.filter(F.col("face_count") >= least).withColumn("cluster_id", F.format_string("SPEAKER_%02d", "cluster"))


def leader_clusters(faces: DataFrame, tolerance: float) -> DataFrame:
    """(recording, det, cluster): in order of arrival (frame, det), each face joins the first cluster whose mean
    center lies nearer than tolerance, or opens one. The order decides, so one recording is one group and a hot one is
    one task. Centers lie on a grid of cells of the tolerance's width and move to another cell as they drift, so a face is
    compared with the centers of nine cells, however many clusters there are. Faces without a center get a cluster each."""

    def run(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values(["frame", "det"])
        sums, cells, out = [], {}, []  # x, y, count and cell of each cluster; the clusters of each cell
        for x, y in g[["center_x", "center_y"]].to_numpy(float).tolist():
            at = (math.floor(x / tolerance), math.floor(y / tolerance)) if tolerance > 0 and math.isfinite(x) and math.isfinite(y) else None
            k = len(sums)
            for dx in (-1, 0, 1) if at else ():
                for dy in (-1, 0, 1):
                    for c in cells.get((at[0] + dx, at[1] + dy), ()):
                        sx, sy, n, _ = sums[c]
                        if c < k and math.sqrt((sx / n - x) ** 2 + (sy / n - y) ** 2) < tolerance:
                            k = c
            if k == len(sums):
                sums.append((x, y, 1, at))
                cells.setdefault(at, set()).add(k)
            else:
                sx, sy, n, old = sums[k]
                sx, sy, n = sx + x, sy + y, n + 1
                new = (math.floor(sx / n / tolerance), math.floor(sy / n / tolerance))
                sums[k] = sx, sy, n, new
                if new != old:
                    cells[old].discard(k)
                    cells.setdefault(new, set()).add(k)
            out.append(k)
        return pd.DataFrame({"recording": g["recording"], "det": g["det"], "cluster": np.array(out, np.int32)})

    kind = faces.schema["recording"].dataType.simpleString()
    return faces.select("recording", "frame", "det", "center_x", "center_y").groupBy("recording").applyInPandas(run, f"recording {kind}, det long, cluster int")


def _overlap(box: np.ndarray, boxes: np.ndarray) -> np.ndarray:
    w = np.minimum(box[2], boxes[:, 2]) - np.maximum(box[0], boxes[:, 0])
    h = np.minimum(box[3], boxes[:, 3]) - np.maximum(box[1], boxes[:, 1])
    inter = np.maximum(w, 0) * np.maximum(h, 0)
    area = lambda b: (b[..., 2] - b[..., 0]) * (b[..., 3] - b[..., 1])
    return inter / np.maximum(area(box) + area(boxes) - inter, 1e-12)


def best_of_tasks(rows: DataFrame, k: int, group: str, order: list[str | Column]) -> DataFrame:
    """The first k rows of every group within each task, without a shuffle: what is left of the global first k has all of
    them. Spark limits groups before a window's shuffle by itself, but only up to spark.sql.optimizer.windowGroupLimitThreshold
    (1,000) rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, seen = None, 0  # group of the last row, and how many rows of it there were
        for b in batches:
            if not b.num_rows:
                continue
            at = b.column(b.schema.get_field_index(group))
            code = at.dictionary_encode(null_encoding="encode").indices.to_numpy()
            starts = np.concatenate([[0], np.flatnonzero(np.diff(code)) + 1])
            place = np.arange(len(code)) - np.repeat(starts, np.diff([*starts, len(code)]))
            first = at[0].as_py()
            if last is not None and (first == last[0] or (first != first and last[0] != last[0])):
                place[: starts[1] if len(starts) > 1 else None] += seen
            last, seen = (at[-1].as_py(),), int(place[-1]) + 1
            yield b.filter(pa.array(place < k))

    return rows.sortWithinPartitions(group, *order).mapInArrow(run, rows.schema)


def suppress(boxes: DataFrame, most_overlap: float = 0.3, before: int = 5000, after: int = 750, least: float = 0.05) -> DataFrame:
    """(image, box, score): per image, boxes in falling order of score; one that overlaps a kept one by more than
    most_overlap goes. Only scores over least count, the best `before` enter and the best `after` stay. Each task hands on
    an image's best `before` of its own, so of a hot image no more than that reaches one task from another."""

    def kept(b: np.ndarray) -> list[int]:
        """Rows of one image that stay; they come in falling order of score."""
        left, out = np.arange(len(b)), []
        while len(left) and len(out) < after:
            i, left = left[0], left[1:]
            out.append(int(i))
            left = left[_overlap(b[i], b[left]) <= most_overlap] if len(left) else left
        return out

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Images come one after the other; pieces of the one that a batch ends in, `before` rows at most, wait for the rest."""
        pieces: list[pd.DataFrame] = []
        same = lambda a, b: a == b or (pd.isna(a) and pd.isna(b))
        for g in chain(batches, [None]):
            last = g is None
            if not last and (not len(g) or (pieces and same(g["image"].iloc[-1], pieces[0]["image"].iloc[0]))):
                pieces += [g] if len(g) else []
                continue
            pieces += [] if last else [g]
            if not pieces:
                continue
            g = pd.concat(pieces, ignore_index=True)
            image, b = pd.factorize(g["image"], use_na_sentinel=False)[0], g[["x1", "y1", "x2", "y2"]].to_numpy(float)
            cuts = [0, *(np.flatnonzero(np.diff(image)) + 1).tolist(), len(g)]
            pieces = [] if last else [g.iloc[cuts[-2] :]]
            rows = [x + k for x, y in zip(cuts, cuts[1:] if last else cuts[1:-1], strict=False) for k in kept(b[x:y])]
            yield g.iloc[rows][["image", "box", "score"]]

    kind = boxes.schema["image"].dataType.simpleString()
    some = boxes.filter(F.col("score") > least).select("image", "box", "score", "x1", "y1", "x2", "y2")
    order = [F.col("score").desc(), F.col("box")]
    w = Window.partitionBy("image").orderBy(*order)
    best = best_of_tasks(some, before, "image", order).withColumn("place", F.row_number().over(w)).filter(F.col("place") <= before).drop("place")
    return best.mapInPandas(run, f"image {kind}, box long, score double")  # the window leaves a task's images in order


#: Boxes of an image or a tile that are judged in a round of suppress_tiles(), the best first. Spark limits groups of up to as
#: many rows before the shuffle by itself.
BEST = 1000


def _kept(b: np.ndarray, inside: np.ndarray, most_overlap: float) -> list[int]:
    """Rows of a tile that stay for sure; boxes come in falling order of score. A box goes if a kept one before it overlaps it, and
    is kept if all that do are gone and it lies inside the tile, so that the tile has all boxes that could."""
    gone, waits, out = np.zeros(len(b), bool), ~inside, []
    for i in range(len(b)):
        if gone[i]:
            continue
        hit = _overlap(b[i], b[i + 1 :]) > most_overlap
        if waits[i]:
            waits[i + 1 :] |= hit
        else:
            out.append(i)
            gone[i + 1 :] |= hit
    return out


def _without(left: DataFrame, kept: DataFrame, most_overlap: float, cell: float, most_w: float, most_h: float) -> DataFrame:
    """The boxes of left that are not in kept and that no box of kept overlaps. A box lies in the cell of its first corner, and a
    kept one is laid on all cells where boxes can begin that overlap it enough: those to the left of it by d share
    at most w / (d + w) with it."""
    k = kept.select(*[F.col(c).alias(f"k{c}") for c in ("image", "box", "x1", "y1", "x2", "y2")])
    share = (1 - most_overlap) / most_overlap + 1e-6 if most_overlap > 0 else math.inf

    def cells(lo: str, hi: str, most: float) -> Column:
        reach = F.greatest(F.lit(0.0), F.least((F.col(hi) - F.col(lo)) * share, F.lit(most)))
        return F.sequence(F.floor((F.col(lo) - reach) / cell), F.floor(F.col(hi) / cell))

    k = k.withColumn("kgx", F.explode(cells("kx1", "kx2", most_w))).withColumn("kgy", F.explode(cells("ky1", "ky2", most_h)))
    near = F.col("image").eqNullSafe(F.col("kimage")) & (F.floor(F.col("x1") / cell) == F.col("kgx")) & (F.floor(F.col("y1") / cell) == F.col("kgy"))
    return left.join(k, near & ((F.col("box") == F.col("kbox")) | (iou("", "k") > most_overlap)), "left_anti")


def suppress_tiles(boxes: DataFrame, most_overlap: float = 0.3, after: int | None = None, least: float = 0.05, tile: float = 512.0) -> DataFrame:
    """What suppress() does with all boxes of an image, for images of any number of boxes: (image, box, score) of those that stay.

    In a round the best BEST boxes of each image are judged, and all boxes that the kept ones overlap go, by a join over cells;
    where boxes are dense few are left. Once that settles less than half of the boxes, images are cut into tiles, and a tile has
    the best BEST of all boxes that touch it. Boxes inside a tile are judged with all better ones that overlap them in sight; others wait, as do those that
    depend on them. Every other round tiles are moved by half their width, and they double when a round has settled less than half
    of the boxes, so in the end an image is one tile, whose best box is settled in any case. (image, box) tells boxes apart; a
    null image is one image. Boxes without finite sides or without an area overlap nothing and stay. tile: some boxes
    wide, as a box is copied to every tile that it touches."""
    sides = ("x1", "y1", "x2", "y2")
    sound = (F.col("x2") > F.col("x1")) & (F.col("y2") > F.col("y1"))
    for c in sides:
        sound = sound & (F.abs(F.col(c)) < float("inf"))
    rows = boxes.filter(F.col("score") > least).select("image", "box", "score", *[F.col(c).cast("double").alias(c) for c in sides])
    own = table(rows.withColumn("sound", F.coalesce(sound, F.lit(False))), "boxes")
    schema = rows.schema
    out = [own.filter("not sound").select("image", "box", "score")]
    now = own.filter("sound").drop("sound")
    left, most_w, most_h = now.agg(F.count("*"), F.max(F.col("x2") - F.col("x1")), F.max(F.col("y2") - F.col("y1"))).first()

    def judge(whole: bool, width: float, shift: float) -> Callable[[pd.DataFrame], pd.DataFrame]:
        def run(g: pd.DataFrame) -> pd.DataFrame:
            g = g.sort_values("place")
            b, low = g[list(sides)].to_numpy(float), g[["gx", "gy"]].to_numpy(float) * width - shift
            inside = whole | ((b[:, :2] >= low).all(axis=1) & (b[:, 2:] < low + width).all(axis=1))
            return g.iloc[_kept(b, inside, most_overlap)][schema.names]

        return run

    whole, turn, width, shift = True, 0, tile, 0.0
    while left:
        if not whole:
            cell = lambda c: F.floor((F.col(c) + shift) / width)  # noqa: B023, E731
            tiles = now.withColumn("gx", F.explode(F.sequence(cell("x1"), cell("x2")))).withColumn("gy", F.explode(F.sequence(cell("y1"), cell("y2"))))
        else:
            tiles = now.withColumns({"gx": F.lit(0).cast("long"), "gy": F.lit(0).cast("long")})
        w = Window.partitionBy("image", "gx", "gy").orderBy(F.col("score").desc(), "box")
        best = tiles.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= BEST)
        kept = table(best.groupBy("image", "gx", "gy").applyInPandas(judge(whole, width, shift), schema), "kept-boxes")
        out.append(kept.select("image", "box", "score"))
        new = table(_without(now, kept, most_overlap, tile / 2, most_w, most_h), "boxes")
        if turn:
            drop(now)
        before, left = left, new.count()
        if left > before / 2:
            whole, width = False, width if whole else width * 2
        now, turn = new, turn + 1
        shift = width / 2 * (turn % 2)
    stay = reduce(DataFrame.union, out)
    if after is None:
        return stay
    w = Window.partitionBy("image").orderBy(F.col("score").desc(), "box")
    return stay.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= after).drop("place")


def tracks(boxes: DataFrame, gap: int = 25, least_iou: float = 0.5, longer: int = 50, larger: float = 100.0) -> DataFrame:
    """(video, shot, track, frame, box) of greedy tracks within a shot.

    The first box that is left opens a track; frame by frame the first box that is left, at most gap frames after
    the track's last one and overlapping it by more than least_iou, joins. Boxes of a finished track are used up;
    tracks of more than `longer` boxes and of a mean side over `larger` stay, numbered in order of their start."""

    def run(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values(["frame", "box"])
        b, frame, free = g[["x1", "y1", "x2", "y2"]].to_numpy(float), g["frame"].to_numpy(), np.ones(len(g), bool)
        rows, number = [], 0
        for i in range(len(g)):  # those before are used up
            if not free[i]:
                continue
            track, free[i] = [i], False
            while True:
                last = track[-1]
                ahead = np.arange(np.searchsorted(frame, frame[last], side="right"), np.searchsorted(frame, frame[last] + gap, side="right"))
                ahead = ahead[free[ahead]]
                ahead = ahead[_overlap(b[last], b[ahead]) > least_iou]
                if not len(ahead):
                    break
                track.append(int(ahead[0]))
                free[ahead[0]] = False
            side = np.maximum(b[track, 2] - b[track, 0], b[track, 3] - b[track, 1]).mean()
            if len(track) > longer and side > larger:
                rows += [(number, k) for k in track]
                number += 1
        out = g.iloc[[k for _, k in rows]][["video", "shot", "frame", "box"]]
        return out.assign(track=np.array([n for n, _ in rows], np.int32))[["video", "shot", "track", "frame", "box"]]

    kinds = {f.name: f.dataType.simpleString() for f in boxes.schema}
    return boxes.select("video", "shot", "frame", "box", "x1", "y1", "x2", "y2").groupBy("video", "shot").applyInPandas(run, f"video {kinds['video']}, shot {kinds['shot']}, track int, frame {kinds['frame']}, box {kinds['box']}")


def interpolate(boxes: DataFrame, value: str = "x1", track: str = "track") -> DataFrame:
    """(track, frame, value): missing frames between two boxes of a track are filled linearly."""
    w = Window.partitionBy(track).orderBy("frame")
    x = boxes.select(track, "frame", value, F.lead("frame").over(w).alias("next"), F.lead(value).over(w).alias("to"))
    x = x.withColumn("f", F.explode(F.sequence(F.col("frame"), F.coalesce(F.col("next") - 1, F.col("frame")))))
    step = F.when(F.col("f") == F.col("frame"), F.col(value)).otherwise(F.col(value) + (F.col("to") - F.col(value)) * (F.col("f") - F.col("frame")) / (F.col("next") - F.col("frame")))
    return x.select(track, F.col("f").alias("frame"), step.cast("double").alias(value))


def rolling_median(rows: DataFrame, value: str, group: str, order: str, k: int = 13) -> DataFrame:
    """Median of k rows around each, where rows beyond the group's ends count as 0."""
    w = Window.partitionBy(group).orderBy(order)
    near = F.collect_list(value).over(w.rowsBetween(-(k // 2), k // 2))
    full = F.array_sort(F.concat(near, F.array_repeat(F.lit(0.0), (F.lit(k) - F.size(near)).cast("int"))))
    return rows.withColumn("median", F.element_at(full, k // 2 + 1))


def assign_shots(frames: DataFrame, shots: DataFrame, least: int = 50, bucket: int = 250) -> DataFrame:
    """Frames (video, frame) with the shot [start_frame, end_frame) of at least so many frames that holds them. A
    video without such shots is one shot. Shots are laid on buckets of frames: the join is by equal buckets."""
    long = shots.filter(F.col("end_frame") - F.col("start_frame") >= least)
    long = long.withColumn("bucket", F.explode(F.sequence(F.floor(F.col("start_frame") / bucket), F.floor((F.col("end_frame") - 1) / bucket))))
    some = long.select("video").distinct().withColumn("has", F.lit(True))
    f = frames.withColumn("bucket", F.floor(F.col("frame") / bucket)).join(some, "video", "left")
    inside = (f["video"] == long["video"]) & (f["bucket"] == long["bucket"]) & (F.col("frame") >= F.col("start_frame")) & (F.col("frame") < F.col("end_frame"))
    j = f.join(long, inside, "left").select(f["video"], "frame", "has", "shot")
    return j.filter(F.col("shot").isNotNull() | F.col("has").isNull()).select("video", "frame", F.coalesce("shot", F.lit(0)).alias("shot"))


def crop_plan(x1: Column, y1: Column, x2: Column, y2: Column, scale: float = 0.4) -> Column:
    """Half size, center and the bounds of the crop around a tracked box, in a frame padded by the half size."""
    half, cx, cy = F.greatest(y2 - y1, x2 - x1) / 2, (x1 + x2) / 2, (y1 + y2) / 2
    padded = F.floor(half * (1 + 2 * scale))
    my, mx = cy + padded, cx + padded
    return F.struct(half.alias("half"), cx.alias("cx"), cy.alias("cy"), F.floor(my - half).alias("top"), F.floor(my + half * (1 + 2 * scale)).alias("bottom"), F.floor(mx - half * (1 + scale)).alias("left"), F.floor(mx + half * (1 + scale)).alias("right"))


def landmark_box(xs: Column, ys: Column, width: Column, height: Column, fallback: Column) -> Column:
    """Box around landmarks with margins of 5 % at the sides and 10 % above and below, cut to the frame; the
    fallback where there are no landmarks."""
    x1, x2, y1, y2 = F.array_min(xs), F.array_max(xs), F.array_min(ys), F.array_max(ys)
    mx, my = (x2 - x1) * 0.05, (y2 - y1) * 0.1
    box = F.struct(F.greatest(F.lit(0.0), x1 - mx).alias("x1"), F.greatest(F.lit(0.0), y1 - my).alias("y1"), F.least(width.cast("double"), x2 + mx).alias("x2"), F.least(height.cast("double"), y2 + my).alias("y2"))
    return F.when(F.size(xs) > 0, box).otherwise(fallback)


def fit_geometry(width: Column, height: Column, size: int) -> Column:
    """Scale of the short side to size, target size (rounded up) and the offsets of the center crop."""
    scale = F.lit(float(size)) / F.least(width, height)
    w, h = F.ceil(width * scale), F.ceil(height * scale)
    return F.struct(w.alias("w"), h.alias("h"), F.floor((w - size) / 2).alias("left"), F.floor((h - size) / 2).alias("top"))
