"""Queries over boxes that integer arithmetic derives from `lineitem`."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import spatial as S
from .catalog import Tables, query

#: A box a line: det is unique by (line, part) for parts below 10^9, 40 to 240 pixels.
BOXES = "b AS (SELECT l_orderkey % 97 AS recording, l_orderkey AS frame, l_linenumber * 1000000000::BIGINT + l_partkey AS det, (l_partkey * 7 % 1600)::INT AS x, (l_suppkey * 37 % 900)::INT AS y, (40 + l_quantity * 4)::INT AS w, (60 + l_partkey % 180)::INT AS h, round(l_discount * 10, 4) AS score FROM (SELECT l_orderkey, l_linenumber, l_partkey, min(l_suppkey) AS l_suppkey, min(l_quantity) AS l_quantity, min(l_discount) AS l_discount FROM lineitem GROUP BY 1, 2, 3))"

#: What sets a line number apart from a part in det; the SQL states it itself.
LINE = 1_000_000_000


def boxes(t: Tables) -> DataFrame:
    c = F.col
    one = t.lineitem.groupBy("l_orderkey", "l_linenumber", "l_partkey").agg(*[F.min(k).alias(k) for k in ("l_suppkey", "l_quantity", "l_discount")])
    return one.select((c("l_orderkey") % 97).alias("recording"), c("l_orderkey").alias("frame"), (c("l_linenumber").cast("long") * LINE + c("l_partkey")).alias("det"), (c("l_partkey") * 7 % 1600).cast("int").alias("x"), (c("l_suppkey") * 37 % 900).cast("int").alias("y"), (40 + c("l_quantity") * 4).cast("int").alias("w"), (60 + c("l_partkey") % 180).cast("int").alias("h"), F.round(c("l_discount") * 10, 4).alias("score"))


PADDED = BOXES + ", p AS (SELECT *, greatest(0, x - floor(w * 0.3::DOUBLE)::BIGINT) AS x1, greatest(0, y - floor(h * 0.3::DOUBLE)::BIGINT) AS y1, least(1920, x + w + floor(w * 0.3::DOUBLE)::BIGINT) AS x2, least(1080, y + h + floor(h * 0.3::DOUBLE)::BIGINT) AS y2 FROM b), q AS (SELECT *, (x1 + x2) / 2 AS center_x, (y1 + y2) / 2 AS center_y, (x2 - x1) * (y2 - y1) AS area FROM p)"


def padded(t: Tables) -> DataFrame:
    return boxes(t).withColumn("p", S.pad(F.col("x"), F.col("y"), F.col("w"), F.col("h"), 1920, 1080)).select("recording", "frame", "det", "w", "h", "score", "p.*")


@query(f"WITH {PADDED} SELECT frame, det, x1, y1, x2, y2, center_x, center_y, area FROM q")
def pad_box(t: Tables) -> DataFrame:
    return padded(t).select("frame", "det", "x1", "y1", "x2", "y2", "center_x", "center_y", "area")


@query(f"WITH {BOXES}, a AS (SELECT *, greatest(0, least(x - 20, 1279)) AS x1, greatest(0, least(y - 20, 719)) AS y1 FROM b) SELECT frame, det, x1, y1, greatest(x1 + 1, least(x + w, 1280)) AS x2, greatest(y1 + 1, least(y + h, 720)) AS y2 FROM a")
def clamp_box(t: Tables) -> DataFrame:
    c = S.clamp(F.col("x") - 20, F.col("y") - 20, F.col("x") + F.col("w"), F.col("y") + F.col("h"), 1280, 720)
    return boxes(t).select("frame", "det", c.alias("c")).select("frame", "det", "c.*")


FACES = "w >= 50 AND h >= 80 AND w / h BETWEEN 0.2 AND 1.5 AND score >= 0.5"


@query(f"WITH {BOXES} SELECT frame, det FROM b WHERE {FACES}")
def face_predicates(t: Tables) -> DataFrame:
    return boxes(t).filter(S.is_face(F.col("w"), F.col("h"), F.col("score"))).select("frame", "det")


@query(f"WITH {BOXES}, r AS (SELECT *, row_number() OVER (PARTITION BY recording, frame ORDER BY w * h DESC, det) AS rn FROM b WHERE {FACES}) SELECT frame, det, w, h FROM r WHERE rn = 1")
def primary_face(t: Tables) -> DataFrame:
    return S.primary_face(boxes(t).withColumn("clip", F.col("recording"))).select("frame", "det", "w", "h")


@query(f"WITH {BOXES}, r AS (SELECT *, row_number() OVER (PARTITION BY frame ORDER BY score DESC, det) AS place FROM b) SELECT frame, det, place FROM r WHERE place <= 2")
def topk_per_image(t: Tables) -> DataFrame:
    return S.top_k(boxes(t), 2, "frame", "score", "det").select("frame", "det", F.col("place").cast("long").alias("place"))


IOU = "greatest(0, least(a.x2, b.x2) - greatest(a.x1, b.x1)) * greatest(0, least(a.y2, b.y2) - greatest(a.y1, b.y1))"


@query(f"WITH {PADDED}, o AS (SELECT a.frame, a.det AS a, b.det AS b, {IOU} AS i, a.area + b.area AS s FROM q a JOIN q b ON a.frame = b.frame AND a.det < b.det) SELECT frame, a, b, CASE WHEN s - i > 0 THEN i / (s - i) ELSE 0 END AS iou FROM o")
def iou(t: Tables) -> DataFrame:
    return S.frame_overlaps(padded(t).withColumn("box", F.col("det")))


CLUSTERS = "c AS (SELECT l_orderkey % 97 AS recording, l_linenumber AS cluster, min(l_partkey * 7 % 1600) AS x1, min(l_partkey * 7 % 1600) + 300 AS x2, min(l_suppkey * 37 % 900) AS y1, min(l_suppkey * 37 % 900) + 300 AS y2 FROM lineitem GROUP BY 1, 2)"


@query(f"WITH {PADDED}, {CLUSTERS} SELECT q.det, q.frame, c.cluster FROM q JOIN c ON q.recording = c.recording AND center_x BETWEEN c.x1 AND c.x2 AND center_y BETWEEN c.y1 AND c.y2")
def box_containment(t: Tables) -> DataFrame:
    x, y = F.min(F.col("l_partkey") * 7 % 1600), F.min(F.col("l_suppkey") * 37 % 900)
    c = t.lineitem.groupBy((F.col("l_orderkey") % 97).alias("recording"), F.col("l_linenumber").alias("cluster")).agg(x.alias("x1"), (x + 300).alias("x2"), y.alias("y1"), (y + 300).alias("y2"))
    return S.contained(padded(t).select("recording", "frame", "det", "center_x", "center_y"), c).select("det", "frame", "cluster")


@query(f"WITH {PADDED} SELECT recording, (det // 1000000000)::INT AS cluster, count(*) AS face_count, round(avg(center_x), 6) AS center_x, round(avg(area), 4) AS avg_area, min(x1) AS x_low, max(x2) AS x_high, 'SPEAKER_' || lpad((det // 1000000000)::VARCHAR, 2, '0') AS cluster_id FROM q GROUP BY recording, det // 1000000000 HAVING count(*) >= 90")
def cluster_stats(t: Tables) -> DataFrame:
    f = padded(t).withColumns({"cluster": F.floor(F.col("det") / LINE).cast("int"), "time": F.col("frame") / 25})
    return S.cluster_stats(f, 90).select("recording", "cluster", "face_count", F.round("center_x", 6).alias("center_x"), F.round("avg_area", 4).alias("avg_area"), "x_low", "x_high", "cluster_id")


@query(f"""WITH RECURSIVE {PADDED}, s AS (SELECT l.recording, q.det, q.center_x, q.center_y, row_number() OVER (PARTITION BY l.recording ORDER BY q.frame, q.det) AS k FROM q JOIN (SELECT l_orderkey AS frame, l_linenumber * 1000000000::BIGINT + l_partkey AS det, min(l_suppkey) AS recording FROM lineitem GROUP BY 1, 2) l ON l.frame = q.frame AND l.det = q.det),
r AS (SELECT DISTINCT recording, 0::BIGINT AS k, 0::BIGINT AS det, 0::INT AS cluster, []::STRUCT(x DOUBLE, y DOUBLE, n BIGINT)[] AS c FROM s UNION ALL
SELECT recording, k, det, cluster, CASE WHEN cluster < len(c) THEN list_transform(c, lambda z, i: CASE WHEN i = cluster + 1 THEN {{'x': z.x + center_x, 'y': z.y + center_y, 'n': z.n + 1}} ELSE z END) ELSE list_append(c, {{'x': center_x, 'y': center_y, 'n': 1}}) END
FROM (SELECT s.recording, s.k, s.det, s.center_x, s.center_y, r.c, (coalesce(list_position(list_transform(r.c, lambda z: sqrt(pow(z.x / z.n - s.center_x, 2) + pow(z.y / z.n - s.center_y, 2)) < 108), true), len(r.c) + 1) - 1)::INT AS cluster FROM r JOIN s ON s.recording = r.recording AND s.k = r.k + 1))
SELECT recording, det, cluster FROM r WHERE k > 0""")
def leader_cluster(t: Tables) -> DataFrame:
    """One supplier is one recording, so recordings grow in number with the table."""
    own = t.lineitem.groupBy(F.col("l_orderkey").alias("frame"), (F.col("l_linenumber").cast("long") * LINE + F.col("l_partkey")).alias("det")).agg(F.min("l_suppkey").alias("recording"))
    return S.leader_clusters(padded(t).drop("recording").join(own, ["frame", "det"]), 108.0)


@query(f"""WITH RECURSIVE {PADDED}, s AS (SELECT frame AS image, det AS box, score::DOUBLE AS score, x1, y1, x2, y2, row_number() OVER (PARTITION BY frame ORDER BY score DESC, det) AS k FROM q WHERE score > 0.05),
r AS (SELECT DISTINCT image, 0::BIGINT AS k, []::STRUCT(box BIGINT, x1 BIGINT, y1 BIGINT, x2 BIGINT, y2 BIGINT)[] AS kept FROM s UNION ALL
SELECT s.image, s.k, CASE WHEN len(list_filter(r.kept, lambda p: greatest(0, least(p.x2, s.x2) - greatest(p.x1, s.x1)) * greatest(0, least(p.y2, s.y2) - greatest(p.y1, s.y1)) > 0.3 * ((p.x2 - p.x1) * (p.y2 - p.y1) + (s.x2 - s.x1) * (s.y2 - s.y1) - greatest(0, least(p.x2, s.x2) - greatest(p.x1, s.x1)) * greatest(0, least(p.y2, s.y2) - greatest(p.y1, s.y1))))) = 0
 THEN list_append(r.kept, {{'box': s.box, 'x1': s.x1, 'y1': s.y1, 'x2': s.x2, 'y2': s.y2}}) ELSE r.kept END FROM r JOIN s ON s.image = r.image AND s.k = r.k + 1),
e AS (SELECT image, unnest(arg_max(kept, k)).box AS box FROM r GROUP BY image)
SELECT image, box, score FROM e JOIN s USING (image, box)""")
def nms(t: Tables) -> DataFrame:
    """One frame is one image."""
    return S.suppress(padded(t).select(F.col("frame").alias("image"), F.col("det").alias("box"), F.col("score").cast("double").alias("score"), "x1", "y1", "x2", "y2"))


@query(f"""WITH RECURSIVE {PADDED}, s AS (SELECT recording AS image, frame * 10000000000 + det AS box, score::DOUBLE AS score, x1, y1, x2, y2, row_number() OVER (PARTITION BY recording ORDER BY score DESC, frame * 10000000000 + det) AS k FROM q WHERE score > 0.05),
r AS (SELECT DISTINCT image, 0::BIGINT AS k, []::STRUCT(box BIGINT, x1 BIGINT, y1 BIGINT, x2 BIGINT, y2 BIGINT)[] AS kept FROM s UNION ALL
SELECT s.image, s.k, CASE WHEN len(list_filter(r.kept, lambda p: greatest(0, least(p.x2, s.x2) - greatest(p.x1, s.x1)) * greatest(0, least(p.y2, s.y2) - greatest(p.y1, s.y1)) > 0.3 * ((p.x2 - p.x1) * (p.y2 - p.y1) + (s.x2 - s.x1) * (s.y2 - s.y1) - greatest(0, least(p.x2, s.x2) - greatest(p.x1, s.x1)) * greatest(0, least(p.y2, s.y2) - greatest(p.y1, s.y1))))) = 0
 THEN list_append(r.kept, {{'box': s.box, 'x1': s.x1, 'y1': s.y1, 'x2': s.x2, 'y2': s.y2}}) ELSE r.kept END FROM r JOIN s ON s.image = r.image AND s.k = r.k + 1),
e AS (SELECT image, unnest(arg_max(kept, k)).box AS box FROM r GROUP BY image)
SELECT image, box, score FROM e JOIN s USING (image, box)""")
def nms_tiles(t: Tables) -> DataFrame:
    """One recording is one large image: its boxes are judged in tiles of 600 pixels first."""
    b = padded(t).select(F.col("recording").alias("image"), (F.col("frame") * (10 * LINE) + F.col("det")).alias("box"), F.col("score").cast("double").alias("score"), "x1", "y1", "x2", "y2")
    return S.suppress_tiles(b, tile=600.0)


@query("""WITH RECURSIVE e AS (SELECT user_id AS video, user_id % 3 AS shot, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS k, event_id AS box, event_id % 50 * 3 AS x FROM events),
g AS (SELECT video, shot, list(x ORDER BY k) AS xs, count(*) AS n FROM e GROUP BY 1, 2),
r AS (SELECT video, shot, xs, n, []::BIGINT[] AS used, 0::BIGINT AS at_, -1::BIGINT AS track FROM g UNION ALL
SELECT video, shot, xs, n, list_append(used, coalesce(nxt, free)), coalesce(nxt, free), CASE WHEN nxt IS NULL THEN track + 1 ELSE track END FROM
(SELECT *, CASE WHEN at_ > 0 THEN list_filter(range(at_ + 1, least(at_ + 8, n) + 1), lambda j: NOT list_contains(used, j) AND 200 - abs(xs[j] - xs[at_]) > 0.5 * (200 + abs(xs[j] - xs[at_])))[1] END AS nxt,
 list_filter(range(1, n + 1), lambda j: NOT list_contains(used, j))[1] AS free FROM r WHERE len(used) < n)),
t AS (SELECT video, track FROM r WHERE at_ > 0 GROUP BY 1, 2 HAVING count(*) > 10),
m AS (SELECT video, track, row_number() OVER (PARTITION BY video ORDER BY track) - 1 AS number FROM t)
SELECT e.video, e.shot, m.number::INT AS track, e.k * 3 AS frame, e.box FROM r JOIN m USING (video, track) JOIN e ON e.video = r.video AND e.k = r.at_""")
def iou_track(t: Tables) -> DataFrame:
    """Boxes that jump about, one in every third frame; one user is one video."""
    order = F.row_number().over(Window.partitionBy("user_id").orderBy("event_id")).cast("long")
    e = t.events.select(F.col("user_id").alias("video"), (F.col("user_id") % 3).alias("shot"), (order * 3).alias("frame"), F.col("event_id").alias("box"), (F.col("event_id") % 50 * 3).alias("x1"))
    return S.tracks(e.withColumns({"y1": F.col("x1") * 0, "x2": F.col("x1") + 200, "y2": F.lit(200)}), longer=10)


@query("""WITH b AS (SELECT user_id AS track, (epoch_us(ts) // 3600000000) AS frame, min(value) AS x1 FROM events GROUP BY 1, 2), n AS (SELECT *, lead(frame) OVER w AS nxt, lead(x1) OVER w AS to_ FROM b WINDOW w AS (PARTITION BY track ORDER BY frame)),
f AS (SELECT *, unnest(range(frame, coalesce(nxt, frame + 1))) AS f FROM n) SELECT track, f AS frame, CASE WHEN f = frame THEN x1 ELSE x1 + (to_ - x1) * (f - frame) / (nxt - frame) END AS x1 FROM f""")
def interpolate_boxes(t: Tables) -> DataFrame:
    hour = F.floor(F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', ts)") / 3600000000)
    b = t.events.groupBy(F.col("user_id").alias("track"), hour.alias("frame")).agg(F.min("value").alias("x1"))
    return S.interpolate(b)


@query("""WITH w AS (SELECT event_id, user_id, list(value) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING) AS v FROM events)
SELECT event_id, list_sort(v || list_transform(range(13 - len(v)), lambda x: 0.0::DOUBLE))[7] AS median FROM w""")
def rolling_median(t: Tables) -> DataFrame:
    return S.rolling_median(t.events, "value", "user_id", "event_id").select("event_id", "median")


@query("""WITH s AS (SELECT l_suppkey AS video, l_linenumber AS shot, l_linenumber * 100 AS start_frame, l_linenumber * 100 + max(l_quantity)::INT * 2 AS end_frame FROM lineitem GROUP BY 1, 2),
f AS (SELECT DISTINCT l_suppkey AS video, l_partkey % 1000 AS frame FROM lineitem), g AS (SELECT * FROM s WHERE end_frame - start_frame >= 50), h AS (SELECT DISTINCT video FROM g)
SELECT f.video, f.frame, g.shot FROM f JOIN g ON f.video = g.video AND f.frame >= start_frame AND f.frame < end_frame UNION ALL SELECT f.video, f.frame, 0 FROM f WHERE f.video NOT IN (SELECT video FROM h)""")
def shot_assign(t: Tables) -> DataFrame:
    start = F.col("l_linenumber") * 100
    s = t.lineitem.groupBy(F.col("l_suppkey").alias("video"), F.col("l_linenumber").alias("shot")).agg(F.max("l_quantity").cast("int").alias("q")).select("video", "shot", (F.col("shot") * 100).alias("start_frame"), (F.col("shot") * 100 + F.col("q") * 2).alias("end_frame"))
    f = t.lineitem.select(F.col("l_suppkey").alias("video"), (F.col("l_partkey") % 1000).alias("frame")).distinct()
    return S.assign_shots(f, s)


@query(f"WITH {BOXES}, h AS (SELECT frame, det, greatest(w, h) / 2 AS half, x + w / 2 AS cx, y + h / 2 AS cy FROM b) SELECT frame, det, half, cx, cy, floor(cy + floor(half * 1.8::DOUBLE) - half)::BIGINT AS top, floor(cy + floor(half * 1.8::DOUBLE) + half * 1.8::DOUBLE)::BIGINT AS bottom FROM h")
def crop_plan(t: Tables) -> DataFrame:
    x, y = F.col("x").cast("double"), F.col("y").cast("double")
    return boxes(t).select("frame", "det", S.crop_plan(x, y, x + F.col("w"), y + F.col("h")).alias("c")).select("frame", "det", "c.half", "c.cx", "c.cy", "c.top", "c.bottom")


@query("""WITH g AS (SELECT l_orderkey, list(l_partkey * 7 % 1600)::DOUBLE[] AS xs, list(l_suppkey * 37 % 900)::DOUBLE[] AS ys FROM lineitem GROUP BY 1), m AS (SELECT *, list_min(xs) AS a, list_max(xs) AS b, list_min(ys) AS c, list_max(ys) AS d FROM g)
SELECT l_orderkey, greatest(0, a - (b - a) * 0.05::DOUBLE) AS x1, greatest(0, c - (d - c) * 0.1::DOUBLE) AS y1, least(1500, b + (b - a) * 0.05::DOUBLE) AS x2, least(880, d + (d - c) * 0.1::DOUBLE) AS y2 FROM m""")
def landmark_box(t: Tables) -> DataFrame:
    g = t.lineitem.groupBy("l_orderkey").agg(F.collect_list((F.col("l_partkey") * 7 % 1600).cast("double")).alias("xs"), F.collect_list((F.col("l_suppkey") * 37 % 900).cast("double")).alias("ys"))
    none = F.lit(None).cast("struct<x1: double, y1: double, x2: double, y2: double>")
    return g.select("l_orderkey", S.landmark_box(F.col("xs"), F.col("ys"), F.lit(1500), F.lit(880), none).alias("b")).select("l_orderkey", "b.*")


@query("WITH s AS (SELECT p_partkey, p_size * 20 AS w, p_size * 5 + 200 AS h FROM part), k AS (SELECT *, ceil(w * (256.0::DOUBLE / least(w, h)))::BIGINT AS tw, ceil(h * (256.0::DOUBLE / least(w, h)))::BIGINT AS th FROM s) SELECT p_partkey, tw AS w, th AS h, floor((tw - 256) / 2)::BIGINT AS left, floor((th - 256) / 2)::BIGINT AS top FROM k")
def fit_geometry(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", S.fit_geometry(F.col("p_size") * 20, F.col("p_size") * 5 + 200, 256).alias("g")).select("p_partkey", "g.*")
