"""Queries over `events.value` as samples (clip = user, in order of event) and lengths from other tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import signal as S
from ..operators.ranking import placed
from .catalog import Tables, query


def samples(t: Tables) -> DataFrame:
    return t.events.select(F.col("user_id").alias("clip"), F.col("event_id").alias("at"), "value")


@query("""WITH x AS (SELECT user_id AS clip, row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY user_id) AS n, value < 60 AS quiet, sum((value >= 60)::INT) OVER w AS loud FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id))
SELECT clip, min(i) AS first, max(i) + 1 AS stop, max(i) + 1 - min(i) AS len, min(i) = 0 AS leading, max(i) + 1 = max(n) AS trailing FROM x WHERE quiet GROUP BY clip, loud HAVING max(i) + 1 - min(i) >= 3""")
def silence_islands(t: Tables) -> DataFrame:
    return S.silence_islands(samples(t), 60.0, 3).withColumnsRenamed({"start": "first", "end": "stop"})


@query("SELECT event_id, value - 0.97::DOUBLE * lag(value, 1, 0) OVER (PARTITION BY user_id ORDER BY event_id) AS y FROM events")
def difference_filter(t: Tables) -> DataFrame:
    return t.events.select("event_id", S.difference_filter("value", "user_id", "event_id").alias("y"))


@query("""WITH e AS (SELECT min(value) AS lo, max(value) AS hi FROM events), c AS (SELECT least(floor((value - lo) / ((hi - lo) / 30)), 29)::INT AS bin, count(*) AS n FROM events, e GROUP BY 1)
SELECT b.bin::INT AS bin, round(lo + b.bin * ((hi - lo) / 30), 9) AS low, round(lo + (b.bin + 1) * ((hi - lo) / 30), 9) AS high, coalesce(n, 0) AS n FROM e, range(30) b(bin) LEFT JOIN c ON c.bin = b.bin""")
def histogram30(t: Tables) -> DataFrame:
    return S.histogram(t.events, "value").select("bin", F.round("low", 9).alias("low"), F.round("high", 9).alias("high"), "n")


@query("""WITH a AS (SELECT user_id AS clip, event_id // 3 AS i, min(value) AS value FROM events WHERE event_type = 'view' GROUP BY 1, 2), b AS (SELECT user_id AS clip, event_id // 3 AS i, max(value) AS value FROM events WHERE event_type <> 'view' GROUP BY 1, 2)
SELECT clip, i, coalesce(a.value, 0) * 1.0::DOUBLE + coalesce(b.value, 0) * 0.3::DOUBLE AS value FROM a FULL JOIN b USING (clip, i)""")
def overlay_mix(t: Tables) -> DataFrame:
    i = F.floor(F.col("event_id") / 3).alias("i")
    a = t.events.filter("event_type = 'view'").groupBy(F.col("user_id").alias("clip"), i).agg(F.min("value").alias("value"))
    b = t.events.filter("event_type <> 'view'").groupBy(F.col("user_id").alias("clip"), i).agg(F.max("value").alias("value"))
    return S.overlay(a, b, ["clip", "i"])


@query("""WITH n AS (SELECT l_orderkey AS clip, count(*) AS n, max(l_quantity)::BIGINT AS length FROM lineitem GROUP BY 1), x AS (SELECT clip, n, unnest(range(length)) AS place FROM n)
SELECT clip, place, CASE WHEN place % (2 * n) < n THEN place % (2 * n) ELSE 2 * n - 1 - place % (2 * n) END AS frame FROM x""")
def ping_pong_loop(t: Tables) -> DataFrame:
    n = t.lineitem.groupBy(F.col("l_orderkey").alias("clip")).agg(F.count("*").alias("n"), F.max("l_quantity").cast("long").alias("length"))
    frames = n.select("clip", F.explode(F.expr("sequence(0L, n - 1)")).alias("frame"))
    return S.ping_pong(frames, n).withColumnRenamed("at", "place")


@query("""WITH f AS (SELECT DISTINCT l_orderkey AS clip, l_partkey % 500 AS frame FROM lineitem), r AS (SELECT *, floor(frame / 25.0::DOUBLE * 16000)::BIGINT AS own, floor((frame + 1) / 25.0::DOUBLE * 16000)::BIGINT AS stop FROM f),
l AS (SELECT *, lag(frame) OVER w AS before, lag(stop) OVER w AS before_stop FROM r WINDOW w AS (PARTITION BY clip ORDER BY frame)) SELECT clip, frame, CASE WHEN before = frame - 1 THEN before_stop ELSE own END AS first, stop FROM l""")
def frame_audio_align(t: Tables) -> DataFrame:
    f = t.lineitem.select(F.col("l_orderkey").alias("clip"), (F.col("l_partkey") % 500).alias("frame")).distinct()
    return S.frame_audio(f).withColumnsRenamed({"start": "first", "end": "stop"})


@query("""WITH s AS (SELECT user_id AS clip, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS at_, value FROM events),
f AS (SELECT clip, unnest(range(0, max(at_) // 2 + 3)) AS frame FROM s GROUP BY clip),
r AS (SELECT clip, frame, floor(frame / 25.0::DOUBLE * 60)::BIGINT AS start, floor((frame + 1) / 25.0::DOUBLE * 60)::BIGINT AS stop FROM f)
SELECT r.clip, r.frame, count(at_) AS n, round(coalesce(sum(value), 0), 4) AS total, arg_min(value, at_) AS first, arg_max(value, at_) AS last FROM r LEFT JOIN s ON s.clip = r.clip AND at_ >= start AND at_ < stop GROUP BY 1, 2""")
def frame_audio_samples(t: Tables) -> DataFrame:
    """Samples of each frame, at 60 samples and 25 frames a second, from blocks of seven samples."""
    s = placed(t.events.select(F.col("user_id").alias("clip"), "event_id", "value"), ["event_id"], ["clip"], "at")
    f = s.groupBy("clip").agg(F.max("at").alias("m")).select("clip", F.explode(F.expr("sequence(0L, cast(m div 2 + 2 as long))")).alias("frame"))
    out = S.frame_samples(S.frame_audio(f, 60, 25.0), S.sample_blocks(s, 7), 7)
    x = F.col("samples")
    return out.select("clip", "frame", F.size(x).cast("long").alias("n"), F.round(F.aggregate(x, F.lit(0.0), lambda a, v: a + v), 4).alias("total"), F.try_element_at(x, F.lit(1)).alias("first"), F.try_element_at(x, F.lit(-1)).alias("last"))


@query("SELECT user_id AS clip, event_id // 3000 AS win, min(event_id) AS first, max(event_id) AS last, count(*) AS n, 3000 - count(*) AS padding FROM events GROUP BY 1, 2")
def fixed_windows(t: Tables) -> DataFrame:
    return S.fixed_windows(samples(t), 3000, "clip", "at").withColumnRenamed("window", "win")


@query("SELECT doc_id, unnest(list_filter(range(0, n_chars, 3), lambda i: i + 52 < n_chars - 3)) AS first, greatest(0, least(n_chars, n_chars * 600 // 640) - 5) AS paired FROM documents")
def sliding_windows(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.explode(S.sliding_starts(F.col("n_chars"), 52, 3, 3)).alias("first"), S.paired_windows(F.col("n_chars"), F.col("n_chars") * 600).alias("paired"))


@query("SELECT l_orderkey, l_linenumber, at_ AS place, 52 AS n FROM (SELECT *, floor(l_partkey % 300 * 80 / 25.0::DOUBLE)::BIGINT AS at_ FROM lineitem) WHERE at_ + 52 <= l_quantity * 20")
def window_crop(t: Tables) -> DataFrame:
    w = S.window_crop(F.col("l_partkey") % 300, 16, F.col("l_quantity") * 20)
    return t.lineitem.select("l_orderkey", "l_linenumber", w.alias("w")).filter("w is not null").select("l_orderkey", "l_linenumber", F.col("w.at").alias("place"), "w.n")


@query("""WITH f AS (SELECT doc_id, n_chars AS n, CASE WHEN n_chars % 200 = 0 THEN (n_chars + 1200 - 800) // 200 + 1 ELSE (n_chars + 1200 - 800) // 200 + 2 END AS frames FROM documents)
SELECT doc_id, n / 25.0::DOUBLE AS seconds, frames, (frames - 1) * 200 + 800 - (n + 1200) AS missing FROM f""")
def frame_math(t: Tables) -> DataFrame:
    p = S.frame_pad(F.col("n_chars"), 800, 200)
    return t.documents.select("doc_id", (F.col("n_chars") / 25.0).alias("seconds"), p.alias("p")).select("doc_id", "seconds", "p.*")


@query("""WITH d AS (SELECT event_id, 20 * log10(greatest(pow(10.0::DOUBLE, -5), value / 500)) AS db FROM events), s AS (SELECT *, greatest(-4, least(4, 8 * ((db + 100) / 100) - 4)) AS sym, greatest(0, least(4, 4 * ((db + 100) / 100))) AS asym FROM d)
SELECT event_id, round(db, 6) AS db, round(sym, 6) AS sym, round(asym, 6) AS asym, round((greatest(-4, least(4, sym)) + 4) * 100 / 8 - 100, 6) AS back, round(pow(10.0::DOUBLE, db * 0.05), 6) AS amp FROM s""")
def spectral_scale(t: Tables) -> DataFrame:
    d = t.events.select("event_id", S.amp_to_db(F.col("value") / 500).alias("db"))
    r = lambda c, n: F.round(c, 6).alias(n)
    return d.select("event_id", r(F.col("db"), "db"), r(S.scale(F.col("db")), "sym"), r(S.scale(F.col("db"), symmetric=False), "asym"), r(S.unscale(S.scale(F.col("db"))), "back"), r(S.db_to_amp(F.col("db")), "amp"))


@query("""WITH l AS (SELECT vec_id, list_transform(embedding::DOUBLE[], lambda v: log10(greatest(v, 1e-10))) AS x FROM embeddings)
SELECT vec_id, round(list_sum(list_transform(x, lambda v: (greatest(v, list_max(x) - 8.0) + 4.0) / 4.0)), 6) AS total FROM l""")
def log_mel(t: Tables) -> DataFrame:
    m = S.log_mel(F.col("embedding").cast("array<double>"))
    return t.embeddings.select("vec_id", F.round(F.aggregate(m, F.lit(0.0), lambda a, v: a + v), 6).alias("total"))


@query("""WITH b AS (SELECT l_suppkey AS clip, l_partkey % 60 AS frame, l_orderkey * 10 + l_linenumber AS det, l_partkey % 2000 - 20 AS x1 FROM lineitem), f AS (SELECT clip, frame, arg_min(x1, (det, x1)) AS x1 FROM b WHERE frame BETWEEN 20 AND 35 GROUP BY 1, 2),
n AS (SELECT *, count(*) OVER (PARTITION BY clip) AS n FROM f) SELECT clip, frame, greatest(0, x1) AS x1, least(1920, x1 + 100) AS x2 FROM n WHERE n = 16""")
def fixed_clip_window(t: Tables) -> DataFrame:
    b = t.lineitem.select(F.col("l_suppkey").alias("clip"), (F.col("l_partkey") % 60).alias("frame"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("d"), (F.col("l_partkey") % 2000 - 20).alias("x1"))
    return S.clip_window(b.withColumns({"x2": F.col("x1") + 100, "det": F.struct("d", "x1")}), 20, 16, 1920, 1080)
