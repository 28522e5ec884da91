"""Queries over `embeddings`: even ids are one stream (video), odd ids the other (audio), clip = label."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import vectors as V
from ..sources.shared import table
from .catalog import Tables, query

STREAMS = "v AS (SELECT label AS clip, vec_id // 2 AS frame, embedding::DOUBLE[] AS vec FROM embeddings WHERE vec_id % 2 = 0), a AS (SELECT label AS clip, vec_id // 2 AS frame, embedding::DOUBLE[] AS vec FROM embeddings WHERE vec_id % 2 = 1)"


def streams(t: Tables) -> tuple[DataFrame, DataFrame]:
    e = t.embeddings.select(F.col("label").alias("clip"), F.floor(F.col("vec_id") / 2).cast("int").alias("frame"), F.col("embedding").cast("array<double>").alias("vec"), "vec_id")
    return tuple(e.filter(F.col("vec_id") % 2 == k).drop("vec_id") for k in (0, 1))


@query("""WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS vec FROM embeddings), p AS (SELECT a.vec_id, a.vec AS x, b.vec AS y FROM v a JOIN v b ON b.vec_id = a.vec_id + 1)
SELECT vec_id, round(list_cosine_similarity(x, y), 9) AS cosine, round(list_distance(x, y), 9) AS distance, round(sqrt(list_inner_product(x, x)), 9) AS length FROM p""")
def vector_math(t: Tables) -> DataFrame:
    v = t.embeddings.select("vec_id", F.col("embedding").alias("x"))
    p = v.join(v.select((F.col("vec_id") - 1).alias("vec_id"), F.col("x").alias("y")), "vec_id")
    return p.select("vec_id", F.round(V.cosine(F.col("x"), F.col("y")), 9).alias("cosine"), F.round(V.distance(F.col("x"), F.col("y")), 9).alias("distance"), F.round(V.norm(F.col("x")), 9).alias("length"))


PAIRS = "p AS (SELECT x.embedding::DOUBLE[] AS a, y.embedding::DOUBLE[] AS b, x.label = y.label AS label FROM embeddings x JOIN embeddings y ON y.vec_id = x.vec_id + 1)"


def pairs(t: Tables) -> DataFrame:
    e = t.embeddings.select("vec_id", "label", F.col("embedding").alias("a"))
    n = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("a").alias("b"), F.col("label").alias("l2"))
    return e.join(n, "vec_id").select("a", "b", (F.col("label") == F.col("l2")).alias("label"))


@query(f"WITH {PAIRS} SELECT count(*) AS pairs, round(avg(((list_cosine_similarity(a, b) > 0.5) = label)::INT) * 100, 6) AS accuracy FROM p")
def pair_accuracy(t: Tables) -> DataFrame:
    return V.pair_accuracy(pairs(t)).withColumn("accuracy", F.round("accuracy", 6))


@query(f"WITH {PAIRS}, c AS (SELECT least(greatest(list_cosine_similarity(a, b), 1e-12), 1.0) AS p, label::INT AS y FROM p) SELECT round(avg(-(y * ln(p) + (1 - y) * ln(greatest(1 - p, 1e-12)))), 6) AS loss FROM c")
def cosine_bce(t: Tables) -> DataFrame:
    return V.cosine_bce(pairs(t).withColumn("label", F.col("label").cast("int"))).withColumn("loss", F.round("loss", 6))


@query(f"""WITH {STREAMS}, j AS (SELECT v.clip, v.frame, s.shift, v.vec, a.vec AS sound FROM v, range(-5, 6) s(shift) LEFT JOIN a ON a.clip = v.clip AND a.frame = v.frame + s.shift)
SELECT clip, shift::INT AS shift, round(avg(CASE WHEN sound IS NULL THEN sqrt(list_inner_product(vec, vec)) ELSE list_distance(vec, sound) END), 6) AS distance FROM j GROUP BY 1, 2""")
def shift_join(t: Tables) -> DataFrame:
    return V.shifted_distances(*streams(t), 5).withColumn("distance", F.round("distance", 6))


@query(f"""WITH {STREAMS}, j AS (SELECT v.clip, v.frame, s.shift, v.vec, a.vec AS sound FROM v, range(-5, 6) s(shift) LEFT JOIN a ON a.clip = v.clip AND a.frame = v.frame + s.shift),
d AS (SELECT clip, shift, round(avg(CASE WHEN sound IS NULL THEN sqrt(list_inner_product(vec, vec)) ELSE list_distance(vec, sound) END), 9) AS d FROM j GROUP BY 1, 2)
SELECT clip, -(arg_min(shift, (d, shift)))::INT AS offset_, round(median(d) - min(d), 6) AS confidence FROM d GROUP BY clip""")
def av_offset(t: Tables) -> DataFrame:
    return V.av_offset(V.shifted_distances(*streams(t), 5)).select("clip", F.col("offset").alias("offset_"), F.round("confidence", 6).alias("confidence"))


@query("""WITH s AS (SELECT user_id % 20 AS video, user_id AS track, event_type, avg(value - 100) AS o, avg(value) AS c FROM events GROUP BY 1, 2, 3),
v AS (SELECT video, trunc(avg(o))::INT AS offset_, avg(c) AS conf FROM s GROUP BY video) SELECT count(*) AS videos, round(avg(offset_), 6) AS mean_offset, round(avg(conf), 6) AS mean_conf FROM v""")
def sync_summary(t: Tables) -> DataFrame:
    """Per video the whole part of the mean offset and the mean confidence over its tracks; then the means of all."""
    s = t.events.groupBy((F.col("user_id") % 20).alias("video"), "user_id", "event_type").agg(F.avg(F.col("value") - 100).alias("o"), F.avg("value").alias("c"))
    v = s.groupBy("video").agg(F.avg("o").cast("int").alias("offset_"), F.avg("c").alias("conf"))
    return v.agg(F.count("*").alias("videos"), F.round(F.avg("offset_"), 6).alias("mean_offset"), F.round(F.avg("conf"), 6).alias("mean_conf"))


COVARIANCE = """WITH u AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, unnest(range(64)) AS i FROM embeddings)
SELECT p.i::INT AS i, q.i::INT AS j, count(*) AS n, round(avg(p.x), 6) AS mean_i, round(avg(q.x), 6) AS mean_j, round(covar_pop(p.x, q.x), 6) AS cov FROM u p JOIN u q ON p.vec_id = q.vec_id AND p.i <= q.i GROUP BY 1, 2"""


@query(COVARIANCE)
def feature_mean_cov(t: Tables) -> DataFrame:
    m = V.mean_cov(V.feature_sums(t.embeddings, "embedding"))
    return m.select("i", "j", "n", *[F.round(c, 6).alias(c) for c in ("mean_i", "mean_j", "cov")])


@query(COVARIANCE)
def merged_statistics(t: Tables) -> DataFrame:
    """Statistics of parts of the table, stored one by one and merged later."""
    parts = [table(V.feature_sums(t.embeddings.filter(F.col("vec_id") % 3 == k), "embedding"), "statistics") for k in range(3)]
    m = V.mean_cov(V.merge_sums(parts[0].union(parts[1]).union(parts[2])))
    return m.select("i", "j", "n", *[F.round(c, 6).alias(c) for c in ("mean_i", "mean_j", "cov")])


@query()
def frechet_distance(t: Tables) -> DataFrame:
    v, a = streams(t)
    return t.spark.createDataFrame([(V.frechet_distance(v, a),)], "distance double")


@query(f"""WITH {STREAMS}, j AS (SELECT v.vec AS x, a.vec AS y, sqrt(list_inner_product(v.vec, v.vec)) AS n, sqrt(list_inner_product(a.vec, a.vec)) AS m FROM v JOIN a USING (frame))
SELECT round(avg(list_sum(list_transform(list_zip(x, y), lambda z: pow(z[1] / n - z[2] / m, 2))) / len(x)), 9) AS drift, count(*) AS pairs FROM j""")
def embedding_drift(t: Tables) -> DataFrame:
    v, a = (x.select(F.col("frame").alias("id"), "vec") for x in streams(t))
    return V.drift(v, a).withColumn("drift", F.round("drift", 9))


@query(f"""WITH {STREAMS}, n AS (SELECT clip, count(*) AS features FROM a GROUP BY clip), x AS (SELECT v.clip, v.frame, floor(v.frame * 2.0)::BIGINT AS mid, features, unnest(range(10)) AS pos FROM v JOIN n USING (clip))
SELECT clip, frame, pos::INT AS pos, greatest(0, least(mid - 4 + pos, features - 1)) AS place FROM x""")
def context_window(t: Tables) -> DataFrame:
    v, a = streams(t)
    length = a.groupBy("clip").agg(F.count("*").alias("features"))
    return V.context_window(v.select("clip", "frame"), length).withColumnRenamed("at", "place")


@query(f"""WITH {STREAMS}, n AS (SELECT clip, count(*) AS features FROM a GROUP BY clip), x AS (SELECT v.clip, v.frame, d.dt, features, (v.frame + d.dt) * 2 AS raw FROM v JOIN n USING (clip), range(-2, 3) d(dt)),
y AS (SELECT *, raw < 1 OR raw > features - 1 AS edge, greatest(0, least(raw, features - 1)) AS here FROM x)
SELECT clip, frame, ((dt + 2) * 2 + k)::INT AS pos, CASE WHEN k = 1 OR edge THEN here ELSE here - 1 END AS place FROM y, range(2) r(k)""")
def sparse_window(t: Tables) -> DataFrame:
    v, a = streams(t)
    length = a.groupBy("clip").agg(F.count("*").alias("features"))
    return V.sparse_window(v.select("clip", "frame"), length).withColumnRenamed("at", "place")


@query(f"WITH {STREAMS}, n AS (SELECT clip, count(*) AS features FROM a GROUP BY clip) SELECT clip, unnest(range(0, features // 2 + 2))::INT AS frame FROM n")
def window_chunks(t: Tables) -> DataFrame:
    return V.window_chunks(streams(t)[1].groupBy("clip").agg(F.count("*").alias("features")))


@query(f"""WITH {STREAMS}, n AS (SELECT clip, count(*) AS features FROM a GROUP BY clip), s AS (SELECT clip, frame AS start, unnest(range(16)) AS place FROM v),
x AS (SELECT clip, start, place, (start + place) * 2 AS mid, features, unnest(range(10)) AS pos FROM s JOIN n USING (clip))
SELECT clip, start, place::INT AS place, pos::INT AS pos, greatest(0, least(mid - 4 + pos, features - 1)) AS feature FROM x""")
def frame_stack(t: Tables) -> DataFrame:
    """Stacks of 16 frames with the features around each frame."""
    v, a = streams(t)
    length = a.groupBy("clip").agg(F.count("*").alias("features"))
    s = V.frame_stack(v.select("clip", F.col("frame").alias("start")), 16)
    w = V.context_window(s.select("clip", "frame").distinct(), length)
    return s.join(w, ["clip", "frame"]).select("clip", "start", "place", "pos", F.col("at").alias("feature"))
