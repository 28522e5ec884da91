"""Queries that read documents, parts and orders as clips."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import sources
from ..operators import curation as C
from ..sources import list_runs, pending, split_quarantine
from .catalog import Tables, query
from .streams import scratch


@query("SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def pending_inputs(t: Tables) -> DataFrame:
    return pending(t.documents.select("doc_id", "source"), t.labels, "doc_id")


MIXED = "CASE event_id % 6 WHEN 0 THEN props || '{' WHEN 1 THEN '[' || props || ']' WHEN 2 THEN event_id::VARCHAR WHEN 3 THEN NULL ELSE props END"


@query(f"SELECT event_id, coalesce(json_valid(x) AND json_type(CASE WHEN json_valid(x) THEN x END) = 'OBJECT', false) AS ok, CASE WHEN event_id % 6 > 3 THEN length(props) END AS good_length, CASE WHEN event_id % 6 < 3 THEN length(x) END AS bad_length FROM (SELECT event_id, props, {MIXED} AS x FROM events)")
def quarantine_split(t: Tables) -> DataFrame:
    """Events whose properties are a JSON object, and the others: broken, a list, a number or null on purpose. Both outputs are
    written in one pass and read back."""
    k = F.col("event_id") % 6
    text = F.when(k == 0, F.concat("props", F.lit("{"))).when(k == 1, F.concat(F.lit("["), "props", F.lit("]"))).when(k == 2, F.col("event_id").cast("string")).when(k == 3, None).otherwise(F.col("props"))
    good, bad = split_quarantine(t.events.select("event_id", "props"), text, "MAP<STRING, STRING>", scratch(t.spark, "quarantine"))
    good = good.select("event_id", F.col("parsed").isNotNull().alias("ok"), F.length("props").alias("good_length"), F.lit(None).cast("int").alias("bad_length"))
    return good.unionByName(bad.select("event_id", F.lit(False).alias("ok"), F.lit(None).cast("int").alias("good_length"), F.length("broken").alias("bad_length")))


@query("SELECT strftime(o_orderdate, '%Y%m') AS run, true AS stored FROM orders WHERE strftime(o_orderdate, '%Y%m') BETWEEN '199406' AND '199609' GROUP BY 1")
def expired_partitions(t: Tables) -> DataFrame:
    """Runs of a table that is partitioned by run, found without opening a file of it."""
    path = scratch(t.spark, "runs")
    run = F.date_format("o_orderdate", "yyyyMM")
    t.orders.select("o_orderkey", run.alias("run")).repartition("run").write.partitionBy("run").parquet(path)
    return list_runs(t.spark, path, "199406", "199609").select("run", (F.col("bytes") > 0).alias("stored"))


@query("SELECT doc_id, n_chars / 25.0::DOUBLE AS seconds FROM documents")
def media_duration(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", (F.col("n_chars") / F.lit(25.0)).alias("seconds"))


@query("SELECT 'doc/' || doc_id AS path FROM documents UNION ALL SELECT 'page/' || page_id FROM pages")
def write_path_list(t: Tables) -> DataFrame:
    """Two lists of paths written as one text list; the rows are the lines of the written files."""
    path = scratch(t.spark, "path-list")
    lists = [t.documents.select(F.concat(F.lit("doc/"), "doc_id").alias("path")), t.pages.select(F.concat(F.lit("page/"), "page_id").alias("path"))]
    sources.write_path_list(lists, path)
    return t.spark.read.text(path).withColumnRenamed("value", "path")


@query("SELECT source AS worker, count(*) AS items FROM (SELECT source FROM documents UNION ALL SELECT 'bench' FROM benchmark) GROUP BY 1")
def union_results(t: Tables) -> DataFrame:
    return t.documents.select("source").unionByName(t.benchmark.select(F.lit("bench").alias("source"))).groupBy(F.col("source").alias("worker")).agg(F.count("*").alias("items"))


def frames(t: Tables) -> DataFrame:
    return t.lineitem.select(F.col("l_orderkey").alias("clip"), F.col("l_linenumber").alias("frame"), (F.col("l_partkey") % 20 == 0).cast("int").alias("zero"), (F.lit(60) + F.col("l_quantity")).cast("int").alias("width"), (F.lit(100) + F.col("l_suppkey") % 40).cast("int").alias("height")).withColumn("faces", 1 - F.col("zero"))


GATE = """WITH f AS (SELECT l_orderkey AS clip, CASE WHEN l_partkey % 20 = 0 THEN 0 ELSE 1 END AS faces, 60 + l_quantity::INT AS width, 100 + l_suppkey % 40 AS height FROM lineitem),
g AS (SELECT clip, bool_and(faces = 1 AND width >= {n} AND height >= {n}) AS ok FROM f GROUP BY clip)
SELECT o_orderkey AS clip, coalesce(ok, false) AS kept FROM orders LEFT JOIN g ON clip = o_orderkey"""


@query(GATE.format(n=70))
def resolution_gate(t: Tables) -> DataFrame:
    return C.single_face(frames(t), t.orders.select(F.col("o_orderkey").alias("clip")), 70)


@query(GATE.format(n=0))
def single_face_gate(t: Tables) -> DataFrame:
    return C.single_face(frames(t), t.orders.select(F.col("o_orderkey").alias("clip")))


@query("SELECT p_partkey, CASE WHEN 20 + p_size % 10 = 25 THEN 'copy' ELSE 'resample' END AS video, CASE WHEN 8000 * (1 + p_size % 3) = 16000 THEN 'copy' ELSE 'resample' END AS audio FROM part")
def resample_plan(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", C.resample_plan(20 + F.col("p_size") % 10, 8000 * (1 + F.col("p_size") % 3)).alias("x")).select("p_partkey", "x.*")


@query("""WITH s AS (SELECT p_partkey, p_retailprice / 300 AS conf, p_size % 17 - 8 AS o FROM part)
SELECT p_partkey, conf >= 3 AND abs(o) <= 6 AS keep, CASE WHEN NOT (conf >= 3 AND abs(o) <= 6) THEN 'drop' WHEN o = 0 THEN 'copy' ELSE 'shift' END AS action, CASE WHEN conf >= 3 AND abs(o) <= 6 THEN o / 25.0::DOUBLE END AS shift FROM s""")
def sync_gate(t: Tables) -> DataFrame:
    g = C.sync_gate(F.col("p_retailprice") / 300, F.col("p_size") % 17 - 8)
    return t.part.select("p_partkey", g.alias("g")).select("p_partkey", "g.*")


FRAMES = "f AS (SELECT l_orderkey AS clip, l_linenumber * 1000000 + l_partkey AS frame, max(l_quantity) * 1.5 AS score FROM lineitem GROUP BY 1, 2), i AS (SELECT *, count(*) OVER (PARTITION BY clip) AS n, row_number() OVER (PARTITION BY clip ORDER BY frame) - 1 AS i FROM f)"


def scored(t: Tables) -> DataFrame:
    return t.lineitem.groupBy(F.col("l_orderkey").alias("clip"), (F.col("l_linenumber") * 1000000 + F.col("l_partkey")).alias("frame")).agg((F.max("l_quantity") * 1.5).alias("score"))


@query(f"WITH {FRAMES} SELECT clip, round(avg(score), 6) AS score, avg(score) >= 40 AS kept FROM i WHERE i = 0 OR i = n // 2 OR i = n - 1 GROUP BY clip")
def quality_gate(t: Tables) -> DataFrame:
    return C.quality_gate(scored(t)).withColumn("score", F.round("score", 6))


@query(f"WITH {FRAMES} SELECT clip, frame, CASE WHEN i = 0 THEN 'first' WHEN i = n - 1 THEN 'last' ELSE 'middle' END AS probe FROM i WHERE i = 0 OR i = n // 2 OR i = n - 1")
def probe_frames(t: Tables) -> DataFrame:
    return C.probe_frames(scored(t)).select("clip", "frame", "probe")


@query("SELECT doc_id, n_chars >= 32 AS sync, n_chars >= 48 AS reference, n_chars > 160 AS folder FROM documents")
def length_gate(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", C.length_gate(F.col("n_chars"), 16, 10).alias("x")).select("doc_id", "x.*")


@query("SELECT l_orderkey, l_linenumber, place FROM (SELECT l_orderkey, l_linenumber, CASE WHEN i < 0 THEN i + n ELSE i END AS place, n FROM (SELECT l_orderkey, l_linenumber, l_partkey % 101 - 50 AS i, l_quantity::BIGINT AS n FROM lineitem)) WHERE place >= 0 AND place < n")
def normalize_index(t: Tables) -> DataFrame:
    at = C.normalize_index(F.col("l_partkey") % 101 - 50, F.col("l_quantity").cast("long"))
    return t.lineitem.select("l_orderkey", "l_linenumber", at.alias("place")).filter("place is not null")


@query("""WITH c AS (SELECT n_chars >= 300 AS a, lang = 'en' AS b, coalesce(quality = 1, false) AS c, coalesce(toxic = 0, false) AS d FROM documents LEFT JOIN labels USING (doc_id)),
n AS (SELECT count(*) AS n0, count(*) FILTER (a) AS n1, count(*) FILTER (a AND b) AS n2, count(*) FILTER (a AND b AND c) AS n3, count(*) FILTER (a AND b AND c AND d) AS n4 FROM c)
SELECT 1 AS step, 'long' AS stage, n0 AS total, n1 AS kept FROM n UNION ALL SELECT 2, 'english', n1, n2 FROM n UNION ALL SELECT 3, 'good', n2, n3 FROM n UNION ALL SELECT 4, 'clean', n3, n4 FROM n""")
def stage_funnel(t: Tables) -> DataFrame:
    c = t.documents.join(t.labels, "doc_id", "left")
    return C.stage_funnel(c, [("long", F.col("n_chars") >= 300), ("english", F.col("lang") == "en"), ("good", F.col("quality") == 1), ("clean", F.col("toxic") == 0)])


KEY = "md5(concat_ws(':', {c}, '{seed}'))"


@query(f"""WITH l AS (SELECT lang AS grp, doc_id AS item FROM documents), r AS (SELECT lang AS grp, doc_id AS item FROM documents WHERE source IN ('src1', 'src2')),
a AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY {KEY.format(c='item', seed=3)}, item) AS place FROM l), b AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY {KEY.format(c='item', seed=4)}, item) AS place FROM r)
SELECT a.grp, place, a.item AS left, b.item AS right FROM a JOIN b USING (grp, place)""")
def random_pairing(t: Tables) -> DataFrame:
    d = t.documents.select(F.col("lang").alias("grp"), F.col("doc_id").alias("item"), "source")
    return C.random_pairing(d, d.filter("source in ('src1', 'src2')"), 3)


def pick_sql(n: str, seed: int, c: str = "clip") -> str:
    return f"(('0x' || left({KEY.format(c=c, seed=seed)}, 8))::BIGINT % ({n}))"


@query(f"""WITH c AS (SELECT doc_id AS clip, n_chars AS frames FROM documents WHERE n_chars >= 48), s AS (SELECT *, {pick_sql('frames - 15', 5)} AS start FROM c),
w AS (SELECT *, (start + 1 + {pick_sql('frames - 16', 6)}) % (frames - 15) AS wrong, {pick_sql('2', 7)}::INT AS y, greatest(start - 15, 0) AS low, greatest(frames - 16 - (start + 16) + 1, 0) AS high FROM s),
p AS (SELECT *, {pick_sql('low + high', 8)} AS pick FROM w)
SELECT clip, frames, start, wrong, y, CASE WHEN pick < low THEN pick ELSE start + 16 + pick - low END AS reference, CASE WHEN y = 1 THEN start ELSE wrong END AS other FROM p""")
def training_pairs(t: Tables) -> DataFrame:
    return C.training_pairs(t.documents.select(F.col("doc_id").alias("clip"), F.col("n_chars").alias("frames")), 16, 5)


@query(f"SELECT source AS video, arg_min(doc_id, ({KEY.format(c='doc_id', seed=9)}, doc_id)) AS clip, count(*) AS clips FROM documents GROUP BY source")
def one_random_clip(t: Tables) -> DataFrame:
    return C.one_random_clip(t.documents.select(F.col("source").alias("video"), F.col("doc_id").alias("clip")), 9)


@query("SELECT doc_id, ntile(7) OVER (PARTITION BY source ORDER BY doc_id) AS part, ((row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) // 4 % 3)::INT AS worker FROM documents")
def even_partition(t: Tables) -> DataFrame:
    d = C.even_partition(t.documents.select("doc_id", "source"), 7, "doc_id", "source")
    return C.round_robin(d, 4, 3, "doc_id", "source").select("doc_id", "part", "worker")


@query("WITH i AS (SELECT user_id AS clip, event_id AS frame, count(*) OVER (PARTITION BY user_id) AS n, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS i FROM events) SELECT clip, frame FROM i WHERE i % greatest(1, n // 10) = 0")
def stride_sample(t: Tables) -> DataFrame:
    return C.stride_sample(t.events.select(F.col("user_id").alias("clip"), F.col("event_id").alias("frame")), 10)


@query("SELECT doc_id AS clip, CASE WHEN quality IS NOT NULL THEN quality::DOUBLE ELSE n_chars / 2.0 END AS feature, quality IS NOT NULL AS cached FROM documents LEFT JOIN labels USING (doc_id)")
def feature_cache(t: Tables) -> DataFrame:
    wanted = t.documents.select(F.col("doc_id").alias("clip"), "n_chars")
    cached = t.labels.select(F.col("doc_id").alias("clip"), F.col("quality").cast("double").alias("feature"))
    return C.feature_cache(wanted, cached, lambda m: m.withColumn("feature", F.col("n_chars") / 2.0)).select("clip", "feature", "cached")


@query("SELECT round(sum(n_chars / 25.0), 3) AS seconds, round(sum(n_chars / 25.0) / 3600, 2) AS hours FROM documents")
def corpus_hours(t: Tables) -> DataFrame:
    s = F.sum(F.col("n_chars") / 25.0)
    return t.documents.agg(F.round(s, 3).alias("seconds"), F.round(s / 3600, 2).alias("hours"))


@query("WITH r AS (SELECT l_suppkey % 7 AS run, l_linenumber AS step, l_partkey % 4 AS rank, sum(l_discount) AS loss FROM lineitem GROUP BY 1, 2, 3) SELECT run, step, round(avg(loss), 6) AS loss, count(*) AS ranks FROM r GROUP BY 1, 2")
def metric_rollup(t: Tables) -> DataFrame:
    steps = t.lineitem.select((F.col("l_suppkey") % 7).alias("run"), F.col("l_linenumber").alias("step"), (F.col("l_partkey") % 4).alias("rank"), F.col("l_discount").alias("loss"))
    return C.metric_rollup(steps).withColumn("loss", F.round("loss", 6))


@query("WITH i AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS i, count(*) OVER (PARTITION BY source) AS n FROM documents) SELECT doc_id, source FROM i WHERE i <= n // 8 * 8")
def bounded_eval(t: Tables) -> DataFrame:
    """Whole batches of eight of each source; the incomplete last one is left out."""
    return C.whole_batches(t.documents.select("doc_id", "source"), 8, "doc_id", "source")


@query("WITH f AS (SELECT p_partkey, 'run/' || p_brand || '/frame_' || p_partkey || '.png' AS path, p_brand AS folder FROM part) SELECT path, row_number() OVER (PARTITION BY folder ORDER BY regexp_extract(path, '_([0-9]+)\\.png$', 1)::BIGINT) AS place FROM f")
def natural_frame_sort(t: Tables) -> DataFrame:
    path = F.concat(F.lit("run/"), "p_brand", F.lit("/frame_"), "p_partkey", F.lit(".png"))
    return C.natural_order(t.part.select(path.alias("path"), F.col("p_brand").alias("folder"))).select("path", "place")
