"""Streams and models over the given tables. A bounded stream is run to its end, so its rows equal the batch's."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.models import apply_model
from ..sources.shared import new_path as scratch
from ..streaming import turns as J
from .catalog import Tables, query
from .segments import GAP


def finish(stream: DataFrame, name: str, parted_by: str | None = None) -> DataFrame:
    """Run a bounded stream to its end into a table, with a folder for each value of a column if one is named, and read that."""
    spark, path = stream.sparkSession, scratch(stream.sparkSession, name)
    w = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", f"{path}-state")
    q = (w.partitionBy(parted_by) if parted_by else w).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def events_stream(t: Tables) -> DataFrame:
    """The events table as a stream of files."""
    folder = t.spark.read.parquet(f"{t.folder}/events.parquet")
    path = scratch(t.spark, "events")
    folder.withColumn("ts", F.col("ts").cast("timestamp")).write.parquet(path)
    return t.spark.readStream.schema(folder.withColumn("ts", F.col("ts").cast("timestamp")).schema).parquet(path)


@query("""WITH m AS (SELECT max(ts) - INTERVAL 1 MINUTE AS mark FROM events), w AS (SELECT time_bucket(INTERVAL 1 HOUR, ts, TIMESTAMP '1970-01-01') AS start, event_type AS speaker, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2)
SELECT epoch(start)::BIGINT AS start_s, speaker, n, total FROM w, m WHERE start + INTERVAL 1 HOUR <= mark""")
def stream_fixed_windows(t: Tables) -> DataFrame:
    """Hourly windows as a stream: a window is there once the watermark has passed its end."""
    e = events_stream(t).select("ts", F.col("event_type").alias("speaker"), "value")
    out = finish(J.window_stream(e, "1 hour"), "windows")
    return out.select(F.unix_seconds("start").alias("start_s"), "speaker", "n", F.round("total", 4).alias("total"))


@query("SELECT count(*) AS read_rows, 0::BIGINT AS again FROM events")
def incremental_ingest(t: Tables) -> DataFrame:
    """Files are copied once: a second run finds nothing new."""
    base = scratch(t.spark, "ingest")
    t.events.write.parquet(f"{base}/in")
    schema = t.events.schema.simpleString()[7:-1].replace(":", " ")
    J.ingest(t.spark, f"{base}/in", schema, f"{base}/out", f"{base}/state")
    again = J.ingest(t.spark, f"{base}/in", schema, f"{base}/out", f"{base}/state")
    return t.spark.read.parquet(f"{base}/out").agg(F.count("*").alias("read_rows")).withColumn("again", F.lit(again).cast("long"))


@query("SELECT doc_id, CASE WHEN doc_id % 10 <> 7 THEN len(text) END AS chars, doc_id % 10 <> 7 AS success, CASE WHEN doc_id % 10 = 7 THEN 'ValueError: cannot read ' || doc_id END AS error FROM documents")
def apply_model_rows(t: Tables) -> DataFrame:
    """A model that fails on some rows: they stay, with the error."""

    def load():
        def model(rows: pd.DataFrame) -> pd.DataFrame:
            bad = rows.loc[rows["doc_id"] % 10 == 7, "doc_id"]
            if len(bad):
                raise ValueError(f"cannot read {bad.iloc[0]}")
            return pd.DataFrame({"chars": rows["text"].str.len()})

        return model

    out = apply_model(t.documents.select("doc_id", "text"), load, T.StructType([T.StructField("chars", T.LongType())]))
    return out.select("doc_id", "chars", "success", "error")


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting for as long as a stream runs; the caller's own comes back."""
    own = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, own) if own is not None else spark.conf.unset(key)


@query(f"""WITH t AS (SELECT user_id AS recording, event_type AS speaker, epoch_us(ts) / 1000000.0::DOUBLE AS start_time, epoch_us(ts) / 1000000.0::DOUBLE + value AS end_time, event_id AS seq FROM events),
m AS (SELECT *, CASE WHEN lag(speaker) OVER w = speaker AND start_time - lag(end_time) OVER w <= {GAP} THEN 0 ELSE 1 END AS new FROM t WINDOW w AS (PARTITION BY recording ORDER BY start_time, seq)),
i AS (SELECT *, sum(new) OVER (PARTITION BY recording ORDER BY start_time, seq) AS island FROM m),
j AS (SELECT recording, island, min(speaker) AS speaker, min(start_time) AS start_time, arg_max(end_time, (start_time, seq)) AS end_time, count(*) AS turns, count(*) OVER (PARTITION BY recording) AS islands FROM i GROUP BY recording, island),
k AS (SELECT *, lead(start_time) OVER (PARTITION BY recording ORDER BY island) AS next, (SELECT max(epoch_us(ts)) // 1000 - 60000 FROM events) AS mark FROM j)
SELECT recording, speaker, round(start_time, 3) AS start_time, round(end_time, 3) AS end_time, turns, false AS late FROM k
WHERE (floor((end_time + {GAP}) / {J.SLOT}) + 1) * {J.SLOT} * 1000 + 1 <= mark OR (floor(next / {J.SLOT}) + 1) * {J.SLOT} * 1000 + 1 <= mark""")
def stream_turn_merge(t: Tables) -> DataFrame:
    """Turn merging as a stream, one state per recording; turns come once the watermark has closed them. No row is late here."""
    start = F.unix_micros("ts") / F.lit(1e6)
    e = events_stream(t).select(F.col("user_id").alias("recording"), F.col("event_type").alias("speaker"), start.alias("start_time"), (start + F.col("value")).alias("end_time"), F.col("event_id").alias("seq"), "ts")
    with setting(t.spark, *J.ROCKSDB):
        out = finish(J.merge_stream(e, GAP, "1 minute"), "turns")
    return out.withColumns({c: F.round(c, 3) for c in ("start_time", "end_time")})
