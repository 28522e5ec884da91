"""File formats, streams, and that the rest stands without the training-data subpackage."""

import datetime
import json
import os
import subprocess
import sys
from pathlib import Path

import pandas as pd
import pytest
from pyspark.sql import functions as F

from voxlake.operators import dictionary, segments, signal
from voxlake.plans import catalog
from voxlake.plans import streams as plans
from voxlake.sources import list_media, list_runs, pending, quarantine, read_path_list, read_pipe_corpus, read_segments, split_quarantine, write_path_list, write_segments, write_text
from voxlake.streaming import turns as streams

ROOT = Path(__file__).resolve().parents[1]


def test_documents_and_bare_lists(spark, tmp_path):
    seg = [{"segment_id": f"segment00{i}", "speaker": "A", "start_time": i * 1.0, "end_time": i + 0.5, "duration": 0.5} for i in (1, 2)]
    (tmp_path / "a.json").write_text(json.dumps({"audio_file": "x.wav", "total_segments": 2, "speakers": ["A"], "segments": seg}))
    (tmp_path / "b.json").write_text(json.dumps(seg[:1]))
    got = sorted((r.recording, r.segment_id) for r in read_segments(spark, str(tmp_path)).collect())
    assert got == [("b.json", "segment001"), ("x.wav", "segment001"), ("x.wav", "segment002")]


def test_lists_and_corpora(spark, tmp_path):
    (tmp_path / "m.csv").write_text('a.wav|He said "so".\nb.wav|x\n')
    assert [r.text for r in read_pipe_corpus(spark, str(tmp_path / "m.csv")).collect()] == ['He said "so".', "x"]
    paths = spark.createDataFrame([("p/1.mp4",), ("p/2.mp4",)], "path string")
    write_path_list([paths, paths.limit(1)], str(tmp_path / "list"))
    assert read_path_list(spark, str(tmp_path / "list")).count() == 3
    assert pending(paths, paths.limit(1)).count() == 1
    for n in ("a.mp4", "b.txt", "sub/c.WAV"):
        (tmp_path / "media" / n).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "media" / n).write_bytes(b"x")
    assert [Path(r.path).name for r in list_media(spark, str(tmp_path / "media")).collect()] == ["a.mp4", "c.WAV"]


def test_written_documents(spark, tmp_path):
    t = spark.createDataFrame([(1, "A", 0.0, 1.0, 1.0, 0), (2, "B", 0.0, 2.0, 2.0, 1)], "recording long, speaker string, start_time double, end_time double, duration double, seq long")
    write_segments(segments.stage_document(segments.number(t)), str(tmp_path / "d"))
    back = spark.read.json(str(tmp_path / "d"))
    assert back.count() == 2 and back.select(F.explode("segments.segment_id")).distinct().count() == 1
    write_text(spark.createDataFrame([(1, "a\nb")], "recording long, value string"), str(tmp_path / "t"))
    assert spark.read.text(str(tmp_path / "t")).count() == 2
    bad = quarantine(spark.createDataFrame([('{"a": "1"}',), ("{",)], "j string"), F.col("j"), "MAP<STRING, STRING>")
    assert [r.ok for r in bad.collect()] == [True, False]


def test_ingest_sees_files_once(spark, tmp_path):
    args = [str(tmp_path / x) for x in ("out", "state")]
    for k in range(2):
        spark.range(k * 10, k * 10 + 10).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        assert streams.ingest(spark, str(tmp_path / "in"), "id long", *args) == 10
    assert streams.ingest(spark, str(tmp_path / "in"), "id long", *args) == 0
    assert spark.read.parquet(args[0]).count() == 20


def test_stream_of_turns_equals_the_batch(spark):
    t = catalog.Tables(spark, "/root/testdata/sf0.001")
    from voxlake.plans import segments as turns

    got = catalog.QUERIES["stream_turn_merge"](spark, t.folder)
    want = segments.merge_turns(turns.turns(t), turns.GAP)
    last = t.events.agg(F.max("ts")).first()[0].timestamp()
    rows = lambda df, c: {(r.recording, r.speaker, round(r.start_time, 3), round(r.end_time, 3), r.turns) for r in df.collect() if c(r)}
    closed = lambda r: r.end_time + turns.GAP < last - 120
    assert rows(got, closed) == rows(want, closed) and got.count() > 0.8 * want.count()


def test_ingest_counts_every_batch(spark, tmp_path):
    """More batches than a query's progress keeps."""
    spark.range(0, 120, 1, 120).write.parquet(str(tmp_path / "in"))
    assert len(list((tmp_path / "in").glob("*.parquet"))) == 120
    assert streams.ingest(spark, str(tmp_path / "in"), "id long", str(tmp_path / "out"), str(tmp_path / "state"), files=1) == 120


def test_late_rows_are_merged_in_their_place(spark, tmp_path):
    """Rows that come a batch later than their successors, but within the watermark, give the batch's turns."""
    kind = "recording long, speaker string, start_time double, end_time double, seq long, ts timestamp"
    at = lambda x: datetime.datetime.fromtimestamp(x, datetime.UTC)
    rows = [(1, s, float(a), a + 5.0, i, at(a)) for i, (s, a) in enumerate([("A", 1000), ("A", 1010), ("B", 1020), ("A", 1030), ("A", 1037), ("A", 5000), ("A", 9000)])]
    for k, part in enumerate(([0, 3], [1, 4], [2], [5], [6])):
        spark.createDataFrame([rows[i] for i in part], kind).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        new = [f for f in (tmp_path / "in").glob("part-*.parquet") if f.stat().st_mtime > 1e6]
        for f in new:  # files are read in the order of their times
            os.utime(f, (k, k))
    s = spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    own = spark.conf.get(streams.ROCKSDB[0], None)
    with plans.setting(spark, *streams.ROCKSDB):
        got = plans.finish(streams.merge_stream(s, 10.0, "10 minutes"), "late")
    assert spark.conf.get(streams.ROCKSDB[0], None) == own
    want = [("A", 1000.0, 1015.0, 2), ("B", 1020.0, 1025.0, 1), ("A", 1030.0, 1042.0, 2), ("A", 5000.0, 5005.0, 1)]
    assert sorted((r.start_time, r.speaker, r.end_time, r.turns) for r in got.collect()) == [(a, s, z, n) for s, a, z, n in want]


def test_rows_that_are_too_late_come_out_alone(spark, tmp_path):
    """A row whose place has been merged over is not lost: it comes out marked, in a table of its own."""
    kind = "recording long, speaker string, start_time double, end_time double, seq long, ts timestamp"
    at = lambda x: datetime.datetime.fromtimestamp(x, datetime.UTC)
    parts = [[(1, "A", 1000.0, 1005.0), (1, "A", 1010.0, 1012.0)], [(1, "A", 9000.0, 9001.0)], [(1, "B", 20_000.0, 20_001.0)], [(1, "C", 1003.0, 1004.0), (2, "C", 1003.0, 1004.0)], [(3, "D", 40_000.0, 40_001.0)]]
    for k, part in enumerate(parts):
        df = spark.createDataFrame([(*r, k, at(r[2])) for r in part], kind)
        df.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        for f in (f for f in (tmp_path / "in").glob("part-*.parquet") if f.stat().st_mtime > 1e6):
            os.utime(f, (k, k))
    s = spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    with plans.setting(spark, *streams.ROCKSDB):
        got = plans.finish(streams.merge_stream(s, 10.0, "10 minutes"), "turns", "late")
    rows = lambda df: sorted((r.recording, r.speaker, r.start_time, r.turns) for r in df.collect())
    assert rows(got.filter("late")) == [(1, "C", 1003.0, 1)] and got.filter("late").count() == 1
    assert rows(got.filter("not late")) == [(1, "A", 1000.0, 2), (1, "A", 9000.0, 1), (1, "B", 20_000.0, 1), (2, "C", 1003.0, 1)]


def test_waiting_rows_are_read_once():
    """A timer reads the slots that are ready, not all rows that wait."""
    from voxlake.streaming.turns import TurnMerger

    class State(dict):
        reads = 0

        exists = lambda self: bool(self)
        get = lambda self: self["v"]
        clear = lambda self: dict.clear(self)
        update = lambda self, v: self.__setitem__("v", v)
        containsKey = dict.__contains__
        updateValue = dict.__setitem__
        removeKey = dict.__delitem__

        def getValue(self, k):
            State.reads += len(self[k][0])
            return self[k]

    class Handle:
        timers = set()
        getValueState = getMapState = lambda self, *a: State()
        registerTimer = lambda self, t: self.timers.add(t)

    class Mark:
        def __init__(self, t):
            self.getCurrentWatermarkInMs = lambda: t

    m, n, out = TurnMerger(10.0), 5000, []
    m.init(Handle())
    frame = pd.DataFrame({"start_time": [float(5 * i) for i in range(n)], "seq": range(n), "speaker": ["A" if i % 10 else "B" for i in range(n)], "end_time": [5.0 * i + 1 for i in range(n)]})
    list(m.handleInputRows((1,), iter([frame.sample(frac=1, random_state=1)]), None))
    for mark in range(0, 30_000_000, 500_000):
        while due := [t for t in Handle.timers if t <= mark]:
            Handle.timers.remove(due[0])
            out += [x for x in m.handleExpiredTimer((1,), Mark(mark), None) if len(x)]
    out = pd.concat(out)
    assert len(out) == 1000 and out.turns.sum() == n and State.reads == n and not m.slots and not Handle.timers


def test_quarantine(spark, tmp_path):
    """Valid JSON of another shape is set apart as well, and both outputs are read back from one pass."""
    texts = ['{"a": "1"}', "[1,2]", "7", '"x"', "{", "", None, "null", ' {"a": null} ', '{"a": {"b": 1}}', "true", '{"a": "1"}{', '{"a": "1"}]', '{"a": "1"} x', '{"a": "1"}, {}']
    df = spark.createDataFrame(list(enumerate(texts)), "id long, j string")
    good, bad = split_quarantine(df, F.col("j"), "MAP<STRING, STRING>", str(tmp_path / "q"))
    assert [r.id for r in good.orderBy("id").collect()] == [0, 8, 9] and good.filter("parsed['a'] = '1'").count() == 1
    assert [(r.id, r.broken) for r in bad.orderBy("id").collect()] == [(i, texts[i]) for i in (1, 2, 3, 4, 5, 6, 7, *range(10, 15))]
    record = spark.createDataFrame([(k, x) for k, x in enumerate(['{"a": 1, "b": "x"}', '{"a": "one"}', '{"b": "x", "c": 2}', "[1]", '[{"a": 1}]', "3", "{}"])], "id long, j string")
    got = quarantine(record, F.col("j"), "a INT, b STRING").orderBy("id").collect()
    assert [r.ok for r in got] == [True, False, True, False, False, False, True] and got[0].parsed.asDict() == {"a": 1, "b": "x"} and got[1].parsed is None
    lists = spark.createDataFrame([(0, "[1, 2]"), (1, '{"a": 1}'), (2, "[]"), (3, "5")], "id long, j string")
    assert [r.ok for r in quarantine(lists, F.col("j"), "ARRAY<INT>").orderBy("id").collect()] == [True, False, True, False]


def test_runs_are_listed_without_reading(spark, tmp_path):
    spark.range(100).withColumn("run", F.format_string("2024%02d", F.col("id") % 12 + 1)).write.partitionBy("run").parquet(str(tmp_path / "t"))
    for f in (tmp_path / "t").rglob("*.parquet"):
        f.write_bytes(b"not parquet")  # a reader would fail
    got = list_runs(spark, str(tmp_path / "t"), "202403", "202405")
    assert [r.run for r in got.orderBy("run").collect()] == ["202403", "202404", "202405"]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run" in plan and "202403" in plan


def test_samples_of_frames(spark):
    """Frames cut from blocks of several sizes, with holes and beyond the end."""
    values = [float(i) for i in range(1000)]
    s = spark.createDataFrame([(1, i, v) for i, v in enumerate(values)], "clip long, at long, value double")
    ranges = [(1, 0, 0, 7), (1, 1, 7, 40), (1, 2, 990, 1010), (1, 3, 2000, 2010), (1, 4, 5, 5), (1, 5, None, 9), (2, 0, 0, 5), (1, 6, 63, 64), (1, 7, 0, 1000)]
    r = spark.createDataFrame(ranges, "clip long, frame long, start long, end long")
    want = {(c, f): values[a:z] if c == 1 and a is not None else [] for c, f, a, z in ranges}
    for size in (1, 7, 64, 5000):
        got = signal.frame_samples(r, signal.sample_blocks(s, size), size)
        assert {(x.clip, x.frame): x.samples for x in got.collect()} == want
    lost = signal.frame_samples(r.filter("frame = 1"), signal.sample_blocks(s, 7).filter("block <> 2"), 7).first().samples
    assert lost == values[7:14] + values[21:40]


@pytest.mark.parametrize("entries, characters", [(10**6, 10**9), (150, 10**9), (10, 10**9), (10**6, 100)])
def test_dictionaries(spark, monkeypatch, entries, characters):
    """Broadcast, cut to the entries that are used, or joined: the same rows. 100,000 entries, repeated and null ones."""
    monkeypatch.setattr(dictionary, "ENTRIES", entries)
    monkeypatch.setattr(dictionary, "CHARACTERS", characters)
    d = spark.range(100_000).select(F.concat(F.lit("w"), "id").alias("key"), F.concat(F.lit("x"), "id").alias("to"))
    d = d.union(spark.createDataFrame([("w5", "a"), ("w6", "zz"), (None, "n"), ("gone", None)], "key string, to string"))
    lists = [["w5", "keep", "w6", "w5"], [], None, ["gone", None, "w99999", ""], [f"w{i}" for i in range(100, 220)]]
    rows = spark.createDataFrame([(i, x, "own") for i, x in enumerate(lists)], "id long, parts array<string>, key string").repartition(2)
    want = {"w5": "a", "w6": "x6", "w99999": "x99999"} | {f"w{i}": f"x{i}" for i in range(100, 220)}
    got = dictionary.map_parts(rows, "parts", d)
    assert got.columns == rows.columns
    assert [(r.id, r.parts, r.key) for r in got.orderBy("id").collect()] == [(i, x and [want.get(w, w) for w in x], "own") for i, x in enumerate(lists)]
    assert dictionary.map_parts(rows, "parts", d.limit(0)).count() == 5 and dictionary.map_parts(rows.limit(0), "parts", d).count() == 0


def test_stands_alone(tmp_path):
    """Without the subpackage and the pipeline everything else imports, and other errors are not hidden."""
    code = "import sys; sys.modules['voxlake.llm'] = None; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; q = e.queries(); assert 'turn_merge' in q and not any(k.startswith('op') for k in q); assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
