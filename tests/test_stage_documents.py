"""Stage documents of many recordings: lines of a few files."""

from pathlib import Path

import pytest

from voxlake.operators import segments
from voxlake.plans import catalog
from voxlake.plans import segments as turns
from voxlake.sources import read_segments, write_segments


def test_files_do_not_grow_with_recordings(spark):
    """The query writes a file a task, not one for each of its 15 recordings."""
    shared = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file://"))
    before = set(shared.glob("stage-documents-*"))
    got = catalog.QUERIES["read_segments"](spark, "/root/testdata/sf0.001")
    (path,) = set(shared.glob("stage-documents-*")) - before
    assert 1 <= len(list(path.rglob("*.json"))) <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    want = turns.merged(catalog.Tables(spark, "/root/testdata/sf0.001"))
    assert want.select("recording").distinct().count() == 15
    rows = lambda df, name: sorted((name(r.recording), r.segment_id, r.speaker, round(r.start_time, 3), round(r.end_time, 3)) for r in df.collect())
    assert rows(got, str) == rows(want, lambda x: f"rec-{x}.wav")


@pytest.mark.parametrize("lines", [False, True])
def test_documents_without_an_audio_file_keep_their_recording(spark, tmp_path, lines):
    """Several documents of one file stay apart; line ends and quotes within a value do not break a line."""
    t = spark.createDataFrame([(i % 9, 'A\n"B', float(i), i + 1.0, 1.0, i) for i in range(90)], "recording long, speaker string, start_time double, end_time double, duration double, seq long")
    write_segments(segments.stage_document(segments.number(t)).coalesce(1), str(tmp_path / "d"), lines)
    assert len(list((tmp_path / "d").rglob("*.json"))) == (1 if lines else 9)
    got = read_segments(spark, str(tmp_path / "d"), lines).collect()
    assert sorted((int(r.recording), r.start_time, r.segment_id) for r in got) == sorted((i % 9, float(i), f"segment{i // 9 + 1:03d}") for i in range(90))
    assert {r.speaker for r in got} == {'A\n"B'}
