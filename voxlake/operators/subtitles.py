"""Transcripts as subtitle and text files, one value per recording."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.times import clock


def _joined(segments: DataFrame, line: Column, between: str, head: str = "", tail: str = "") -> DataFrame:
    rows = segments.groupBy("recording").agg(F.array_sort(F.collect_list(F.struct("start_time", "seq", line.alias("line")))).alias("rows"))
    return rows.select("recording", F.concat(F.lit(head), F.array_join("rows.line", between), F.lit(tail)).alias("value"))


def _text() -> Column:
    return F.replace(F.trim("text"), F.lit("-->"), F.lit("->"))


def srt(segments: DataFrame) -> DataFrame:
    """Numbered cues HH:MM:SS,mmm --> HH:MM:SS,mmm; segments has ordinal."""
    cue = F.concat(F.col("ordinal").cast("string"), F.lit("\n"), clock(F.col("start_time"), True, ","), F.lit(" --> "), clock(F.col("end_time"), True, ","), F.lit("\n"), _text(), F.lit("\n"))
    return _joined(segments, cue, "\n")


def vtt(segments: DataFrame) -> DataFrame:
    cue = F.concat(clock(F.col("start_time")), F.lit(" --> "), clock(F.col("end_time")), F.lit("\n"), _text(), F.lit("\n"))
    return _joined(segments, cue, "\n", "WEBVTT\n\n")


def txt(segments: DataFrame) -> DataFrame:
    return _joined(segments, F.trim("text"), "\n")
