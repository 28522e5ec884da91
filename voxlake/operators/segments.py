"""Speaker turns: merging, numbering, timelines, totals and synthesis attempts.

Turns are rows (recording, speaker, start_time, end_time, duration, seq); seq breaks ties of start_time.
Recordings of many turns are cut into ranges of time, which are the unit of parallel work (see ranges).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ranges import RANGE, TOTAL, in_ranges, join_at_seams, window, with_seams

TIME_ORDER = ["start_time", "seq"]


def min_duration(turns: DataFrame, least: float = 0.5) -> DataFrame:
    """Turns of at least so many seconds."""
    return turns.filter(F.col("duration") >= least)


def merge_turns(turns: DataFrame, gap: float = 1.0, ranged: bool = False) -> DataFrame:
    """Consecutive turns of one speaker that are at most gap seconds apart become one. Its end is the end of
    its last turn, not the latest end. Another speaker in between always breaks a turn; turns without a speaker stand
    alone. Ranges of a long recording are merged each by itself, then what meets at their seams. ranged keeps the ranges'
    columns for what comes next (number, gap_timeline), which then need not count the merged turns."""
    w = window("recording", *TIME_ORDER)
    follows = lambda before: (before("speaker") == F.col("speaker")) & (F.col("start_time") - before("end_time") <= gap)
    new = ~F.coalesce(follows(lambda c: F.lag(c).over(w)), F.lit(False))
    marked = in_ranges(turns, "recording", "start_time").withColumn("island", F.sum(new.cast("int")).over(w))
    several = [TOTAL] if TOTAL in marked.columns else []
    order = F.struct("start_time", "seq")
    parts = marked.groupBy("recording", RANGE, "island").agg(F.first("speaker").alias("speaker"), F.min("start_time").alias("start_time"), F.max_by("end_time", order).alias("end_time"), F.min("seq").alias("seq"), F.count("*").alias("turns"), *[F.first(c).alias(c) for c in several])
    if not several:
        merged = parts.drop("island")
        return (merged if ranged else merged.drop(RANGE)).withColumn("duration", F.col("end_time") - F.col("start_time"))
    parts = parts.withColumn("islands", F.max("island").over(window("recording")))
    edge = F.col(TOTAL).isNotNull() & ((F.col("island") == 1) | (F.col("island") == F.col("islands")))
    place = F.struct(RANGE, "island")
    joins = lambda before: (F.col("island") == 1) & follows(before)
    merged = join_at_seams(parts, "recording", edge, ["island"], joins, [F.min_by("speaker", place).alias("speaker"), F.min("start_time").alias("start_time"), F.max_by("end_time", place).alias("end_time"), F.min("seq").alias("seq"), F.sum("turns").alias("turns"), F.min(RANGE).alias(RANGE), F.first(TOTAL).alias(TOTAL)])
    merged = merged if ranged else merged.drop(RANGE, TOTAL)
    return merged.withColumn("duration", F.col("end_time") - F.col("start_time"))


def number(turns: DataFrame, prefix: str = "segment") -> DataFrame:
    """Ordinal in time order and an id of at least three digits."""
    x = with_seams(in_ranges(turns, "recording", "start_time"), "recording", before=(F.count("*"), "sum"))
    n = F.row_number().over(window("recording", *TIME_ORDER)) + F.col("before")
    return x.withColumn("ordinal", n).withColumn("segment_id", F.format_string(f"{prefix}%03d", "ordinal")).drop("before", RANGE, TOTAL)


def gap_timeline(turns: DataFrame, least: float = 0.1, lead_in: float = 0.5) -> DataFrame:
    """Gap to the previous turn's end; silence is the gap if it exceeds least, and overlap marks negative gaps.
    The first turn of a recording gets the lead-in. The first turn of a range looks up the last end before the range."""
    x = with_seams(in_ranges(turns, "recording", "start_time"), "recording", before=(F.max_by("end_time", F.struct(*TIME_ORDER)), "last"))
    w = window("recording", *TIME_ORDER)
    end = F.when(F.row_number().over(w) == 1, F.col("before")).otherwise(F.lag("end_time").over(w))
    x = x.withColumn("gap", F.col("start_time") - end).drop("before", RANGE, TOTAL)
    return x.withColumns(
        {
            "silence": F.when(F.col("gap").isNull(), F.lit(lead_in)).when(F.col("gap") > least, F.col("gap")).otherwise(0.0),
            "overlap": F.coalesce(F.col("gap") < 0, F.lit(False)),
        }
    )


def timeline_summary(turns: DataFrame, least: float = 0.1, lead_in: float = 0.5) -> DataFrame:
    """Per recording: segments, spoken seconds, gaps over least with their sum, and the rebuilt length."""
    t = gap_timeline(turns, least, lead_in)
    big = F.col("gap") > least
    out = t.groupBy("recording").agg(F.count("*").alias("segments"), F.sum("duration").alias("total_duration"), F.count_if(big).alias("gaps"), F.coalesce(F.sum(F.when(big, F.col("gap"))), F.lit(0.0)).alias("total_gaps"))
    return out.withColumn("estimated_duration", lead_in + F.col("total_duration") + F.col("total_gaps"))


def gap_details(turns: DataFrame, least: float = 0.1) -> DataFrame:
    """Per recording the ordered list of (before_segment, gap_duration) of gaps over least."""
    t = gap_timeline(number(turns), least).filter(F.col("gap") > least)
    item = F.struct("ordinal", F.col("segment_id").alias("before_segment"), F.col("gap").alias("gap_duration"))
    return t.groupBy("recording").agg(F.array_sort(F.collect_list(item)).alias("gap_details"))


def speaker_totals(segments: DataFrame, sample: str = "sample.wav") -> DataFrame:
    """Per recording and speaker: segments, seconds, ordered segment ids and the name of the sample."""
    item = F.struct("start_time", "seq", "segment_id")
    out = segments.groupBy("recording", "speaker").agg(F.count("*").alias("total_segments"), F.sum("duration").alias("total_duration"), F.array_sort(F.collect_list(item)).alias("items"))
    return out.select("recording", "speaker", "total_segments", "total_duration", F.col("items.segment_id").alias("files"), F.concat_ws("_", "speaker", F.lit(sample)).alias("sample_file"))


def distinct_speakers(segments: DataFrame) -> DataFrame:
    return segments.groupBy("recording").agg(F.sort_array(F.collect_set("speaker")).alias("speakers"), F.count("*").alias("total_segments"))


def stage_document(segments: DataFrame) -> DataFrame:
    """One row per recording: header counts and the segments in time order, as they are written to JSON."""
    item = F.struct("start_time", "seq", "segment_id", "speaker", "end_time", "duration")
    out = segments.groupBy("recording").agg(F.count("*").alias("total_segments"), F.sort_array(F.collect_set("speaker")).alias("speakers"), F.array_sort(F.collect_list(item)).alias("segments"))
    return out


def clip_key(duration_digits: int = 6) -> Column:
    """{id}_{speaker}_{start}_{end}_{duration}.wav with dashes in times."""
    from ..functions.times import dash

    return F.concat(F.concat_ws("_", "segment_id", "speaker", dash(F.col("start_time")), dash(F.col("end_time")), F.format_string(f"%0{duration_digits}.3f", F.col("duration"))), F.lit(".wav"))


def parse_clip_key(c: Column) -> Column:
    """(segment_id, speaker, start, end, duration) of a clip name; the duration may be spelled either way. The
    speaker itself may contain underscores."""
    pattern = r"^([^_]+)_(.+)_([0-9-]+\.[0-9]+)_([0-9-]+\.[0-9]+)_([0-9.]+)\.wav$"
    part = lambda i: F.regexp_extract(c, pattern, i)
    return F.struct(part(1).alias("segment_id"), part(2).alias("speaker"), part(3).alias("start"), part(4).alias("end"), part(5).cast("double").alias("duration"))


def compare_durations(expected: DataFrame, made: DataFrame) -> DataFrame:
    """Left join on segment_id of expected and made seconds: difference, its share in percent (0 where the
    expected length is 0), and MISSING where nothing was made. The first made clip by name counts."""
    first = made.groupBy("segment_id").agg(F.min_by("duration", "name").alias("made"))
    out = expected.join(first, "segment_id", "left")
    diff = F.col("made") - F.col("duration")
    return out.select("segment_id", "duration", "made", diff.alias("difference"), F.when(F.col("made").isNull(), None).when(F.col("duration") == 0, 0.0).otherwise(diff / F.col("duration") * 100).alias("percent"), F.when(F.col("made").isNull(), "MISSING").otherwise("OK").alias("status"))


def attach_samples(segments: DataFrame, samples: DataFrame) -> DataFrame:
    """Left join of a voice sample by speaker; segments without one are marked failed."""
    return segments.join(samples, "speaker", "left").withColumn("failed", F.col("sample_file").isNull())


def best_attempt(attempts: DataFrame, passing: float = 85.0, lenient: float = 50.0, most: int = 5) -> DataFrame:
    """One row per segment from (segment, attempt, similarity, words).

    Of the first `most` attempts, the first that passes (at least `passing`; texts of fewer than five words
    pass at `lenient`, of fewer than three words always), else the one of highest similarity above 0, the
    earliest of equal ones. status: passed, best_below, failed."""
    tried = attempts.filter(F.col("attempt") <= most)
    ok = (F.col("words") < 3) | ((F.col("words") < 5) & (F.col("similarity") >= lenient)) | (F.col("similarity") >= passing)
    rank = F.struct(F.when(ok, 0).when(F.col("similarity") > 0, 1).otherwise(2).alias("tier"), F.when(ok, F.lit(0.0)).otherwise(-F.col("similarity")).alias("down"), F.col("attempt").alias("attempt"))
    best = tried.groupBy("segment").agg(F.min(rank).alias("r"), F.min_by("similarity", rank).alias("similarity"), F.count("*").alias("attempts"))
    return best.select("segment", F.col("r.attempt").alias("attempt"), "similarity", "attempts", F.when(F.col("r.tier") == 0, "passed").when(F.col("r.tier") == 1, "best_below").otherwise("failed").alias("status"))


def generation_report(results: DataFrame) -> DataFrame:
    """Totals of (success, status, similarity, expected_duration, actual_duration), one row per recording."""
    good = F.col("success")
    out = results.groupBy("recording").agg(
        F.count_if(good).alias("successful"),
        F.count_if(~good & (F.col("status") == "failed")).alias("failed"),
        F.count_if(~good & (F.col("status") == "skipped")).alias("skipped"),
        F.avg(F.when(good, F.col("similarity"))).alias("average_similarity"),
        F.count_if(F.col("status") == "passed").alias("passed"),
        F.count_if(F.col("status") == "best_below").alias("best_below"),
        F.sum(F.when(good, F.col("expected_duration"))).alias("expected_total"),
        F.sum(F.when(good, F.col("actual_duration"))).alias("actual_total"),
    )
    return out.withColumn("ratio", F.when(F.col("expected_total") > 0, F.col("actual_total") / F.col("expected_total")))


def confidence_pct(logprob: Column) -> Column:
    """Mean log probability as a percentage: clamp((avg + 1) * 100, 0, 100)."""
    return F.greatest(F.lit(0.0), F.least(F.lit(100.0), (F.avg(logprob) + 1) * 100))


def rank_candidates(rows: DataFrame, alpha: float | None = None) -> DataFrame:
    """Per group the candidate of highest log probability per length, or per ((5 + length) / 6) ** alpha; the
    earliest of equal ones. avg_logprob divides by length + 1."""
    norm = F.col("length") if alpha is None else F.pow((5 + F.col("length")) / 6, F.lit(alpha))
    score = F.col("logprob") / norm
    best = F.struct(score.alias("score"), (-F.col("candidate")).alias("back"))
    out = rows.groupBy("grp").agg(F.max(best).alias("b"), F.max_by(F.struct("candidate", "logprob", "length"), best).alias("c"))
    return out.select("grp", F.col("c.candidate").alias("candidate"), F.col("b.score").alias("score"), (F.col("c.logprob") / (F.col("c.length") + 1)).alias("avg_logprob"))


def language_argmax(rows: DataFrame) -> DataFrame:
    """Softmax of (grp, language, score) in every group: best language, its probability."""
    top = Window.partitionBy("grp")
    p = F.exp(F.col("score") - F.max("score").over(top))
    shared = rows.withColumn("e", p)
    shared = shared.withColumn("p", F.col("e") / F.sum("e").over(top))
    best = F.struct("p", F.col("language"))
    return shared.groupBy("grp").agg(F.max_by("language", best).alias("language"), F.max("p").alias("probability"), F.count("*").alias("languages"))


def background_source(recordings: DataFrame, tracks: DataFrame, priority: tuple[str, ...] = ("no_vocals", "original")) -> DataFrame:
    """The track of highest priority that a recording has; null if it has none."""
    rank = F.array_position(F.array(*map(F.lit, priority)), F.col("kind"))
    best = tracks.filter(F.col("kind").isin(*priority)).groupBy("recording").agg(F.min_by("path", rank).alias("background"))
    return recordings.join(best, "recording", "left")
