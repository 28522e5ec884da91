"""Queries over `events` read as speaker turns: recording = user, speaker = event type, seconds from 1970."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import times
from ..operators import segments as S
from ..operators import subtitles
from .catalog import Tables, query

#: Turns of these tables lie minutes apart; the merge tolerance is a parameter.
GAP = 600.0


def turns(t: Tables) -> DataFrame:
    start = F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', ts)") / F.lit(1e6)
    return t.events.select(F.col("user_id").alias("recording"), F.col("event_type").alias("speaker"), start.alias("start_time"), F.col("value").alias("duration"), F.col("event_id").alias("seq")).withColumn("end_time", F.col("start_time") + F.col("duration"))


def merged(t: Tables) -> DataFrame:
    return S.number(S.merge_turns(S.min_duration(turns(t)), GAP, ranged=True))


def seconds(c: str, digits: int = 3):
    return F.round(c, digits).alias(c)


TURNS = "turns AS (SELECT user_id AS recording, event_type AS speaker, epoch_us(ts) / 1e6 AS start_time, value AS duration, epoch_us(ts) / 1e6 + value AS end_time, event_id AS seq FROM events)"
MERGED = f"""{TURNS}, kept AS (SELECT * FROM turns WHERE duration >= 0.5),
marked AS (SELECT *, CASE WHEN lag(speaker) OVER w = speaker AND start_time - lag(end_time) OVER w <= {GAP} THEN 0 ELSE 1 END AS new FROM kept WINDOW w AS (PARTITION BY recording ORDER BY start_time, seq)),
islands AS (SELECT *, sum(new) OVER (PARTITION BY recording ORDER BY start_time, seq) AS island FROM marked),
joined AS (SELECT recording, min(speaker) AS speaker, min(start_time) AS start_time, arg_max(end_time, (start_time, seq)) AS end_time, min(seq) AS seq, count(*) AS turns FROM islands GROUP BY recording, island),
numbered AS (SELECT *, end_time - start_time AS duration, row_number() OVER (PARTITION BY recording ORDER BY start_time, seq) AS ordinal FROM joined),
merged AS (SELECT *, 'segment' || CASE WHEN ordinal < 1000 THEN lpad(ordinal::VARCHAR, 3, '0') ELSE ordinal::VARCHAR END AS segment_id FROM numbered)"""


@query("WITH " + MERGED + """
SELECT recording, count(*) AS segments, sum(turns)::BIGINT AS turns, count(DISTINCT speaker) AS speakers, round(sum(duration), 3) AS total_duration,
       round(max(end_time) - min(start_time), 3) AS span FROM merged GROUP BY recording""")
def speaker_timeline(t: Tables) -> DataFrame:
    """The flagship: merged turns, summed per recording."""
    m = merged(t)
    return m.groupBy("recording").agg(F.count("*").alias("segments"), F.sum("turns").alias("turns"), F.count_distinct("speaker").alias("speakers"), F.round(F.sum("duration"), 3).alias("total_duration"), F.round(F.max("end_time") - F.min("start_time"), 3).alias("span"))


@query("WITH " + TURNS + " SELECT recording, speaker, seq, duration FROM turns WHERE duration >= 0.5")
def min_duration(t: Tables) -> DataFrame:
    return S.min_duration(turns(t)).select("recording", "speaker", "seq", "duration")


@query("WITH " + MERGED + " SELECT recording, speaker, seq, turns, round(start_time, 3) AS start_time, round(end_time, 3) AS end_time FROM merged")
def turn_merge(t: Tables) -> DataFrame:
    return merged(t).select("recording", "speaker", "seq", "turns", seconds("start_time"), seconds("end_time"))


@query("WITH " + MERGED + " SELECT recording, ordinal, segment_id, speaker FROM merged")
def segment_numbering(t: Tables) -> DataFrame:
    return merged(t).select("recording", F.col("ordinal").cast("long").alias("ordinal"), "segment_id", "speaker")


@query("WITH " + TURNS + """, gaps AS (SELECT *, start_time - lag(end_time) OVER (PARTITION BY recording ORDER BY start_time, seq) AS gap FROM turns)
SELECT recording, seq, round(gap, 3) AS gap, round(CASE WHEN gap IS NULL THEN 0.5 WHEN gap > 0.1 THEN gap ELSE 0 END, 3) AS silence, coalesce(gap < 0, false) AS overlap FROM gaps""")
def gap_timeline(t: Tables) -> DataFrame:
    return S.gap_timeline(turns(t)).select("recording", "seq", seconds("gap"), seconds("silence"), "overlap")


@query("WITH " + TURNS + """, gaps AS (SELECT *, start_time - lag(end_time) OVER (PARTITION BY recording ORDER BY start_time, seq) AS gap FROM turns)
SELECT recording, count(*) AS segments, round(sum(duration), 3) AS total_duration, count(*) FILTER (gap > 0.1) AS gaps, round(coalesce(sum(gap) FILTER (gap > 0.1), 0), 3) AS total_gaps,
       round(0.5 + sum(duration) + coalesce(sum(gap) FILTER (gap > 0.1), 0), 3) AS estimated_duration FROM gaps GROUP BY recording""")
def timeline_summary(t: Tables) -> DataFrame:
    out = S.timeline_summary(turns(t))
    return out.select("recording", "segments", seconds("total_duration"), "gaps", seconds("total_gaps"), seconds("estimated_duration"))


@query("WITH " + MERGED + """
SELECT recording, speaker, count(*) AS total_segments, round(sum(duration), 3) AS total_duration, string_agg(segment_id, ',' ORDER BY start_time, seq) AS files, speaker || '_sample.wav' AS sample_file
FROM merged GROUP BY recording, speaker""")
def speaker_totals(t: Tables) -> DataFrame:
    return S.speaker_totals(merged(t)).select("recording", "speaker", "total_segments", seconds("total_duration"), F.array_join("files", ",").alias("files"), "sample_file")


@query("WITH " + TURNS + " SELECT recording, string_agg(DISTINCT speaker, ',' ORDER BY speaker) AS speakers, count(*) AS total_segments FROM turns GROUP BY recording")
def distinct_speakers(t: Tables) -> DataFrame:
    return S.distinct_speakers(turns(t)).select("recording", F.array_join("speakers", ",").alias("speakers"), "total_segments")


@query("WITH " + MERGED + """
SELECT recording, count(*) AS total_segments, string_agg(DISTINCT speaker, ',' ORDER BY speaker) AS speakers, string_agg(segment_id || ':' || speaker, ';' ORDER BY start_time, seq) AS segments FROM merged GROUP BY recording""")
def write_segments(t: Tables) -> DataFrame:
    d = S.stage_document(merged(t))
    return d.select("recording", "total_segments", F.array_join("speakers", ",").alias("speakers"), F.array_join(F.transform("segments", lambda s: F.concat_ws(":", s["segment_id"], s["speaker"])), ";").alias("segments"))


CHAT = "SELECT conv_id AS recording, turn AS seq, role AS speaker, text, turn * 7.0625 AS start_time, turn * 7.0625 + 5.5004 AS end_time FROM conversations"
CLOCK = "CASE WHEN {ms} // 3600000 > 0 OR {always} THEN lpad(({ms} // 3600000)::VARCHAR, 2, '0') || ':' ELSE '' END || lpad(({ms} % 3600000 // 60000)::VARCHAR, 2, '0') || ':' || lpad(({ms} % 60000 // 1000)::VARCHAR, 2, '0') || '{mark}' || lpad(({ms} % 1000)::VARCHAR, 3, '0')"


def clock_sql(ms: str, always: str = "false", mark: str = ".") -> str:
    return CLOCK.format(ms=f"({ms})", always=always, mark=mark)


def chat(t: Tables) -> DataFrame:
    start = F.col("turn") * F.lit(7.0625)
    c = t.conversations.select(F.col("conv_id").alias("recording"), F.col("turn").alias("seq"), F.col("role").alias("speaker"), "text", start.alias("start_time"), (start + 5.5004).alias("end_time"))
    return S.number(c)


MS = "chat AS (" + CHAT + "), cues AS (SELECT *, round_even(start_time * 1000, 0)::BIGINT AS a, round_even(end_time * 1000, 0)::BIGINT AS z, row_number() OVER (PARTITION BY recording ORDER BY start_time, seq) AS ordinal, replace(trim(text), '-->', '->') AS words FROM chat)"


@query(f"WITH {MS} SELECT recording, string_agg(ordinal || chr(10) || {clock_sql('a', 'true', ',')} || ' --> ' || {clock_sql('z', 'true', ',')} || chr(10) || words || chr(10), chr(10) ORDER BY start_time, seq) AS value FROM cues GROUP BY recording")
def subtitles_srt(t: Tables) -> DataFrame:
    return subtitles.srt(chat(t))


@query(f"WITH {MS} SELECT recording, 'WEBVTT' || chr(10) || chr(10) || string_agg({clock_sql('a')} || ' --> ' || {clock_sql('z')} || chr(10) || words || chr(10), chr(10) ORDER BY start_time, seq) AS value FROM cues GROUP BY recording")
def subtitles_vtt(t: Tables) -> DataFrame:
    return subtitles.vtt(chat(t))


@query(f"WITH {MS} SELECT recording, string_agg(trim(text), chr(10) ORDER BY start_time, seq) AS value FROM cues GROUP BY recording")
def transcript_txt(t: Tables) -> DataFrame:
    return subtitles.txt(chat(t))


DASH = "printf('%02d-%02d-%06.3f', floor({s} / 3600)::BIGINT, (floor({s})::BIGINT % 3600) // 60, {s} - floor({s} / 60) * 60)"
CLIPS = f"clips AS (SELECT l_orderkey, l_linenumber, 'segment' || lpad(l_linenumber::VARCHAR, 3, '0') AS segment_id, 'SPEAKER_' || l_returnflag AS speaker, (l_partkey % 9000) + 0.25 AS start_time, (l_partkey % 9000) + 0.25 + l_quantity AS end_time, l_quantity AS duration FROM lineitem)"


def clips(t: Tables) -> DataFrame:
    start = F.col("l_partkey") % 9000 + F.lit(0.25)
    return t.lineitem.select("l_orderkey", "l_linenumber", F.format_string("segment%03d", "l_linenumber").alias("segment_id"), F.concat(F.lit("SPEAKER_"), "l_returnflag").alias("speaker"), start.alias("start_time"), (start + F.col("l_quantity")).alias("end_time"), F.col("l_quantity").alias("duration"))


@query(f"WITH {CLIPS}, named AS (SELECT *, segment_id || '_' || speaker || '_' || {DASH.format(s='start_time')} || '_' || {DASH.format(s='end_time')} || '_' || printf('%06.3f', duration) || '.wav' AS name FROM clips) SELECT l_orderkey, l_linenumber, name, segment_id, speaker AS parsed_speaker, duration AS parsed_duration FROM named")
def clip_key(t: Tables) -> DataFrame:
    """Names made from segments, and the parts parsed back from them."""
    c = clips(t).select("l_orderkey", "l_linenumber", S.clip_key().alias("name"))
    p = S.parse_clip_key(F.col("name"))
    return c.select("l_orderkey", "l_linenumber", "name", p["segment_id"].alias("segment_id"), p["speaker"].alias("parsed_speaker"), p["duration"].alias("parsed_duration"))


@query(f"WITH {CLIPS} SELECT l_orderkey, l_linenumber, {DASH.format(s='start_time')} AS start_str, printf('%06.3f', duration) AS duration_str FROM clips")
def timecode_dash(t: Tables) -> DataFrame:
    return clips(t).select("l_orderkey", "l_linenumber", times.dash(F.col("start_time")).alias("start_str"), F.format_string("%06.3f", "duration").alias("duration_str"))


@query(f"WITH x AS (SELECT event_id, round_even(value * 100 * 1000, 0)::BIGINT AS ms FROM events) SELECT event_id, {clock_sql('ms')} AS short, {clock_sql('ms', 'true', ',')} AS long FROM x")
def timecode_clock(t: Tables) -> DataFrame:
    s = F.col("value") * 100
    return t.events.select("event_id", times.clock(s).alias("short"), times.clock(s, True, ",").alias("long"))


@query("""WITH e AS (SELECT p_partkey AS segment_id, p_size AS duration FROM part),
m AS (SELECT l_partkey AS segment_id, arg_min(l_quantity, l_orderkey * 10 + l_linenumber) AS made FROM lineitem WHERE l_returnflag <> 'N' GROUP BY 1)
SELECT segment_id, duration, made, made - duration AS difference, CASE WHEN made IS NULL THEN NULL WHEN duration = 0 THEN 0 ELSE (made - duration) / duration * 100 END AS percent, CASE WHEN made IS NULL THEN 'MISSING' ELSE 'OK' END AS status FROM e LEFT JOIN m USING (segment_id)""")
def duration_compare(t: Tables) -> DataFrame:
    made = t.lineitem.filter("l_returnflag <> 'N'").select(F.col("l_partkey").alias("segment_id"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("name"), F.col("l_quantity").alias("duration"))
    return S.compare_durations(t.part.select(F.col("p_partkey").alias("segment_id"), F.col("p_size").alias("duration")), made)


@query("""SELECT e.event_id, e.event_type AS speaker, s.sample_file, s.sample_file IS NULL AS failed FROM events e LEFT JOIN (SELECT event_type, 'sample_' || event_type || '.wav' AS sample_file FROM events WHERE event_type <> 'view' GROUP BY event_type) s USING (event_type)""")
def speaker_sample_join(t: Tables) -> DataFrame:
    samples = t.events.filter("event_type <> 'view'").groupBy(F.col("event_type").alias("speaker")).agg(F.lit(1).alias("one")).select("speaker", F.concat(F.lit("sample_"), "speaker", F.lit(".wav")).alias("sample_file"))
    return S.attach_samples(t.events.select("event_id", F.col("event_type").alias("speaker")), samples).select("event_id", "speaker", "sample_file", "failed")


ATTEMPTS = "attempts AS (SELECT l_orderkey AS segment, l_linenumber AS attempt, max(l_quantity) * 2 AS similarity, l_orderkey % 9 AS words FROM lineitem GROUP BY l_orderkey, l_linenumber)"


def attempts(t: Tables) -> DataFrame:
    tried = t.lineitem.groupBy(F.col("l_orderkey").alias("segment"), F.col("l_linenumber").alias("attempt")).agg((F.max("l_quantity") * 2).alias("similarity"))
    return tried.withColumn("words", F.col("segment") % 9)


BEST = ATTEMPTS + """, tried AS (SELECT *, CASE WHEN words < 3 OR (words < 5 AND similarity >= 50) OR similarity >= 85 THEN 0 WHEN similarity > 0 THEN 1 ELSE 2 END AS tier FROM attempts WHERE attempt <= 5),
ranked AS (SELECT *, count(*) OVER (PARTITION BY segment) AS attempts, row_number() OVER (PARTITION BY segment ORDER BY tier, CASE WHEN tier = 0 THEN 0 ELSE -similarity END, attempt) AS rn FROM tried),
best AS (SELECT segment, attempt, similarity, attempts, CASE tier WHEN 0 THEN 'passed' WHEN 1 THEN 'best_below' ELSE 'failed' END AS status FROM ranked WHERE rn = 1)"""


@query(f"WITH {BEST} SELECT * FROM best")
def best_attempt(t: Tables) -> DataFrame:
    return S.best_attempt(attempts(t))


@query(f"""WITH {BEST}, results AS (SELECT segment % 50 AS recording, status <> 'failed' AND segment % 7 <> 0 AS success, CASE WHEN segment % 7 = 0 THEN 'skipped' ELSE status END AS status, similarity, 10.0 + segment % 5 AS expected, 9.0 + attempt AS actual FROM best)
SELECT recording, count(*) FILTER (success) AS successful, count(*) FILTER (NOT success AND status = 'failed') AS failed, count(*) FILTER (NOT success AND status = 'skipped') AS skipped, round(avg(similarity) FILTER (success), 4) AS average_similarity,
 count(*) FILTER (status = 'passed') AS passed, count(*) FILTER (status = 'best_below') AS best_below, sum(expected) FILTER (success)::DOUBLE AS expected_total, sum(actual) FILTER (success)::DOUBLE AS actual_total, round(sum(actual) FILTER (success)::DOUBLE / sum(expected) FILTER (success), 6) AS ratio FROM results GROUP BY recording""")
def generation_report(t: Tables) -> DataFrame:
    skipped = F.col("segment") % 7 == 0
    r = S.best_attempt(attempts(t)).select((F.col("segment") % 50).alias("recording"), ((F.col("status") != "failed") & ~skipped).alias("success"), F.when(skipped, "skipped").otherwise(F.col("status")).alias("status"), "similarity", (F.lit(10.0) + F.col("segment") % 5).alias("expected_duration"), (F.lit(9.0) + F.col("attempt")).alias("actual_duration"))
    return S.generation_report(r).withColumn("average_similarity", F.round("average_similarity", 4)).withColumn("ratio", F.round("ratio", 6))


@query("SELECT l_orderkey AS segment, round(greatest(0, least(100, (avg(-l_discount * 10) + 1) * 100)), 4) AS confidence FROM lineitem GROUP BY 1")
def confidence_pct(t: Tables) -> DataFrame:
    return t.lineitem.groupBy(F.col("l_orderkey").alias("segment")).agg(F.round(S.confidence_pct(-F.col("l_discount") * 10), 4).alias("confidence"))


RANK = """WITH c AS (SELECT l_orderkey AS grp, l_linenumber AS candidate, -l_extendedprice AS logprob, l_quantity AS length FROM lineitem),
s AS (SELECT *, logprob / {norm} AS score FROM c), r AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY score DESC, candidate) AS rn FROM s)
SELECT grp, candidate, {out} AS score, logprob / (length + 1) AS avg_logprob FROM r WHERE rn = 1"""


def candidates(t: Tables) -> DataFrame:
    return t.lineitem.select(F.col("l_orderkey").alias("grp"), F.col("l_linenumber").alias("candidate"), (-F.col("l_extendedprice")).alias("logprob"), F.col("l_quantity").alias("length"))


@query(RANK.format(norm="length", out="score"))
def rank_candidates(t: Tables) -> DataFrame:
    return S.rank_candidates(candidates(t))


@query(RANK.format(norm="pow((5 + length) / 6, 0.6)", out="round(score, 4)"))
def rank_candidates_alpha(t: Tables) -> DataFrame:
    return S.rank_candidates(candidates(t), 0.6).select("grp", "candidate", seconds("score", 4), "avg_logprob")


@query("""WITH s AS (SELECT l_orderkey AS grp, l_returnflag AS language, max(l_quantity) / 10 AS score FROM lineitem GROUP BY 1, 2),
e AS (SELECT *, exp(score - max(score) OVER (PARTITION BY grp)) AS e FROM s), p AS (SELECT *, e / sum(e) OVER (PARTITION BY grp) AS p FROM e),
r AS (SELECT *, count(*) OVER (PARTITION BY grp) AS languages, row_number() OVER (PARTITION BY grp ORDER BY p DESC, language DESC) AS rn FROM p)
SELECT grp, language, round(p, 6) AS probability, languages FROM r WHERE rn = 1""")
def language_argmax(t: Tables) -> DataFrame:
    s = t.lineitem.groupBy(F.col("l_orderkey").alias("grp"), F.col("l_returnflag").alias("language")).agg((F.max("l_quantity") / 10).alias("score"))
    return S.language_argmax(s).select("grp", "language", seconds("probability", 6), "languages")


@query("""WITH tr AS (SELECT user_id AS recording, CASE event_type WHEN 'view' THEN 'original' WHEN 'purchase' THEN 'no_vocals' ELSE event_type END AS kind, max(event_id) AS path FROM events GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY recording ORDER BY CASE kind WHEN 'no_vocals' THEN 1 ELSE 2 END) AS rn FROM tr WHERE kind IN ('no_vocals', 'original'))
SELECT u.recording, r.path AS background FROM (SELECT DISTINCT user_id AS recording FROM events) u LEFT JOIN (SELECT * FROM r WHERE rn = 1) r USING (recording)""")
def background_source(t: Tables) -> DataFrame:
    kind = F.when(F.col("event_type") == "view", "original").when(F.col("event_type") == "purchase", "no_vocals").otherwise(F.col("event_type"))
    tracks = t.events.groupBy(F.col("user_id").alias("recording"), kind.alias("kind")).agg(F.max("event_id").alias("path"))
    return S.background_source(t.events.select(F.col("user_id").alias("recording")).distinct(), tracks)


@query("WITH " + TURNS + " SELECT recording, seq, row_number() OVER (PARTITION BY recording ORDER BY start_time, seq) AS place FROM turns")
def ordered_timeline(t: Tables) -> DataFrame:
    return S.number(turns(t)).select("recording", "seq", F.col("ordinal").alias("place"))
