"""Operators of turns, boxes, curation and text on small inputs with known results."""

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxlake.functions import numbers, text, times
from voxlake.functions.models import apply_model
from voxlake.operators import curation, segments, signal, spatial, subtitles, vectors

TURN = "recording long, speaker string, start_time double, end_time double, duration double, seq long"


def turns(spark, rows):
    return spark.createDataFrame([(1, s, a, z, z - a, i) for i, (s, a, z) in enumerate(rows)], TURN)


def test_merge(spark):
    t = turns(spark, [("A", 0.0, 5.0), ("A", 5.5, 6.0), ("B", 6.1, 7.0), ("A", 7.1, 8.0), ("A", 9.1, 9.5), ("A", 10.6, 11.0)])
    got = [(r.speaker, r.start_time, r.end_time, r.turns) for r in segments.merge_turns(t).orderBy("start_time").collect()]
    assert got == [("A", 0.0, 6.0, 2), ("B", 6.1, 7.0, 1), ("A", 7.1, 8.0, 1), ("A", 9.1, 9.5, 1), ("A", 10.6, 11.0, 1)]


def test_merge_ends_with_the_last_turn(spark):
    t = turns(spark, [("A", 0.0, 9.0), ("A", 1.0, 2.0)])
    assert segments.merge_turns(t).first().end_time == 2.0


def test_merge_is_a_fixpoint(spark):
    t = turns(spark, [("A", float(i), i + 0.4) for i in range(20)])
    once = segments.merge_turns(t)
    assert segments.merge_turns(once).drop("turns").collect() == once.drop("turns").collect()


def test_timeline(spark):
    t = turns(spark, [("A", 1.0, 2.0), ("B", 2.05, 3.0), ("A", 4.0, 5.0), ("A", 4.5, 6.0)])
    got = segments.gap_timeline(t).orderBy("seq").collect()
    assert [round(r.silence, 3) for r in got] == [0.5, 0.0, 1.0, 0.0] and [r.overlap for r in got] == [False, False, False, True]
    s = segments.timeline_summary(t).first()
    assert s.gaps == 1 and s.estimated_duration == pytest.approx(0.5 + 4.45 + 1.0)


def test_numbering_and_keys(spark):
    t = segments.number(turns(spark, [("SPEAKER_01", 79.126, 83.5)]))
    name = t.select(segments.clip_key().alias("n"))
    assert name.first().n == "segment001_SPEAKER_01_00-01-19.126_00-01-23.500_04.374.wav"
    parsed = name.select(segments.parse_clip_key(F.col("n")).alias("p")).first().p
    assert (parsed.speaker, parsed.duration) == ("SPEAKER_01", 4.374)


def test_attempts(spark):
    rows = [(1, 1, 60.0, 9), (1, 2, 90.0, 9), (1, 3, 99.0, 9), (2, 1, 70.0, 9), (2, 2, 70.0, 9), (3, 1, 10.0, 2), (4, 1, 55.0, 4), (5, 1, 0.0, 9), (6, 6, 99.0, 9), (6, 1, 20.0, 9)]
    got = {r.segment: (r.attempt, r.status) for r in segments.best_attempt(spark.createDataFrame(rows, "segment long, attempt int, similarity double, words int")).collect()}
    assert got == {1: (2, "passed"), 2: (1, "best_below"), 3: (1, "passed"), 4: (1, "passed"), 5: (1, "failed"), 6: (1, "best_below")}


def test_clock(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    assert one(times.clock(F.lit(61.0005))) == "01:01.000" and one(times.clock(F.lit(3661.5), True, ",")) == "01:01:01,500"
    assert one(times.dash(F.lit(3723.25))) == "01-02-03.250"


def test_subtitles(spark):
    s = spark.createDataFrame([(1, 1, 0, 0.0, 1.5, " a --> b ")], "recording long, ordinal int, seq int, start_time double, end_time double, text string")
    assert subtitles.srt(s).first().value == "1\n00:00:00,000 --> 00:00:01,500\na -> b\n"
    assert subtitles.vtt(s).first().value == "WEBVTT\n\n00:00.000 --> 00:01.500\na -> b\n"


# Abbreviations with their expected forms.
CASES = [
    ("Hello Mr. Smith.", "Hello mister Smith.", "en"), ("Dr. Jones is here.", "doctor Jones is here.", "en"),
    ("Hola Sr. Garcia.", "Hola señor Garcia.", "es"), ("La Dra. Martinez es muy buena.", "La doctora Martinez es muy buena.", "es"),
    ("Bonjour Mr. Dupond.", "Bonjour monsieur Dupond.", "fr"), ("Mme. Moreau est absente aujourd'hui.", "madame Moreau est absente aujourd'hui.", "fr"),
    ("Frau Dr. Müller ist sehr klug.", "Frau doktor Müller ist sehr klug.", "de"),
    ("Olá Sr. Silva.", "Olá senhor Silva.", "pt"), ("Dra. Costa, você está disponível?", "doutora Costa, você está disponível?", "pt"),
    ("Buongiorno, Sig. Rossi.", "Buongiorno, signore Rossi.", "it"),
    ("Dzień dobry, P. Kowalski.", "Dzień dobry, pani Kowalski.", "pl"), ("M. Nowak, czy mogę zadać pytanie?", "pan Nowak, czy mogę zadać pytanie?", "pl"),
    ("P. Novák", "pan Novák", "cs"), ("Dr. Vojtěch", "doktor Vojtěch", "cs"),
    ("Dhr. Jansen", "de heer Jansen", "nl"), ("Mevr. de Vries", "mevrouw de Vries", "nl"),
    ("Здравствуйте Г-н Иванов.", "Здравствуйте господин Иванов.", "ru"), ("Д-р Смирнов здесь, чтобы увидеть вас.", "доктор Смирнов здесь, чтобы увидеть вас.", "ru"),
    ("Merhaba B. Yılmaz.", "Merhaba bay Yılmaz.", "tr"), ("Dr. Ayşe burada.", "doktor Ayşe burada.", "tr"),
    ("Dr. Szabó itt van.", "doktor Szabó itt van.", "hu"),
]
# Symbols with their expected forms.
SYMBOLS = [
    ("I have 14% battery", "I have 14 percent battery", "en"), ("Te veo @ la fiesta", "Te veo arroba la fiesta", "es"),
    ("J'ai 14° de fièvre", "J'ai 14 degrés de fièvre", "fr"), ("Die Rechnung beträgt £ 20", "Die Rechnung beträgt pfund 20", "de"),
    ("O meu email é ana&joao@gmail.com", "O meu email é ana e joao arroba gmail.com", "pt"), ("linguaggio di programmazione C#", "linguaggio di programmazione C cancelletto", "it"),
    ("Moja temperatura to 36.6°", "Moja temperatura to 36.6 stopnie", "pl"), ("Mám 14% baterie", "Mám 14 procento baterie", "cs"),
    ("Těším se na tebe @ party", "Těším se na tebe na party", "cs"), ("У меня 14% заряда", "У меня 14 процентов заряда", "ru"),
    ("Я буду @ дома", "Я буду собака дома", "ru"), ("Ik heb 14% batterij", "Ik heb 14 procent batterij", "nl"),
    ("Ik zie je @ het feest", "Ik zie je bij het feest", "nl"), ("لدي 14% في البطارية", "لدي 14 في المئة في البطارية", "ar"),
    ("我的电量为 14%", "我的电量为 14 百分之", "zh"), ("Pilim %14 dolu.", "Pilim yüzde 14 dolu.", "tr"),
    ("Az akkumulátorom töltöttsége 14%", "Az akkumulátorom töltöttsége 14 százalék", "hu"), ("14% 배터리", "14 퍼센트 배터리", "ko"),
]
# Numbers with their expected forms.
NUMBERS = [
    ("In 12.5 seconds.", "In twelve point five seconds.", "en"), ("There were 50 soldiers.", "There were fifty soldiers.", "en"), ("This is a 1st test", "This is a first test", "en"),
    ("That will be $20 sir.", "That will be twenty dollars sir.", "en"), ("That will be 20€ sir.", "That will be twenty euro sir.", "en"),
    ("That will be 20.15€ sir.", "That will be twenty euro, fifteen cents sir.", "en"), ("That's 100,000.5.", "That's one hundred thousand point five.", "en"),
    ("En 12,5 secondes.", "En douze virgule cinq secondes.", "fr"), ("Il y avait 50 soldats.", "Il y avait cinquante soldats.", "fr"), ("Ceci est un 1er test", "Ceci est un premier test", "fr"),
    ("Cela vous fera $20 monsieur.", "Cela vous fera vingt dollars monsieur.", "fr"), ("Cela vous fera 20€ monsieur.", "Cela vous fera vingt euros monsieur.", "fr"),
    ("Cela vous fera 20,15€ monsieur.", "Cela vous fera vingt euros et quinze centimes monsieur.", "fr"), ("Ce sera 100.000,5.", "Ce sera cent mille virgule cinq.", "fr"),
    ("In 12,5 Sekunden.", "In zwölf Komma fünf Sekunden.", "de"), ("Es gab 50 Soldaten.", "Es gab fünfzig Soldaten.", "de"), ("Dies ist ein 1. Test", "Dies ist ein erste Test", "de"),
    ("Das macht $20 Herr.", "Das macht zwanzig Dollar Herr.", "de"), ("Das macht 20€ Herr.", "Das macht zwanzig Euro Herr.", "de"), ("Das macht 20,15€ Herr.", "Das macht zwanzig Euro und fünfzehn Cent Herr.", "de"),
    ("En 12,5 segundos.", "En doce punto cinco segundos.", "es"), ("Había 50 soldados.", "Había cincuenta soldados.", "es"), ("Este es un 1er test", "Este es un primero test", "es"),
    ("Eso le costará $20 señor.", "Eso le costará veinte dólares señor.", "es"), ("Eso le costará 20€ señor.", "Eso le costará veinte euros señor.", "es"), ("Eso le costará 20,15€ señor.", "Eso le costará veinte euros con quince céntimos señor.", "es"),
]
CASES += [("édr. x", "édr. x", "en"), ("Mr. X", "Mr. X", "xx")]
NUMBERS += [("Had 50", "Had 50", "ur")]


@pytest.mark.parametrize("cases, fn", [(CASES, text.expand_abbreviations), (SYMBOLS, text.expand_symbols), (NUMBERS, numbers.expand_numbers)])
def test_expansion(spark, cases, fn):
    df = spark.createDataFrame(cases, "a string, want string, lang string")
    assert [r.got for r in df.select(fn(F.col("a"), F.col("lang")).alias("got")).collect()] == [w for _, w, _ in cases]


@pytest.mark.parametrize("n", [0, 7, 13, 21, 100, 101, 342, 1000, 1001, 20_000, 100_000, 999_999, 10**6, 12_345_678])
def test_numbers_read_back(n):
    assert numbers.digits(numbers.cardinal(n, "en").replace(",", "")) == str(n)


@pytest.mark.parametrize("said, want", [("one oh one", "101"), ("three point five", "3.5"), ("double four", "44"), ("ten percent", "10%"), ("twenty million dollars", "$20000000"), ("nineteen ninety", "1990"), ("and then", "and then"), ("twenty first", "21st"), ("the two hundredth", "the 200th"), ("nineteen sixties", "1960s"), ("minus three", "-3"), ("five pounds", "£5"), ("two euros and ten cents", "€2.10"), ("$20 million and 5 dollars", "$20000000 $5"), ("two and a half", "2.5"), ("20 per cent", "20%"), ("per hour", "per hour"), ("3 hundred and 7", "300 7"), ("a point made", "a point made"), ("1 or ones", "one or ones"), ("zero point five", "0.5"), ("five hundred twenty", "520"), ("forty double oh seven", "40007"), ("twelfth of five", "12th of 5"), ("sixes", "6s"), ("two quadrillion", "2000000000000000"), ("plus 5", "+5"), ("minus one", "-one")])
def test_digits(said, want):
    assert numbers.digits(said) == want


def test_normal_forms(spark):
    df = spark.createDataFrame([("Um, it's [noise] $1,000 (loud) twenty one won't Mr. X",)], "t string")
    assert df.select(numbers.english_normalize(F.col("t")).alias("x")).first().x == "it is $1021 will not mister x"
    one = lambda c: df.select(c.alias("x")).first().x
    assert one(text.basic_normalize(F.lit("A <b> [c] (d) É-f!"))) == "a é f "
    assert one(text.basic_normalize(F.lit("ﬁn ½ É ⅷ"))) == "fin 1 2 é viii"
    assert one(text.basic_normalize(F.lit("Øré ǽ!"), diacritics=False)) == "øré ae ".replace("øré", "ore")
    assert one(text.basic_normalize(F.lit("Né a\u0301x"), letters=True)) == "n é á x"
    assert one(numbers.english_normalize(F.lit("Capt. Smith'd done it, Gov. Jones Esq. — señor’s crème"))) == "captain smith had done it governor jones esquire senor s creme"
    assert one(numbers.english_normalize(F.lit("The Colour of $20 million"), {"colour": "color"})) == "the color of $20000000"
    assert one(numbers.english_normalize(F.lit(None).cast("string"))) is None
    assert df.select(text.fold_diacritics(F.lit("straße éà ø")).alias("x")).first().x == "strasse ea o"


def chunks(spark, fn, t, limit):
    return spark.createDataFrame([(t,)], "t string").select(fn(F.col("t"), F.lit(limit)).alias("p")).first().p


def test_chunks(spark):
    """What joins what: blanks between sentences do not count, and only the open variant goes on behind a full chunk."""
    t = "One two. Three four. Five six seven. Eight. Nine."
    assert chunks(spark, text.pack_sentences, t, 21) == ["One two. Three four.", "Five six seven. Eight.", "Nine."]
    assert chunks(spark, text.pack_closed, t, 21) == ["One two. Three four.", "Five six seven.", "Eight. Nine."]
    long = "Short. " + "word " * 8 + "end. Tail. Last."
    assert chunks(spark, text.pack_sentences, long, 24) == ["Short.", "word word word word word", "word word word end. Tail.", "Last."]
    assert chunks(spark, text.pack_closed, long, 24) == ["Short.", "word word word word word", "word word word end.", "Tail. Last."]
    assert chunks(spark, text.pack_sentences, " short ", 80) == ["short "] and chunks(spark, text.pack_closed, " short ", 80) == ["short"]
    assert chunks(spark, text.fallback_pack, "a b. c d. e f g h. i.", 9) == ["a b. c d", "e f g h", "i."]
    assert chunks(spark, text.fallback_pack, "", 9) == [""] and chunks(spark, text.pack_sentences, None, 9) is None


def test_smart_chunks(spark):
    assert chunks(spark, text.smart_chunks, "Short one. Next!", 40) == ["Short one.", "Next!"]
    long = "alpha beta gamma delta: epsilon zeta eta theta iota kappa, lambda mu nu"
    assert chunks(spark, text.smart_chunks, long, 40) == ["alpha beta gamma delta:.", "epsilon zeta eta theta iota.", "kappa lambda mu nu."]
    got = chunks(spark, text.smart_chunks, "word " * 60 + "x" * 300, 50)
    assert "".join("".join(got).split()).replace(".", "") == "word" * 60 + "x" * 300


def test_missing_sides(spark):
    """Segments that were never made, recordings without a background, and videos without shots."""
    e = spark.createDataFrame([(1, 10), (2, 20)], "segment_id long, duration int")
    made = spark.createDataFrame([(1, "a", 9.0)], "segment_id long, name string, duration double")
    assert {(r.segment_id, r.status) for r in segments.compare_durations(e, made).collect()} == {(1, "OK"), (2, "MISSING")}
    rec = spark.createDataFrame([(1,), (2,), (3,)], "recording long")
    tracks = spark.createDataFrame([(1, "original", 5), (1, "no_vocals", 6), (2, "drums", 7)], "recording long, kind string, path long")
    assert {(r.recording, r.background) for r in segments.background_source(rec, tracks).collect()} == {(1, 6), (2, None), (3, None)}
    frames = spark.createDataFrame([(1, 10), (1, 200), (2, 7), (3, 9)], "video long, frame long")
    shots = spark.createDataFrame([(1, 4, 0, 100), (3, 1, 0, 20)], "video long, shot int, start_frame long, end_frame long")
    assert {(r.video, r.frame, r.shot) for r in spatial.assign_shots(frames, shots).collect()} == {(1, 10, 4), (2, 7, 0), (3, 9, 0)}


def test_language_codes(spark):
    df = spark.createDataFrame([("French",), ("castilian",), ("zh",), ("Haitian Creole",), ("klingon",)], "n string")
    assert [r.c for r in df.select(text.language_code(F.col("n")).alias("c")).collect()] == ["fr", "es", "zh", "ht", None]


def test_similarity(spark):
    df = spark.createDataFrame([("Hello, world", "hello world!"), ("a b", "c d"), ("", "x"), (None, "x")], "a string, b string")
    got = [r.s for r in df.select(text.similarity_pct(F.col("a"), F.col("b")).alias("s")).collect()]
    assert got[0] == pytest.approx(100) and got[1] < 40 and got[2] == got[3] == 0


@pytest.mark.parametrize("url, want", [("https://x/watch?v=abcdefghijkLM", "abcdefghijk"), ("https://youtu.be/ABCDEFGHIJK", "ABCDEFGHIJK"), ("https://x/shorts/12345678901?a", "12345678901"), ("https://bilibili.com/video/BV1234567890", "BV1234567890"), ("https://x/clip/watch?v=a", None), ("https://x/", None)])
def test_video_ids(spark, url, want):
    assert spark.range(1).select(text.video_id(F.lit(url)).alias("x")).first().x == want


def test_suppression_leaves_no_overlap(spark):
    rows = [(1, i, (i * 37 % 100) / 100, float(i * 13 % 90), float(i * 7 % 50), float(i * 13 % 90 + 40), float(i * 7 % 50 + 40)) for i in range(60)]
    b = spark.createDataFrame(rows, "image long, box long, score double, x1 double, y1 double, x2 double, y2 double")
    kept = spatial.suppress(b, 0.3).select("box").join(b, "box").withColumn("frame", F.lit(1))
    assert kept.count() > 1 and spatial.frame_overlaps(kept).filter("iou > 0.3").count() == 0
    assert kept.agg(F.max("score")).first()[0] == max(r[2] for r in rows)


def test_leader_clusters(spark):
    rows = [(1, i, i, x, 0.0) for i, x in enumerate([0.0, 5.0, 100.0, 2.0, 104.0, 50.0])]
    got = spatial.leader_clusters(spark.createDataFrame(rows, "recording long, frame long, det long, center_x double, center_y double"), 10.0)
    assert [r.cluster for r in got.orderBy("det").collect()] == [0, 0, 1, 0, 1, 2]


def test_tracks(spark):
    rows = [(1, 0, f, f, float(f), 0.0, f + 150.0, 150.0) for f in range(60) if f not in (10, 11)] + [(1, 0, f, 1000 + f, 900.0, 0.0, 1050.0, 150.0) for f in range(20)]
    got = spatial.tracks(spark.createDataFrame(rows, "video long, shot long, frame long, box long, x1 double, y1 double, x2 double, y2 double"))
    assert got.count() == 58 and {r.track for r in got.collect()} == {0}
    filled = spatial.interpolate(got.withColumn("x1", F.col("frame").cast("double")))
    assert filled.count() == 60 and filled.filter("frame = 10").first().x1 == 10.0


def test_offset(spark):
    v = spark.createDataFrame([(1, i, [float(i), 1.0]) for i in range(20)], "clip long, frame int, vec array<double>")
    a = v.withColumn("frame", F.col("frame") + 3)
    assert vectors.av_offset(vectors.shifted_distances(v, a, 5)).first().offset == -3


def test_frechet_distance_of_equal_tables(spark):
    v = spark.createDataFrame([([float(i % 7), float(i % 5), i * 0.1],) for i in range(50)], "vec array<double>")
    assert vectors.frechet_distance(v, v) == pytest.approx(0, abs=1e-6)
    assert vectors.frechet_distance(v, v.select(F.transform("vec", lambda x: x + 1).alias("vec"))) == pytest.approx(3)


def test_sums_of_some_vectors(spark):
    v = spark.createDataFrame([([1.0, float(i)],) for i in range(50)], "vec array<double>")
    assert {r.n for r in vectors.feature_sums(v, most=20).collect()} == {20} and {r.n for r in vectors.feature_sums(v).collect()} == {50}


def test_training_pairs(spark):
    p = curation.training_pairs(spark.range(300).select(F.col("id").alias("clip"), (F.col("id") + 20).alias("frames")), 16, 1)
    assert p.filter("start = wrong or start + 16 > frames or wrong + 16 > frames or abs(reference - start) < 16 or reference + 16 > frames or reference < 0").count() == 0
    assert 0.35 < p.agg(F.avg("y")).first()[0] < 0.65


def test_silence(spark):
    s = spark.createDataFrame([(1, i, v) for i, v in enumerate([0, 0, 5, 0, 5, 0, 0, 0])], "clip long, at int, value double".replace("double", "int"))
    got = [(r.start, r.end, r.leading, r.trailing) for r in signal.silence_islands(s, 1, 2).orderBy("start").collect()]
    assert got == [(0, 2, True, False), (5, 8, False, True)]


def test_models_lose_no_rows(spark):
    def load():
        def model(rows: pd.DataFrame) -> pd.DataFrame:
            if (rows["id"] % 5 == 3).any():
                raise RuntimeError("no")
            return pd.DataFrame({"twice": rows["id"] * 2})

        return model

    out = apply_model(spark.range(40), load, T.StructType([T.StructField("twice", T.LongType())])).collect()
    assert len(out) == 40 and sum(r.success for r in out) == 32
    assert all((r.twice == 2 * r.id) if r.success else (r.twice is None and "RuntimeError: no" in r.error) for r in out)
