"""Queries over texts: `documents`, `conversations`, `benchmark` and `pages`."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators.dictionary import map_parts
from .catalog import Tables, query

#: Sentences with no lookbehind: a mark behind each end, then a split.
PARTS = "list_filter(list_transform(string_split(regexp_replace(text, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)), lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')), lambda x: x <> '')"


@query(f"SELECT doc_id, len({PARTS}) AS sentences, list_max(list_transform({PARTS}, lambda x: len(x))) AS longest, {PARTS}[1] AS first FROM documents")
def split_sentences(t: Tables) -> DataFrame:
    s = X.sentences(F.col("text"))
    return t.documents.select("doc_id", F.size(s).cast("long").alias("sentences"), F.array_max(F.transform(s, F.char_length)).cast("long").alias("longest"), F.try_element_at(s, F.lit(1)).alias("first"))


@query("SELECT lang, count(*) AS documents FROM documents WHERE trim(text) <> '' GROUP BY lang")
def non_empty_text(t: Tables) -> DataFrame:
    return t.documents.filter(F.trim("text") != "").groupBy("lang").agg(F.count("*").alias("documents"))


@query("""SELECT doc_id, trim(CASE WHEN o <> '' AND right(o, 1) NOT IN ('.', '!', '?') THEN o || '.' ELSE o END) AS norm FROM (SELECT doc_id,
regexp_replace(translate(regexp_replace(regexp_replace(regexp_replace(text, '\\.{2,}', '.', 'g'), '!{2,}', '!', 'g'), '\\?{2,}', '?', 'g'), ',;', ''), '\\s{2,}', ' ', 'g') AS o FROM documents)""")
def tts_normalize(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", X.tts_normalize(F.col("text")).alias("norm"))


# The SQL's own statement of the words for the languages of the table, not read from the library.
SQL_SHORT = {
    "en": {"mrs": "misess", "mr": "mister", "dr": "doctor", "st": "saint", "co": "company", "jr": "junior", "maj": "major", "gen": "general", "drs": "doctors", "rev": "reverend", "lt": "lieutenant", "hon": "honorable", "sgt": "sergeant", "capt": "captain", "esq": "esquire", "ltd": "limited", "col": "colonel", "ft": "fort"},
    "es": {"sra": "señora", "sr": "señor", "dr": "doctor", "dra": "doctora", "st": "santo", "co": "compañía", "jr": "junior", "ltd": "limitada"},
    "fr": {"mme": "madame", "mr": "monsieur", "dr": "docteur", "st": "saint", "co": "compagnie", "jr": "junior", "ltd": "limitée"},
    "de": {"fr": "frau", "dr": "doktor", "st": "sankt", "co": "firma", "jr": "junior"},
}
SQL_SIGNS = {
    "en": {"&": "and", "@": "at", "%": "percent", "#": "hash", "$": "dollar", "£": "pound", "°": "degree"},
    "es": {"&": "y", "@": "arroba", "%": "por ciento", "#": "numeral", "$": "dolar", "£": "libra", "°": "grados"},
    "fr": {"&": "et", "@": "arobase", "%": "pour cent", "#": "dièse", "$": "dollar", "£": "livre", "°": "degrés"},
    "de": {"&": "und", "@": "at", "%": "prozent", "#": "raute", "$": "dollar", "£": "pfund", "°": "grad"},
}


def _shortened(words: dict[str, str], out: str) -> str:
    for short, word in words.items():
        out = f"regexp_replace({out}, '(^|[^\\p{{L}}\\p{{N}}_]){short}\\.', '\\1{word}', 'gi')"
    return out


def _signed(words: dict[str, str], out: str) -> str:
    for sign, word in words.items():
        out = f"replace(replace({out}, '{sign}', ' {word} '), '  ', ' ')"
    return f"trim({out})"


ABBREVIATED = "CASE lang " + " ".join(f"WHEN '{c}' THEN {_shortened(w, 'text')}" for c, w in SQL_SHORT.items()) + " ELSE text END"
SYMBOLIC = "CASE lang " + " ".join(f"WHEN '{c}' THEN {_signed(w, '{text}')}" for c, w in SQL_SIGNS.items()) + " ELSE {text} END"


@query(f"SELECT doc_id, {ABBREVIATED} AS expanded FROM (SELECT doc_id, lang, 'Dr. No st. x Mr. ' || text AS text FROM documents)")
def expand_abbreviations(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", X.expand_abbreviations(F.concat(F.lit("Dr. No st. x Mr. "), "text"), F.col("lang")).alias("expanded"))


@query(f"SELECT doc_id, {SYMBOLIC.format(text='text')} AS expanded FROM documents")
def expand_symbols(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", X.expand_symbols(F.col("text"), F.col("lang")).alias("expanded"))


@query(f"SELECT doc_id, regexp_replace({SYMBOLIC.format(text='low')}, '\\s+', ' ', 'g') AS cleaned FROM (SELECT doc_id, lang, {ABBREVIATED.replace('text', 'low')} AS low FROM (SELECT doc_id, lang, lower(replace(text, chr(34), '')) AS low FROM documents))")
def clean_without_numbers(t: Tables) -> DataFrame:
    """All steps of multilingual_clean but the number words, which SQL cannot spell."""
    return t.documents.select("doc_id", X.clean(F.col("text"), F.col("lang")).alias("cleaned"))


@query()
def multilingual_clean(t: Tables) -> DataFrame:
    from ..functions.numbers import expand_numbers as words

    return t.documents.select("doc_id", X.clean(F.col("text"), F.col("lang"), words).alias("cleaned"))


@query("SELECT doc_id, lower(translate(text, '!\"#$%&''()*+,-./:;<=>?@[\\]^_`{|}~', '')) AS form FROM documents")
def strip_punctuation(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", X.strip_punctuation(F.col("text")).alias("form"))


WORDS = "list_filter(regexp_split_to_array(regexp_replace(lower({c}), '[^\\p{{L}}\\p{{N}}_\\s]', '', 'g'), '\\s+'), lambda x: x <> '')"


@query(f"""WITH p AS (SELECT conv_id, turn, {WORDS.format(c='text')} AS a, {WORDS.format(c="coalesce(lag(text) OVER (PARTITION BY conv_id ORDER BY turn), '')")} AS b FROM conversations)
SELECT conv_id, turn, CASE WHEN len(list_distinct(a || b)) = 0 THEN 0 ELSE len(list_intersect(list_distinct(a), list_distinct(b))) / len(list_distinct(a || b)) END AS jaccard FROM p""")
def word_jaccard(t: Tables) -> DataFrame:
    """Word overlap of each turn with the one before."""
    from pyspark.sql import Window

    before = F.coalesce(F.lag("text").over(Window.partitionBy("conv_id").orderBy("turn")), F.lit(""))
    c = t.conversations.withColumn("before", before)
    return c.select("conv_id", "turn", X.word_jaccard(X.words(F.col("text")), X.words(F.col("before"))).alias("jaccard"))


# The SQL's own limits for the languages of the table.
LIMITS = "MAP {'en': 250, 'de': 253, 'fr': 273, 'es': 239}"


@query(f"SELECT doc_id, coalesce({LIMITS}[lang], 250) AS lim, len(text) > coalesce({LIMITS}[lang], 250) AS too_long, MAP {{'en': 200, 'es': 180, 'fr': 170, 'de': 160}}[lang] AS cautious FROM documents")
def length_check(t: Tables) -> DataFrame:
    lim = X.limit_of(F.col("lang"))
    return t.documents.select("doc_id", lim.alias("lim"), (F.char_length("text") > lim).alias("too_long"), X.cautious_limit(F.col("lang")).alias("cautious"))


@query("""WITH n AS (SELECT n_nationkey, CASE n_name WHEN 'FRANCE' THEN 'French' WHEN 'GERMANY' THEN 'German' WHEN 'JAPAN' THEN 'Japanese' WHEN 'RUSSIA' THEN 'Russian' WHEN 'CHINA' THEN 'Chinese' WHEN 'INDIA' THEN 'hindi' WHEN 'PERU' THEN 'Castilian' ELSE n_name END AS language FROM nation)
SELECT n_nationkey, language, CASE language WHEN 'French' THEN 'fra_Latn' WHEN 'German' THEN 'deu_Latn' WHEN 'Japanese' THEN 'jpn_Jpan' WHEN 'Russian' THEN 'rus_Cyrl' WHEN 'Chinese' THEN 'zho_Hans' WHEN 'hindi' THEN 'hin_Deva' ELSE lower(language) || '_Latn' END AS code,
CASE language WHEN 'French' THEN 'fr' WHEN 'German' THEN 'de' WHEN 'Japanese' THEN 'ja' WHEN 'Russian' THEN 'ru' WHEN 'Chinese' THEN 'zh-cn' ELSE 'en' END AS synthesis,
CASE language WHEN 'French' THEN 'fr' WHEN 'German' THEN 'de' WHEN 'Japanese' THEN 'ja' WHEN 'Russian' THEN 'ru' WHEN 'Chinese' THEN 'zh' WHEN 'hindi' THEN 'hi' WHEN 'Castilian' THEN 'es' END AS short FROM n""")
def language_lookup(t: Tables) -> DataFrame:
    own = {"FRANCE": "French", "GERMANY": "German", "JAPAN": "Japanese", "RUSSIA": "Russian", "CHINA": "Chinese", "INDIA": "hindi", "PERU": "Castilian"}
    name = F.coalesce(F.create_map(*[F.lit(x) for kv in own.items() for x in kv])[F.col("n_name")], F.col("n_name"))
    code = X.translation_code(F.col("language"))
    return t.nation.select("n_nationkey", name.alias("language")).withColumn("code", code).withColumn("synthesis", X.synthesis_code(F.col("code"))).withColumn("short", X.language_code(F.col("language")))


@query()
def pack_sentences(t: Tables) -> DataFrame:
    c = X.pack_sentences(F.col("text"), X.limit_of(F.col("lang")))
    return t.documents.select("doc_id", F.posexplode(c).alias("chunk", "text"))


@query()
def pack_closed(t: Tables) -> DataFrame:
    """The variant in which a sentence that did not fit stays alone."""
    c = X.pack_closed(F.col("text"), X.limit_of(F.col("lang")))
    return t.documents.select("doc_id", F.posexplode(c).alias("chunk", "text"))


@query()
def fallback_pack(t: Tables) -> DataFrame:
    c = X.fallback_pack(F.col("text"), X.limit_of(F.col("lang")))
    return t.documents.select("doc_id", F.posexplode(c).alias("chunk", "text"))


@query()
def smart_chunk(t: Tables) -> DataFrame:
    c = X.smart_chunks(F.col("text"), X.cautious_limit(F.col("lang")))
    return t.documents.select("doc_id", F.posexplode(c).alias("chunk", "text"))


@query("SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(text), '[<\\[][^>\\]]*[>\\]]', '', 'g'), '\\(([^)]+?)\\)', '', 'g'), '[\\p{M}\\p{S}\\p{P}]', ' ', 'g'), '\\s+', ' ', 'g') AS norm FROM documents")
def basic_normalize(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", X.basic_normalize(F.col("text")).alias("norm"))


@query("SELECT doc_id, strip_accents(regexp_replace(lower(text), 'ß', 'ss', 'g')) AS folded FROM documents")
def fold_diacritics(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", X.fold_diacritics(F.lower("text")).alias("folded"))


@query("""WITH d AS (SELECT DISTINCT unnest(string_split(text, ' ')) AS w FROM benchmark)
SELECT doc_id, array_to_string(list_transform(string_split(text, ' '), lambda w: CASE WHEN list_contains(known, w) THEN '<' || w || '>' ELSE w END), ' ') AS mapped FROM documents, (SELECT list(w) AS known FROM d WHERE length(w) > 4)""")
def spelling_map(t: Tables) -> DataFrame:
    """Words of documents by a dictionary that is a table: here the longer words of the benchmark, put in marks."""
    words = t.benchmark.select(F.explode(F.split("text", " ")).alias("key")).filter(F.length("key") > 4).distinct()
    d = t.documents.select("doc_id", F.split("text", " ").alias("words"))
    d = map_parts(d, "words", words.select("key", F.concat(F.lit("<"), "key", F.lit(">")).alias("to")))
    return d.select("doc_id", F.array_join("words", " ").alias("mapped"))


@query()
def similarity_pct(t: Tables) -> DataFrame:
    """How alike each turn is to the one before."""
    from pyspark.sql import Window

    before = F.lag("text").over(Window.partitionBy("conv_id").orderBy("turn"))
    c = t.conversations.withColumn("before", before).filter("before is not null")
    return c.select("conv_id", "turn", X.similarity_pct(F.col("before"), F.col("text")).alias("similarity"))


@query()
def compression_ratio(t: Tables) -> DataFrame:
    d = t.documents.withColumn("ratio", X.compression_ratio(F.col("text")))
    return d.select("doc_id", "ratio", (F.col("ratio") > 2.4).alias("repetitive"))


@query("SELECT doc_id, regexp_replace(array_to_string(string_split(regexp_replace(strip_accents(regexp_replace(regexp_replace(regexp_replace(lower(text), '[<\\[][^>\\]]*[>\\]]', '', 'g'), '\\(([^)]+?)\\)', '', 'g'), 'ß', 'ss', 'g')), '[\\p{M}\\p{S}\\p{P}]', ' ', 'g'), ''), ' '), '\\s+', ' ', 'g') AS norm FROM documents")
def basic_letters(t: Tables) -> DataFrame:
    """The normal form without diacritics, letter by letter."""
    return t.documents.select("doc_id", X.basic_normalize(F.col("text"), diacritics=False, letters=True).alias("norm"))


@query("SELECT l_orderkey, l_linenumber, l_quantity / 10 > 2.4 AS repetitive, l_tax * -20 < -1.0 AS unlikely, l_discount * 10 > 0.6 AND l_tax * -20 < -1.0 AS silent FROM lineitem")
def decoding_flags(t: Tables) -> DataFrame:
    f = X.decoding_failed(F.col("l_quantity") / 10, F.col("l_tax") * -20, F.col("l_discount") * 10)
    return t.lineitem.select("l_orderkey", "l_linenumber", f.alias("f")).select("l_orderkey", "l_linenumber", "f.*")


URLS = "WITH u AS (SELECT page_id, url FROM pages UNION ALL SELECT page_id, 'https://v.example/watch?v=abcdefghijk' || page_id AS url FROM pages UNION ALL SELECT page_id, 'https://youtu.be/ABCDEFGHIJK?t=1' AS url FROM pages UNION ALL SELECT page_id, 'https://v.example/clip/watch?v=x' AS url FROM pages)"


@query(URLS + """ SELECT page_id, url, CASE WHEN contains(url, 'clip') THEN NULL WHEN contains(url, 'watch?v=') THEN left(split_part(url, 'watch?v=', 2), 11) WHEN contains(url, 'shorts/') THEN left(split_part(url, 'shorts/', 2), 11)
WHEN contains(url, 'youtu.be/') THEN left(split_part(url, 'youtu.be/', 2), 11) WHEN contains(url, '&v=') THEN left(split_part(url, '&v=', 2), 11) END AS video FROM u""")
def video_id_from_url(t: Tables) -> DataFrame:
    p, forms = t.pages, ["https://v.example/clip/watch?v=x", "https://youtu.be/ABCDEFGHIJK?t=1"]
    u = p.select("page_id", "url").union(p.select("page_id", F.concat(F.lit("https://v.example/watch?v=abcdefghijk"), "page_id")))
    for f in forms:
        u = u.union(p.select("page_id", F.lit(f)))
    return u.select("page_id", "url", X.video_id(F.col("url")).alias("video"))


@query("SELECT l_orderkey, l_linenumber, l_quantity, greatest(0.9, least(1.1, l_partkey / l_quantity / 5.0)) AS speed, CASE WHEN abs(l_quantity - 25) / 25 > 0.05 AND l_quantity / 25 BETWEEN 0.9 AND 1.1 THEN l_quantity / 25 ELSE 1.0 END AS factor FROM lineitem")
def pace_plan(t: Tables) -> DataFrame:
    q = F.col("l_quantity")
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", X.pace(F.col("l_partkey"), q).alias("speed"), X.duration_fix(q, F.lit(25.0)).alias("factor"))


@query("SELECT l_orderkey, string_agg(CASE WHEN l_partkey % 3000 >= 1000 THEN '<|' || printf('%.2f', (l_partkey % 3000 - 1000) * 0.02) || '|>' ELSE (l_partkey % 3000)::VARCHAR END, ' ' ORDER BY l_linenumber, l_partkey) AS tokens FROM lineitem GROUP BY 1")
def timestamp_tokens(t: Tables) -> DataFrame:
    g = t.lineitem.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))).alias("x"))
    return g.select("l_orderkey", X.timestamp_tokens(F.transform("x.l_partkey", lambda v: v % 3000), 1000).alias("tokens"))


@query("SELECT doc_id, replace('[' || lang || ']' || text, ' ', '[SPACE]') AS wire, replace(replace('[' || lang || ']' || text, '[STOP]', ''), '[UNK]', '') AS back FROM documents")
def wire_text(t: Tables) -> DataFrame:
    w = X.to_wire(F.col("text"), F.concat("lang", F.lit("-XX")))
    return t.documents.select("doc_id", w.alias("wire"), X.from_wire(w).alias("back"))


@query(f"""WITH s AS (SELECT conv_id, turn, unnest({PARTS}) AS s, unnest(range(len({PARTS}))) AS i FROM conversations),
d AS (SELECT DISTINCT s AS key, 'X' || s AS tr FROM s WHERE turn = 0 AND i = 0)
SELECT conv_id, turn, string_agg(coalesce(tr, s), ' ' ORDER BY i) AS mapped FROM s LEFT JOIN d ON key = s GROUP BY 1, 2""")
def sentence_map(t: Tables) -> DataFrame:
    """Map sentences by a table of translations (here of the sentences that begin a conversation), keep those that it
    doesn't have, in order."""
    s = t.conversations.select("conv_id", "turn", X.sentences(F.col("text")).alias("s")).filter(F.size("s") > 0)
    known = s.filter("turn = 0").select(F.col("s")[0].alias("key")).distinct()
    out = map_parts(s, "s", known.select("key", F.concat(F.lit("X"), "key").alias("to")))
    return out.select("conv_id", "turn", F.array_join("s", " ").alias("mapped"))


@query()
def expand_numbers(t: Tables) -> DataFrame:
    from ..functions.numbers import expand_numbers as words

    return t.documents.select("doc_id", words(F.col("text"), F.col("lang")).alias("expanded"))


@query()
def english_normalize(t: Tables) -> DataFrame:
    from ..functions import numbers

    return t.documents.filter("lang = 'en'").select("doc_id", numbers.english_normalize(F.col("text")).alias("norm"))


@query("SELECT l_orderkey, l_linenumber, n, n::VARCHAR AS digits FROM (SELECT l_orderkey, l_linenumber, (l_quantity::BIGINT * 37 + l_linenumber) * 1009 AS n FROM lineitem)")
def english_number_words(t: Tables) -> DataFrame:
    """Numbers spelled as words and read back as digits."""
    from ..functions.numbers import expand_numbers as words
    from ..functions.numbers import number_digits

    n = (F.col("l_quantity").cast("long") * 37 + F.col("l_linenumber")) * 1009
    spelled = F.replace(words(n.cast("string"), F.lit("en")), F.lit(","), F.lit(""))
    return t.lineitem.select("l_orderkey", "l_linenumber", n.alias("n"), number_digits(spelled).alias("digits"))


@query("SELECT doc_id, count(*) > 0 AS some, string_agg(w, ' ') AS text FROM (SELECT doc_id, unnest(list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '')) AS w FROM documents) GROUP BY doc_id")
def text_chunks(t: Tables) -> DataFrame:
    """Texts cut by the table function and joined again."""
    from ..functions.tables import register

    register(t.spark)
    t.documents.createOrReplaceTempView("voxlake_documents")
    c = t.spark.sql("SELECT doc_id, chunk, piece FROM voxlake_documents, LATERAL text_chunks(text, 200)")
    g = c.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("chunk", "piece"))).alias("x"))
    return g.select("doc_id", (F.size("x") > 0).alias("some"), F.array_join("x.piece", " ").alias("text"))
