"""Language of a text by rank order: its most frequent n-grams against each language's.

An n-gram is one to three characters of a word in lower case with a blank on both sides, held as one number (21 bits a
character), so a text's n-grams are shifted copies of its code points and counting is sorting. A profile is the order
of a language's most frequent n-grams over all labelled texts, counted by tasks. A text's own order is compared with every
profile: an n-gram costs the difference of its places, or the profile's length where the profile lacks it.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import drop, prepare, quoted, table, whole
from .tokens import in_parts

#: N-grams of a profile, and of a text that are compared.
PROFILE = 400
#: Different n-grams that a task counts before it hands its counts on, and languages compared in one pass.
HELD, LANGUAGES = 2_000_000, 1000
#: Bytes of texts whose n-grams are held at once (some 60 bytes for each byte of text), unless one text alone is longer.
PART = 1 << 20
#: What texts without a letter get.
UNKNOWN = "und"
BLANK = 32


@cache
def kinds() -> np.ndarray:
    """For every code point 2 if it is a letter, 1 if it is a mark within words, else 0."""
    return np.fromiter(({"L": 2, "M": 1}.get(unicodedata.category(chr(c))[0], 0) for c in range(0x110000)), np.uint8, 0x110000)


def characters(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code points, owners, letters of each text) of texts in lower case, where all between words is one blank."""
    blank, none = pa.scalar(" ", pa.large_string()), pa.scalar("", pa.large_string())
    padded = pc.binary_join_element_wise(blank, pc.utf8_lower(texts.cast(pa.large_string()).fill_null("")), blank, none)
    _, offsets, data = padded.buffers()
    used = int(np.frombuffer(offsets, np.int64)[len(padded)])
    chars = np.frombuffer((data.to_pybytes()[:used] if used else b"").decode().encode("utf-32-le"), "<u4")
    owner = np.repeat(np.arange(len(padded)), pc.utf8_length(padded).to_numpy())
    kind = kinds()[chars]
    letters = np.bincount(owner, weights=kind == 2, minlength=len(padded)).astype(np.int64)
    chars = np.where(kind > 0, chars, BLANK).astype(np.int64)
    once = np.ones(len(chars), bool)
    once[1:] = (chars[1:] != BLANK) | (chars[:-1] != BLANK) | (owner[1:] != owner[:-1])
    return chars[once], owner[once], letters


def grams(chars: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(n-grams as numbers in the order of their characters, owners in rising order)."""
    word = chars != BLANK
    two, three = chars[:-1] << 42 | chars[1:] << 21, (chars[:-2] << 42 | chars[1:-1] << 21 | chars[2:]) if len(chars) > 2 else chars[:0]
    same2, same3 = owner[1:] == owner[:-1], (owner[2:] == owner[:-2]) & word[1:-1] if len(chars) > 2 else np.zeros(0, bool)
    found = np.concatenate([chars[word] << 42, two[same2 & (word[1:] | word[:-1])], three[same3]])
    owners = np.concatenate([owner[word], owner[:-1][same2 & (word[1:] | word[:-1])], owner[:-2][same3] if len(chars) > 2 else owner[:0]])
    order = np.argsort(owners, kind="stable")
    return found[order], owners[order]


def counted(found: np.ndarray, times: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(different n-grams in rising order, their counts)."""
    if times is None:
        return np.unique(found, return_counts=True)
    gram, back = np.unique(found, return_inverse=True)
    return gram, np.bincount(back, weights=times, minlength=len(gram)).astype(np.int64)


def most_frequent(found: np.ndarray, size: int) -> np.ndarray:
    """The `size` most frequent n-grams, of equal ones the first by their characters."""
    gram, n = counted(found)
    return gram[np.argsort(-n, kind="stable")[:size]]


def fit(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", where: str | None = None, size: int = PROFILE) -> DataFrame:
    """(lang, place, gram): the profiles of all languages, `size` n-grams each, from all texts of docs that `where` allows; rows with a null text or
    language teach nothing, languages whose texts have no letter get no profile. Written to the shared folder."""
    prepare(docs.sparkSession)
    some = (docs.filter(where) if where else docs).select(quoted(lang_col).alias("lang"), quoted(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def out() -> Iterator[pa.RecordBatch]:
            for lang, (gram, n) in held.items():
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(gram), pa.string()), pa.array(gram), pa.array(n)], ["lang", "gram", "n"])
            held.clear()

        for b in batches:
            coded = b.column("lang").dictionary_encode()
            names, place, at = coded.dictionary.to_pylist(), coded.indices.to_numpy(), 0
            for part in in_parts(b.column("text"), PART):
                own = place[at : at + len(part)]
                at += len(part)
                found, owner = grams(*characters(part)[:2])
                lang = own[owner]
                order = np.argsort(lang, kind="stable")
                found, ends = found[order], np.searchsorted(lang[order], np.arange(len(names) + 1))
                for k in np.unique(lang).tolist():
                    gram, n = counted(found[ends[k] : ends[k + 1]])
                    if names[k] in held:
                        before = held[names[k]]
                        gram, n = counted(np.concatenate([before[0], gram]), np.concatenate([before[1], n]))
                    held[names[k]] = gram, n
            if sum(len(gram) for gram, _ in held.values()) > HELD:
                yield from out()
        yield from out()

    counts = some.filter("lang is not null and text is not null").mapInArrow(run, "lang string, gram long, n long")
    counts = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    w = Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram")  # the least places of each task first, so `size` rows a task meet
    top = counts.withColumn("place", F.row_number().over(w) - 1).filter(F.col("place") < size)
    return table(top.select("lang", "place", "gram"), "profiles")


class Profiles:
    """Profiles of some languages as one table of places."""

    def __init__(self, size: int, languages: list[str], at: np.ndarray, place: np.ndarray, gram: np.ndarray):
        self.size, self.languages = size, languages
        self.grams, row = np.unique(gram, return_inverse=True)
        self.places = np.full((len(self.grams) + 1, len(languages)), -1, np.int32)  # the last row: n-grams of no profile
        self.places[row, at] = place

    def distances(self, own: np.ndarray) -> np.ndarray:
        """Out-of-place distance of a text's n-grams in order to each language."""
        at = np.minimum(np.searchsorted(self.grams, own), len(self.grams) - 1)
        at = np.where(self.grams[at] == own, at, len(self.grams))
        there = self.places[at]
        return np.where(there < 0, self.size, np.abs(there - np.arange(len(own))[:, None])).sum(axis=0)


def predict(docs: DataFrame, profiles: DataFrame, text_col: str = "text", size: int = PROFILE) -> DataFrame:
    """(row, lang_pred, score): a document's columns but the text, the language of least distance (of equal ones the first by
    name) and how much of the greatest possible distance it keeps clear of, from 0 to 1. size: that of the profiles.

    Null texts and texts without a letter get UNKNOWN and 0, as do all texts if there is no profile. Texts are read whole
    and may be of any length; equal texts get equal results. Columns of docs, of any name, stay in `row`."""
    spark = docs.sparkSession
    prepare(spark)
    many = profiles.select("lang").distinct().count()
    parts = 1 if many <= LANGUAGES else -(-many // max(1, LANGUAGES // 2))  # by hash, so about half of LANGUAGES each
    rest = docs.drop(text_col) if len(docs.columns) > 1 else docs
    out = docs.select(whole(rest), quoted(text_col).cast("string").alias("text"), F.lit(None).cast("string").alias("lang_pred"), F.lit(None).cast("long").alias("least"), F.lit(0).cast("long").alias("greatest"))
    for k in range(parts if many else 0):  # one pass over the texts, or one for each part of very many languages
        rows = profiles.filter(F.pmod(F.xxhash64("lang"), F.lit(parts)) == k).toArrow()
        names = sorted(set(rows.column("lang").to_pylist()))
        if not names:
            continue
        at = {n: i for i, n in enumerate(names)}
        shared = spark.sparkContext.broadcast(Profiles(size, names, np.array([at[n] for n in rows.column("lang").to_pylist()]), rows.column("place").to_numpy(), rows.column("gram").to_numpy()))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            own = shared.value
            for b in batches:
                lang, least, greatest = (b.column(c).to_pylist() for c in ("lang_pred", "least", "greatest"))
                at = 0
                for part in in_parts(b.column("text"), PART):
                    chars, owner, letters = characters(part)
                    found, owner = grams(chars, owner)
                    ends = np.searchsorted(owner, np.arange(len(part) + 1))
                    for i in np.flatnonzero(letters).tolist():
                        first = most_frequent(found[ends[i] : ends[i + 1]], own.size)
                        far = own.distances(first)
                        best = int(far.argmin())
                        if least[at + i] is None or (far[best], own.languages[best]) < (least[at + i], lang[at + i]):
                            lang[at + i], least[at + i], greatest[at + i] = own.languages[best], int(far[best]), len(first) * own.size
                    at += len(part)
                yield pa.RecordBatch.from_arrays([b.column("row"), b.column("text"), pa.array(lang, pa.string()), pa.array(least, pa.int64()), pa.array(greatest, pa.int64())], b.schema.names)

        out = out.mapInArrow(run, out.schema)
    return out.select("row", F.coalesce("lang_pred", F.lit(UNKNOWN)).alias("lang_pred"), F.coalesce(1 - F.try_divide("least", "greatest"), F.lit(0.0)).alias("score"))


def _sql(held_out: str) -> str:
    order = f"row_number() OVER (PARTITION BY who ORDER BY n DESC, g) - 1 AS place QUALIFY place < {PROFILE}"
    return f"""
WITH remainders AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, CAST(i AS BIGINT))) AS r),
docs AS (
  SELECT row_number() OVER () AS k, doc_id, lang, text, {held_out} AS held_out FROM documents, remainders),
words AS (SELECT k, ' ' || unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{M}}]+')) || ' ' AS w FROM docs),
different AS (SELECT k, w, count(*) AS n FROM words GROUP BY ALL),
cut AS (SELECT k, n, w, unnest(range(1, length(w) + 1)) AS i FROM different),
grams AS (
  SELECT k, g, sum(n) AS n FROM (SELECT k, n, unnest([substr(w, i, 1), CASE WHEN i < length(w) THEN substr(w, i, 2) END, CASE WHEN i < length(w) - 1 THEN substr(w, i, 3) END]) AS g FROM cut)
  WHERE g IS NOT NULL AND g <> ' ' GROUP BY ALL),
taught AS (SELECT lang AS who, g, sum(n) AS n FROM grams JOIN docs USING (k) WHERE NOT held_out AND lang IS NOT NULL GROUP BY ALL),
profiles AS (SELECT who AS lang, g, {order.replace("QUALIFY", "FROM taught QUALIFY")}),
own AS (SELECT who AS k, g, {order.replace("QUALIFY", "FROM (SELECT k AS who, g, n FROM grams) QUALIFY")}),
sizes AS (SELECT k, count(*) * {PROFILE} AS most FROM own GROUP BY k),
near AS (SELECT own.k, p.lang, sum({PROFILE} - abs(own.place - p.place)) AS less FROM own JOIN profiles p USING (g) GROUP BY ALL),
far AS (
  SELECT s.k, l.lang, most, most - coalesce(less, 0) AS distance FROM sizes s CROSS JOIN (SELECT DISTINCT lang FROM profiles) l LEFT JOIN near ON near.k = s.k AND near.lang = l.lang),
best AS (SELECT * FROM far QUALIFY row_number() OVER (PARTITION BY k ORDER BY distance, lang) = 1)
SELECT doc_id, held_out, CASE WHEN regexp_matches(text, '\\p{{L}}') THEN coalesce(b.lang, '{UNKNOWN}') ELSE '{UNKNOWN}' END AS lang_pred,
  CASE WHEN regexp_matches(text, '\\p{{L}}') THEN coalesce(1 - distance / most, 0) ELSE 0 END AS score
FROM docs LEFT JOIN best b USING (k)
"""


#: CRC-32 of the id by its table of 256 remainders.
SQL = _sql("xor(list_reduce(list_transform(range(1, strlen(coalesce(doc_id::VARCHAR, '')) + 1), lambda i: ascii(substr(doc_id::VARCHAR, i, 1))::BIGINT), lambda c, x: xor(c >> 8, r[(xor(c, x) & 255) + 1]), 4294967295), 4294967295) % 3 = 1")
