"""Text as columns: sentences, chunks, expansion, normal forms, similarity."""

from __future__ import annotations

import re
import textwrap
import unicodedata
from collections.abc import Callable, Iterator
from itertools import accumulate, pairwise

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import languages as L

PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def sentences(text: Column) -> Column:
    """Parts of a text that end in . ! or ? before white space, trimmed; empty ones are left out."""
    parts = F.transform(F.split(text, r"(?<=[.!?])\s+"), lambda x: F.regexp_replace(x, r"^\s+|\s+$", ""))
    return F.filter(parts, lambda x: x != "")


def by_language(lang: Column, make: Callable[[str], Column], codes, other: Column) -> Column:
    """The expression that make gives for each language, other for the rest."""
    out = None
    for code in codes:
        out = F.when(lang == code, make(code)) if out is None else out.when(lang == code, make(code))
    return out.otherwise(other)


def expand_abbreviations(text: Column, lang: Column) -> Column:
    """Replace abbreviations by words, whatever their case; languages without a table keep the text. One expression
    finds the texts that hold any at all; only these go through the replacements."""

    def make(code: str) -> Column:
        end = r"\b" if code == "ru" else r"\."
        table, out = L.ABBREVIATIONS[code], text
        for short, word in table.items():
            out = F.regexp_replace(out, rf"(?iu)\b{short}{end}", word)
        return F.when(F.rlike(text, F.lit(rf"(?iu)\b(?:{'|'.join(table)}){end}")), out).otherwise(text)

    return by_language(lang, make, L.ABBREVIATIONS, text)


def expand_symbols(text: Column, lang: Column) -> Column:
    """Replace symbols by words and trim; languages without a table keep the text."""

    def make(code: str) -> Column:
        out = text
        for symbol, word in L.SYMBOLS[code].items():
            out = F.replace(F.replace(out, F.lit(symbol), F.lit(f" {word} ")), F.lit("  "), F.lit(" "))
        return F.trim(out)

    return by_language(lang, make, L.SYMBOLS, text)


def collapse(text: Column) -> Column:
    return F.regexp_replace(text, r"\s+", " ")


def tts_normalize(text: Column) -> Column:
    """One mark instead of runs of . ! and ?, no commas and semicolons, single blanks, and a mark at the end."""
    out = text
    for mark in (r"\.", "!", r"\?"):
        out = F.regexp_replace(out, mark + "{2,}", mark.strip("\\"))
    out = F.regexp_replace(F.translate(out, ",;", ""), r"\s{2,}", " ")
    return F.trim(F.when((out != "") & ~F.right(out, F.lit(1)).isin(".", "!", "?"), F.concat(out, F.lit("."))).otherwise(out))


def strip_punctuation(text: Column) -> Column:
    """Without ASCII punctuation, in lower case: the form in which texts are compared."""
    return F.lower(F.translate(text, PUNCTUATION, ""))


def words(text: Column) -> Column:
    return F.filter(F.split(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}_\s]", ""), r"\s+"), lambda x: x != "")


def word_jaccard(a: Column, b: Column) -> Column:
    """Shared words over all words of both texts; 0 for two texts without words."""
    both = F.size(F.array_union(a, b))
    return F.when(both == 0, 0.0).otherwise(F.size(F.array_intersect(a, b)) / both)


def limit_of(lang: Column) -> Column:
    code = F.split_part(lang, F.lit("-"), F.lit(1))
    return F.coalesce(F.create_map(*[F.lit(x) for kv in L.CHAR_LIMITS.items() for x in kv])[code], F.lit(L.DEFAULT_LIMIT))


def cautious_limit(lang: Column) -> Column:
    table = {k: min(v, L.CHAR_LIMITS.get(k, v)) for k, v in L.CAUTIOUS_LIMITS.items()}
    return F.coalesce(F.create_map(*[F.lit(x) for kv in table.items() for x in kv])[lang], F.lit(L.CAUTIOUS_DEFAULT))


def translation_code(name: Column) -> Column:
    low = F.lower(name)
    return F.coalesce(F.create_map(*[F.lit(x) for kv in L.TRANSLATION_CODES.items() for x in kv])[low], F.concat(low, F.lit("_Latn")))


def synthesis_code(code: Column) -> Column:
    """Two-letter code of a three-letter or translation code; unsupported languages give en."""
    short = F.coalesce(F.create_map(*[F.lit(x) for kv in L.TWO_LETTERS.items() for x in kv])[F.substring(code, 1, 3)], code)
    return F.when(short.isin(*L.SUPPORTED), short).otherwise("en")


def language_code(name: Column) -> Column:
    """Code of a language by its code, name or alias, in any case; null if there is none."""
    known = {c: c for c in L.LANGUAGE_NAMES} | {n: c for c, n in L.LANGUAGE_NAMES.items()} | L.LANGUAGE_ALIASES
    return F.create_map(*[F.lit(x) for kv in known.items() for x in kv])[F.lower(name)]


def _chunks(parts: list[str], limit: int, grows: bool, between: str = " ", more: int = 0) -> list[str]:
    """Parts joined as long as the lengths of both sides, and more, keep to the limit. A part that does not fit begins
    a chunk, wrapped into lines where it is longer than the limit; with grows the next part may join it."""
    out, room = [], False  # room: the last chunk may grow
    for part in parts:
        if len(out[-1] if room else "") + len(part) + more <= limit:
            out = [*out[:-1], out[-1] + between + part] if room else [*out, part]
            room = True
            continue
        out += textwrap.wrap(part, limit, drop_whitespace=True, break_on_hyphens=False, tabsize=1) if len(part) > limit else [part]
        room = grows
    return out


def _sentences(t: str) -> list[str]:
    return [x for x in (y.strip() for y in re.split(r"(?<=[.!?])\s+", t)) if x]


def _clauses(sentence: str, most: int) -> list[str]:
    """A long sentence in chunks, by one rule over places: a chunk ends at the first mark of , : ; - that lies more than `most`
    behind its start, or at the last blank within `most` where there is one. What the marks leave is cut once more by it."""

    def end(start: int, mark: int) -> int:
        if mark - start <= most:
            return start
        begin = mark - len(sentence[start:mark].lstrip())
        blank = sentence.rfind(" ", begin + 1, begin + most) if len(sentence[begin:mark].rstrip()) > most else -1
        return mark if blank < 0 else blank

    places = [*accumulate((m.start() for m in re.finditer(r"[,:;\-]", sentence)), end, initial=0)]
    places += [end(places[-1], len(sentence)), len(sentence)]
    return [sentence[a:b].strip() for a, b in pairwise(places)]


#: Texts that are Python's own strings at once.
SLICE = 256


def over_texts(split: Callable[[str, int], list[str]]) -> Callable[[Column, Column], Column]:
    """split(text, limit) as a function of columns: one map over batches of whole texts, handed on by SLICE of them, so that
    neither a batch's strings nor its results are held together; null stays null."""

    @F.arrow_udf(T.ArrayType(T.StringType()))
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, limits in batches:
            for at in range(0, len(texts), SLICE):
                pairs = zip(texts.slice(at, SLICE).to_pylist(), limits.slice(at, SLICE).to_pylist(), strict=True)
                yield pa.array([None if t is None else split(t, n) for t, n in pairs], pa.list_(pa.string()))

    return run


#: Chunks of whole sentences; a text below the limit is one chunk. In pack_sentences the next sentence may join one that
#: began a chunk, in pack_closed it may not.
pack_sentences = over_texts(lambda t, n: _chunks(_sentences(t), n, True) if len(t) >= n else [t.lstrip()])
pack_closed = over_texts(lambda t, n: [c for c in (_chunks(_sentences(t), n, False) if len(t) >= n else [t.strip()]) if c])
#: Chunks of parts between '. ', joined with it again.
fallback_pack = over_texts(lambda t, n: _chunks([x for x in (y.strip() for y in t.split(". ")) if x], n, False, ". ", 1) or [t])
#: Sentences; those over limit - 10 in clauses.
_smart = over_texts(lambda t, n: [c for s in _sentences(t) for c in (_clauses(s, n - 10) if len(s) > n - 10 else [s]) if c])


def smart_chunks(text: Column, limit: Column) -> Column:
    """Chunks that keep to limit - 10 where their marks and blanks allow it, each normalized for synthesis."""
    return F.filter(F.transform(_smart(text, limit), tts_normalize), lambda x: (x != "") & (x != "."))


def clean(text: Column, lang: Column, numbers: Callable[[Column, Column], Column] | None = None) -> Column:
    """No double quotes, Turkish letters folded, lower case, then numbers, abbreviations, symbols and blanks."""
    out = F.replace(text, F.lit('"'), F.lit(""))
    out = F.when(lang == "tr", F.translate(out, "İÖÜ", "iöü")).otherwise(out)
    out = F.lower(out)
    if numbers is not None:
        out = numbers(out, lang)
    return collapse(expand_symbols(expand_abbreviations(out, lang), lang))


# What the normal forms drop, in order: <…> and […], then (…).
BRACKETS = (r"[<\[][^>\]]*[>\]]", r"\(([^)]+?)\)")
# Letters that decomposition leaves as they are.
LETTERS = {"œ": "oe", "Œ": "OE", "ø": "o", "Ø": "O", "æ": "ae", "Æ": "AE", "ß": "ss", "ẞ": "SS", "đ": "d", "Đ": "D", "ð": "d", "Ð": "D", "þ": "th", "Þ": "th", "ł": "l", "Ł": "L"}


def folded(t: str) -> str:
    """Compatibility decomposition without marks; letters that do not decompose are spelled out."""
    if t.isascii():
        return t
    return "".join(LETTERS.get(c, c) for c in unicodedata.normalize("NFKD", t) if unicodedata.category(c) != "Mn")


@F.pandas_udf(T.StringType())
def fold_diacritics(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else folded(t))


@F.pandas_udf(T.StringType())
def _composed(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t))


def compatible(text: Column) -> Column:
    """Compatibility composition. Texts of ASCII and of the Latin letters that it leaves alone never reach Python."""
    other = F.when(F.rlike(text, F.lit(r"[^\x00-\x7FÀ-ÖØ-öø-ÿ]")), text)
    return F.coalesce(_composed(other), text)


def basic_normalize(text: Column, diacritics: bool = True, letters: bool = False) -> Column:
    """Lower case without <…>, […] and (…); marks, symbols and punctuation of the composed form become blanks; runs of
    blanks become one. Without diacritics, letters lose their marks first; with letters, characters (graphemes) are
    set apart by blanks."""
    out = F.lower(text)
    for pattern in BRACKETS:
        out = F.regexp_replace(out, pattern, "")
    out = F.lower(F.regexp_replace(compatible(out) if diacritics else fold_diacritics(out), r"[\p{M}\p{S}\p{P}]", " "))
    if letters:
        out = F.array_join(F.regexp_extract_all(out, F.lit(r"\X"), F.lit(0)), " ")
    return collapse(out)


def spelling(text: Column, table: dict[str, str]) -> Column:
    """Replace whole words by the table's."""
    m = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    return F.array_join(F.transform(F.split(text, " "), lambda w: F.coalesce(F.try_element_at(m, w), w)), " ")


@F.pandas_udf(T.DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratio of matching blocks of two texts, in percent; the order of the arguments matters. 0 if one is empty."""
    from difflib import SequenceMatcher

    return pd.Series([SequenceMatcher(None, x, y).ratio() * 100 if x and y else 0.0 for x, y in zip(a, b, strict=True)], dtype="float64")


def similarity_pct(a: Column, b: Column) -> Column:
    """0.7 of the sequence ratio and 0.3 of the word overlap of the two compared forms, in percent."""
    form = lambda c: F.regexp_replace(collapse(F.lower(F.trim(c))), r"[^\p{L}\p{N}_\s]", "")
    x, y = form(a), form(b)
    return F.when((F.coalesce(x, F.lit("")) == "") | (F.coalesce(y, F.lit("")) == ""), 0.0).otherwise(0.7 * sequence_ratio(x, y) + 30 * word_jaccard(words(a), words(b)))


@F.arrow_udf(T.DoubleType())
def compression_ratio(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Characters of the text over bytes of its zlib form; high values mean repetition."""
    import zlib

    for texts in batches:
        yield pa.array((None if t is None else len(t) / len(zlib.compress(t.encode())) for t in (x.as_py() for x in texts)), pa.float64(), size=len(texts))


def decoding_failed(ratio: Column, avg_logprob: Column, no_speech: Column) -> Column:
    """Flags of a decoding: repetitive over 2.4, unlikely under -1.0, silent where no speech is likelier than 0.6."""
    return F.struct((ratio > 2.4).alias("repetitive"), (avg_logprob < -1.0).alias("unlikely"), ((no_speech > 0.6) & (avg_logprob < -1.0)).alias("silent"))


def video_id(url: Column) -> Column:
    """The video's id by the form of its address; null for clips and unknown forms."""
    after = lambda mark, n: F.substring(F.element_at(F.split(url, F.lit(rf"\Q{mark}\E").cast("string")), 2), 1, n)
    out = F.when(F.contains(url, F.lit("clip")), F.lit(None).cast("string"))
    # What stands before the id in each form of address, in order, and the id's length.
    for mark, n in (("watch?v=", 11), ("shorts/", 11), ("youtu.be/", 11), ("&v=", 11), ("bilibili.com/video/", 12), ("douyin.com/video/", 19), ("douyin.com/user/self?modal_id=", 19)):
        out = out.when(F.contains(url, F.lit(mark)), after(mark, n))
    return out


def pace(words_: Column, seconds: Column) -> Column:
    """Speed for so many words in so many seconds: words a second over 5, within 0.9 and 1.1."""
    return F.greatest(F.lit(0.9), F.least(F.lit(1.1), words_ / seconds / 5.0))


def duration_fix(actual: Column, target: Column) -> Column:
    """Speed factor that fits a clip to its target; 1 if it is off by 5 % at most or the factor is not within 0.9 and 1.1."""
    factor = actual / target
    return F.when((F.abs(actual - target) / target > 0.05) & factor.between(0.9, 1.1), factor).otherwise(1.0)


def timestamp_tokens(tokens: Column, base: int, step: float = 0.02) -> Column:
    """Token ids as text: ids from base on become <|seconds|> marks, others stand as they are, blank-joined."""
    return F.array_join(F.transform(tokens, lambda t: F.when(t >= base, F.format_string("<|%.2f|>", ((t - base) * step).cast("double"))).otherwise(t.cast("string"))), " ")


def to_wire(text: Column, lang: Column) -> Column:
    """[lang] before the text, without the region, and [SPACE] for blanks."""
    return F.replace(F.concat(F.lit("["), F.split_part(lang, F.lit("-"), F.lit(1)), F.lit("]"), text), F.lit(" "), F.lit("[SPACE]"))


def from_wire(text: Column) -> Column:
    return F.replace(F.replace(F.replace(F.replace(text, F.lit(" "), F.lit("")), F.lit("[SPACE]"), F.lit(" ")), F.lit("[STOP]"), F.lit("")), F.lit("[UNK]"), F.lit(""))
