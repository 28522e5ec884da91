"""Numbers in texts as words, for English, Spanish, French and German.

Numbers are spelled by each language's rules below a million millions; larger ones stay as digits. The words
come from a pandas UDF over whole texts; texts without digits never reach it.
"""

from __future__ import annotations

import re
from fractions import Fraction

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import BRACKETS, folded, spelling

LANGUAGES = ("en", "es", "fr", "de")

# The words for 0 to 19 and the tens.
SMALL = {
    "en": "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen".split(),
    "es": "cero uno dos tres cuatro cinco seis siete ocho nueve diez once doce trece catorce quince dieciséis diecisiete dieciocho diecinueve".split(),
    "fr": "zéro un deux trois quatre cinq six sept huit neuf dix onze douze treize quatorze quinze seize dix-sept dix-huit dix-neuf".split(),
    "de": "null eins zwei drei vier fünf sechs sieben acht neun zehn elf zwölf dreizehn vierzehn fünfzehn sechzehn siebzehn achtzehn neunzehn".split(),
}
TENS = {
    "en": "twenty thirty forty fifty sixty seventy eighty ninety".split(),
    "es": "veinte treinta cuarenta cincuenta sesenta setenta ochenta noventa".split(),
    "fr": "vingt trente quarante cinquante soixante soixante quatre-vingt quatre-vingt".split(),
    "de": "zwanzig dreißig vierzig fünfzig sechzig siebzig achtzig neunzig".split(),
}
# Spanish twenties and hundreds that are not regular.
TWENTIES_ES = "veintiuno veintidós veintitrés veinticuatro veinticinco veintiséis veintisiete veintiocho veintinueve".split()
HUNDREDS_ES = "ciento doscientos trescientos cuatrocientos quinientos seiscientos setecientos ochocientos novecientos".split()
# The decimal mark's word and what joins an amount to its cents.
POINT = {"en": "point", "es": "punto", "fr": "virgule", "de": "Komma"}
CENTS_AFTER = {"en": ", ", "es": " con ", "fr": " et ", "de": " und "}
# One and many units of each currency, then of its hundredth.
MONEY = {
    "en": {"$": ("dollar", "dollars", "cent", "cents"), "€": ("euro", "euro", "cent", "cents"), "£": ("pound sterling", "pounds sterling", "penny", "pence")},
    "es": {"$": ("dólar", "dólares", "centavo", "centavos"), "€": ("euro", "euros", "céntimo", "céntimos"), "£": ("libra", "libras", "penique", "peniques")},
    "fr": {"$": ("dollar", "dollars", "cent", "cents"), "€": ("euro", "euros", "centime", "centimes"), "£": ("livre", "livres", "penny", "pence")},
    "de": {"$": ("Dollar", "Dollar", "Cent", "Cent"), "€": ("Euro", "Euro", "Cent", "Cent"), "£": ("Pfund", "Pfund", "Penny", "Pence")},
}
# Ordinals that do not follow their language's rule.
FIRST = {
    "en": {"one": "first", "two": "second", "three": "third", "five": "fifth", "eight": "eighth", "nine": "ninth", "twelve": "twelfth"},
    "es": dict(zip(range(1, 11), "primero segundo tercero cuarto quinto sexto séptimo octavo noveno décimo".split(), strict=True)),
    "fr": {"un": "premier", "cinq": "cinquième", "neuf": "neuvième"},
    "de": {"eins": "erste", "drei": "dritte", "sieben": "siebte", "acht": "achte"},
}
# What marks an ordinal behind digits.
ORDINAL = {"en": r"([0-9]+)(?:st|nd|rd|th)", "es": r"([0-9]+)(?:º|ª|er|o|a|os|as)", "fr": r"([0-9]+)(?:º|ª|er|re|e|ème)", "de": r"([0-9]+)(?:st|nd|rd|th|º|ª|\.(?=\s|$))"}


def _below_100(n: int, lang: str) -> str:
    small, tens = SMALL[lang], TENS[lang]
    if n < 20:
        return small[n]
    ten, one = divmod(n, 10)
    if lang == "fr":
        if ten in (7, 9):  # counted on from sixty and eighty
            return f"{tens[ten - 2]}{' et ' if n == 71 else '-'}{small[10 + one]}"
        if not one:
            return tens[ten - 2] + ("s" if ten == 8 else "")
        return f"{tens[ten - 2]} et un" if one == 1 and ten != 8 else f"{tens[ten - 2]}-{small[one]}"
    if not one:
        return tens[ten - 2]
    if lang == "de":
        return f"{'ein' if one == 1 else small[one]}und{tens[ten - 2]}"
    if lang == "es":
        return TWENTIES_ES[one - 1] if ten == 2 else f"{tens[ten - 2]} y {small[one]}"
    return f"{tens[ten - 2]}-{small[one]}"


def _below_1000(n: int, lang: str) -> str:
    hundred, rest = divmod(n, 100)
    if not hundred:
        return _below_100(rest, lang)
    tail = _below_100(rest, lang) if rest else ""
    if lang == "en":
        return f"{SMALL['en'][hundred]} hundred" + (f" and {tail}" if tail else "")
    if lang == "es":
        return "cien" if n == 100 else " ".join(filter(None, [HUNDREDS_ES[hundred - 1], tail]))
    if lang == "fr":
        head = "cent" if hundred == 1 else f"{SMALL['fr'][hundred]} cent" + ("" if tail else "s")
        return " ".join(filter(None, [head, tail]))
    return ("ein" if hundred == 1 else SMALL["de"][hundred]) + "hundert" + tail


def cardinal(n: int, lang: str) -> str:
    """The words for a whole number."""
    if n >= 10**12:
        return str(n)
    if n < 1000:
        return _below_1000(n, lang)
    if lang in ("es", "fr", "de") and n < 10**6:
        high, low = divmod(n, 1000)
        tail = _below_1000(low, lang) if low else ""
        if lang == "de":
            return ("ein" if high == 1 else _below_1000(high, lang)) + "tausend" + tail
        head = "" if high == 1 else _below_1000(high, lang)
        if lang == "es":
            head = re.sub("veintiuno$", "veintiún", head)
            head = re.sub("uno$", "un", head)
        if lang == "fr":
            head = re.sub("(cent|vingt)s$", r"\1", head)
        return " ".join(filter(None, [head, "mil" if lang == "es" else "mille", tail]))
    # The words for 10 ** 9 (thousand millions in Spanish), 10 ** 6 and 10 ** 3.
    scales = {"en": [(10**9, "billion", "billion"), (10**6, "million", "million"), (10**3, "thousand", "thousand")], "es": [(10**6, "millón", "millones")], "fr": [(10**9, "milliard", "milliards"), (10**6, "million", "millions")], "de": [(10**9, "Milliarde", "Milliarden"), (10**6, "Million", "Millionen")]}
    out = []
    for size, one, many in scales[lang]:
        count, n = divmod(n, size)
        if count:
            word = {"es": "un", "de": "eine"}.get(lang, SMALL[lang][1]) if count == 1 else cardinal(count, lang)
            out.append(f"{word} {one if count == 1 else many}")
    if n:
        out.append(("and " if lang == "en" and n < 100 else "") + cardinal(n, lang))
    return (", " if lang == "en" else " ").join(out).replace(", and ", " and ")


def ordinal(n: int, lang: str) -> str:
    word, own = cardinal(n, lang), FIRST[lang]
    if lang == "es":
        return own.get(n, word)
    if lang == "en":
        head, _, last = re.match(r"(.*?)(^|[ -])([^ -]*)$", word).groups() if not re.search(r"[ -]", word) else (*re.match(r"(.*[ -])()([^ -]*)$", word).groups(),)
        return head + (own[last] if last in own else last[:-1] + "ieth" if last.endswith("y") else last + "th")
    if lang == "fr":
        if n == 1:
            return own["un"]
        for k in ("cinq", "neuf"):
            if word.endswith(k):
                return word[: -len(k)] + own[k]
        return re.sub("e$", "", re.sub("(cent|vingt|million)s$", r"\1", word)) + "ième"
    last = next((k for k in own if word.endswith(k) and (k == word or n > 100)), None)
    return word[: -len(last)] + own[last] if last else word + ("te" if n % 100 < 20 and n % 100 else "ste")


def _decimal(text: str, lang: str) -> str:
    whole, part = re.split("[.,]", text)
    spelled = " ".join(SMALL[lang][int(d)] for d in part) if part.startswith("0") or lang == "en" or len(part) == 1 else cardinal(int(part), lang)
    return f"{cardinal(int(whole), lang)} {POINT[lang]} {spelled}"


def _amount(text: str, sign: str, lang: str) -> str:
    whole, _, part = re.sub("[^0-9.,]", "", text).replace(",", ".").rpartition(".") if re.search("[.,]", text) else (re.sub("[^0-9]", "", text), "", "")
    n, cents = int(re.sub("[^0-9]", "", whole) or 0), int((part + "00")[:2]) if part else 0
    one, many, small, smalls = MONEY[lang][sign]
    unit = {"es": "un", "de": "ein"}.get(lang, SMALL[lang][1]) if n == 1 else cardinal(n, lang)
    out = f"{unit} {one if n == 1 else many}"
    return out + (f"{CENTS_AFTER[lang]}{cardinal(cents, lang)} {small if cents == 1 else smalls}" if cents else "")


def expand(text: str, lang: str) -> str:
    """Money, decimals, ordinals and whole numbers as words; thousands marks go first. Other languages keep digits."""
    if lang not in LANGUAGES or not re.search("[0-9]", text):
        return text
    mark = "," if lang == "en" else "."
    text = re.sub(rf"\b\d{{1,3}}(?:{re.escape(mark)}\d{{3}})+(?!\d)", lambda m: m[0].replace(mark, ""), text)
    for sign in ("£", "$", "€"):
        s = re.escape(sign)
        text = re.sub(rf"{s}[0-9.,]*[0-9]+|[0-9.,]*[0-9]+{s}", lambda m, sign=sign: _amount(m[0], sign, lang), text)
    text = re.sub(r"[0-9]+[.,][0-9]+", lambda m: _decimal(m[0], lang), text)
    text = re.sub(ORDINAL[lang], lambda m: ordinal(int(m[1]), lang), text)
    return re.sub("[0-9]+", lambda m: cardinal(int(m[0]), lang), text)


@F.pandas_udf(T.StringType())
def _expand(texts: pd.Series, langs: pd.Series) -> pd.Series:
    pairs = list(zip(texts, langs, strict=True))
    known = {(t, g): None if t is None else expand(t, g) for t, g in set(pairs)}  # equal texts of a batch once
    return pd.Series([known[x] for x in pairs], dtype="object")


def expand_numbers(text: Column, lang: Column) -> Column:
    some = F.rlike(text, F.lit("[0-9]")) & lang.isin(*LANGUAGES)
    return F.coalesce(_expand(F.when(some, text), lang), text)  # other texts don't travel to Python


# English number words beyond 0 to 19 and the tens: names of powers of a thousand.
SCALES = "thousand million billion trillion quadrillion quintillion sextillion septillion octillion nonillion decillion".split()
SCALE_WORDS = {"hundred": 100} | {w: 1000 ** (i + 1) for i, w in enumerate(SCALES)}
# Ordinals and plurals that are not the word with th or s, and how the others change their end.
ODD_ORDINALS = {"one": "first", "two": "second", "three": "third", "five": "fifth", "eight": "eighth", "nine": "ninth", "twelve": "twelfth"}
MARKS = {"first": "st", "second": "nd", "third": "rd"}
# Words before and behind a number that become its sign or mark.
SIGNS = {"minus": "-", "negative": "-", "plus": "+", "positive": "+"}
CURRENCIES = {"pound": "£", "pounds": "£", "euro": "€", "euros": "€", "dollar": "$", "dollars": "$", "cent": "¢", "cents": "¢"}
# What is done to a text before its words are read (blanks for hyphens and between digits and letters, none before an
# ending) and after (cents joined to their amount, "one" for 1).
BEFORE_WORDS = [(r"(?<=[a-z])-(?=[a-z])", " "), (r"([a-z])([0-9])", r"\1 \2"), (r"([0-9])([a-z])", r"\1 \2"), (r"([0-9])\s+(st|nd|rd|th|s)\b", r"\1\2")]
HALF = re.compile(r"(\S+)\s+and\s+a\s+half\b")
CENTS, ONLY_CENTS, LONE_ONE = re.compile(r"([€£$])([0-9]+) (?:and )?¢([0-9]{1,2})\b"), re.compile(r"[€£$]0.([0-9]{1,2})\b"), re.compile(r"\b1(s?)\b")
NUMERAL = re.compile(r"([-+£€$¢]?)([0-9]+(?:\.[0-9]+)?)$")


def _vocabulary() -> dict[str, tuple[str, int, str]]:
    """Number words: (unit, ten or scale; number; what follows the digits of an ordinal or a plural)."""
    out = {w: ("unit" if i else "zero", i, "") for i, w in enumerate(SMALL["en"])} | {"o": ("zero", 0, ""), "oh": ("zero", 0, "")}
    out |= {w: ("ten", 10 * (i + 2), "") for i, w in enumerate(TENS["en"])} | {w: ("scale", n, "") for w, n in SCALE_WORDS.items()}
    for w, (kind, n, _) in list(out.items()):
        if w in ("o", "oh"):
            continue
        ordinal = ODD_ORDINALS.get(w, w[:-1] + "ieth" if w.endswith("y") else w + "th")
        out[ordinal] = (kind if n else "unit", n, MARKS.get(ordinal, "th"))
        if n:
            out[w[:-1] + "ies" if w.endswith("y") else w + ("es" if w.endswith("x") else "s")] = (kind, n, "s")
    return out


VOCABULARY = _vocabulary()
#: Letters of the kinds of words in PHRASE; those of ordinals and plurals are capitals.
LETTERS_OF = {"zero": "z", "unit": "u", "ten": "t", "scale": "k"}
#: A number phrase over such letters: sign; numeral (n, without sign and point i) or words, with "and" (a) only behind a scale; point (p) and digits; an
#: ordinal or plural at the end; currency (c), percent (%) or per cent (rc). d: double or triple. Every part may lack.
WORD = "(?:[zutk]|d[zu])"
PHRASE = re.compile(rf"(?P<sign>s?)(?P<whole>(?:[ni]|{WORD})(?:(?:(?<=k)a)?{WORD})*)?(?P<part>p(?:[zuti]|d[zu]){WORD}*)?(?P<last>(?:(?<=k)a)?[ZUTK])?(?P<tail>[c%]|rc)?")


#: Letters of the words of PHRASE.
LETTERS = {"and": "a", "point": "p", "per": "r", "percent": "%", "double": "d", "triple": "d"} | dict.fromkeys(SIGNS, "s") | dict.fromkeys(CURRENCIES, "c")
LETTERS |= {w: LETTERS_OF[kind].upper() if mark else LETTERS_OF[kind] for w, (kind, _, mark) in VOCABULARY.items()}


def _letter(word: str) -> str:
    known = LETTERS.get(word)
    if known is None and word[-1].isdecimal() and (m := NUMERAL.match(word)):
        return "n" if m[1] or "." in m[2] else "i"
    return known or "x"


def _below_scales(words: list[str]) -> str:
    """Digits of words without a scale: tens take a unit, all else is written one behind the other. A numeral that ends in
    enough zeros takes what follows."""
    pieces, k = [], 0
    while k < len(words):
        n = [VOCABULARY[w][1] if w in VOCABULARY else w for w in words[k : k + 2]]
        kinds = [VOCABULARY[w][0] if w in VOCABULARY else w for w in words[k : k + 2]]
        if kinds[0] in ("double", "triple"):
            pieces.append(str(n[1]) * (2 if kinds[0] == "double" else 3))
        elif kinds[0] == "ten" and len(n) > 1 and kinds[1] == "unit" and n[1] < 10:
            pieces.append(str(n[0] + n[1]))
        else:
            pieces.append(str(n[0]))
            k -= 1
        k += 2
    first = "".join(pieces[:1])
    if len(pieces) > 1 and words[0] not in VOCABULARY and first.isdigit() and pieces[1][0] != "0" and int(first) and int(first) % 10 ** len(pieces[1]) == 0:
        pieces[:2] = [str(int(first) + int(pieces[1]))]
    return "".join(pieces)


def _phrase_digits(words: list[str]) -> str:
    """Digits of a phrase without its sign: what stands before the largest scale times it, plus what follows if that is less."""
    scales = [VOCABULARY[w][1] for w in words if w in VOCABULARY and VOCABULARY[w][0] == "scale"]
    if not scales:
        return _below_scales(words)
    at = next(k for k, w in enumerate(words) if w in VOCABULARY and VOCABULARY[w][:2] == ("scale", max(scales)))
    left, after = _phrase_digits(words[:at]) or "1", words[at + 1 :]
    product = Fraction(left) * max(scales)
    if product.denominator > 1:
        return f"{left} {_phrase_digits(words[at:])}"
    if len(scales) == 1:
        return _below_scales([str(product.numerator), *after])
    right = _phrase_digits(after)
    if right.isdigit() and int(right) < max(scales):
        return str(product.numerator + int(right))
    return f"{product.numerator}{right}"


def _spoken(words: list[str], m: re.Match) -> str:
    """Digits, sign and mark of the phrase that m found in the letters of words."""
    at = m.start("last") if m["last"] else m.end("part") if m["part"] else m.end("whole")
    body = [w for w in words[m.end("sign") : at] if w != "and"]
    sign = SIGNS[words[m.start()]] if m["sign"] else ""
    if m["whole"] and (numeral := NUMERAL.match(body[0])):
        sign, body[0] = numeral[1] or sign, numeral[2] if "." in numeral[2] else str(int(numeral[2]))
    mark = ""
    if m["last"]:
        ordinal = words[m.end("last") - 1]
        kind, n, mark = VOCABULARY[ordinal]
        body.append(next(w for w, v in VOCABULARY.items() if v == (kind, n, "")))
    if m["part"]:
        point = body.index("point")
        many = next((k for k, w in enumerate(body) if k > point and w in VOCABULARY and VOCABULARY[w][0] == "scale"), len(body))
        whole, behind = _phrase_digits(body[:point]), _below_scales(body[point + 1 : many])
        amount = _phrase_digits([f"{whole or 0}.{behind}", *body[many:]]) if many < len(body) else f"{whole}.{behind}"
    else:
        amount = _phrase_digits(body)
    if m["tail"] in ("%", "rc"):
        mark = "%"
    elif m["tail"]:
        sign = CURRENCIES[words[m.end() - 1]]
    return f"{sign}{amount}{mark}"


def digits(text: str) -> str:
    """Spelled English numbers as digits: twenty one -> 21, one hundred and two -> 102, three point five -> 3.5, two and
    a half -> 2.5, one oh one -> 101, double four -> 44, ten percent -> 10%, $20 million -> $20000000, two euros and ten
    cents -> €2.10, twenty first -> 21st, nineteen sixties -> 1960s, minus three -> -3. A 1 alone is written one."""
    if "half" in text:
        text = HALF.sub(lambda m: f"{m[1]} point five" if VOCABULARY.get(m[1], ("", 0, "s"))[2] == "" else m[0], text)
    if "-" in text or re.search("[0-9]", text):  # each rule needs one of them
        for pattern, word in BEFORE_WORDS:
            text = re.sub(pattern, word, text)
    words = text.split()
    letters, out, k = "".join(map(_letter, words)), [], 0
    while k < len(words):
        if letters[k] == "x":  # no word of a number begins a phrase
            out.append(words[k])
            k += 1
            continue
        m = PHRASE.match(letters, k)
        if not (m["whole"] or m["part"] or m["last"]):
            out.append(words[k])
            k += 1
            continue
        if (m["tail"] == "rc" and words[m.end() - 1] != "cent") or (m["tail"] and m["last"]):
            m = PHRASE.match(letters, k, m.start("tail"))
        out.append(_spoken(words, m))
        k = m.end()
        if letters[k - 1 : k + 2] in ("kan", "kai"):  # "3 hundred and 7" is two numbers, and neither needs the "and"
            k += 1
    said = CENTS.sub(lambda m: f"{m[1]}{m[2]}.{int(m[3]):02d}", " ".join(out))
    return LONE_ONE.sub(r"one\1", ONLY_CENTS.sub(lambda m: f"¢{int(m[1])}", said))


@F.pandas_udf(T.StringType())
def number_digits(texts: pd.Series) -> pd.Series:
    known = {t: None if t is None else digits(t) for t in set(texts)}  # equal texts of a batch once
    return pd.Series([known[t] for t in texts], dtype="object")


# Contractions and titles of the English normal form, in order.
CONTRACTIONS = [
    (r"\bwon't\b", "will not"), (r"\bcan't\b", "can not"), (r"\blet's\b", "let us"), (r"\bain't\b", "aint"), (r"\by'all\b", "you all"),
    (r"\bwanna\b", "want to"), (r"\bgotta\b", "got to"), (r"\bgonna\b", "going to"), (r"\bi'ma\b", "i am going to"), (r"\bimma\b", "i am going to"),
    (r"\bwoulda\b", "would have"), (r"\bcoulda\b", "could have"), (r"\bshoulda\b", "should have"), (r"\bma'am\b", "madam"),
    (r"\bmr\b", "mister "), (r"\bmrs\b", "missus "), (r"\bst\b", "saint "), (r"\bdr\b", "doctor "), (r"\bprof\b", "professor "),
    (r"\bcapt\b", "captain "), (r"\bgov\b", "governor "), (r"\bald\b", "alderman "), (r"\bgen\b", "general "), (r"\bsen\b", "senator "),
    (r"\brep\b", "representative "), (r"\bpres\b", "president "), (r"\brev\b", "reverend "), (r"\bhon\b", "honorable "), (r"\basst\b", "assistant "),
    (r"\bassoc\b", "associate "), (r"\blt\b", "lieutenant "), (r"\bcol\b", "colonel "), (r"\bjr\b", "junior "), (r"\bsr\b", "senior "), (r"\besq\b", "esquire "),
    (r"'d been\b", " had been"), (r"'s been\b", " has been"), (r"'d gone\b", " had gone"), (r"'s gone\b", " has gone"), (r"'d done\b", " had done"), (r"'s got\b", " has got"),
    (r"n't\b", " not"), (r"'re\b", " are"), (r"'s\b", " is"), (r"'d\b", " would"), (r"'ll\b", " will"), (r"'t\b", " not"), (r"'ve\b", " have"), (r"'m\b", " am"),
]
# What goes before them (brackets, fillers, a blank before an apostrophe), and between them and the
# numbers (commas and final points at digits, every symbol but those of amounts), and after the numbers (lone symbols).
BEFORE = [*((p, "") for p in BRACKETS), (r"\b(hmm|mm|mhm|mmm|uh|um)\b", ""), (r"\s+'", "'")]
AROUND = [(r"(\d),(\d)", "$1$2"), (r"\.([^0-9]|$)", " $1")]
SYMBOLS = (r"[\p{M}\p{S}\p{P}&&[^.%$¢€£]]", " ")
AFTER = [(r"[.$¢€£]([^0-9])", " $1"), (r"([^0-9])%", "$1 ")]


@F.pandas_udf(T.StringType())
def _folded(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else folded(t))


def english_normalize(text: Column, spellings: dict[str, str] | None = None) -> Column:
    """The form in which English texts are compared: the rules above in turn over lower case, letters without marks,
    spelled numbers as digits, single blanks. spellings maps words to one spelling; callers bring the table."""

    def passes(c: Column, rules: list[tuple[str, str]]) -> Column:
        for pattern, word in rules:
            c = F.regexp_replace(c, pattern, word)
        return c

    def if_any(c: Column, rules: list[tuple[str, str]]) -> Column:
        """The rules for texts in which one of them finds something; in others none would. The list binds c, so it is worked out once."""
        some = F.lit("|".join(f"(?:{p})" for p, _ in rules))
        return F.transform(F.array(c), lambda x: F.when(F.rlike(x, some), passes(x, rules)).otherwise(x))[0]

    out = passes(F.lower(text), BEFORE)
    for apostrophe in (False, True):
        out = if_any(out, [r for r in CONTRACTIONS if r[0].startswith(r"\b") != apostrophe])
    # all texts go: a column of which some go would be worked out before the trip and once more behind it
    out = F.regexp_replace(_folded(passes(out, AROUND)), *SYMBOLS)
    out = number_digits(out)
    out = F.array_join(F.split(F.trim(out), r"\s+"), " ") if spellings is None else spelling(F.regexp_replace(F.trim(out), r"\s+", " "), spellings)
    return F.regexp_replace(passes(out, AFTER), r"\s+", " ")
