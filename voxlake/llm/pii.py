r"""Personal data: fixed patterns, and identifiers that bootstrapping finds in the same contexts.

The fixed patterns give seed spans; tokens in the shape of a digest or access key (SHAPE) are seeds too, but no
spans by themselves. A pattern is the word before a token with the marks between (`token = "`), or the marks and the word
behind it. Identifier-like tokens in the same contexts are candidate instances. Patterns and instances score each other in
rounds: a pattern's confidence is the share of trusted instances among these and what speaks against it: its
occurrences, in the whole corpus, with no identifier-like token beside them, and instances of a make (which classes of
characters they have) that none of its trusted ones has. Instances not trusted yet, but of such a make, speak neither
way: they are what is to be found. An instance's confidence is the chance that one of its trusted patterns is right; trusted
instances count for other patterns in the next round. Those that no fixed pattern matches become spans of kind `id`,
wherever they occur. DataFrame functions only.

Texts are passed over once for each kind: matches are marked, and texts split at the marks. Repeated groups are
possessive: they need no stack, however long a run is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import prepare, table, whole

#: Kind: (what a text must hold to be searched at all, the expression). A match starts where no earlier
#: start could match, so runs are looked at once.
KINDS = {
    "email": ("@", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    "ip": ("[0-9]\\.[0-9]", r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}+"),
    "card": ("[0-9]", r"[0-9](?:[\x20-]?+[0-9])++"),
    "phone": ("\\+[0-9]", r"\+[0-9][\x20().0-9-]+[0-9]"),
}
PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
#: Characters between tokens.
BETWEEN = r"\s\"'=:<>()\[\],;|"
#: A token with a digit that could be an identifier, of at least six characters.
TOKEN = rf"(?<![^{BETWEEN}])(?=[^{BETWEEN}]*[0-9])[^{BETWEEN}]{{6,}}+"

#: Seeds that are no spans of themselves: 32, 40 or 64 hexadecimal digits, letters and digits among them.
SHAPE = r"^(?=.*[0-9])(?=.*[A-Fa-f])(?:[0-9A-Fa-f]{32}|[0-9A-Fa-f]{40}|[0-9A-Fa-f]{64})$"
#: Rounds, least confidence that is trusted, and different trusted instances that a pattern needs.
ROUNDS, TRUST, SEEDS = 3, 0.6, 3
#: Patterns that are broadcast to count their occurrences (16 bytes each); more are joined.
CONTEXTS = 50_000
#: Marks around matches while a text is split, and what stands for them where a text has them itself.
OPEN, CLOSE, OTHER = "\u0001", "\u0002", "\u0003"
#: Classes of characters that make up an identifier, a bit each.
MAKE = {1: "[0-9]", 2: "[A-Fa-f]", 4: "[G-Zg-z]", 8: r"[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]", 16: r"[^\x00-\x7F]"}


def plain(c: Column) -> Column:
    """Lower case, with one blank for any white space and one kind of quotes."""
    return F.translate(F.lower(F.regexp_replace(c, r"\s+", " ")), "'", '"')


def left_context(gap: Column) -> Column:
    """Last token of the text before a match with the marks behind it, null if there is none."""
    return F.nullif(plain(F.regexp_extract(gap, rf"([^{BETWEEN}]++[{BETWEEN}]++)$", 1)), F.lit(""))


def right_context(gap: Column) -> Column:
    """First token of the text behind a match with the marks before it, null if there is none."""
    return F.nullif(plain(F.regexp_extract(gap, rf"^([{BETWEEN}]++[^{BETWEEN}]++)", 1)), F.lit(""))


def make(value: Column) -> Column:
    """Which classes of characters a token has."""
    out = F.lit(0)
    for bit, c in MAKE.items():
        out = out + F.when(F.rlike(value, F.lit(c)), bit).otherwise(0)
    return out


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    n = F.length(digits)

    def worth(i: Column) -> Column:
        d = F.substring(digits, n - i + 1, F.lit(1)).cast("int")
        twice = d * 2
        return F.when(i % 2 == 1, d).when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda a, i: a + worth(i)) % 10 == 0


def passes(kind: str, value: Column) -> Column:
    """The check that follows a match of the kind's expression."""
    if kind == "ip":
        return F.rlike(value, F.lit(rf"^{PART}(?:\.{PART}){{3}}$"))
    n = F.length(_digits(value))
    if kind == "card":
        return F.when(n.between(12, 19), luhn(_digits(value))).otherwise(F.lit(False))
    return n.between(9, 15) if kind == "phone" else F.lit(True)


def spans_of(rows: DataFrame) -> DataFrame:
    """(row, rank, pos, skip, size, value, left, right) of seeds (rank 0 to 3, in the order of KINDS) and candidates
    (rank 4) of rows (row, text); left and right are hashes of the contexts beside them."""
    text = F.translate("text", OPEN + CLOSE, OTHER + OTHER)  # as many characters, and no kind has any of them
    kinds = []
    for rank, (hint, pattern) in enumerate([*KINDS.values(), ("[0-9]", TOKEN)]):
        ask = F.contains(F.col("text"), F.lit(hint)) if hint == "@" else F.rlike("text", F.lit(hint))
        pieces = F.split(F.when(ask, F.regexp_replace(text, F.lit(pattern), F.lit(f"{OPEN}$0{CLOSE}"))), OPEN)
        kinds.append(F.struct(F.lit(rank).alias("rank"), pieces.alias("pieces")))
    each = rows.select("row", F.explode(F.array(*kinds)).alias("k")).select("row", "k.rank", "k.pieces").filter(F.size("pieces") > 1)
    gap = lambda k: F.when(k == 0, F.col("pieces")[0]).otherwise(F.substring_index(F.get("pieces", k), CLOSE, -1))
    left, right = (lambda k: F.xxhash64(F.lit(0), left_context(gap(k)))), (lambda k: F.xxhash64(F.lit(1), right_context(gap(k + 1))))
    near = lambda k: F.struct(F.char_length(gap(k)).alias("skip"), F.substring_index(F.get("pieces", k + 1), CLOSE, 1).alias("value"), left(k).alias("left"), right(k).alias("right"))
    one = each.select("row", "rank", F.posexplode(F.transform(F.sequence(F.lit(0), F.size("pieces") - 2), near)).alias("pos", "m"))
    no = [F.xxhash64(F.lit(k), F.lit(None).cast("string")) for k in (0, 1)]  # the hash of no context
    return one.select("row", "rank", "pos", "m.skip", F.char_length("m.value").alias("size"), "m.value", F.nullif("m.left", no[0]).alias("left"), F.nullif("m.right", no[1]).alias("right"))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: bool = False, shape: Column | None = None) -> DataFrame:
    """(doc_id, spans array<struct<start int, rank int, end int>>) of every input row, ordered by start and
    kind (rank 0 to 3: KINDS; 4: id); with keep, also `row`, all columns of docs as a struct. Positions are code
    points, ends are exclusive. shape: which tokens (an expression of `value`) are seeds besides the fixed kinds, SHAPE if it
    isn't given.

    Null and empty texts have no spans; texts may be of any length. Rows repeated in full get the same spans. Candidates
    that overlap a fixed span are not looked at, and a candidate loses its final . ! and ?. Columns of docs may have any
    name. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    prepare(spark)
    text = F.coalesce(F.col(text_col), F.lit(""))
    own = ["doc_id", "row"] if keep else ["doc_id"]
    rows = docs.select(*([whole(docs)] if keep else []), F.col(id_col).alias("doc_id"), text.alias("text"), F.rlike(text, F.lit("[0-9@]")).alias("some"))
    some = table(rows.filter("some").withColumn("at", F.monotonically_increasing_id()), "texts")
    # dealt out by row: matching costs far more than the size of these files says
    spread = some.select(F.col("at").alias("row"), "text").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "row")
    found = table(spans_of(spread), "matches")
    before = Window.partitionBy("row", "rank").orderBy("pos")
    found = found.withColumn("end", F.sum(F.col("skip") + F.col("size")).over(before)).withColumn("start", F.col("end") - F.col("size"))
    check = F.when(F.col("rank") == 4, F.lit(True))
    for rank, kind in enumerate(KINDS):
        check = check.when(F.col("rank") == rank, passes(kind, F.col("value")))
    found = found.filter(check)
    trail = F.regexp_extract("value", r"[.!?]*+$", 0)
    found = found.withColumn("end", F.when(F.col("rank") == 4, F.col("end") - F.length(trail)).otherwise(F.col("end")))
    found = found.withColumn("value", F.when(F.col("rank") == 4, F.regexp_replace("value", r"[.!?]++$", "")).otherwise(F.col("value")))
    # a candidate overlaps a fixed span if one that starts before its end reaches beyond its start, or the reverse
    order = Window.partitionBy("row").orderBy("start", "rank")
    fixed_end = F.when(F.col("rank") < 4, F.col("end"))
    fixed_start = F.when(F.col("rank") < 4, F.col("start"))
    reach = F.max(fixed_end).over(order.rowsBetween(Window.unboundedPreceding, -1))
    after = F.min(fixed_start).over(order.rowsBetween(1, Window.unboundedFollowing))
    same = F.min(fixed_start).over(Window.partitionBy("row", "start"))
    clash = (F.coalesce(reach > F.col("start"), F.lit(False)) | F.coalesce(after < F.col("end"), F.lit(False)) | same.isNotNull()) & (F.col("rank") == 4)
    place = [F.col("row"), F.col("rank"), F.col("start").cast("int").alias("start"), F.col("end").cast("int").alias("end")]
    found = table(found.withColumn("clash", clash).filter("not clash").select(*place, "value", "left", "right"), "spans")
    good = identifiers(found, rows.select("text"), shape)
    extra = found.filter("rank = 4").join(good, "value", "left_semi")
    spans = found.filter("rank < 4").select("row", "start", "rank", "end").union(extra.select("row", "start", "rank", "end"))
    spans = spans.groupBy(F.col("row").alias("at")).agg(F.array_sort(F.collect_list(F.struct("start", "rank", "end"))).alias("spans"))
    none = F.array().cast("array<struct<start:int,rank:int,end:int>>")
    with_spans = some.select("at", *own).join(spans, "at", "left").select(*own, F.coalesce("spans", none).alias("spans"))
    return with_spans.union(rows.filter("not some").select(*own, none.alias("spans")))


def occurrences(texts: DataFrame, contexts: DataFrame) -> DataFrame:
    """(p, all): how often each of the given contexts occurs in the whole corpus."""
    text = texts.select(plain(F.col("text")).alias("text"))
    sides = [(0, rf"[^{BETWEEN}]++[{BETWEEN}]++"), (1, rf"[{BETWEEN}]++[^{BETWEEN}]++")]
    found = [text.select(F.explode(F.regexp_extract_all("text", F.lit(c), F.lit(0))).alias("c")).select(F.xxhash64(F.lit(k), "c").alias("p")) for k, c in sides]
    found = found[0].union(found[1])
    if contexts.count() <= CONTEXTS:
        found = found.join(F.broadcast(contexts), "p", "left_semi")
    # counted before any join: frequent contexts then meet in a row a task, however many texts hold them
    return table(found.groupBy("p").agg(F.count("*").alias("all")).join(contexts, "p"), "context-counts")


def identifiers(found: DataFrame, texts: DataFrame, shape: Column | None = None) -> DataFrame:
    """(value): candidate values that the rounds of scoring trust. found: of spans_of, texts: the whole corpus, shape: which
    values are seeds besides those of fixed patterns (SHAPE)."""
    shape = F.rlike("value", F.lit(SHAPE)) if shape is None else shape
    graph = found.select("rank", "value", F.explode(F.array("left", "right")).alias("p")).filter("p is not null")
    base = F.col("rank") < len(KINDS)
    graph = graph.groupBy("p", "value").agg(F.count("*").alias("n"), F.max(base).alias("base"), F.max(base | shape).alias("seed"))
    graph = table(graph, "graph")
    # a pattern with fewer instances than it needs trusted ones can be left out at once
    enough = graph.groupBy("p").agg(F.count("*").alias("instances")).filter(F.col("instances") >= SEEDS).select("p")
    graph = table(graph.join(enough, "p", "left_semi").withColumn("make", make(F.col("value"))), "patterns")
    often = occurrences(texts, table(graph.select("p").distinct(), "contexts"))
    trusted = graph.groupBy("value").agg(F.max("base").alias("base"), F.max("seed").alias("seed")).withColumns({"s": F.lit(0.0), "c": F.col("seed").cast("double")})
    for _ in range(ROUNDS):
        sure = F.col("c") >= TRUST
        seen = graph.select("p", "value", "n", "make").join(trusted.select("value", "c"), "value")
        makes = seen.groupBy("p", "make").agg(F.sum("n").alias("n"), F.coalesce(F.sum(F.when(sure, F.col("n"))), F.lit(0)).alias("hits"), F.sum(sure.cast("int")).alias("different"))
        against = F.sum(F.when(F.col("different") == 0, F.col("n")).otherwise(0))
        pattern = makes.groupBy("p").agg(F.sum("n").alias("n"), F.sum("hits").alias("hits"), F.sum("different").alias("different"), against.alias("against"))
        pattern = pattern.filter(F.col("different") >= SEEDS).join(often, "p")
        bare = F.greatest(F.col("all") - F.col("n"), F.lit(0))
        pattern = pattern.select("p", (F.col("hits") / (F.col("hits") + F.col("against") + bare + 1)).alias("c")).filter(F.col("c") >= TRUST)
        score = graph.select("p", "value").join(pattern, "p").groupBy("value").agg((1 - F.exp(F.sum(F.log(1 - F.col("c"))))).alias("s"))
        trusted = trusted.select("value", "base", "seed").join(score, "value", "left").withColumn("s", F.coalesce("s", F.lit(0.0)))
        trusted = table(trusted.withColumn("c", F.when(F.col("seed"), 1.0).otherwise(F.col("s"))), "trusted")
    return trusted.filter((F.col("s") >= TRUST) & ~F.col("base")).select("value")


NAMES = [*KINDS, "id"]


def joined(spans: Column) -> Column:
    """kind:start:end of the spans, comma-joined."""
    kind = lambda x: F.element_at(F.array(*map(F.lit, NAMES)), x["rank"] + 1)
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", kind(x), x["start"], x["end"])), ",")


def digest(found: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_id, n_spans) from find()."""
    ranks = F.transform("spans", lambda x: x["rank"])
    counts = [(F.size(ranks) - F.size(F.array_remove(ranks, r))).cast("long").alias(f"n_{k}") for r, k in enumerate(NAMES)]
    base = joined(F.filter("spans", lambda x: x["rank"] < len(KINDS)))
    return found.select("doc_id", *counts[:-1], F.sha2(base, 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"), counts[-1], F.size("spans").cast("long").alias("n_spans"))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with every span of its text replaced by its kind in brackets; of overlapping spans the first counts. Each
    row is cut by the spans of its own text, whatever its id; null texts stay null."""
    found = find(docs, id_col, text_col, keep=True).withColumn("text", F.col("row").getField(text_col))
    name = lambda x: F.element_at(F.array(*map(F.lit, NAMES)), x["rank"] + 1)

    def add(a: Column, x: Column) -> Column:
        piece = F.concat(a["out"], F.substring(F.col("text"), a["at"] + 1, x["start"] - a["at"]), F.lit("["), name(x), F.lit("]"))
        return F.when(x["start"] < a["at"], a).otherwise(F.struct(piece.alias("out"), x["end"].alias("at")))

    begin = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    cut = F.aggregate("spans", begin, add, lambda a: F.concat(a["out"], F.substring(F.col("text"), a["at"] + 1, F.char_length("text"))))
    return found.select(*[cut.alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns])
