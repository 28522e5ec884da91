"""Removal of lines that spread over many sites.

A HyperLogLog sketch of the sites of each line hash is merged by aggregation. Lines whose estimate lies
near the threshold get an exact distinct count; the others are decided by the estimate. Of a line that
spreads, the first occurrence stays and all others go. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, table, text_key, whole

#: A line spreads if at least so many distinct sites have it, and counts if it has so many words.
SITES, WORDS = 3, 3
#: log2 of a sketch's registers; its standard error is 1.04 / sqrt(2 ** LG).
LG = 12
#: Lines whose estimate is within so many standard errors (one site at least) of the threshold are counted exactly.
ERRORS = 5

BLANK = " \t\n\r\x0b\x0c"


def _lines(docs: DataFrame, id_col: str, text_col: str, site_col: str, words: int) -> DataFrame:
    """(doc_id, t1, t2, site, pos, l1, l2) of every line that counts; pos starts at 0."""
    t = F.coalesce(F.col(text_col), F.lit(""))
    t1, t2 = text_key(t)
    own = docs.select(F.col(id_col).alias("doc_id"), t1.alias("t1"), t2.alias("t2"), F.coalesce(F.concat(F.lit("s"), F.col(site_col).cast("string")), F.lit("")).alias("site"), F.split(t, "\n", -1).alias("lines"))
    own = own.select("doc_id", "t1", "t2", "site", F.posexplode("lines").alias("pos", "line"))
    own = own.withColumn("line", F.trim(F.col("line"), F.lit(BLANK)))
    least = WORD + (r"[\x20\x09-\x0D]+" + WORD) * (words - 1)
    l1, l2 = text_key("line")
    return own.filter(F.rlike("line", F.lit(least))).select("doc_id", "t1", "t2", "site", "pos", l1.alias("l1"), l2.alias("l2"))


def spreading(lines: DataFrame, sites: int = SITES, lg: int = LG) -> DataFrame:
    """(l1, l2, first): line hashes that at least so many sites have, with the first (doc_id, pos); null ids last."""
    at = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "pos")
    seen = lines.groupBy("l1", "l2").agg(F.hll_sketch_agg("site", lg).alias("sketch"), F.min(at).alias("first"))
    seen = table(seen.select("l1", "l2", "first", F.hll_sketch_estimate("sketch").alias("sites")).filter(F.col("sites") >= 2 if sites >= 3 else F.lit(True)), "line-sites")
    band = max(1.0, ERRORS * 1.04 / 2 ** (lg / 2) * sites)
    near = seen.filter(F.abs(F.col("sites") - sites) <= band).select("l1", "l2", "first")
    # one row a line and site before anything meets by line: a task writes a frequent line once for each site. Dealt
    # anew behind the join, so that a line with very many sites can be split there; lines near the threshold have few
    exact = lines.select("l1", "l2", "site").distinct().join(near, ["l1", "l2"])
    exact = exact.repartition("l1", "l2").groupBy("l1", "l2", "first").count()
    return seen.filter(F.col("sites") - sites > band).select("l1", "l2", "first").union(exact.filter(F.col("count") >= sites).select("l1", "l2", "first"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source", sites: int = SITES, words: int = WORDS) -> DataFrame:
    """All columns of docs, its text without repeated spreading lines, and n_lines and n_removed.

    Lines are cut at \\n and compared without ASCII white space at both ends; lines of fewer than `words`
    words never go. A null site is a site of its own. Lines are ordered by (id, position), null ids last; rows
    repeated in full keep the same lines. A null text stays null and has no lines; texts may be of any length.
    Columns of docs named n_lines or n_removed are replaced; other columns, of any name, are kept as they are. An
    empty table gives an empty result.
    """
    lines = table(_lines(docs, id_col, text_col, site_col, words), "lines")
    spread = spreading(lines, sites).withColumnsRenamed({"l1": "m1", "l2": "m2"})
    gone = lines.join(spread, F.expr("l1 = m1 and l2 = m2 and not (doc_id <=> first.doc_id and pos = first.pos)"))
    gone = gone.groupBy("doc_id", "t1", "t2").agg(F.collect_set("pos").alias("gone"))
    gone = gone.withColumnsRenamed({c: f"g_{c}" for c in ("doc_id", "t1", "t2")})
    t1, t2 = text_key(F.coalesce(F.col(text_col), F.lit("")))
    mine = docs.select(whole(docs), F.col(text_col).alias("text"), F.col(id_col).alias("doc_id"), t1.alias("t1"), t2.alias("t2"))
    mine = mine.join(gone, F.expr("t1 = g_t1 and t2 = g_t2 and doc_id <=> g_doc_id"), "left")
    parts = F.split("text", "\n", -1)
    n = F.when(F.col("text").isNull(), 0).otherwise(F.size(parts)).cast("long")
    kept = F.filter(F.transform(parts, lambda x, i: F.struct(i.alias("i"), x.alias("x"))), lambda s: ~F.array_contains("gone", s["i"]))["x"]
    text = F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    columns = [text.alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns if c not in ("n_lines", "n_removed")]
    return mine.select(*columns, n.alias("n_lines"), F.coalesce(F.array_size("gone"), F.lit(0)).cast("long").alias("n_removed"))


SQL = rf"""
WITH lines AS (
  SELECT doc_id, coalesce('s' || source, '') AS site, unnest(string_split(text, chr(10))) AS line,
         unnest(range(len(string_split(text, chr(10))))) AS pos
  FROM documents),
counted AS (
  SELECT doc_id, site, pos, trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS line FROM lines),
spread AS (
  SELECT line, arg_min(doc_id, (doc_id, pos)) AS first_doc, arg_min(pos, (doc_id, pos)) AS first_pos
  FROM counted
  WHERE len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) >= {WORDS}
  GROUP BY line HAVING count(DISTINCT site) >= {SITES}),
marked AS (
  SELECT l.doc_id, l.pos, l.line AS raw, s.line IS NOT NULL AND NOT (l.doc_id = s.first_doc AND l.pos = s.first_pos) AS gone
  FROM lines l JOIN counted c USING (doc_id, pos) LEFT JOIN spread s ON c.line = s.line)
SELECT doc_id, coalesce(string_agg(raw, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS text,
       count(*) AS n_lines, CAST(sum(CAST(gone AS INT)) AS BIGINT) AS n_removed
FROM marked GROUP BY doc_id
"""
