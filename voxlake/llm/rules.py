"""Quality rules with a learned decision list.

Every document gets statistics of its whole text. The base rules are fixed. The learned part is an ordered
list of conjunctions of thresholds on these statistics, found by sequential covering on labelled
documents: a rule is grown condition by condition on one part of the sample, pruned on the other, and the
documents that it covers leave. The list is applied as one ordered Spark conditional expression.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import prepare

#: Labelled documents of each class that the list is learned from at most; only their statistics are read.
SAMPLE = 20_000
#: Most rules and conditions of a rule; thresholds tried for a statistic; least precision of a rule that stays.
RULES, CONDITIONS, CUTS, PRECISION = 12, 3, 64, 0.95
SEED = 13

SYMBOLS = re.compile("[#*$%&|<>]")
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MORE = ["n_upper", "n_marks", "n_stops", "n_same", "n_distinct", "n_lines"]
#: What the rules look at: shares of the counts above, so that length alone tells little.
SHARES = {
    "mean_chars": "word_chars / greatest(n_words, 1)",
    "symbol_share": "n_symbols / greatest(word_chars, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "upper_share": "n_upper / greatest(word_chars, 1)",
    "mark_share": "n_marks / greatest(word_chars, 1)",
    "stop_share": "n_stops / greatest(n_words, 1)",
    "same_share": "n_same / greatest(n_words, 1)",
    "distinct_share": "n_distinct / greatest(n_words, 1)",
}


def repeat_words(words: list) -> int:
    """Words that lie in a 3-word window that occurs twice or more."""
    if len(words) < 4:
        return 0
    at: dict = {}
    w = np.fromiter((at.setdefault(x, len(at)) for x in words), np.int64, len(words))
    n = len(at)
    pair = w[:-1] * n + w[1:]
    pair = np.unique(pair, return_inverse=True)[1] if n > 1 << 20 else pair  # keeps the next product in 64 bits
    _, back, count = np.unique(pair[:-1] * n + w[2:], return_inverse=True, return_counts=True)
    twice = np.flatnonzero(count[back] > 1)
    hit = np.zeros(len(words), bool)
    for k in range(3):
        hit[twice + k] = True
    return int(hit.sum())


def measure(text: str | None) -> tuple[int, ...]:
    """BASE and MORE of one text; null counts as empty."""
    text = text or ""
    words = text.encode("utf-8", "replace").split()
    joined = b" ".join(words).decode()
    seen, dup, lines = set(), 0, 0
    for x in text.split("\n"):
        if x.encode("utf-8", "replace").strip():
            lines += 1
            dup += x in seen
            seen.add(x)
    chars = len(joined) - max(0, len(words) - 1)
    symbols = len(SYMBOLS.findall(text)) if SYMBOLS.search(text) else 0
    same = sum(a == b for a, b in zip(words, words[1:], strict=False))
    upper = sum(map(str.isupper, joined)) if len(joined) < 1 << 16 else sum(sum(map(str.isupper, joined[k : k + 65536])) for k in range(0, len(joined), 65536))
    marks = joined.count("!") + joined.count("?")
    stops = joined.count(".") + joined.count(",")
    return len(words), chars, symbols, dup, repeat_words(words), upper, marks, stops, same, len(set(words)), lines


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, BASE, MORE), one row per input row; texts themselves go no further than this map.

    Null and empty texts have zeros throughout; repeated rows come as often as they are there. A text may be of any
    length: one text's words are held at a time. Other columns, of any name, are not looked at; an empty table gives an
    empty result."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    names = [*BASE, *MORE]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = np.array([measure(t.as_py()) for t in b.column(1)], np.int64).reshape(-1, len(names))
            yield pa.RecordBatch.from_arrays([b.column(0), *map(pa.array, got.T)], ["doc_id", *names])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"{n} long" for n in names))


Condition = tuple[str, str, float]  # statistic, "<=" or ">", threshold


def covers(rule: list[Condition], x: dict[str, np.ndarray]) -> np.ndarray:
    out = np.ones(len(next(iter(x.values()))), bool)
    for name, op, cut in rule:
        out &= x[name] <= cut if op == "<=" else x[name] > cut
    return out


def grow(x: dict[str, np.ndarray], bad: np.ndarray) -> list[Condition]:
    """Add the condition of the largest information gain for bad documents until none that are good are covered."""
    rule: list[Condition] = []
    inside = np.ones(len(bad), bool)
    while len(rule) < CONDITIONS and (inside & ~bad).any():
        p0, n0 = (inside & bad).sum(), (inside & ~bad).sum()
        best: tuple[float, Condition | None] = (1e-9, None)
        for name, v in x.items():
            edge, every = np.unique(np.quantile(v[inside & bad], np.linspace(0, 1, CUTS))), np.unique(v[inside])
            last = len(every) - 1
            for op in ("<=", ">"):  # thresholds lie half way to the next value, so an edge counts as bad
                beside = every[np.clip(np.searchsorted(every, edge, side="right"), 0, last)] if op == "<=" else every[np.clip(np.searchsorted(every, edge) - 1, 0, last)]
                cuts = (edge + beside) / 2
                p, n = (np.searchsorted(np.sort(v[inside & m]), cuts, side="right") for m in (bad, ~bad))
                if op == ">":
                    p, n = p0 - p, n0 - n
                gain = np.where(p > 0, p * (np.log2(np.maximum(p, 1) / np.maximum(p + n, 1)) - np.log2(p0 / (p0 + n0))), 0)
                k = int(gain.argmax())
                if gain[k] > best[0]:
                    best = (float(gain[k]), (name, op, float(cuts[k])))
        if best[1] is None:
            break
        rule.append(best[1])
        inside = covers(rule, x)
    return rule


def prune(rule: list[Condition], x: dict[str, np.ndarray], bad: np.ndarray) -> list[Condition]:
    """Drop final conditions as long as (bad - good) / (bad + good) on the pruning part does not fall."""

    def value(r: list[Condition]) -> float:
        c = covers(r, x)
        return ((c & bad).sum() - (c & ~bad).sum()) / max(1, c.sum())

    return max((rule[:k] for k in range(len(rule), 0, -1)), key=value)


def learn(x: dict[str, np.ndarray], bad: np.ndarray) -> list[list[Condition]]:
    """Ordered rules; a document that one covers is bad. Each rule must hold its precision on both parts."""
    rng, rules = np.random.default_rng(SEED), []
    left = np.ones(len(bad), bool)
    while len(rules) < RULES and (left & bad).sum() >= 2:
        part = rng.random(len(bad)) < 2 / 3
        take = lambda m: {k: v[m] for k, v in x.items()}  # noqa: B023, E731
        growing, testing = left & part, left & ~part
        if not (growing & bad).any():
            break
        rule = grow(take(growing), bad[growing])
        if not rule:
            break
        rule = prune(rule, take(testing), bad[testing]) if testing.any() else rule
        c = covers(rule, x) & left
        if not (c & bad).any() or (c & bad).sum() < PRECISION * c.sum():
            break
        rules.append(rule)
        left &= ~c
    return rules


def verdict(rules: list[list[Condition]]) -> Column:
    """The list as one ordered conditional: false where the first matching rule rejects, else true."""
    out = None
    for rule in rules:
        test = F.lit(True)
        for name, op, cut in rule:
            share = F.expr(SHARES[name])
            test = test & (share <= cut if op == "<=" else share > cut)
        out = F.when(test, F.lit(False)) if out is None else out.when(test, F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def base_failed() -> Column:
    return F.expr("n_words < 50 or 100 * n_repeat_words > 50 * n_words")


def fit(stats: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", sample: int = SAMPLE) -> list[list[Condition]]:
    """Learn the list from at most `sample` labelled documents of each class, chosen by a hash of the id, among
    those that pass the base rules. Labels that are null or neither 0 nor 1, and null ids, are left out; of repeated
    ids the least label and the least statistics count, so ties leave nothing to chance. Without labels of both
    classes, an empty table among them, the list is empty. Other columns, of any name, are not looked at."""
    ids = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("y")).filter("doc_id is not null and y in (0, 1)")
    ids = ids.groupBy("doc_id").agg(F.min("y").alias("y"))
    parts = [ids.filter(F.col("y") == y).orderBy(F.xxhash64(F.lit(SEED), "doc_id"), "doc_id").limit(sample) for y in (0, 1)]
    rows = stats.filter(~base_failed()).select("doc_id", *[F.expr(e).cast("double").alias(n) for n, e in SHARES.items()])
    rows = rows.join(parts[0].union(parts[1]), "doc_id")
    rows = rows.groupBy("doc_id").agg(F.min("y").alias("y"), F.min(F.struct(*SHARES)).alias("x")).select("doc_id", "y", "x.*")
    rows = rows.toPandas().sort_values("doc_id")  # 2 * sample rows at most
    if rows["y"].nunique() < 2:
        return []
    return learn({n: rows[n].to_numpy() for n in SHARES}, (rows["y"] == 0).to_numpy())


def judge(stats: DataFrame, rules: list[list[Condition]]) -> DataFrame:
    """stats with base_failed and kept."""
    return stats.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & verdict(rules))
