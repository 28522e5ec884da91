"""A quality classifier of learned subword embeddings.

Every word, its character n-grams, every pair of adjacent words and the class of how often a word comes in its document (in
powers of two, absolute and as a share) are hashed to rows of one embedding table. A document is the mean of the rows of all its words and pairs; a softmax over two classes on top is trained with it
by stochastic gradient descent in numpy, on a bounded sample of labelled documents whose rows are hashed by tasks.
Scoring is a map over all documents: as the model is linear in the mean, a word's part of the score is one
number, kept for repeated words.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import prepare, quoted, table
from .tokens import in_parts, split_words

#: Rows of the embedding table, their width, and the lengths of character n-grams (with word marks < and >).
BUCKETS, WIDTH, GRAMS = 1 << 17, 8, (3, 4, 5)
#: Labelled documents of each class that the fit reads at most, and the different rows of all of them together that
#: the driver holds at most (8 bytes each); of more documents it takes those of least hash that keep within it.
SAMPLE, ENTRIES = 1000, 6_000_000
EPOCHS, RATE, SEED = 6, 0.5, 11
#: Different words whose part of the score a task keeps, and their greatest length.
CACHE, LONGEST = 500_000, 64
THRESHOLD = 0.3
#: The odd factor of the hashes of n-grams, pairs and classes.
PRIME = np.uint64(0x9E3779B97F4A7C15)
#: Classes of a word's count (1, 2, 4 and so on) and of the words of its document for each time that it comes.
TIMES, SHARES = 7, 8


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(rows, owners): the rows of each word itself and of its character n-grams; owners are word numbers."""
    chars = np.frombuffer(f"<{'><'.join(words)}>".encode("utf-32-le"), "<u4").astype(np.uint64)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 2
    owner = np.repeat(np.arange(len(words)), size)
    left = np.cumsum(size)[owner] - np.arange(len(chars))  # characters from here to the word's end
    rows, owners = [(hashes(words) % np.uint64(BUCKETS)).astype(np.int64)], [np.arange(len(words))]
    for n in GRAMS:
        at = np.flatnonzero(left >= n)
        h = np.full(len(at), n, np.uint64)
        for j in range(n):
            h = (h ^ chars[at + j]) * PRIME
            h ^= h >> np.uint64(29)
        rows.append((h % np.uint64(BUCKETS)).astype(np.int64))
        owners.append(owner[at])
    return np.concatenate(rows), np.concatenate(owners)


def hashes(words: list[str]) -> np.ndarray:
    return np.fromiter((zlib.crc32(w.encode()) for w in words), np.uint64, len(words))


def pair_rows(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Rows of adjacent words, from their hashes."""
    h = ((first + np.uint64(1)) * PRIME ^ second) * PRIME
    return ((h ^ h >> np.uint64(29)) % np.uint64(BUCKETS)).astype(np.int64)


def class_rows(times: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Rows of words that come so many times in documents of so many words."""
    k = np.minimum(np.log2(times).astype(np.int64), TIMES - 1) * SHARES + np.minimum(np.log2(words / times).astype(np.int64), SHARES - 1)
    h = (k + (1 << 33)).astype(np.uint64) * PRIME  # no word hashes to such a number
    return ((h ^ h >> np.uint64(29)) % np.uint64(BUCKETS)).astype(np.int64)


def document_rows(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(different rows of a document, their counts) of its words in order."""
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    different = list(dict.fromkeys(words))
    at = {w: i for i, w in enumerate(different)}
    place = np.fromiter(map(at.__getitem__, words), np.int64, len(words))
    rows, owners = features(different)
    h = hashes(different)[place]
    times = np.bincount(place, minlength=len(different))
    found, back = np.unique(np.concatenate([rows, pair_rows(h[:-1], h[1:]), class_rows(times, len(words))]), return_inverse=True)
    return found, np.bincount(back, weights=np.concatenate([times[owners], np.ones(len(h) - 1, np.int64), times])).astype(np.int64)


def train(docs: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, prior: float) -> tuple[np.ndarray, float]:
    """(weight of each row, bias) of the log odds of label 1, from (rows, counts) of each document. prior: share of
    label 1 among all labels; the sample may hold the classes in other shares."""
    rng = np.random.default_rng(SEED)
    weights = rng.uniform(-1 / WIDTH, 1 / WIDTH, (BUCKETS, WIDTH))
    out, bias = np.zeros((2, WIDTH)), np.zeros(2)
    share = labels.mean() if len(labels) else 0.5
    steps, done = EPOCHS * len(docs), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(docs)):
            rows, counts = docs[i]
            part = counts / max(1, counts.sum())
            rate = RATE * (1 - done / steps)
            done += 1
            mean = part @ weights[rows]
            z = out @ mean + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[labels[i]] -= 1
            back = out.T @ p
            out -= rate * np.outer(p, mean)
            bias -= rate * p
            weights[rows] -= rate * np.outer(part, back) * min(len(rows), 20)
    w = weights @ (out[1] - out[0])
    shift = np.log(max(prior, 1e-6) / max(1 - prior, 1e-6)) - np.log(max(share, 1e-6) / max(1 - share, 1e-6))
    return w.astype(np.float32), float(bias[1] - bias[0] + shift)


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE, where: str | None = None, entries: int = ENTRIES) -> tuple[np.ndarray, float]:
    """Train on at most `sample` labelled documents of each class, chosen by a hash of their id, and of these on
    those of least hash whose hashed rows number `entries` together at most; texts never leave the tasks.

    labels: id_col and label_col (0 or 1; rows with nulls are left out, of repeated ids the least label counts).
    where: which ids may be learned from. Of documents of one id the least text counts, null ids are not learned from,
    null and empty texts have no rows. Other columns, of any name, are not looked at. Without labels of both classes
    every score is the prior's."""
    prepare(docs.sparkSession)
    ids = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("y")).filter("doc_id is not null and y in (0, 1)")
    if where:
        ids = ids.filter(where)
    ids = ids.groupBy("doc_id").agg(F.min("y").alias("y"))
    counts = {r["y"]: r["count"] for r in ids.groupBy("y").count().collect()}
    prior = (counts.get(1, 0) + 1) / (sum(counts.values()) + 2)
    ids = ids.withColumn("h", F.xxhash64(F.lit(SEED), "doc_id"))
    parts = [ids.filter(F.col("y") == y).orderBy("h", "doc_id").limit(sample) for y in (0, 1)]
    chosen = F.broadcast(parts[0].union(parts[1]))  # 2 * sample rows at most
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(chosen, "doc_id")
    rows = rows.groupBy("doc_id").agg(F.first("h").alias("h"), F.min("y").alias("y"), F.min("text").alias("text")).select("h", "y", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k, text in enumerate(b.column("text")):
                found, times = document_rows(split_words(pa.array([text.as_py()], pa.string()))[0].to_pylist())
                yield pa.RecordBatch.from_arrays([b.column("h").slice(k, 1), b.column("y").slice(k, 1), pa.array([len(found)], pa.int64()), pa.array([found.astype("<u4").tobytes()]), pa.array([times.astype("<u4").tobytes()])], ["h", "y", "n", "found", "times"])

    rows = table(rows.mapInArrow(run, "h long, y int, n long, found binary, times binary"), "labelled-rows")
    sizes = sorted((r["h"], r["n"]) for r in rows.select("h", "n").collect())  # 2 * sample pairs of numbers
    fits = int(np.searchsorted(np.cumsum([n for _, n in sizes]), entries, "right"))
    found = sorted(rows.filter(F.col("h") < sizes[fits][0]).collect() if fits < len(sizes) else rows.collect(), key=lambda r: (r["h"], r["found"]))
    if len({r["y"] for r in found}) < 2:
        return np.zeros(BUCKETS, np.float32), float(np.log(prior / (1 - prior)))
    return train([(np.frombuffer(r["found"], "<u4"), np.frombuffer(r["times"], "<u4")) for r in found], np.array([r["y"] for r in found]), prior)


class Scorer:
    """Scores texts with a fitted model; keeps each word's sum of weights, number of rows and hash."""

    def __init__(self, model: tuple[np.ndarray, float]):
        self.w, self.bias = model
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.sums, self.rows, self.hash = np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.uint64)

    def _places(self, words: pa.Array) -> np.ndarray:
        """Place of each word (all different) in sums, rows and hash; new words are learned."""
        names = words.to_numpy(zero_copy_only=False).tolist()
        place = np.fromiter(map(self.known.get, names, repeat(-1)), np.int64, len(names))
        new = np.flatnonzero(place < 0)
        sums, count, own = [self.sums], [self.rows], [self.hash]
        for k in range(0, len(new), 4096):
            part = [names[i] for i in new[k : k + 4096].tolist()]
            rows, owners = features(part)
            sums.append(np.bincount(owners, weights=self.w[rows], minlength=len(part)))
            count.append(np.bincount(owners, minlength=len(part)))
            own.append(hashes(part))
        place[new] = np.arange(len(self.sums), len(self.sums) + len(new))
        self.known.update((names[i], p) for i, p in zip(new.tolist(), place[new].tolist(), strict=True) if len(names[i]) <= LONGEST)
        self.sums, self.rows, self.hash = np.concatenate(sums), np.concatenate(count), np.concatenate(own)
        return place

    def logits(self, texts: pa.Array) -> np.ndarray:
        words, per_text = split_words(texts)
        coded = words.dictionary_encode()
        if len(self.sums) > CACHE:
            self._forget()
        place = self._places(coded.dictionary)[coded.indices.to_numpy()]
        owner = np.repeat(np.arange(len(per_text)), per_text)
        total = np.bincount(owner, weights=self.sums[place], minlength=len(per_text))
        rows = np.bincount(owner, weights=self.rows[place], minlength=len(per_text))
        h = self.hash[place]
        both = np.flatnonzero(owner[:-1] == owner[1:])
        total += np.bincount(owner[both], weights=self.w[pair_rows(h[both], h[both + 1])], minlength=len(per_text))
        rows += np.bincount(owner[both], minlength=len(per_text))
        each, times = np.unique(owner * (len(coded.dictionary) + 1) + coded.indices.to_numpy(), return_counts=True)
        each //= len(coded.dictionary) + 1
        total += np.bincount(each, weights=self.w[class_rows(times, per_text[each])] * times, minlength=len(per_text))
        rows += per_text
        return self.bias + total / np.maximum(rows, 1)

    def scores(self, texts: pa.Array) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(texts), -500, 500)))


def score(docs: DataFrame, model: tuple[np.ndarray, float], text_col: str = "text", keep: float | None = None) -> DataFrame:
    """docs with a column score in place of the text; with keep, all columns of docs as they are, of the rows that
    score at least so much. Null and empty texts have the score of no words; texts may be of any length, and equal
    texts have equal scores. A column score of docs is replaced; others, of any name, stay as they are. An empty table
    gives an empty result."""
    spark = docs.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast(model)  # BUCKETS numbers
    columns = docs.columns if keep is not None else [c for c in docs.columns if c not in (text_col, "score")]
    docs = docs.select(*map(quoted, columns), *([] if keep is not None else [text_col]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Scorer(shared.value)
        for b in batches:
            at = b.schema.get_field_index(text_col)
            s = np.concatenate([np.zeros(0), *map(own.scores, in_parts(b.column(at)))])
            if keep is not None:
                yield b.filter(pa.array(s >= keep))
            else:
                yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(b.num_columns - 1)), pa.array(s)], [*columns, "score"])

    kept = docs.schema if keep is not None else StructType([f for f in docs.schema if f.name in columns]).add("score", "double")
    return docs.mapInArrow(run, kept)
