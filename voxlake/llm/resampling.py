"""Importance resampling towards a target distribution, with bit-sliced sums.

Words and pairs of words fall into BUCKETS buckets by CRC-32. A bucket's gain is the log ratio of its smoothed
frequencies in the target and in the source, as a whole number. A document's bucket counts are held as bit planes: plane j has a
bit for every bucket whose count has bit j. The gains are bit planes too, in two's complement, whose highest plane counts
negative. The sum of count times gain is then the sum over pairs of planes of the bits that both have, times a power of
two: AND and popcount of whole machine words, exact.

Texts are read twice (totals, then weights), so nothing but ten thousand totals and a few numbers a document is ever stored.
Documents are drawn without replacement by Gumbel keys from a hash of their id; the highest keys are found by ranges,
not by one sort in one task.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import placed
from .common import prepare, quoted, table, unpacked, whole
from .tokens import in_parts, split_words

BUCKETS = 10_000
#: 64-bit machine words of a plane.
CELLS = -(-BUCKETS // 64)
#: Bytes after folding: ASCII letters in lower case, other ASCII characters but digits as blanks. All else belongs to words.
FOLD = bytes(ord(chr(c).lower()) if c > 127 or chr(c).isalnum() else 32 for c in range(128)) + bytes(range(128, 256))
#: Documents whose counts and planes are held at once.
DOCUMENTS = 64
#: Documents of fewer words are never drawn; the share of the others that is; what is hashed before an id.
LEAST_WORDS, SHARE, SALT = 20, 0.25, "7:"


def _zero_bytes() -> np.ndarray:
    """(power, byte, value): what CRC-32 makes of each byte of a remainder after 2 ** power bytes of zeros."""
    x = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        x = np.where(x & 1, x >> 1 ^ np.uint32(0xEDB88320), x >> 1)
    b = np.arange(256, dtype=np.uint32)
    out = [np.stack([x, *(b << np.uint32(8 * (k - 1)) for k in (1, 2, 3))])]
    for _ in range(31):
        out.append(_through(out[-1], out[-1]))
    return np.stack(out)


def _through(table: np.ndarray, x: np.ndarray) -> np.ndarray:
    return table[0][x & 255] ^ table[1][x >> 8 & 255] ^ table[2][x >> 16 & 255] ^ table[3][x >> 24]


ZERO_BYTES = _zero_bytes()


def joined(first: np.ndarray, second: np.ndarray, size: np.ndarray) -> np.ndarray:
    """CRC-32 of first + second from both's CRC-32 and the second's size in bytes."""
    first = first.copy()
    for k in range(int(size.max(initial=0)).bit_length()):
        own = np.flatnonzero(size >> k & 1)
        first[own] = _through(ZERO_BYTES[k], first[own])
    return first ^ second


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(buckets, owners, words of each text): a bucket for each word and for each two neighbours with a blank between, in
    any order; owners are text numbers."""
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    own = data[int(ends[0]) : int(ends[-1])].to_pybytes() if data else b""
    folded = pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(ends - ends[0]), pa.py_buffer(own.translate(FOLD)))
    words, count = split_words(folded)
    coded = words.dictionary_encode()
    at, names = coded.indices.to_numpy(), coded.dictionary.cast(pa.large_binary()).to_pylist()
    own = np.fromiter(map(zlib.crc32, names), np.uint32, len(names))
    before = np.fromiter((zlib.crc32(b" ", c) for c in own.tolist()), np.uint32, len(names))
    size = np.fromiter(map(len, names), np.int64, len(names))
    owner = np.repeat(np.arange(len(count)), count)
    pair = np.flatnonzero(owner[1:] == owner[:-1])
    crc = np.concatenate([own[at], joined(before[at[pair]], own[at[pair + 1]], size[at[pair + 1]])])
    return crc.astype(np.int64) % BUCKETS, np.concatenate([owner, owner[pair]]), count


def totals(texts: DataFrame, text_col: str = "text") -> np.ndarray:
    """Count of every bucket over all texts: a task adds up its texts and sends BUCKETS rows at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for b in batches:
            for part in in_parts(b.column(0)):
                total += np.bincount(features(part)[0], minlength=BUCKETS)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])

    prepare(texts.sparkSession)
    out = np.zeros(BUCKETS, np.int64)
    for r in texts.select(quoted(text_col).cast("string")).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log ratio of each bucket's smoothed frequency in the target to that in the source, in thousandths, rounded down."""
    s, t = source.astype(np.float64), target.astype(np.float64)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + BUCKETS) / ((s + 1) * (t.sum() + BUCKETS)))).astype(np.int64)


def bit_planes(numbers: np.ndarray, many: int) -> np.ndarray:
    """(…, plane, machine word) of the lowest `many` bits of whole numbers (…, bucket), in two's complement."""
    bits = (numbers[..., None, :] >> np.arange(many)[:, None] & 1).astype(np.uint8)
    packed = np.zeros((*bits.shape[:-1], CELLS * 8), np.uint8)
    packed[..., : -(-numbers.shape[-1] // 8)] = np.packbits(bits, axis=-1)
    return packed.view(np.uint64)


class Gains:
    """Signed gains as bit planes."""

    def __init__(self, gain: np.ndarray):
        many = int(np.abs(gain).max(initial=0)).bit_length() + 1
        self.planes = bit_planes(gain, many)
        self.worth = np.array([1 << k for k in range(many - 1)] + [-(1 << many - 1)], np.int64)

    def sums(self, count: np.ndarray) -> np.ndarray:
        """Sum of count times gain for each row of counts (document, bucket)."""
        out = np.zeros(len(count), np.int64)
        most = count.max(axis=1, initial=0)
        for j in range(int(most.max(initial=0)).bit_length()):
            rows = np.flatnonzero(most >> j)  # the highest planes are those of a few long documents
            plane = bit_planes(count[rows] >> j, 1)[:, 0]
            for own, worth in zip(self.planes, self.worth, strict=True):
                out[rows] += (np.bitwise_count(plane & own).sum(axis=1, dtype=np.int64) << j) * worth
        return out


def weigh(docs: DataFrame, gain: np.ndarray, text_col: str = "text") -> DataFrame:
    """(row, n_words, n_features, weight): a document's columns but the text, and the floored mean gain of its features, 0 if
    it has none."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(gain)  # BUCKETS numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Gains(shared.value)
        for b in batches:
            words, n, weight = [np.zeros(0, np.int64)] * 3
            for part in in_parts(b.column("text")):
                bucket, owner, count = features(part)
                order = np.argsort(owner, kind="stable")
                bucket, owner = bucket[order], owner[order]
                words = np.concatenate([words, count])
                for at in range(0, len(count), DOCUMENTS):
                    now = slice(*np.searchsorted(owner, [at, at + DOCUMENTS]))
                    many = min(DOCUMENTS, len(count) - at)
                    counts = np.bincount((owner[now] - at) * BUCKETS + bucket[now], minlength=many * BUCKETS).reshape(many, BUCKETS)
                    total = counts.sum(axis=1)
                    n = np.concatenate([n, total])
                    weight = np.concatenate([weight, own.sums(counts) // np.maximum(total, 1)])
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(words), pa.array(n), pa.array(weight)], ["row", "n_words", "n_features", "weight"])

    rest = docs.drop(text_col) if len(docs.columns) > 1 else docs
    some = docs.select(whole(rest), quoted(text_col).cast("string").alias("text"))
    return some.mapInArrow(run, f"row {some.schema['row'].dataType.simpleString()}, n_words long, n_features long, weight long")


def gumbel(doc_id: Column, salt: str = SALT) -> Column:
    """A Gumbel number in thousandths, rounded down, from the SHA-256 of the salt and the id (a null id: of the salt)."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(salt), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def ranks(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", share: float = SHARE, least: int = LEAST_WORDS, salt: str = SALT) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every document; rank numbers the floor(share * N) highest scores of the N
    documents of at least `least` words, ties by id; it is null for the others. target: rows with a column text_col.

    A null text has no words, and a document without features weighs 0. Texts may be of any length. Null ids come first among ties and share one Gumbel number; rows of one id are documents of their own,
    their ties go by features and weight. An empty target gives gains from smoothing alone, an empty table an empty
    result. Other columns, of any name, are not looked at."""
    gain = gains(totals(docs, text_col), totals(target, text_col))
    w = weigh(docs.select(quoted(id_col).alias("doc_id"), quoted(text_col).alias("text")), gain)
    w = w.select(*unpacked(["doc_id"]), "n_words", "n_features", "weight")
    w = table(w.withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), salt)), "weights")
    may = w.filter(F.col("n_words") >= least)
    order = [F.col("score").desc(), F.col("doc_id"), F.col("n_features"), F.col("weight")]
    drawn = round(100 * share) * may.count() // 100
    out = placed(may, order, name="place").withColumn("rank", F.when(F.col("place") < drawn, F.col("place") + 1))
    names = ["doc_id", "n_features", "weight", "score"]
    return out.select(*names, "rank").unionByName(w.filter(F.col("n_words") < least).select(*names, F.lit(None).cast("long").alias("rank")))


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", share: float = SHARE, least: int = LEAST_WORDS, salt: str = SALT) -> DataFrame:
    """The drawn documents with all their columns: those that ranks() gives a rank, and of equals of the last one all
    rows. Documents are not shuffled: one pass compares their scores with the last drawn one's."""
    last = ranks(docs, target, id_col, text_col, share, least, salt).filter("rank is not null").orderBy(F.col("rank").desc()).limit(1).collect()
    if not last:
        return docs.limit(0)
    gain = gains(totals(docs, text_col), totals(target, text_col))
    both = docs.select(whole(docs), quoted(text_col).alias("text"))
    w = weigh(both, gain).select(F.col("row.row").alias("row"), "n_words", "weight")
    score = F.col("weight") + gumbel(F.col("row").getField(id_col), salt)
    own, (end,) = F.col("row").getField(id_col), last
    before = own.isNull() | (own <= F.lit(end["doc_id"])) if end["doc_id"] is not None else own.isNull()
    kept = w.filter((F.col("n_words") >= least) & ((score > end["score"]) | ((score == end["score"]) & before)))
    return kept.select(*unpacked(docs.columns))


#: CRC-32 by its table of 256 remainders, over the bytes of every different feature.
SQL = f"""
WITH remainders AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, CAST(i AS BIGINT))) AS r),
texts AS (
  SELECT 'd' AS side, row_number() OVER () AS n, doc_id, text FROM documents
  UNION ALL SELECT 't', row_number() OVER (), NULL, text FROM benchmark),
words AS (
  SELECT side, n, doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), []) AS w FROM texts),
features AS (
  SELECT side, n, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM words),
hashed AS (
  SELECT f, xor(list_reduce(list_transform(range(1, CAST(2 * strlen(f) AS BIGINT), 2), lambda i: CAST('0x' || substr(hex(encode(f)), i, 2) AS BIGINT)),
    lambda c, x: xor(c >> 8, r[(xor(c, x) & 255) + 1]), 4294967295), 4294967295) % {BUCKETS} AS bucket
  FROM (SELECT DISTINCT f FROM features), remainders),
found AS (SELECT side, n, bucket, count(*) AS c FROM features JOIN hashed USING (f) GROUP BY ALL),
sums AS (
  SELECT bucket, sum(c) FILTER (side = 'd') AS s, sum(c) FILTER (side = 't') AS t FROM found GROUP BY bucket),
gains AS (
  SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1) * (sum(coalesce(s, 0)) OVER () + {BUCKETS})::DOUBLE / ((coalesce(s, 0) + 1) * (sum(coalesce(t, 0)) OVER () + {BUCKETS})::DOUBLE))) AS g FROM sums),
means AS (SELECT n, sum(c) AS n_features, floor(sum(c * g) / sum(c)) AS weight FROM found JOIN gains USING (bucket) WHERE side = 'd' GROUP BY n),
scored AS (
  SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('{SALT}' || coalesce(doc_id::VARCHAR, '')), 1, 8) AS BIGINT) + 0.5)::DOUBLE / 4294967296))) AS score
  FROM words LEFT JOIN means USING (n) WHERE side = 'd'),
placed AS (
  SELECT *, CASE WHEN n_words >= {LEAST_WORDS} THEN row_number() OVER (PARTITION BY n_words >= {LEAST_WORDS} ORDER BY score DESC, doc_id NULLS FIRST, n_features, weight) END AS place,
    count(*) FILTER (n_words >= {LEAST_WORDS}) OVER () AS may FROM scored)
SELECT doc_id, n_features::BIGINT AS n_features, weight::BIGINT AS weight, score::BIGINT AS score, CASE WHEN place <= {round(100 * SHARE)} * may // 100 THEN place END AS rank FROM placed
"""
