"""Packing documents into training sequences by the sum-of-squares rule.

A document that is longer than a sequence is cut into full pieces and a rest. A piece goes where the sum,
over all gap sizes, of the squared number of open sequences with that gap becomes smallest: into an open
sequence or a new one. Groups of pieces are packed in parallel; the pieces in sequences that a group
leaves unfilled meet those of other groups in the next round. No group outgrows its size; rounds end with
one group, or when another round would fill hardly any sequence more (lengths that don't fit each other).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import new_path, prepare, table
from .tokens import crc32, default_path, encoder, in_parts, with_end

CAPACITY, END = 4096, 1
#: Pieces in a group, the share of pieces that a round must bring to rest if another is to follow, and rounds
#: that a sequence's id has room for.
GROUP, GAIN, ROUNDS = 100_000, 0.1, 31


class SumOfSquares:
    """Open sequences by gap. Its state is one number a gap and the open sequences themselves."""

    def __init__(self, capacity: int = CAPACITY):
        self.capacity = capacity
        self.count = np.zeros(capacity + 1, np.int64)  # of open sequences with this gap; 0 stays 0
        self.open: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.made = 0

    def place(self, size: int) -> tuple[int, int]:
        """(sequence, offset) for a piece of the given size; ties go to the smallest gap that is left."""
        c, n = self.capacity, self.count
        if size < c:
            # change of the sum: gap g loses one, gap g - size gains one (a gap of 0 doesn't count)
            change = 2 * (n[: c - size] - n[size:c])
            change[0] -= 1
            change[n[size:c] == 0] = np.iinfo(np.int64).max
            at = int(change.argmin())
            # in a new sequence only the gap c - size gains one; the 2 * 0 + 1 of "gains" is left out on both sides
            if change[at] != np.iinfo(np.int64).max and change[at] + 1 <= 2 * n[c - size]:
                gap = at + size
                seq = self.open[gap].pop()
                n[gap] -= 1
                if at:
                    self.open[at].append(seq)
                    n[at] += 1
                return seq, c - gap
            self.open[c - size].append(self.made)
            n[c - size] += 1
        self.made += 1
        return self.made - 1, 0


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document's ids with the end id; null texts are empty."""
    prepare(docs.sparkSession)
    model = tokenizer or default_path()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(model)
        for b in batches:
            row, piece, start, length, crc = [], [], [], [], []
            i = 0
            for part in in_parts(b.column(1)):
                ids, sizes = with_end(*encode.flat(part), END)
                ids, first = ids.astype("<u4"), 0
                for size in sizes.tolist():
                    for k, at in enumerate(range(0, size, capacity)):
                        n = min(capacity, size - at)
                        row.append(i)
                        piece.append(k)
                        start.append(at)
                        length.append(n)
                        crc.append(crc32(ids[first + at : first + at + n]))
                    i, first = i + 1, first + size
            cols = [b.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "piece", "start", "length", "ids_crc32"])

    return rows.mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def _pack(batches: Iterator[pa.RecordBatch], level: int, capacity: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by group and falling length. Adds (sequence_id, offset, fill of the sequence)."""
    group, rows = None, []

    def flush() -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(rows).combine_chunks()
        rule, size = SumOfSquares(capacity), t.column("length").to_pylist()
        got = np.array([rule.place(s) for s in size], np.int64).reshape(-1, 2)
        fill = np.bincount(got[:, 0], weights=size, minlength=rule.made).astype(np.int64)
        base = (level << 58) | (group << 26)
        for name, x in (("sequence_id", got[:, 0] + base), ("offset", got[:, 1]), ("fill", fill[got[:, 0]])):
            t = t.set_column(t.schema.get_field_index(name), name, pa.array(x))
        yield from t.to_batches(max_chunksize=10_000)

    for b in batches:
        g = b.column("grp").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(g)) + 1).tolist(), len(g)]
        for a, z in zip(cuts, cuts[1:], strict=False):
            if z > a:
                if rows and g[a] != group:
                    yield from flush()
                    rows = []
                group = int(g[a])
                rows.append(b.slice(a, z - a))
    if rows:
        yield from flush()


def pack(items: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """items: any columns with length (1 to capacity), doc_id and piece. Returns them with sequence_id and
    offset: the pieces of a sequence lie side by side from offset 0. The rows of a group are spread by hash
    of all that tells pieces apart and, for rows repeated in full, by their place in the input."""
    items = items.withColumns({"sequence_id": F.lit(-1).cast("long"), "offset": F.lit(0).cast("long"), "fill": F.lit(0).cast("long")})
    before = items.count()
    groups = before // group + 1
    live = items.withColumn("grp", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.monotonically_increasing_id() % 64), F.lit(groups)))
    live = table(live, "pieces")
    kind = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in live.schema)
    done, level = None, 0
    while True:
        full = live.filter(F.col("length") == capacity) if level == 0 else None
        todo = live.filter(F.col("length") < capacity) if level == 0 else live
        todo = todo.repartition("grp").sortWithinPartitions("grp", F.col("length").desc(), "doc_id", "piece", "ids_crc32")
        out = table(todo.mapInArrow(lambda b, v=level + 1: _pack(b, v, capacity), kind), "packed")
        if full is not None:
            done = full.withColumns({"sequence_id": F.monotonically_increasing_id(), "fill": F.col("length")})
            done = table(done, "full-pieces")
        unfilled = out.filter(F.col("fill") < capacity)
        left = unfilled.count() if groups > 1 else 0
        if groups == 1 or left > (1 - GAIN) * before or level + 1 == ROUNDS:
            return done.union(out).drop("grp", "fill")
        done = done.union(out.filter(F.col("fill") == capacity))
        before, groups, level = left, min(groups - 1, left // group + 1), level + 1
        live = unfilled.withColumn("grp", F.col("grp") % groups).select(*live.columns)


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset), one row per piece.

    A null or empty text is one piece of the end id alone; texts may be of any length. Repeated rows are packed as often
    as they come; ties among equal lengths are ordered by id, piece and checksum. Other columns, of any name, are not
    looked at. An empty table gives an empty result. The sequences themselves: write_sequences().
    """
    return pack(table(pieces(docs, id_col, text_col, tokenizer), "encoded"))


def write_sequences(docs: DataFrame, text_col: str = "text", tokenizer: str | None = None) -> str:
    """Pack docs and write the sequences themselves, (sequence_id, ids), as a table; returns its path. Rows are told
    apart by a number of their own, so ids that repeat or are null lose nothing. Null texts are empty; a text may be of
    any length; other columns, of any name, are not looked at; an empty table gives an empty one."""
    prepare(docs.sparkSession)
    model = tokenizer or default_path()
    rows = docs.select(F.monotonically_increasing_id().alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = table(rows, "numbered")
    at = pack_documents(rows, "doc_id", "text", tokenizer).groupBy("doc_id").agg(F.collect_list(F.struct("start", "length", "sequence_id", "offset")).alias("pieces"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(model)
        for b in batches:
            done = 0
            for part in in_parts(b.column("text")):
                out, first = [], 0
                ids, sizes = with_end(*encode.flat(part), END)
                for size, own in zip(sizes.tolist(), b.column("pieces").slice(done, len(part)).to_pylist(), strict=True):
                    out += [(p["sequence_id"], p["offset"], ids[first + p["start"] : first + p["start"] + p["length"]].astype(np.int32)) for p in own]
                    first += size
                done += len(part)
                seq, offset, cut = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(seq, pa.int64()), pa.array(offset, pa.int64()), pa.array(cut, pa.list_(pa.int32()))], ["sequence_id", "offset", "ids"])

    cut = rows.join(at, "doc_id").select("text", "pieces").mapInArrow(run, "sequence_id long, offset long, ids array<int>")
    whole = cut.groupBy("sequence_id").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda x: x["ids"])).alias("ids"))
    path = new_path(docs.sparkSession, "sequences")
    whole.write.parquet(path)
    return path
