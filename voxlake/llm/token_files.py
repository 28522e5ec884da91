"""Token ids in Arrow files of fixed-size-list batches.

A shard is one Arrow IPC file whose batches hold `ids` (fixed-size list of uint16 or uint32) and `mask`
(fixed-size list of bool, false behind the last id). Every list has the same length, so sequence k of a
batch lies at a known offset of its buffer and a memory map gives it without a copy. A second Arrow file
beside it, `.docs`, has doc_id, start and n_tokens of each document in the shard.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import new_path, prepare, table
from .tokens import crc32, default_path, encoder, in_parts, with_end

#: Ids in a sequence, and sequences in a record batch.
LENGTH, ROWS = 2048, 256
END = 1
#: Bytes of text that a shard is meant for.
SHARD = 128 << 20


def place(uri: str) -> tuple[pafs.FileSystem, str]:
    """The store of a shared folder, and the path in it."""
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


class ShardWriter:
    """Writes one shard; holds at most one record batch of ids."""

    def __init__(self, path: str, kind: np.dtype, id_type: pa.DataType, length: int = LENGTH, rows: int = ROWS):
        self.store, self.path = place(path)
        self.length, self.rows, self.kind = length, rows, kind
        item = pa.from_numpy_dtype(kind)
        self.schema = pa.schema([("ids", pa.list_(item, length)), ("mask", pa.list_(pa.bool_(), length))])
        self.index_schema = pa.schema([("doc_id", id_type), ("start", pa.int64()), ("n_tokens", pa.int64())])
        self.out, self.index = self.store.open_output_stream(self.path), self.store.open_output_stream(f"{self.path}.docs")
        self.data, self.docs = pa.ipc.new_file(self.out, self.schema), pa.ipc.new_file(self.index, self.index_schema)
        self.open, self.held, self.entries, self.total, self.count = [], 0, [], 0, 0

    def add(self, doc_id, ids: np.ndarray) -> None:
        self.entries.append((doc_id, self.total, len(ids)))
        self.count += 1
        self.total += len(ids)
        self.open.append(ids)
        self.held += len(ids)
        full = self.length * self.rows
        if self.held >= full:
            flat = np.concatenate(self.open)
            for at in range(0, len(flat) - full + 1, full):
                self._batch(flat[at : at + full])
            rest = flat[len(flat) // full * full :].copy()
            self.open, self.held = [rest], len(rest)
        if len(self.entries) >= 8192:
            self._entries()

    def _batch(self, flat: np.ndarray) -> None:
        short = -len(flat) % self.length
        mask = np.ones(len(flat) + short, bool)
        mask[len(flat) :] = False
        ids = pa.array(np.concatenate([flat, np.zeros(short, self.kind)]).astype(self.kind))
        cols = [pa.FixedSizeListArray.from_arrays(x, self.length) for x in (ids, pa.array(mask))]
        self.data.write_batch(pa.RecordBatch.from_arrays(cols, schema=self.schema))

    def _entries(self) -> None:
        cols = list(zip(*self.entries, strict=True)) or [(), (), ()]
        self.docs.write_batch(pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, self.index_schema, strict=True)], schema=self.index_schema))
        self.entries = []

    def close(self) -> None:
        if self.held:
            self._batch(np.concatenate(self.open))
        if self.entries:
            self._entries()
        for x in (self.data, self.docs, self.out, self.index):
            x.close()


def read_shard(path: str) -> Iterator[tuple[object, int, np.ndarray]]:
    """(doc_id, start in the shard, ids) of each document, from the files alone, a few batches at a time."""
    store, at = place(path)
    with store.open_input_file(at) as f, store.open_input_file(f"{at}.docs") as g:
        data, docs = pa.ipc.open_file(f), pa.ipc.open_file(g)
        held, begin, batch = np.zeros(0, np.uint16), 0, 0
        for k in range(docs.num_record_batches):
            for doc_id, start, n in zip(*(c.to_pylist() for c in docs.get_batch(k).columns), strict=True):
                parts, have = [held[start - begin :]], begin + len(held) - start
                while have < n:
                    b = data.get_batch(batch)
                    ids, mask = b.column(0).flatten().to_numpy(), b.column(1).flatten().to_numpy(zero_copy_only=False)
                    parts.append(ids if mask[-1] else ids[mask])
                    have += len(parts[-1])
                    batch += 1
                if len(parts) > 1:
                    held, begin = np.concatenate(parts), start
                yield doc_id, start, held[start - begin : start - begin + n]


def sequences(path: str) -> tuple[pa.Table, pa.Table]:
    """A local shard memory-mapped, as (sequences, documents): nothing is copied until it is touched."""
    local = place(path)[1]
    return pa.ipc.open_file(pa.memory_map(local)).read_all(), pa.ipc.open_file(pa.memory_map(f"{local}.docs")).read_all()


def write_shards(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, length: int = LENGTH) -> DataFrame:
    """Encode every text, append the end id, and write shards in ascending order of id_col.

    Returns the manifest (shard int, path, n_docs, n_tokens), a written table; a path that it does not name
    comes from a task that failed and is not part of the data. Null texts are empty; null ids come first;
    rows of one id are ordered by their text, and repeated rows are written as often as they come. A text may
    be of any length: a shard's writer holds one record batch beside the ids of one text. Other columns, of any
    name, are ignored. An empty table gives an empty manifest. There is a shard for every SHARD bytes of text,
    and at least spark.sql.shuffle.partitions of them. Texts, not ids, go through the range exchange: two bytes
    an id are about as many as compressed text takes, and Spark runs a range exchange's input twice.
    """
    spark = docs.sparkSession
    prepare(spark)
    model, folder = tokenizer or default_path(), new_path(spark, "token-shards")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // SHARD))
    rows = rows.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, out, shard = encoder(model), None, TaskContext.get().partitionId()
        for b in batches:
            if out is None and b.num_rows:
                store, at = place(folder)
                store.create_dir(at)
                path = f"{folder}/{shard:06d}-{uuid.uuid4().hex}.arrow"
                out = ShardWriter(path, encode.kind, b.column(0).type, length)
            doc_ids = iter(b.column(0).to_pylist())
            for part in in_parts(b.column(1)):
                ids, sizes = with_end(*encode.flat(part), END)
                at = 0
                for size in sizes.tolist():
                    out.add(next(doc_ids), ids[at : at + size])
                    at += size
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int32()), "path": [path], "n_docs": [out.count], "n_tokens": [out.total]})

    return table(rows.mapInArrow(run, "shard int, path string, n_docs long, n_tokens long"), "manifest")


def read_documents(manifest: DataFrame, id_type: str = "long") -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, read from the shards; one task reads a shard."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row a shard, no more
    first = manifest.withColumn("first", F.coalesce(F.sum("n_tokens").over(before), F.lit(0))).select("shard", "path", "first")
    first = first.repartition(max(1, manifest.count()), "shard")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "start", "n_tokens", "ids_crc32"]
        for b in batches:
            for path, begin in zip(b.column("path").to_pylist(), b.column("first").to_pylist(), strict=True):
                rows = []
                for doc_id, start, ids in read_shard(path):
                    rows.append((doc_id, begin + start, len(ids), crc32(ids)))
                    if len(rows) == 8192:
                        yield pa.RecordBatch.from_arrays(list(map(pa.array, zip(*rows, strict=True))), names)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays(list(map(pa.array, zip(*rows, strict=True))), names)

    return first.mapInArrow(run, f"doc_id {id_type}, start long, n_tokens long, ids_crc32 long")
