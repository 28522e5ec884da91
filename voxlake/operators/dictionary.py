"""Words, sentences or other parts of texts mapped by a dictionary that is a table of any size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import table

#: Entries of a dictionary that is broadcast at most, and their characters together.
ENTRIES, CHARACTERS = 200_000, 16_000_000
#: Rows whose parts are replaced at once.
SLICE = 1024


def _fits(entries: DataFrame) -> bool:
    n, size = entries.agg(F.count("*"), F.coalesce(F.sum(F.length("__key") + F.length("__to")), F.lit(0))).first()
    return n <= ENTRIES and size <= CHARACTERS


def map_parts(rows: DataFrame, parts: str, dictionary: DataFrame, key: str = "key", to: str = "to") -> DataFrame:
    """rows with each part in the list column `parts` replaced by what the dictionary (key, to) has for it; parts that it does not
    have stay as they are, in their place. Null keys and values count for nothing, of repeated keys the smallest value
    holds; null parts and null lists stay null.

    A dictionary within ENTRIES is broadcast, and each task looks up the different parts of a batch. Of a larger one only
    the entries that rows use are kept, by a join with their different parts; if these do not fit either, the parts
    of rows are joined with them and put back by the row's number. All ways give the same rows."""
    entries = dictionary.select(F.col(key).alias("__key"), F.col(to).alias("__to")).filter("__key is not null and __to is not null")
    entries = table(entries.groupBy("__key").agg(F.min("__to").alias("__to")), "dictionary")
    if not _fits(entries):
        used = rows.select(F.explode(parts).alias("__key")).distinct()
        entries = table(entries.join(used, "__key", "left_semi"), "used-entries")
    if _fits(entries):
        known = rows.sparkSession.sparkContext.broadcast(dict(entries.toPandas().itertuples(index=False)))
        return rows.mapInArrow(_by_lookup(parts, known), rows.schema)
    numbered = table(rows.withColumn("__row", F.monotonically_increasing_id()), "numbered")
    found = numbered.select("__row", F.explode(F.array_distinct(parts)).alias("__key")).join(entries, "__key")
    found = found.groupBy("__row").agg(F.collect_list("__key").alias("__keys"), F.collect_list("__to").alias("__tos"))
    out = numbered.join(found, "__row", "left").drop("__row")
    return out.mapInArrow(_by_own_entries(parts), rows.schema)


def _replaced(lists: pa.ListArray, values: pa.Array) -> pa.ListArray:
    """The same lists with other values."""
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
    return pa.ListArray.from_arrays(ends, values, mask=lists.is_null() if lists.null_count else None)


def _sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows, at most SLICE a batch: what is made of a batch is let go before the next."""
    for b in batches:
        for at in range(0, b.num_rows, SLICE):
            yield b.slice(at, SLICE)


def _by_lookup(parts: str, known):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _sliced(batches):
            at = b.schema.get_field_index(parts)
            coded = b.column(at).flatten().dictionary_encode()
            new = pa.array([known.value.get(w, w) for w in coded.dictionary.to_pylist()], pa.string())
            yield b.set_column(at, b.schema.field(at), _replaced(b.column(at), new.take(coded.indices)).cast(b.schema.field(at).type))

    return run


def _by_own_entries(parts: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _sliced(batches):
            at, n = b.schema.get_field_index(parts), b.num_columns - 2
            out = []
            for words, keys, tos in zip(b.column(at).to_pylist(), b.column(n).to_pylist(), b.column(n + 1).to_pylist(), strict=True):
                own = dict(zip(keys or (), tos or (), strict=True))
                out.append(words and [own.get(w, w) for w in words])
            own = b.select(b.schema.names[:n])
            yield own.set_column(at, own.schema.field(at), pa.array(out, own.schema.field(at).type))

    return run
