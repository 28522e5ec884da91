"""WARC archives as chunked record tables.

Archives are written by the tasks that hold the payloads and read back as a table of chunks: (file, record,
chunk, bytes, running digest). Each record is a gzip member of its own, as in .warc.gz files. A reader never
holds more than one chunk of a payload; the digest travels from chunk to chunk, so the last chunk of a
record carries the digest of all of it.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType, IntegralType, LongType, StringType, StructType

from .common import new_path, prepare, table
from .token_files import place

#: Bytes of a payload that a reader holds at once, and of a compressed archive before the next one begins.
CHUNK, ARCHIVE = 1 << 20, 256 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2020-01-01T00:00:00Z"


def clean(value: str | None) -> str:
    """A header value: line ends, which would start another header, are percent-encoded."""
    return re.sub(r"[\r\n]", lambda m: f"%{ord(m[0]):02X}", value or "")


def head(kind: str, page_id: int | str | None, row: int, url: str | None, digest: str, length: int, full: int, refers: int | str | None) -> bytes:
    """Ids stand as JSON values, so numbers, strings of any characters and null come back as they were."""
    fields = {"WARC-Type": kind, "WARC-Record-ID": f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}:{row}')}>", "WARC-Date": DATE, "WARC-Target-URI": clean(url), "WARC-Payload-Digest": f"sha1:{digest}", "WARC-Page-ID": json.dumps(page_id), "WARC-Payload-Length": str(full), "Content-Type": "text/html; charset=utf-8"}
    if kind == "revisit":
        fields |= {"WARC-Profile": PROFILE, "WARC-Refers-To-Page": json.dumps(refers)}
    fields["Content-Length"] = str(length)
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items()) + "\r\n").encode()


def plan_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = 0) -> DataFrame:
    """(page_id, url, html, digest hex, bytes, kind, refers_to), one row per page: of equal payloads of at least `least`
    bytes the largest page_id is response and the others revisit it. Rows that share that id are all responses; null
    ids revisit, or are responses where the payload has no other. A null html is an empty payload; payloads may be of any
    length. Ids are whole numbers or strings, other types are refused. Other columns, of any name, are left out; an
    empty table gives an empty result. Only digests that several pages have are looked up: they are a table of their
    own, so Spark knows whether it can be broadcast and the payloads need not be shuffled."""
    kind = pages.schema[id_col].dataType
    if not isinstance(kind, (IntegralType, StringType)):
        raise TypeError(f"ids of WARC records are whole numbers or strings, not {kind.simpleString()}")
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    rows = rows.withColumns({"digest": F.sha1(F.col("html").cast("binary")), "bytes": F.octet_length("html").cast("long")})
    best = rows.filter(F.col("bytes") >= least).groupBy("digest", "bytes").agg(F.max("page_id").alias("best"), F.count("*").alias("n"))
    best = table(best.filter("n > 1").drop("n"), "repeated-payloads")
    rows = rows.join(best.withColumnsRenamed({"digest": "d2", "bytes": "b2"}), F.expr("digest = d2 and bytes = b2"), "left")
    again = F.col("best").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("best"))
    return rows.select("page_id", "url", "html", "digest", "bytes", F.when(again, "revisit").otherwise("response").alias("kind"), F.when(again, F.col("best")).alias("refers_to"))


def write_archives(records: DataFrame, archive: int = ARCHIVE) -> DataFrame:
    """Write records (of plan_records) to WARC files in the shared folder. Returns (path, n_records), a written
    table: files that it does not name are of tasks that failed and hold no data."""
    spark = records.sparkSession
    prepare(spark)
    folder = new_path(spark, "warc")

    def member(first: bytes, payload: memoryview) -> Iterator[bytes]:
        z = zlib.compressobj(1, zlib.DEFLATED, 31)
        yield z.compress(first)
        for at in range(0, len(payload), CHUNK):
            yield z.compress(payload[at : at + CHUNK])
        yield z.compress(b"\r\n\r\n") + z.flush()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = path = None
        count = size = 0
        done = []
        for b in batches:
            cols = [b.column(c).to_pylist() for c in ("page_id", "url", "digest", "bytes", "kind", "refers_to")]
            for i, (page, url, digest, full, kind, refers) in enumerate(zip(*cols, strict=True)):
                if out is None:
                    path = f"{folder}/{uuid.uuid4().hex}.warc.gz"
                    store, at = place(path)
                    store.create_dir(at.rpartition("/")[0])
                    out, count, size = store.open_output_stream(at), 0, 0
                text = base64.b32encode(bytes.fromhex(digest)).decode()
                payload = memoryview(b"" if kind == "revisit" else b.column("html")[i].as_buffer())
                for part in member(head(kind, page, count, url, text, len(payload), full, refers), payload):
                    out.write(part)
                    size += len(part)
                count += 1
                if size >= archive:
                    out.close()
                    done.append((path, count))
                    out = None
        if out is not None:
            out.close()
            done.append((path, count))
        if done:
            yield pa.RecordBatch.from_arrays(list(map(pa.array, zip(*done, strict=True))), ["path", "n_records"])

    return table(records.mapInArrow(run, "path string, n_records long"), "archives")


def read_records(path: str, chunk: int = CHUNK) -> Iterator[tuple[int, dict[str, str], int, bytes, str, bool]]:
    """(record, headers, chunk number, bytes, base-32 SHA-1 of the payload so far, last) of one archive."""
    store, at = place(path)
    with store.open_input_stream(at, buffer_size=1 << 16) as raw, gzip.GzipFile(fileobj=raw, mode="rb") as f:
        held = b""

        def need(mark: bytes) -> bytes | None:
            nonlocal held
            while (end := held.find(mark)) < 0:
                more = f.read(1 << 16)
                if not more:
                    if held.strip():
                        raise ValueError(f"{path} breaks off inside a record")
                    return None
                held += more
            found, held = held[:end], held[end + len(mark) :]
            return found

        record = 0
        while (first := need(b"\r\n\r\n")) is not None:
            version, *lines = first.decode().split("\r\n")
            if not version.startswith("WARC/"):
                raise ValueError(f"{path}: no record begins at {version[:40]!r}")
            headers = dict(x.split(": ", 1) for x in lines)
            left, digest, number = int(headers["Content-Length"]), hashlib.sha1(), 0
            while True:
                want = min(left, chunk)
                while len(held) < want and (more := f.read(want - len(held))):
                    held += more
                if len(held) < want:
                    raise ValueError(f"{path} breaks off inside a payload")
                data, held = held[:want], held[want:]
                digest.update(data)
                left -= want
                yield record, headers, number, data, base64.b32encode(digest.digest()).decode(), not left
                number += 1
                if not left:
                    break
            if need(b"\r\n\r\n") != b"":
                raise ValueError(f"{path}: record {record} does not end where its length says")
            record += 1


def chunk_schema(id_type: DataType) -> StructType:
    kind = id_type.simpleString()
    return StructType.fromDDL(f"path string, record long, page_id {kind}, url string, kind string, refers_to {kind}, payload_bytes long, payload_digest string, chunk int, data binary, digest_so_far string, last boolean")


def chunks(archives: DataFrame, data: bool = True, chunk: int = CHUNK, id_type: DataType | None = None) -> DataFrame:
    """The chunked record table of the archives. A record without payload has one empty chunk; data=False
    leaves the bytes out and keeps lengths and digests. Batches hold a few megabytes at most. id_type: type of the ids
    that the archives hold (long if not given)."""
    schema = chunk_schema(id_type or LongType())
    archives = archives.select("path").repartition(max(1, archives.count()), "path")
    names, kinds = schema.names, [to_arrow_type(f.dataType) for f in schema]

    def as_batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for b in batches:
            for path in b.column(0).to_pylist():
                for record, h, number, part, digest, last in read_records(path, chunk):
                    page, refers = json.loads(h["WARC-Page-ID"]), json.loads(h.get("WARC-Refers-To-Page", "null"))
                    rows.append((path, record, page, h["WARC-Target-URI"], h["WARC-Type"], refers, int(h["WARC-Payload-Length"]), h["WARC-Payload-Digest"].removeprefix("sha1:"), number, part if data else None, digest, last))
                    size += len(part) if data else 0
                    if len(rows) >= 2000 or size >= 4 * chunk:
                        yield as_batch(rows)
                        rows, size = [], 0
        if rows:
            yield as_batch(rows)

    return archives.mapInArrow(run, schema)


def page_records(archives: DataFrame, id_type: DataType | None = None) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every record, from the archives. A
    response's digest is the one that its last chunk carries; reading fails if that is not the header's."""
    last = chunks(archives, data=False, id_type=id_type).filter("last")
    same = F.assert_true((F.col("kind") == "revisit") | (F.col("digest_so_far") == F.col("payload_digest")), "a payload does not have its digest")
    return last.withColumn("ok", same).filter("ok is null").select("page_id", "payload_bytes", F.when(F.col("kind") == "revisit", F.col("payload_digest")).otherwise(F.col("digest_so_far")).alias("payload_digest"), F.col("kind").alias("record_type"), "refers_to")


#: What the query returns, from the pages themselves: digests of five hexadecimal digits at a time make four letters.
SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes, sha1(html) AS hex,
             max(page_id) OVER (PARTITION BY html) AS best FROM p)
SELECT page_id, payload_bytes,
       list_aggregate(list_transform(range(0, 32), lambda i:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                CAST((CAST(concat('0x', substr(hex, i // 4 * 5 + 1, 5)) AS INTEGER) >> (15 - i % 4 * 5)::INTEGER) & 31 AS INTEGER) + 1, 1)),
         'string_agg', '') AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM best OR best IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM best THEN best END AS refers_to
FROM d
"""
