"""Stage documents, corpora, path lists and media listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEGMENT = "segment_id STRING, speaker STRING, start_time DOUBLE, end_time DOUBLE, duration DOUBLE, start_time_str STRING, end_time_str STRING, duration_str STRING, audio_file STRING, transcription STRING, language STRING, confidence DOUBLE, original_transcription STRING, translated_transcription STRING, source_language STRING, target_language STRING, target_language_code STRING"
#: Where a record that could not be read is kept.
BROKEN = "_broken_record"
MEDIA = ("mp4", "avi", "mov", "mkv", "webm", "wav", "mp3", "flac", "m4a")


def read_segments(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """One row per segment of stage documents: objects with a `segments` list, or bare lists of segments. Each file is one
    document, or, with lines, each line of a file.

    A bare list is read as one row per element whose `segments` is null, so both shapes share one pass.
    recording is the document's audio_file, or else its recording, or else the file's name."""
    schema = f"{SEGMENT}, recording STRING, total_segments INT, speakers ARRAY<STRING>, segments ARRAY<STRUCT<{SEGMENT.replace(' STRING', ': STRING').replace(' DOUBLE', ': DOUBLE')}>>"
    raw = spark.read.schema(schema).option("multiLine", not lines).json(path).withColumn("recording", F.coalesce("audio_file", "recording", F.element_at(F.split(F.input_file_name(), "/"), -1)))
    fields = [x.split()[0] for x in SEGMENT.split(", ")]
    own = F.array(F.struct(*fields))
    whole = F.when(F.col("segments").isNotNull(), F.col("segments")).when(F.col("segment_id").isNotNull(), own)
    return raw.select("recording", F.inline(whole))


def read_pipe_corpus(spark: SparkSession, path: str) -> DataFrame:
    """(filename, text) of a corpus with | between them; quotes mean nothing."""
    return spark.read.schema("filename STRING, text STRING").option("sep", "|").option("quote", "").csv(path)


def read_path_list(spark: SparkSession, path: str) -> DataFrame:
    """(path) of a list with one path a line; blank lines are left out."""
    return spark.read.text(path).select(F.trim("value").alias("path")).filter(F.col("path") != "")


def list_media(spark: SparkSession, folder: str, extensions: tuple[str, ...] = MEDIA, recursive: bool = True) -> DataFrame:
    """(path, length) of media files, in no order; their content is never read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", recursive).load(folder)
    kind = F.lower(F.regexp_extract("path", r"\.([^.\/]+)$", 1))
    return found.select("path", "length").filter(kind.isin(*extensions))


def pending(inputs: DataFrame, outputs: DataFrame, key: str = "path") -> DataFrame:
    """Inputs whose output does not exist yet."""
    return inputs.join(outputs.select(key).distinct(), key, "left_anti")


def quarantine(rows: DataFrame, text: Column, schema: str) -> DataFrame:
    """rows with parsed, and ok false where text is null or is not JSON of the schema: broken JSON, JSON of another shape (a list or
    a number for a map), or a value that does not fit its field. parsed is null where ok is false. Fields that the text
    lacks are null, others that it has besides are passed over."""
    kind = T._parse_datatype_string(schema)
    record = isinstance(kind, T.StructType)
    if record:  # only records have a place for what could not be read; a single value would be taken for a record's first field
        kind = T.StructType([*kind.fields, T.StructField(BROKEN, T.StringType())])
    parsed = F.from_json(text, kind, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN})
    out = rows.withColumn("parsed", parsed)
    begins = F.when(F.lit(isinstance(kind, T.ArrayType)), "[").otherwise("{")  # lists are not read as records, nor records as lists
    alone = F.from_json(F.concat(F.lit("["), text, F.lit(f',"{BROKEN}"]')), "ARRAY<STRING>")  # parsers pass over what follows a value
    ok = F.col("parsed").isNotNull() & F.ltrim(text).startswith(begins) & (F.size(alone) == 2) & (F.try_element_at(alone, F.lit(2)) == BROKEN)
    out = out.withColumn("ok", F.coalesce(ok & F.col("parsed")[BROKEN].isNull() if record else ok, F.lit(False)))
    return out.withColumn("parsed", F.when(F.col("ok"), F.col("parsed").dropFields(BROKEN) if record else F.col("parsed")))


def split_quarantine(rows: DataFrame, text: Column, schema: str, path: str) -> tuple[DataFrame, DataFrame]:
    """(good, bad): both written under path in one pass, read back from there. good has parsed instead of the text's
    failure, bad has the text itself as `broken`."""
    checked = quarantine(rows, text, schema)
    checked.withColumn("broken", F.when(~F.col("ok"), text)).write.mode("overwrite").partitionBy("ok").parquet(path)
    schema = T.StructType([*checked.drop("ok").schema.fields, T.StructField("broken", T.StringType()), T.StructField("ok", T.BooleanType())])
    both = rows.sparkSession.read.schema(schema).parquet(path)
    return both.filter("ok").drop("broken", "ok"), both.filter("not ok").drop("parsed", "ok")


def list_runs(spark: SparkSession, folder: str, begin: str, end: str, column: str = "run") -> DataFrame:
    """(run, files, bytes) of the runs from begin to end, by name, of a table that is partitioned by `column`. Folders are pruned by
    name and files only listed: no data file is opened."""
    found = spark.read.format("binaryFile").schema("path STRING, modificationTime TIMESTAMP, length LONG, content BINARY, " + f"`{column}` STRING").load(folder)
    kept = found.filter(F.col(column).between(begin, end))
    return kept.groupBy(column).agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))


def write_segments(documents: DataFrame, path: str, lines: bool = False) -> None:
    """One JSON document per recording, in folders named by it, or, with lines, one document a line in as many files as there
    are tasks: folders and files cost more than what is in them where recordings are many. Read with the same lines."""
    out = documents.write.mode("overwrite")
    (out if lines else out.partitionBy("recording")).json(path)


def write_text(texts: DataFrame, path: str) -> None:
    """(recording, value) as one text file per recording."""
    texts.select("recording", "value").write.mode("overwrite").partitionBy("recording").text(path)


def write_path_list(lists: list[DataFrame], path: str) -> None:
    """Several lists of paths as one text list."""
    out = lists[0].select("path")
    for x in lists[1:]:
        out = out.unionByName(x.select("path"))
    out.write.mode("overwrite").text(path)
