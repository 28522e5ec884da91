"""Table functions: one text in, rows of chunks out, for use with LATERAL."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.functions import udtf


class Chunks:
    """Chunks of whole words of at most `most` characters; a longer word is a chunk of its own."""

    def eval(self, text: str, most: int) -> Iterator[tuple[int, str]]:
        n, held = 0, ""
        for word in (text or "").split():
            if held and len(held) + 1 + len(word) > most:
                yield n, held
                n, held = n + 1, word
            else:
                held = f"{held} {word}" if held else word
        if held:
            yield n, held


def register(spark: SparkSession) -> None:
    """Make text_chunks(text, most) known to SQL."""
    kind = T.StructType([T.StructField("chunk", T.IntegerType()), T.StructField("piece", T.StringType())])
    spark.udtf.register("text_chunks", udtf(Chunks, returnType=kind))
