"""One query for each operator of this subpackage, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import hard_negatives, languages, line_dedup, mixing, packing, pii, quality_model, resampling, rules, simhash, token_files, vector_forest, warc
from .common import table


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of near-duplicate documents: fingerprint and component of every document."""
    out = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def mixing_pivotal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies of each document in the mix, and the words that the mix takes from it."""
    return mixing.mix(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "copies", "taken")


def token_files_arrow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in Arrow shards of equal-length sequences, read back from the files."""
    docs = read(spark, sf_dir, "documents")
    return token_files.read_documents(token_files.write_shards(docs), docs.schema["doc_id"].dataType.simpleString())


def packing_sum_of_squares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every piece of every document in the packed sequences."""
    out = packing.pack_documents(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def warc_chunked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as WARC records, read back from the archives chunk by chunk."""
    pages = read(spark, sf_dir, "pages")
    return warc.page_records(warc.write_archives(warc.plan_records(pages)), pages.schema["page_id"].dataType)


def embedding_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of near-duplicate vectors."""
    return vector_forest.near_vectors(read(spark, sf_dir, "embeddings"))


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of every document, the base rules and the learned decision list."""
    stats = table(rules.statistics(read(spark, sf_dir, "documents")), "statistics")
    out = rules.judge(stats, rules.fit(stats, read(spark, sf_dir, "labels")))
    return out.select("doc_id", *rules.BASE, "base_failed", "kept")


def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data in every document."""
    return pii.digest(pii.find(read(spark, sf_dir, "documents")))


#: Ids that the classifiers never learn from; a null id counts as the empty text.
HELD_OUT = "crc32(cast(coalesce(cast(doc_id as string), '') as binary)) % 5 = 0"


def quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; one fifth of the ids is held out."""
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    model = quality_model.fit(docs, labels, where=f"not ({HELD_OUT})")
    out = quality_model.score(docs.select("doc_id", "text"), model)
    return out.select("doc_id", F.expr(HELD_OUT).alias("held_out"), "score", (F.col("score") >= quality_model.THRESHOLD).cast("int").alias("predicted"))


def line_dedup_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the repeats of lines that spread over sources."""
    return line_dedup.dedup_lines(read(spark, sf_dir, "documents")).select("doc_id", "text", "n_lines", "n_removed")


def hard_negative_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every 50th vector's nearest rows of its label; every 7th id has the next label."""
    label = F.expr("CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END")
    return hard_negatives.mine(read(spark, sf_dir, "embeddings"), F.expr("vec_id % 50 = 0"), label_col=label)


#: Ids that the language profiles never learn from.
NOT_TAUGHT = "crc32(cast(coalesce(cast(doc_id as string), '') as binary)) % 3 = 1"


def language_rank_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by the order of its n-grams; one third of the ids is held out."""
    docs = read(spark, sf_dir, "documents")
    profiles = languages.fit(docs, where=f"not ({NOT_TAUGHT})")
    out = languages.predict(docs.select("doc_id", "text"), profiles)
    return out.select("row.doc_id", "lang_pred", "score").select("doc_id", F.expr(NOT_TAUGHT).alias("held_out"), "lang_pred", "score")


def target_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight of every document towards the benchmark's distribution, and its rank among the quarter that is drawn."""
    return resampling.ranks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_warc_chunked": warc_chunked,
        "op2_simhash_near_dedup": simhash_near_dedup,
        "op3_quality_classifier": quality_classifier,
        "op4_mixing_pivotal": mixing_pivotal,
        "op5_token_files_arrow": token_files_arrow,
        "op6_line_dedup_spread": line_dedup_spread,
        "op7_quality_rules": quality_rules,
        "op8_personal_data": personal_data,
        "op9_packing_sum_of_squares": packing_sum_of_squares,
        "op10_embedding_forest": embedding_forest,
        "op11_hard_negatives": hard_negative_mining,
        "op12_language_rank_order": language_rank_order,
        "op13_target_resampling": target_resampling,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_warc_chunked": warc.SQL,
        "op6_line_dedup_spread": line_dedup.SQL,
        "op10_embedding_forest": vector_forest.SQL,
        "op11_hard_negatives": hard_negatives.SQL,
        "op12_language_rank_order": languages.SQL,
        "op13_target_resampling": resampling.SQL,
    }
