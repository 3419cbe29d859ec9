"""Registered queries of the operators in this package: the digests their contracts name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.llm import (
    fim, imatch, importance, jaccard_join, langid, line_dedup, mixing, nearest, packing,
    substring_dedup, suffix_dedup, token_counts, warc_zip,
)
from lodestar.llm.common import read_table, tokenizer_path
from lodestar.llm.oracle import ORACLE_SQL  # noqa: F401
from lodestar.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


def op1_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.compare_edited(read_table(spark, sf_dir, "documents"))


def op2_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = warc_zip.plan_records(read_table(spark, sf_dir, "pages"))
    packages = warc_zip.write_packages(planned, scratch_path(spark, "warc"))
    records = warc_zip.read_records(warc_zip.record_ranges(packages))
    return records.select(
        warc_zip.page_of("record_id").alias("page_id"), "payload_bytes", "payload_digest",
        "record_type", warc_zip.page_of("refers_to").alias("refers_to"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), tokenizer_path(), with_ids=False)


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(read_table(spark, sf_dir, "documents"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select(
        "doc_id", "text", "lang",
        F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False)).alias("held_out"))
    model = langid.fit(docs.where("not held_out"))
    return langid.predict(docs, model, ["doc_id", "held_out"]).select(
        "doc_id", "held_out", "lang_pred", "score", "accepted")


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.dedup_suffixes(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans",
                      F.sha2("kept", 256).alias("kept_sha256"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its lines, the removed ones, and the digest of the text that is left."""
    out = line_dedup.line_report(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.dedup_substrings(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op9_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.nearest(read_table(spark, sf_dir, "embeddings"), "vec_id", "embedding",
                           F.col("id") % 50 == 0).select(
        "query_id", "rank", F.col("id").alias("vec_id"), "score")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_words(*mixing.mix(read_table(spark, sf_dir, "documents")))


def op11_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fim.fill_in_middle(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                      F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(fim.restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read_table(spark, sf_dir, "documents"), tokenizer_path())


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = importance.resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"),
                              "item_id")
    return out.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES: dict[str, Query] = {
    "op1_imatch": op1_imatch,
    "op2_warc_zip": op2_warc_zip,
    "op3_packing": op3_packing,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_language_id": op5_language_id,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_line_dedup": op7_line_dedup,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_nearest": op9_nearest,
    "op10_mixing": op10_mixing,
    "op11_fim": op11_fim,
    "op12_token_counts": op12_token_counts,
    "op13_importance": op13_importance,
}
