"""A training-data pipeline over ``documents``: five stages of the operators in ``lodestar.llm``.

``STAGES`` lists ``(name, function)``; each function takes ``(spark, docs, sf_dir)`` and
returns a DataFrame that is written as Parquet and read again as the next one's ``docs``.
All but the last return the columns of ``documents``.

Every stage: null ids, null and blank texts, repeated rows, empty tables and further columns
are handled as its operator's module says; rows that a stage does not mean to change pass
as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.llm import jaccard_join, langid, line_dedup, mixing, packing
from lodestar.llm.common import WORD, read_table, stage, tokenizer_path

LINE_WORDS = 5  # a repeated line of so many words goes even if its neighbours differ


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the labelled documents, sets ``lang`` to the prediction; rejected ones go."""
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    model = langid.fit(docs.where(~held_out).select("doc_id", "text", "lang"))
    found = langid.predict(docs.select(F.struct("*").alias("_row")), model, ["_row"], "_row.text").where("accepted")
    return found.select(*[F.col("lang_pred").alias(c) if c == "lang" else F.col(f"_row.`{c}`").alias(c)
                          for c in docs.columns])


def line_runs(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of line runs, and of single lines of ``LINE_WORDS`` words, are deleted;
    documents of which nothing is left go."""
    return line_dedup.dedup_lines(docs, long_line=LINE_WORDS, keep_rows=False)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays.

    Rows are numbered once, in a written table, so that no two rows share a name; documents
    without words are in no group and pass.
    """
    rows = stage(docs.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("key")),
                 "pipeline-numbered")
    blank = ~F.coalesce(F.col("row.text").rlike(WORD), F.lit(False))
    found = jaccard_join.jaccard_components(
        rows.where(~blank).select(F.col("key").alias("doc_id"), F.col("row.text").alias("text")))
    ids = rows.where(~blank).select("key", F.col("row.doc_id").cast("bigint").alias("id"))
    order = F.struct(F.col("id").isNull().alias("unnamed"), F.col("id"), F.col("key"))
    keep = ids.join(found.select(F.col("doc_id").alias("key"), "component_id"), "key").groupBy(
        "component_id").agg(F.min(order).alias("first")).select(F.col("first.key").alias("key"))
    kept = rows.where(~blank).join(keep, "key").unionByName(rows.where(blank))
    return kept.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are mixed to their target weights: documents repeat, or stay away."""
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of all documents, packed into training sequences: a row a piece, with its ids."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_runs),
    ("ngram_jaccard_join", near_duplicates),
    ("mixing", mixture),
    ("packing", packed),
]

ORACLE_SQL = None  # k-means, links over links and a solver are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
