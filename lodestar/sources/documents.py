"""Corpus from the driver's ``documents`` table, and document de-duplication."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.operators.rank import staged
from lodestar.operators.skew import few_keys


def from_documents(documents: DataFrame) -> DataFrame:
    """Map ``documents(doc_id, text, ...)`` onto the corpus schema.

    There is no title or byline; the headline (display only) is the first line of the
    text.  A projection: narrow, no shuffle, only ``doc_id`` and ``text`` are read.
    """
    empty_codes = F.array().cast("array<string>")
    return documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.lit(None).cast("date").alias("date"),
        F.lit(None).cast("string").alias("title"),
        F.substring_index("text", "\n", 1).alias("headline"),
        F.lit(None).cast("string").alias("byline"),
        F.lit(None).cast("string").alias("dateline"),
        F.col("text"),
        empty_codes.alias("countries"),
        empty_codes.alias("industries"),
        empty_codes.alias("topics"),
    )


def dedupe_docs(corpus: DataFrame) -> DataFrame:
    """One row per ``doc_id``; among copies the greatest (date, text, ...) row wins.

    Rows without an id are left out, as every source does.  ``groupBy`` + ``max(struct)`` is
    deterministic (unlike ``dropDuplicates``) and partially aggregated map-side, so a doc_id
    with many copies collapses before the shuffle.  The result lies hashed on ``doc_id``:
    whatever groups by keys that hold the doc id needs no second exchange.
    """
    first = [c for c in ("date", "text", "title", "headline") if c in corpus.columns]
    others = first + [c for c in corpus.columns if c not in first and c != "doc_id"]
    picked = corpus.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max(F.struct(*others)).alias("_row"))
    return picked.select(*[F.col("doc_id") if c == "doc_id" else F.col(f"_row.{c}").alias(c)
                           for c in corpus.columns])


def dedupe_docs_late(corpus: DataFrame) -> DataFrame:
    """The rows of ``dedupe_docs``, for corpora in which few documents have copies.

    Ids are counted first, from the id column alone, and the repeated ones stored.  A short list
    of them is broadcast: only documents whose id occurs more than once are shuffled, all others
    pass as they are.  With a long list all documents are aggregated.  The corpus is read
    twice, so it should be a stored table or a file scan.
    """
    known = corpus.where(F.col("doc_id").isNotNull())
    many = staged(known.groupBy("doc_id").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("doc_id"),
                  "repeated-ids")
    if many.isEmpty():
        return known
    if not few_keys(many):
        return dedupe_docs(corpus)
    ids = F.broadcast(many)
    return known.join(ids, "doc_id", "left_anti").unionByName(
        dedupe_docs(known.join(ids, "doc_id", "left_semi").select(*corpus.columns))).select(*corpus.columns)
