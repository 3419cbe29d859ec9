"""Corpus statistics kept up by signed changes, and parts weighted under common statistics.

A part of the corpus changes the statistics by what its documents add, less what the versions
they replace had added before: ``(term, d_cf, d_df)`` for every term touched, and one row
``(d_docs, d_len)``.  The statistics at any time are the sums of all changes so far, so they
cost one row a term and part, and no pass over all postings.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.operators import weights
from lodestar.operators.rank import staged


def term_changes(added: DataFrame, removed: DataFrame | None = None) -> DataFrame:
    """``(term, d_cf, d_df)`` from postings ``(term, doc_id, tf)`` that come and that go."""
    signed = added.select("term", F.col("tf").alias("d_cf"), F.lit(1).alias("d_df"))
    if removed is not None:
        signed = signed.unionByName(removed.select("term", (-F.col("tf")).alias("d_cf"), F.lit(-1).alias("d_df")))
    return signed.groupBy("term").agg(F.sum("d_cf").cast("bigint").alias("d_cf"),
                                      F.sum("d_df").cast("bigint").alias("d_df")).where("d_cf != 0 or d_df != 0")


def size_change(added: DataFrame, removed: DataFrame | None = None) -> DataFrame:
    """One row ``(d_docs, d_len)`` from documents ``(doc_id, len)`` that come and that go."""
    signed = added.select(F.lit(1).alias("n"), "len")
    if removed is not None:
        signed = signed.unionByName(removed.select(F.lit(-1).alias("n"), (-F.col("len")).alias("len")))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    return signed.agg(total("n").alias("d_docs"), total("len").alias("d_len"))


def term_stats(changes: DataFrame) -> DataFrame:
    """``(term, cf, df)`` after all ``changes``; terms that no document holds any more are gone."""
    return changes.groupBy("term").agg(F.sum("d_cf").cast("bigint").alias("cf"),
                                       F.sum("d_df").cast("bigint").alias("df")).where("df > 0")


def corpus_stats(changes: DataFrame) -> DataFrame:
    """One row ``(n_docs, total_len, avgdl)`` after all ``changes``; without documents avgdl is null."""
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    return changes.agg(total("d_docs").alias("n_docs"), total("d_len").alias("total_len")).withColumn(
        "avgdl", F.try_divide(F.col("total_len").cast("double"), F.col("n_docs").cast("double")))


def newest(parts: Sequence[DataFrame], versions: DataFrame) -> DataFrame:
    """Rows of the numbered ``parts`` that belong to the version of their document in force."""
    union = None
    for i, p in enumerate(parts):
        tagged = p.withColumn("_part", F.lit(i))
        union = tagged if union is None else union.unionByName(tagged)
    return union.join(versions, ["doc_id", "_part"], "left_semi").drop("_part")


def common_weights(parts: Sequence[tuple[DataFrame, DataFrame]], **options) -> DataFrame:
    """``(term, doc_id, tf, idf, bm25, tfidf)`` of parts merged under common statistics.

    ``parts`` are pairs ``(term, doc_id, tf, len)`` and ``(doc_id, len)``.  A document that lies in
    several parts counts once, as the last of them has it; df, N and the mean length are those
    of all documents together, so every posting has the weight that a build of the whole corpus
    would give it.  The postings in force and their statistics are written, as the weights read
    them several times.  (``weights.merge_weights`` keeps one of the weights that the parts' own
    statistics gave.)
    """
    if not parts:
        raise ValueError("common_weights needs at least one part")
    versions = None
    for i, (_, docs) in enumerate(parts):
        tagged = docs.select("doc_id", F.lit(i).alias("_part"))
        versions = tagged if versions is None else versions.unionByName(tagged)
    versions = versions.groupBy("doc_id").agg(F.max("_part").alias("_part"))
    postings = staged(newest([p.select("term", "doc_id", "tf", "len") for p, _ in parts], versions), "postings")
    terms = staged(term_stats(term_changes(postings)), "term-stats")
    docs = newest([d.select("doc_id", "len") for _, d in parts], versions)
    return weights.both_weights(postings, terms, corpus_stats(size_change(docs)), stored=True, **options)
