"""Precomputed term weights: idf, BM25, log-tf x idf, merging and impact order."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.functions import scoring
from lodestar.operators.layout import row_tasks
from lodestar.operators.rank import rank_within
from lodestar.operators.skew import hot_keys, join_key_stats, placed_key_join, salted_key_join


def stats_row(corpus_stats_df: DataFrame, n_docs: float | None = None,
              avgdl: float | None = None) -> DataFrame:
    """The 1-row ``(n_docs, avgdl)`` frame, with optional overrides of either value."""
    n = F.lit(float(n_docs)) if n_docs is not None else F.col("n_docs").cast("double")
    a = F.lit(float(avgdl)) if avgdl is not None else F.col("avgdl")
    return corpus_stats_df.select(n.alias("n_docs"), a.alias("avgdl"))


def term_idf(term_stats_df: DataFrame, corpus_stats_df: DataFrame,
             n_docs: float | None = None, avgdl: float | None = None) -> DataFrame:
    """``(term, df, idf, avgdl)`` with idf = ln(N / df).

    The stats side is exactly one row, so broadcasting it is bounded by construction.
    """
    s = F.broadcast(stats_row(corpus_stats_df, n_docs, avgdl))
    return term_stats_df.select("term", "df").crossJoin(s).select(
        "term", "df", scoring.idf(F.col("n_docs"), F.col("df")).alias("idf"), "avgdl"
    )


def _with_idf(tf_df: DataFrame, term_stats_df: DataFrame, corpus_stats_df: DataFrame,
              n_docs: float | None, avgdl: float | None, stored: bool = False,
              tasks: int | None = None) -> DataFrame:
    """Postings joined with their term's df, then with the 1-row corpus stats.

    The postings x term join is the one big join of the build, and a hot term would put a
    large share of all postings into one join partition; ``salted_key_join`` spreads such
    terms over several partitions (df is exactly the term's number of postings).  With
    ``stored`` term statistics ``join_key_stats`` broadcasts the frequent terms instead, so that
    their postings do not move; it counts the terms first, while the lazy join starts no job.  The
    1-row stats are attached after the join (a broadcast bounded by construction).  With ``tasks``
    the result lies by its terms in so many tasks (``placed_key_join``).
    """
    terms = term_stats_df.select("term", "df")
    s = F.broadcast(stats_row(corpus_stats_df, n_docs, avgdl))
    if tasks:
        joined = placed_key_join(tf_df, terms, "term", tasks)
    else:
        joined = (join_key_stats if stored else salted_key_join)(tf_df, terms, "term", "df")
    return joined.crossJoin(s).withColumn(
        "idf", scoring.idf(F.col("n_docs"), F.col("df")))


def bm25_weights(tf_df: DataFrame, term_stats_df: DataFrame, corpus_stats_df: DataFrame,
                 k1: float = scoring.K1, b: float = scoring.B,
                 n_docs: float | None = None, avgdl: float | None = None, stored: bool = False,
                 tasks: int | None = None) -> DataFrame:
    """``(term, doc_id, tf, idf, weight)`` from postings that carry ``len``."""
    j = _with_idf(tf_df, term_stats_df, corpus_stats_df, n_docs, avgdl, stored, tasks)
    return j.select(
        "term", "doc_id", "tf", "idf",
        scoring.bm25(F.col("idf"), F.col("tf"), F.col("len"), F.col("avgdl"), k1, b).alias("weight"),
    )


def tfidf_weights(tf_df: DataFrame, term_stats_df: DataFrame, corpus_stats_df: DataFrame,
                  n_docs: float | None = None, stored: bool = False, tasks: int | None = None) -> DataFrame:
    """``(term, doc_id, tf, idf, weight)`` with weight = (1 + ln tf) * idf."""
    j = _with_idf(tf_df, term_stats_df, corpus_stats_df, n_docs, None, stored, tasks)
    return j.select(
        "term", "doc_id", "tf", "idf",
        scoring.tfidf(F.col("idf"), F.col("tf")).alias("weight"),
    )


def both_weights(tf_df: DataFrame, term_stats_df: DataFrame, corpus_stats_df: DataFrame,
                 k1: float = scoring.K1, b: float = scoring.B,
                 n_docs: float | None = None, avgdl: float | None = None, stored: bool = False,
                 tasks: int | None = None) -> DataFrame:
    """``(term, doc_id, tf, idf, bm25, tfidf)``: both schemes from one join."""
    j = _with_idf(tf_df, term_stats_df, corpus_stats_df, n_docs, avgdl, stored, tasks)
    return j.select(
        "term", "doc_id", "tf", "idf",
        scoring.bm25(F.col("idf"), F.col("tf"), F.col("len"), F.col("avgdl"), k1, b).alias("bm25"),
        scoring.tfidf(F.col("idf"), F.col("tf")).alias("tfidf"),
    )


def merge_weights(*parts: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """Union weight tables built on overlapping parts and keep one row per (term, doc).

    Of several rows for a (term, doc) the one with the largest weight stays, as a whole (ties:
    larger tf, then idf).  ``max`` of a struct sorts its rows; a part holds a (term, doc) once as a
    rule, so nothing would be merged before the exchange, and with ``num_partitions`` the rows are
    sorted behind it only.
    """
    if not parts:
        raise ValueError("merge_weights needs at least one table")
    cols = ["term", "doc_id", "tf", "idf", "weight"]
    union = parts[0].select(*cols)
    for p in parts[1:]:
        union = union.unionByName(p.select(*cols))
    union = union.repartition(num_partitions, "term", "doc_id") if num_partitions else union
    return union.groupBy("term", "doc_id").agg(
        F.max(F.struct("weight", "tf", "idf")).alias("_row")
    ).select("term", "doc_id", "_row.tf", "_row.idf", "_row.weight")


def impact_order(weights_df: DataFrame, num_partitions: int | None = None,
                 stored: bool = False, counts: DataFrame | None = None, placed: bool = False) -> DataFrame:
    """Add ``impact_rank``: 1 for the heaviest posting of a term, ties by doc id.

    ``stored`` says that ``weights_df`` reads a written table, so it needs no copy; ``counts``
    are the postings ``(term, n)`` of each term, if known; ``placed`` as in ``rank_within``.
    """
    return rank_within(
        weights_df, "term", [F.col("weight").desc(), F.col("doc_id").asc()],
        rank_col="impact_rank", num_partitions=num_partitions, stored=stored, counts=counts, placed=placed,
    )


def ranked_parts(weights_of, tf_df: DataFrame, term_stats_df: DataFrame,
                 corpus_stats_df: DataFrame) -> list[DataFrame]:
    """``impact_order(weights_of(postings, ...))`` of stored postings and term statistics, in parts
    that share no term.

    The postings move once: they go to tasks by their terms, where the terms' df meet them and where
    they are weighted, ranked, and can be listed.  Terms with more postings than a task's
    share (at most as many as tasks) are a part of their own, ranked by ranges.
    """
    counts = term_stats_df.select("term", F.col("df").alias("n"))
    n = row_tasks(tf_df.sparkSession, counts.agg(F.sum("n")).first()[0])
    if n is None:
        return [impact_order(weights_of(tf_df, term_stats_df, corpus_stats_df, stored=True), stored=True,
                             counts=counts)]
    hot = hot_keys(counts, "term", "n", n).select("term").collect()
    if not hot:
        return [impact_order(weights_of(tf_df, term_stats_df, corpus_stats_df, tasks=n), placed=True)]
    keys = F.broadcast(tf_df.sparkSession.createDataFrame(hot, tf_df.select("term").schema))
    rest = tf_df.join(keys, "term", "left_anti")
    often, its_stats = tf_df.join(keys, "term", "left_semi"), term_stats_df.join(keys, "term", "left_semi")
    return [impact_order(weights_of(rest, term_stats_df, corpus_stats_df, tasks=n), placed=True),
            impact_order(weights_of(often, its_stats, corpus_stats_df, stored=True), stored=True,
                         counts=counts.join(keys, "term", "left_semi"))]


LIST_TASK_BYTES = 384 << 20
FEW_HEADLINE_BYTES = 256 << 20  # with their ids, in each executor's memory; more are joined by an exchange


def weight_list_view(ranked_df: DataFrame, doc_stats_df: DataFrame,
                     block_size: int = 1024, n_postings: int | None = None) -> DataFrame:
    """``(term, idf, block, postings)``: each term's postings by impact, in bounded blocks.

    ``postings`` is an array of ``struct(impact_rank, doc_id, weight, headline)``.  Up to
    ``FEW_HEADLINE_BYTES`` of headlines go to the ranked rows, which stay where they are: the more
    tasks make the blocks, the fewer copies of a headline lie side by side in their exchange, so
    that it is compressed less the more there is.  More headlines are joined by document, and
    exchanged with the postings to tasks cut by the size of the lists (``n_postings``, counted if
    not given), not by that of the exchange: with ``LIST_TASK_BYTES`` each they sort in memory.
    """
    heads = doc_stats_df.select("doc_id", "headline")
    size = F.octet_length("headline")
    width, total = heads.agg(F.coalesce(F.avg(size), F.lit(0.0)), F.coalesce(F.sum(size + 64), F.lit(0))).first()
    n = ranked_df.count() if n_postings is None else n_postings
    tasks = max(int(ranked_df.sparkSession.conf.get("spark.sql.shuffle.partitions")),
                math.ceil(n * (width + 96) / LIST_TASK_BYTES))
    few = total <= FEW_HEADLINE_BYTES
    # a merge join leaves the rows in the order of documents; few headlines go to the ranked rows instead
    withh = ranked_df.select("term", "idf", "doc_id", "weight", "impact_rank").join(
        F.broadcast(heads) if few else heads.hint("merge"), "doc_id", "left")
    blocks = withh.withColumn("block", ((F.col("impact_rank") - 1) / block_size).cast("bigint"))
    return (blocks if few else blocks.repartition(tasks, "term", "block")).groupBy("term", "block").agg(
        F.max("idf").alias("idf"),
        F.sort_array(F.collect_list(
            F.struct("impact_rank", "doc_id", "weight", "headline"))).alias("postings"),
    ).select("term", "idf", "block", "postings")
