"""Searches over the index tables; each returns a DataFrame (empty = not found).

Query words are bounded by the query, so they travel as literals: an ``IN`` list that
Parquet pushes down (row-group skipping on the term-sorted tables) and, where a per-word
count is needed, a literal map.  No join with a query table.  The only rows that ever
reach the driver are the k winners of a ranked search in eager mode (``_top_hits``).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestar.functions import scoring
from lodestar.operators import grams, topk
from lodestar.operators.rank import rank_within
from lodestar.operators.skew import salted_key_join

DEFAULT_K = 20
MAX_K = 100_000  # up to here hits are broadcast, and in eager mode fetched; above they are ranked in parallel
MAX_EAGER_KEYS = 200  # matching terms that are looked up before their postings are read
IN_VALUES = 10  # Parquet gets longer IN lists as one range


def query_words(words: str | Iterable[str], allow_empty: bool = False) -> list[str]:
    """Lower-cased query words in order, repeats kept."""
    if isinstance(words, str):
        words = words.split()
    out = [w.strip().lower() for w in words if w and w.strip()]
    if not out and not allow_empty:
        raise ValueError("empty query")
    return out


def among(column: str, values: list) -> Column:
    """``column IN (values)`` as a disjunction of short lists.

    Spark hands Parquet an ``IN`` of up to ``IN_VALUES`` values value by value, and a longer one
    only by its smallest and largest.
    """
    parts = [F.col(column).isin(values[i:i + IN_VALUES]) for i in range(0, len(values), IN_VALUES)]
    out = parts[0] if parts else F.lit(False)
    for p in parts[1:]:
        out = out | p
    return out


def _qtf_map(words: list[str]) -> Column:
    counts = Counter(words)
    return F.create_map(*[x for w in sorted(counts) for x in (F.lit(w), F.lit(counts[w]))])


# ----------------------------------------------------------------------------- lookups

def _with_frequency(matches: DataFrame, stats_df: DataFrame, key: str) -> DataFrame:
    # df is the number of postings of a key: hot keys (a substring query such as "e"
    # matches the hottest terms) are salted across partitions
    stats = stats_df.select(key, "df", F.col("cf").alias("frequency"))
    return salted_key_join(matches, stats, key, "df").select(key, "frequency", "doc_id")


def term_substring(term_stats_df: DataFrame, postings_df: DataFrame, q: str,
                   key: str = "term", eager: bool = False) -> DataFrame:
    """``(term, frequency, doc_id)`` for every term containing ``q`` (``''`` = all terms).

    ``eager`` looks the matching terms up first (one row per term of the index) and reads
    only their postings, when they are few.
    """
    q = q.lower()
    cond = F.col(key).contains(q)
    matched = term_stats_df.where(cond)
    if eager:
        keys = [r[key] for r in matched.select(key).limit(MAX_EAGER_KEYS + 1).collect()]
        if len(keys) <= MAX_EAGER_KEYS:  # pruned by key; more of them are filtered row by row
            cond = among(key, sorted(keys))
    return _with_frequency(postings_df.where(cond).select(key, "doc_id"), matched, key)


def bigram_substring(bigram_stats_df: DataFrame, bigram_postings_df: DataFrame,
                     q: str, eager: bool = False) -> DataFrame:
    """``(bigram, frequency, doc_id)`` for every bigram containing ``q`` ("w1 w2")."""
    return term_substring(bigram_stats_df, bigram_postings_df, q, "bigram", eager)


def _of_keys(keys: DataFrame, stats_df: DataFrame, postings_df: DataFrame, key: str) -> DataFrame:
    """``(key, frequency, doc_id)`` of the terms in ``keys``.

    Few of them are looked up by name; more are joined (hot ones salted), so nothing unbounded
    reaches the driver.
    """
    names = [r[key] for r in keys.limit(MAX_EAGER_KEYS + 1).collect()]
    if len(names) <= MAX_EAGER_KEYS:
        cond = among(key, sorted(names))
        return _with_frequency(postings_df.where(cond).select(key, "doc_id"), stats_df.where(cond), key)
    return _with_frequency(postings_df.select(key, "doc_id"), stats_df.join(keys, key, "left_semi"), key)


def term_substring_grams(grams_df: DataFrame, term_stats_df: DataFrame, postings_df: DataFrame, q: str,
                         key: str = "term") -> DataFrame:
    """The rows of ``term_substring``, with the terms found in a gram table (``operators.grams``)."""
    q = q.lower()
    if not q:
        return term_substring(term_stats_df, postings_df, q, key)
    return _of_keys(grams.keys_containing(grams_df, q, key), term_stats_df, postings_df, key)


def term_like(grams_df: DataFrame, reversed_df: DataFrame, term_stats_df: DataFrame, postings_df: DataFrame,
              pattern: str, key: str = "term") -> DataFrame:
    """``(term, frequency, doc_id)`` of the terms that a LIKE pattern matches."""
    keys = grams.keys_like(term_stats_df, grams_df, reversed_df, pattern.lower(), key)
    return _of_keys(keys, term_stats_df, postings_df, key)


def term_exact(term_stats_df: DataFrame, postings_df: DataFrame, word: str,
               like: bool = False) -> DataFrame:
    """``(term, frequency, doc_id)`` for one term; ``like=True`` treats ``%``/``_`` as
    wildcards, as a raw SQL LIKE pattern would."""
    w = word.lower()
    cond = F.col("term").like(w) if like else (F.col("term") == F.lit(w))
    return _with_frequency(postings_df.where(cond).select("term", "doc_id"),
                           term_stats_df.where(cond), "term")


def postings_any(weights_df: DataFrame, words: str | Iterable[str]) -> DataFrame:
    """Weighted postings of any of the query words (a pushed-down ``IN``)."""
    ws = sorted(set(query_words(words)))
    return weights_df.where(among("term", ws))


# ----------------------------------------------------------------------------- proximity

def proximity_pairs(positions_df: DataFrame, w1: str, w2: str, delta: int = 1) -> DataFrame:
    """``(doc_id, n_pairs)``: pairs (p1 of w1, p2 of w2) in a doc with |p1 - p2| = delta.

    The distance test is turned into an equi-join: each w1 position proposes the one or
    two positions where w2 would have to be, joined on (doc_id, pos).  The join key holds
    the doc id, so even the most frequent word spreads evenly, and matches per w1
    position are at most two - never all pairs of a document.
    """
    if delta < 0:
        raise ValueError("delta must be >= 0")
    a = positions_df.where(F.col("term") == F.lit(w1.lower())).select("doc_id", F.col("pos").alias("p1"))
    b = positions_df.where(F.col("term") == F.lit(w2.lower())).select("doc_id", F.col("pos").alias("p2"))
    targets = F.array_distinct(F.array(F.col("p1") - F.lit(delta), F.col("p1") + F.lit(delta)))
    cand = a.select("doc_id", "p1", F.explode(targets).alias("p2"))
    pairs = cand.join(b, ["doc_id", "p2"])
    return pairs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_pairs"))


def proximity_by_document(positions_df: DataFrame, w1: str, w2: str, delta: int = 1) -> DataFrame:
    """The rows of ``proximity_pairs`` from one scan and one aggregate by document, without a join.

    A document's places of both words come together (bounded by its length), those of w1
    moved by ``delta`` meet those of w2.  On positions that are bucketed by document
    (``sources.colocated``) there is no exchange.
    """
    if delta < 0:
        raise ValueError("delta must be >= 0")
    a, b = w1.lower(), w2.lower()
    is_a, is_b = F.col("term") == F.lit(a), F.col("term") == F.lit(b)
    places = positions_df.where(is_a | is_b).groupBy("doc_id").agg(
        F.collect_list(F.when(is_a, F.col("pos"))).alias("a"), F.collect_list(F.when(is_b, F.col("pos"))).alias("b"))

    def met(by: int) -> Column:
        return F.size(F.array_intersect(F.transform("a", lambda p: p + by), F.col("b")))

    pairs = met(0) if delta == 0 else met(delta) + met(-delta)
    return places.select("doc_id", pairs.cast("bigint").alias("n_pairs")).where(F.col("n_pairs") > 0)


def proximity(positions_df: DataFrame, w1: str, w2: str, delta: int = 1) -> DataFrame:
    """``(doc_id)`` of documents where w1 and w2 occur exactly ``delta`` apart."""
    return proximity_pairs(positions_df, w1, w2, delta).select("doc_id")


# ----------------------------------------------------------------------------- ranking

HIT_SCHEMA = "rank INT, doc_id BIGINT, score DOUBLE"


def _top_hits(scores: DataFrame, doc_stats_df: DataFrame, k: int, digits: int | None,
              eager: bool = False) -> DataFrame:
    """Top-k by score (ties: smaller doc id first) with rank and headline.

    ``orderBy(...).limit(k)`` becomes TakeOrderedAndProject: every task keeps k rows, so
    only k x tasks rows meet on one core.  Headlines are then attached in one of two ways:

    * lazy (default): a broadcast of the k winners joined with the headline table - the
      plan stays a DataFrame, but the headline table is scanned in full;
    * ``eager=True``: the k winners (the result itself, bounded by k) are fetched, and
      headlines are read with short ``doc_id IN (...)`` lists pushed into the Parquet scan,
      which on a doc-id-sorted table reads only the row groups of those k documents.

    More than ``MAX_K`` hits are neither broadcast nor sorted in one task: they are ranked over
    ranges of scores (``rank_within``) and joined with the headlines by document.

    A winner without a row in ``doc_stats`` keeps its place, with a null headline.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    if digits is not None:
        scores = scores.withColumn("score", F.round("score", digits))
    if k > MAX_K:
        order = [F.col("score").desc(), F.col("doc_id").asc()]
        placed = rank_within(scores.select("doc_id", "score", F.lit(0).alias("_list")), "_list", order)
        return placed.where(F.col("rank") <= k).join(
            doc_stats_df.select("doc_id", "headline"), "doc_id", "left").select(
            F.col("rank").cast("int").alias("rank"), "doc_id", "score", "headline")
    top = scores.orderBy(F.col("score").desc(), F.col("doc_id").asc()).limit(k)
    if eager:
        winners = top.collect()
        spark = scores.sparkSession
        ranked = spark.createDataFrame(
            [(i + 1, r["doc_id"], r["score"]) for i, r in enumerate(winners)], HIT_SCHEMA)
        heads = doc_stats_df.where(among("doc_id", sorted(r["doc_id"] for r in winners)))
    else:
        ranked = top.withColumn(
            "rank", F.row_number().over(Window.orderBy(F.col("score").desc(), F.col("doc_id").asc()))
        )
        heads = doc_stats_df
    # k rows are broadcast to read their headlines, and joined with those once more
    found = heads.select("doc_id", "headline").join(F.broadcast(ranked.select("doc_id")), "doc_id")
    return ranked.join(F.broadcast(found), "doc_id", "left").select(
        F.col("rank").cast("int").alias("rank"), "doc_id", "score", "headline")


def bm25(weights_df: DataFrame, doc_stats_df: DataFrame, words: str | Iterable[str],
         k: int = DEFAULT_K, digits: int | None = None, eager: bool = False) -> DataFrame:
    """BM25 hits: score = (sum of the matched words' weights) / 2.

    A repeated query word counts once (membership test).  ``groupBy(doc_id)`` keys on the
    document, so a hot query word spreads over all tasks and is summed map-side first.
    """
    scores = postings_any(weights_df, words).groupBy("doc_id").agg(
        (F.sum("weight") / F.lit(2.0)).alias("score")
    )
    return _top_hits(scores, doc_stats_df, k, digits, eager)


def _slack(digits: int | None) -> float:
    """How far sums of weights may lie apart and still round to one score (half the sum)."""
    return 0.0 if digits is None else 2.0 * 10.0 ** -digits


def bm25_pruned(weights_df: DataFrame, impacts_df: DataFrame, blocks_df: DataFrame, doc_stats_df: DataFrame,
                words: str | Iterable[str], k: int = DEFAULT_K, digits: int | None = None,
                eager: bool = False, block_size: int = topk.BLOCK_SIZE) -> DataFrame:
    """The hits of ``bm25``, reading only postings that can matter (see ``operators.topk``)."""
    ws = sorted(set(query_words(words)))
    found = topk.candidate_postings(weights_df, impacts_df, blocks_df, dict.fromkeys(ws, 1.0), k,
                                    _slack(digits), block_size)
    return bm25(found, doc_stats_df, ws, k, digits, eager)


def tfidf_pruned(weights_df: DataFrame, impacts_df: DataFrame, blocks_df: DataFrame, doc_stats_df: DataFrame,
                 words: str | Iterable[str], k: int = DEFAULT_K, digits: int | None = None,
                 eager: bool = False, block_size: int = topk.BLOCK_SIZE) -> DataFrame:
    """The hits of ``tfidf``, reading only postings that can matter (see ``operators.topk``)."""
    ws = query_words(words)
    factors = {w: float(n) for w, n in Counter(ws).items()}
    found = topk.candidate_postings(weights_df, impacts_df, blocks_df, factors, k, _slack(digits), block_size)
    return tfidf(found, doc_stats_df, ws, k, digits, eager)


def _query_pairs(weights_df: DataFrame, words: list[str]) -> DataFrame:
    """Matched postings with the query count ``qtf`` and query weight ``qw``."""
    m = postings_any(weights_df, words)
    qtf = F.element_at(_qtf_map(words), F.col("term")).cast("double")
    return m.select(
        "doc_id", "term", F.col("weight").alias("dw"), qtf.alias("qtf"),
        scoring.tfidf(F.col("idf"), qtf).alias("qw"),
    )


def query_weights(term_idf_df: DataFrame, words: str | Iterable[str]) -> DataFrame:
    """``(term, qtf, idf, qweight)`` for the query words found in the index."""
    ws = query_words(words)
    qtf = F.element_at(_qtf_map(ws), F.col("term"))
    return term_idf_df.where(F.col("term").isin(sorted(set(ws)))).select(
        "term", qtf.cast("bigint").alias("qtf"), "idf",
        scoring.tfidf(F.col("idf"), qtf).alias("qweight"),
    )


def tfidf(weights_df: DataFrame, doc_stats_df: DataFrame, words: str | Iterable[str],
          k: int = DEFAULT_K, digits: int | None = None, eager: bool = False) -> DataFrame:
    """Tf-idf hits: score = sum over query words (repeats included) of the doc weight / 2."""
    pairs = _query_pairs(weights_df, query_words(words))
    scores = pairs.groupBy("doc_id").agg(
        (F.sum(F.col("qtf") * F.col("dw")) / F.lit(2.0)).alias("score")
    )
    return _top_hits(scores, doc_stats_df, k, digits, eager)


def cosine(weights_df: DataFrame, doc_stats_df: DataFrame, words: str | Iterable[str],
           k: int = DEFAULT_K, digits: int | None = None, eager: bool = False) -> DataFrame:
    """Cosine hits; both norms run over the matched query words only (repeats counted)."""
    pairs = _query_pairs(weights_df, query_words(words))
    sums = pairs.groupBy("doc_id").agg(
        F.sum(F.col("qtf") * F.col("qw") * F.col("dw")).alias("dot"),
        F.sum(F.col("qtf") * F.col("qw") * F.col("qw")).alias("q_sq"),
        F.sum(F.col("qtf") * F.col("dw") * F.col("dw")).alias("d_sq"),
    )
    scores = sums.select("doc_id", scoring.cosine(F.col("dot"), F.col("q_sq"), F.col("d_sq")).alias("score"))
    return _top_hits(scores, doc_stats_df, k, digits, eager)
