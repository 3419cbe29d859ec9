"""Inverted indexes and corpus statistics.

Shape of every build: tokenise per row (narrow), count per row too where a document is known
to be one row (else ``groupBy`` on a key that contains the doc id, so that hashing spreads even
the hottest term evenly), then per-term statistics by a second, tiny-output aggregate.
Nothing is ever collected into one row per term except in the explicitly blocked views.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from lodestar.functions.text import doc_text, profile, tokens
from lodestar.operators.layout import text_input
from lodestar.operators.rank import rank_parts, staged, together
from lodestar.operators.skew import broadcast_if_few


def _explode_terms(df: DataFrame, keep: list[str], name: str, col: str = "terms") -> DataFrame:
    """explode without Catalyst's inferred ``size(terms) > 0`` pre-filter.

    For a plain ``explode`` Catalyst adds that filter below the generator, and the filter
    re-evaluates the whole tokenizer expression (regex included) a second time per row.
    ``explode_outer`` gets no inferred filter; the null row it yields for an empty array is
    dropped right after.
    """
    return df.select(*keep, F.explode_outer(col).alias(name)).where(F.col(name).isNotNull())


def _runs(df: DataFrame, keep: list[str], same) -> DataFrame:
    """Adds ``_starts``: where the runs of equal items of the sorted array ``_all`` begin, and its size.

    ``same(a, b)`` says whether two neighbours are one run; null for an empty array.
    """
    at = lambda i: F.get("_all", i)
    n = F.size("_all")
    starts = F.filter(F.sequence(F.lit(0), n), lambda i: (i == 0) | (i == n) | ~same(at(i), at(i - 1)))
    return df.select(*keep, "_all", F.when(n > 0, starts).alias("_starts"))


def _each_run(df: DataFrame, keep: list[str], fields) -> DataFrame:
    """A row for each run, with the ``fields(start, end)`` of the run (as in ``_explode_terms``)."""
    bound = lambda k: F.get("_starts", k)
    last = F.when(F.size("_starts") > 1, F.size("_starts") - 2)
    runs = F.transform(F.sequence(F.lit(0), last), lambda k: F.struct(*fields(bound(k), bound(k + 1))))
    return _explode_terms(df.select(*keep, runs.alias("_all_runs")), keep, "_run", "_all_runs").select(*keep, "_run.*")


def _counted(df: DataFrame, keep: list[str], items: str, name: str) -> DataFrame:
    """``(keep, name, tf)``: a row for each different item of a row's array ``items``.

    The array is sorted and its runs are counted inside the row: no exchange, and memory of one
    document, where an aggregate of all postings holds as many of them as its task gets.
    """
    ordered = df.select(*keep, F.sort_array(items).alias("_all"))
    return _each_run(_runs(ordered, keep, lambda a, b: a == b), keep, lambda start, end: [
        F.get("_all", start).alias(name), (end - start).cast("bigint").alias("tf")])


def doc_terms(corpus: DataFrame, profile_name: str = "t1") -> DataFrame:
    """``(doc_id, len, terms)``: the kept tokens of each document, in order."""
    return text_input(corpus).select(
        "doc_id", profile(profile_name).terms(doc_text()).alias("terms")
    ).select("doc_id", F.size("terms").cast("bigint").alias("len"), "terms")


def term_frequency(corpus: DataFrame, profile_name: str = "t1", per_row: bool = False) -> DataFrame:
    """Postings ``(term, doc_id, tf, len)``; ``len`` is the document length in tokens.

    ``len`` depends on doc_id only; carrying it as a grouping key costs a few bytes per
    posting and saves the BM25 build a join of all postings with the document table.

    ``per_row`` says that a document is one row of ``corpus``: its terms are then counted where
    the row lies, without an exchange.  A plan that uses such postings twice tokenizes twice.
    """
    terms = doc_terms(corpus, profile_name)
    if per_row:
        found = _counted(terms, ["doc_id", "len"], "terms", "term")
    else:
        found = _explode_terms(terms, ["doc_id", "len"], "term").groupBy("term", "doc_id", "len").agg(
            F.count(F.lit(1)).alias("tf"))
    return found.select("term", "doc_id", "tf", "len")


def postings(corpus: DataFrame, profile_name: str = "t1", per_row: bool = False) -> DataFrame:
    """Unigram postings ``(term, doc_id, tf)``."""
    return term_frequency(corpus, profile_name, per_row).select("term", "doc_id", "tf")


def term_stats(postings_df: DataFrame, key: str = "term", num_partitions: int | None = None) -> DataFrame:
    """``(term, cf, df)`` from postings: collection and document frequency.

    Postings are unique per (term, doc), so df is a plain count (no distinct needed) and
    the partial aggregate emits one row per term per map task.  With ``num_partitions`` the
    postings are exchanged into so many tasks instead: for keys so different that a partial
    aggregate would hold most of its task's postings and merge few.
    """
    if num_partitions:
        postings_df = postings_df.select(key, "tf").repartition(num_partitions, key)
    return postings_df.groupBy(key).agg(
        F.sum("tf").cast("bigint").alias("cf"),
        F.count_if(F.col("tf") > F.lit(0)).alias("df"),
    )


def doc_length(corpus: DataFrame, profile_name: str = "t1") -> DataFrame:
    """``(doc_id, len)``; empty documents have length 0 (per-row, no join)."""
    return doc_terms(corpus, profile_name).select("doc_id", "len")


def doc_stats(corpus: DataFrame, profile_name: str = "t1") -> DataFrame:
    """``(doc_id, len, headline)`` - length plus what a hit displays."""
    return text_input(corpus, "headline").select(
        "doc_id",
        F.size(profile(profile_name).terms(doc_text())).cast("bigint").alias("len"),
        "headline",
    )


def corpus_stats(doc_stats_df: DataFrame) -> DataFrame:
    """One row ``(n_docs, total_len, avgdl)``; a global aggregate with map-side partials.

    Documents are counted by id (de-duplication drops rows without one).  Referencing
    ``doc_id`` also keeps the column in this branch, so its input is the same projection
    of the corpus as the postings branch and the two share one exchange of the raw text.
    """
    return doc_stats_df.agg(
        F.count("doc_id").alias("n_docs"),
        F.coalesce(F.sum("len"), F.lit(0)).cast("bigint").alias("total_len"),
    ).select("n_docs", "total_len", _avgdl())


def _avgdl():
    # NULL rather than a division-by-zero error for an empty corpus
    return F.try_divide(F.col("total_len").cast("double"), F.col("n_docs").cast("double")).alias("avgdl")


def corpus_stats_from_postings(corpus: DataFrame, tf_df: DataFrame) -> DataFrame:
    """Same row as ``corpus_stats`` without tokenising again.

    n_docs counts ids; total_len is the sum of all term frequencies, taken from postings
    that are being computed anyway.
    """
    n = corpus.agg(F.count("doc_id").alias("n_docs"))
    total = tf_df.agg(F.coalesce(F.sum("tf"), F.lit(0)).cast("bigint").alias("total_len"))
    return n.crossJoin(F.broadcast(total)).select("n_docs", "total_len", _avgdl())


def bigram_postings(corpus: DataFrame, profile_name: str = "t2", per_row: bool = False) -> DataFrame:
    """``(bigram, doc_id, tf)`` over adjacent tokens after stop-word removal.

    ``per_row`` as in ``term_frequency``.
    """
    pairs = text_input(corpus).select("doc_id", profile(profile_name).pairs(doc_text()).alias("pairs"))
    if per_row:
        return _counted(pairs, ["doc_id"], "pairs", "bigram").select("bigram", "doc_id", "tf")
    return _explode_terms(pairs, ["doc_id"], "bigram", "pairs").groupBy("bigram", "doc_id").agg(
        F.count(F.lit(1)).alias("tf"))


def bigram_stats(bigram_postings_df: DataFrame, num_partitions: int | None = None) -> DataFrame:
    return term_stats(bigram_postings_df, "bigram", num_partitions)


def positions(corpus: DataFrame, profile_name: str = "t3") -> DataFrame:
    """Positional index in long form ``(term, doc_id, pos)``; every position is kept."""
    return token_stream(corpus, profile_name).select(F.col("token").alias("term"), "doc_id", "pos")


def token_stream(corpus: DataFrame, profile_name: str = "t1") -> DataFrame:
    """``(doc_id, pos, token)`` of a whole corpus (narrow)."""
    return tokens(text_input(corpus), profile_name)


def positional_frequency(positions_df: DataFrame) -> DataFrame:
    """``(term, frequency, df)``: total occurrences and documents per term (two-level).

    Takes positions in long form, or one row per (term, doc) as ``term_positions`` gives.
    """
    if "positions" in positions_df.columns:
        per_doc = positions_df.select("term", F.size("positions").alias("n"))
    else:
        per_doc = positions_df.groupBy("term", "doc_id").agg(F.count(F.lit(1)).alias("n"))
    return per_doc.groupBy("term").agg(
        F.sum("n").cast("bigint").alias("frequency"),
        F.count(F.lit(1)).alias("df"),
    )


# ---------------------------------------------------------------------------------------
# Nested views.  The reference keeps one list per term; here a list is cut into blocks of
# at most ``block_size`` documents so that no row (and no task) grows with the corpus.
# ---------------------------------------------------------------------------------------

def posting_list_view(postings_df: DataFrame, stats_df: DataFrame, key: str = "term",
                      block_size: int = 1024) -> DataFrame:
    """``(key, cf, block, doc_ids)``: doc ids ascending, ``block_size`` per row.

    Postings are shuffled once: how many a key has is known from the statistics.  A key with one
    block has the sum of its ``tf`` as its collection frequency; longer lists, of which there is
    at most one for ``block_size`` postings, take theirs from the statistics.
    """
    counted = "tf" in postings_df.columns
    stats, n = _list_stats(stats_df.select(key, "cf", "df"), block_size if counted else 0)
    rows = postings_df.select(key, "doc_id", F.col("tf") if counted else F.lit(None).cast("bigint").alias("tf"))
    ranked = rank_parts(rows, key, [F.col("doc_id").asc()], stored=True,
                        counts=stats.select(key, F.col("df").alias("n")), rows=n)
    blocks = together([part.where(F.col(key).isNotNull()).withColumn("block", _block(block_size)).groupBy(
        key, "block").agg(F.sort_array(F.collect_list("doc_id")).alias("doc_ids"),
                          F.sum("tf").cast("bigint").alias("_own")) for part in ranked])
    if counted:
        return _with_total(blocks, stats, key, "cf").select(key, "cf", "block", "doc_ids")
    return blocks.join(broadcast_if_few(stats), key).select(key, "cf", "block", "doc_ids")


def _list_stats(stats: DataFrame, block_size: int) -> tuple[DataFrame, int]:
    """The statistics of the keys with more than one block, written, and the postings of all keys.

    Only longer lists take a total from their statistics, and only they can be too long for a task.
    """
    seen = Observation()
    longer = staged(stats.observe(seen, F.coalesce(F.sum("df"), F.lit(0)).alias("n")).where(F.col("df") > block_size),
                    "list-stats")
    return longer, seen.get["n"]


def _with_total(blocks: DataFrame, stats: DataFrame, key: str, total: str) -> DataFrame:
    """Adds the ``total`` of each block's key: ``_own`` of the block if it is the only one.

    ``stats`` are those of the keys with more blocks.
    """
    longer = stats.select(key, F.col(total).alias("_total"))
    return blocks.join(broadcast_if_few(longer), key, "left").withColumn(total, F.coalesce("_total", "_own"))


def bigram_list_view(bigram_postings_df: DataFrame, bigram_stats_df: DataFrame,
                     block_size: int = 1024) -> DataFrame:
    """``(bigram, cf, block, doc_ids)``: the posting lists of the bigram index."""
    return posting_list_view(bigram_postings_df, bigram_stats_df, "bigram", block_size)


def positional_view(positions_df: DataFrame) -> DataFrame:
    """``(term, doc_id, positions)``: one row per (term, doc), positions ascending.

    Bounded by the length of one document, so a per-(term, doc) list is safe.
    """
    return positions_df.groupBy("term", "doc_id").agg(
        F.sort_array(F.collect_list("pos")).alias("positions")
    )


def term_positions(corpus: DataFrame, profile_name: str = "t3") -> DataFrame:
    """``positional_view`` of a corpus with one row per document, made where the row lies."""
    found = text_input(corpus).select("doc_id", profile(profile_name).pieces(doc_text()).alias("_pieces"))
    placed = F.sort_array(F.filter(
        F.transform("_pieces", lambda w, i: F.struct(w.alias("term"), (i + 1).cast("bigint").alias("pos"))),
        lambda x: profile(profile_name).keep(x["term"])))
    ordered = found.select("doc_id", placed.alias("_all"))
    runs = _runs(ordered, ["doc_id"], lambda a, b: a["term"] == b["term"])
    return _each_run(runs, ["doc_id"], lambda start, end: [
        F.get("_all", start)["term"].alias("term"),
        F.transform(F.slice("_all", start + 1, end - start), lambda x: x["pos"]).alias("positions"),
    ]).select("term", "doc_id", "positions")


def positional_list_view(positions_df: DataFrame, block_size: int = 1024) -> DataFrame:
    """``(term, frequency, block, docs)``: a term's documents ascending, each with its
    positions, ``block_size`` documents per row; ``frequency`` counts all occurrences.

    Takes positions in long form, or already one row per (term, doc) as ``term_positions`` gives.
    """
    listed = "positions" in positions_df.columns
    per_doc = positions_df if listed else staged(positional_view(positions_df), "positions-by-doc")
    stats, n = _list_stats(per_doc.groupBy("term").agg(F.sum(F.size("positions")).cast("bigint").alias("frequency"),
                                                       F.count(F.lit(1)).alias("df")), block_size)
    ranked = rank_parts(per_doc, "term", [F.col("doc_id").asc()], stored=True,
                        counts=stats.select("term", F.col("df").alias("n")), rows=n)
    blocks = together([part.where(F.col("term").isNotNull()).withColumn("block", _block(block_size)).groupBy(
        "term", "block").agg(F.sort_array(F.collect_list(F.struct("doc_id", "positions"))).alias("docs"),
                             F.sum(F.size("positions")).cast("bigint").alias("_own")) for part in ranked])
    return _with_total(blocks, stats, "term", "frequency").select("term", "frequency", "block", "docs")


def _block(block_size: int):
    return ((F.col("rank") - 1) / block_size).cast("bigint")
