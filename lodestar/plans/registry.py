"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the driver's ``documents`` (or ``pages``) table in full and builds what
it needs from it.  Emitted doubles are rounded to ``DIGITS`` places so that results can be
compared across engines whose ``log`` may differ in the last bit; ranked searches order
by the rounded score, then doc id.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.functions import markup
from lodestar.functions.text import doc_text
from lodestar.operators import grams, index, maintain, search, topk, weights
from lodestar.operators.layout import row_tasks, text_tasks
from lodestar.operators.rank import staged, together
from lodestar.plans.build import BuildOptions, SearchIndex, build_index
from lodestar.plans.catalog import corpus, table, unique_corpus
from lodestar.session import scratch_path
from lodestar.sources import colocated, delimited, news_xml, posting_text, results
from lodestar.sources.documents import dedupe_docs, dedupe_docs_late
from lodestar.sources.store import IndexStore

DIGITS = 6
K = 20

# Query parameters of the registered searches.
BM25_QUERY = ["the", "ention"]
TFIDF_QUERY = ["the", "the", "of", "ention"]
SUBSTRING_QUERY = "ention"
BIGRAM_QUERY = "and th"
EXACT_QUERY = "and"
LIKE_PREFIX, LIKE_SUFFIX, LIKE_INNER = "th_%", "%ing", "%enti_n%"
PROXIMITY = ("of", "the", 1)
# The merge query builds weights on two overlapping parts that together hold every
# document: ids below the 60 % point of the id range, and ids from the 40 % point on.
MERGE_HI = 0.6
MERGE_LO = 0.4

Query = Callable[[SparkSession, str], DataFrame]


def _r(c: str) -> F.Column:
    return F.round(F.col(c), DIGITS).alias(c)


# ---------------------------------------------------------------- shared building blocks

def _tf(spark, sf):
    return index.term_frequency(unique_corpus(spark, sf), per_row=True)


def _stats(spark, sf):
    # doc_length projects the corpus like the postings branch does, so both share one
    # exchange of the raw text
    return index.corpus_stats(index.doc_length(unique_corpus(spark, sf)))


def _inputs(c, words=None):
    """Postings, term statistics and corpus statistics, of all terms or of a query's words.

    A whole weight table stores its postings, so that documents are tokenized once, and the
    statistics of all terms, from which it takes the total length.  A search keeps its words right above the tokenizer, so all that follows is as
    small as they are; the lengths are counted per document.
    """
    if words is None:
        tf = staged(index.term_frequency(c, per_row=True), "postings")
        stats = staged(index.term_stats(tf), "term-stats")
        return tf, stats, index.corpus_stats_from_postings(c, stats.select(F.col("cf").alias("tf")))
    tf = index.term_frequency(c).where(search.among("term", sorted(set(words))))
    return tf, index.term_stats(tf), index.corpus_stats(index.doc_length(c))


def _bm25(spark, sf, words=None):
    return weights.bm25_weights(*_inputs(unique_corpus(spark, sf), words), stored=words is None)


def _tfidf(spark, sf, words=None):
    return weights.tfidf_weights(*_inputs(unique_corpus(spark, sf), words), stored=words is None)


def _ranked(spark, sf, weights_of):
    """All weights of a scheme by impact, in parts that share no term."""
    return weights.ranked_parts(weights_of, *_inputs(unique_corpus(spark, sf)))


def _weight_lists(spark, sf, weights_of):
    tf, stats, totals = _inputs(unique_corpus(spark, sf))
    heads = _headlines(spark, sf)
    n = stats.agg(F.coalesce(F.sum("df"), F.lit(0))).first()[0]
    return together([weights.weight_list_view(part, heads, VIEW_BLOCK, n)
                     for part in weights.ranked_parts(weights_of, tf, stats, totals)])


def _headlines(spark, sf):
    """``(doc_id, headline)`` for the k hits - straight from the corpus, no tokenizing."""
    return unique_corpus(spark, sf).select("doc_id", "headline")


def _doubled(spark, sf):
    """Every document twice: as it is, and an older version with another text."""
    c = corpus(spark, sf)
    dated = c.withColumn("date", F.lit("1996-08-21").cast("date"))
    older = c.withColumn("date", F.lit("1996-08-20").cast("date")).withColumn(
        "text", F.concat(F.lit("older words "), F.col("text"), F.lit(" zzz older")))
    return dedupe_docs(older.unionByName(dated))


def _coded(spark, sf):
    """The corpus with code lists: language, both, and source of each document."""
    extra = table(spark, sf, "documents").select("doc_id", "lang", "source")
    return corpus(spark, sf).drop("countries", "industries", "topics").join(extra, "doc_id").select(
        "doc_id", F.lit("1996-08-20").cast("date").alias("date"), "title", "headline", "byline",
        F.lit("A $ and $$, \\ here$").alias("dateline"), "text",
        F.array("lang").alias("countries"), F.array("lang", "source").alias("industries"),
        F.array("source").alias("topics"))


def _flat(df):
    """Code lists and dates as text, so that both engines compare them alike."""
    return df.select("doc_id", F.col("date").cast("string").alias("date"), "title", "headline", "byline",
                     "dateline", "text", *[F.array_join(c, "|").alias(c) for c in (
                         "countries", "industries", "topics")])


# ---------------------------------------------------------------- text and ingest

def q_doc_text(spark, sf):
    return corpus(spark, sf).select("doc_id", doc_text().alias("doc_text"))


def _tokens(profile_name: str) -> Query:
    def run(spark, sf):
        return index.token_stream(corpus(spark, sf), profile_name)
    run.__name__ = f"q_tokens_{profile_name}"
    return run


def q_clean_markup(spark, sf):
    pages = table(spark, sf, "pages")
    return pages.select("page_id", markup.clean_markup(F.col("html")).alias("text"))


def q_clean_headline(spark, sf):
    return corpus(spark, sf).select("doc_id", markup.clean_headline(F.col("text")).alias("headline"))


def q_format_hits(spark, sf):
    hits = search.bm25(_bm25(spark, sf, BM25_QUERY), _headlines(spark, sf), BM25_QUERY, K, DIGITS)
    return hits.select(
        "rank", "score",
        markup.format_hit(F.col("doc_id"), markup.clean_headline(F.col("headline")), ":").alias("hit"),
        markup.format_hit(F.col("doc_id"), markup.clean_headline(F.col("headline")), ",").alias("hit_csv"),
    )


def q_dedupe_docs(spark, sf):
    c = corpus(spark, sf)
    return dedupe_docs(c.unionByName(c)).select("doc_id", "headline", "text")


def q_dedupe_docs_late(spark, sf):
    """Every document twice, but the longest ones once: copies are aggregated, the others pass."""
    c = corpus(spark, sf)
    older = c.where(F.length("text") < 2000).withColumn("text", F.substring_index("text", "\n", 1))
    return dedupe_docs_late(c.unionByName(older)).select("doc_id", "headline", "text")


def q_export_delimited(spark, sf):
    return delimited.export_delimited(corpus(spark, sf))


def q_ingest_delimited(spark, sf):
    path = scratch_path(spark, "delimited")
    delimited.write_delimited(_coded(spark, sf), path)
    return _flat(delimited.read_delimited(spark, path))


def q_ingest_delimited_paths(spark, sf):
    """Two folders of delimited lines, read as a list of a glob and a folder."""
    short, long = scratch_path(spark, "delimited-short"), scratch_path(spark, "delimited-long")
    c = _coded(spark, sf)
    is_short = F.coalesce(F.length("text") < 1000, F.lit(True))
    delimited.write_delimited(c.where(is_short), short)
    delimited.write_delimited(c.where(~is_short), long)
    return _flat(delimited.read_delimited(spark, [f"{short}/part-*", long]))


def q_ingest_delimited_rejects(spark, sf):
    """Documents as lines with their line breaks left in: what is kept and what is not, by reason."""
    path, quarantine = scratch_path(spark, "raw-lines"), scratch_path(spark, "quarantine")
    line = F.concat(F.col("doc_id").cast("string"), F.lit("$$null$$null$$null$$null$$null$$"),
                    F.coalesce("text", F.lit("")))
    table(spark, sf, "documents").select(line.alias("value")).write.option("lineSep", "\n").text(path)
    rows, counts = delimited.read_delimited_checked(spark, path, quarantine, plain=True)
    kept = rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit("kept").alias("reason"), "n")
    rejected = spark.read.parquet(quarantine).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
    read = spark.createDataFrame([("lines read", counts["lines"]), ("lines rejected", counts["rejected"])],
                                 "reason string, n bigint")
    return kept.unionByName(rejected).unionByName(read)


def q_ingest_xml_rejects(spark, sf):
    """Records of all documents, those of short texts without an end tag of the title."""
    path = scratch_path(spark, "broken-xml")
    end = F.when(F.length("text") < 200, F.lit("")).otherwise(F.lit("</title>"))
    table(spark, sf, "documents").select(F.concat(
        F.lit("<newsitem itemid=\""), F.col("doc_id").cast("string"), F.lit("\"><title>"),
        F.col("n_chars").cast("string"), end, F.lit("</newsitem>")).alias("value")).write.text(path)
    kept = news_xml.read_news_xml(spark, path).select("doc_id", F.lit("kept").alias("status"))
    raw_id = F.regexp_extract("raw", "itemid=\"([0-9]+)\"", 1).cast("bigint")
    return kept.unionByName(news_xml.news_xml_rejects(spark, path).select(
        raw_id.alias("doc_id"), F.lit("rejected").alias("status")))


def q_ingest_xml(spark, sf):
    path = scratch_path(spark, "news-xml")
    news_xml.write_news_xml(_coded(spark, sf), path)
    return _flat(news_xml.read_news_xml(spark, path))


def q_ingest_xml_encodings(spark, sf):
    """Files in UTF-8 and in ISO-8859-1 (odd ids that it can write) in one scan."""
    path = scratch_path(spark, "news-xml-encodings")
    docs = _coded(spark, sf)
    strings = [f.name for f in docs.schema if f.dataType.simpleString() == "string"]
    latin = (F.col("doc_id") % 2 == 1) & F.concat_ws(" ", *strings).rlike("(?s)^[\\x00-\\xff]*$")
    news_xml.write_news_xml(docs.where(F.coalesce(latin, F.lit(False))), f"{path}/latin", "ISO-8859-1")
    news_xml.write_news_xml(docs.where(~F.coalesce(latin, F.lit(False))), f"{path}/utf")
    return _flat(news_xml.read_news_xml(spark, [f"{path}/latin", f"{path}/utf"], news_xml.PROLOG))


# ---------------------------------------------------------------- indexes and statistics

def q_term_frequency(spark, sf):
    return _tf(spark, sf).select("term", "doc_id", "tf")


def q_doc_length(spark, sf):
    return index.doc_length(unique_corpus(spark, sf))


def q_corpus_stats(spark, sf):
    return _stats(spark, sf).select("n_docs", "total_len", _r("avgdl"))


def q_term_idf(spark, sf):
    tf = _tf(spark, sf)
    return weights.term_idf(index.term_stats(tf), _stats(spark, sf)).select("term", "df", _r("idf"))


def q_postings_with_headline(spark, sf):
    p = index.postings(unique_corpus(spark, sf), per_row=True)
    return p.join(_headlines(spark, sf).select("doc_id", "headline"), "doc_id") \
        .select("term", "doc_id", "tf", "headline")


def q_index_unigram(spark, sf):
    return index.term_stats(index.postings(unique_corpus(spark, sf), per_row=True))


def q_index_unigram_doubled(spark, sf):
    return index.term_stats(index.postings(_doubled(spark, sf), per_row=True))


def _bigrams(spark, sf, stored=False):
    """Bigram postings and their statistics; the latter in tasks cut by the size of the text.

    ``stored`` postings are written, for plans that read them several times.
    """
    c = unique_corpus(spark, sf)
    bp = index.bigram_postings(c, per_row=True)
    bp = staged(bp, "bigram-postings") if stored else bp
    return bp, index.bigram_stats(bp, text_tasks(c))


def _term_positions(spark, sf):
    return staged(index.term_positions(unique_corpus(spark, sf)), "term-positions")


def q_index_bigram(spark, sf):
    return _bigrams(spark, sf)[1]


def q_index_bigram_postings(spark, sf):
    return index.bigram_postings(unique_corpus(spark, sf), per_row=True)


def q_index_positional(spark, sf):
    return index.positions(unique_corpus(spark, sf))


def q_positional_frequency(spark, sf):
    return index.positional_frequency(index.term_positions(unique_corpus(spark, sf)))


def q_index_roundtrip(spark, sf):
    # global ascending order by key: range-partitioned files, each sorted (disjoint ranges)
    store = IndexStore(spark, scratch_path(spark, "index"))
    c = unique_corpus(spark, sf)
    return store.write("postings", index.postings(c, per_row=True), text_tasks(c))


# ---------------------------------------------------------------- nested views
# Lists are shown as comma-joined strings so that both engines compare them as text.

VIEW_BLOCK = 1024


def _ids(c: str) -> F.Column:
    return F.array_join(F.transform(F.col(c), lambda x: x.cast("string")), ",")


def q_index_unigram_view(spark, sf):
    p = index.postings(unique_corpus(spark, sf), per_row=True)
    v = index.posting_list_view(p, index.term_stats(p), block_size=VIEW_BLOCK)
    return v.select("term", "cf", "block", _ids("doc_ids").alias("doc_ids"))


def q_index_positional_view(spark, sf):
    v = index.term_positions(unique_corpus(spark, sf))
    return v.select("term", "doc_id", _ids("positions").alias("positions"))


def q_index_bigram_view(spark, sf):
    v = index.bigram_list_view(*_bigrams(spark, sf), VIEW_BLOCK)
    return v.select("bigram", "cf", "block", _ids("doc_ids").alias("doc_ids"))


def q_index_positional_list(spark, sf):
    v = index.positional_list_view(_term_positions(spark, sf), VIEW_BLOCK)
    docs = F.transform("docs", lambda d: F.concat_ws(":", d["doc_id"].cast("string"), F.array_join(
        F.transform(d["positions"], lambda p: p.cast("string")), ",")))
    return v.select("term", "frequency", "block", F.array_join(docs, ";").alias("docs"))


def _weight_list(weights_of) -> Query:
    def run(spark, sf):
        v = _weight_lists(spark, sf, weights_of)
        shown = F.transform("postings", lambda p: F.concat_ws(
            ":", p["doc_id"].cast("string"), F.round(p["weight"] * 10 ** DIGITS).cast("bigint").cast("string"),
            p["headline"]))
        return v.select("term", _r("idf"), "block", F.array_join(shown, ";").alias("postings"))
    return run


def q_impact_list_bm25(spark, sf):
    block = ((F.col("impact_rank") - 1) / VIEW_BLOCK).cast("bigint").alias("block")
    lists = together([ranked.groupBy("term", block).agg(
        F.sort_array(F.collect_list(F.struct("impact_rank", "doc_id"))).alias("l"))
        for ranked in _ranked(spark, sf, weights.bm25_weights)])
    return lists.select("term", "block",
                        F.array_join(F.transform("l", lambda x: x["doc_id"].cast("string")), ",")
                        .alias("doc_ids"))


# ---------------------------------------------------------------- weights

def q_weights_bm25(spark, sf):
    return _bm25(spark, sf).select("term", "doc_id", "tf", _r("idf"), _r("weight"))


def q_weights_bm25_doubled(spark, sf):
    w = weights.bm25_weights(*_inputs(_doubled(spark, sf)), stored=True)
    return w.select("term", "doc_id", "tf", _r("idf"), _r("weight"))


def q_weights_tfidf(spark, sf):
    return _tfidf(spark, sf).select("term", "doc_id", "tf", _r("idf"), _r("weight"))


def q_impact_order_bm25(spark, sf):
    return together(_ranked(spark, sf, weights.bm25_weights)).select(
        "term", "doc_id", _r("weight"), "impact_rank")


def q_impact_order_tfidf(spark, sf):
    return together(_ranked(spark, sf, weights.tfidf_weights)).select(
        "term", "doc_id", _r("weight"), "impact_rank")


def q_merge_weights(spark, sf):
    """Weights built on two overlapping parts, each with its own statistics, then merged.

    A document in both parts has two rows for a term, and the heavier one stays.
    """
    c = unique_corpus(spark, sf)
    bounds = F.broadcast(c.agg(F.min("doc_id").alias("_lo"), F.max("doc_id").alias("_hi")))  # 1 row
    cut = lambda f: F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.lit(f)
    tagged = c.crossJoin(bounds)
    parts = [_inputs(tagged.where(cond).drop("_lo", "_hi")) for cond in (
        F.col("doc_id") < cut(MERGE_HI), F.col("doc_id") >= cut(MERGE_LO))]
    rows = sum(stats.agg(F.coalesce(F.sum("df"), F.lit(0))).first()[0] for _, stats, _ in parts)
    low, high = [weights.tfidf_weights(*part, stored=True) for part in parts]
    merged = weights.merge_weights(low, high, num_partitions=row_tasks(spark, rows))
    return merged.select("term", "doc_id", "tf", _r("idf"), _r("weight"))


def q_merge_weights_common(spark, sf):
    """The same two overlapping parts, weighted under their common statistics."""
    c = unique_corpus(spark, sf)
    bounds = F.broadcast(c.agg(F.min("doc_id").alias("_lo"), F.max("doc_id").alias("_hi")))  # 1 row
    cut = lambda f: F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.lit(f)
    tagged = c.crossJoin(bounds)
    parts = [tagged.where(cond).drop("_lo", "_hi") for cond in (
        F.col("doc_id") < cut(MERGE_HI), F.col("doc_id") >= cut(MERGE_LO))]
    merged = maintain.common_weights([(index.term_frequency(p, per_row=True), index.doc_length(p)) for p in parts])
    return merged.select("term", "doc_id", "tf", _r("idf"), _r("bm25"), _r("tfidf"))


def q_stream_statistics(spark, sf):
    """Term statistics kept up by two ingests of the documents, the second one replacing all."""
    from lodestar.streaming.incremental import maintained_term_stats, start_part_ingest

    store = IndexStore(spark, scratch_path(spark, "stream-index"))
    for _ in range(2):
        start_part_ingest(spark, f"{sf}/documents*.parquet", store,
                          scratch_path(spark, "stream-ckpt")).awaitTermination()
    return maintained_term_stats(spark, store)


def q_query_weights(spark, sf):
    tf = _tf(spark, sf)
    ti = weights.term_idf(index.term_stats(tf), _stats(spark, sf))
    return search.query_weights(ti, TFIDF_QUERY).select("term", "qtf", _r("idf"), _r("qweight"))


# ---------------------------------------------------------------- searches

def q_search_term_substring(spark, sf):
    p = index.postings(unique_corpus(spark, sf), per_row=True)
    return search.term_substring(index.term_stats(p), p, SUBSTRING_QUERY)


def q_search_bigram_substring(spark, sf):
    bp, stats = _bigrams(spark, sf)
    return search.bigram_substring(stats, bp, BIGRAM_QUERY)


def q_search_term_exact(spark, sf):
    p = index.postings(unique_corpus(spark, sf), per_row=True)
    return search.term_exact(index.term_stats(p), p, EXACT_QUERY)


def q_search_postings_any(spark, sf):
    return search.postings_any(_bm25(spark, sf, BM25_QUERY), BM25_QUERY).select(
        "term", "doc_id", _r("weight"))


def q_search_proximity(spark, sf):
    w1, w2, d = PROXIMITY
    return search.proximity(index.positions(unique_corpus(spark, sf)), w1, w2, d)


def q_search_proximity_pairs(spark, sf):
    w1, w2, d = PROXIMITY
    return search.proximity_pairs(index.positions(unique_corpus(spark, sf)), w1, w2, d)


def q_search_bm25(spark, sf):
    return search.bm25(_bm25(spark, sf, BM25_QUERY), _headlines(spark, sf), BM25_QUERY, K, DIGITS)


def q_search_tfidf(spark, sf):
    return search.tfidf(_tfidf(spark, sf, TFIDF_QUERY), _headlines(spark, sf), TFIDF_QUERY, K, DIGITS)


def q_search_cosine(spark, sf):
    return search.cosine(_tfidf(spark, sf, TFIDF_QUERY), _headlines(spark, sf), TFIDF_QUERY, K, DIGITS)


def _lines(spark, lines, name):
    """Lists written as text lines and read again."""
    path = scratch_path(spark, name)
    posting_text.write_lines(lines, path, "zstd")  # a headline stands once for each word of its document
    return posting_text.read_lines(spark, path)


def q_text_lists_unigram(spark, sf):
    p = staged(index.postings(unique_corpus(spark, sf), per_row=True), "postings")
    view = index.posting_list_view(p, index.term_stats(p), block_size=VIEW_BLOCK)
    return posting_text.parse_postings(_lines(spark, posting_text.posting_lines(view), "unigram-lists"))


def q_text_lists_bigram(spark, sf):
    view = index.bigram_list_view(*_bigrams(spark, sf, stored=True), VIEW_BLOCK)
    return posting_text.parse_postings(
        _lines(spark, posting_text.posting_lines(view, "bigram"), "bigram-lists"), "bigram")


def q_text_lists_positional(spark, sf):
    view = index.positional_list_view(_term_positions(spark, sf), VIEW_BLOCK)
    return posting_text.parse_positions(_lines(spark, posting_text.positional_lines(view), "positional-lists"))


def q_text_lists_weights(spark, sf):
    view = _weight_lists(spark, sf, weights.tfidf_weights)
    return posting_text.parse_weights(_lines(spark, posting_text.weight_lines(view), "weight-lists"), True).select(
        "term", _r("idf"), "doc_id", _r("weight"), "headline")


def _stored(spark, sf, *tables):
    """A stored index with some of its tables."""
    store = IndexStore(spark, scratch_path(spark, "index"))
    return SearchIndex(build_index(corpus(spark, sf), store, BuildOptions(tables=tables)))


def _built(spark, sf, scheme):
    return _stored(spark, sf, "doc_stats", "corpus_stats", f"weights_{scheme}")


def _together(spark, sf, *names):
    # laid out by document before it is tokenized: texts are shuffled, not their postings
    c = unique_corpus(spark, sf)
    n = text_tasks(c) or int(spark.conf.get("spark.sql.shuffle.partitions"))
    c = c.repartition(n, "doc_id")
    make = {"positions": index.positions, "postings": lambda d: index.postings(d, per_row=True), "doc_stats": index.doc_stats}
    return colocated.write_colocated(spark, scratch_path(spark, "colocated"), {t: make[t](c) for t in names}, n)


def q_search_proximity_colocated(spark, sf):
    return search.proximity_by_document(_together(spark, sf, "positions").read("positions"), *PROXIMITY)


def q_postings_with_headline_colocated(spark, sf):
    tables = _together(spark, sf, "postings", "doc_stats")
    return tables.read("postings").join(tables.read("doc_stats"), "doc_id").select(
        "term", "doc_id", "tf", "headline")


def q_term_grams(spark, sf):
    return grams.gram_table(index.term_stats(index.postings(unique_corpus(spark, sf), per_row=True)))


def q_search_term_substring_grams(spark, sf):
    return _stored(spark, sf, "term_grams").term_substring_grams(SUBSTRING_QUERY)


def q_search_bigram_substring_grams(spark, sf):
    return _stored(spark, sf, "bigram_grams").bigram_substring_grams(BIGRAM_QUERY)


def _like(pattern: str) -> Query:
    def run(spark, sf):
        return _stored(spark, sf, "term_grams").term_like(pattern)
    return run


def q_search_bm25_pruned(spark, sf):
    """The hits of search_bm25 from a stored index, without summing every posting."""
    return _built(spark, sf, "bm25").bm25_pruned(BM25_QUERY, K, DIGITS)


def q_search_tfidf_pruned(spark, sf):
    return _built(spark, sf, "tfidf").tfidf_pruned(TFIDF_QUERY, K, DIGITS)


def q_impact_blocks_bm25(spark, sf):
    """The block table of the stored BM25 weights (64 postings a block)."""
    blocks = [topk.block_table(topk.impact_table(ranked), 64) for ranked in _ranked(spark, sf, weights.bm25_weights)]
    return together(blocks).select(
        "term", "block", "n", _r("max_weight"), _r("min_weight"), "min_doc", "max_doc")


def q_stream_postings(spark, sf):
    """Postings built by the streaming part ingest over the documents table."""
    from lodestar.streaming.incremental import merged_postings, start_part_ingest

    store = IndexStore(spark, scratch_path(spark, "stream-index"))
    # a file stream watches a folder or glob; this glob matches only the documents table
    q = start_part_ingest(spark, f"{sf}/documents*.parquet", store, scratch_path(spark, "stream-ckpt"))
    q.awaitTermination()
    return merged_postings(spark, store).select("term", "doc_id", "tf")


def q_write_hits(spark, sf):
    hits = q_search_bm25(spark, sf)
    path = scratch_path(spark, "hits")
    results.write_hits(hits, path)
    return spark.read.parquet(path)


QUERIES: dict[str, Query] = {
    "doc_text": q_doc_text,
    "tokens_t1": _tokens("t1"),
    "tokens_t2": _tokens("t2"),
    "tokens_t2_legacy": _tokens("t2_legacy"),
    "tokens_t3": _tokens("t3"),
    "tokens_t4_legacy": _tokens("t4_legacy"),
    "clean_markup": q_clean_markup,
    "clean_headline": q_clean_headline,
    "format_hits": q_format_hits,
    "dedupe_docs": q_dedupe_docs,
    "dedupe_docs_late": q_dedupe_docs_late,
    "term_frequency": q_term_frequency,
    "doc_length": q_doc_length,
    "corpus_stats": q_corpus_stats,
    "term_idf": q_term_idf,
    "postings_with_headline": q_postings_with_headline,
    "index_unigram": q_index_unigram,
    "index_unigram_doubled": q_index_unigram_doubled,
    "index_bigram": q_index_bigram,
    "index_bigram_postings": q_index_bigram_postings,
    "index_positional": q_index_positional,
    "index_unigram_view": q_index_unigram_view,
    "index_bigram_view": q_index_bigram_view,
    "index_positional_view": q_index_positional_view,
    "index_positional_list": q_index_positional_list,
    "weight_list_bm25": _weight_list(weights.bm25_weights),
    "weight_list_tfidf": _weight_list(weights.tfidf_weights),
    "impact_list_bm25": q_impact_list_bm25,
    "positional_frequency": q_positional_frequency,
    "weights_bm25": q_weights_bm25,
    "weights_bm25_doubled": q_weights_bm25_doubled,
    "weights_tfidf": q_weights_tfidf,
    "impact_order_bm25": q_impact_order_bm25,
    "impact_order_tfidf": q_impact_order_tfidf,
    "merge_weights": q_merge_weights,
    "merge_weights_common": q_merge_weights_common,
    "stream_statistics": q_stream_statistics,
    "query_weights": q_query_weights,
    "search_term_substring": q_search_term_substring,
    "search_bigram_substring": q_search_bigram_substring,
    "search_term_exact": q_search_term_exact,
    "search_postings_any": q_search_postings_any,
    "search_proximity": q_search_proximity,
    "search_proximity_pairs": q_search_proximity_pairs,
    "search_bm25": q_search_bm25,
    "search_tfidf": q_search_tfidf,
    "search_cosine": q_search_cosine,
    "text_lists_unigram": q_text_lists_unigram,
    "text_lists_bigram": q_text_lists_bigram,
    "text_lists_positional": q_text_lists_positional,
    "text_lists_weights": q_text_lists_weights,
    "search_proximity_colocated": q_search_proximity_colocated,
    "postings_with_headline_colocated": q_postings_with_headline_colocated,
    "term_grams": q_term_grams,
    "search_term_substring_grams": q_search_term_substring_grams,
    "search_bigram_substring_grams": q_search_bigram_substring_grams,
    "search_term_like_prefix": _like(LIKE_PREFIX),
    "search_term_like_suffix": _like(LIKE_SUFFIX),
    "search_term_like_inner": _like(LIKE_INNER),
    "search_bm25_pruned": q_search_bm25_pruned,
    "search_tfidf_pruned": q_search_tfidf_pruned,
    "impact_blocks_bm25": q_impact_blocks_bm25,
    "index_roundtrip": q_index_roundtrip,
    "export_delimited": q_export_delimited,
    "ingest_delimited": q_ingest_delimited,
    "ingest_xml": q_ingest_xml,
    "ingest_xml_encodings": q_ingest_xml_encodings,
    "ingest_delimited_paths": q_ingest_delimited_paths,
    "ingest_delimited_rejects": q_ingest_delimited_rejects,
    "ingest_xml_rejects": q_ingest_xml_rejects,
    "write_hits": q_write_hits,
    "stream_postings": q_stream_postings,
}
