"""Weights, merge, impact order and searches against the brute force."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

import brute
from lodestar.operators import index, search, weights
from lodestar.operators.rank import rank_within
from lodestar.plans.build import SearchIndex, build_index
from lodestar.sources.store import IndexStore


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    from corpora import make_corpus
    c = make_corpus(spark, brute.DOCS)
    store = IndexStore(spark, str(tmp_path_factory.mktemp("index")))
    build_index(c, store)
    return c, SearchIndex(store)


def _weights(idx, scheme):
    return {(r.term, r.doc_id): r.weight for r in idx.table(f"weights_{scheme}").collect()}


def test_weights(built):
    _, idx = built
    for scheme, want in (("bm25", brute.bm25_weights()), ("tfidf", brute.tfidf_weights())):
        got = _weights(idx, scheme)
        assert got.keys() == want.keys()
        assert all(got[k] == pytest.approx(want[k], rel=1e-12, abs=1e-12) for k in want)


def test_impact_rank(built):
    _, idx = built
    w = idx.table("weights_bm25")
    want = w.withColumn("r", F.row_number().over(
        Window.partitionBy("term").orderBy(F.col("weight").desc(), "doc_id")))
    assert want.where(F.col("r") != F.col("impact_rank")).count() == 0


def test_merge_is_whole_and_idempotent(built, spark):
    c, idx = built
    tf = index.term_frequency(c)
    ts, cs = index.term_stats(tf), index.corpus_stats(index.doc_stats(c))
    low = weights.tfidf_weights(tf.where("doc_id < 6"), ts, cs)
    high = weights.tfidf_weights(tf.where("doc_id >= 3"), ts, cs)
    merged = weights.merge_weights(low, high)
    whole = weights.tfidf_weights(tf, ts, cs)
    assert merged.exceptAll(whole).count() == 0 and whole.exceptAll(merged).count() == 0
    assert weights.merge_weights(merged, merged).exceptAll(merged).count() == 0


def _hits(df):
    return [(r.doc_id, r.score) for r in df.orderBy("rank").collect()]


def test_bm25_search(built):
    _, idx = built
    assert _hits(idx.bm25(["The", "cat"], k=5, digits=6)) == brute.bm25_search(["the", "cat"], 5)


def test_tfidf_and_cosine_search(built):
    _, idx = built
    q = ["the", "the", "dog", "cat"]
    assert _hits(idx.tfidf(q, k=20, digits=6)) == brute.tfidf_search(q, 20)
    assert _hits(idx.cosine(q, k=20, digits=6)) == brute.tfidf_search(q, 20, cosine=True)


def test_hits_have_headlines_and_ranks(built):
    _, idx = built
    rows = idx.bm25("dog", k=3).orderBy("rank").collect()
    assert [r.rank for r in rows] == [1, 2, 3]
    assert all(r.headline for r in rows)


def test_substring_exact_and_not_found(built):
    _, idx = built
    sub = {(r.term, r.doc_id) for r in idx.term_substring("at").collect()}
    assert {t for t, _ in sub} == {t for t, _ in brute.postings() if "at" in t}
    exact = idx.term_exact("dog").collect()
    assert {r.doc_id for r in exact} == {d for (t, d) in brute.postings() if t == "dog"}
    assert idx.term_exact("zzz").count() == 0
    assert {r.term for r in idx.term_exact("ca_", like=True).collect()} == {"cat"}
    assert idx.bigram_substring("dog cat").count() > 0


@pytest.mark.parametrize("w1,w2,delta", [("the", "cat", 1), ("cat", "the", 1), ("dog", "cat", 2), ("the", "the", 0)])
def test_proximity(built, w1, w2, delta):
    _, idx = built
    got = {r.doc_id: r.n_pairs for r in idx.proximity_pairs(w1, w2, delta).collect()}
    assert got == brute.proximity_pairs(w1, w2, delta)
    # symmetric in its two words
    back = {r.doc_id: r.n_pairs for r in idx.proximity_pairs(w2, w1, delta).collect()}
    assert back == got


def test_query_weights(built):
    _, idx = built
    rows = {r.term: (r.qtf, r.qweight) for r in idx.query_weights(["the", "the", "cat", "nope"]).collect()}
    assert set(rows) == {"the", "cat"} and rows["the"][0] == 2


def test_empty_query_is_an_error():
    with pytest.raises(ValueError):
        search.query_words([" "])


def test_rank_within_hot_key(spark):
    df = spark.range(0, 5000).select(
        F.when(F.col("id") % 4 != 0, F.lit("hot")).otherwise((F.col("id") % 13).cast("string")).alias("term"),
        F.col("id").alias("doc_id"), ((F.col("id") * 7919) % 101).cast("double").alias("weight"))
    order = [F.col("weight").desc(), F.col("doc_id").asc()]
    got = rank_within(df, "term", order, num_partitions=11)
    want = df.withColumn("rank", F.row_number().over(Window.partitionBy("term").orderBy(*order)).cast("bigint"))
    assert got.select("term", "doc_id", "rank").exceptAll(want.select("term", "doc_id", "rank")).count() == 0
    assert got.count() == 5000


def test_rank_within_runs_across_arrow_batches(spark):
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        df = spark.range(0, 3000).select(
            F.when(F.col("id") % 5 == 0, F.lit("a")).when(F.col("id") % 5 == 1, F.lit("b"))
            .when(F.col("id") % 5 == 2, F.lit("c")).otherwise((F.col("id") % 37).cast("string")).alias("term"),
            F.col("id").alias("doc_id"), ((F.col("id") * 31) % 17).cast("double").alias("weight"))
        order = [F.col("weight").desc(), F.col("doc_id").asc()]
        got = rank_within(df, "term", order, num_partitions=9)
        want = df.withColumn("rank", F.row_number().over(Window.partitionBy("term").orderBy(*order)).cast("bigint"))
        assert got.select("term", "doc_id", "rank").exceptAll(want.select("term", "doc_id", "rank")).count() == 0
        assert got.count() == 3000
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_empty_corpus_builds_and_finds_nothing(spark, tmp_path):
    from corpora import make_corpus
    store = build_index(make_corpus(spark, []), IndexStore(spark, str(tmp_path / "empty")))
    idx = SearchIndex(store)
    assert idx.table("postings").count() == 0
    cs = idx.table("corpus_stats").first()
    assert cs.n_docs == 0 and cs.avgdl is None
    assert idx.bm25(["cat"]).count() == 0 and idx.cosine(["cat"]).count() == 0
    assert idx.proximity("a", "b").count() == 0 and idx.term_substring("a").count() == 0


def test_rank_within_with_aqe_sized_ranges(spark):
    keys = {"spark.sql.shuffle.partitions": "24",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
            "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        df = spark.range(0, 4000).select(
            F.when(F.col("id") % 3 != 0, F.lit("hot")).otherwise((F.col("id") % 29).cast("string")).alias("term"),
            F.col("id").alias("doc_id"), ((F.col("id") * 13) % 97).cast("double").alias("weight"))
        order = [F.col("weight").desc(), F.col("doc_id").asc()]
        got = rank_within(df, "term", order)
        want = df.withColumn("rank", F.row_number().over(Window.partitionBy("term").orderBy(*order)).cast("bigint"))
        assert got.select("term", "doc_id", "rank").exceptAll(want.select("term", "doc_id", "rank")).count() == 0
        assert got.count() == 4000
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_weight_lists_of_few_and_of_many_headlines(spark, corpus_of, monkeypatch):
    c = corpus_of([(i, "hot " + f"w{chr(97 + i % 7)} " * (1 + i % 3)) for i in range(50)])
    tf = index.term_frequency(c)
    ranked = weights.impact_order(weights.tfidf_weights(tf, index.term_stats(tf), index.corpus_stats(index.doc_length(c))))
    few = weights.weight_list_view(ranked, index.doc_stats(c), 8).collect()
    monkeypatch.setattr(weights, "FEW_HEADLINE_BYTES", -1)
    many = weights.weight_list_view(ranked, index.doc_stats(c), 8).collect()
    assert sorted(map(str, few)) == sorted(map(str, many)) and len(few) > 7


def test_weight_lists_with_megabytes_of_headlines_move_no_headline(spark, corpus_of):
    c = corpus_of([(i, "hot " + f"w{chr(97 + i % 7)} " * (1 + i % 3)) for i in range(50)])
    tf = index.term_frequency(c)
    ranked = weights.impact_order(weights.tfidf_weights(tf, index.term_stats(tf), index.corpus_stats(index.doc_length(c))))
    heads = spark.range(50).select(F.col("id").alias("doc_id"), F.repeat(F.lit("Word "), 40_000).alias("headline"))
    view = weights.weight_list_view(ranked, heads, 8)  # 10 MB
    assert "SortMergeJoin [doc_id" not in view._jdf.queryExecution().executedPlan().toString()
    rows = view.select("term", "block", F.size("postings").alias("n"), F.expr(
        "forall(postings, p -> length(p.headline) = 200000)").alias("whole")).collect()
    assert sum(r["n"] for r in rows) == ranked.count() and all(r["whole"] for r in rows)
