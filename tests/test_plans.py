"""Plan shape and end-to-end goldens through the build path."""

import math

import pytest
from pyspark.sql import functions as F

import brute
from corpora import plan_text
from lodestar.functions import scoring
from lodestar.operators import index, search, weights
from lodestar.plans.build import BuildOptions, SearchIndex, build_index
from lodestar.sources.documents import dedupe_docs, dedupe_docs_late
from lodestar.sources.store import IndexStore


def _final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_bm25_build_tokenizes_once(spark, corpus_of):
    c = corpus_of(brute.DOCS)
    tf = index.term_frequency(c)
    w = weights.bm25_weights(tf, index.term_stats(tf), index.corpus_stats_from_postings(c, tf))
    plan = _final_plan(w)
    # postings, document frequency and total length share one postings exchange
    assert plan.count("ReusedExchange") >= 2
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_stored_search_pushes_terms_and_takes_top_k(spark, corpus_of, tmp_path):
    store = build_index(corpus_of(brute.DOCS), IndexStore(spark, str(tmp_path / "i")),
                        BuildOptions(tables=("postings", "term_stats", "doc_stats", "corpus_stats",
                                             "weights_bm25")))
    hits = SearchIndex(store, eager=False).bm25(["cat", "dog"], k=3)
    plan = _final_plan(hits)
    assert "PushedFilters: [In(term, [cat,dog])]" in plan
    assert "TakeOrderedAndProject" in plan
    assert "ReadSchema: struct<term:string,doc_id:bigint,weight:double>" in plan


def test_reference_goldens_through_build(spark, corpus_of, tmp_path):
    """With the reference's N and avgdl, its printed weights come out of the build.

    doc 757478: 113 tokens, "alamosa" once, in no other doc      -> 17.98570241495611
    doc 274280: 132 tokens, "amalgamated" 6 times; 366 docs hold the word -> 16.2321782572662
    """
    filler = lambda n: " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}" for i in range(n))
    docs = [(757478, "alamosa " + filler(112)), (274280, " ".join(["amalgamated"] * 6) + " " + filler(126))]
    docs += [(1000 + i, "amalgamated") for i in range(365)]
    opts = BuildOptions(n_docs=scoring.REFERENCE_N_DOCS, avgdl=scoring.REFERENCE_AVGDL,
                        impact_order=False,
                        tables=("postings", "term_stats", "doc_stats", "corpus_stats", "weights_bm25"))
    store = build_index(corpus_of(docs), IndexStore(spark, str(tmp_path / "g")), opts)
    w = {(r.term, r.doc_id): (r.idf, r.weight) for r in store.read("weights_bm25")
         .where(F.col("term").isin("alamosa", "amalgamated")).collect()}
    idf, weight = w[("alamosa", 757478)]
    assert idf == pytest.approx(14.293967110378958, abs=4 * math.ulp(14.3))
    assert weight == pytest.approx(17.98570241495611, abs=2 * math.ulp(18.0))
    idf, weight = w[("amalgamated", 274280)]
    assert idf == pytest.approx(8.391333776977591, abs=4 * math.ulp(8.4))
    assert weight == pytest.approx(16.2321782572662, abs=2 * math.ulp(16.2))


def _jobs(spark) -> int:
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))


def test_planning_an_index_starts_no_job(spark, corpus_of):
    c = dedupe_docs(corpus_of(brute.DOCS).unionByName(corpus_of(brute.DOCS)))
    before = _jobs(spark)
    tf = index.term_frequency(c)
    weights.bm25_weights(tf, index.term_stats(tf), index.corpus_stats_from_postings(c, tf))
    index.bigram_postings(c), index.positions(c), index.doc_stats(c)
    assert _jobs(spark) == before


def test_deduplication_is_the_only_exchange_before_postings(spark, corpus_of):
    df = index.postings(dedupe_docs(corpus_of(brute.DOCS)))
    plan = _final_plan(df).split("== Initial Plan ==")[0]
    assert plan.count("Exchange hashpartitioning(doc_id") == 1
    assert "Exchange hashpartitioning(term" not in plan


def test_search_keeps_its_words_at_every_tokenizer(spark):
    from lodestar.plans import registry
    q = registry.QUERIES["search_bm25"](spark, "/root/testdata/sf0.001")
    plan = q._jdf.queryExecution().optimizedPlan().toString()
    generators = [i for i, line in enumerate(plan.splitlines()) if "Generate explode" in line and "term" in line]
    assert generators
    for i in generators:
        assert "ention" in "".join(plan.splitlines()[max(0, i - 2):i])


def test_long_id_lists_prune_row_groups(spark, tmp_path):
    """At the default k the headline scan reads a small part of the row groups."""
    from lodestar.operators.search import DEFAULT_K, among
    n = 200_000
    path = str(tmp_path / "heads")
    spark.range(0, n, 1, 1).select(F.col("id").alias("doc_id"), F.lit("h").alias("headline")) \
        .write.option("parquet.block.size", 64 * 1024).option("parquet.page.row.count.limit", 1000) \
        .parquet(path)
    wanted = [i * (n // DEFAULT_K) for i in range(DEFAULT_K)]
    df = spark.read.parquet(path).where(among("doc_id", wanted))
    assert df.count() == DEFAULT_K
    rows = spark.read.parquet(path).where(among("doc_id", wanted)).select("doc_id", "headline")
    rows.collect()
    assert _scanned(rows) < n / 5


def _scanned(df) -> int:
    """Rows that left the scan of an executed plan."""
    plan = df._jdf.queryExecution().executedPlan()
    while plan.children().size():
        plan = plan.children().head()
    return plan.metrics().apply("numOutputRows").value()


def test_stored_tables_are_disjoint_by_term(spark, corpus_of, tmp_path):
    import glob

    import pyarrow.parquet as pq
    docs = [(i, " ".join(f"w{chr(97 + (i * 7 + j) % 26)}{chr(97 + j % 26)}" for j in range(40))) for i in range(300)]
    aqe = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(aqe, "false")  # ranges this small would become one file
    try:
        store = build_index(corpus_of(docs), IndexStore(spark, str(tmp_path / "d")), BuildOptions(
            tables=("postings", "term_stats", "bigram_postings", "bigram_stats", "positions")))
    finally:
        spark.conf.set(aqe, "true")
    for name, key in (("postings", "term"), ("bigram_postings", "bigram"), ("positions", "term")):
        ranges = []
        for f in glob.glob(f"{store.path(name)}/part-*.parquet"):
            keys = pq.read_table(f, columns=[key]).column(key).to_pylist()
            if keys:
                assert keys == sorted(keys)
                ranges.append((keys[0], keys[-1]))
        ranges.sort()
        assert len(ranges) > 1 and all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))


def test_both_weights_come_from_one_join(spark, corpus_of, tmp_path):
    store = build_index(corpus_of(brute.DOCS), IndexStore(spark, str(tmp_path / "b")))
    both = store.read("weights_unranked")
    for s in ("bm25", "tfidf"):
        a = both.select("term", "doc_id", F.col(s).alias("weight"))
        b = store.read(f"weights_{s}").select("term", "doc_id", "weight")
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_doubled_documents_change_nothing(spark, corpus_of, tmp_path):
    docs = [(1, "cat dog"), (1, "cat dog bird"), (2, "dog"), (2, "dog"), (3, "fish")]
    store = build_index(corpus_of(docs), IndexStore(spark, str(tmp_path / "x")))
    assert store.read("corpus_stats").first().n_docs == 3
    assert store.read("term_stats").where("term = 'dog'").first().df == 2
    assert store.read("postings").where("term = 'cat' and doc_id = 1").count() == 1
    hits = SearchIndex(store).bm25(["dog", "cat"]).collect()
    assert sorted(r.doc_id for r in hits) == [1, 2] and sorted(r.rank for r in hits) == [1, 2]


def test_winner_without_headline_stays(spark, corpus_of, tmp_path):
    store = build_index(corpus_of(brute.DOCS), IndexStore(spark, str(tmp_path / "w")))
    w, ds = store.read("weights_bm25"), store.read("doc_stats")
    whole = search.bm25(w, ds, ["cat"], 3).orderBy("rank").collect()
    for eager in (False, True):
        less = search.bm25(w, ds.where(F.col("doc_id") != whole[0].doc_id), ["cat"], 3, eager=eager)
        rows = less.orderBy("rank").collect()
        assert [r.doc_id for r in rows] == [r.doc_id for r in whole] and rows[0].headline is None


def test_eager_hits_read_only_their_headlines(spark, corpus_of, tmp_path):
    store = build_index(corpus_of(brute.DOCS), IndexStore(spark, str(tmp_path / "e")),
                        BuildOptions(tables=("postings", "term_stats", "doc_stats", "corpus_stats",
                                             "weights_bm25")))
    eager = SearchIndex(store, eager=True).bm25(["cat"], k=2, digits=6)
    lazy = SearchIndex(store, eager=False).bm25(["cat"], k=2, digits=6)
    assert eager.orderBy("rank").collect() == lazy.orderBy("rank").collect()
    plan = eager._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(doc_id, [" in plan or "PushedFilters: [Or(" in plan


def test_late_deduplication_aggregates_copies_only(spark, corpus_of):
    c = corpus_of([(i, f"text {i}") for i in range(50)])
    both = c.unionByName(corpus_of([(3, "zz newer"), (4, "a lesser"), (4, "text 4")]))
    got, want = dedupe_docs_late(both), dedupe_docs(both)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert dedupe_docs_late(c.where("false")).count() == 0
    texts = [n for n, what in _outputs(got, "Aggregate") if "max(struct(" in what or "max(named" in what]
    assert texts and max(texts) <= 10  # five rows of two ids, partial and final, run twice


def _outputs(df, name):
    """(rows out, description) of the plan's nodes of a kind, after it ran."""
    plan = df._jdf.queryExecution().executedPlan()
    plan.executeCollect()
    found, stack = [], [plan]
    while stack:
        p = stack.pop()
        kind = p.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            stack.append(p.executedPlan())
        elif kind.endswith("QueryStageExec"):
            stack.append(p.plan())
        else:
            if name in kind and "inal" not in kind and p.metrics().contains("numOutputRows"):
                found.append((p.metrics().apply("numOutputRows").value(), p.simpleString(2000)))
            stack.extend(p.children().apply(i) for i in range(p.children().size()))
    return found


def test_a_build_shuffles_texts_once(spark, corpus_of, tmp_path):
    """Tokenizing passes over the stored corpus have no exchange."""
    from lodestar.sources.colocated import write_colocated

    c = write_colocated(spark, str(tmp_path / "u"), {"corpus": dedupe_docs(corpus_of(brute.DOCS))}, 3).read("corpus")
    for df in (index.term_frequency(c), index.bigram_postings(c), index.positions(c), index.doc_stats(c)):
        df.collect()
        assert "Exchange" not in plan_text(df)


def test_ranking_has_no_python_worker(spark, corpus_of):
    df = index.term_frequency(corpus_of(brute.DOCS))
    ranked = weights.impact_order(weights.tfidf_weights(df, index.term_stats(df), index.corpus_stats(
        index.doc_length(corpus_of(brute.DOCS)))))
    assert "Python" not in plan_text(ranked) and "InArrow" not in plan_text(ranked)
