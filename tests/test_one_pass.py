"""Postings that a plan reads several times are written once, and move once for weights, ranks and lists."""

from __future__ import annotations

import glob

import pytest
from pyspark.sql import functions as F

from lodestar.operators import index, layout, maintain, topk, weights
from lodestar.operators.rank import rank_parts, rank_within, together
from lodestar.plans import registry
from lodestar.plans.build import BuildOptions, build_index
from lodestar.sources import posting_text
from lodestar.sources.documents import from_documents
from lodestar.sources.store import IndexStore


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    """A folder with 60 documents: a word in all of them, others in some, and repeats."""
    root = tmp_path_factory.mktemp("one-pass")
    words = [F.concat(F.lit(f"w{chr(97 + i)}x"), F.translate((F.col("id") % (i + 2)).cast("string"), "0123456789",
                                                           "abcdefghij")) for i in range(8)]
    text = F.concat_ws(" ", F.lit("Every one of them\n"), *words, F.repeat(F.lit("often "), (F.col("id") % 4).cast("int")))
    spark.range(60).select(F.col("id").alias("doc_id"), text.alias("text")).write.parquet(str(root / "documents.parquet"))
    return str(root)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


@pytest.mark.parametrize("query", ["impact_order_bm25", "impact_order_tfidf", "impact_list_bm25", "impact_blocks_bm25",
                                   "weight_list_bm25", "weight_list_tfidf", "merge_weights", "merge_weights_common",
                                   "index_positional_list"])
def test_postings_are_made_once(spark, sf, query):
    assert "Generate" not in _plan(registry.QUERIES[query](spark, sf))


def _inputs(spark, sf):
    return registry._inputs(registry.unique_corpus(spark, sf))


@pytest.mark.parametrize("weights_of", [weights.bm25_weights, weights.tfidf_weights])
def test_weights_ranks_and_lists_move_postings_once(spark, sf, monkeypatch, weights_of):
    tf, stats, totals = _inputs(spark, sf)
    plain = weights_of(tf, stats, totals, stored=True)
    want = sorted(weights.impact_order(plain, stored=True).collect())
    total = tf.count()
    for rows, parts in ((total, 1), (total // 2, 1), (total // 40, 2)):  # one task, some, and frequent terms apart
        monkeypatch.setattr(layout, "TASK_ROWS", rows)
        found = weights.ranked_parts(weights_of, tf, stats, totals)
        assert len(found) == parts
        assert sorted(together(found).select(*plain.columns, "impact_rank").collect()) == want
    monkeypatch.setattr(layout, "TASK_ROWS", total // 2)
    ranked, = weights.ranked_parts(weights_of, tf, stats, totals)
    lists = ranked.groupBy("term", ((F.col("impact_rank") - 1) / 8).cast("bigint")).agg(F.collect_list("doc_id"))
    for df in (ranked, lists, topk.block_table(topk.impact_table(ranked), 8)):
        assert _plan(df).count("Exchange hashpartitioning(term") == 2  # the postings, and their terms' df


def test_rows_of_other_keys_move_once_beside_hot_ones(spark, monkeypatch):
    df = spark.range(3000).select(F.when(F.col("id") < 1000, 0).otherwise(F.col("id") % 300).alias("k"), "id")
    want = sorted(rank_within(df, "k", [F.col("id").asc()], stored=True).collect())
    monkeypatch.setattr(layout, "TASK_ROWS", 150)
    rest, hot = rank_parts(df, "k", [F.col("id").asc()], stored=True)
    assert sorted(rest.collect() + hot.collect()) == want
    assert {r.k for r in hot.collect()} == {0} and rest.where("k = 0").isEmpty()
    by_key = rest.groupBy("k", (F.col("rank") / 10).cast("int")).agg(F.collect_list("id"))
    assert _plan(by_key).count("Exchange hashpartitioning(k") == 1


def test_statistics_of_short_lists_are_not_written(spark, sf):
    c = registry.unique_corpus(spark, sf)
    p = index.postings(c, per_row=True)
    stats = index.term_stats(p)
    longer, n = index._list_stats(stats, 20)
    assert n == p.count()
    assert sorted(longer.collect()) == sorted(stats.where("df > 20").collect())
    want = {r.term: (r.cf, r.df) for r in stats.collect()}
    for size in (1, 20, 1024):
        got = {}
        for r in index.posting_list_view(p, stats, block_size=size).collect():
            assert r.cf == want[r.term][0] and r.doc_ids == sorted(r.doc_ids)
            got[r.term] = got.get(r.term, 0) + len(r.doc_ids)
        assert got == {t: df for t, (_, df) in want.items()}


def test_merged_weights_are_sorted_behind_the_exchange(spark, sf):
    tf, stats, totals = _inputs(spark, sf)
    w = weights.tfidf_weights(tf, stats, totals, stored=True)
    less = w.withColumn("weight", F.col("weight") / 2)
    merged = weights.merge_weights(less.where("doc_id < 40"), w.where("doc_id >= 20"), num_partitions=5)
    assert sorted(merged.collect()) == sorted(
        weights.merge_weights(less.where("doc_id < 40"), w.where("doc_id >= 20")).collect())
    plan = _plan(merged)
    assert "Sort" not in plan[plan.index("Exchange hashpartitioning(term"):] and ", 5)" in plan


def test_common_weights_read_stored_postings(spark, sf):
    c = registry.unique_corpus(spark, sf)
    parts = [c.where("doc_id < 40"), c.where("doc_id >= 20")]
    got = maintain.common_weights([(index.term_frequency(p, per_row=True), index.doc_length(p)) for p in parts])
    want = weights.both_weights(*_inputs(spark, sf), stored=True)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


@pytest.mark.parametrize("scheme", ["bm25", "tfidf"])
def test_a_single_scheme_is_ranked_from_its_postings(spark, sf, tmp_path, scheme):
    c = from_documents(spark.read.parquet(f"{sf}/documents.parquet"))
    one = build_index(c, IndexStore(spark, str(tmp_path / "one")),
                      BuildOptions(tables=("corpus_stats", "doc_stats", f"weights_{scheme}"), n_docs=50.0, avgdl=9.0))
    two = build_index(c, IndexStore(spark, str(tmp_path / "two")), BuildOptions(n_docs=50.0, avgdl=9.0))
    for t in (f"weights_{scheme}", f"impacts_{scheme}", f"blocks_{scheme}"):
        a, b = one.read(t), two.read(t)
        assert a.columns == b.columns and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    assert not glob.glob(str(tmp_path / "one" / "weights_unranked"))


def test_list_files_of_zstd(spark, sf, tmp_path):
    long = spark.range(3000).select(F.concat(F.lit("(w"), "id", F.lit(",[1, "), F.col("id") % 50, F.lit("])")).alias("value"))
    sizes = {}
    for kind in ("zstd", "gzip", "none"):
        path = str(tmp_path / kind)
        posting_text.write_lines(long.coalesce(1), path, kind)
        assert sorted(posting_text.read_lines(spark, path).collect()) == sorted(long.collect())
        sizes[kind] = sum(len(open(f, "rb").read()) for f in glob.glob(f"{path}/part-*"))
    assert sizes["zstd"] < sizes["gzip"] < sizes["none"]
    lists = registry.q_text_lists_unigram(spark, sf)
    assert lists.inputFiles() and all(f.endswith(".txt.zstd") for f in lists.inputFiles())
