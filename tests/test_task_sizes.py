"""Tasks that sort, rank or aggregate are cut by the size of their input."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestar.operators import index, layout
from lodestar.operators.rank import rank_within
from lodestar.plans import registry
from lodestar.plans.build import BuildOptions, build_index
from lodestar.sources.documents import from_documents
from lodestar.sources.store import IndexStore


def _documents(spark, n=40):
    words = F.concat_ws(" ", F.lit("Every one\n"), *[F.concat(F.lit(f"w{i}x"), F.col("id") % (i + 2))
                                                     for i in range(12)])
    return spark.range(n).select(F.col("id").alias("doc_id"), F.translate(words, "0123456789", "abcdefghij").alias("text"))


def _parts(spark):
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_bigram_statistics_in_given_tasks(spark):
    bp = index.bigram_postings(from_documents(_documents(spark)), per_row=True)
    cut = index.bigram_stats(bp, 3 * _parts(spark))
    assert sorted(cut.collect()) == sorted(index.bigram_stats(bp).collect())
    plan = cut._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Exchange hashpartitioning") == 1 and f", {3 * _parts(spark)})" in plan


def test_ranks_take_tasks_by_rows(spark, monkeypatch):
    df = spark.range(3000).select(F.when(F.col("id") < 1000, 0).otherwise(F.col("id") % 300).alias("k"), "id")
    want = sorted(rank_within(df, "k", [F.col("id").asc()], stored=True).collect())
    monkeypatch.setattr(layout, "TASK_ROWS", 3000 // (4 * _parts(spark)))
    many = rank_within(df, "k", [F.col("id").asc()], stored=True)
    assert sorted(many.collect()) == want
    assert many.rdd.getNumPartitions() >= 4 * _parts(spark)
    even = df.where("id >= 1000")  # without a hot key
    assert rank_within(even, "k", [F.col("id").asc()], stored=True).rdd.getNumPartitions() >= 2 * _parts(spark)


def test_ranks_keep_their_tasks_where_the_sessions_number_would_do(spark, monkeypatch):
    df = spark.range(3000).select((F.col("id") % 300).alias("k"), "id")
    want = sorted(rank_within(df, "k", [F.col("id").asc()], stored=True).collect())
    monkeypatch.setattr(layout, "TASK_ROWS", 1500)  # two tasks, fewer than the session has
    cut = rank_within(df, "k", [F.col("id").asc()], stored=True)
    assert sorted(cut.collect()) == want
    assert cut.rdd.getNumPartitions() == _parts(spark)  # AQE has merged none


def test_written_tables_take_tasks_by_text(spark, tmp_path, monkeypatch):
    docs = _documents(spark, 400)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    want = sorted(registry.q_index_roundtrip(spark, str(tmp_path)).collect())
    pairs = sorted(registry.q_index_bigram_view(spark, str(tmp_path)).collect())
    heads = sorted(registry.q_postings_with_headline_colocated(spark, str(tmp_path)).collect())
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0]
    monkeypatch.setattr(layout, "TASK_TEXT_BYTES", total // (3 * _parts(spark)))
    monkeypatch.setattr(layout, "TASK_ROWS", 50)
    many = registry.q_index_roundtrip(spark, str(tmp_path))
    assert sorted(many.collect()) == want and len(many.inputFiles()) > 2 * _parts(spark)
    assert sorted(registry.q_index_bigram_view(spark, str(tmp_path)).collect()) == pairs
    assert registry._together(spark, str(tmp_path), "postings").buckets >= 3 * _parts(spark)
    assert sorted(registry.q_postings_with_headline_colocated(spark, str(tmp_path)).collect()) == heads
    store = build_index(from_documents(docs), IndexStore(spark, str(tmp_path / "index")),
                        BuildOptions(tables=("bigram_grams",)))
    assert len(store.read("bigram_postings").inputFiles()) > 2 * _parts(spark)
    assert len(store.read("bigram_grams").inputFiles()) > 2 * _parts(spark)
