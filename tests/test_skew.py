"""A term in every document: the postings x term-stats join spreads the hot term."""

import pytest

import brute
from lodestar.operators import index, weights

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.0",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def skew_conf(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_hot_term_join_is_split(spark, corpus_of, skew_conf):
    # "hot" is in every document and holds most postings; the rest are rare words
    docs = [(i, "hot " * (1 + i % 3) + f"rare{i} other{i % 7}") for i in range(400)]
    c = corpus_of(docs)
    tf = index.term_frequency(c)
    w = weights.bm25_weights(tf, index.term_stats(tf), index.corpus_stats_from_postings(c, tf))
    rows = w.collect()
    plan = w._jdf.queryExecution().executedPlan().toString()
    # the hot term is salted: the join runs on (term, salt) and "hot" spans several keys
    assert "_lodestar_salt" in plan
    want = brute.bm25_weights(docs)
    got = {(r.term, r.doc_id): r.weight for r in rows}
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k], abs=1e-12) for k in want)


def test_salted_join_equals_plain_join(spark):
    from pyspark.sql import functions as F

    from lodestar.operators.skew import hot_keys, salted_key_join
    big = spark.range(0, 3000).select(
        F.when(F.col("id") % 10 < 7, F.lit("hot")).otherwise((F.col("id") % 50).cast("string")).alias("term"),
        F.col("id").alias("doc_id"))
    stats = big.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.lit(1).alias("x"))
    hot = {r.term: r._lodestar_fanout for r in hot_keys(stats, "term", "df", 8).collect()}
    assert set(hot) == {"hot"} and hot["hot"] >= 5
    got = salted_key_join(big, stats, "term", "df", partitions=8)
    want = big.join(stats, "term")
    assert got.count() == 3000
    assert got.select(*want.columns).exceptAll(want).count() == 0


def test_frequent_keys_are_broadcast_and_the_rest_joined(spark, monkeypatch, tmp_path):
    from pyspark.sql import functions as F

    from lodestar.operators import skew
    big = spark.range(0, 2000).select(
        F.when(F.col("id") % 10 < 7, F.lit("hot")).otherwise((F.col("id") % 50).cast("string")).alias("term"),
        F.col("id").alias("doc_id"))
    big.groupBy("term").agg(F.count(F.lit(1)).alias("df")).write.parquet(str(tmp_path / "s"))
    stats = spark.read.parquet(str(tmp_path / "s"))
    want = big.join(stats, "term")
    for few in (1000, 5, 1, 0):
        monkeypatch.setattr(skew, "FEW_KEYS", few)
        got = skew.join_key_stats(big, stats, "term", "df")
        assert got.count() == 2000
        assert got.select(*want.columns).exceptAll(want).count() == 0
