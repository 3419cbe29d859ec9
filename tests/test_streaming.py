"""Streaming part ingest: one epoch per part file, newest document version wins."""

import os

from lodestar.plans.build import SearchIndex
from lodestar.sources.store import IndexStore
from lodestar.streaming.incremental import finish_index, merged_postings, start_part_ingest

SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"


def test_parts_last_wins(spark, tmp_path):
    src = tmp_path / "parts"
    p1 = [(1, "old cat text", "en", "s", 12), (2, "dog and cat", "en", "s", 11)]
    p2 = [(1, "new dog text", "en", "s", 12), (3, "cat cat", "en", "s", 7), (3, "cat cat", "en", "s", 7)]
    spark.createDataFrame(p1, SCHEMA).coalesce(1).write.parquet(str(src / "part1"))
    spark.createDataFrame(p2, SCHEMA).coalesce(1).write.parquet(str(src / "part2"))
    store = IndexStore(spark, str(tmp_path / "index"))
    q = start_part_ingest(spark, str(src / "part*"), store, str(tmp_path / "ckpt"),
                          max_files_per_trigger=1)
    q.awaitTermination()
    runs = [r for r in os.listdir(store.path("postings_parts")) if r.startswith("run=")]
    assert len(runs) == 1
    epochs = os.listdir(os.path.join(store.path("postings_parts"), runs[0]))
    assert len([e for e in epochs if e.startswith("epoch=")]) == 2
    got = {(r.term, r.doc_id): r.tf for r in merged_postings(spark, store).collect()}
    assert got == {("new", 1): 1, ("dog", 1): 1, ("text", 1): 1,
                   ("dog", 2): 1, ("and", 2): 1, ("cat", 2): 1, ("cat", 3): 2}
    finish_index(spark, store)
    hits = SearchIndex(store).bm25(["cat"]).collect()
    assert {r.doc_id for r in hits} == {2, 3}

    # the same weights as a batch build over the final documents (last version, no copies)
    from lodestar import build_index, from_documents
    final = spark.createDataFrame([p2[0], p1[1], p2[1]], SCHEMA)
    batch = build_index(from_documents(final), IndexStore(spark, str(tmp_path / "batch")))
    cols = ["term", "doc_id", "tf", "idf", "weight", "impact_rank"]
    for t in ("weights_bm25", "weights_tfidf"):
        a, b = store.read(t).select(*cols), batch.read(t).select(*cols)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_another_checkpoint_adds_to_the_store(spark, tmp_path):
    """Two runs with checkpoints of their own: nothing is lost, the later version wins."""
    store = IndexStore(spark, str(tmp_path / "index"))
    for name, rows in (("a", [(1, "one cat", "en", "s", 7), (2, "two", "en", "s", 3)]),
                       ("b", [(2, "two dogs", "en", "s", 8), (3, "three", "en", "s", 5)])):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(str(tmp_path / name))
        start_part_ingest(spark, str(tmp_path / name), store, str(tmp_path / f"ckpt-{name}")).awaitTermination()
    got = {(r.term, r.doc_id) for r in merged_postings(spark, store).collect()}
    assert got == {("one", 1), ("cat", 1), ("two", 2), ("dogs", 2), ("three", 3)}
    finish_index(spark, store)
    from lodestar.plans.build import ALL_TABLES
    assert all(os.path.isdir(store.path(t)) for t in ALL_TABLES)
    assert {r.doc_id for r in SearchIndex(store).bigram_substring("two dogs").collect()} == {2}
    assert SearchIndex(store).proximity("two", "dogs").count() == 1


def test_statistics_are_kept_up(spark, tmp_path):
    """Replaced documents are taken out of df, cf, N and the total length; a replay changes nothing."""
    from lodestar import build_index, from_documents
    from lodestar.streaming import incremental

    parts = [[(1, "old cat cat", "en", "s", 0), (2, "dog", "en", "s", 0)], [(1, "new dog", "en", "s", 0), (3, "", "en", "s", 0)],
             [(1, "last", "en", "s", 0), (2, "dog dog", "en", "s", 0)]]
    store = IndexStore(spark, str(tmp_path / "index"))
    for i, rows in enumerate(parts):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(str(tmp_path / f"p{i}"))
        start_part_ingest(spark, str(tmp_path / f"p{i}"), store, str(tmp_path / f"ckpt-{i}")).awaitTermination()
    final = {r[0]: r for p in parts for r in p}
    batch = build_index(from_documents(spark.createDataFrame(list(final.values()), SCHEMA)),
                        IndexStore(spark, str(tmp_path / "batch")))

    def rows(df):
        return sorted(tuple(r) for r in df.collect())

    def check():
        assert rows(incremental.maintained_term_stats(spark, store)) == rows(batch.read("term_stats"))
        assert rows(incremental.maintained_corpus_stats(spark, store)) == rows(batch.read("corpus_stats"))

    check()
    # a part that is written again finds the versions before its own, not itself
    run = [r.run for r in spark.read.parquet(store.path("runs")).orderBy("run").collect()][-1]
    ids = spark.createDataFrame([(1,), (2,), (3,), (9,)], "doc_id bigint")
    old = incremental._replaced(spark, store, ids, (run, 0))
    assert {(r.doc_id, r.text) for r in old.collect()} == {(1, "new dog"), (2, "dog"), (3, "")}


def test_common_weights_equal_a_build_of_the_whole(spark, corpus_of):
    from lodestar.operators import index, maintain, weights

    parts = [[(1, "old cat cat"), (2, "dog the"), (4, "")], [(1, "new the dog"), (3, "cat the the")]]
    whole = corpus_of(list({d: (d, t) for p in parts for d, t in p}.values()))
    tf = index.term_frequency(whole)
    want = weights.both_weights(tf, index.term_stats(tf), index.corpus_stats(index.doc_length(whole)))
    made = [corpus_of(p) for p in parts]
    got = maintain.common_weights([(index.term_frequency(c), index.doc_length(c)) for c in made])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
