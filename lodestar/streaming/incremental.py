"""Incremental index build over corpus part files with Structured Streaming.

New part files of the corpus are picked up by a file stream; each micro-batch writes its
documents, their postings and their stats into folders ``run=<n>-<query>/epoch=<id>``.  The
query id lives in the stream's checkpoint: a replayed epoch (after a failure) overwrites
its own folder, and another checkpoint over the same store is another run that never
touches earlier ones.  Runs are numbered as they first appear.  Corpus-wide values (df, N,
avgdl) change with every part: each epoch writes its signed changes, less those of the document
versions it replaces (``operators.maintain``), and ``finish_index`` sums them and makes the weights
from the merged parts; the newest version of every document wins.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lodestar.operators import index, maintain
from lodestar.plans.build import BuildOptions, write_grams, write_weights
from lodestar.sources.documents import dedupe_docs_late, from_documents
from lodestar.sources.store import IndexStore, write_table

DOCUMENTS_SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
PART = ["run", "epoch"]


def run_name(spark: SparkSession, store: IndexStore, query_id: str) -> str:
    """``<number>-<query id>``: the run's own number, or the next one for a new query.

    Runs are kept in a table of one row a run, so no listing of parts is needed.
    """
    try:
        known = [r["run"] for r in spark.read.schema("run string").parquet(store.path("runs")).collect()]
    except AnalysisException:  # no run yet
        known = []
    mine = [r for r in known if r.endswith(query_id)]
    if mine:
        return mine[0]
    run = f"{max([int(r[:8]) for r in known], default=0) + 1:08d}-{query_id}"
    spark.createDataFrame([(run,)], "run string").coalesce(1).write.mode("append").parquet(store.path("runs"))
    return run


def _replaced(spark: SparkSession, store: IndexStore, ids: DataFrame, part: tuple[str, int]) -> DataFrame | None:
    """The corpus rows that a part's documents replace: their newest versions in earlier parts.

    Only the parts that hold such a version are read (a row a part reaches the driver).
    """
    try:
        before = spark.read.parquet(store.path("doc_stats_parts"))
    except AnalysisException:  # the first part
        return None
    earlier = F.struct("run", F.col("epoch").cast("bigint")) < F.struct(F.lit(part[0]), F.lit(part[1]).cast("bigint"))
    versions = before.where(earlier).join(ids, "doc_id", "left_semi").groupBy("doc_id").agg(
        F.max(F.struct(*PART)).alias("v")).select("doc_id", "v.run", "v.epoch")
    held = [tuple(r) for r in versions.select(*PART).distinct().collect()]
    if not held:
        return None
    folders = [os.path.join(store.path("corpus_parts"), f"run={r}", f"epoch={e}") for r, e in sorted(held)]
    rows = spark.read.option("basePath", store.path("corpus_parts")).parquet(*folders)
    return rows.join(versions, ["doc_id", *PART], "left_semi").drop(*PART)


def start_part_ingest(spark: SparkSession, source: str, store: IndexStore, checkpoint: str,
                      schema: str = DOCUMENTS_SCHEMA,
                      to_corpus: Callable[[DataFrame], DataFrame] = from_documents,
                      max_files_per_trigger: int | None = None,
                      available_now: bool = True) -> StreamingQuery:
    """Start indexing corpus part files under ``source`` (a folder or glob)."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    docs = reader.parquet(source)

    def write_epoch(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        run = run_name(spark, store, spark.sparkContext.getLocalProperty("sql.streaming.queryId"))
        part = f"run={run}/epoch={epoch_id}"
        unique = dedupe_docs_late(to_corpus(batch))  # copies inside one part collapse here
        folder = os.path.join(store.path("corpus_parts"), part)
        write_table(unique, folder, ("doc_id",))
        corpus = spark.read.schema(unique.schema).parquet(folder)
        old = _replaced(spark, store, corpus.select("doc_id"), (run, epoch_id))
        gone = None if old is None else old.select(*corpus.columns)
        write = lambda name, table, *keys: write_table(
            table, os.path.join(store.path(name), part), keys)
        read = lambda name: spark.read.parquet(os.path.join(store.path(name), part))
        # what was tokenized once is read back; the part's documents are in force once doc_stats_parts is there
        write("postings_parts", index.term_frequency(corpus, per_row=True), "term", "doc_id")
        write("term_changes", maintain.term_changes(
            read("postings_parts"), None if gone is None else index.term_frequency(gone, per_row=True)), "term")
        tokens = read("term_changes").agg(F.coalesce(F.sum("d_cf"), F.lit(0)).cast("bigint").alias("d_len"))
        docs = maintain.size_change(*[d and d.select("doc_id", F.lit(0).alias("len")) for d in (corpus, gone)])
        write("size_changes", docs.select("d_docs").crossJoin(F.broadcast(tokens)))
        write("doc_stats_parts", index.doc_stats(corpus), "doc_id")

    writer = (docs.writeStream.foreachBatch(write_epoch)
              .option("checkpointLocation", checkpoint)
              .queryName(f"lodestar_parts_{abs(hash(store.root)) % 10**8}"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def _newest(spark: SparkSession, store: IndexStore, name: str) -> DataFrame:
    """The rows of a part table that belong to the newest version of their document."""
    versions = spark.read.parquet(store.path("doc_stats_parts")).groupBy("doc_id").agg(
        F.max(F.struct(*PART)).alias("v")).select("doc_id", "v.run", "v.epoch")
    return spark.read.parquet(store.path(name)).join(versions, ["doc_id", *PART], "left_semi")


def merged_doc_stats(spark: SparkSession, store: IndexStore) -> DataFrame:
    """``(doc_id, len, headline)`` of the newest version of every document."""
    return _newest(spark, store, "doc_stats_parts").select("doc_id", "len", "headline")


def merged_postings(spark: SparkSession, store: IndexStore) -> DataFrame:
    """``(term, doc_id, tf, len)`` of the newest version of every document."""
    return _newest(spark, store, "postings_parts").select("term", "doc_id", "tf", "len")


def merged_corpus(spark: SparkSession, store: IndexStore) -> DataFrame:
    """The newest version of every document."""
    return _newest(spark, store, "corpus_parts").drop(*PART)


def maintained_term_stats(spark: SparkSession, store: IndexStore) -> DataFrame:
    """``(term, cf, df)`` as of the last part, from the parts' changes."""
    return maintain.term_stats(spark.read.parquet(store.path("term_changes")).drop(*PART))


def maintained_corpus_stats(spark: SparkSession, store: IndexStore) -> DataFrame:
    return maintain.corpus_stats(spark.read.parquet(store.path("size_changes")).drop(*PART))


def finish_index(spark: SparkSession, store: IndexStore,
                 options: BuildOptions = BuildOptions()) -> IndexStore:
    """Write the tables of ``options`` (all by default) from the ingested parts.

    Term and corpus statistics are the sums of the parts' changes, not an aggregate of all postings.
    """
    postings = store.write("postings", merged_postings(spark, store))
    ts = store.write("term_stats", maintained_term_stats(spark, store))
    store.write("doc_stats", merged_doc_stats(spark, store))
    cs = store.write("corpus_stats", maintained_corpus_stats(spark, store))
    write_weights(store, postings, ts, cs, options)
    if "term_grams" in options.tables:
        write_grams(store, ts, "term")
    if {"bigram_postings", "bigram_stats", "bigram_grams"} & set(options.tables):
        bp = store.write("bigram_postings", index.bigram_postings(merged_corpus(spark, store), per_row=True))
        bs = store.write("bigram_stats", index.bigram_stats(bp))
        if "bigram_grams" in options.tables:
            write_grams(store, bs, "bigram")
    if "positions" in options.tables:
        store.write("positions", index.positions(merged_corpus(spark, store)))
    return store
