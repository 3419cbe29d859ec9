"""Mixing sources to target weights by a low-discrepancy schedule.

The size of a document is its number of words.  Sources in code point order (null last)
weigh 5, 2, 1 and so on; their targets share the whole corpus by weight, no target above
``max_epochs`` times its source's size, and the excess is shared again by weight.

* Schedule: slot ``i`` takes the point ``frac((i + 1) * golden ratio)`` through the cumulative
  shares of the sources, so any stretch of slots follows the weights within a few slots.
  Slots are ranked per source; the few that a source lacks at the end follow after the rest.
* Blocks: each source's documents are shuffled by a hash and cut into blocks of equal words.
  Slot rank ``r`` of a source takes block ``r`` of its documents, repeated up to
  ``max_epochs`` times; the last block ends exactly at the target.

Ranks and offsets come from sums per (source, chunk), so a source that holds a third of all
rows is laid out in parallel.  Only one row per source reaches the driver; sources are the
entries of a mixture and ``max_sources`` is checked before.

Cases: null text has size 0, as has text without words: such documents take nothing and come
back with ``taken`` 0; rows that repeat a ``doc_id`` are documents of their own (equal ones
are taken in any order); an empty table gives an empty result; other columns stay out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestar.llm.common import WORD, shuffle_partitions, stage

# between the spaces after a word and the next word
BEFORE_WORD = r"(?<=[\x20\x09-\x0D])(?=[^\x20\x09-\x0D])"
AROUND = r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$"

WEIGHTS = (5.0, 2.0, 1.0)
MAX_EPOCHS = 3
BLOCK = 1024
MAX_SOURCES = 1_000_000
GOLDEN = (5 ** 0.5 - 1) / 2
SLOTS_PER_TASK = 1 << 16


def n_words(text: str = "text") -> F.Column:
    """Number of words; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(sizes: np.ndarray, weights: np.ndarray, max_epochs: int) -> np.ndarray:
    """Shares of the whole by weight, none above ``max_epochs`` times its size."""
    cap = max_epochs * sizes.astype(np.float64)
    out, free = np.zeros(len(sizes)), np.ones(len(sizes), bool)
    rest = float(sizes.sum())
    while free.any():
        share = rest * weights / weights[free].sum()
        over = free & (share > cap)
        if not over.any():
            out[free] = share[free]
            break
        out[over] = cap[over]
        rest -= float(cap[over].sum())
        free &= ~over
    return out


def _sources(sized: DataFrame, weights, max_epochs: int):
    rows = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    if rows.count() > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources are no mixture")
    found = sorted(((r[0] is None, (r[0] or "").encode()), r[0], int(r[1])) for r in rows.collect())
    size = np.array([x[2] for x in found], np.int64)
    weight = np.array([weights[i % len(weights)] for i in range(len(found))])
    return [x[1] for x in found], size, targets(size, weight, max_epochs)


def _schedule(spark, take: np.ndarray, block: int) -> DataFrame:
    """``(slot, number, rank)``: the source (by number) and its slot rank, for every slot."""
    need = -(-take // block)  # blocks a source has to give
    total = int(need.sum())
    edges = np.cumsum(take) / max(1, take.sum())
    chunks = max(1, -(-total // SLOTS_PER_TASK))
    shared = spark.sparkContext.broadcast((edges, need))

    def points(chunk: int) -> np.ndarray:
        i = np.arange(chunk * SLOTS_PER_TASK, min((chunk + 1) * SLOTS_PER_TASK, total))
        at = np.searchsorted(shared.value[0], (i + 1) * GOLDEN % 1.0, side="right")
        return np.minimum(at, len(need) - 1)

    def count(it):
        for batch in it:
            for c in batch.column("id").to_pylist():
                got = np.bincount(points(c), minlength=len(need))
                number = np.flatnonzero(got)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([c] * len(number), pa.int64()), pa.array(number), pa.array(got[number])],
                    ["chunk", "number", "slots"])

    ids = spark.range(0, chunks, 1, chunks)
    per_chunk = stage(ids.mapInArrow(count, "chunk bigint, number bigint, slots bigint"), "mixing-slots")
    before = F.sum("slots").over(Window.partitionBy("number").orderBy("chunk")) - F.col("slots")
    firsts = per_chunk.withColumn("before", before).groupBy("chunk").agg(
        F.collect_list(F.struct("number", "before")).alias("firsts"))

    def slots(it):
        for batch in it:
            for r in batch.to_pylist():
                at = points(r["chunk"])
                first = np.zeros(len(need), np.int64)
                for x in r["firsts"]:
                    first[x["number"]] = x["before"]
                order = np.argsort(at, kind="stable")
                n = at[order]
                start = np.maximum.accumulate(
                    np.where(np.append(True, n[1:] != n[:-1]), np.arange(len(n)), 0))
                rank = np.empty(len(n), np.int64)
                rank[order] = first[n] + np.arange(len(n)) - start
                keep = rank < shared.value[1][at]
                slot = np.arange(len(at)) + r["chunk"] * SLOTS_PER_TASK
                yield pa.RecordBatch.from_arrays(
                    [pa.array(slot[keep]), pa.array(at[keep]), pa.array(rank[keep])],
                    ["slot", "number", "rank"])

    main = firsts.mapInArrow(slots, "slot bigint, number bigint, rank bigint")
    # what a source lacks: discrepancy is a few slots a source
    have = {r[0]: r[1] for r in per_chunk.groupBy("number").agg(F.sum("slots")).collect()}
    missing = [(n, have.get(n, 0), int(x)) for n, x in enumerate(need.tolist()) if have.get(n, 0) < x]
    if not missing:
        return main
    tail = spark.createDataFrame(missing, "number bigint, have bigint, need bigint").select(
        "number", F.explode(F.expr("sequence(have, need - 1)")).alias("rank"))
    return main.unionByName(tail.select((F.lit(total) + F.col("rank")).alias("slot"), "number", "rank"))


def mix(docs: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS,
        block: int = BLOCK, row_key: F.Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Documents ``(row_key, doc_id, source, size, source_size, target)`` and the mixture
    ``(slot, row_key, epoch, start, length)``: the words each slot takes from a document.

    ``row_key`` names a row of ``docs``; without one the rows are numbered.
    """
    spark = docs.sparkSession
    key = F.struct(F.xxhash64(F.col("doc_id").cast("bigint"), F.lit(10)).alias("h"), F.col("doc_id"),
                   F.xxhash64("text").alias("t"))
    sized = stage(docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "source", n_words().alias("size"),
        key.alias("shuffle_key"),
        (F.monotonically_increasing_id() if row_key is None else row_key).alias("row_key")), "mixing-sizes")
    names, size, target = _sources(sized, weights, max_epochs)
    take = np.minimum(np.floor(target + 0.5).astype(np.int64), max_epochs * size)
    table = spark.createDataFrame(
        [(i, n, int(s), float(t), int(k)) for i, (n, s, t, k) in enumerate(zip(names, size, target, take))],
        "number bigint, source string, source_size bigint, target double, take bigint")
    known = sized.join(F.broadcast(table.withColumnRenamed("source", "name")),
                       F.col("source").eqNullSafe(F.col("name"))).drop("name")

    # offsets of the shuffled documents within their source, by chunks of the shuffle hash
    n = shuffle_partitions(spark)
    chunked = known.where("size > 0").withColumn(
        "chunk", F.expr(f"shiftright(shuffle_key.h, 32) + {1 << 31}") * n / (1 << 32)).withColumn(
        "chunk", F.col("chunk").cast("int"))
    sums = chunked.groupBy("number", "chunk").agg(F.sum("size").alias("words"))
    starts = sums.select("number", "chunk", (F.sum("words").over(
        Window.partitionBy("number").orderBy("chunk")) - F.col("words")).alias("before"))
    own = F.sum("size").over(Window.partitionBy("number", "chunk").orderBy("shuffle_key", "row_key")
                             .rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    placed = chunked.withColumn("own", own).join(starts, ["number", "chunk"]).withColumn(
        "at", F.col("before") + F.col("own"))

    # pieces of documents by block of the repeated line of the source
    epochs = placed.select(
        "number", "row_key", "size", "take",
        F.explode(F.sequence(F.lit(0), F.lit(max_epochs - 1))).alias("epoch"),
        F.col("at"), "source_size").withColumn(
        "lo", F.col("epoch") * F.col("source_size") + F.col("at")).where("lo < take").withColumn(
        "hi", F.least(F.col("lo") + F.col("size"), F.col("take")))
    cut = epochs.withColumn("rank", F.explode(F.expr(f"sequence(lo div {block}, (hi - 1) div {block})")))
    begin = F.greatest(F.col("lo"), F.col("rank") * block)
    pieces = cut.select(
        "number", "rank", "row_key", "epoch", (begin - F.col("lo")).alias("start"),
        (F.least(F.col("hi"), (F.col("rank") + 1) * block) - begin).alias("length"))
    mixture = _schedule(spark, take, block).join(pieces, ["number", "rank"]).select(
        "slot", "row_key", "epoch", "start", "length")
    return known.select("row_key", "doc_id", "source", "size", "source_size", "target"), mixture


def taken_words(documents: DataFrame, mixture: DataFrame) -> DataFrame:
    """``documents`` with ``taken``: the words the mixture takes of each, repeats counted."""
    taken = mixture.groupBy("row_key").agg(F.sum("length").alias("taken"))
    return documents.join(taken, "row_key", "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken"))


def mixed_documents(docs: DataFrame, **settings) -> DataFrame:
    """``docs`` as the mixture has them: one row for each epoch a document is taken in.

    A document that is taken in part (the last of a source's target) comes with its first
    words only, with the spaces and line ends between them; documents that are not taken go.
    """
    # rows are numbered once, in a written table, so that no two share a name
    keyed = stage(docs.select(F.monotonically_increasing_id().alias("_key"), F.struct("*").alias("_row")),
                  "mixing-rows")
    documents, mixture = mix(keyed.select("_row.doc_id", "_row.source", "_row.text", "_key"),
                             row_key=F.col("_key"), **settings)
    taken = mixture.groupBy("row_key", "epoch").agg(F.sum("length").alias("_take"))
    rows = keyed.join(taken.join(documents.select("row_key", "size"), "row_key").withColumnRenamed(
        "row_key", "_key"), "_key")
    pieces = F.split(F.regexp_replace("_row.text", AROUND, ""), BEFORE_WORD)  # a word and what follows it
    begin = F.regexp_replace(F.array_join(F.slice(pieces, F.lit(1), F.col("_take").cast("int")), ""), AROUND, "")
    cut = rows.where("_take > 0").withColumn("_text", F.when(
        F.col("_take") >= F.col("size"), F.col("_row.text")).otherwise(begin))
    columns = []
    for c in docs.columns:
        value = F.col(f"_row.`{c}`")
        if c == "text":
            value = F.col("_text")
        elif c == "n_chars":
            value = F.when(F.col("_take") >= F.col("size"), value).otherwise(
                F.length("_text")).cast(docs.schema[c].dataType)
        columns.append(value.alias(c))
    return cut.select(*columns)
