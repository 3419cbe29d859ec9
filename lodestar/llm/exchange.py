"""Groups of documents that ask buckets of keys, and get answers back.

Documents are dealt into groups by a hash of their id.  A group sends, for each bucket of
the key space, one row of packed keys; a bucket sees the rows of all groups and answers
each group with one row.  Copies inside a group are merged before anything is sent, so a
key that a third of all documents hold costs its bucket one entry per group, never one per
document.  The texts are shuffled once: every step reads the same exchange by ``g``.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.llm.common import shuffle_partitions

GROUPS_PER_PARTITION = 4


@dataclass(frozen=True)
class Deal:
    """Numbers of groups and buckets, and labels that deal them evenly over the partitions.

    Spark places a key by its hash; a few hundred keys would meet in some partitions and miss
    others.  Each partition gets as many labels as the next.
    """

    groups: list[int]
    buckets: list[int]

    @classmethod
    def of(cls, spark: SparkSession) -> Deal:
        n = shuffle_partitions(spark)
        k = GROUPS_PER_PARTITION
        ids = spark.range(0, n * (20 + 10 * k), 1, 1).select(F.col("id").cast("int").alias("id"))
        found = ids.groupBy(F.pmod(F.hash("id"), F.lit(n)).alias("p")).agg(
            F.slice(F.array_sort(F.collect_list("id")), 1, k).alias("ids")).orderBy("p")
        rows = [r["ids"] for r in found.collect()]  # n rows
        return cls([row[i % len(row)] for i in range(k) for row in rows], [row[0] for row in rows])

    def group(self, number: F.Column) -> F.Column:
        return pick(self.groups, F.pmod(number, F.lit(len(self.groups))))

    def by_bucket(self, asks: DataFrame):
        return asks.withColumn("place", pick(self.buckets, F.col("bucket"))).groupBy("place")


def pick(labels: list[int], number: F.Column) -> F.Column:
    return F.get(F.expr(f"array({', '.join(map(str, labels))})"), number.cast("int"))


def grouped(docs: DataFrame, deal: Deal) -> DataFrame:
    """``(g, doc_id, text)``.  Other columns are left out."""
    doc_id = F.col("doc_id").cast("bigint")
    return docs.select(deal.group(F.xxhash64(doc_id)).alias("g"), doc_id.alias("doc_id"), "text")


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket by the high bits; ascending keys have ascending buckets."""
    return ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def bucket_slices(keys: np.ndarray, buckets: int):
    """``(bucket, from, to)`` over ascending keys, for the buckets that have any."""
    b = bucket_of(keys, buckets)
    cuts = [0, *(np.flatnonzero(np.diff(b)) + 1).tolist(), len(b)]
    return [(int(b[x]), x, y) for x, y in zip(cuts, cuts[1:]) if y > x]


def pack_bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def unpack_bits(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8), count=n).astype(bool)


def give_back() -> None:
    """Return freed memory to the system: a worker lives on between groups, and allocators keep
    what the largest one took."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc
    if trim:
        trim(0)


def on_table(func: Callable, **bound) -> Callable:
    """``func`` with settings bound, in the annotated form that ``applyInArrow`` asks for."""
    def run(table: pa.Table) -> pa.Table:
        try:
            return func(table, **bound)
        finally:
            give_back()
    run.__name__ = func.__name__.strip("_")  # as the plan shows it
    return run


def on_tables(func: Callable, **bound) -> Callable:
    """The same for cogrouped tables."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        try:
            return func(left, right, **bound)
        finally:
            give_back()
    run.__name__ = func.__name__.strip("_")
    return run


def on_batches(func: Callable) -> Callable:
    """``func`` over a task's batches, in the form that ``mapInArrow`` asks for."""
    def run(it):
        try:
            yield from func(it)
        finally:
            give_back()
    run.__name__ = func.__name__.strip("_")
    return run


def rows_table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def merge_counts(table: pa.Table, kind) -> list[tuple[int, int, bytes]]:
    """Which keys of each row count two or more over all rows of a bucket.

    Rows hold distinct packed ``keys`` and a bit in ``flags`` for those that count two already.
    """
    rows = table.select(["g", "bucket", "keys", "flags"]).to_pylist()
    parts = [np.frombuffer(r["keys"], kind) for r in rows]
    counts = np.concatenate([1 + unpack_bits(r["flags"], len(p)) for r, p in zip(rows, parts)])
    _, key = np.unique(np.concatenate(parts), return_inverse=True)
    total = np.bincount(key, weights=counts)
    out, at = [], 0
    for r, p in zip(rows, parts):
        repeated = total[key[at:at + len(p)]] >= 2
        at += len(p)
        if repeated.any():
            out.append((r["g"], r["bucket"], pack_bits(repeated)))
    return out
