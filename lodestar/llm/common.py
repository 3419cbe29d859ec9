"""Table access and scratch tables shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from lodestar.session import scratch_path

# Bytes that separate words: space and 0x09-0x0D.  Every operator that counts or compares
# words splits at these and nothing else.
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
WORD = "[^\\x20\\x09-\\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Where a public tokenizer's file lies; it is read there and never copied."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def stage(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back (cuts the lineage)."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def arrow_batches(spark: SparkSession, limit: int) -> Iterator[None]:
    """Jobs that run inside send their Python workers batches of ``limit`` bytes, about; the
    session's own setting comes back behind.

    A batch lies in the JVM's and in the worker's memory, outside the heap, and counts rows only
    unless told otherwise.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(limit))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
