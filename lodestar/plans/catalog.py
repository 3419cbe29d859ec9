"""Driver tables as DataFrames (explicit paths, Parquet, no inference)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from lodestar.sources.documents import dedupe_docs_late, from_documents

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The news corpus view of the ``documents`` table."""
    return from_documents(table(spark, sf_dir, "documents"))


def unique_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus as an index takes it: one row per document."""
    return dedupe_docs_late(corpus(spark, sf_dir))
