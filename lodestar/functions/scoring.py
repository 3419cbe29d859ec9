"""Scoring formulas as Column arithmetic.

The operation order follows the reference formulas term by term, so doubles agree with it
to the last bit where the inputs agree.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# BM25 parameters of the reference.
K1 = 1.2
B = 0.75

# Corpus constants hard-coded in the reference (used by the golden tests
# and available as overrides; by default N and avgdl come from the data).
REFERENCE_N_DOCS = 1613582.0
REFERENCE_AVGDL = 226.791644


def idf(n_docs: Column, df: Column) -> Column:
    """ln(N / df); no smoothing."""
    return F.log(n_docs.cast("double") / df.cast("double"))


def bm25(idf_col: Column, tf: Column, length: Column, avgdl: Column,
         k1: float = K1, b: float = B) -> Column:
    """idf * ((k1 + 1) * tf) / (k1 * ((1 - b) + b * (len / avgdl)) + tf)."""
    tf = tf.cast("double")
    norm = F.lit(k1) * (F.lit(1.0 - b) + F.lit(b) * (length.cast("double") / avgdl)) + tf
    return idf_col * ((F.lit(k1 + 1.0) * tf) / norm)


def log_tf(tf: Column) -> Column:
    """1 + ln(tf)."""
    return F.lit(1.0) + F.log(tf.cast("double"))


def tfidf(idf_col: Column, tf: Column) -> Column:
    """(1 + ln tf) * idf, used for both document and query weights."""
    return log_tf(tf) * idf_col


def cosine(dot: Column, q_sq: Column, d_sq: Column) -> Column:
    """dot / (sqrt(sum q^2) * sqrt(sum d^2)); NULL when a norm is 0 (idf 0)."""
    return F.try_divide(dot, F.sqrt(q_sq) * F.sqrt(d_sq))
