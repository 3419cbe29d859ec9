"""Importance resampling towards a target corpus, on hashed n-grams.

1. Texts are brought to words parted by single spaces, and a regular expression with
   overlapped matches and boundary lookarounds yields every run of ``low`` to ``high`` words as
   a span, whose CRC-32 names its bucket.  A document's buckets are written once, packed.
2. Bucket counts of the raw and of the target corpus: every task sums its documents first
   and sends at most one row a bucket.  The gain of a bucket is the logarithm of its smoothed
   share in the target over that in the raw corpus; the table is as long as there are buckets.
3. A document's weight is the sum of the gains of its features.  With a Gumbel draw from a hash
   of the id on top, the highest scores are a sample without replacement.
4. The documents are ranked by score over all tasks (``operators.rank``: ranges of scores, and
   the rows of earlier ranges), and a share of those long enough is drawn.

Cases: null text has no words (no features, weight 0); a null ``doc_id`` draws like an empty id
and comes last among equal scores; rows that repeat a ``doc_id`` are scored and drawn row by
row; a very long text is matched lazily, two or four bytes a feature; without a target, or
without documents, counts are 0; other columns are ignored.
"""

from __future__ import annotations

import zlib
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.llm.common import stage
from lodestar.llm.fim import draws, groups
from lodestar.operators.rank import rank_within

BUCKETS = 10_000
MIN_WORDS = 20
PERCENT = 10
SEED = 2024

# Bytes of words are digits, small letters and all beyond ASCII; others part words.
_LETTERS = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20
    for c in range(256))


def collapse(text: bytes) -> bytes:
    """Words in lower case (A-Z only), parted, begun and ended by one space."""
    words = text.translate(_LETTERS).split(None)
    return b" " + b" ".join(words) + b" " if words else b""


def gram_pattern(n: int):
    """All runs of ``n`` words of a collapsed text; searched with overlapped matches.

    A match may start right behind a space only and must end right before one, so at every
    word there is exactly one.
    """
    import regex

    return regex.compile(rb"(?<= )[^ ]++" + rb"(?: [^ ]++)" * (n - 1) + rb"(?= )")


def _kind(buckets: int) -> np.dtype:
    return np.dtype("<u2" if buckets <= 1 << 16 else "<u4")


def features(docs: DataFrame, id_column: str = "doc_id", low: int = 1, high: int = 1,
             buckets: int = BUCKETS) -> DataFrame:
    """``(doc_id, n_words, n_features, buckets)``: the buckets of all n-grams, packed."""
    if not 1 <= low <= high:
        raise ValueError("low must be at least 1 and not above high")
    kind = _kind(buckets)

    def run(batches):
        patterns = [gram_pattern(n) for n in range(low, high + 1)]
        span = itemgetter(0)  # the bytes of a match's span
        for batch in batches:
            for part in groups(batch, "text"):
                words, packed = [], []
                for text in part.column("text"):
                    clean = collapse(text.as_py()) if text.is_valid else b""
                    words.append(max(0, clean.count(b" ") - 1))
                    packed.append(b"".join(
                        (np.fromiter(map(zlib.crc32, map(span, p.finditer(clean, overlapped=True))), np.uint32)
                         % buckets).astype(kind).tobytes() for p in patterns))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(words, pa.int64()),
                     pa.array([len(x) // kind.itemsize for x in packed], pa.int64()),
                     pa.array(packed, pa.binary())],
                    ["doc_id", "n_words", "n_features", "buckets"])

    rows = docs.select(F.col(id_column).cast("bigint").alias("doc_id"),
                       F.encode(F.col("text").cast("string"), "UTF-8").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, n_words bigint, n_features bigint, buckets binary")


def bucket_counts(found: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``(bucket, count)`` over all features; a task sends at most a row a bucket."""
    kind = _kind(buckets)

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in groups(batch, "buckets"):
                for x in part.column("buckets"):
                    total += np.bincount(np.frombuffer(x.as_buffer(), kind), minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used])], ["bucket", "count"])

    return found.select("buckets").mapInArrow(run, "bucket bigint, count bigint").groupBy("bucket").agg(
        F.sum("count").alias("count"))


def gains(spark: SparkSession, target: DataFrame, raw: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Gain of every bucket, in thousandths: of smoothed shares in target and raw counts."""
    total = lambda df, name: F.broadcast(df.agg(  # noqa: E731  (one row)
        F.coalesce(F.sum("count"), F.lit(0)).cast("double").alias(name)))
    rows = (spark.range(buckets).withColumnRenamed("id", "bucket")
            .join(target.select("bucket", F.col("count").alias("t")), "bucket", "left")
            .join(raw.select("bucket", F.col("count").alias("s")), "bucket", "left")
            .crossJoin(total(target, "all_t")).crossJoin(total(raw, "all_s")))
    up = (F.coalesce("t", F.lit(0)) + 1).cast("double") * (F.col("all_s") + float(buckets))
    down = (F.coalesce("s", F.lit(0)) + 1).cast("double") * (F.col("all_t") + float(buckets))
    gain = F.floor(F.lit(1000.0) * F.log(up / down))
    out = np.zeros(buckets, np.int64)
    for r in rows.select("bucket", gain.alias("gain")).collect():  # a row a bucket
        out[r["bucket"]] = r["gain"]
    return out


def weigh(found: DataFrame, gain: np.ndarray) -> DataFrame:
    """``(doc_id, n_words, n_features, weight)``: sums of the gains of all features."""
    kind = _kind(len(gain))

    def run(batches):
        for batch in batches:
            for part in groups(batch, "buckets"):
                weight = [int(gain[np.frombuffer(x.as_buffer(), kind)].sum()) for x in part.column("buckets")]
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in ("doc_id", "n_words", "n_features")] + [pa.array(weight, pa.int64())],
                    ["doc_id", "n_words", "n_features", "weight"])

    return found.mapInArrow(run, "doc_id bigint, n_words bigint, n_features bigint, weight bigint")


def resample(docs: DataFrame, target: DataFrame, target_id: str = "doc_id", low: int = 1, high: int = 1,
             buckets: int = BUCKETS, min_words: int = MIN_WORDS, percent: int = PERCENT,
             seed: int = SEED) -> DataFrame:
    """``(doc_id, n_words, n_features, weight, score, rank)``, a row per document.

    ``rank`` counts the drawn documents from 1, highest score first, and is null for others.
    ``percent`` of the documents with at least ``min_words`` words are drawn.
    """
    spark = docs.sparkSession
    found = stage(features(docs, "doc_id", low, high, buckets), "importance-features")
    aimed = features(target, target_id, low, high, buckets)
    gain = gains(spark, bucket_counts(aimed, buckets), bucket_counts(found, buckets), buckets)
    lot = (draws(F.col("doc_id"), seed, 1)[0] + F.lit(0.5)) / F.lit(4294967296.0)
    score = F.col("weight") + F.floor(F.lit(-1000.0) * F.log(-F.log(lot)))
    scored = stage(weigh(found, gain).withColumn("score", score).withColumn(
        "short", F.col("n_words") < min_words).withColumn("all", F.lit(0)), "importance-scores")
    order = [F.col("short").asc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last(),
             F.col("n_features").asc(), F.col("weight").asc()]  # beyond these, rows are alike
    ranked = rank_within(scored, "all", order, rank_col="place", stored=True)
    drawn = F.broadcast(scored.agg(  # one row
        F.floor(F.count_if(~F.col("short")) * F.lit(percent) / F.lit(100)).alias("drawn")))
    return ranked.crossJoin(drawn).select(
        "doc_id", "n_words", "n_features", "weight", "score",
        F.when(~F.col("short") & (F.col("place") <= F.col("drawn")), F.col("place")).alias("rank"))
