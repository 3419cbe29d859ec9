"""Formula goldens from the reference's sample output (N, avgdl hard-coded there)."""

import math

import pytest
from pyspark.sql import functions as F

from lodestar.functions import scoring

N, AVGDL = scoring.REFERENCE_N_DOCS, scoring.REFERENCE_AVGDL

GOLDENS = [
    # tf, df, len, idf, weight
    (1, 1, 113, 14.293967110378958, 17.98570241495611),
    (6, 366, 132, 8.391333776977591, 16.2321782572662),
    (5, 366, 135, 8.391333776977591, 15.817148480483835),
]


@pytest.mark.parametrize("tf,df,length,idf,weight", GOLDENS)
def test_bm25_goldens(spark, tf, df, length, idf, weight):
    row = spark.createDataFrame([(tf, df, length)], "tf BIGINT, df BIGINT, len BIGINT").select(
        scoring.idf(F.lit(N), F.col("df")).alias("idf"),
    ).first()
    assert row.idf == pytest.approx(idf, rel=0, abs=4 * math.ulp(idf))
    w = spark.createDataFrame([(tf, length, idf)], "tf BIGINT, len BIGINT, idf DOUBLE").select(
        scoring.bm25(F.col("idf"), F.col("tf"), F.col("len"), F.lit(AVGDL)).alias("w")
    ).first().w
    assert w == pytest.approx(weight, rel=0, abs=2 * math.ulp(weight))


def test_tfidf_and_cosine(spark):
    r = spark.createDataFrame([(3, 2.0)], "tf BIGINT, idf DOUBLE").select(
        scoring.tfidf(F.col("idf"), F.col("tf")).alias("w"),
        scoring.cosine(F.lit(2.0), F.lit(1.0), F.lit(4.0)).alias("c"),
        scoring.cosine(F.lit(0.0), F.lit(0.0), F.lit(4.0)).alias("z"),
    ).first()
    assert r.w == pytest.approx((1 + math.log(3)) * 2.0)
    assert r.c == pytest.approx(1.0)
    assert r.z is None
