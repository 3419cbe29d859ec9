"""Explicit schemas of the corpus and the index tables (no inference anywhere)."""

from pyspark.sql import types as T

CODES = T.ArrayType(T.StringType())

CORPUS = T.StructType([
    T.StructField("doc_id", T.LongType(), False),
    T.StructField("date", T.DateType(), True),
    T.StructField("title", T.StringType(), True),
    T.StructField("headline", T.StringType(), True),
    T.StructField("byline", T.StringType(), True),
    T.StructField("dateline", T.StringType(), True),
    T.StructField("text", T.StringType(), True),
    T.StructField("countries", CODES, True),
    T.StructField("industries", CODES, True),
    T.StructField("topics", CODES, True),
])

# News XML record (rowTag=newsitem); attributes carry the "_" prefix.
NEWS_XML = T.StructType([
    T.StructField("_itemid", T.LongType(), True),
    T.StructField("_date", T.StringType(), True),
    T.StructField("title", T.StringType(), True),
    T.StructField("headline", T.StringType(), True),
    T.StructField("byline", T.StringType(), True),
    T.StructField("dateline", T.StringType(), True),
    T.StructField("text", T.StructType([T.StructField("p", T.ArrayType(T.StringType()), True)]), True),
    T.StructField("metadata", T.StructType([
        T.StructField("codes", T.ArrayType(T.StructType([
            T.StructField("_class", T.StringType(), True),
            T.StructField("code", T.ArrayType(T.StructType([
                T.StructField("_code", T.StringType(), True),
            ])), True),
        ])), True),
    ]), True),
])
