"""News XML, one ``<newsitem>`` per record.

Files are read as text cut at the end tag, which Spark splits like any text file (its XML
source takes a file as one task); each piece from its start tag on is parsed by ``from_xml``.

Files may be in UTF-8 (US-ASCII included) or ISO-8859-1.  The caller names the encoding of the
scan, or passes ``PROLOG``: then every file is decoded by what its own XML prolog says, UTF-8
without one.  The prolog stands in a file's first piece only, so a first pass over the bytes
finds the files of another encoding; the pieces of all files are then joined with that list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.functions.markup import clean_markup
from lodestar.schemas import NEWS_XML

ROW_TAG = "newsitem"
ROOT_TAG = "newsitems"
END_TAG = "</newsitem>"
START_PATTERN = r"<newsitem[\s>]"
CORRUPT_COL = "_corrupt_record"
PROLOG = "prolog"  # in place of an encoding: as each file's prolog says
PROLOG_PATTERN = r"""^\s*<\?xml\s[^>]*?encoding\s*=\s*["']([A-Za-z0-9._-]+)["']"""
PROLOG_BYTES = 256  # of a file's first piece, where a prolog ends at the latest
BROADCAST_FILES = 10_000  # files not in UTF-8, up to which their list is broadcast
# Names of encodings, upper case
UTF8_NAMES = ("UTF-8", "UTF8", "US-ASCII", "ASCII")
LATIN1_NAMES = ("ISO-8859-1", "ISO8859-1", "ISO_8859-1", "LATIN1", "LATIN-1", "L1")
# The code classes whose codes become the three code lists.
CODE_CLASSES = {"countries": "countries", "industries": "industries", "topics": "topics"}


def _codes_of(klass: str) -> Column:
    matching = F.filter(F.col("metadata.codes"), lambda c: F.contains(c["_class"], F.lit(klass)))
    return F.coalesce(
        F.flatten(F.transform(matching, lambda c: F.transform(c["code"], lambda x: x["_code"]))),
        F.array().cast("array<string>"),
    )


def news_to_corpus(items: DataFrame) -> DataFrame:
    """Typed XML records -> corpus rows (text = paragraphs joined by a space)."""
    text = clean_markup(F.concat_ws(" ", F.col("text.p")))
    return items.select(
        F.col("_itemid").cast("bigint").alias("doc_id"),
        F.expr("try_cast(_date AS DATE)").alias("date"),
        F.col("title"),
        F.col("headline"),
        F.col("byline"),
        F.col("dateline"),
        text.alias("text"),
        *[_codes_of(k).alias(name) for name, k in CODE_CLASSES.items()],
    ).where(F.col("doc_id").isNotNull())


def _file_encodings(pieces: DataFrame) -> DataFrame:
    """``(file, encoding)`` of the files whose prolog names another encoding than UTF-8."""
    head = F.regexp_replace(F.substring("value", 1, PROLOG_BYTES), "^\ufeff", "")
    name = F.upper(F.regexp_extract(head, PROLOG_PATTERN, 1))
    first = pieces.where(F.instr(F.substring("value", 1, PROLOG_BYTES), "<?xml") > 0)
    return first.select("file", name.alias("encoding")).where(
        (F.col("encoding") != "") & ~F.col("encoding").isin(*UTF8_NAMES)).select(
        "file", F.when(F.col("encoding").isin(*LATIN1_NAMES), "ISO-8859-1")
        .otherwise(F.col("encoding")).alias("encoding")).groupBy("file").agg(F.min("encoding").alias("encoding"))


def _by_prolog(pieces: DataFrame, broadcast_files: int) -> DataFrame:
    """``value`` of each piece as its file's prolog says."""
    other = _file_encodings(pieces)
    listed = other.limit(broadcast_files + 1).collect()
    if not listed:
        return pieces.select("value")
    if len(listed) <= broadcast_files:
        other = F.broadcast(pieces.sparkSession.createDataFrame(listed, "file string, encoding string"))
    decoded = F.call_function("decode", F.col("value").cast("binary"), F.col("encoding"))
    return pieces.join(other, "file", "left").select(
        F.when(F.col("encoding").isNull(), F.col("value")).otherwise(decoded).alias("value"))


def _scan(spark: SparkSession, path: str | list[str], encoding: str,
          broadcast_files: int = BROADCAST_FILES) -> DataFrame:
    # PERMISSIVE: a malformed record becomes a row with nulls and its raw text in the
    # corrupt-record column, instead of failing the whole scan.
    schema = T.StructType([*NEWS_XML.fields, T.StructField(CORRUPT_COL, T.StringType(), True)])
    pieces = spark.read.text(path, lineSep=END_TAG)
    if encoding == PROLOG:
        pieces = _by_prolog(pieces.select("value", F.col("_metadata.file_path").alias("file")), broadcast_files)
    value = F.col("value") if encoding == PROLOG or encoding.upper() in UTF8_NAMES else F.decode(
        F.col("value").cast("binary"), encoding)
    start = F.regexp_instr(value, F.lit(START_PATTERN))
    record = F.concat(F.expr("substring(v, at)"), F.lit(END_TAG))
    options = {"rowTag": ROW_TAG, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COL,
               "ignoreSurroundingSpaces": "false"}
    return (pieces.select(value.alias("v"), start.alias("at")).where("at > 0")
            .select(F.from_xml(record, schema, options).alias("x")).select("x.*"))


def read_news_xml(spark: SparkSession, path: str | list[str], encoding: str = "UTF-8") -> DataFrame:
    """Scan news XML files into the corpus schema (explicit schema, no inference).

    Records without a parsable item id (including malformed ones) are left out; see
    ``news_xml_rejects`` for them.  With ``encoding=PROLOG`` files of several encodings may lie
    under ``path``; a prolog that names an encoding Spark cannot decode is an error.
    """
    return news_to_corpus(_scan(spark, path, encoding))


def news_xml_rejects(spark: SparkSession, path: str | list[str], encoding: str = "UTF-8") -> DataFrame:
    """``(item_id, raw)``: the records the XML parser could not read.

    ``item_id`` is whatever the parser still recovered (often null).
    """
    return _scan(spark, path, encoding).where(F.col(CORRUPT_COL).isNotNull()) \
        .select(F.col("_itemid").alias("item_id"), F.col(CORRUPT_COL).alias("raw"))


def corpus_to_news(corpus: DataFrame) -> DataFrame:
    """Corpus rows -> the XML record shape (paragraphs split at line breaks)."""
    def code_group(name: str) -> Column:
        return F.struct(
            F.lit(f"bip:{name}:1.0").alias("_class"),
            F.transform(F.coalesce(F.col(name), F.array().cast("array<string>")),
                        lambda x: F.struct(x.alias("_code"))).alias("code"),
        )

    return corpus.select(
        F.col("doc_id").alias("_itemid"),
        F.col("date").cast("string").alias("_date"),
        "title", "headline", "byline", "dateline",
        F.struct(F.split(F.col("text"), "\n", -1).alias("p")).alias("text"),
        F.struct(F.array(*[code_group(n) for n in CODE_CLASSES]).alias("codes")).alias("metadata"),
    )


def write_news_xml(corpus: DataFrame, path: str, encoding: str = "UTF-8") -> None:
    (corpus_to_news(corpus).write.mode("overwrite").format("xml")
     .option("rowTag", ROW_TAG).option("rootTag", ROOT_TAG).option("encoding", encoding)
     .option("declaration", f'version="1.0" encoding="{encoding}" standalone="yes"').save(path))
