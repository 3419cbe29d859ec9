"""Column layout shared by the tokenizing operators."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TEXT_COLUMNS = ("doc_id", "title", "byline", "text")
TASK_TEXT_BYTES = 16 << 20  # text whose postings one task sorts: some 100 MB of rows
TASK_ROWS = 1 << 20  # rows of a key and a few numbers


def more_tasks(spark: SparkSession, n: float) -> int | None:
    """``n`` tasks if that is more than the session's shuffle partitions, else None (these do).

    Tasks that sort or aggregate are cut by the size of their input, so that their memory does
    not grow with it.
    """
    n = math.ceil(n)
    return n if n > int(spark.conf.get("spark.sql.shuffle.partitions")) else None


def text_tasks(corpus: DataFrame) -> int | None:
    """``more_tasks`` for the postings of a corpus, by the bytes of its text (not tokenized)."""
    size = F.octet_length(F.concat_ws(" ", *[c for c in TEXT_COLUMNS[1:] if c in corpus.columns]))
    total = corpus.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    return more_tasks(corpus.sparkSession, total / TASK_TEXT_BYTES)


def row_tasks(spark: SparkSession, rows: int | None) -> int | None:
    """Tasks for so many rows of a key and a few numbers, the session's shuffle partitions at least;
    None (Spark's choice) where one task will do.

    Their number is given even where the session's would do: without one, AQE merges partitions
    up to a size in compressed bytes, which are ten times that when sorted.
    """
    n = math.ceil((rows or 0) / TASK_ROWS)
    return max(n, int(spark.conf.get("spark.sql.shuffle.partitions"))) if n > 1 else None


def text_input(corpus: DataFrame, *extra: str) -> DataFrame:
    """The columns a tokenizer reads (plus ``extra``).

    Every tokenizing branch of one plan projects the same way, so over a de-duplicated
    corpus they share its one exchange of the text.
    """
    return corpus.select(*[c for c in (*TEXT_COLUMNS, *extra) if c in corpus.columns])
