"""Row number within a key, without putting a hot key into a single task.

``row_number() OVER (PARTITION BY key ORDER BY ...)`` sends every row of a key to one task, so
a term found in a third of all documents would be sorted by one core.  Here a rank is a
two-level prefix sum of plain DataFrame steps:

1. Keys with more rows than one partition's fair share are *hot*; there are at most as many
   as partitions (``skew.hot_keys``).  All other keys are numbered by the window as it is.
2. The rows of hot keys are range-partitioned on (key, order...), which cuts a hot key into
   several ranges, and written with the number of their range, so that a range stays what
   it is when an executor is lost and a stage runs again.
3. One window numbers the rows inside each (key, range).  A row's rank adds the rows of the
   key's earlier ranges: running sums over counts of (hot key, range), a table of at most
   two rows a partition, which is broadcast.

Shuffles: one of the rows of other keys, and two of the rows of hot keys.  Their tasks are cut by
the number of rows, so what one task sorts does not grow with the table.  ``rank_parts`` gives both
kinds of rows apart, each still lying by its key, so that lists of a key need no exchange more.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestar.operators.layout import row_tasks
from lodestar.operators.skew import hot_keys
from lodestar.session import scratch_path

_RANGE = "_lodestar_range"
_LOCAL = "_lodestar_local"
_OFFSET = "_lodestar_offset"
_COUNT = "_lodestar_count"


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back (cuts the lineage)."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)  # a third less than Spark's default
    return df.sparkSession.read.schema(df.schema).parquet(path)


def rank_within(df: DataFrame, key: str, order: Sequence[Column], rank_col: str = "rank",
                num_partitions: int | None = None, stored: bool = False,
                counts: DataFrame | None = None, placed: bool = False) -> DataFrame:
    """Add ``rank_col`` = 1-based row number of each row inside its ``key`` by ``order``.

    ``order`` must make rows of one key distinct (add a unique tie-breaker column), which
    keeps the result deterministic.  ``df`` is read several times: it is written to the scratch
    folder first, unless the caller says that it comes from a ``stored`` table, or from steps
    inside the rows of one, which cost less to repeat than to write.  ``counts (key, n)`` gives the
    rows of each key if they are known; a wrong count costs balance only.  Rows whose key is null
    count as one key, which is not split.  ``placed`` says that each key's rows lie in one task
    already and that no key is hot.
    """
    return together(rank_parts(df, key, order, rank_col, num_partitions, stored, counts, placed))


def together(parts: Sequence[DataFrame]) -> DataFrame:
    """The rows of all ``parts``."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def rank_parts(df: DataFrame, key: str, order: Sequence[Column], rank_col: str = "rank",
               num_partitions: int | None = None, stored: bool = False,
               counts: DataFrame | None = None, placed: bool = False, rows: int | None = None) -> list[DataFrame]:
    """``rank_within`` in one or two parts, which share no key: rows of other keys lie by ``key``,
    those of hot keys by their ranges.  ``rows`` are all rows, where ``counts`` leaves out small keys."""
    by_key = Window.partitionBy(key).orderBy(*order)
    if placed:
        return [df.withColumn(rank_col, F.row_number().over(by_key).cast("bigint"))]
    spark = df.sparkSession
    base = df if stored else staged(df, "rank-input")
    if num_partitions is None:
        known = rows if rows is not None or counts is None else counts.agg(F.sum("n")).first()[0]
        num_partitions = row_tasks(spark, base.count() if counts is None else known)
    p = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts = (base.groupBy(key).agg(F.count(F.lit(1)).alias(_COUNT)) if counts is None
              else counts.withColumnRenamed("n", _COUNT))
    hot = hot_keys(counts, key, _COUNT, p, rows).select(key).collect()  # at most p keys
    if not hot:
        base = base.repartition(p, key) if num_partitions else base
        return [base.withColumn(rank_col, F.row_number().over(by_key).cast("bigint"))]

    keys = F.broadcast(spark.createDataFrame(hot, base.select(key).schema))
    split = base.join(keys, key, "left_semi")
    split = split.repartitionByRange(p, key, *order) if num_partitions else split.repartitionByRange(key, *order)
    # Without an explicit count AQE may join neighbouring ranges; they stay ranges
    ranges = staged(split.withColumn(_RANGE, F.spark_partition_id()), "rank-ranges")
    rest = base.join(keys, key, "left_anti")
    rest = rest.repartition(p, key) if num_partitions else rest
    earlier = Window.partitionBy(key).orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.groupBy(key, _RANGE).agg(F.count(F.lit(1)).alias(_COUNT)).select(
        key, _RANGE, F.sum(_COUNT).over(earlier).alias(_OFFSET)).where(F.col(_OFFSET).isNotNull())
    local = (ranges.repartition(p, key, _RANGE) if num_partitions else ranges).withColumn(
        _LOCAL, F.row_number().over(Window.partitionBy(key, _RANGE).orderBy(*order)))
    ranked = local.join(F.broadcast(offsets), [key, _RANGE], "left").withColumn(
        rank_col, (F.coalesce(F.col(_OFFSET), F.lit(0)) + F.col(_LOCAL)).cast("bigint"))
    return [rest.select(*df.columns, F.row_number().over(by_key).cast("bigint").alias(rank_col)),
            ranked.select(*df.columns, rank_col)]
