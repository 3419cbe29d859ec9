"""Join a big table with one-row-per-key statistics when some keys are very hot.

A term that occurs in a third of all documents puts a third of all postings into the one
join partition that holds it.  Here every key is classified by its row count in the big
table (known exactly from the statistics):

* a key is *hot* when it holds more than one partition's fair share of rows,
  ``theta = ceil(total / P)``.  Counts sum to ``total``, so at most ``P`` keys are hot -
  the hot list is bounded by the partition count and is safe to broadcast;
* a hot key's rows get ``salt = pmod(xxhash64(spread), fanout)`` with
  ``fanout = ceil(count / theta)``, and its single statistics row is replicated once per
  salt value (at most ``2 * P`` extra rows in total);
* the join then runs on ``(key, salt)``: a hot key is spread over ``fanout`` partitions,
  every other key keeps ``salt = 0`` and behaves like a plain equi-join.

Nothing is dropped or sampled; the result equals the plain join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SALT = "_lodestar_salt"
FANOUT = "_lodestar_fanout"


def hot_keys(stats: DataFrame, key: str, count_col: str, partitions: int,
             rows: int | None = None) -> DataFrame:
    """``(key, fanout)`` of the keys holding more than ``total / partitions`` rows.

    The total is that of ``stats``, or ``rows`` where these leave out small keys.
    """
    total = stats.agg((F.sum(count_col) if rows is None else F.lit(rows)).alias("_total"))
    theta = F.greatest(F.lit(1), F.ceil(F.col("_total") / F.lit(partitions)))
    return (
        stats.select(key, count_col)
        .crossJoin(F.broadcast(total))  # one row
        .where(F.col(count_col) > theta)
        .select(key, F.ceil(F.col(count_col) / theta).cast("int").alias(FANOUT))
    )


FEW_KEYS = 200_000  # rows of (key, a few numbers): some 20 MB


def few_keys(stats: DataFrame) -> bool:
    """Whether ``stats`` (a stored table) has ``FEW_KEYS`` rows at most, so that it can be broadcast.

    The rows are counted, not estimated, so the large side of the join is not written for an
    exchange that turns out to be needless.
    """
    return stats.limit(FEW_KEYS + 1).count() <= FEW_KEYS


def broadcast_if_few(stats: DataFrame) -> DataFrame:
    return F.broadcast(stats) if few_keys(stats) else stats


def join_key_stats(big: DataFrame, stats: DataFrame, key: str, count_col: str) -> DataFrame:
    """``big JOIN stats USING (key)`` in which the rows of frequent keys don't move.

    ``stats`` is a stored table with one row per key and ``count_col`` = rows of ``big`` of that key.
    The ``FEW_KEYS`` most frequent keys are broadcast; they hold most rows.  The others hold few
    rows each, so these are joined by a plain exchange.  Then ``big`` is read twice; it should be
    a stored table or steps inside the rows of one.
    """
    if few_keys(stats):
        return big.join(F.broadcast(stats), key)
    # one row for each different count: at most sqrt(2 * rows of big)
    sizes = stats.groupBy(count_col).agg(F.count(F.lit(1)).alias("n"))
    above = Window.orderBy(F.col(count_col).desc())
    cut = sizes.withColumn("keys", F.sum("n").over(above)).where(F.col("keys") > FEW_KEYS).agg(
        F.max(count_col)).first()[0]
    frequent = F.broadcast(stats.where(F.col(count_col) > cut))
    rest = big.join(frequent.select(key), key, "left_anti").join(stats.where(F.col(count_col) <= cut), key)
    return big.join(frequent, key).unionByName(rest)


def placed_key_join(big: DataFrame, stats: DataFrame, key: str, partitions: int) -> DataFrame:
    """``big JOIN stats USING (key)``, whose rows lie in ``partitions`` tasks by their key.

    For rows that are to meet by ``key`` anyway and of which no key has more than a task's share.
    A task holds its keys' statistics, so nothing is sorted.
    """
    return big.repartition(partitions, key).join(stats.repartition(partitions, key).hint("shuffle_hash"), key)


def salted_key_join(big: DataFrame, stats: DataFrame, key: str, count_col: str,
                    spread_col: str = "doc_id", partitions: int | None = None) -> DataFrame:
    """``big JOIN stats USING (key)`` with hot keys spread over several partitions.

    ``stats`` has one row per key and ``count_col`` = number of ``big`` rows of that key.
    """
    p = partitions or int(big.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = F.broadcast(hot_keys(stats, key, count_col, p))  # <= p rows by construction
    salted = big.join(hot, key, "left").withColumn(
        SALT,
        F.when(F.col(FANOUT).isNull(), F.lit(0))
        .otherwise(F.pmod(F.xxhash64(F.col(spread_col)), F.col(FANOUT)).cast("int")),
    ).drop(FANOUT)
    replicated = stats.join(hot, key, "left").withColumn(
        SALT, F.explode(F.sequence(F.lit(0), F.coalesce(F.col(FANOUT), F.lit(1)) - 1))
    ).drop(FANOUT)
    return salted.join(replicated, [key, SALT]).drop(SALT)
