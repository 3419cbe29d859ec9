"""Result sink: the k hits of a ranked search as one small file."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.functions.markup import clean_headline, format_hit


def hit_lines(hits: DataFrame, sep: str = ":") -> DataFrame:
    """``(rank, line)`` with line = ``(score,id<sep>headline)``, ranks ascending."""
    line = F.concat(F.lit("("), F.col("score").cast("string"), F.lit(","),
                    format_hit(F.col("doc_id"), clean_headline(F.col("headline")), sep), F.lit(")"))
    return hits.select("rank", line.alias("line"))


def write_hits(hits: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write hits into a single file (``coalesce(1)``: k rows, bounded by the search).

    ``fmt="text"`` writes one ``(score,id:headline)`` line per hit in rank order.
    """
    if fmt == "text":
        hit_lines(hits).coalesce(1).sortWithinPartitions("rank").select("line") \
            .write.mode("overwrite").text(path)
    elif fmt == "parquet":
        hits.coalesce(1).write.mode("overwrite").parquet(path)
    else:
        raise ValueError(f"unknown format {fmt!r}")
