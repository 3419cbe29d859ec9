"""Removal of repeated line runs by a suffix array over line ids, in DataFrame functions only.

The text of the corpus is a sequence of line ids (hashes of the lines that are not blank).
Distributed prefix doubling ranks the suffixes by their first 1, 2, 4, ... lines: the rank
of a suffix at depth ``2k`` orders the pairs (rank at i, rank at i + k).  It goes on until no
two suffixes share a rank, so as far as the longest repeated run.

Suffixes of one rank are a longest-common-prefix interval of at least that depth, with a first
place by document and line.  Neighbouring suffixes of a document whose intervals begin at
neighbouring places of one text are one repeated run, and its length follows from their number.
Of the runs of all depths those inside another are left out.  What stays are the maximal runs
with the place they repeat; where the beginning of a run has an earlier place than the whole, it
is given as overlapping pieces that cover it.  All of them are later copies and their lines
are deleted.  A run counts when it has ``min_lines`` lines, or when it is a single line of
``long_line`` words.

Ranks are numbers of smaller suffixes: distinct pairs are counted first (a line that a third
of all documents hold is one pair), cut into ranges of both their keys, and summed up.
Suffixes that are alone at some depth are dropped before the next.

Cases: null text has no lines and stays null; blank lines are kept and never compared; a
document of which no line is left becomes empty (``keep_rows`` false drops such rows); null
``doc_id`` comes before all others; rows equal in ``doc_id`` and text are one document and
are treated alike; an empty table gives an empty result; other columns are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestar.llm.common import WORD, shuffle_partitions, stage
from lodestar.operators.skew import salted_key_join

MIN_LINES = 2
LONG_LINE = 20
BROADCAST_ROWS = 100_000  # intervals of under 100 bytes; more are joined by shuffle, hot ones salted


def line_ids(docs: DataFrame) -> DataFrame:
    """``(doc_id, t, seq, id, words)``: the lines that are not blank, numbered by ``seq``;
    ``t`` tells equal ids apart."""
    lines = F.transform(F.split("text", "\n"), lambda x: F.struct(
        F.xxhash64(x).alias("id"), F.regexp_count(x, F.lit(WORD)).alias("words")))
    full = F.filter(lines, lambda x: x["words"] > 0)
    return docs.where("text is not null").select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("t"),
        F.posexplode(full).alias("seq", "l")).select("doc_id", "t", "seq", "l.id", "l.words")


def _ranked(pairs: DataFrame, lead: F.Column) -> DataFrame:
    """``pairs(a, b, ...)`` that several suffixes share, with ``rank``: how many lie before.

    ``lead`` grows with ``(a, b)`` and spreads evenly over 0 to 1.
    """
    n = shuffle_partitions(pairs.sparkSession)
    chunked = pairs.withColumn("chunk", F.least(F.floor(lead * n), F.lit(n - 1)).cast("int"))
    own = F.sum("size").over(Window.partitionBy("chunk").orderBy("a", "b")
                             .rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    sums = chunked.groupBy("chunk").agg(F.sum("size").alias("all"))  # one row a chunk
    before = sums.select("chunk", (F.sum("all").over(Window.orderBy("chunk")) - F.col("all")).alias("before"))
    return chunked.withColumn("own", own).join(F.broadcast(before), "chunk").withColumn(
        "rank", F.col("before") + F.col("own")).drop("chunk", "own", "before")


def _intervals(level: DataFrame, *marks: F.Column) -> DataFrame:
    """Suffixes with equal ``(a, b)``: their number and first place, where several places are."""
    return level.groupBy("a", "b").agg(
        F.count("*").alias("size"), F.min("place").alias("first"), F.max("place").alias("last"),
        F.max("wide").alias("wide"), *marks).where("first < last").drop("last")


def _shared(level: DataFrame, found: DataFrame, rows: int, depth: int) -> DataFrame:
    """Staged suffixes ``(place, rank, size, first, ...)`` that share their rank with others;
    ``rows`` is the number of intervals ``found``."""
    keyed = level.select("place", F.struct("a", "b").alias("k"))
    of = found.select(F.struct("a", "b").alias("k"), *[c for c in found.columns if c not in ("a", "b", "wide")])
    if rows <= BROADCAST_ROWS:
        both = keyed.join(F.broadcast(of), "k")
    else:
        both = salted_key_join(keyed, of, "k", "size", spread_col="place")
    return stage(both.drop("k"), f"line-suffixes-{depth}")


def _doubled(at: DataFrame, step: int) -> DataFrame:
    """The next depth: each suffix with its rank ``a`` and the rank ``b`` of the one ``step``
    lines on.  Without that one it is alone and goes."""
    ahead = Window.partitionBy("place.doc_id", "place.t").orderBy("place.seq").rangeBetween(step, step)
    return at.select("place", F.col("rank").alias("a"), F.max("rank").over(ahead).alias("b"),
                     F.col("size").alias("wide")).where("b is not null")


def _maximal(later: DataFrame) -> DataFrame:
    """Runs ``(doc_id, t, seq, lines, first)`` of the suffixes ``later(depth, place, first)``."""
    doc = ["place.doc_id", "place.t"]
    shift = (F.col("place.seq") - F.col("first.seq")).alias("shift")
    steps = later.select("depth", F.col("place.doc_id").alias("doc_id"), F.col("place.t").alias("t"),
                         F.col("place.seq").alias("seq"), "first.doc_id", "first.t", shift).toDF(
        "depth", "doc_id", "t", "seq", "from_doc", "from_t", "shift")
    same = ["depth", "doc_id", "t", "from_doc", "from_t", "shift"]
    chain = F.col("seq") - F.row_number().over(Window.partitionBy(*same).orderBy("seq"))
    runs = steps.withColumn("chain", chain).groupBy(*same, "chain").agg(
        F.min("seq").alias("seq"), (F.max("seq") - F.min("seq") + F.col("depth")).alias("lines"))
    inside = Window.partitionBy("doc_id", "t").orderBy(
        "seq", F.desc("lines"), F.desc("depth"), "from_doc", "from_t").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("seq") + F.col("lines")
    return runs.withColumn("reach", F.max(end).over(inside)).where(
        F.col("reach").isNull() | (end > F.col("reach"))).select(
        "doc_id", "t", "seq", "lines", F.struct(
            F.col("from_doc").alias("doc_id"), F.col("from_t").alias("t"),
            (F.col("seq") - F.col("shift")).alias("seq")).alias("first"))


def repeated_runs(lines: DataFrame, min_lines: int = MIN_LINES, long_line: int = LONG_LINE) -> DataFrame:
    """``(doc_id, t, seq, lines, first)``: the maximal runs that are later copies, ``lines`` long,
    and the place ``first (doc_id, t, seq)`` they repeat."""
    place = F.struct("doc_id", "t", "seq").alias("place")
    level = lines.select(place, F.col("id").alias("a"), F.lit(0).cast("bigint").alias("b"),
                         F.lit(1).cast("bigint").alias("wide"), "words")
    lead = (F.col("a") / 2.0 ** 64) + 0.5  # hashes are spread evenly
    depth, marks, out = 1, [F.max("words").alias("words")], []
    while True:
        found = stage(_ranked(_intervals(level, *marks), lead), f"line-ranks-{depth}")
        total, rows = found.agg(F.max(F.col("rank") + F.col("size")), F.count("*")).first()
        if total is None and out:
            break
        at = _shared(level, found, rows, depth)
        later = at.where("place > first")
        if depth < min_lines:  # so far only single lines count
            later = later.where(F.col("words") >= long_line if depth == 1 and long_line else F.lit(False))
        found_here = later.select(F.lit(depth).alias("depth"), "place", "first")
        out.append(found_here.distinct() if depth == 1 else found_here)
        if total is None:
            break
        if depth == 1:  # rows that are repeated as a whole are one document
            at = at.groupBy("place").agg(F.max("rank").alias("rank"), F.max("size").alias("size"))
        step = depth if depth >= min_lines else min(depth, min_lines - depth)
        level, marks = _doubled(at, step), []
        # the pairs of one ``a`` begin at rank ``a`` and reach over ``wide`` ranks
        lead = (F.col("a") + F.col("wide") * (F.col("b") / float(total))) / float(total)
        depth += step
    every = out[0]
    for x in out[1:]:
        every = every.unionByName(x)
    return _maximal(every)


def _changed(docs: DataFrame, min_lines: int, long_line: int) -> DataFrame:
    """Every row of ``docs`` as ``_row``, with the numbers of the lines that go (``_gone``, among
    those that are not blank; null if none) and the text that stays (``_text``)."""
    lines = stage(line_ids(docs), "line-ids")
    runs = repeated_runs(lines, min_lines, long_line)
    # of one document, so no longer than that
    removed = runs.groupBy("doc_id", "t").agg(F.array_distinct(F.flatten(F.collect_list(
        F.expr("sequence(seq, seq + lines - 1)")))).alias("gone"))
    inner = docs.select(F.struct("*").alias("_row"), F.col("doc_id").cast("bigint").alias("_id"),
                        F.xxhash64("text").alias("_t"))
    both = inner.join(removed.toDF("_doc", "_hash", "_gone"),
                      F.col("_id").eqNullSafe(F.col("_doc")) & (F.col("_t") == F.col("_hash")), "left")
    # lines and places are columns of their own: within a lambda they would be made anew each time
    cut = both.withColumn("_lines", F.when(F.col("_gone").isNotNull(), F.split("_row.text", "\n")))
    every = F.sequence(F.lit(0), F.size("_lines") - 1)
    cut = cut.withColumn("_full", F.filter(every, lambda i: F.get("_lines", i).rlike(WORD)))
    gone = F.when(F.size("_full") > 0, F.transform("_gone", lambda s: F.get("_full", s)))
    kept = F.array_join(F.transform(F.array_except(every, gone), lambda i: F.get("_lines", i)), "\n")
    return cut.withColumn("_text", F.when(F.col("_gone").isNull(), F.col("_row.text")).otherwise(kept))


def dedup_lines(docs: DataFrame, min_lines: int = MIN_LINES, long_line: int = LONG_LINE,
                keep_rows: bool = True) -> DataFrame:
    """``docs`` with repeated runs removed from ``text``, and ``n_chars`` brought in line."""
    changed = _changed(docs, min_lines, long_line)
    if not keep_rows:
        # Counted from the row's own text: Spark moves a filter on ``_text`` below the columns that
        # it is made of, and then splits the text anew for each of its lines.
        full = F.size(F.filter(F.split("_row.text", "\n"), lambda x: x.rlike(WORD)))
        changed = changed.where(F.col("_gone").isNull() | (F.size("_gone") < full))
    columns = []
    for c in docs.columns:
        value = F.col(f"_row.`{c}`")
        if c == "text":
            value = F.col("_text")
        elif c == "n_chars":
            value = F.when(F.col("_gone").isNull(), value).otherwise(F.length("_text")).cast(docs.schema[c].dataType)
        columns.append(value.alias(c))
    return changed.select(*columns)


def line_report(docs: DataFrame, min_lines: int = MIN_LINES, long_line: int = LONG_LINE) -> DataFrame:
    """``(doc_id, n_lines, n_removed, kept)`` for every row of ``docs``."""
    return _changed(docs, min_lines, long_line).select(
        F.col("_id").alias("doc_id"),
        F.when(F.col("_row.text").isNull(), 0).otherwise(F.size(F.split("_row.text", "\n"))).cast("bigint").alias("n_lines"),
        F.when(F.col("_gone").isNull(), 0).otherwise(F.size("_gone")).cast("bigint").alias("n_removed"),
        F.coalesce("_text", F.lit("")).alias("kept"))
