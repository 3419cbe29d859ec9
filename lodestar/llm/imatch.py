"""I-Match document fingerprints with randomised lexicons, in DataFrame functions only.

* Terms are the lower-cased runs between ASCII marks and spaces.  The lexicon holds the terms
  with an inverse document frequency ``ln(N / df)`` in a band.  The upper end bounds it: the
  document frequencies add up to N times the mean number of terms, so at most
  ``mean * exp(idf_high)`` terms reach it, however many documents there are.
* A document's distinct terms in the lexicon are hashed as a whole (the classic signature)
  and in randomised subsets of the lexicon of several densities.  Dense subsets tell short
  texts apart, sparse ones survive edits of long texts.  Sorting only makes the hash of a set
  independent of order; here the exclusive or of the terms' hashes does that, so the sets are
  hashed by a plain aggregate and never collected.
* Likeness of two fingerprints is the share of equal fields among those that one of them has:
  of all fields, or of one density that fills half of its fields, whichever is largest (the
  density with about one term in a subset fits the text best).

A text without a term in the lexicon is fingerprinted by the hash of its whole text, so only
equal ones share a field.

Cases: null text is empty; a null ``doc_id`` comes first in order; rows that repeat a
``doc_id`` are ordered by text and each get a row; a single document is its own next one; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestar.llm.common import shuffle_partitions, stage
from lodestar.llm.exchange import Deal, pick

IDF_LOW, IDF_HIGH = 1.5, 7.5
DENSITIES = (4, 16, 64, 256)
SUBSETS = 12  # of each density
BROADCAST_TERMS = 2_000_000  # 16 bytes each; a larger lexicon is joined by shuffle

MARKS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
MARK = "\x00"  # no term holds it


def terms(text: F.Column) -> F.Column:
    return F.array_remove(F.array_distinct(F.split(F.lower(text), MARKS)), "")


def lexicon(docs: DataFrame, idf_low: float = IDF_LOW, idf_high: float = IDF_HIGH) -> DataFrame:
    """``(h,)``: hashes of the terms in the band, staged."""
    n = docs.count()
    counts = (docs.select(F.explode(terms(F.col("text"))).alias("term"))
              .select(F.xxhash64("term").alias("h")).groupBy("h").count())
    idf = F.log(F.lit(float(max(n, 1))) / F.col("count"))
    return stage(counts.where(idf.between(idf_low, idf_high)).select("h"), "imatch-lexicon")


def fingerprints(texts: DataFrame, lex: DataFrame, key: list[str]) -> DataFrame:
    """``(*key, fields)`` for each row of ``texts(*key, text)``: 32 bits of the hash of the
    document's terms in the lexicon, and of those in each subset of it; null where none is.

    Rows are grouped where they lie if they are partitioned by a part of the key.
    """
    if lex.count() <= BROADCAST_TERMS:
        lex = F.broadcast(lex)
    # the mark is in the lexicon, so that texts without a term of it stay
    marked = texts.select(*key, F.explode(F.array_append(terms(F.col("text")), MARK)).alias("term"))
    found = marked.select(*key, F.xxhash64("term").alias("h")).join(lex, "h")
    value = F.when(F.col("h") != F.xxhash64(F.lit(MARK)), F.xxhash64("h", F.lit(7)))
    words, inside = [], [F.lit(True)]
    for density in DENSITIES:
        bits = density.bit_length() - 1  # a subset takes one value of as many bits of a hash
        per_word = 64 // bits
        for i in range(SUBSETS):
            name = f"r{density}_{i // per_word}"
            if i % per_word == 0:
                words.append(F.xxhash64("h", F.lit(density * 1000 + i)).alias(name))
            inside.append(F.shiftright(name, i % per_word * bits).bitwiseAND(density - 1) == 0)
    sums = found.select(*key, value.alias("value"), *words).groupBy(*key).agg(
        *[F.bit_xor(F.when(x, F.col("value"))).alias(f"f{i}") for i, x in enumerate(inside)])
    return sums.select(*key, F.array(*[
        F.shiftright(f"f{i}", 32).cast("int") for i in range(len(inside))]).alias("fields"))


def shown(fields: str, plain: str) -> F.Column:
    """A fingerprint as text; ``plain`` stands for texts without a term in the lexicon."""
    parts = F.transform(fields, lambda x: F.coalesce(F.lpad(F.hex(x.cast("bigint").bitwiseAND(0xFFFFFFFF)), 8, "0"),
                                                     F.lit("-")))
    return F.when(F.get(fields, 0).isNull(), F.concat(F.lit("="), F.hex(plain))).otherwise(
        F.array_join(parts, " "))


def likeness(a: str, plain_a: str, b: str, plain_b: str) -> F.Column:
    """Share of equal fields among those that one of two fingerprints has."""
    same = F.zip_with(a, b, lambda x, y: F.when(x.isNotNull() | y.isNotNull(), x.eqNullSafe(y)))
    shares = []
    for start, length, least in [(1, 1 + SUBSETS * len(DENSITIES), 1)] + [
            (2 + i * SUBSETS, SUBSETS, SUBSETS // 2) for i in range(len(DENSITIES))]:
        part = F.slice(same, start, length)
        some = F.size(F.filter(part, lambda p: p.isNotNull()))
        shares.append(F.when(some >= least, F.size(F.filter(part, lambda p: p)) / some))
    neither = F.get(a, 0).isNull() & F.get(b, 0).isNull()
    return F.when(neither, (F.col(plain_a) == F.col(plain_b)).cast("double")).otherwise(F.greatest(*shares))


def in_order(docs: DataFrame) -> DataFrame:
    """``(bucket, place, guard, doc_id, text, next_text)``: every document with the next one.

    Documents are dealt into ranges of the id; the first of a range comes along in the range
    before as its guard (and the very first in the last), so one shuffle of the texts does.
    """
    n = shuffle_partitions(docs.sparkSession)
    key = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(1 << 63)))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), key.alias("key"),
                       F.coalesce("text", F.lit("")).alias("text"))
    # n ranges: that many bounds and first ids reach the driver
    cuts = rows.agg(F.percentile_approx("key", [i / n for i in range(1, n)], 20 * n).alias("c")) \
        .first()["c"] if n > 1 else []
    bounds = sorted(set(cuts or []))
    bucket = F.size(F.filter(F.array(*[F.lit(b).cast("bigint") for b in bounds]).cast("array<bigint>"),
                             lambda b: b <= F.col("key")))
    dealt = rows.withColumn("bucket", bucket)
    firsts = {r["bucket"]: r["first"] for r in
              dealt.groupBy("bucket").agg(F.min("key").alias("first")).collect()}
    order = sorted(firsts)
    before = [(firsts[b], order[i - 1]) for i, b in enumerate(order)]
    guard = F.element_at(F.map_from_arrays(
        F.array(*[F.lit(k).cast("bigint") for k, _ in before]),
        F.array(*[F.lit(b) for _, b in before])), F.col("key")) if before else F.lit(None).cast("int")
    is_first = F.col("key").isin([k for k, _ in before])
    places = F.array(F.struct(F.col("bucket"), F.lit(False).alias("guard")),
                     F.struct(F.when(is_first, guard).alias("bucket"), F.lit(True).alias("guard")))
    both = rows.withColumn("bucket", bucket).select("doc_id", "key", "text", F.explode(places).alias("p")).select(
        F.col("p.bucket").alias("bucket"), F.col("p.guard").alias("guard"), "doc_id", "key", "text"
    ).where("bucket is not null")
    w = Window.partitionBy("bucket").orderBy("guard", "key", "text")
    # a label for each range, so that every task gets one
    labels = Deal.of(docs.sparkSession).buckets
    both = both.withColumn("bucket", pick(labels, F.col("bucket")))
    return both.select("bucket", F.row_number().over(w).alias("place"), "guard", "doc_id", "text",
                       F.lead("text").over(w).alias("next_text"))


def edited(share: int = 4) -> F.Column:
    """The text with its last ``n / share`` characters replaced by the first of the next text."""
    n = F.length("text")
    cut = F.floor(n / share).cast("int")
    return F.concat(F.substring("text", F.lit(1), n - cut),
                    F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), cut))


def compare_edited(docs: DataFrame, idf_low: float = IDF_LOW, idf_high: float = IDF_HIGH) -> DataFrame:
    """Each document with its fingerprint, that of its edited text, and both likenesses.

    ``(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)``
    """
    lex = lexicon(docs, idf_low, idf_high).unionByName(
        docs.sparkSession.range(1).select(F.xxhash64(F.lit(MARK)).alias("h")))
    about = ["bucket", "place", "guard", "doc_id", "n_chars", "edited_sha256", "plain", "edited_plain"]
    rows = in_order(docs).withColumn("edited", edited()).select(
        "bucket", "place", "guard", "doc_id", F.length("text").cast("bigint").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        F.xxhash64("text").alias("plain"), F.xxhash64("edited").alias("edited_plain"),
        F.explode(F.array(F.struct(F.lit(0).alias("version"), "text"),
                          F.struct(F.lit(1).alias("version"), F.col("edited").alias("text")))).alias("v"))
    # the places of a bucket lie together, so nothing below is shuffled again
    prints = fingerprints(rows.select(*about, "v.version", "v.text"), lex, [*about, "version"])
    both = prints.groupBy(*about).agg(
        F.max(F.when(F.col("version") == 0, F.col("fields"))).alias("f"),
        F.max(F.when(F.col("version") == 1, F.col("fields"))).alias("e"))
    w = Window.partitionBy("bucket").orderBy("place")
    after = both.withColumn("next", F.lead("f").over(w)).withColumn("next_plain", F.lead("plain").over(w))
    return after.where("not guard").select(
        "doc_id", "n_chars", "edited_sha256", shown("f", "plain").alias("fingerprint"),
        shown("e", "edited_plain").alias("edited_fingerprint"),
        likeness("f", "plain", "e", "edited_plain").alias("near_edited"),
        likeness("f", "plain", "next", "next_plain").alias("near_next"))
