"""Language identification by nearest centroid.

A text is a TF-IDF vector of its hashed byte n-grams (1 to 3 bytes of the lower-cased
text, digits and ASCII marks as one sign), ``(1 + ln tf) * idf``, at unit length.  Each
language has several centroids from spherical k-means, none for less than a twentieth of its
training texts.  A text gets the language of the
centroid with the largest cosine and is rejected when that cosine lies below the
centroid's limit for texts of its length.

Limits: short texts are less like any centroid, so every training text is cut to ``LENGTHS``
bytes, and each length has its own limit: ``slack`` times the ``QUANTILE`` of the cosines of
the cut texts, each without its own share in its centroid.  Too few texts at a centroid take
the language's limit, too few of a language that of the next shorter length.

Fitting takes at most ``per_language`` labelled rows of each language (those with the
smallest hash of the id; 256 by default), whole texts, whose vectors are made on the
executors, as are the cosines behind the limits; the driver sees those bounded vectors and
numbers and no text.  Prediction is one narrow pass.

Cases: null text, or text without a letter, is ``und`` with score 0 and rejected; rows with
null ``lang`` or null ``doc_id`` teach nothing; with no training row at all every row is
``und``; rows that repeat a ``doc_id`` are predicted one by one; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.llm.bytescan import batches, texts_of
from lodestar.llm.common import stage
from lodestar.llm.exchange import give_back

DIMS = 4096
ROWS = 256  # vectors made at once
PER_LANGUAGE = 256
CENTROIDS = 4
STARTS = 8
LEAST_SHARE = 0.05
SLACK = 0.8
QUANTILE = 0.01
LENGTHS = 16 << np.arange(11)  # bytes
FEWEST = 8  # texts behind a limit, and a quarter of the language's
UNDETERMINED = "und"

# Bytes as the model sees them: ASCII letters lower-cased, all other ASCII as a space,
# bytes of longer characters as they are.
_SIGN = np.full(256, 32, np.uint8)
_SIGN[97:123] = np.arange(97, 123)
_SIGN[65:91] = np.arange(97, 123)
_SIGN[128:] = np.arange(128, 256)


@dataclass(frozen=True)
class Model:
    languages: list[str]
    idf: np.ndarray
    centroids: np.ndarray  # one row each
    language_of: np.ndarray
    limit: np.ndarray  # a row per centroid, a column per length

    def limits(self, centroid: np.ndarray, size: np.ndarray) -> np.ndarray:
        """What texts of ``size`` bytes have to reach at their ``centroid``."""
        at = np.interp(np.log2(np.maximum(size, 1)), np.log2(LENGTHS), np.arange(len(LENGTHS)))
        low = np.floor(at).astype(int)
        high = np.minimum(low + 1, len(LENGTHS) - 1)
        return self.limit[centroid, low] * (1 - (at - low)) + self.limit[centroid, high] * (at - low)


def counts(texts: list[bytes]) -> np.ndarray:
    """Hashed n-gram counts, a row per text."""
    data = _SIGN[np.frombuffer(b"   ".join(texts) + b"   ", np.uint8)].astype(np.uint32)
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    row = np.repeat(np.arange(len(texts)), size + 3) * DIMS
    two = data[:-1] | data[1:] << 8
    three = two[:-1] | data[2:] << 16
    out = np.zeros(len(texts) * DIMS, np.int64)
    for n, gram in ((1, data), (2, two), (3, three)):
        code = (gram * np.uint32(2654435761) + np.uint32(n * 40503)) >> np.uint32(20)
        out += np.bincount(row[:len(code)] + code, minlength=len(out))
    return out.reshape(-1, DIMS)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def vectors(tf: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log(np.maximum(tf, 1))
    x += 1
    x[tf == 0] = 0
    return _unit(x.astype(np.float32) * idf)


def _k_means(x: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means from seeded k-means++ starts, the one with the largest cosines.

    A cluster of one text, or of less than ``LEAST_SHARE`` of all, is given up, the smallest first, so
    single odd texts are no centroids and there may be fewer than ``k``.
    """
    rng, best, most = np.random.default_rng(0), None, -np.inf
    for _ in range(STARTS):
        centers = x[[rng.integers(len(x))]]
        while len(centers) < min(k, len(x)):
            far = np.maximum(0, 1 - (x @ centers.T).max(axis=1)).astype(np.float64)
            if far.sum() < 1e-6:  # copies only
                break
            centers = np.vstack([centers, x[[rng.choice(len(x), p=far / far.sum())]]])
        while True:
            for _ in range(20):
                own = (x @ centers.T).argmax(axis=1)
                centers = _unit(np.vstack([x[own == i].mean(axis=0) if (own == i).any() else centers[i]
                                           for i in range(len(centers))]))
            near = x @ centers.T
            size = np.bincount(near.argmax(axis=1), minlength=len(centers))
            if len(centers) == 1 or size.min() >= max(2, LEAST_SHARE * len(x)):
                break
            centers = np.delete(centers, size.argmin(), axis=0)
        if near.max(axis=1).sum() > most:
            best, most = centers, near.max(axis=1).sum()
    return best


def training_rows(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """At most ``per_language`` rows of each language, by the smallest hash of the id."""
    labelled = docs.where("lang is not null and doc_id is not null").withColumn(
        "h", F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)))
    total = labelled.groupBy("lang").agg(F.count("*").alias("rows"))
    # about twice the wanted rows by a threshold on the hash, then exactly by rank
    share = F.least(F.lit(1.0), (2 * per_language + 64) / F.col("rows"))
    near = labelled.join(F.broadcast(total), "lang").where(F.col("h") < share * F.lit(float(1 << 40)))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h", "doc_id", "text"))
    return near.withColumn("rank", rank).where(F.col("rank") <= per_language).select("lang", "text")


def _likeness(texts: list[bytes], idf: np.ndarray, centers: np.ndarray, sums: np.ndarray,
              size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(length, centroid, cosine)`` of the texts of one language, cut to each of the lengths.

    ``sums`` and ``size`` are of the vectors of each centroid's own texts: a text is left out
    of its centroid before it is compared.
    """
    x = vectors(counts(texts), idf)
    own = (x @ centers.T).argmax(axis=1)
    rest = _unit(sums[own] - x)
    nbytes = np.fromiter(map(len, texts), np.int64, len(texts))
    out = []
    for n, length in enumerate(LENGTHS):
        rows = np.flatnonzero((nbytes >= length) | (n == 0))
        if len(rows):
            cut = vectors(counts([texts[i][:length] for i in rows]), idf)
            near = cut @ centers.T
            alone = size[own[rows]] < 2
            if len(centers) > 1 or not alone.all():
                near[np.arange(len(rows)), own[rows]] = np.where(alone, -1, (cut * rest[rows]).sum(axis=1))
            out.append((np.full(len(rows), n), near.argmax(axis=1), near.max(axis=1)))
    return tuple(np.concatenate(x) for x in zip(*out))


def _limits(length: np.ndarray, centroid: np.ndarray, cosine: np.ndarray, centroids: int,
            slack: float) -> np.ndarray:
    """The limits of one language's centroids; without any text nothing is accepted."""
    least = max(FEWEST, int((length == 0).sum()) // 4)
    out = np.full((centroids, len(LENGTHS)), np.inf)
    for n in range(len(LENGTHS)):
        every = cosine[length == n]
        for j in range(centroids):
            mine = cosine[(length == n) & (centroid == j)]
            basis = mine if len(mine) >= least else every
            if len(basis) >= (least if n else 1):
                out[j, n] = slack * np.quantile(basis, QUANTILE, method="lower")
            elif n:
                out[j, n] = out[j, n - 1]
    return out


def fit(train: DataFrame, per_language: int = PER_LANGUAGE, centroids: int = CENTROIDS,
        slack: float = SLACK) -> Model:
    """The model of the labelled rows ``(doc_id, text, lang)``."""
    def run(it):
        for batch in it:
            for part in batches(pa.Table.from_batches([batch]), 1 << 20, rows=ROWS):
                tf = counts(texts_of(part.column("text").combine_chunks())).astype(np.uint32)
                yield pa.RecordBatch.from_arrays(
                    [part.column("lang").combine_chunks(),
                     pa.array([x.tobytes() for x in tf], pa.binary())], ["lang", "tf"])
        give_back()

    chosen = stage(training_rows(train, per_language).where(F.col("text").isNotNull()), "language-rows")
    rows = chosen.mapInArrow(run, "lang string, tf binary")
    sample = sorted((r["lang"], bytes(r["tf"])) for r in rows.toLocalIterator())  # bounded
    if not sample:
        return Model([], np.zeros(DIMS, np.float32), np.zeros((0, DIMS), np.float32),
                     np.zeros(0, int), np.zeros((0, len(LENGTHS))))
    lang = np.array([x for x, _ in sample])
    tf = np.vstack([np.frombuffer(x, np.uint32) for _, x in sample])
    idf = np.log((1 + len(tf)) / (1 + (tf > 0).sum(axis=0))).astype(np.float32) + np.float32(0.1)
    x = vectors(tf, idf)
    languages = sorted(set(lang.tolist()))
    groups, of = {}, []
    for i, name in enumerate(languages):
        mine = x[lang == name]
        c = _k_means(mine, centroids)
        own = (mine @ c.T).argmax(axis=1)
        sums = np.vstack([mine[own == j].sum(axis=0) for j in range(len(c))])
        groups[name] = c, sums, np.bincount(own, minlength=len(c))
        of += [i] * len(c)
    shared = train.sparkSession.sparkContext.broadcast((idf, groups))

    def compare(it):
        idf, groups = shared.value
        for batch in it:
            for part in batches(pa.Table.from_batches([batch]), 1 << 20, rows=ROWS):
                name = np.array(part.column("lang").to_pylist())
                texts = [x if any(map(str.isalpha, x)) else "" for x in part.column("text").to_pylist()]
                for one in np.unique(name):
                    found = [t.encode() for t, n in zip(texts, name) if t and n == one]
                    if found:
                        length, centroid, cosine = _likeness(found, idf, *groups[one])
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([str(one)] * len(length)), pa.array(length, pa.int32()),
                             pa.array(centroid, pa.int32()), pa.array(cosine, pa.float64())],
                            ["lang", "length", "centroid", "cosine"])
        give_back()

    found = {name: [] for name in languages}
    for r in chosen.mapInArrow(compare, "lang string, length int, centroid int, cosine double").toLocalIterator():
        found[r["lang"]].append((r["length"], r["centroid"], r["cosine"]))
    limit = [_limits(*np.array(found[name], float).reshape(-1, 3).T, len(groups[name][0]), slack)
             for name in languages]
    return Model(languages, idf, np.vstack([groups[name][0] for name in languages]), np.array(of), np.vstack(limit))


def predict(docs: DataFrame, model: Model, keep: list[str] = (), text: str = "text") -> DataFrame:
    """``keep`` and ``(lang_pred, score, accepted)`` for every row.

    ``text`` may name a field of a struct that is kept (``"row.text"``): the workers then take it
    from there, instead of getting every text twice.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = list(keep)
    within, _, field = text.rpartition(".")
    inside = within in kept
    if inside:  # the field's place, as Spark resolves its name
        [place] = [i for i, c in enumerate(docs.schema[within].dataType.names) if c.lower() == field.lower()]

    def run(it):
        m = shared.value
        for batch in it:
            table = pa.Table.from_batches([batch])
            if inside:
                table = table.append_column("_text", pc.struct_field(table.column(within), [place]))
            for part in batches(table, 1 << 20, "_text", ROWS):
                texts = part.column("_text").to_pylist()
                raw = [(x or "").encode() for x in texts]
                near = vectors(counts(raw), m.idf) @ m.centroids.T if m.languages else None
                lang, score, good = [], [], []
                if near is not None:
                    limit = m.limits(near.argmax(axis=1), np.fromiter(map(len, raw), np.int64, len(raw)))
                for i, t in enumerate(texts):
                    if near is None or not t or not any(map(str.isalpha, t)):
                        lang.append(UNDETERMINED), score.append(0.0), good.append(False)
                        continue
                    j = int(near[i].argmax())
                    s = min(1.0, max(0.0, float(near[i, j])))
                    lang.append(m.languages[m.language_of[j]])
                    score.append(s)
                    good.append(bool(s >= limit[i]))
                out = part.select([c for c in part.column_names if c != "_text"])
                yield from (out.append_column("lang_pred", pa.array(lang, pa.string()))
                            .append_column("score", pa.array(score, pa.float64()))
                            .append_column("accepted", pa.array(good, pa.bool_()))
                            .combine_chunks().to_batches())
        give_back()

    source = docs.select(*kept, *([] if inside else [F.col(text).alias("_text")]))
    schema = T.StructType([f for f in source.schema if f.name != "_text"] + [
        T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
        T.StructField("accepted", T.BooleanType())])
    return source.mapInArrow(run, schema)
