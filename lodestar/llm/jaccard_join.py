"""Exact Jaccard join of word shingles by token-combination prefixes, and its components.

A document's set holds its distinct ``width``-word shingles (with fewer words, the whole
sequence as one).  Two documents link when ``100 * |x & y| >= percent * |x | y|``.

* Equal sets are one class; everything below runs on classes, so copies cost nothing.
* Tokens (shingle hashes) are ordered rare first by a count sketch of the corpus.  A class
  with ``n`` tokens can miss ``tau = n - ceil(percent * n / 100)`` of them in a partner.  A
  rare token scores one; the frequent tokens of a prefix are dealt into subsets by hash and
  a subset of ``f`` scores ``f - 1``, for it takes ``f - 1`` misses before no pair of it is
  shared.  The prefix is extended until the score exceeds ``tau``; its rare tokens are
  indexed singly, its frequent ones as pairs within a subset (k = 2).  Of two linked classes,
  all of the shorter-reaching prefix that is shared lies in the other prefix too, so they
  share a signature: the candidates miss no link.  The number of subsets follows the size
  band (powers of two), so a prefix has about four tokens in each and the pairs stay linear
  in ``n``; a class indexes its own band and the next, where every possible partner lies.
* Candidates are verified on whole sets.  First every class is held against the least class
  that it shares most signatures with, then against the least class of the groups that still
  span components: one pair a class and round.  Then the classes of large signatures that
  still span components are compared in tiles: blocks of whole sets, two blocks a task, which
  gives links but no row a pair.  Last, only pairs of classes in different components are left,
  under signatures of at most ``PAIRED`` members (or in chains of crowds).  No link between
  components is lost.
* Before a pair's sets are read, its shared signatures are counted.  If a class indexes single
  tokens only, ``p`` of its ``n``, the overlap is at most the shared ones plus ``n - p``: those of
  the shorter-reaching prefix that the other set has lie in both prefixes.

Hashes have 64 bits (128 for whole sets).  The sketch has a fixed size; it only orders tokens,
so its errors cost time and never links.

Cases: null or blank text has an empty set, links with nothing and keeps its own
``doc_id`` as component; a null ``doc_id`` keeps a null component and links with nothing;
rows that repeat a ``doc_id`` each get a row; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.bytescan import U64, SegmentHash, Words, batches, mix, texts_of
from lodestar.llm.common import stage
from lodestar.llm.components import components
from lodestar.llm.exchange import (
    Deal, bucket_slices, merge_counts, on_batches, on_table, on_tables, pack_bits, rows_table, unpack_bits,
)
from lodestar.operators.skew import salted_key_join

WIDTH = 5
PERCENT = 75
TEXT_BYTES = 2 << 20  # of text at a time; a worker takes some thirty times as much
SKETCH_BITS = 20
SKETCH_CHUNKS = 16
SUBSET_SHARE = 12  # a subset holds about this many tokens of a whole set, a third in the prefix

_SHINGLE = SegmentHash(41)


def shingle_sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    """The ascending distinct shingle hashes of each text."""
    w = Words(texts, lower=True)
    count = np.diff(w.first)
    first, _ = w.windows(width)
    whole = np.flatnonzero((count > 0) & (count < width))
    begin = np.concatenate([first, w.first[whole]])
    last = np.concatenate([first + width - 1, w.first[whole + 1] - 1])
    order = np.argsort(begin, kind="stable")
    begin, last = begin[order], last[order]
    hashes = _SHINGLE(w.data, w.start[begin], w.end[last])
    cuts = np.searchsorted(begin, w.first)
    return [np.unique(hashes[a:b]) for a, b in zip(cuts, cuts[1:])]


def least_overlap(n: int, percent: int) -> int:
    return -(-percent * n // 100)


def _slot(tokens: np.ndarray) -> np.ndarray:
    return (mix(tokens + U64(7)) >> U64(64 - SKETCH_BITS)).astype(np.int64)


def _sketch(docs: DataFrame, width: int) -> np.ndarray:
    """How many sets hit each slot, over all documents; 2**SKETCH_BITS counters."""
    def count(it):
        total = np.zeros(1 << SKETCH_BITS, np.uint32)
        for batch in it:
            for part in batches(pa.Table.from_batches([batch]), TEXT_BYTES):
                sets = shingle_sets(texts_of(part.column("text").combine_chunks()), width)
                total += np.bincount(_slot(np.concatenate(sets)),
                                     minlength=len(total)).astype(np.uint32)
        yield pa.RecordBatch.from_pydict({
            "chunk": pa.array(range(SKETCH_CHUNKS), pa.int32()),
            "counts": pa.array([x.tobytes() for x in total.reshape(SKETCH_CHUNKS, -1)], pa.binary())})

    def add(key: tuple[pa.Scalar, ...], parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for part in parts:
            for x in part.column("counts").to_pylist():
                total = total + np.frombuffer(x, np.uint32).astype(np.uint64)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()),
                                          pa.array([total.tobytes()], pa.binary())],
                                         ["chunk", "counts"])

    parts = docs.select("text").mapInArrow(on_batches(count), "chunk int, counts binary")
    merged = parts.groupBy("chunk").applyInArrow(add, "chunk int, counts binary")
    out = np.zeros((SKETCH_CHUNKS, (1 << SKETCH_BITS) // SKETCH_CHUNKS), np.uint64)
    for r in merged.toLocalIterator():  # a fixed number of counters, 8 MB
        out[r["chunk"]] = np.frombuffer(bytes(r["counts"]), np.uint64)
    return out.reshape(-1)


def frequent_from(sketch: np.ndarray) -> int:
    """Slots with more hits than this hold a frequent token."""
    mean = float(sketch.mean())
    return int(mean + 8 * mean ** 0.5) + 16


def _band_signatures(tokens: np.ndarray, rare: int, tau: int, band: int) -> list[np.ndarray]:
    """Signatures of a set in one band; ``tokens`` rare first, the first ``rare`` are rare."""
    if rare > tau:
        return [tokens[:tau + 1]]
    subsets = max(1, (1 << (band - 1)) // SUBSET_SHARE)
    subset = (mix(tokens[rare:] + U64(11)) % U64(subsets)).astype(np.int64)
    order = np.argsort(subset, kind="stable")  # keeps the order of tokens within a subset
    s = subset[order]
    new = np.ones(len(s), bool)
    new[1:] = s[1:] != s[:-1]
    rank = np.empty(len(s), np.int64)
    rank[order] = np.arange(len(s)) - np.maximum.accumulate(np.where(new, np.arange(len(s)), 0))
    score = rare + np.cumsum(rank > 0)
    end = int(np.searchsorted(score, tau + 1)) + 1
    order = order[order < end]
    s, t = subset[order], tokens[rare:][order]
    out = [tokens[:rare]]
    gap = 1
    while gap < len(t):  # pairs (i, i + gap) within a subset
        both = np.flatnonzero(s[gap:] == s[:-gap])
        if not len(both):
            break
        out.append(mix(mix(t[both]) + t[both + gap] + U64(band)))
        gap += 1
    return out


def signatures(tokens: np.ndarray, hits: np.ndarray, frequent: int,
               percent: int) -> tuple[np.ndarray, int | None]:
    """Distinct signatures of a set, and how many tokens lie beyond them if they are single
    tokens only; ``hits`` are the sketched counts of the tokens."""
    n = len(tokens)
    tau = n - least_overlap(n, percent)
    tokens = tokens[np.lexsort((tokens, hits))]
    rare = int((hits <= frequent).sum())
    if rare > tau:
        return np.sort(tokens[:tau + 1]), n - tau - 1
    own = n.bit_length()
    parts = _band_signatures(tokens, rare, tau, own) + _band_signatures(tokens, rare, tau, own + 1)
    return np.unique(np.concatenate(parts)), None


_SETS = "g int, set_key binary, n bigint, rest bigint, docs array<bigint>, signatures binary"
_ASK = "g int, bucket int, keys binary, flags binary"
_ASK_ARROW = pa.schema([("g", pa.int32()), ("bucket", pa.int32()), ("keys", pa.binary()),
                        ("flags", pa.binary())])
_FOUND = "node bigint, set_key binary, n bigint, rest bigint, docs array<bigint>, sig bigint"
_FOUND_ARROW = pa.schema([("node", pa.int64()), ("set_key", pa.binary()), ("n", pa.int64()),
                          ("rest", pa.int64()), ("docs", pa.list_(pa.int64())), ("sig", pa.int64())])
BROADCAST_ROWS = 200_000  # of 50 bytes: classes that are broadcast to their texts, pairs joined unsalted

PAIRED = 32  # signatures of so many members are paired as they are
TILE_GAIN = 8  # a pair in a tile costs less than this part of one that is a row
BLOCK_NODES = 2048  # a block of a crowd
BLOCK_TOKENS = 1 << 20
DENSE = 32  # tokens of so many sets of a tile are counted by a matrix product
COLUMNS = 1024


def _set_key(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def _scan(docs: DataFrame, sketch: np.ndarray, width: int, percent: int) -> DataFrame:
    """One row per distinct set of a task, with the ids of the documents that have it.

    Rows without a set or without an id come as well, with a null ``set_key``.
    """
    frequent = frequent_from(sketch)
    hits = docs.sparkSession.sparkContext.broadcast(  # 4 MB
        np.minimum(sketch, 0xFFFFFFFF).astype(np.uint32))

    def run(it):
        own: dict[bytes, list] = {}  # as large as the task's share of the input at most
        alone: dict[int, list] = {}
        for batch in it:
            for part in batches(pa.Table.from_batches([batch]), TEXT_BYTES):
                sets = shingle_sets(texts_of(part.column("text").combine_chunks()), width)
                for doc, s in zip(part.column("doc_id").to_pylist(), sets):
                    if doc is None or not len(s):
                        alone.setdefault(len(s), []).append(doc)
                        continue
                    key = _set_key(s)
                    if key not in own:
                        own[key] = [len(s), [], *signatures(s, hits.value[_slot(s)], frequent, percent)]
                    own[key][1].append(doc)
        rows = [(int.from_bytes(k[:3], "little"), k, n, rest, d, x.tobytes())
                for k, (n, d, x, rest) in own.items()]
        rows += [(i, None, n, None, d, None) for i, (n, d) in enumerate(alone.items())]
        for a in range(0, len(rows), 1000):
            g, k, n, rest, d, x = zip(*rows[a:a + 1000])
            yield pa.RecordBatch.from_arrays(
                [pa.array(g, pa.int32()), pa.array(k, pa.binary()), pa.array(n, pa.int64()),
                 pa.array(rest, pa.int64()), pa.array(d, pa.list_(pa.int64())), pa.array(x, pa.binary())],
                ["g", "set_key", "n", "rest", "docs", "signatures"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(on_batches(run), _SETS)


class _Classes:
    """The distinct sets of a group, in the order of their keys."""

    def __init__(self, table: pa.Table):
        self.g = table.column("g")[0].as_py()
        self.keys = table.column("set_key").to_pylist()
        order = {k: i for i, k in enumerate(sorted({k for k in self.keys if k is not None}))}
        self.node = [None if k is None else (self.g << 32) + order[k] for k in self.keys]
        first = {}
        for i, n in enumerate(self.node):
            if n is not None:
                first.setdefault(n, i)
        marks = table.column("signatures")
        parts = [np.frombuffer(marks[i].as_py(), U64) for i in first.values()]
        sig = np.concatenate(parts) if parts else np.zeros(0, U64)
        node = np.repeat(np.fromiter(first, np.int64, len(first)),
                         np.fromiter(map(len, parts), np.int64, len(parts)))
        order = np.argsort(sig, kind="stable")
        self.sig, self.sig_node = sig[order], node[order]
        new = np.ones(len(sig), bool)
        new[1:] = self.sig[1:] != self.sig[:-1]
        self.distinct = self.sig[new]
        self.hits = np.diff(np.append(np.flatnonzero(new), len(sig)))


def _send_signatures(table: pa.Table, buckets: int) -> pa.Table:
    c = _Classes(table)
    return rows_table([(c.g, b, c.distinct[x:y].tobytes(), pack_bits(c.hits[x:y] > 1))
                       for b, x, y in bucket_slices(c.distinct, buckets)], _ASK_ARROW)


def _count_signatures(table: pa.Table) -> pa.Table:
    return rows_table([(g, b, None, bits) for g, b, bits in merge_counts(table, U64)], _ASK_ARROW)


def _found(sets: pa.Table, replies: pa.Table, buckets: int) -> pa.Table:
    """The group's classes with their documents, and their signatures that others have too."""
    if not sets.num_rows:
        return _FOUND_ARROW.empty_table()
    c = _Classes(sets)
    flag = np.zeros(len(c.distinct), bool)
    seen = dict(zip(replies.column("bucket").to_pylist(), replies.column("flags").to_pylist()))
    for b, x, y in bucket_slices(c.distinct, buckets):
        if b in seen:
            flag[x:y] = unpack_bits(seen[b], y - x)
    keep = np.repeat(flag, c.hits)
    n = int(keep.sum())
    members = pa.table([pa.array(c.node, pa.int64()), pa.array(c.keys, pa.binary()),
                        sets.column("n"), sets.column("rest"),
                        sets.column("docs").cast(pa.list_(pa.int64())),
                        pa.nulls(len(c.node), pa.int64())], schema=_FOUND_ARROW)
    shared = pa.table([pa.array(c.sig_node[keep]), pa.nulls(n, pa.binary()), pa.nulls(n, pa.int64()),
                       pa.nulls(n, pa.int64()), pa.nulls(n, pa.list_(pa.int64())),
                       pa.array(c.sig[keep].view(np.int64))], schema=_FOUND_ARROW)
    return pa.concat_tables([members, shared])


def _whole_sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """``(node, tokens)`` of the classes in ``wanted(node, set_key, doc_id)``, from their texts."""
    def run(it):
        for batch in it:
            for part in batches(pa.Table.from_batches([batch]), TEXT_BYTES):
                sets = shingle_sets(texts_of(part.column("text").combine_chunks()), width)
                own = pa.array([_set_key(s) for s in sets], pa.binary())
                out = pa.RecordBatch.from_arrays(
                    [part.column("node").combine_chunks(), part.column("set_key").combine_chunks(),
                     own, pa.array([s.tobytes() for s in sets], pa.binary())],
                    ["node", "set_key", "own", "tokens"])
                # a repeated doc_id may bring another text along
                yield out.filter(pc.equal(out["set_key"], out["own"])).select(["node", "tokens"])

    if wanted.count() <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)
    doc_id = F.col("doc_id").cast("bigint").alias("doc_id")
    return docs.select(doc_id, "text").join(wanted, "doc_id").mapInArrow(
        on_batches(run), "node bigint, tokens binary")


def _verified(docs: DataFrame, classes: DataFrame, pairs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` that link, by their whole sets."""
    def run(it):
        for batch in it:
            a = [np.frombuffer(x, U64) for x in batch.column("ta").to_pylist()]
            b = [np.frombuffer(x, U64) for x in batch.column("tb").to_pylist()]
            both = [len(np.intersect1d(x, y, assume_unique=True)) for x, y in zip(a, b)]
            keep = pa.array([100 * c >= percent * (len(x) + len(y) - c)
                             for x, y, c in zip(a, b, both)], pa.bool_())
            yield batch.select(["a", "b"]).filter(keep)

    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = stage(classes.join(nodes, "node").select("node", "set_key", "doc_id"), "jaccard-wanted")
    sets = stage(_whole_sets(docs, wanted, width), "jaccard-tokens")
    of = lambda c, t: sets.select(F.col("node").alias(c), F.col("tokens").alias(t))
    with_b = pairs.join(of("b", "tb"), "b")
    if pairs.count() <= BROADCAST_ROWS:  # too few for a hot class to matter
        both = with_b.join(of("a", "ta"), "a")
    else:
        fan = of("a", "ta").join(pairs.groupBy("a").agg(F.count("*").alias("pairs")), "a")
        both = salted_key_join(with_b, fan, "a", "pairs", spread_col="b")
    return both.select("a", "b", "ta", "tb").mapInArrow(on_batches(run), "a bigint, b bigint")


def _able(counted: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Of pairs ``(a, b, shared)``, those whose sizes and shared signatures allow a link."""
    side = lambda c: classes.select(
        F.col("node").alias(c), F.col("n").alias(f"n{c}"), F.col("rest").alias(f"r{c}"))
    both = counted.join(side("b"), "b").join(side("a"), "a")
    sizes = F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent
    # 100 * overlap >= percent * (na + nb - overlap)
    most = F.col("shared") + F.greatest("ra", "rb")
    overlap = F.coalesce(most * (100 + percent) >= (F.col("na") + F.col("nb")) * percent, F.lit(True))
    return both.where(sizes & overlap).select("a", "b", "shared")


def _one_each(pairs: DataFrame) -> DataFrame:
    """For each class ``x`` the ``y`` it shares most signatures with, of the pairs ``(x, y)``."""
    counted = pairs.groupBy("x", "y").agg(F.count("*").alias("shared"))
    best = counted.groupBy("x").agg(F.max(F.struct("shared", "y")).alias("m"))
    return best.select(F.least("x", "m.y").alias("a"), F.greatest("x", "m.y").alias("b"), "m.shared").distinct()


def _labelled(shared: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members with labels, and the signatures whose members still have several."""
    members = shared.join(labels, "node", "left").select(
        "sig", "node", F.coalesce("label", "node").alias("label"))
    mixed = members.groupBy("sig").agg(
        F.min(F.struct("label", "node")).alias("lo"), F.max("label").alias("hi"),
        F.count("*").alias("size")).where("lo.label < hi")
    return members, mixed


def _open(shared: DataFrame, labels: DataFrame) -> DataFrame:
    """Staged members ``(sig, node, label, lo, hi, size)`` of signatures that span components."""
    members, mixed = _labelled(shared, labels)
    return stage(salted_key_join(members, mixed, "sig", "size", spread_col="node"), "jaccard-open")


def _crowds(rest: DataFrame, classes: DataFrame) -> DataFrame:
    """``(node, crowd, parts)``: members of large signatures, joined where they share one.

    Members of one group of near copies share most of its signatures, so its pairs come once for
    each of these.  A crowd is compared whole, in ``parts`` blocks, unless that are more pairs than its
    signatures have (crowds that chain); the members of such a one are left to their signatures.
    """
    big = rest.where(F.col("size") > PAIRED).select("node", F.col("lo.node").alias("least"), "size")
    crowd = components(big.select(F.col("node").alias("a"), F.col("least").alias("b"))).select(
        "node", F.col("label").alias("crowd"))
    nodes = big.groupBy("node").agg(F.sum("size").alias("pairs")).join(crowd, "node").join(
        classes.select("node", "n"), "node")
    sums = nodes.groupBy("crowd").agg(F.count("*").alias("m"), F.sum("n").alias("tokens"), F.sum("pairs").alias("pairs"))
    parts = F.greatest(F.least(F.lit(16), F.ceil(F.col("m") / 256)), F.ceil(F.col("m") / BLOCK_NODES),
                       F.ceil(F.col("tokens") / BLOCK_TOKENS)).cast("int")
    kept = sums.where(F.col("m").cast("double") * F.col("m") <= TILE_GAIN * F.col("pairs")).select(
        "crowd", parts.alias("parts"))
    return stage(crowd.join(kept, "crowd").select("node", "crowd", "parts"), "jaccard-crowds")


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """How many tokens each two of some sets share; a set's own entry may be anything."""
    m = len(sets)
    owner = np.repeat(np.arange(m), np.fromiter(map(len, sets), np.int64, m))
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    both = np.zeros((m, m), np.float32)
    order = np.argsort(column, kind="stable")
    common = count >= DENSE
    few = order[~common[column[order]]]
    who, what = owner[few], column[few]
    for gap in range(1, DENSE):  # a token of few sets: its pairs
        at = np.flatnonzero(what[gap:] == what[:-gap])
        if not len(at):
            break
        np.add.at(both, (who[at], who[at + gap]), 1)
        np.add.at(both, (who[at + gap], who[at]), 1)
    number = np.cumsum(common) - 1
    many = order[common[column[order]]]
    who, what = owner[many], number[column[many]]
    for a in range(0, int(common.sum()), COLUMNS):
        x, y = np.searchsorted(what, [a, a + COLUMNS])
        has = np.zeros((m, COLUMNS), np.float32)
        has[who[x:y], what[x:y] - a] = 1
        both += has @ has.T
    return both


def _forest(table: pa.Table, percent: int) -> pa.Table:
    """Links among the classes of a tile that connect what all its links connect."""
    rows = dict(zip(table.column("node").to_pylist(), table.column("tokens").to_pylist()))  # a copy may come twice
    nodes, sets = list(rows), [np.frombuffer(x, U64) for x in rows.values()]
    n = np.fromiter(map(len, sets), np.int64, len(sets))
    both = overlaps(sets)
    left, a, b = np.ones(len(n), bool), [], []
    for root in range(len(n)):
        left[root], new = False, [root] if left[root] else []
        while new:
            x = new.pop()
            c = both[x].astype(np.int64)
            found = np.flatnonzero(left & (100 * c >= percent * (n[x] + n - c))).tolist()
            left[found] = False
            new += found
            a += [nodes[x]] * len(found)
            b += [nodes[y] for y in found]
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _crowd_links(docs: DataFrame, classes: DataFrame, crowds: DataFrame, width: int, percent: int) -> DataFrame:
    """Verified links ``(a, b)`` that connect whatever classes of a crowd are connected.

    A crowd is dealt into blocks of bounded size; each two blocks meet in one task, which holds no
    more than these and reads their whole sets.
    """
    wanted = stage(classes.join(crowds, "node").select("node", "set_key", "doc_id"), "jaccard-wanted")
    own = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    placed = _whole_sets(docs, wanted, width).join(crowds, "node").withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    tiles = placed.groupBy("crowd", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"))
    return tiles.applyInArrow(on_table(_forest, percent=percent), "a bigint, b bigint")


def jaccard_classes(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """Members ``(node, set_key, n, docs)`` and links ``(a, b)`` between nodes.

    A node is a class of equal sets; it may have several member rows.  The links connect
    whatever the exact join would connect, but leave out most of those within a component.
    """
    deal = Deal.of(docs.sparkSession)
    buckets = len(deal.buckets)
    sets = _scan(docs, _sketch(docs, width), width, percent)
    by_group = sets.withColumn("g", deal.group(F.col("g"))).groupBy("g")
    asks = by_group.applyInArrow(on_table(_send_signatures, buckets=buckets), _ASK)
    replies = deal.by_bucket(asks).applyInArrow(on_table(_count_signatures), _ASK)
    found = stage(by_group.cogroup(replies.groupBy("g")).applyInArrow(
        on_tables(_found, buckets=buckets), _FOUND), "jaccard-found")
    shared = found.where("sig is not null").select("sig", "node")
    members = found.where("sig is null").select("node", "set_key", "n", "docs")
    classes = stage(found.where("sig is null and node is not null").groupBy("node", "set_key").agg(
        F.min(F.array_min("docs")).alias("doc_id"), F.first("n").alias("n"), F.first("rest").alias("rest")),
        "jaccard-classes")

    def link(counted: DataFrame) -> DataFrame:
        tried = stage(_able(counted, classes, percent).select("a", "b"), "jaccard-pairs")
        return _verified(docs, classes, tried, width, percent)

    # 1. each class against the least member it shares most signatures with
    least = shared.groupBy("sig").agg(F.min("node").alias("y"), F.count("*").alias("size")).where("size > 1")
    star = salted_key_join(shared, least, "sig", "size", spread_col="node").where("node > y")
    links = stage(link(_one_each(star.select(F.col("node").alias("x"), "y"))), "jaccard-links")
    # 2. members outside the least component of their signatures, against that one's least member
    rest = _open(shared, components(links))
    ends = rest.where("label <> lo.label").select(F.col("node").alias("x"), F.col("lo.node").alias("y"))
    links = stage(links.unionByName(link(_one_each(ends))), "jaccard-links")
    # 3. whatever pair of members still lies in different components
    rest = _open(shared, components(links))
    # 3. crowds of members under large signatures, block against block
    crowds = _crowds(rest, classes)
    if not crowds.isEmpty():
        links = stage(links.unionByName(_crowd_links(docs, classes, crowds, width, percent)), "jaccard-links")
        rest = rest.drop("label").join(components(links).select("node", "label"), "node", "left").withColumn(
            "label", F.coalesce("label", "node"))
    # 4. whatever pair of members still lies in different components
    rest = rest.join(crowds.select("node", "crowd"), "node", "left").join(classes.select("node", "n"), "node").where(
        ~((F.col("size") > PAIRED) & F.col("crowd").isNotNull())).select("sig", "node", "label", "n", "crowd")
    pairs = rest.join(rest.toDF("sig", "y", "other", "ny", "beside"), "sig").where(
        (F.col("label") < F.col("other")) & ~F.coalesce(F.col("crowd") == F.col("beside"), F.lit(False))
        & (F.least("n", "ny") * 100 >= F.greatest("n", "ny") * percent))
    counted = pairs.groupBy(F.least("node", "y").alias("a"), F.greatest("node", "y").alias("b")).agg(
        F.count("*").alias("shared"))
    return members, stage(links.unionByName(link(counted)), "jaccard-links")


def jaccard_components(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """``(doc_id, n_shingles, component_id)``: one row for each row of ``docs``."""
    members, links = jaccard_classes(docs, width, percent)
    labelled = members.join(components(links), "node", "left").select(
        F.coalesce("label", "node").alias("label"), "n", "docs")
    least = labelled.where("label is not null").groupBy("label").agg(
        F.min(F.array_min("docs")).alias("component_id"), F.count("*").alias("rows"))
    known = salted_key_join(labelled.where("label is not null").withColumn("at", F.array_min("docs")),
                            least, "label", "rows", spread_col="at")
    alone = labelled.where("label is null").withColumn("component_id", F.lit(None).cast("bigint"))
    doc = F.explode("docs").alias("doc_id")
    return (known.select(doc, "n", "component_id").unionByName(alone.select(doc, "n", "component_id"))
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.coalesce("component_id", "doc_id").alias("component_id")))
