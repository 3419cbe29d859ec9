"""Substring de-duplication over bytes with bucket-pointer refinement of suffixes.

A byte is removed when a ``length``-byte string that covers it also starts in a document
with a smaller ``doc_id``.  Sorting every suffix of the corpus is never needed:

1. Initial q-gram buckets.  Every ``length``-byte window is filed under the least (by hash)
   of its ``q``-byte grams, its anchor; equal windows have equal anchors.  Anchors are counted
   over the corpus, bucket by bucket, and those of one document only are done.
2. Neighbouring windows with one anchor form a context.  Contexts under an anchor are
   compared by hash: where a smaller document has the whole context, all its windows go.
3. What is left (anchors with several contexts, one copy of each) meets in the anchor's
   bucket as bytes.  There the suffixes are refined by bucket pointers: buckets of equal 8-byte
   prefixes are split by the bucket identifiers 8 bytes on, the result by its own identifiers
   16 bytes on, and so on up to ``length``; suffixes alone in their bucket drop out.

Every exchange carries one entry per group and key, see ``exchange``.

Cases: null text is empty; a null ``doc_id`` neither removes nor loses bytes; rows that
repeat a ``doc_id`` never remove each other's bytes; an empty table gives an empty result;
other columns are ignored.  What is kept may be no valid UTF-8, so it is binary.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lodestar.llm.bytescan import U64, SegmentHash, grams8, mix, sliding_min, texts_of
from lodestar.llm.exchange import (
    Deal, bucket_slices, grouped, merge_counts, on_table, on_tables, pack_bits, rows_table,
    unpack_bits,
)

LENGTH = 50
Q = 24
SCAN = 1 << 18  # windows whose anchors are found at once
REFINED = 1 << 20  # bytes of contexts that are refined at once, about

_ASK = "g int, bucket int, seen binary, keys binary, flags binary, docs binary, segments binary"
_ASK_ARROW = pa.schema([("g", pa.int32()), ("bucket", pa.int32())]
                       + [(c, pa.binary()) for c in ("seen", "keys", "flags", "docs", "segments")])
_OUT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary"
_OUT_ARROW = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()),
                        ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())])

_CONTEXT = SegmentHash(61)


def _anchors(data: np.ndarray, length: int, q: int) -> np.ndarray:
    """The least gram hash of every ``length``-byte window of ``data``, mixed once more.

    The least of many hashes are small numbers; buckets are cut from the high bits, and without
    the mixing most windows of a corpus would meet in the first ones.
    """
    x = grams8(data)
    n = len(data) - q + 1
    h = mix(x[:n])
    for off in [*range(8, q - 8, 8), q - 8]:
        h = mix(h + x[off:off + n])
    return mix(sliding_min(h, length - q + 1))


def _runs(data: np.ndarray, window: np.ndarray, length: int, q: int) -> tuple[np.ndarray, np.ndarray]:
    """First windows of the runs of one anchor, and their anchors, some windows at a time."""
    starts, anchors = [np.zeros(0, np.int64)], [np.zeros(0, U64)]
    before = None  # the anchor of the window before the block, if there is one
    for a in range(0, len(window), SCAN):
        ok = window[a:a + SCAN]
        m = _anchors(data[a:a + len(ok) + length - 1], length, q)
        new = ok.copy()
        new[1:] &= (m[1:] != m[:-1]) | ~ok[:-1]
        if ok[0] and before is not None and m[0] == before:
            new[0] = False
        before = m[-1] if ok[-1] else None
        at = np.flatnonzero(new)
        starts.append(at + a)
        anchors.append(m[at])
    return np.concatenate(starts), np.concatenate(anchors)


class _Group:
    """Contexts of one group: runs of neighbouring windows with one anchor."""

    def __init__(self, table: pa.Table, length: int, q: int):
        texts = texts_of(table.column("text").combine_chunks())
        self.length = length
        self.ids = table.column("doc_id")
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        self.size = np.fromiter(map(len, texts), np.int64, len(texts))
        self.offset = np.cumsum(self.size) - self.size
        count = np.maximum(self.size - length + 1, 0) * np.asarray(self.ids.is_valid())
        window = np.zeros(max(len(self.data) - length + 1, 0), bool)  # none crosses into the next text
        for a, n in zip(self.offset.tolist(), count.tolist()):
            window[a:a + n] = True
        self.start, self.anchor = _runs(self.data, window, length, q)
        text = np.searchsorted(self.offset, self.start, side="right") - 1
        after = np.append(self.start[1:], len(self.data))
        self.windows = np.minimum(after, (self.offset + count)[text]) - self.start
        self.doc = self.ids.fill_null(0).to_numpy()[text]
        self.anchors, self.anchor_of = np.unique(self.anchor, return_inverse=True)

    def several(self) -> np.ndarray:
        """Whether an anchor lies in two documents of the group."""
        low = np.full(len(self.anchors), np.iinfo(np.int64).max)
        high = np.full(len(self.anchors), np.iinfo(np.int64).min)
        np.minimum.at(low, self.anchor_of, self.doc)
        np.maximum.at(high, self.anchor_of, self.doc)
        return low < high

    def keep_seen(self, seen: dict[int, bytes], buckets: int) -> None:
        """Keep contexts whose anchor is in several documents; merge the equal ones."""
        flag = np.zeros(len(self.anchors), bool)
        for b, x, y in bucket_slices(self.anchors, buckets):
            if b in seen:
                flag[x:y] = unpack_bits(seen[b], y - x)
        at = np.flatnonzero(flag[self.anchor_of])
        self.start, self.windows = self.start[at], self.windows[at]
        self.doc, anchor = self.doc[at], self.anchor[at]
        whole = _CONTEXT(self.data, self.start, self.start + self.windows + self.length - 1)
        order = np.lexsort((self.doc, whole, anchor))
        a, w = anchor[order], whole[order]
        new = np.ones(len(order), bool)
        new[1:] = (a[1:] != a[:-1]) | (w[1:] != w[:-1])
        self.class_of = np.empty(len(order), np.int64)
        self.class_of[order] = np.cumsum(new) - 1
        self.key, self.whole, self.least = a[new], w[new], self.doc[order][new]
        self.sample = order[new]  # a context of each class

    def segment(self, c: int) -> bytes:
        i = self.sample[c]
        s = int(self.start[i])
        return self.data[s:s + int(self.windows[i]) + self.length - 1].tobytes()


def _replies(replies: pa.Table) -> dict[int, dict]:
    return {r["bucket"]: r for r in replies.to_pylist()}


def _send_anchors(table: pa.Table, length: int, q: int, buckets: int) -> pa.Table:
    group, g = _Group(table, length, q), table.column("g")[0].as_py()
    several = group.several()
    return rows_table([(g, b, None, group.anchors[x:y].tobytes(), pack_bits(several[x:y]), None, None)
                       for b, x, y in bucket_slices(group.anchors, buckets)], _ASK_ARROW)


def _count_anchors(table: pa.Table) -> pa.Table:
    return rows_table([(g, b, bits, None, None, None, None)
                       for g, b, bits in merge_counts(table, U64)], _ASK_ARROW)


def _seen_group(docs: pa.Table, replies: pa.Table, length: int, q: int, buckets: int):
    group, rows = _Group(docs, length, q), _replies(replies)
    group.keep_seen({b: r["seen"] for b, r in rows.items()}, buckets)
    return group, rows


def _send_contexts(docs: pa.Table, replies: pa.Table, length: int, q: int, buckets: int) -> pa.Table:
    if not docs.num_rows or not replies.num_rows:
        return rows_table([], _ASK_ARROW)
    group, rows = _seen_group(docs, replies, length, q, buckets)
    g = docs.column("g")[0].as_py()
    return rows_table([(g, b, rows[b]["seen"], group.key[x:y].tobytes() + group.whole[x:y].tobytes(),
                        None, group.least[x:y].tobytes(), None)
                       for b, x, y in bucket_slices(group.key, buckets)], _ASK_ARROW)


def _compare_contexts(table: pa.Table) -> pa.Table:
    """Two bits a context: a smaller document has it whole; it is the one copy to look into."""
    rows = table.to_pylist()
    least = [np.frombuffer(r["docs"], np.int64) for r in rows]
    key, whole = np.concatenate([np.frombuffer(r["keys"], U64).reshape(2, -1) for r in rows], axis=1)
    doc = np.concatenate(least)
    order = np.lexsort((doc, whole, key))
    k, w = key[order], whole[order]
    new_key = np.ones(len(order), bool)
    new_key[1:] = k[1:] != k[:-1]
    new = new_key.copy()
    new[1:] |= w[1:] != w[:-1]
    kinds = np.bincount((np.cumsum(new_key) - 1)[new])  # contexts under each anchor
    below, mixed = np.empty(len(order), bool), np.empty(len(order), bool)
    below[order] = doc[order][new][np.cumsum(new) - 1] < doc[order]
    mixed[order] = kinds[np.cumsum(new_key) - 1] > 1
    out, at = [], 0
    for r, part in zip(rows, least):
        end = at + len(part)
        flags = pack_bits(np.concatenate([below[at:end], (mixed & ~below)[at:end]]))
        out.append((r["g"], r["bucket"], r["seen"], None, flags, None, None))
        at = end
    return rows_table(out, _ASK_ARROW)


def _send_segments(docs: pa.Table, replies: pa.Table, length: int, q: int, buckets: int) -> pa.Table:
    if not docs.num_rows or not replies.num_rows:
        return rows_table([], _ASK_ARROW)
    group, rows = _seen_group(docs, replies, length, q, buckets)
    g, out = docs.column("g")[0].as_py(), []
    for b, x, y in bucket_slices(group.key, buckets):
        flags = rows[b]["flags"]
        parts = np.flatnonzero(unpack_bits(flags, 2 * (y - x))[y - x:]) + x
        segments = [group.segment(c) for c in parts]
        sizes = np.fromiter(map(len, segments), np.int64, len(segments))
        out.append((g, b, rows[b]["seen"], group.key[parts].tobytes() + sizes.tobytes(), flags,
                    group.least[parts].tobytes(), b"".join(segments)))
    return rows_table(out, _ASK_ARROW)


def refine(data: np.ndarray, size: np.ndarray, length: int) -> np.ndarray:
    """Bucket identifiers of the suffixes of segments, equal where ``length`` bytes are.

    ``data`` holds segments of the given sizes one after the other.  Identifier 0 marks a
    suffix that is shorter than ``length`` or was alone in its bucket on the way there.
    """
    n = len(data)
    left = np.repeat(np.cumsum(size), size) - np.arange(n)  # bytes up to the segment's end
    pointer = np.zeros(n, np.int64)
    active = np.flatnonzero(left >= length)
    first = np.flatnonzero(left >= 8)
    if not len(active):
        return pointer
    _, ids, counts = np.unique(grams8(data)[first].byteswap(), return_inverse=True,
                               return_counts=True)
    pointer[first] = ids + 1
    alive = np.zeros(n, bool)
    alive[first] = counts[ids] > 1
    depth, top = 8, len(counts) + 1
    while depth < length:
        step = min(depth, length - depth)
        able = np.flatnonzero(alive & (left >= depth + step))
        pair = pointer[able] * top + pointer[able + step]
        _, ids, counts = np.unique(pair, return_inverse=True, return_counts=True)
        pointer = pointer.copy()
        pointer[able] = top + ids  # a suffix that is not refined keeps its own identifier
        alive = np.zeros(n, bool)
        alive[able] = counts[ids] > 1
        depth, top = depth + step, top + len(counts)
    return np.where(alive & (left >= length), pointer, 0)


def _refine_segments(table: pa.Table, length: int) -> pa.Table:
    rows = table.select(["g", "bucket", "seen", "keys", "flags", "docs", "segments"]).to_pylist()
    heads = [np.frombuffer(r["keys"], np.int64).reshape(2, -1) for r in rows]
    anchor, size = np.concatenate(heads, axis=1)
    doc = np.concatenate([np.frombuffer(r["docs"], np.int64) for r in rows])
    data = np.frombuffer(b"".join(r.pop("segments") for r in rows), np.uint8)
    offset = np.cumsum(size) - size
    below = np.zeros(len(data), bool)
    # equal windows have equal anchors, so anchors are refined some at a time
    order = np.argsort(anchor, kind="stable")
    total = np.cumsum(size[order])
    a = 0
    while a < len(order):
        b = max(a + 1, int(np.searchsorted(total, total[a] + REFINED)))
        while b < len(order) and anchor[order[b]] == anchor[order[b - 1]]:
            b += 1
        part = order[a:b]
        at = _places(offset[part], size[part])
        below[at] = _least_below(data[at], size[part], np.repeat(doc[part], size[part]), length)
        a = b
    out, at = [], 0
    for r, head in zip(rows, heads):
        end = at + int(head[1].sum())
        out.append((r["g"], r["bucket"], r["seen"], None, r["flags"], None, pack_bits(below[at:end])))
        at = end
    return rows_table(out, _ASK_ARROW)


def _places(offset: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The indexes of all bytes of segments, one segment after the other."""
    return np.repeat(offset - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))


def _least_below(data: np.ndarray, size: np.ndarray, doc: np.ndarray, length: int) -> np.ndarray:
    """Whether a smaller document has the ``length`` bytes from a place on."""
    ids, found = np.unique(refine(data, size, length), return_inverse=True)
    least = np.full(len(ids), np.iinfo(np.int64).max)
    np.minimum.at(least, found, doc)
    return (least[found] < doc) & (ids[found] > 0)


def _cut(docs: pa.Table, replies: pa.Table, length: int, q: int, buckets: int) -> pa.Table:
    if not docs.num_rows:
        return _OUT_ARROW.empty_table()
    group, rows = _seen_group(docs, replies, length, q, buckets)
    n = len(group.data)
    edge = np.zeros(n + 1, np.int32)

    def remove(at: np.ndarray, windows: np.ndarray) -> None:
        np.add.at(edge, at, 1)
        np.add.at(edge, at + windows + length - 1, -1)

    below = np.zeros(len(group.key), bool)
    inside = {}  # of the contexts looked into, the windows that go
    for b, x, y in bucket_slices(group.key, buckets):
        flags = unpack_bits(rows[b]["flags"], 2 * (y - x))
        below[x:y] = flags[:y - x]
        classes = np.flatnonzero(flags[y - x:]) + x
        sizes = group.windows[group.sample[classes]] + length - 1
        bits = unpack_bits(rows[b]["segments"] or b"", int(sizes.sum()))
        for c, e, s in zip(classes.tolist(), np.cumsum(sizes).tolist(), sizes.tolist()):
            part = np.flatnonzero(bits[e - s:e])
            if len(part):
                inside[c] = part
    all_go = below[group.class_of] | (group.doc > group.least[group.class_of])
    remove(group.start[all_go], group.windows[all_go])
    if inside:
        some = np.zeros(len(group.key), bool)
        some[list(inside)] = True
        for i in np.flatnonzero(some[group.class_of] & ~all_go).tolist():
            part = group.start[i] + inside[group.class_of[i]]
            remove(part, np.ones(len(part), np.int64))
    gone = np.cumsum(edge[:-1]) > 0
    total = np.concatenate([[0], np.cumsum(gone)])
    end = group.offset + group.size
    n_removed = total[end] - total[group.offset]
    kept, spans = [], []
    for a, e, r in zip(group.offset.tolist(), end.tolist(), n_removed.tolist()):
        mine = gone[a:e]
        kept.append((group.data[a:e][~mine] if r else group.data[a:e]).tobytes())
        spans.append(int(mine[:1].sum() + (mine[1:] & ~mine[:-1]).sum()) if r else 0)
    return pa.table([group.ids.cast(pa.int64()), pa.array(group.size), pa.array(n_removed, pa.int64()),
                     pa.array(spans, pa.int64()), pa.array(kept, pa.binary())], schema=_OUT_ARROW)


def dedup_suffixes(docs: DataFrame, length: int = LENGTH, q: int = Q) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept)``; ``8 <= q <= length``, ``length >= 16``."""
    deal = Deal.of(docs.sparkSession)
    scan = {"length": length, "q": q, "buckets": len(deal.buckets)}
    by_group = grouped(docs, deal).groupBy("g")

    def answered(asks: DataFrame, reply, **bound) -> DataFrame:
        return deal.by_bucket(asks).applyInArrow(on_table(reply, **bound), _ASK)

    def asking(replies: DataFrame, ask) -> DataFrame:
        return by_group.cogroup(replies.groupBy("g")).applyInArrow(on_tables(ask, **scan), _ASK)

    anchors = by_group.applyInArrow(on_table(_send_anchors, **scan), _ASK)
    repeated = answered(anchors, _count_anchors)
    compared = answered(asking(repeated, _send_contexts), _compare_contexts)
    refined = answered(asking(compared, _send_segments), _refine_segments, length=length)
    return by_group.cogroup(refined.groupBy("g")).applyInArrow(on_tables(_cut, **scan), _OUT)
