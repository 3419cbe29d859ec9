"""Substring de-duplication over word windows, behind a count-min prefilter.

A window is ``width`` consecutive words of one document.  A word is removed when a window
that covers it also starts in a document with a smaller ``doc_id``.

1. Every group of documents builds its part of a count-min sketch: the slots its windows
   fall into, each slot once with a flag when the group hits it again.  The parts are merged
   bucket by bucket; a merged count is never below the true one, since collisions only add.
2. Each group learns which of its slots count two or more, and sends the exact 128-bit keys
   of only those windows, each with the smallest ``doc_id`` that has it in the group.  The
   bucket finds the smallest of all, and answers whether it lies below the group's own.

The sketch grows with the data because its buckets do (``spark.sql.shuffle.partitions``), so
it stays selective at any size, and no task holds more than one bucket of it.

Cases: null text is empty and null ``doc_id`` is a document that neither removes nor loses
words; rows that repeat a ``doc_id`` are separate texts that never remove each other's words;
shorter documents than ``width`` stay whole; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lodestar.llm.bytescan import SegmentHash, Words, texts_of
from lodestar.llm.exchange import (
    Deal, bucket_of, bucket_slices, grouped, merge_counts, on_table, on_tables, pack_bits,
    rows_table, unpack_bits,
)

WIDTH = 50

_ASK = "g int, bucket int, keys binary, flags binary, docs binary"
_REPLY = "g int, bucket int, seen binary, bits binary"
_OUT = "doc_id bigint, n_words bigint, n_removed bigint, kept string"
_OUT_ARROW = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()),
                        ("n_removed", pa.int64()), ("kept", pa.string())])

_FIRST, _SECOND = SegmentHash(81), SegmentHash(82)


class _Group:
    """The windows of one group, and the sketch slots they fall into."""

    def __init__(self, table: pa.Table, width: int, buckets: int):
        self.ids = table.column("doc_id")
        self.words = w = Words(texts_of(table.column("text").combine_chunks()))
        first, text = w.windows(width)
        known = np.asarray(self.ids.is_valid())[text]
        self.first, text = first[known], text[known]
        self.doc = self.ids.fill_null(0).to_numpy()[text]
        self.start, self.end = w.start[self.first], w.end[self.first + width - 1]
        self.hash = _FIRST(w.data, self.start, self.end)
        bucket = bucket_of(self.hash, buckets)
        slot = (bucket << np.uint64(32)) | (self.hash & np.uint64(0xFFFFFFFF))
        self.slots, self.slot_of, self.hits = np.unique(
            slot, return_inverse=True, return_counts=True)

    def sketch(self):
        bucket = (self.slots >> np.uint64(32)).astype(np.int64)
        cuts = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(bucket)]
        return [(int(bucket[a]), a, b) for a, b in zip(cuts, cuts[1:]) if b > a]

    def keep_seen(self, seen: dict[int, bytes]) -> None:
        """Keep the windows estimated repeated, and merge their exact keys."""
        flag = np.zeros(len(self.slots), bool)
        for b, x, y in self.sketch():
            if b in seen:
                flag[x:y] = unpack_bits(seen[b], y - x)
        at = np.flatnonzero(flag[self.slot_of])
        self.first, self.doc, h1 = self.first[at], self.doc[at], self.hash[at]
        h2 = _SECOND(self.words.data, self.start[at], self.end[at])
        order = np.lexsort((self.doc, h2, h1))
        h1, h2 = h1[order], h2[order]
        new = np.ones(len(order), bool)
        new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        self.key_of = np.empty(len(order), np.int64)
        self.key_of[order] = np.cumsum(new) - 1
        self.h1, self.h2, self.least = h1[new], h2[new], self.doc[order][new]


_ASK_ARROW = pa.schema([("g", pa.int32()), ("bucket", pa.int32()), ("keys", pa.binary()),
                        ("flags", pa.binary()), ("docs", pa.binary())])
_REPLY_ARROW = pa.schema([("g", pa.int32()), ("bucket", pa.int32()), ("seen", pa.binary()),
                          ("bits", pa.binary())])


def _send_sketch(table: pa.Table, width: int, buckets: int) -> pa.Table:
    group, g = _Group(table, width, buckets), table.column("g")[0].as_py()
    return rows_table([(g, b, group.slots[x:y].astype(np.uint32).tobytes(),
                   pack_bits(group.hits[x:y] > 1), None) for b, x, y in group.sketch()], _ASK_ARROW)


def _merge_sketches(table: pa.Table) -> pa.Table:
    return rows_table([(g, b, bits, None) for g, b, bits in merge_counts(table, np.uint32)],
                      _REPLY_ARROW)


def _send_keys(docs: pa.Table, replies: pa.Table, width: int, buckets: int) -> pa.Table:
    if not docs.num_rows or not replies.num_rows:
        return rows_table([], _ASK_ARROW)
    group, g = _Group(docs, width, buckets), docs.column("g")[0].as_py()
    seen = dict(zip(replies.column("bucket").to_pylist(), replies.column("seen").to_pylist()))
    group.keep_seen(seen)
    return rows_table([(g, b, group.h1[x:y].tobytes() + group.h2[x:y].tobytes(), seen[b],
                   group.least[x:y].tobytes()) for b, x, y in bucket_slices(group.h1, buckets)],
                 _ASK_ARROW)


def _least_docs(table: pa.Table) -> pa.Table:
    rows = table.to_pylist()
    least = [np.frombuffer(r["docs"], np.int64) for r in rows]
    keys = [np.frombuffer(r["keys"], np.uint64).reshape(2, -1) for r in rows]
    (h1, h2), doc = np.concatenate(keys, axis=1), np.concatenate(least)
    order = np.lexsort((doc, h2, h1))
    new = np.ones(len(order), bool)
    new[1:] = (h1[order][1:] != h1[order][:-1]) | (h2[order][1:] != h2[order][:-1])
    smallest = np.empty(len(order), np.int64)
    smallest[order] = doc[order][new][np.cumsum(new) - 1]
    below, at, out = smallest < doc, 0, []
    for r, part in zip(rows, least):
        out.append((r["g"], r["bucket"], r["flags"], pack_bits(below[at:at + len(part)])))
        at += len(part)
    return rows_table(out, _REPLY_ARROW)


def _cut(docs: pa.Table, replies: pa.Table, width: int, buckets: int) -> pa.Table:
    if not docs.num_rows:
        return _OUT_ARROW.empty_table()
    group = _Group(docs, width, buckets)
    bucket = replies.column("bucket").to_pylist()
    group.keep_seen(dict(zip(bucket, replies.column("seen").to_pylist())))
    bits = dict(zip(bucket, replies.column("bits").to_pylist()))
    below = np.zeros(len(group.h1), bool)
    for b, x, y in bucket_slices(group.h1, buckets):
        below[x:y] = unpack_bits(bits[b], y - x)
    gone = group.first[below[group.key_of] | (group.doc > group.least[group.key_of])]
    w = group.words
    edge = np.zeros(len(w.start) + 1, np.int64)
    np.add.at(edge, gone, 1)
    np.add.at(edge, gone + width, -1)
    kept = np.cumsum(edge[:-1]) == 0
    data, removed, texts = w.data.tobytes(), [], []
    for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist()):
        mine = kept[a:b]
        removed.append(int(b - a - mine.sum()))
        step = np.flatnonzero(np.diff(np.concatenate([[False], mine, [False]])))
        texts.append(b" ".join(data[w.start[a + x]:w.end[a + y - 1]]
                               for x, y in zip(step[0::2], step[1::2])))
    return pa.table([group.ids.cast(pa.int64()), pa.array(np.diff(w.first)), pa.array(removed, pa.int64()),
                     pa.array(texts, pa.large_binary()).cast(pa.string())], schema=_OUT_ARROW)


def dedup_substrings(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept)``: kept words joined by one space."""
    deal = Deal.of(docs.sparkSession)
    scan = {"width": width, "buckets": len(deal.buckets)}
    by_group = grouped(docs, deal).groupBy("g")
    sketches = by_group.applyInArrow(on_table(_send_sketch, **scan), _ASK)
    repeated = deal.by_bucket(sketches).applyInArrow(on_table(_merge_sketches), _REPLY)
    keys = by_group.cogroup(repeated.groupBy("g")).applyInArrow(
        on_tables(_send_keys, **scan), _ASK)
    smaller = deal.by_bucket(keys).applyInArrow(on_table(_least_docs), _REPLY)
    return by_group.cogroup(smaller.groupBy("g")).applyInArrow(on_tables(_cut, **scan), _OUT)
