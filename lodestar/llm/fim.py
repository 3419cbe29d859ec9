"""Fill-in-the-middle transformation of documents, as a pyarrow.compute pipeline.

Every text is cut at two points into prefix, middle and suffix, and written as

* psm: ``<P>`` prefix ``<S>`` suffix ``<M>`` middle, or
* spm: ``<S>`` suffix ``<P>`` prefix ``<M>`` middle;

the rest stays plain: a share of the documents, empty texts, and texts that hold one of the
marks, so that ``restore`` rebuilds every text exactly.  Draws come from a hash of the id, so
runs and retries agree, and nothing is shuffled: a document is handled where it is read.

Per Arrow batch, in blocks of bounded bytes that may begin and end inside a document:

1. texts are split into units (code points, or words with the white space after them): a list
   array over the text's own bytes, of which only the offsets are new;
2. ``list_flatten`` and ``list_parent_indices`` give every unit with its document, and the
   difference to the document's first unit is its ordinal;
3. units are filtered by role (ordinal before the first cut, between the cuts, behind them),
   and lists are rebuilt from what is left for each document;
4. ``binary_join`` makes the pieces of a block; the pieces of a document's blocks are joined
   once more, and ``binary_join_element_wise`` sets the marks.

Cases: null text is empty (plain, no units); a null ``doc_id`` draws like an empty id; rows that
repeat a ``doc_id`` draw alike and are handled one by one; a very long text is handled in many
blocks; an empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import SPACES

MARKS = ("<P>", "<S>", "<M>")
FIM_PERCENT = 90
SPM_PERCENT = 20
UNITS = ("character", "word")
BLOCK_BYTES = 1 << 20  # units of one block are in memory with their offsets and ordinals
GROUP_BYTES = 8 << 20  # rows of one result batch, by bytes of text

_SCHEMA = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"


def draws(doc_id: Column, seed: int, count: int = 4) -> list[Column]:
    """The first ``count`` 8-digit groups of the hex SHA-256 of ``seed:doc_id``, as integers."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(count)]


def _starts(data: np.ndarray, offsets: np.ndarray, unit: str) -> np.ndarray:
    """Per byte: does a unit start here?  Texts lie end to end, at ``offsets``."""
    if unit == "character":
        return (data & 0xC0) != 0x80
    blank = np.isin(data, np.frombuffer(SPACES, np.uint8))
    starts = ~blank
    starts[1:] &= blank[:-1]
    starts[offsets[:-1][offsets[:-1] < offsets[1:]]] = True  # of every text that has bytes
    return starts


def _joined(pieces: list[pa.Array], owners: list[np.ndarray], rows: int) -> pa.Array:
    """Pieces of one role, in order, joined per document."""
    if not pieces:
        return pa.array([""] * rows, pa.string())
    counts = np.bincount(np.concatenate(owners), minlength=rows)
    offsets = np.concatenate([[0], np.cumsum(counts)])
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.concat_arrays(pieces)), "")


def cut_texts(data: pa.Buffer, offsets: np.ndarray, starts: np.ndarray, first: np.ndarray,
              second: np.ndarray, block_bytes: int = BLOCK_BYTES) -> list[pa.Array]:
    """Prefix, middle and suffix of each text; ``first`` and ``second`` count units.

    ``data[offsets[i]:offsets[i + 1]]`` is text ``i``, ``starts`` marks the bytes where units start.
    """
    rows, size = len(offsets) - 1, int(offsets[-1])
    pieces: list[list[pa.Array]] = [[], [], []]
    owners: list[list[np.ndarray]] = [[], [], []]
    done = np.zeros(rows, np.int64)  # units of a text that earlier blocks held
    lo = 0
    while lo < size:
        hi = min(size, lo + block_bytes)
        while hi < size:  # on to the next start of a unit
            ahead = np.flatnonzero(starts[hi:hi + block_bytes])
            if len(ahead):
                hi += int(ahead[0])
                break
            hi = min(size, hi + block_bytes)
        at = np.flatnonzero(starts[lo:hi]) + lo
        units = pa.StringArray.from_buffers(
            len(at), pa.py_buffer(np.append(at, hi).astype(np.int32)), data)
        a = int(np.searchsorted(offsets, lo, side="right")) - 1  # the text that holds lo
        b = int(np.searchsorted(offsets, hi, side="left"))
        lists = pa.ListArray.from_arrays(
            pa.array(np.searchsorted(at, np.clip(offsets[a:b + 1], lo, hi)), pa.int32()), units)
        flat, parent = pc.list_flatten(lists), pc.list_parent_indices(lists)
        begin = pa.array(np.asarray(lists.offsets)[:-1] - done[a:b], pa.int64())
        ordinal = pc.subtract(pa.array(np.arange(len(flat))), pc.take(begin, parent))
        before = pc.less(ordinal, pc.take(pa.array(first[a:b]), parent))
        behind = pc.greater_equal(ordinal, pc.take(pa.array(second[a:b]), parent))
        for role, chosen in enumerate((before, pc.invert(pc.or_(before, behind)), behind)):
            kept = np.bincount(np.asarray(pc.filter(parent, chosen)), minlength=b - a)
            rebuilt = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(kept)]), pa.int32()), pc.filter(flat, chosen))
            pieces[role].append(pc.binary_join(rebuilt, ""))
            owners[role].append(np.arange(a, b))
        done[a:b] += np.asarray(pc.list_value_length(lists))
        lo = hi
    return [_joined(p, o, rows) for p, o in zip(pieces, owners)]


def _arranged(batch: pa.RecordBatch, unit: str, marks: tuple[str, str, str], fim_percent: int,
              spm_percent: int) -> pa.RecordBatch:
    text = pc.fill_null(batch.column("text"), "")
    if text.offset:
        text = pa.concat_arrays([text])
    h = [np.asarray(batch.column(f"h{i}")) for i in range(1, 5)]
    offsets = np.frombuffer(text.buffers()[1], np.int32, len(text) + 1).astype(np.int64)
    data = text.buffers()[2] or pa.py_buffer(b"")
    low = int(offsets[0])
    data, offsets = data.slice(low, int(offsets[-1]) - low), offsets - low
    starts = _starts(np.frombuffer(data, np.uint8), offsets, unit)
    n = np.zeros(len(text), np.int64)
    some = offsets[:-1] < offsets[1:]
    if some.any():
        n[some] = np.add.reduceat(starts, offsets[:-1][some], dtype=np.int64)

    plain = (n == 0) | (h[2] % 100 >= fim_percent)
    for m in marks:
        plain |= np.asarray(pc.match_substring(text, m))
    spm = h[3] % 100 < spm_percent
    x, y = h[0] % (n + 1), h[1] % (n + 1)
    first, second = np.minimum(x, y), np.maximum(x, y)
    form = pa.array(np.where(plain, "plain", np.where(spm, "spm", "psm")), pa.string())
    output = text
    if not plain.all():
        prefix, middle, suffix = cut_texts(data, offsets, starts, first, second)
        p, s, m = (pa.scalar(k) for k in marks)
        output = pc.if_else(pa.array(plain), text, pc.if_else(
            pa.array(spm), pc.binary_join_element_wise(s, suffix, p, prefix, m, middle, ""),
            pc.binary_join_element_wise(p, prefix, s, suffix, m, middle, "")))
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id"), pa.array(n), form, pa.array(first, mask=plain),
         pa.array(second - first, mask=plain), output],
        ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])


def groups(batch: pa.RecordBatch, column: str, limit: int = GROUP_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in slices of at most ``limit`` bytes of ``column`` (one row at least)."""
    size = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
    total = np.concatenate([[0], np.cumsum(size)])
    lo = 0
    while lo < batch.num_rows:
        hi = max(lo + 1, int(np.searchsorted(total, total[lo] + limit, side="right")) - 1)
        yield batch.slice(lo, hi - lo)
        lo = hi


def fill_in_middle(docs: DataFrame, seed: int = 1, fim_percent: int = FIM_PERCENT,
                   spm_percent: int = SPM_PERCENT, marks: tuple[str, str, str] = MARKS,
                   unit: str = "character") -> DataFrame:
    """``(doc_id, n, form, prefix_chars, middle_chars, output)``, a row per document.

    ``n`` and the two lengths count units; the lengths are null in plain documents.  ``marks``
    begin the prefix, the suffix and the middle; they must not overlap each other or themselves
    (none may begin as another one ends), else ``restore`` could misread a text.
    """
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {UNITS}")
    if len(set(marks)) != 3 or any(a[-k:] == b[:k] for a in marks for b in marks
                                   for k in range(1, min(len(a), len(b)))):
        raise ValueError("marks must differ and must not overlap")

    def run(batches):
        for batch in batches:
            for part in groups(batch, "text"):
                yield _arranged(part, unit, marks, fim_percent, spm_percent)

    h = draws(F.col("doc_id"), seed)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       *[x.alias(f"h{i}") for i, x in enumerate(h, 1)])
    return rows.mapInArrow(run, _SCHEMA)


def restore(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The text that ``output`` was made of."""
    parts = F.split(output, "|".join("\\Q" + m + "\\E" for m in marks), -1)  # an empty one, then three
    at = lambda i: F.get(parts, F.lit(i))
    return (F.when(form == "psm", F.concat(at(1), at(3), at(2)))
            .when(form == "spm", F.concat(at(2), at(3), at(1))).otherwise(output))
