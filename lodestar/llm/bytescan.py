"""Vectorised scans of UTF-8 bytes: words, n-gram values and segment hashes.

Everything here works on one task's batch of texts at a time and allocates a bounded
multiple of that batch.
"""

from __future__ import annotations

import numpy as np

from lodestar.llm.common import SPACES

U64 = np.uint64

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES)] = True
_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[_IS_SPACE] = 32
_LOWER = _PLAIN.copy()
_LOWER[65:91] += 32

BLOCK = 1 << 18  # segments hashed at once


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (every input bit reaches every output bit)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


class SegmentHash:
    """64-bit polynomial hashes of byte segments by one prefix sum.

    The powers of the odd base and of its inverse modulo 2**64 are kept for the longest
    block seen.  ``seed`` picks base and byte values, so two seeds give independent hashes.
    """

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.values = rng.integers(1, 2**63, 256, dtype=np.uint64)
        base = int(rng.integers(2**40, 2**62)) | 1
        self._bases = (base, pow(base, -1, 2**64))
        self._powers = (np.ones(1, U64), np.ones(1, U64))

    def _to(self, n: int) -> None:
        if len(self._powers[0]) <= n:
            m = max(n + 1, 2 * len(self._powers[0]))
            steps = [np.full(m, b, U64) for b in self._bases]
            for x in steps:
                x[0] = 1
            self._powers = tuple(np.cumprod(x) for x in steps)

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of ``data[starts[i]:ends[i]]``; starts and ends ascend."""
        out = np.empty(len(starts), U64)
        for a in range(0, len(starts), BLOCK):
            s, e = starts[a:a + BLOCK], ends[a:a + BLOCK]
            lo, hi = int(s[0]), int(e[-1])
            self._to(hi - lo)
            up, down = self._powers
            total = np.zeros(hi - lo + 1, U64)
            np.cumsum(self.values[data[lo:hi]] * up[:hi - lo], out=total[1:])
            out[a:a + BLOCK] = mix((total[e - lo] - total[s - lo]) * down[s - lo])
        return out


class Words:
    """Words of a batch of texts: ``data`` holds them parted by single spaces.

    Word ``i`` is ``data[start[i]:end[i]]`` and belongs to text ``text[i]``; ``first`` has the
    index of each text's first word, and one more entry for the end.
    """

    def __init__(self, texts: list[bytes], lower: bool = False):
        raw = np.frombuffer(b" ".join(texts), np.uint8)
        space = _IS_SPACE[raw]
        keep = ~space
        keep[1:] |= ~space[:-1]  # of a run of spaces, the first
        self.data = (_LOWER if lower else _PLAIN)[raw[keep]]
        space = self.data == 32
        inside = np.concatenate([[False], ~space, [False]])
        edge = np.flatnonzero(inside[1:] != inside[:-1])
        self.start, self.end = edge[0::2], edge[1::2]
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        before = np.concatenate([[0], np.cumsum(keep)])
        offsets = np.cumsum(lengths + 1) - (lengths + 1)
        self.first = np.append(
            np.searchsorted(self.start, before[np.minimum(offsets, len(raw))]), len(self.start))

    def windows(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """First word and text of every ``width`` consecutive words within one text."""
        counts = np.maximum(np.diff(self.first) - width + 1, 0)
        text = np.repeat(np.arange(len(counts)), counts)
        base = np.repeat(self.first[:-1] - (np.cumsum(counts) - counts), counts)
        return np.arange(len(text)) + base, text


def grams8(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place on as one integer (exact, no hash)."""
    if len(data) < 8:
        return np.zeros(0, U64)
    x = data.astype(U64)
    x = x[:-1] | (x[1:] << U64(8))
    x = x[:-2] | (x[2:] << U64(16))
    return x[:-4] | (x[4:] << U64(32))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, by doubling."""
    span, out = 1, x
    while span * 2 <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    if span < width:
        step = width - span
        out = np.minimum(out[:-step], out[step:])
    return out


def texts_of(column) -> list[bytes]:
    """UTF-8 bytes of an Arrow string column; null is empty."""
    import pyarrow as pa

    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def batches(table, limit: int = 8 << 20, text: str = "text", rows: int = 1 << 16):
    """Slices of an Arrow table with about ``limit`` text bytes and ``rows`` rows at most."""
    import pyarrow.compute as pc

    size = np.asarray(pc.fill_null(pc.binary_length(table.column(text)), 0).to_numpy())
    at = np.cumsum(size) // limit + np.arange(len(size)) // rows
    cuts = [0, *(np.flatnonzero(np.diff(at)) + 1).tolist(), table.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield table.slice(a, b - a)
