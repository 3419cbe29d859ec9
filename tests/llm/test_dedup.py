"""Operators 4, 6, 7 and 8 against plain Python, with nulls, ties, copies and odd columns."""

import random
from collections import Counter

import numpy as np
import pytest

from brute_llm import WORDS, components, cut_windows, shingles
from lodestar.llm import jaccard_join, line_dedup, substring_dedup, suffix_dedup
from lodestar.llm.bytescan import SegmentHash, Words, sliding_min
from lodestar.llm.exchange import bucket_of


def bag(rows):
    return Counter(tuple(r) for r in rows)


def test_words_are_split_at_the_six_spaces_only():
    w = Words([b"", b" a\x0bb\xc2\xa0c ", b"  ", b"d\x1ce"])
    got = [w.data[a:b].tobytes() for a, b in zip(w.start, w.end)]
    assert got == [b"a", b"b\xc2\xa0c", b"d\x1ce"]
    assert w.first.tolist() == [0, 0, 2, 2, 3]


def test_segment_hashes_depend_on_bytes_only():
    h = SegmentHash(1)
    data = np.frombuffer(b"abcabcabd", np.uint8)
    x = h(data, np.array([0, 3, 6]), np.array([3, 6, 9]))
    assert x[0] == x[1] != x[2]


def test_sliding_min():
    x = np.random.default_rng(0).integers(0, 1000, 50, dtype=np.uint64)
    for w in (1, 2, 3, 7, 27):
        assert sliding_min(x, w).tolist() == [x[i:i + w].min() for i in range(51 - w)]


def test_substrings(frame, odd):
    got = substring_dedup.dedup_substrings(frame(odd)).collect()
    seqs = [(i, WORDS.findall(t or "")) for i, t in odd]
    want = [(i, len(x), len(x) - sum(k), " ".join(w for w, y in zip(x, k) if y))
            for (i, x), k in zip(seqs, cut_windows(seqs, 50))]
    assert bag(got) == bag(want)
    assert sum(r[2] for r in want) > 500
    assert substring_dedup.dedup_substrings(frame([])).collect() == []


def test_suffixes(frame, odd):
    got = suffix_dedup.dedup_suffixes(frame(odd)).collect()
    seqs = [(i, (t or "").encode()) for i, t in odd]
    want = []
    for (i, x), k in zip(seqs, cut_windows(seqs, 50)):
        spans = sum(not b and (a == 0 or k[a - 1]) for a, b in enumerate(k))
        want.append((i, len(x), len(x) - sum(k), spans, bytes(c for c, y in zip(x, k) if y)))
    assert bag((*r[:4], bytes(r[4])) for r in got) == bag(want)
    assert suffix_dedup.dedup_suffixes(frame([])).collect() == []


def test_bucket_pointers_tell_equal_prefixes():
    rng = np.random.default_rng(3)
    parts = [rng.integers(97, 99, n).astype(np.uint8) for n in (70, 16, 200, 40, 15)]
    data, size = np.concatenate(parts), np.array([len(x) for x in parts])
    for length in (16, 20, 32):
        ids = suffix_dedup.refine(data, size, length)
        ends = np.repeat(np.cumsum(size), size)
        text = {}
        for p in range(len(data)):
            if p + length <= ends[p]:
                text.setdefault(data[p:p + length].tobytes(), []).append(p)
        for places in text.values():
            assert len({ids[p] for p in places}) == 1
            assert (ids[places[0]] > 0) == (len(places) > 1)
        assert len({ids[x[0]] for x in text.values() if len(x) > 1}) == sum(len(x) > 1 for x in text.values())


def test_line_runs(frame, spark, odd):
    # distinct ids, so that the order of texts with one id does not matter
    rows = [(i, t) for n, (i, t) in enumerate(odd) if i is not None and i not in [x for x, _ in odd[:n]]]
    rows += [rows[-1], rows[0]]  # equal rows are one document
    kept = line_dedup.dedup_lines(frame(rows))
    assert kept.columns == frame([]).columns
    got = kept.select("doc_id", "text", "n_chars").collect()
    seqs = {}
    for i, t in rows:
        lines = (t or "").split("\n")
        seqs[i] = lines, [n for n, x in enumerate(lines) if WORDS.search(x)]
    one, two = {}, {}
    for i in sorted(seqs):
        lines, full = seqs[i]
        for s, n in enumerate(full):
            one.setdefault(lines[n], (i, s))
            if s + 1 < len(full):
                two.setdefault((lines[n], lines[full[s + 1]]), (i, s))
    want = []
    for i, t in rows:
        lines, full = seqs[i]
        gone = set()
        for s, n in enumerate(full):
            if one[lines[n]] < (i, s) and len(WORDS.findall(lines[n])) >= 20:
                gone.add(n)
            if s + 1 < len(full) and two[lines[n], lines[full[s + 1]]] < (i, s):
                gone |= {n, full[s + 1]}
        x = None if t is None else "\n".join(y for n, y in enumerate(lines) if n not in gone)
        want.append((i, x, None if x is None else len(x)))
    assert bag(got) == bag(want)
    assert sum(a[1] != b[1] for a, b in zip(rows, want)) >= 5
    fewer = line_dedup.dedup_lines(frame(rows), keep_rows=False)
    assert fewer.count() < len(rows)
    assert line_dedup.dedup_lines(frame([])).collect() == []


def test_longer_runs_take_more_rounds(frame):
    run = [f"line {i}" for i in range(6)]
    rows = [(1, "\n".join(run)), (2, "\n".join(["a", *run[:4], "b"])), (3, "\n".join(["c", *run[2:], "d"])),
            (4, "\n".join(run[:3]))]
    kept = line_dedup.dedup_lines(frame(rows), min_lines=4, long_line=0)
    assert {r["doc_id"]: r["text"] for r in kept.collect()} == {
        1: rows[0][1], 2: "a\nb", 3: "c\nd", 4: rows[3][1]}


def test_maximal_line_runs(frame, monkeypatch):
    rng = random.Random(11)
    # few different lines, so that runs of many lengths repeat within and across documents
    docs = {i: [rng.choice("abcd") for _ in range(rng.randrange(1, 30))] for i in range(12)}
    docs[20], docs[21] = docs[3] + docs[5], ["e"] + docs[5] + docs[3] + ["e"]
    docs[22] = ["p"] * 17
    docs[23] = [f"row {i}" for i in range(13)]
    docs[24] = ["e", "f", *docs[23], "g"]
    rows = [(i, "\n".join(x)) for i, x in docs.items()] + [(20, "\n".join(docs[20]))]  # one row twice
    lines = line_dedup.line_ids(frame(rows))
    for least, limit in ((1, 0), (3, 10 ** 5)):  # joined by shuffle, by broadcast
        monkeypatch.setattr(line_dedup, "BROADCAST_ROWS", limit)
        longest = {}  # the longest run from each place on that an earlier place has as well
        places = [(i, s) for i in sorted(docs) for s in range(len(docs[i]))]
        for n, (i, s) in enumerate(places):
            for j, r in places[:n]:
                x, y = docs[i][s:], docs[j][r:]
                same = next((k for k, (a, b) in enumerate(zip(x, y)) if a != b), min(len(x), len(y)))
                longest[i, s] = max(longest.get((i, s), 0), same)
        want, reach = set(), {}
        for i, s in places:  # not inside a longer one
            n = longest.get((i, s), 0)
            if n >= least and s + n > reach.get(i, 0):
                want.add((i, s, n))
                reach[i] = s + n
        runs = line_dedup.repeated_runs(lines, least, 0).collect()
        got = {(r["doc_id"], r["seq"], r["lines"]) for r in runs}
        assert len(runs) == len(got)
        covered = lambda found: {(i, s + k) for i, s, n in found for k in range(n)}
        assert covered(got) == covered(want)
        for r in runs:  # each repeats an earlier place
            f, n = r["first"], r["lines"]
            assert (f["doc_id"], f["seq"]) < (r["doc_id"], r["seq"])
            assert docs[f["doc_id"]][f["seq"]:f["seq"] + n] == docs[r["doc_id"]][r["seq"]:r["seq"] + n]
            assert n >= least
        assert [(s, n) for i, s, n in got if i == 24 and s > 1] == [(2, 13)]


def test_jaccard(frame, odd):
    got = jaccard_join.jaccard_components(frame(odd)).collect()
    sets = [(i, shingles(t)) for i, t in odd]
    want = [(i, len(s), c) for (i, s), c in zip(sets, components(sets))]
    assert bag(got) == bag(want)
    assert jaccard_join.jaccard_components(frame([])).collect() == []


def test_overlaps(monkeypatch):
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 90, int(n), dtype=np.uint64)) for n in rng.integers(1, 60, 30)]
    want = [[len(np.intersect1d(x, y)) for y in sets] for x in sets]
    for dense, columns in ((2, 7), (8, 1024), (40, 3)):
        monkeypatch.setattr(jaccard_join, "DENSE", dense)
        monkeypatch.setattr(jaccard_join, "COLUMNS", columns)
        got = jaccard_join.overlaps(sets)
        assert all(got[i][j] == want[i][j] for i in range(30) for j in range(30) if i != j), dense


def test_a_crowd_of_near_copies_costs_no_row_a_pair(frame, monkeypatch):
    """Copies about as far from each other as links reach, in several blocks."""
    rng = random.Random(11)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(120):
        w = list(base)
        for at in rng.sample(range(120), rng.choice((1, 4, 5, 6, 7))):
            w[at] = f"new{i}x{at}"
        rows.append((i, " ".join(w)))
    sets = [(i, shingles(t)) for i, t in rows]
    want = [(i, len(s), c) for (i, s), c in zip(sets, components(sets))]
    assert 10 < len({c for *_, c in want}) < 110
    able, pairs = jaccard_join._able, []
    monkeypatch.setattr(jaccard_join, "_able", lambda counted, *a: pairs.append(counted.count()) or able(counted, *a))
    monkeypatch.setattr(jaccard_join, "BLOCK_NODES", 40)
    assert bag(jaccard_join.jaccard_components(frame(rows)).collect()) == bag(want)
    assert max(pairs) <= 2 * len(rows)
    monkeypatch.setattr(jaccard_join, "TILE_GAIN", 0)  # left to their signatures
    assert bag(jaccard_join.jaccard_components(frame(rows)).collect()) == bag(want)


def test_signatures_miss_no_pair():
    """Any two sets at the limit share a signature, whatever tokens count as frequent."""
    rng = np.random.default_rng(9)
    for n in list(range(2, 40)) + [100, 257, 700]:
        for _ in range(6):
            x = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
            drop = int(rng.integers(0, len(x) // 4 + 1))
            y = rng.choice(x, len(x) - drop, replace=False)
            y = np.unique(np.append(y, rng.integers(0, 2**63, int(rng.integers(0, 4)), dtype=np.uint64)))
            both = len(np.intersect1d(x, y))
            if 100 * both < 75 * (len(x) + len(y) - both):
                continue
            for share in (0, 3, 60, 95, 100):
                hits = lambda t: (t % np.uint64(100) < share).astype(np.uint32) * 10  # noqa: E731, B023
                a, beyond = jaccard_join.signatures(x, hits(x), 5, 75)
                b, beyond_b = jaccard_join.signatures(y, hits(y), 5, 75)
                common = len(np.intersect1d(a, b))
                assert common, (n, share)
                if (beyond, beyond_b) != (None, None):
                    assert both <= common + max(beyond or 0, beyond_b or 0)


def test_frequent_tokens_stay_linear():
    x = np.unique(np.random.default_rng(2).integers(0, 2**63, 4000, dtype=np.uint64))
    assert len(jaccard_join.signatures(x, np.full(len(x), 9), 5, 75)[0]) < 3 * len(x)


@pytest.mark.parametrize("links,labels", [
    ([], {}), ([(1, 1)], {}), ([(2, 1), (1, 2), (2, 1)], {1: 1, 2: 1}),
    ([(i, i + 1) for i in range(40)], {i: 0 for i in range(41)}),
    ([(9, i) for i in range(1, 9)] + [(20, 21)], {**{i: 1 for i in range(1, 10)}, 20: 20, 21: 20})])
def test_components(spark, links, labels):
    from lodestar.llm.components import components as find

    got = find(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    assert {r["node"]: r["label"] for r in got} == labels and len(got) == len(labels)


def test_runs_do_not_depend_on_the_block(monkeypatch):
    rng = np.random.default_rng(8)
    data = np.concatenate([rng.integers(97, 100, 700), np.full(150, 120)]).astype(np.uint8)
    window = np.ones(len(data) - 49, bool)
    window[300:349] = False
    whole = suffix_dedup._runs(data, window, 50, 24)
    for scan in (1, 7, 64):
        monkeypatch.setattr(suffix_dedup, "SCAN", scan)
        again = suffix_dedup._runs(data, window, 50, 24)
        assert [x.tolist() for x in again] == [x.tolist() for x in whole]


def test_anchors_spread_over_the_buckets():
    """Each bucket gets about its share of the contexts, and equal windows have equal anchors."""
    rng = np.random.default_rng(11)
    data = rng.integers(97, 123, 200_000).astype(np.uint8)
    _, anchors = suffix_dedup._runs(data, np.ones(len(data) - 49, bool), 50, 24)
    sizes = np.bincount(bucket_of(np.unique(anchors), 50).astype(int), minlength=50)
    assert sizes.max() < 2 * sizes.mean() and sizes.min() > sizes.mean() / 2
    same = suffix_dedup._anchors(np.concatenate([data[:300], data[:300]]), 50, 24)
    assert same[:200].tolist() == same[300:500].tolist()
