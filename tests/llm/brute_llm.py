"""Plain Python versions of the operators, for small inputs."""

import hashlib
import re

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def cut_windows(sequences, width):
    """``sequences`` of (id, items): per row, which items stay."""
    first = {}
    for i, x in sequences:
        if i is not None:
            for a in range(len(x) - width + 1):
                w = tuple(x[a:a + width])
                first[w] = min(first.get(w, i), i)
    out = []
    for i, x in sequences:
        keep = [True] * len(x)
        if i is not None:
            for a in range(len(x) - width + 1):
                if first[tuple(x[a:a + width])] < i:
                    keep[a:a + width] = [False] * width
        out.append(keep)
    return out


def shingles(text, width=5):
    w = WORDS.findall(lower(text or ""))
    return {tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def components(sets, percent=75):
    """``sets`` of (id, set): the least id reachable, per row."""
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, x) in enumerate(sets):
        for b in range(a):
            j, y = sets[b]
            if i is not None and j is not None and x and y and \
                    100 * len(x & y) >= percent * len(x | y):
                parent[root(a)] = root(b)
    least = {}
    for a, (i, _) in enumerate(sets):
        if i is not None:
            least[root(a)] = min(least.get(root(a), i), i)
    return [None if i is None else least[root(a)] for a, (i, _) in enumerate(sets)]
