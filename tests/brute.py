"""Plain-Python brute force for the fixture corpus (independent of the Spark plans)."""

import math
from collections import Counter

import regex

from lodestar.functions.text import STOP_WORDS, T1_PATTERN, T3_PATTERN

DOCS = [
    (1, "The cat sat on the mat. The cat is happy."),
    (2, "A dog and a cat; the dog barked at the cat!"),
    (3, "Markets rose 3.5 percent as the economy recovered."),
    (4, "The the the of of the"),
    (5, ""),
    (6, "word"),
    (7, "Cat-like reflexes: the cat, the dog, the mouse."),
    (8, "null amp quot example of a 3com deal"),
    (9, "dog cat dog cat dog"),
]


def t1(text):
    return [t for t in regex.sub(T1_PATTERN, " ", text.lower()).split(" ") if t]


def t2(text):
    return [t for t in t1(text) if t not in STOP_WORDS]


def t3_positions(text):
    pieces = regex.sub(T3_PATTERN, " ", text.lower()).split(" ")
    return [(i + 1, p) for i, p in enumerate(pieces) if p and not regex.search(r"\d", p)]


def postings(docs=DOCS):
    return {(term, d): n for d, text in docs for term, n in Counter(t1(text)).items()}


def doc_len(docs=DOCS):
    return {d: len(t1(text)) for d, text in docs}


def stats(docs=DOCS):
    lens = doc_len(docs)
    n = len(docs)
    return n, sum(lens.values()), sum(lens.values()) / n


def df(docs=DOCS):
    return Counter(term for term, _ in postings(docs))


def bm25_weights(docs=DOCS, k1=1.2, b=0.75):
    n, _, avgdl = stats(docs)
    dfs, lens = df(docs), doc_len(docs)
    out = {}
    for (term, d), tf in postings(docs).items():
        idf = math.log(n / dfs[term])
        out[(term, d)] = idf * ((k1 + 1) * tf) / (k1 * ((1 - b) + b * lens[d] / avgdl) + tf)
    return out


def tfidf_weights(docs=DOCS):
    n, _, _ = stats(docs)
    dfs = df(docs)
    return {(t, d): (1 + math.log(tf)) * math.log(n / dfs[t]) for (t, d), tf in postings(docs).items()}


def top(scores, k):
    ranked = sorted(scores.items(), key=lambda kv: (-round(kv[1], 6), kv[0]))[:k]
    return [(d, round(s, 6)) for d, s in ranked]


def bm25_search(words, k=20, docs=DOCS):
    w = bm25_weights(docs)
    q = set(x.lower() for x in words)
    scores = Counter()
    for (t, d), v in w.items():
        if t in q:
            scores[d] += v
    return top({d: s / 2 for d, s in scores.items()}, k)


def tfidf_search(words, k=20, cosine=False, docs=DOCS):
    w = tfidf_weights(docs)
    n, _, _ = stats(docs)
    dfs = df(docs)
    qtf = Counter(x.lower() for x in words)
    acc = {}
    for (t, d), dw in w.items():
        if t in qtf:
            c = qtf[t]
            qw = (1 + math.log(c)) * math.log(n / dfs[t])
            s = acc.setdefault(d, [0.0, 0.0, 0.0, 0.0])
            s[0] += c * qw * dw
            s[1] += c * qw * qw
            s[2] += c * dw * dw
            s[3] += c * dw
    if cosine:
        scores = {d: (s[0] / (math.sqrt(s[1]) * math.sqrt(s[2])) if s[1] * s[2] > 0 else None)
                  for d, s in acc.items()}
        scores = {d: v for d, v in scores.items() if v is not None}
    else:
        scores = {d: s[3] / 2 for d, s in acc.items()}
    return top(scores, k)


def proximity_pairs(w1, w2, delta, docs=DOCS):
    out = {}
    for d, text in docs:
        pos = t3_positions(text)
        a = [p for p, t in pos if t == w1]
        b = [p for p, t in pos if t == w2]
        n = sum(1 for x in a for y in b if abs(x - y) == delta)
        if n:
            out[d] = n
    return out
