"""Property tests: the Spark tokenizers against plain Python on random texts.

Texts mix letters, digits, punctuation, symbols, whitespace and the special words the
patterns delete ("null", "amp", "quot") or drop (stop words).  Characters are kept to
ones whose classes agree between Java and Python regex engines.
"""

import regex
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

import brute
from lodestar.functions.text import T1_PATTERN, T2_LEGACY_PATTERN, tokens

ATOMS = list("abcdefghijklmnopqrstuvwxyzABCXYZéèüß0123456789") + list(".,;:!?-'\"()$%&+<>=/ \t\n") + [
    "null", "amp", "quot", " the ", " a ", " of ", "3com", "&amp;", " in ", "an", "their",
]

texts = st.lists(st.lists(st.sampled_from(ATOMS), max_size=40).map("".join), min_size=1, max_size=25)


def py_tokens(text, profile):
    low = text.lower()
    if profile == "t2_legacy":
        pieces = regex.sub(T2_LEGACY_PATTERN, " ", low).split(" ")
        return [(i + 1, p) for i, p in enumerate(pieces) if p]
    if profile == "t3":
        return brute.t3_positions(text)
    pieces = regex.sub(T1_PATTERN, " ", low).split(" ")
    out = [(i + 1, p) for i, p in enumerate(pieces) if p]
    if profile == "t2":
        out = [(i, p) for i, p in out if p not in brute.STOP_WORDS]
    return out


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(batch=texts)
def test_tokenizers_match_python(spark, corpus_of, batch):
    corpus = corpus_of(list(enumerate(batch)))
    for profile in ("t1", "t2", "t2_legacy", "t3"):
        got = sorted((r.doc_id, r.pos, r.token) for r in tokens(corpus, profile).collect())
        want = sorted((d, p, t) for d, text in enumerate(batch) for p, t in py_tokens(text, profile))
        assert got == want, profile


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(batch=texts)
def test_lengths_sum_to_tokens(spark, corpus_of, batch):
    from lodestar.operators import index
    corpus = corpus_of(list(enumerate(batch)))
    lens = {r.doc_id: r.len for r in index.doc_length(corpus).collect()}
    assert lens == {d: len(py_tokens(t, "t1")) for d, t in enumerate(batch)}
