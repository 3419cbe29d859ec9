"""Tokenizer profiles on the token cases of the fixture list."""

import pytest

from lodestar.functions.text import tokens


def toks(spark, corpus_of, text, profile):
    rows = tokens(corpus_of([(1, text)]), profile).orderBy("pos").collect()
    return [(r.pos, r.token) for r in rows]


def words(spark, corpus_of, text, profile):
    return [t for _, t in toks(spark, corpus_of, text, profile)]


@pytest.mark.parametrize("text,profile,expected", [
    ("3com", "t1", ["com"]),
    ("3com", "t3", []),
    ("3com", "t4_legacy", ["com"]),
    ("a4b", "t1", ["a", "b"]),
    ("a4b", "t4_legacy", ["ab"]),
    ("example", "t1", ["ex", "le"]),
    ("$5bn", "t1", ["bn"]),
    ("and the market", "t2", ["and", "market"]),
    ("and the market", "t2_legacy", ["nd", "m", "rket"]),
    ("", "t1", []),
    ("word", "t1", ["word"]),
    ("Über   Café", "t1", ["über", "café"]),
    ("AT&amp;T quot;x&quot;", "t1", ["at", "t", "x"]),
    ("a null value", "t1", ["a", "value"]),
])
def test_profiles(spark, corpus_of, text, profile, expected):
    assert words(spark, corpus_of, text, profile) == expected


def test_t3_positions_count_empty_pieces(spark, corpus_of):
    # "one, two 3com four": the comma leaves an empty piece, 3com is dropped but counted
    assert toks(spark, corpus_of, "one, two 3com four", "t3") == [(1, "one"), (3, "two"), (5, "four")]


def test_t2_keeps_positions_of_stop_words(spark, corpus_of):
    assert toks(spark, corpus_of, "the cat in a hat", "t2") == [(2, "cat"), (5, "hat")]


def test_stop_word_only_as_whole_token(spark, corpus_of):
    assert words(spark, corpus_of, "theory of anthems", "t2") == ["theory", "anthems"]


def test_title_and_byline_are_indexed_headline_is_not(spark, corpus_of):
    c = corpus_of([(1, "Title", "Byline", "Body", "Headline only")])
    assert [r.token for r in tokens(c, "t1").orderBy("pos").collect()] == ["title", "byline", "body"]


def test_patterns_are_the_fixed_values():
    """Literal copies, so that a slip in the code under test is not repeated by its oracle."""
    from lodestar.functions import markup, text
    assert text.T1_PATTERN == r"(\pP)|(\pS)|(\d)|(\s)|(null)|(amp)|(quot)"
    assert text.T1B_PATTERN == r"(\pP)|(\pS)|(\d+)|(\s)|(null)|(amp)|(quot)"
    assert text.T3_PATTERN == r"(\pP)|(\pS)|(\s)|(null)|(amp)|(quot)"
    assert text.T4_DELETE_PATTERN == r"(\pS)|(\d+)"
    assert text.T4_SPACE_PATTERN == r"(\pP)|(\s)|(null)|(amp)|(quot)"
    assert text.STOP_WORDS == tuple(
        "a the of an that at in without within between this these those their his her its my".split())
    assert markup.MARKUP_PATTERN == r"(<p>)|(</p>)|(&quot;)|(&amp;)|(\n)"


def test_t1b_takes_digit_runs_as_one_gap(spark, corpus_of):
    from lodestar.operators import index
    got = index.token_stream(corpus_of([(1, "a12b 3 c")]), "t1b").orderBy("pos").collect()
    assert [r.token for r in got] == ["a", "b", "c"]
