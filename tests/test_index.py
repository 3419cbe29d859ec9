"""Index operators against the brute force, plus the property checks."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import brute
from lodestar.functions.text import tokens
from lodestar.operators import index


@pytest.fixture(scope="module")
def corpus(spark):
    from corpora import make_corpus
    return make_corpus(spark, brute.DOCS)


def test_postings(corpus):
    got = {(r.term, r.doc_id): r.tf for r in index.postings(corpus).collect()}
    assert got == brute.postings()


def test_term_stats(corpus):
    got = {r.term: (r.cf, r.df) for r in index.term_stats(index.postings(corpus)).collect()}
    cf = Counter()
    for (t, _), n in brute.postings().items():
        cf[t] += n
    assert got == {t: (cf[t], brute.df()[t]) for t in cf}


def test_doc_length_and_corpus_stats(corpus):
    assert {r.doc_id: r.len for r in index.doc_length(corpus).collect()} == brute.doc_len()
    cs = index.corpus_stats(index.doc_stats(corpus)).first()
    n, total, avgdl = brute.stats()
    assert (cs.n_docs, cs.total_len) == (n, total) and cs.avgdl == pytest.approx(avgdl)
    tf = index.term_frequency(corpus)
    cs2 = index.corpus_stats_from_postings(corpus, tf).first()
    assert (cs2.n_docs, cs2.total_len, cs2.avgdl) == (cs.n_docs, cs.total_len, cs.avgdl)


def test_bigrams(corpus):
    got = {(r.bigram, r.doc_id): r.tf for r in index.bigram_postings(corpus).collect()}
    want = Counter()
    for d, text in brute.DOCS:
        t = brute.t2(text)
        for a, b in zip(t, t[1:]):
            want[(f"{a} {b}", d)] += 1
    assert got == dict(want)
    assert not [k for k in got if k[1] in (5, 6)]  # fewer than two tokens: no bigram


def test_positions(corpus):
    got = sorted((r.doc_id, r.pos, r.term) for r in index.positions(corpus).collect())
    want = sorted((d, p, t) for d, text in brute.DOCS for p, t in brute.t3_positions(text))
    assert got == want


def test_positional_frequency(corpus):
    pf = {r.term: (r.frequency, r.df) for r in index.positional_frequency(index.positions(corpus)).collect()}
    assert pf["the"][0] == sum(1 for d, t in brute.DOCS for _, w in brute.t3_positions(t) if w == "the")


def test_properties(corpus):
    # sum of lengths = number of tokens; df <= min(cf, N); positions strictly increasing
    n_tokens = tokens(corpus, "t1").count()
    assert index.corpus_stats(index.doc_stats(corpus)).first().total_len == n_tokens
    ts = index.term_stats(index.postings(corpus))
    assert ts.where((F.col("df") > F.col("cf")) | (F.col("df") > len(brute.DOCS))).count() == 0
    v = index.positional_view(index.positions(corpus)).collect()
    assert all(r.positions == sorted(set(r.positions)) for r in v)


def test_posting_list_view_blocks(corpus):
    p = index.postings(corpus)
    view = index.posting_list_view(p, index.term_stats(p), block_size=2).collect()
    the = sorted((r.block, r.doc_ids) for r in view if r.term == "the")
    ids = sorted(d for (t, d) in brute.postings() if t == "the")
    assert [x for _, b in the for x in b] == ids
    assert all(len(b) <= 2 for _, b in the)


def test_postings_counted_in_their_rows(spark, corpus_of):
    """``per_row`` gives the rows of the aggregate without any exchange of postings."""
    docs = [(1, "cat dog cat the cat dog"), (2, ""), (3, None), (4, "one"), (5, "b a b a b")]
    c = corpus_of(docs)
    for make in (index.term_frequency, index.bigram_postings):
        narrow, whole = make(c, per_row=True), make(c)
        assert sorted(map(tuple, narrow.select(*whole.columns).collect())) == sorted(map(tuple, whole.collect()))
        assert "Exchange" not in narrow._jdf.queryExecution().executedPlan().toString()
    placed, whole = index.term_positions(c), index.positional_view(index.positions(c))
    assert sorted(map(str, placed.collect())) == sorted(map(str, whole.collect()))
    assert "Exchange" not in placed._jdf.queryExecution().executedPlan().toString()


def test_lists_and_frequencies_from_counted_positions(spark, corpus_of):
    c = corpus_of([(i, "cat dog " * (1 + i % 3) + f"w{chr(97 + i % 26)}") for i in range(60)])
    long, per_doc = index.positions(c), index.term_positions(c)
    for make in (index.positional_frequency, lambda d: index.positional_list_view(d, 7)):
        assert sorted(map(str, make(per_doc).collect())) == sorted(map(str, make(long).collect()))


def test_unique_corpus_moves_no_text_without_copies(spark, tmp_path):
    from lodestar.plans.catalog import unique_corpus

    rows = [(i, f"text {i}") for i in range(50)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(str(tmp_path / "one" / "documents.parquet"))
    spark.createDataFrame(rows + [(3, "zzz"), (None, "lost")], "doc_id bigint, text string").write.parquet(
        str(tmp_path / "two" / "documents.parquet"))
    plain, copies = (unique_corpus(spark, str(tmp_path / d)) for d in ("one", "two"))
    assert "Exchange" not in plain._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.doc_id, r.text) for r in plain.collect()) == rows
    assert sorted((r.doc_id, r.text) for r in copies.collect()) == sorted(rows[:3] + [(3, "zzz")] + rows[4:])


def test_postings_view_of_a_list_longer_than_a_block(spark, corpus_of):
    c = corpus_of([(i, "hot hot " + f"rare{chr(97 + i % 26)}") for i in range(40)])
    p = index.postings(c, per_row=True)
    view = index.posting_list_view(p, index.term_stats(p), block_size=16).collect()
    assert sorted((r.block, r.cf, len(r.doc_ids)) for r in view if r.term == "hot") == [(0, 80, 16), (1, 80, 16), (2, 80, 8)]
    assert all(r.cf == len(r.doc_ids) for r in view if r.term != "hot")
