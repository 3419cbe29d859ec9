"""Operators 11 to 13 against plain Python and against the tokenizer library itself."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lodestar.llm import fim, importance, token_counts
from lodestar.llm.common import tokenizer_path

MARKED = [(200, "a <P> b"), (201, "x<S>"), (202, "<M"), (203, "<M><"), (204, "ends with <"), (205, "S>tart P>"),
          (206, "<|endoftext|> and <|startoftext|>x<|STARTOFTEXT|>"), (207, "it's WE'RE you'Ll 'tis 12 3.5 a_b"),
          (208, "Ελλάς ΣΊΣΥΦΟΣ café e ́x   wide　日本語 テキスト 🙂🙂 ﬁ ½²"),
          (209, "naïve “quoted” – déjà-vu … 10 € ŒUVRE ß İstanbul"), (210, "\x00\x1c\x85 odd\x7f\x0b\x0c")]


@pytest.fixture(scope="module")
def rows(odd):
    return [*odd, *MARKED]


# ------------------------------------------------------------------------- 11

def fim_rows(docs, seed=1, fim_percent=90, spm_percent=20):
    out = []
    for i, text in docs:
        t = text or ""
        digest = hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
        h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
        a, b = sorted(x % (len(t) + 1) for x in h[:2])
        p, m, s = t[:a], t[a:b], t[b:]
        if not t or any(k in t for k in ("<P>", "<S>", "<M>")) or h[2] % 100 >= fim_percent:
            out.append((i, len(t), "plain", None, None, t))
        elif h[3] % 100 < spm_percent:
            out.append((i, len(t), "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"))
        else:
            out.append((i, len(t), "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"))
    return out


def some(rows):
    return sorted((tuple((x is None, x) for x in r) for r in rows), key=repr)


def test_fim(frame, rows):
    got = fim.fill_in_middle(frame(rows)).withColumn("back", fim.restore(F.col("output"), F.col("form"))).collect()
    assert some(tuple(r)[:6] for r in got) == some(fim_rows(rows))
    assert sorted(r.back for r in got) == sorted(t or "" for _, t in rows)
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_fim_of_words_and_other_marks(frame, rows):
    marks = ("[pre]", "[suf]", "[mid]")
    got = fim.fill_in_middle(frame(rows), 7, 100, 50, marks, "word").withColumn(
        "back", fim.restore(F.col("output"), F.col("form"), marks)).collect()
    assert sorted(r.back for r in got) == sorted(t or "" for _, t in rows)
    texts = {i: t for i, t in rows if i not in (None, 3)}
    for r in got:
        if r.doc_id in texts:
            units = re.findall(r"^[\x20\x09-\x0D]+|[^\x20\x09-\x0D]+[\x20\x09-\x0D]*", texts[r.doc_id] or "")
            assert r.n == len(units)
            if r.form == "psm":
                a, b = r.prefix_chars, r.prefix_chars + r.middle_chars
                cut = ["".join(x) for x in (units[:a], units[b:], units[a:b])]
                assert r.output == "".join(m + x for m, x in zip(("[pre]", "[suf]", "[mid]"), cut))


def test_fim_blocks_of_any_size():
    rng = random.Random(3)
    texts = ["".join(rng.choice("aé漢🙂 ") for _ in range(rng.randrange(40))) for _ in range(50)]
    for unit in fim.UNITS:
        column = pa.array(texts, pa.string())
        offsets = np.frombuffer(column.buffers()[1], np.int32).astype(np.int64)
        starts = fim._starts(np.frombuffer(column.buffers()[2], np.uint8), offsets, unit)
        n = np.array([int(starts[a:b].sum()) for a, b in zip(offsets, offsets[1:])])
        first, second = n // 3, n - n // 4
        want = fim.cut_texts(column.buffers()[2], offsets, starts, first, second)
        assert ["".join(x) for x in zip(*(w.to_pylist() for w in want))] == texts
        if unit == "character":
            assert want[0].to_pylist() == [t[:a] for t, a in zip(texts, first)]
            assert want[1].to_pylist() == [t[a:b] for t, a, b in zip(texts, first, second)]
        for size in (1, 2, 3, 7, 50):
            assert fim.cut_texts(column.buffers()[2], offsets, starts, first, second, size) == want


def test_fim_of_a_very_long_text(spark):
    long = "wörter und mehr 🙂 " * 1_000_000  # 21 MB
    df = spark.createDataFrame([(4, long), (5, "short")], "doc_id bigint, text string")
    r = {x.doc_id: x for x in fim.fill_in_middle(df, fim_percent=100).select(
        "doc_id", "n", F.sha2("output", 256).alias("h"), F.sha2(
            fim.restore(F.col("output"), F.col("form")), 256).alias("back")).collect()}
    want = {w[0]: w for w in fim_rows([(4, long), (5, "short")], fim_percent=100)}
    for i, t in ((4, long), (5, "short")):
        assert r[i].n == len(t)
        assert r[i].h == hashlib.sha256(want[i][5].encode()).hexdigest()
        assert r[i].back == hashlib.sha256(t.encode()).hexdigest()


def test_fim_refuses_marks_that_overlap(frame):
    for marks in (("<>", "<>", "x"), ("ab", "ba", "c"), ("aa", "b", "aa")):
        with pytest.raises(ValueError):
            fim.fill_in_middle(frame([(1, "a")]), marks=marks)


def test_fim_empty(frame):
    assert fim.fill_in_middle(frame([]).select("doc_id", "text")).count() == 0


# ------------------------------------------------------------------------- 12

@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path())
    return lambda text: len(t.encode(text, add_special_tokens=False).ids)


@pytest.fixture(scope="module")
def proof():
    return token_counts.prove(tokenizer_path())


def test_proof_holds(proof, library):
    assert len(proof.whole) > 30_000 and proof.plain and len(proof.special) == 2
    rng = random.Random(1)
    for w in rng.sample(sorted(proof.whole), 2000):
        assert library(w) == 1 or not w.islower()  # a string with capitals never comes out of lower-casing
    counter, some_of = token_counts.TokenCounter(proof), proof.plain + " '" * 20
    for _ in range(3000):  # plain characters in any order are cut here as there
        text = "".join(rng.choice(some_of) for _ in range(rng.randrange(60)))
        assert counter.count(text) == library(text), repr(text)


def test_token_counts(frame, rows, proof, library):
    got = token_counts.count_tokens(frame(rows), tokenizer_path(), 100, proof).collect()
    want = [(i, len((t or "").encode()), n := library(t or ""), n > 100) for i, t in rows]
    assert some(map(tuple, got)) == some(want)
    assert {r.over_limit for r in got} == {True, False}


def test_token_counts_of_random_text(proof, library):
    rng = random.Random(9)
    counter = token_counts.TokenCounter(proof)
    alphabet = ["a", "B", "é", "é", "́", " ", "\n", " ", " ", "1", "²", "'s", "'", "_", ".", "--",
                "Σ", "ς", "日本", "한", "가", "🙂", "<|endoftext|>", "<|startoftext|>", "<|", "İ", "ﬁ", "Ω",
                "the", "tion", "\t", "\x1c", "\x85"]
    for _ in range(3000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(25)))
        assert counter.count(text) == library(text), repr(text)


def test_token_counts_of_very_long_texts(spark, proof, library, monkeypatch):
    unit = "The quick brown fox, it's 42 times naïve. "
    texts = [unit * 500_000, "word" * 100_000, ("Ωmega words " + unit) * 3000]  # 21 MB; no space; odd words
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(df, tokenizer_path(), proof=proof).collect()}
    assert got == {0: library(unit) * 500_000, 1: library(texts[1]), 2: library(texts[2])}
    counter = token_counts.TokenCounter(proof)
    monkeypatch.setattr(token_counts, "PORTION", 3)
    monkeypatch.setattr(token_counts, "CACHE_BYTES", 40)
    assert counter.count(texts[2][:5000]) == library(texts[2][:5000])


def test_other_tokenizer_files_go_to_the_library(spark):
    from tokenizers import Tokenizer

    texts = ["Some text, it's here 123", "", " x  ", "日本<|endoftext|>"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    path = tokenizer_path("byte_bpe_50k.json")
    assert token_counts.prove(path).plain is None
    t = Tokenizer.from_file(path)
    got = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(df, path).collect()}
    assert got == {i: len(t.encode(x, add_special_tokens=False).ids) for i, x in enumerate(texts)}
    sentencepiece = pytest.importorskip("sentencepiece")
    path = tokenizer_path("piece_bpe_32k.model")
    m = sentencepiece.SentencePieceProcessor(model_file=path)
    got = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(df, path).collect()}
    assert got == {i: len(m.encode(x)) for i, x in enumerate(texts)}


def test_token_counts_empty(frame, proof):
    assert token_counts.count_tokens(frame([]), tokenizer_path(), proof=proof).count() == 0


# ------------------------------------------------------------------------- 13

def dsir(docs, target, low=1, high=1, buckets=10_000, min_words=20, percent=10, seed=2024):
    def grams(text):
        small = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", small)
        return len(w), [zlib.crc32(" ".join(w[i:i + n]).encode()) % buckets
                        for n in range(low, high + 1) for i in range(len(w) - n + 1)]

    mine = [(i, *grams(t)) for i, t in docs]
    s, t = [0] * buckets, [0] * buckets
    for _, _, g in mine:
        for b in g:
            s[b] += 1
    for text in target:
        for b in grams(text)[1]:
            t[b] += 1
    all_s, all_t = sum(s) + buckets, sum(t) + buckets
    gain = [math.floor(1000 * math.log((y + 1) * all_s / ((x + 1) * all_t))) for x, y in zip(s, t)]
    out = []
    for i, n, g in mine:
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in g)
        out.append([i, n, len(g), weight,
                    weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    long = sorted((r for r in out if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2], r[3]))
    for place, r in enumerate(long[:percent * len(long) // 100], 1):
        r[5] = place
    return [tuple(r) for r in out]


TARGET = ["The cat sat on w1x and W2X w3x", None, "", "w1x w1x; word-by-word über 2 mm", "new3 a a"]


@pytest.fixture(scope="module")
def target(spark):
    return spark.createDataFrame([(i, t, 1) for i, t in enumerate(TARGET)], "item_id int, text string, buckets int")


@pytest.mark.parametrize("options", [{}, {"low": 1, "high": 3, "buckets": 997, "min_words": 2, "percent": 40, "seed": 5},
                                     {"low": 2, "high": 2, "buckets": 100_000, "min_words": 0, "percent": 100}])
def test_importance(frame, rows, target, options):
    got = importance.resample(frame(rows), target, "item_id", **options).collect()
    assert some(map(tuple, got)) == some(dsir(rows, TARGET, **options))


def test_importance_without_target_or_documents(frame, rows, target):
    got = importance.resample(frame(rows), target.limit(0), "item_id").collect()
    assert some(map(tuple, got)) == some(dsir(rows, []))
    assert importance.resample(frame([]), target, "item_id").count() == 0


def test_importance_draw_of_many_copies(spark, target):
    """One document that makes up most rows, ids repeated: ranks have no gap and no double."""
    docs = spark.range(4000).select(
        (F.col("id") % 7).alias("doc_id"),
        F.when(F.col("id") % 3 > 0, F.repeat(F.lit("same words "), 30)).otherwise(
            F.concat(F.repeat(F.lit("w1x w2x "), 15), F.col("id").cast("string"))).alias("text"))
    got = importance.resample(docs, target, "item_id", percent=30).collect()
    ranks = sorted((r.rank, -r.score, r.doc_id) for r in got if r.rank)
    assert [r[0] for r in ranks] == list(range(1, 1201)) and [r[1:] for r in ranks] == sorted(r[1:] for r in ranks)
    assert min(r.score for r in got if r.rank) >= max(r.score for r in got if not r.rank)


def test_grams_of_a_very_long_text(spark):
    text = "Aé b2,c " * 1_500_000  # 13.5 MB
    df = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    r = importance.features(df, high=2, buckets=1000).select("n_words", "n_features", "buckets").first()
    assert (r.n_words, r.n_features) == (4_500_000, 8_999_999)
    got = np.frombuffer(r.buckets, "<u2")
    want = [zlib.crc32(x.encode()) % 1000 for x in ("aé", "b2", "c", "aé b2", "b2 c", "c aé")]
    assert got[:3].tolist() == want[:3] and (got[:4_500_000].reshape(-1, 3) == want[:3]).all()
    assert (got[4_500_000:].reshape(-1)[:8_999_997 - 4_500_000].reshape(-1, 3) == want[3:]).all()
