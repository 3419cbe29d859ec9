"""The pipeline: each stage on what the one before kept, and against plain Python."""

from collections import Counter, defaultdict

import corpus_pipeline
from brute_llm import WORDS, components, shingles
from lodestar.llm.common import stage
from lodestar.llm.common import tokenizer_path as packing_path


def test_stages(spark, frame, odd):
    docs = frame(odd)
    steps = dict(corpus_pipeline.STAGES)
    assert list(steps) == ["language_id", "line_dedup", "ngram_jaccard_join", "mixing", "packing"]

    named = stage(steps["language_id"](spark, docs, None), "t")
    assert named.columns == docs.columns
    letters = [r for r in odd if r[1] and any(c.isalpha() for c in r[1])]
    rows = [(r["doc_id"], r["text"]) for r in named.collect()]
    assert not Counter(rows) - Counter(letters) and len(rows) >= 0.8 * len(letters)

    lines = stage(steps["line_dedup"](spark, named, None), "t")
    assert lines.columns == docs.columns and 0 < lines.count() < named.count()

    near = stage(steps["ngram_jaccard_join"](spark, lines, None), "t")
    before = [(r["doc_id"], r["text"]) for r in lines.collect()]
    after = [(r["doc_id"], r["text"]) for r in near.collect()]
    distinct = sorted(set(before), key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    numbered = [(n, shingles(t)) for n, (_, t) in enumerate(distinct)]
    groups = defaultdict(list)
    for n, c in enumerate(components(numbered)):
        groups[c].append(distinct[n])
    assert not Counter(after) - Counter(before)
    stay = Counter(next(c for c, g in groups.items() if r in g) for r in after if WORDS.search(r[1] or ""))
    assert all(stay[c] == 1 for c, g in groups.items() if WORDS.search(g[0][1] or ""))
    for c, g in groups.items():
        if WORDS.search(g[0][1] or ""):
            kept = [r for r in after if r in g]
            assert kept[0][0] == min((r[0] for r in g if r[0] is not None), default=None)

    mixed = stage(steps["mixing"](spark, near, None), "t")
    assert mixed.columns == docs.columns and mixed.count() > 0
    packed = steps["packing"](spark, mixed, None)
    assert packed.count() >= mixed.count()


def test_empty(spark, frame):
    docs = frame([])
    for _, step in corpus_pipeline.STAGES:
        docs = stage(step(spark, docs, None), "t")
    assert docs.count() == 0


def test_single_lines_of_a_few_words_go(spark, frame):
    line, short = "Licensed under the Apache License, Version 2.0.", "} // end"
    docs = frame([(i, f"first {i} a b\n{line}\nnext {i} c\n{short}\nlast {i}") for i in range(6)])
    kept = dict(corpus_pipeline.STAGES)["line_dedup"](spark, docs, None).select("doc_id", "text").collect()
    assert [r["doc_id"] for r in kept if line in r["text"]] == [0]
    assert len(kept) == 6 and all(short in r["text"] for r in kept)


def test_rows_are_told_apart_by_number_whatever_their_columns(spark):
    """Columns named like inner ones, a map column, and rows that are equal in all the others."""
    from pyspark.sql import functions as F

    long = " ".join(f"w{i}" for i in range(40))
    rows = [(i, t, "en", "s", len(t or ""), 7, i % 2) for i, t in
            [(4, long), (2, long), (2, long), (9, "other text of a few words"), (11, " "), (11, " "), (12, None)]]
    docs = spark.createDataFrame(
        rows, "doc_id bigint, text string, lang string, source string, n_chars int, _key int, key int").withColumn(
        "row", F.create_map(F.lit("k"), F.monotonically_increasing_id()))
    steps = dict(corpus_pipeline.STAGES)
    near = stage(steps["ngram_jaccard_join"](spark, docs, None), "t")
    assert near.columns == docs.columns
    assert sorted((r["doc_id"], r["text"] or "") for r in near.collect()) == [
        (2, long), (9, "other text of a few words"), (11, " "), (11, " "), (12, "")]
    twice = docs.where("doc_id = 2")  # differ in the map only
    mixed = stage(steps["mixing"](spark, twice, None), "t").collect()
    assert len({r["row"]["k"] for r in mixed}) == 2 and {r["_key"] for r in mixed} == {7}


def test_language_of_a_kept_row_without_a_second_text(spark, frame):
    from pyspark.sql import functions as F

    from lodestar.llm import langid

    docs = frame([(i, t) for i, t in enumerate(["the cat and the dog", "der Hund und die Katze", None, "12", "the end"])], 1)
    model = langid.fit(docs.select("doc_id", "text", F.when(F.col("doc_id") % 2 == 0, "en").otherwise("de").alias("lang")))
    found = langid.predict(docs.select(F.struct("*").alias("row")), model, ["row"], "row.text")
    assert "_text" not in found._jdf.queryExecution().executedPlan().toString()
    got = sorted((r["row"]["doc_id"], *r[1:]) for r in found.collect())
    assert got == sorted(map(tuple, langid.predict(docs, model, ["doc_id"]).collect())) and len(got) == 5


def test_documents_without_lines_go_by_a_filter_that_builds_no_text(spark, frame):
    from lodestar.llm import line_dedup

    line = "one two three four five"
    docs = frame([(1, f"{line}\n \n{line} six"), (2, f"{line}\n\n"), (3, line), (4, " "), (5, None), (6, "short\n" + line)])
    kept = line_dedup.dedup_lines(docs, long_line=5, keep_rows=False)
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect() if r["text"]) == [
        (1, f"{line}\n \n{line} six"), (4, " "), (6, "short")]
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 4, 5, 6]
    plan = kept._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert not [x for x in plan if "Filter (" in x and "array_join" in x]


def test_packing_sends_its_workers_batches_of_bounded_bytes(spark, frame, monkeypatch):
    from lodestar.llm import packing

    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    before, seen = spark.conf.get(setting), {}
    real = packing.stage

    def watched(df, name):
        seen[name] = spark.conf.get(setting)
        return real(df, name)

    monkeypatch.setattr(packing, "stage", watched)
    monkeypatch.setattr(packing, "GROUP_BYTES", 2000)
    docs = frame([(i, f"some words of text {i} " * 40) for i in range(30)])
    assert packing.pack(docs, packing_path()).count() > 0
    assert seen["packing-tokens"] == "2000" and spark.conf.get(setting) == before
