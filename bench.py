"""Benchmark: index build and searches at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value" (total seconds), "unit", "queries", "sf", ...}.
The whole sequence runs twice on a fresh index folder each time.  The first, cold pass is
what counts, as the reference's times are those of single cold runs; the second is reported
as ``warm``.  ``value`` is the index build plus the searches on the stored index;
``scratch_total`` sums the registered queries recomputed from the raw documents.
Timed steps:
  build_*        writing each index table (postings .. weights with impact order)
  search_*       searches answered from the stored index
  scratch_*      registered queries computed from the raw documents (no stored index)
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lodestar.plans import registry  # noqa: E402
from lodestar.plans.build import BuildOptions, SearchIndex, build_tables, stored_corpus, write_grams, write_weights  # noqa: E402
from lodestar.plans.catalog import corpus  # noqa: E402
from lodestar.session import local_session, scratch_path  # noqa: E402
from lodestar.sources.store import IndexStore  # noqa: E402

SCRATCH = ["weights_bm25", "weights_tfidf", "search_bm25", "search_cosine",
           "search_proximity", "index_bigram", "impact_order_bm25"]


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    spark = local_session(cpus, shuffle_partitions=int(cpus) * 2 if cpus.isdigit() else 16,
                          app_name="lodestar-bench")
    cold = _pass(spark, sf_dir)
    warm = _pass(spark, sf_dir)
    n_docs = corpus(spark, sf_dir).count()

    def total(times, prefixes):
        return round(sum(v for k, v in times.items() if k.startswith(prefixes)), 3)

    build = total(cold, ("build_",))
    print(json.dumps({
        "metric": "index_build_and_search_total",
        "value": total(cold, ("build_", "search_")),
        "unit": "sec", "queries": cold, "sf": sf,
        "build_total": build, "search_total": total(cold, ("search_",)),
        "scratch_total": total(cold, ("scratch_",)),
        "warm_total": total(warm, ("build_", "search_")), "warm": warm,
        "docs": n_docs, "build_docs_per_sec": round(n_docs / build, 1),
    }))


def _pass(spark, sf_dir: str) -> dict[str, float]:
    times: dict[str, float] = {}

    def timed(name, fn):
        t = time.time()
        out = fn()
        times[name] = round(time.time() - t, 3)
        return out

    store = IndexStore(spark, scratch_path(spark, "bench-index"))
    unique = timed("build_corpus", lambda: stored_corpus(corpus(spark, sf_dir), store))
    c = unique.read("corpus")
    steps = [
        ("build_postings", ("postings", "term_stats")),
        ("build_doc_stats", ("doc_stats", "corpus_stats")),
        ("build_weights", ("weights_bm25", "weights_tfidf")),
        ("build_bigrams", ("bigram_postings", "bigram_stats")),
        ("build_positions", ("positions",)),
        ("new_build_grams", ("term_grams", "bigram_grams")),
    ]
    for name, tables in steps:
        def step(tables=tables):
            # later steps read what earlier steps wrote; only the new tables are built
            if "weights_bm25" in tables:
                write_weights(store, *(store.read(t) for t in ("postings", "term_stats", "corpus_stats")),
                              BuildOptions(tables=tables))
            elif "term_grams" in tables:
                write_grams(store, store.read("term_stats"), "term")
                write_grams(store, store.read("bigram_stats"), "bigram")
            else:
                build_tables(c, store, BuildOptions(tables=tables))
        timed(name, step)

    idx = SearchIndex(store)
    w1, w2, d = registry.PROXIMITY
    timed("search_bm25", lambda: _run(idx.bm25(registry.BM25_QUERY)))
    timed("search_tfidf", lambda: _run(idx.tfidf(registry.TFIDF_QUERY)))
    timed("search_cosine", lambda: _run(idx.cosine(registry.TFIDF_QUERY)))
    timed("search_proximity", lambda: _run(idx.proximity(w1, w2, d)))
    timed("search_term_substring", lambda: _run(idx.term_substring(registry.SUBSTRING_QUERY)))
    timed("search_bigram_substring", lambda: _run(idx.bigram_substring(registry.BIGRAM_QUERY)))

    # what the headline did not time before has a name of its own
    timed("new_search_bm25_pruned", lambda: _run(idx.bm25_pruned(registry.BM25_QUERY)))
    timed("new_search_tfidf_pruned", lambda: _run(idx.tfidf_pruned(registry.TFIDF_QUERY)))
    timed("new_search_term_grams", lambda: _run(idx.term_substring_grams(registry.SUBSTRING_QUERY)))
    timed("new_search_bigram_grams", lambda: _run(idx.bigram_substring_grams(registry.BIGRAM_QUERY)))
    unique.forget()

    for key in SCRATCH:
        timed(f"scratch_{key}", lambda key=key: _run(registry.QUERIES[key](spark, sf_dir)))
    return times


if __name__ == "__main__":
    main()
