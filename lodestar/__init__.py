"""lodestar - news retrieval on Spark DataFrames.

Ingest news XML, delimited lines or Parquet; build unigram, bigram and positional
indexes, corpus statistics and BM25 / tf-idf weight tables; run substring, exact,
proximity, BM25, tf-idf and cosine searches.  Every step is a DataFrame plan.

    from lodestar import build_index, SearchIndex, IndexStore, read_news_xml
"""

__version__ = "0.1.0"

_EXPORTS = {
    "build_index": "lodestar.plans.build",
    "BuildOptions": "lodestar.plans.build",
    "SearchIndex": "lodestar.plans.build",
    "IndexStore": "lodestar.sources.store",
    "read_news_xml": "lodestar.sources.news_xml",
    "read_delimited": "lodestar.sources.delimited",
    "export_delimited": "lodestar.sources.delimited",
    "from_documents": "lodestar.sources.documents",
    "dedupe_docs": "lodestar.sources.documents",
    "tokens": "lodestar.functions.text",
}


def __getattr__(name):
    # imported on first use, so `import lodestar` does not need a Spark session
    if name in _EXPORTS:
        import importlib
        return getattr(importlib.import_module(_EXPORTS[name]), name)
    raise AttributeError(name)


__all__ = sorted(_EXPORTS)
