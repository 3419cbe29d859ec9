"""DuckDB SQL for each registered query (tables are pre-registered views).

Written independently of the DataFrame plans: tokens come from ``string_split`` +
``unnest``, the proximity test is a plain theta join, ranks are window functions.  The
patterns are the same fixed values the tokenizer uses.
"""

from __future__ import annotations

from lodestar.functions import text as T
from lodestar.functions.markup import MARKUP_PATTERN
from lodestar.plans import registry as R

D = R.DIGITS


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _in_list(words) -> str:
    return ", ".join(_lit(w) for w in words)


CORPUS = (
    "corpus AS (SELECT doc_id, CAST(NULL AS VARCHAR) AS title, split_part(text, chr(10), 1) AS headline, "
    "CAST(NULL AS VARCHAR) AS byline, text FROM documents)"
)
DOC_TEXT = "lower(concat_ws(' ', title, byline, text))"
STOP = _in_list(T.STOP_WORDS)


def _pieces(profile: str) -> str:
    if profile == "t4_legacy":
        inner = (f"regexp_replace(regexp_replace({DOC_TEXT}, {_lit(T.T4_DELETE_PATTERN)}, '', 'g'), "
                 f"{_lit(T.T4_SPACE_PATTERN)}, ' ', 'g')")
    else:
        pattern = {"t1": T.T1_PATTERN, "t1b": T.T1B_PATTERN, "t2": T.T1_PATTERN,
                   "t2_legacy": T.T2_LEGACY_PATTERN, "t3": T.T3_PATTERN}[profile]
        inner = f"regexp_replace({DOC_TEXT}, {_lit(pattern)}, ' ', 'g')"
    return f"string_split({inner}, ' ')"


def _keep(profile: str, x: str) -> str:
    cond = f"{x} <> ''"
    if profile == "t2":
        cond += f" AND {x} NOT IN ({STOP})"
    if profile == "t3":
        cond += f" AND NOT regexp_matches({x}, {_lit(T.DIGIT_PATTERN)})"
    return cond


def _ctes(profile: str = "t1") -> str:
    """corpus, pc(doc_id, p raw pieces), tk(doc_id, token, pos) of kept tokens."""
    return (
        f"{CORPUS}, pc AS (SELECT doc_id, {_pieces(profile)} AS p FROM corpus), "
        "tk0 AS (SELECT doc_id, unnest(p) AS token, generate_subscripts(p, 1) AS pos FROM pc), "
        f"tk AS (SELECT doc_id, token, CAST(pos AS BIGINT) AS pos FROM tk0 WHERE {_keep(profile, 'token')})"
    )


# Index-level CTEs on top of _ctes('t1').
POST = "post AS (SELECT token AS term, doc_id, CAST(count(*) AS BIGINT) AS tf FROM tk GROUP BY token, doc_id)"
DL = "dl AS (SELECT doc_id, CAST(len(list_filter(p, lambda x: x <> '')) AS BIGINT) AS len FROM pc)"
CS = ("cs AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(len) AS BIGINT) AS total_len, "
      "CAST(sum(len) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS avgdl FROM dl)")
TS = ("ts AS (SELECT term, CAST(sum(tf) AS BIGINT) AS cf, CAST(count(*) AS BIGINT) AS df "
      "FROM post GROUP BY term)")
IDF = ("ti AS (SELECT ts.term, ts.df, ln(CAST(cs.n_docs AS DOUBLE) / CAST(ts.df AS DOUBLE)) AS idf, "
       "cs.avgdl FROM ts, cs)")
BM25 = (
    "w AS (SELECT post.term, post.doc_id, post.tf, ti.idf, "
    "ti.idf * (((CAST(1.2 AS DOUBLE) + CAST(1.0 AS DOUBLE)) * CAST(post.tf AS DOUBLE)) / "
    "(CAST(1.2 AS DOUBLE) * ((CAST(1.0 AS DOUBLE) - CAST(0.75 AS DOUBLE)) + CAST(0.75 AS DOUBLE) * "
    "(CAST(dl.len AS DOUBLE) / ti.avgdl)) + CAST(post.tf AS DOUBLE))) AS weight "
    "FROM post JOIN ti ON post.term = ti.term JOIN dl ON post.doc_id = dl.doc_id)"
)
TFIDF = (
    "w AS (SELECT post.term, post.doc_id, post.tf, ti.idf, "
    "(CAST(1.0 AS DOUBLE) + ln(CAST(post.tf AS DOUBLE))) * ti.idf AS weight "
    "FROM post JOIN ti ON post.term = ti.term)"
)


def _with(*parts: str) -> str:
    return "WITH " + ", ".join(parts) + " "


def _r(expr: str, name: str) -> str:
    return f"round({expr}, {D}) AS {name}"


W_BM25 = _with(_ctes("t1"), POST, DL, CS, TS, IDF, BM25)
W_TFIDF = _with(_ctes("t1"), POST, DL, CS, TS, IDF, TFIDF)

_QTF = ", ".join(f"({_lit(w)}, {R.TFIDF_QUERY.count(w)})" for w in sorted(set(R.TFIDF_QUERY)))
QUERY_CTE = f"q(term, qtf) AS (VALUES {_QTF})"


HIT_COLS = "CAST(top.rnk AS INTEGER) AS rank, top.doc_id, top.score, corpus.headline"


def _hits(scores_select: str, cols: str = HIT_COLS) -> str:
    """Top-k with rank and headline from a ``s(doc_id, score)`` select."""
    return (
        f", s AS ({scores_select}), "
        f"top AS (SELECT doc_id, score, row_number() OVER (ORDER BY score DESC, doc_id) AS rnk FROM s) "
        f"SELECT {cols} FROM top JOIN corpus ON top.doc_id = corpus.doc_id WHERE top.rnk <= {R.K}"
    )


def _tokens_sql(profile: str) -> str:
    return _with(_ctes(profile)) + "SELECT doc_id, pos, token FROM tk"


BIGRAM_POST = (
    f"bt AS (SELECT doc_id, list_filter(p, lambda x: {_keep('t2', 'x')}) AS t FROM pc), "
    "bg AS (SELECT doc_id, unnest(list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])) AS bigram FROM bt), "
    "bpost AS (SELECT bigram, doc_id, CAST(count(*) AS BIGINT) AS tf FROM bg GROUP BY bigram, doc_id), "
    "bts AS (SELECT bigram, CAST(sum(tf) AS BIGINT) AS cf, CAST(count(*) AS BIGINT) AS df FROM bpost GROUP BY bigram)"
)
POSITIONS = "pos AS (SELECT token AS term, doc_id, pos FROM tk)"

_W1, _W2, _DELTA = R.PROXIMITY
PAIRS = (
    f"a AS (SELECT doc_id, pos AS p1 FROM pos WHERE term = {_lit(_W1)}), "
    f"b AS (SELECT doc_id, pos AS p2 FROM pos WHERE term = {_lit(_W2)}), "
    f"pairs AS (SELECT a.doc_id, count(*) AS n FROM a JOIN b ON a.doc_id = b.doc_id "
    f"AND abs(a.p1 - b.p2) = {_DELTA} GROUP BY a.doc_id)"
)

CLEAN_HEADLINE = "replace(replace(coalesce(headline, ''), ',', ''), '&amp;', '&')"


BM25_SCORES = (
    f"SELECT doc_id, round(sum(weight) / 2.0, {D}) AS score FROM w "
    f"WHERE term IN ({_in_list(sorted(set(R.BM25_QUERY)))}) GROUP BY doc_id"
)
TFIDF_PAIRS = (
    "m AS (SELECT w.doc_id, w.weight AS dw, CAST(q.qtf AS DOUBLE) AS qtf, "
    "(CAST(1.0 AS DOUBLE) + ln(CAST(q.qtf AS DOUBLE))) * w.idf AS qw FROM w JOIN q ON w.term = q.term)"
)


def _merged() -> str:
    """Weights of two overlapping parts, each with its own statistics; the heavier row stays."""
    cut = "(SELECT min(doc_id) + (max(doc_id) - min(doc_id)) * CAST({} AS DOUBLE) FROM documents)"
    parts = [
        "SELECT * FROM (" + W_TFIDF.replace("FROM documents)", f"FROM documents WHERE doc_id {op} {cut.format(share)})")
        + "SELECT term, doc_id, tf, idf, weight FROM w)"
        for op, share in (("<", R.MERGE_HI), (">=", R.MERGE_LO))
    ]
    return (
        f"SELECT term, doc_id, arg_max(tf, weight) AS tf, {_r('arg_max(idf, weight)', 'idf')}, "
        f"{_r('max(weight)', 'weight')} FROM ({' UNION ALL '.join(parts)}) GROUP BY term, doc_id"
    )


# What the two ingest round trips start from: fixed date and dateline, code lists of lang and source.
CODED = (
    "CAST(doc_id AS BIGINT) AS doc_id, '1996-08-20' AS date, CAST(NULL AS VARCHAR) AS title, "
    "split_part(text, chr(10), 1) AS headline, CAST(NULL AS VARCHAR) AS byline, "
    "'A $ and $$, \\ here$' AS dateline, coalesce(lang, '') AS countries, "
    "concat_ws('|', lang, source) AS industries, coalesce(source, '') AS topics"
)


def _escaped(x: str) -> str:
    for char, mark in (("'\\'", "'\\\\'"), ("'$'", "'\\s'"), ("chr(10)", "'\\n'"), ("chr(13)", "'\\r'")):
        x = f"replace({x}, {char}, {mark})"
    return f"coalesce({x}, '\\N')"


def sql() -> dict[str, str]:
    s: dict[str, str] = {}
    s["doc_text"] = _with(CORPUS) + f"SELECT doc_id, {DOC_TEXT} AS doc_text FROM corpus"
    for p in ("t1", "t2", "t2_legacy", "t3", "t4_legacy"):
        s[f"tokens_{p}"] = _tokens_sql(p)
    s["clean_markup"] = (
        "SELECT page_id, regexp_replace(regexp_replace(html, '\\r\\n', '', 'g'), "
        f"{_lit(MARKUP_PATTERN)}, ' ', 'g') AS text FROM pages"
    )
    s["clean_headline"] = f"SELECT doc_id, {CLEAN_HEADLINE.replace('headline', 'text')} AS headline FROM documents"
    shown = CLEAN_HEADLINE.replace("headline", "corpus.headline")
    s["format_hits"] = W_BM25 + _hits(
        BM25_SCORES,
        "CAST(top.rnk AS INTEGER) AS rank, top.score, "
        f"CAST(top.doc_id AS VARCHAR) || ':' || {shown} AS hit, "
        f"CAST(top.doc_id AS VARCHAR) || ',' || {shown} AS hit_csv",
    )
    s["dedupe_docs"] = _with(CORPUS) + (
        "SELECT doc_id, max(headline) AS headline, max(text) AS text "
        "FROM (SELECT * FROM corpus UNION ALL SELECT * FROM corpus) GROUP BY doc_id"
    )
    s["dedupe_docs_late"] = _with(CORPUS) + (
        "SELECT doc_id, max(headline) AS headline, max(text) AS text FROM (SELECT * FROM corpus UNION ALL "
        "SELECT doc_id, title, headline, byline, split_part(text, chr(10), 1) AS text FROM corpus "
        "WHERE length(text) < 2000) GROUP BY doc_id"
    )
    s["term_frequency"] = _with(_ctes("t1"), POST) + "SELECT term, doc_id, tf FROM post"
    s["doc_length"] = _with(_ctes("t1"), DL) + "SELECT doc_id, len FROM dl"
    s["corpus_stats"] = _with(_ctes("t1"), DL, CS) + f"SELECT n_docs, total_len, {_r('avgdl', 'avgdl')} FROM cs"
    s["term_idf"] = _with(_ctes("t1"), POST, DL, CS, TS, IDF) + f"SELECT term, df, {_r('idf', 'idf')} FROM ti"
    s["postings_with_headline"] = _with(_ctes("t1"), POST) + (
        "SELECT post.term, post.doc_id, post.tf, corpus.headline FROM post JOIN corpus ON post.doc_id = corpus.doc_id"
    )
    s["index_unigram"] = _with(_ctes("t1"), POST, TS) + "SELECT term, cf, df FROM ts"
    s["index_unigram_doubled"] = s["index_unigram"]
    s["index_bigram"] = _with(_ctes("t1"), BIGRAM_POST) + "SELECT bigram, cf, df FROM bts"
    s["index_bigram_postings"] = _with(_ctes("t1"), BIGRAM_POST) + "SELECT bigram, doc_id, tf FROM bpost"
    s["index_positional"] = _with(_ctes("t3"), POSITIONS) + "SELECT term, doc_id, pos FROM pos"
    vb = R.VIEW_BLOCK
    s["index_unigram_view"] = _with(_ctes("t1"), POST, TS) + (
        "SELECT term, cf, block, string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY doc_id) AS doc_ids FROM ("
        f"SELECT post.term, ts.cf, CAST((row_number() OVER (PARTITION BY post.term ORDER BY post.doc_id) - 1) // {vb} AS BIGINT) AS block, "
        "post.doc_id FROM post JOIN ts ON post.term = ts.term) GROUP BY term, cf, block"
    )
    s["index_bigram_view"] = _with(_ctes("t1").replace(_pieces("t1"), _pieces("t2")), BIGRAM_POST) + (
        "SELECT bigram, cf, block, string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY doc_id) AS doc_ids FROM ("
        f"SELECT bpost.bigram, bts.cf, CAST((row_number() OVER (PARTITION BY bpost.bigram ORDER BY bpost.doc_id) - 1) // {vb} AS BIGINT) AS block, "
        "bpost.doc_id FROM bpost JOIN bts ON bpost.bigram = bts.bigram) GROUP BY bigram, cf, block"
    )
    s["index_positional_list"] = _with(_ctes("t3"), POSITIONS) + (
        ", pd AS (SELECT term, doc_id, count(*) AS n, string_agg(CAST(pos AS VARCHAR), ',' ORDER BY pos) AS p "
        "FROM pos GROUP BY term, doc_id), "
        "pr AS (SELECT term, doc_id, p, CAST(sum(n) OVER (PARTITION BY term) AS BIGINT) AS frequency, "
        f"CAST((row_number() OVER (PARTITION BY term ORDER BY doc_id) - 1) // {vb} AS BIGINT) AS block FROM pd) "
        "SELECT term, frequency, block, string_agg(CAST(doc_id AS VARCHAR) || ':' || p, ';' ORDER BY doc_id) AS docs "
        "FROM pr GROUP BY term, frequency, block"
    )
    for scheme, cte in (("bm25", W_BM25), ("tfidf", W_TFIDF)):
        s[f"weight_list_{scheme}"] = cte + (
            ", r AS (SELECT w.*, row_number() OVER (PARTITION BY term ORDER BY weight DESC, doc_id) AS rnk FROM w) "
            f"SELECT term, {_r('max(idf)', 'idf')}, CAST((rnk - 1) // {vb} AS BIGINT) AS block, "
            "string_agg(concat_ws(':', CAST(r.doc_id AS VARCHAR), "
            f"CAST(CAST(round(weight * {10 ** D}) AS BIGINT) AS VARCHAR), headline), ';' ORDER BY rnk) AS postings "
            "FROM r JOIN corpus ON r.doc_id = corpus.doc_id GROUP BY term, block"
        )
    s["index_positional_view"] = _with(_ctes("t3"), POSITIONS) + (
        "SELECT term, doc_id, string_agg(CAST(pos AS VARCHAR), ',' ORDER BY pos) AS positions "
        "FROM pos GROUP BY term, doc_id"
    )
    s["impact_list_bm25"] = W_BM25 + (
        "SELECT term, block, string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY rnk) AS doc_ids FROM ("
        "SELECT term, doc_id, row_number() OVER (PARTITION BY term ORDER BY weight DESC, doc_id) AS rnk, "
        f"CAST((row_number() OVER (PARTITION BY term ORDER BY weight DESC, doc_id) - 1) // {vb} AS BIGINT) AS block "
        "FROM w) GROUP BY term, block"
    )
    s["positional_frequency"] = _with(_ctes("t3"), POSITIONS) + (
        "SELECT term, CAST(count(*) AS BIGINT) AS frequency, CAST(count(DISTINCT doc_id) AS BIGINT) AS df "
        "FROM pos GROUP BY term"
    )
    s["weights_bm25"] = W_BM25 + f"SELECT term, doc_id, tf, {_r('idf', 'idf')}, {_r('weight', 'weight')} FROM w"
    s["weights_tfidf"] = W_TFIDF + f"SELECT term, doc_id, tf, {_r('idf', 'idf')}, {_r('weight', 'weight')} FROM w"
    impact = (
        f"SELECT term, doc_id, {_r('weight', 'weight')}, "
        "CAST(row_number() OVER (PARTITION BY term ORDER BY weight DESC, doc_id) AS BIGINT) AS impact_rank FROM w"
    )
    s["impact_order_bm25"] = W_BM25 + impact
    s["impact_order_tfidf"] = W_TFIDF + impact
    s["weights_bm25_doubled"] = s["weights_bm25"]
    s["merge_weights"] = _merged()
    s["merge_weights_common"] = _with(_ctes("t1"), POST, DL, CS, TS, IDF, BM25.replace("w AS", "wb AS", 1)) + (
        ", wt AS (" + TFIDF.split("w AS (", 1)[1] +
        f" SELECT wb.term, wb.doc_id, wb.tf, {_r('wb.idf', 'idf')}, {_r('wb.weight', 'bm25')}, {_r('wt.weight', 'tfidf')} "
        "FROM wb JOIN wt ON wb.term = wt.term AND wb.doc_id = wt.doc_id")
    s["stream_statistics"] = s["index_unigram"]
    s["query_weights"] = _with(_ctes("t1"), POST, DL, CS, TS, IDF, QUERY_CTE) + (
        "SELECT q.term, CAST(q.qtf AS BIGINT) AS qtf, "
        f"{_r('ti.idf', 'idf')}, {_r('(CAST(1.0 AS DOUBLE) + ln(CAST(q.qtf AS DOUBLE))) * ti.idf', 'qweight')} "
        "FROM q JOIN ti ON q.term = ti.term"
    )
    s["search_term_substring"] = _with(_ctes("t1"), POST, TS) + (
        "SELECT post.term, ts.cf AS frequency, post.doc_id FROM post JOIN ts ON post.term = ts.term "
        f"WHERE contains(post.term, {_lit(R.SUBSTRING_QUERY)})"
    )
    s["search_bigram_substring"] = _with(_ctes("t1"), BIGRAM_POST) + (
        "SELECT bpost.bigram, bts.cf AS frequency, bpost.doc_id FROM bpost JOIN bts ON bpost.bigram = bts.bigram "
        f"WHERE contains(bpost.bigram, {_lit(R.BIGRAM_QUERY)})"
    )
    s["search_term_exact"] = _with(_ctes("t1"), POST, TS) + (
        "SELECT post.term, ts.cf AS frequency, post.doc_id FROM post JOIN ts ON post.term = ts.term "
        f"WHERE post.term = {_lit(R.EXACT_QUERY)}"
    )
    s["search_postings_any"] = W_BM25 + (
        f"SELECT term, doc_id, {_r('weight', 'weight')} FROM w "
        f"WHERE term IN ({_in_list(sorted(set(R.BM25_QUERY)))})"
    )
    s["search_proximity"] = _with(_ctes("t3"), POSITIONS, PAIRS) + "SELECT doc_id FROM pairs"
    s["search_proximity_pairs"] = _with(_ctes("t3"), POSITIONS, PAIRS) + (
        "SELECT doc_id, CAST(n AS BIGINT) AS n_pairs FROM pairs"
    )
    s["search_bm25"] = W_BM25 + _hits(BM25_SCORES)
    s["search_tfidf"] = W_TFIDF.rstrip() + ", " + QUERY_CTE + ", " + TFIDF_PAIRS + _hits(
        f"SELECT doc_id, round(sum(qtf * dw) / 2.0, {D}) AS score FROM m GROUP BY doc_id"
    )
    s["search_cosine"] = W_TFIDF.rstrip() + ", " + QUERY_CTE + ", " + TFIDF_PAIRS + _hits(
        "SELECT doc_id, round(sum(qtf * qw * dw) / "
        "NULLIF(sqrt(sum(qtf * qw * qw)) * sqrt(sum(qtf * dw * dw)), 0), "
        f"{D}) AS score FROM m GROUP BY doc_id"
    )
    s["text_lists_unigram"] = _with(_ctes("t1"), POST, TS) + (
        "SELECT post.term, ts.cf, post.doc_id FROM post JOIN ts ON post.term = ts.term")
    s["text_lists_bigram"] = _with(_ctes("t1").replace(_pieces("t1"), _pieces("t2")), BIGRAM_POST) + (
        "SELECT bpost.bigram, bts.cf, bpost.doc_id FROM bpost JOIN bts ON bpost.bigram = bts.bigram")
    s["text_lists_positional"] = _with(_ctes("t3"), POSITIONS) + (
        "SELECT term, CAST(count(*) OVER (PARTITION BY term) AS BIGINT) AS frequency, doc_id, pos FROM pos")
    s["text_lists_weights"] = W_TFIDF + (
        f"SELECT w.term, {_r('w.idf', 'idf')}, w.doc_id, {_r('w.weight', 'weight')}, "
        "regexp_replace(regexp_replace(headline, '\r\n', '', 'g'), '[\r\n]', ' ', 'g') AS headline "
        "FROM w JOIN corpus ON w.doc_id = corpus.doc_id")
    s["search_proximity_colocated"] = s["search_proximity_pairs"]
    s["postings_with_headline_colocated"] = s["postings_with_headline"]
    s["search_term_substring_grams"] = s["search_term_substring"]
    s["search_bigram_substring_grams"] = s["search_bigram_substring"]
    for name, pattern in (("prefix", R.LIKE_PREFIX), ("suffix", R.LIKE_SUFFIX), ("inner", R.LIKE_INNER)):
        s[f"search_term_like_{name}"] = _with(_ctes("t1"), POST, TS) + (
            "SELECT post.term, ts.cf AS frequency, post.doc_id FROM post JOIN ts ON post.term = ts.term "
            f"WHERE post.term LIKE {_lit(pattern)}")
    s["term_grams"] = _with(_ctes("t1"), POST, TS) + (
        "SELECT DISTINCT substr(term, i, 3) AS gram, term FROM "
        "(SELECT term, unnest(range(1, length(term) + 1)) AS i FROM ts)")
    s["search_bm25_pruned"], s["search_tfidf_pruned"] = s["search_bm25"], s["search_tfidf"]
    s["impact_blocks_bm25"] = W_BM25 + (
        "SELECT term, CAST((rnk - 1) // 64 AS BIGINT) AS block, count(*) AS n, "
        f"{_r('max(weight)', 'max_weight')}, {_r('min(weight)', 'min_weight')}, "
        "min(doc_id) AS min_doc, max(doc_id) AS max_doc FROM (SELECT term, doc_id, weight, "
        "row_number() OVER (PARTITION BY term ORDER BY weight DESC, doc_id) AS rnk FROM w) "
        "GROUP BY term, (rnk - 1) // 64"
    )
    s["index_roundtrip"] = s["term_frequency"]
    s["stream_postings"] = s["term_frequency"]
    s["write_hits"] = s["search_bm25"]
    s["export_delimited"] = _with(CORPUS) + (
        f"SELECT doc_id, concat_ws('$$', CAST(doc_id AS VARCHAR), '\\N', '\\N', {_escaped('headline')}, "
        f"'\\N', '\\N', {_escaped('text')}, '[]', '[]', '[]') AS line FROM corpus"
    )
    s["ingest_delimited"] = f"SELECT {CODED}, text FROM documents"
    s["ingest_delimited_paths"] = s["ingest_delimited"]
    s["ingest_delimited_rejects"] = (
        "WITH l AS (SELECT unnest(string_split(concat(doc_id, '$$null$$null$$null$$null$$null$$', coalesce(text, '')), "
        "chr(10))) AS v FROM documents), f AS (SELECT v, string_split(v, '$$') AS f FROM l), "
        "r AS (SELECT CASE WHEN v = '' THEN 'empty line' WHEN NOT regexp_full_match(f[1], '[0-9]+') "
        "THEN 'no id at the beginning' WHEN TRY_CAST(f[1] AS BIGINT) IS NULL THEN 'id out of range' "
        "WHEN len(f) < 7 THEN 'fewer than 7 fields' ELSE 'kept' END AS reason FROM f) "
        "SELECT reason, count(*) AS n FROM r GROUP BY reason UNION ALL SELECT 'lines read', count(*) FROM r "
        "UNION ALL SELECT 'lines rejected', count(*) FROM r WHERE reason <> 'kept'"
    )
    s["ingest_xml_rejects"] = (
        "SELECT doc_id, CASE WHEN length(text) < 200 THEN 'rejected' ELSE 'kept' END AS status FROM documents")
    s["ingest_xml"] = (
        f"SELECT {CODED}, regexp_replace(regexp_replace(text, '\\r\\n', '', 'g'), "
        f"{_lit(MARKUP_PATTERN)}, ' ', 'g') AS text FROM documents"
    )
    s["ingest_xml_encodings"] = s["ingest_xml"]
    return s
