"""DuckDB SQL for the operator queries that SQL can express, written apart from the operators.

The others (fingerprints, learned models, a solver, shuffled schedules, and cosines whose
last bits depend on the order of summing) are tested against plain Python.
"""

WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_WORDS = f"regexp_extract_all(coalesce(text, ''), '{WORD}')"

OP2 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
f AS (SELECT sha256(h) AS digest, min(page_id) AS first FROM p GROUP BY ALL),
r AS (SELECT page_id, h, digest, first, strlen(h) >= 100 AND page_id > first AS again
      FROM p JOIN f ON sha256(p.h) = f.digest)
SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN first END AS refers_to FROM r
"""

# A link is followed in both directions until no document is new; pairs stay within components.
OP4 = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w
  FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM d),
e AS (SELECT doc_id, len(g) AS n, unnest(g) AS x FROM s),
l AS (SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.x = b.x AND a.doc_id <> b.doc_id
      GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
r(doc_id, c) AS (SELECT doc_id, doc_id FROM documents UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.doc_id)
SELECT s.doc_id, CAST(len(g) AS BIGINT) AS n_shingles, c.component_id
FROM s JOIN (SELECT doc_id, min(c) AS component_id FROM r GROUP BY doc_id) c ON s.doc_id = c.doc_id
"""

# Bytes are handled in hexadecimal; removed windows are joined into spans.
OP6 = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS hx, strlen(coalesce(text, '')) AS n FROM documents),
k AS (SELECT doc_id, s, substr(hx, 2 * s + 1, 100) AS x FROM d, unnest(range(0, n - 49)) t(s)),
m AS (SELECT x, min(doc_id) AS first FROM k GROUP BY x),
c AS (SELECT k.doc_id, k.s FROM k JOIN m ON k.x = m.x WHERE m.first < k.doc_id),
b AS (SELECT doc_id, s, coalesce(s > lag(s) OVER (PARTITION BY doc_id ORDER BY s) + 50, true) AS new FROM c),
i AS (SELECT doc_id, s, sum(CAST(new AS INT)) OVER (PARTITION BY doc_id ORDER BY s) AS span FROM b),
p AS (SELECT doc_id, span, min(s) AS a, max(s) + 50 AS z FROM i GROUP BY doc_id, span),
q AS (SELECT doc_id, a, z, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS left_end FROM p),
t AS (SELECT q.doc_id, count(*) AS spans, sum(z - a) AS removed, max(z) AS last,
        string_agg(substr(hx, 2 * left_end + 1, 2 * (a - left_end)), '' ORDER BY a) AS head
      FROM q JOIN d ON q.doc_id = d.doc_id GROUP BY q.doc_id)
SELECT d.doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(head, '') || substr(hx, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN t ON d.doc_id = t.doc_id
"""

OP7 = f"""
WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents),
e AS (SELECT doc_id, unnest(ls) AS x, generate_subscripts(ls, 1) AS i FROM d),
n AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS s FROM e WHERE regexp_matches(x, '{WORD}')),
w AS (SELECT *, lead(x) OVER o AS y, lead(i) OVER o AS j, len(regexp_extract_all(x, '{WORD}')) AS words
      FROM n WINDOW o AS (PARTITION BY doc_id ORDER BY s)),
one AS (SELECT doc_id, i, words, row_number() OVER (PARTITION BY x ORDER BY doc_id, s) AS copy FROM w),
two AS (SELECT doc_id, i, j, row_number() OVER (PARTITION BY x, y ORDER BY doc_id, s) AS copy FROM w WHERE y IS NOT NULL),
gone AS (SELECT doc_id, i FROM one WHERE copy > 1 AND words >= 20 UNION SELECT doc_id, i FROM two WHERE copy > 1
         UNION SELECT doc_id, j FROM two WHERE copy > 1),
kept AS (SELECT e.doc_id, string_agg(e.x, chr(10) ORDER BY e.i) AS t FROM e
         LEFT JOIN gone ON e.doc_id = gone.doc_id AND e.i = gone.i WHERE gone.i IS NULL GROUP BY e.doc_id),
r AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(len(ls), 0) AS BIGINT) AS n_lines, CAST(coalesce(r.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.t, '')) AS kept_sha256
FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id LEFT JOIN r ON d.doc_id = r.doc_id
"""

OP8 = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
k AS (SELECT doc_id, unnest(range(1, len(w) - 48)) AS s,
        unnest(list_transform(range(1, len(w) - 48), lambda i: md5(array_to_string(w[i:i + 49], ' ')))) AS x
      FROM d WHERE len(w) >= 50),
m AS (SELECT x, min(doc_id) AS first FROM k GROUP BY x),
gone AS (SELECT DISTINCT k.doc_id, unnest(range(k.s, k.s + 50)) AS i FROM k JOIN m ON k.x = m.x WHERE m.first < k.doc_id),
e AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM d),
kept AS (SELECT e.doc_id, string_agg(e.x, ' ' ORDER BY e.i) AS t FROM e
         LEFT JOIN gone ON e.doc_id = gone.doc_id AND e.i = gone.i WHERE gone.i IS NULL GROUP BY e.doc_id),
r AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(r.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.t, '')) AS kept_sha256
FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id LEFT JOIN r ON d.doc_id = r.doc_id
"""

def _draws(seed: int, count: int) -> str:
    digest = f"sha256('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), ''))"
    return ", ".join(f"CAST('0x' || substr({digest}, {8 * i + 1}, 8) AS BIGINT) AS h{i + 1}" for i in range(count))


OP11 = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, {_draws(1, 4)} FROM documents),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
        n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 AS plain FROM d),
p AS (SELECT *, substr(t, 1, a) AS prefix, substr(t, a + 1, b - a) AS middle, substr(t, b + 1) AS suffix FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, CASE WHEN plain THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form,
       CASE WHEN NOT plain THEN CAST(a AS BIGINT) END AS prefix_chars,
       CASE WHEN NOT plain THEN CAST(b - a AS BIGINT) END AS middle_chars,
       sha256(CASE WHEN plain THEN t WHEN h4 % 100 < 20 THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle
              ELSE '<P>' || prefix || '<S>' || suffix || '<M>' || middle END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""

# CRC-32 is folded over the bytes of every distinct word, with its table made by rule.
OP13 = f"""
WITH k AS (SELECT list(list_reduce(list_prepend(CAST(i AS UBIGINT), list_transform(range(8), lambda x: CAST(0 AS UBIGINT))),
        lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c >> 1, CAST(3988292384 AS UBIGINT)) ELSE c >> 1 END) ORDER BY i) AS tab
      FROM range(256) t(i)),
w AS (SELECT doc_id, true AS raw, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS x FROM documents
      UNION ALL SELECT item_id, false, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') FROM benchmark),
e AS (SELECT doc_id, raw, unnest(x) AS word FROM w),
u AS (SELECT DISTINCT word, hex(encode(word)) AS hx FROM e),
b AS (SELECT word, CAST(xor(list_reduce(list_prepend(CAST(4294967295 AS UBIGINT), list_transform(range(1, len(hx), 2),
        lambda i: CAST('0x' || substr(hx, i, 2) AS UBIGINT))),
        lambda c, y: xor(c >> 8, tab[CAST(xor(c, y) % 256 + 1 AS BIGINT)])), CAST(4294967295 AS UBIGINT)) % 10000 AS BIGINT)
        AS bucket FROM u, k),
f AS (SELECT e.doc_id, e.raw, b.bucket, count(*) AS n FROM e JOIN b ON e.word = b.word GROUP BY ALL),
c AS (SELECT bucket, sum(CASE WHEN raw THEN n ELSE 0 END) AS s, sum(CASE WHEN raw THEN 0 ELSE n END) AS t FROM f GROUP BY bucket),
g AS (SELECT bucket, CAST(floor(CAST(1000 AS DOUBLE) * ln((CAST(t + 1 AS DOUBLE) * CAST(sum(s) OVER () + 10000 AS DOUBLE))
        / (CAST(s + 1 AS DOUBLE) * CAST(sum(t) OVER () + 10000 AS DOUBLE)))) AS BIGINT) AS gain FROM c),
v AS (SELECT f.doc_id, sum(f.n * g.gain) AS weight FROM f JOIN g ON f.bucket = g.bucket WHERE raw GROUP BY f.doc_id),
o AS (SELECT w.doc_id, len(w.x) AS n, CAST(coalesce(v.weight, 0) AS BIGINT) AS weight, {_draws(2024, 1).replace("doc_id", "w.doc_id")}
      FROM w LEFT JOIN v ON w.doc_id = v.doc_id WHERE w.raw),
z AS (SELECT *, weight + CAST(floor(CAST(-1000 AS DOUBLE) * ln(-ln((CAST(h1 AS DOUBLE) + CAST(0.5 AS DOUBLE))
        / CAST(4294967296 AS DOUBLE)))) AS BIGINT) AS score FROM o),
r AS (SELECT *, row_number() OVER (PARTITION BY n >= 20 ORDER BY score DESC, doc_id) AS place,
        count(*) OVER (PARTITION BY n >= 20) * 10 // 100 AS drawn FROM z)
SELECT doc_id, CAST(n AS BIGINT) AS n_features, weight, score,
       CASE WHEN n >= 20 AND place <= drawn THEN CAST(place AS BIGINT) END AS rank
FROM r
"""

ORACLE_SQL: dict[str, str] = {
    "op2_warc_zip": OP2,
    "op4_jaccard_join": OP4,
    "op6_suffix_dedup": OP6,
    "op7_line_dedup": OP7,
    "op8_substring_dedup": OP8,
    "op11_fim": OP11,
    "op13_importance": OP13,
}
