"""SQL (DuckDB) for the rows of those queries that SQL can express."""

from __future__ import annotations

import string

WORDS = r"list_filter(string_split_regex({text}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"

NEAR_DUPLICATES = f"""
WITH RECURSIVE w AS (SELECT doc_id, {WORDS.format(text=f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')")} ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 4 THEN list_transform(range(1, len(ws) - 2), lambda i: array_to_string(list_slice(ws, i, i + 3), ' ')) WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) g FROM w),
n AS (SELECT doc_id, count(*) n FROM s GROUP BY doc_id),
e AS (SELECT a.doc_id u, b.doc_id v FROM s a JOIN s b USING (g) JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id WHERE a.doc_id <> b.doc_id GROUP BY u, v, na.n, nb.n HAVING 100 * count(*) >= 80 * (na.n + nb.n - count(*))),
r AS (SELECT DISTINCT u, v FROM e UNION SELECT r.u, e.v FROM r JOIN e ON r.v = e.u)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) n_shingles, least(w.doc_id, coalesce(c.least, w.doc_id)) component_id, w.doc_id <= coalesce(c.least, w.doc_id) kept
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT u doc_id, min(v) least FROM r GROUP BY u) c USING (doc_id)
"""

_ESCAPED = r"regexp_replace(regexp_replace({x}, '<(\\*)(/?s>|</?SYS>>)', '<\\\1\2', 'g'), '\[(\\*)(/?INST\])', '[\\\1\2', 'g')"
CHAT = rf"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, CAST(count(*) AS BIGINT) n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) turns_sha256,
CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) loss_chars, sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) loss_sha256,
CAST(sum(9 + length(replace(replace({_ESCAPED.format(x='role')}, chr(9226), chr(9226) || chr(9216)), chr(10), chr(9226) || chr(9217))) + length({_ESCAPED.format(x='text')})) AS BIGINT) formatted_chars
FROM t GROUP BY conv_id
"""

SUFFIXES = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) h FROM documents),
u AS (SELECT doc_id, pos, substr(h, CAST(2 * pos - 1 AS BIGINT), 2) x, length(h) // 2 n FROM (SELECT doc_id, h, unnest(range(1, length(h) // 2 + 1)) pos FROM d)),
k AS (SELECT doc_id, pos, md5(string_agg(x, '') OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING)) win, n FROM u),
f AS (SELECT doc_id, pos, win FROM k WHERE pos <= n - 49),
m AS (SELECT win, min(doc_id) lo FROM f GROUP BY win HAVING min(doc_id) < max(doc_id)),
r AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + 50)) pos FROM f JOIN m USING (win) WHERE doc_id > lo),
j AS (SELECT u.doc_id, u.pos, x, r.pos IS NOT NULL gone, lag(r.pos IS NOT NULL, 1, false) OVER (PARTITION BY u.doc_id ORDER BY u.pos) before FROM u LEFT JOIN r ON r.doc_id = u.doc_id AND r.pos = u.pos)
SELECT d.doc_id, CAST(length(h) // 2 AS BIGINT) n_bytes, CAST(coalesce(g.n, 0) AS BIGINT) n_removed, CAST(coalesce(g.spans, 0) AS BIGINT) n_spans, sha256(unhex(coalesce(g.kept, ''))) kept_sha256
FROM d LEFT JOIN (SELECT doc_id, count(*) FILTER (WHERE gone) n, count(*) FILTER (WHERE gone AND NOT before) spans, string_agg(x, '' ORDER BY pos) FILTER (WHERE NOT gone) kept FROM j GROUP BY doc_id) g USING (doc_id)
"""

PHRASES = f"""
WITH w AS (SELECT doc_id, {WORDS.format(text="coalesce(text, '')")} ws FROM documents),
u AS (SELECT doc_id, unnest(ws) x, unnest(range(1, len(ws) + 1)) pos, len(ws) n FROM w),
k AS (SELECT doc_id, pos, md5(string_agg(x, ' ') OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING)) win, n FROM u),
f AS (SELECT doc_id, pos, win FROM k WHERE pos <= n - 49),
m AS (SELECT win, min(doc_id) lo FROM f GROUP BY win HAVING min(doc_id) < max(doc_id)),
r AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + 50)) pos FROM f JOIN m USING (win) WHERE doc_id > lo)
SELECT w.doc_id, CAST(len(w.ws) AS BIGINT) n_words, CAST(coalesce(g.n, 0) AS BIGINT) n_removed, sha256(coalesce(g.kept, '')) kept_sha256
FROM w LEFT JOIN (SELECT u.doc_id, count(r.pos) n, string_agg(x, ' ' ORDER BY u.pos) FILTER (WHERE r.pos IS NULL) kept FROM u LEFT JOIN r ON r.doc_id = u.doc_id AND r.pos = u.pos GROUP BY u.doc_id) g USING (doc_id)
"""

_F = "((CAST({p} AS HUGEINT) - {q}) * (CAST({p} AS HUGEINT) - {q}) // (CAST({p} AS HUGEINT) + {q}))"
DIVERGENCE = rf"""
WITH d AS (SELECT row_number() OVER () i, coalesce(lang, '') lang, coalesce(source, '') source, translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}') text FROM documents),
t AS (SELECT i, lang, source, unnest(list_filter(string_split_regex(text, '[\x00-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '')) term FROM d),
k AS (SELECT lang, term, count(*) total FROM t GROUP BY lang, term HAVING count(DISTINCT i) >= 10),
v AS (SELECT lang, count(*) V, sum(total) M FROM k GROUP BY lang),
c AS (SELECT lang, source, term, count(*) n FROM t SEMI JOIN k USING (lang, term) GROUP BY lang, source, term),
g AS (SELECT lang, source, coalesce(N, 0) N, V, M FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN (SELECT lang, source, sum(n) N FROM c GROUP BY lang, source) USING (lang, source) LEFT JOIN v USING (lang)),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) n, 1 + (1000000000 * CAST(coalesce(c.n, 0) + 2 AS HUGEINT)) // (g.N + 2 * g.V) p, 1 + (1000000000 * CAST(k.total + 2 AS HUGEINT)) // (g.M + 2 * g.V) q FROM g JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
x AS (SELECT a.lang, a.source, b.source item, sum({_F.format(p='a.p', q='b.p')}) f FROM p a JOIN p b USING (lang, term) WHERE a.source <> b.source GROUP BY a.lang, a.source, b.source),
r AS (SELECT a.lang, a.source, 'pair' part, b.source item, coalesce(x.f, 0) f FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
UNION ALL SELECT lang, source, 'term', term, {_F.format(p='p', q='q')} FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, CAST(f AS BIGINT) AS value, CAST(rank AS INT) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY f DESC, item) rank FROM r) WHERE part = 'pair' OR rank <= 10
"""

OVERLAP = NEAR_DUPLICATES.replace("100 * count(*) >= 80 *", "100 * count(*) >= 85 *").replace(", w.doc_id <= coalesce(c.least, w.doc_id) kept", "")
