"""DuckDB SQL that states the corpus operators' results from their definitions."""

LINE_DEDUP = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
l AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS pos FROM d),
k AS (SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
often AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
f AS (SELECT k.*, o.key IS NOT NULL AND k.doc_id < o.last AS gone FROM k LEFT JOIN often o USING (key))
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (gone))::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM f GROUP BY doc_id
"""

_COVER = "".join(
    f""",
g{n} AS (SELECT doc_id, i, list_reduce([{", ".join(f"lead(w, {k}) OVER p" if k else "w" for k in range(n))}], lambda a, b: a || ' ' || b) AS gram,
                lead(w, {n - 1}) OVER p IS NOT NULL AS whole FROM w WINDOW p AS (PARTITION BY doc_id ORDER BY i)),
r{n} AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, gram) AS c FROM g{n} WHERE whole) WHERE c > 1),
c{n} AS (SELECT w.doc_id, count(*) AS n, sum(length(w.w)) AS chars FROM w
         SEMI JOIN (SELECT doc_id, unnest(range(i, i + {n})) AS i FROM r{n}) x ON x.doc_id = w.doc_id AND x.i = w.i GROUP BY w.doc_id)"""
    for n in range(5, 11)
)
QUALITY = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
w AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM d),
b AS (SELECT doc_id, length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(ws) AS n_words,
             coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars FROM d),
l AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS pos FROM d),
m AS (SELECT doc_id, length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g')) AS chars,
             row_number() OVER (PARTITION BY doc_id, line ORDER BY pos) AS nth FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
dup AS (SELECT doc_id, count(*) AS n_dup_lines, sum(chars) AS dup_line_chars FROM m WHERE nth > 1 GROUP BY doc_id){_COVER},
j AS (SELECT b.doc_id, n_words::BIGINT AS n_words, word_chars, n_symbols::BIGINT AS n_symbols,
             coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(c5.n, 0)::BIGINT AS n_repeat_words,
             coalesce(dup_line_chars, 0)::BIGINT AS dup_line_chars, coalesce(c5.chars, 0)::BIGINT AS dup_gram_chars,
             n_words < 10 OR 100 * coalesce(c5.n, 0) > 20 * n_words AS base_failed,
             100 * coalesce(dup_line_chars, 0) > 30 * word_chars OR 100 * coalesce(c5.chars, 0) > 20 * word_chars
             OR 100 * coalesce(c6.chars, 0) > 19 * word_chars OR 100 * coalesce(c7.chars, 0) > 18 * word_chars
             OR 100 * coalesce(c8.chars, 0) > 17 * word_chars OR 100 * coalesce(c9.chars, 0) > 16 * word_chars
             OR 100 * coalesce(c10.chars, 0) > 15 * word_chars AS bad
      FROM b LEFT JOIN dup USING (doc_id) LEFT JOIN c5 USING (doc_id) LEFT JOIN c6 USING (doc_id) LEFT JOIN c7 USING (doc_id)
             LEFT JOIN c8 USING (doc_id) LEFT JOIN c9 USING (doc_id) LEFT JOIN c10 USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT bad AS kept,
       dup_line_chars, dup_gram_chars FROM j
"""

TOP_K = r"""
WITH v AS (SELECT vec_id, row_number() OVER () AS row, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, v.vec_id, max(coalesce(list_sum(list_transform(list_zip(q.e, v.e), lambda p: p[1] * p[2])), 0))::BIGINT AS score
      FROM v q JOIN v ON q.vec_id % 50 = 0 AND v.vec_id <> q.vec_id AND len(q.e) = len(v.e) GROUP BY q.vec_id, v.vec_id, v.row)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
FROM s QUALIFY rank <= 5
"""


def _licences() -> str:
    from .licenses import CUT, LOWER, RULES, SENTENCES, UPPER

    known = ", ".join(f"('{name}', '{sentence}')" for name, sentence in SENTENCES.items())
    rules = ", ".join(f"('{licence}', '{kind}', '%{'%'.join(f'<{i}>' for i in ids)}%')" for licence, kind, ids in RULES)
    return rf"""
WITH known(name, sentence) AS (VALUES {known}), rules(licence, kind, pattern) AS (VALUES {rules}),
s AS (SELECT doc_id, unnest(p) AS part, generate_subscripts(p, 1) AS pos FROM (SELECT doc_id,
      string_split(regexp_replace(translate(text, '{UPPER}', '{LOWER}'), '{CUT}', chr(10), 'g'), chr(10)) AS p FROM documents)),
k AS (SELECT doc_id, pos, name FROM s JOIN known ON sentence = trim(regexp_replace(part, '[^a-z0-9]+', ' ', 'g'))),
q AS (SELECT doc_id, count(*) AS n, string_agg(name, ' ' ORDER BY pos) AS ids, '<' || string_agg(name, '><' ORDER BY pos) || '>' AS line FROM k GROUP BY doc_id),
m AS (SELECT doc_id, string_agg(DISTINCT licence, ',' ORDER BY licence) AS licences, string_agg(DISTINCT kind, ',' ORDER BY kind) AS classes
      FROM q JOIN rules ON line LIKE pattern GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_known, coalesce(ids, '') AS identifiers, coalesce(licences, '') AS licences, coalesce(classes, '') AS classes
FROM documents d LEFT JOIN q USING (doc_id) LEFT JOIN m USING (doc_id)
"""


LICENCES = _licences()

URL_FILTERS = r"""
WITH u AS (SELECT page_id, lower(url) AS url, DATE '2024-01-01' + (page_id % 366)::INTEGER AS fetched FROM pages),
h AS (SELECT *, nullif(regexp_extract(url, '^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?(\[[^\]/?#]*\]|[^/?#:\[]+)', 1), '') AS host,
             nullif(regexp_extract(url, '^[a-z][a-z0-9+.\-]*://[^/?#]*(/[^/?#]*)', 1), '') AS path FROM u),
c AS (SELECT *, nullif(regexp_extract(host, '((?:[^.]+\.){0,2}[^.]+)$', 1), '') AS site, host || path AS prefix FROM h),
keys AS (SELECT DISTINCT scope, pattern FROM (SELECT 'host' AS scope, host AS pattern FROM c UNION ALL SELECT 'site', site FROM c
         UNION ALL SELECT 'prefix', prefix FROM c) WHERE pattern IS NOT NULL),
x AS (SELECT *, md5(scope || ' ' || pattern) AS m FROM keys),
y AS (SELECT scope, pattern, ('0x' || m[1:3])::INTEGER AS a, ('0x' || m[4:6])::INTEGER AS b, ('0x' || m[7:9])::INTEGER AS c FROM x
      WHERE ('0x' || m[10:12])::INTEGER % 3 = 0),
e AS (SELECT scope, pattern, a % 300 AS day, true AS listed FROM y UNION ALL SELECT scope, pattern, a % 300 + 1 + b % 60, false FROM y WHERE b % 2 = 0
      UNION ALL SELECT scope, pattern, a % 300 + 70 + c % 60, true FROM y WHERE b % 2 = 0 AND c % 2 = 0),
now AS (SELECT c.page_id, k.scope, arg_max(e.listed, (e.day, e.listed)) AS listed, arg_max(DATE '2024-01-01' + e.day, (e.day, e.listed)) AS since
        FROM c, LATERAL (SELECT 'host' AS scope, c.host AS key UNION ALL SELECT 'site', c.site UNION ALL SELECT 'prefix', c.prefix) k
        JOIN e ON e.scope = k.scope AND e.pattern = k.key AND DATE '2024-01-01' + e.day <= c.fetched GROUP BY ALL),
a AS (SELECT page_id, max(since) FILTER (scope = 'host') AS host_since, max(since) FILTER (scope = 'site') AS site_since,
             max(since) FILTER (scope = 'prefix') AS prefix_since FROM now WHERE listed GROUP BY page_id)
SELECT c.page_id, c.host, host_since::VARCHAR AS host_since, site_since::VARCHAR AS site_since, prefix_since::VARCHAR AS prefix_since, coalesce(host_since, site_since, prefix_since) IS NOT NULL AS blocked
FROM c LEFT JOIN a USING (page_id)
"""

CHAT = r"""
WITH RECURSIVE t AS (SELECT conv_id, turn, coalesce(role, '') AS role, text, count(*) AS n FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL GROUP BY ALL),
a AS (SELECT *, CASE WHEN EXISTS (SELECT 1 FROM t x WHERE x.conv_id = t.conv_id AND x.turn = t.turn - 2 AND x.role <> 'assistant') THEN turn - 2
                     WHEN EXISTS (SELECT 1 FROM t x WHERE x.conv_id = t.conv_id AND x.turn = t.turn - 1 AND x.role <> 'assistant') THEN turn - 1 END AS up
      FROM t WHERE role <> 'assistant'),
d AS (SELECT conv_id, turn, 0 AS depth FROM a WHERE up IS NULL
      UNION ALL SELECT a.conv_id, a.turn, d.depth + 1 FROM d JOIN a ON a.conv_id = d.conv_id AND a.up = d.turn),
r AS (SELECT conv_id, turn - 1 AS turn, text FROM t WHERE role = 'assistant'),
j AS (SELECT coalesce(a.conv_id, r.conv_id) AS conv, coalesce(a.turn, r.turn) AS turn, a.turn IS NOT NULL AS called, r.turn IS NOT NULL AS answered,
             d.depth, a.role, a.text, r.text AS content, coalesce(a.n, 0) AS copies,
             list_aggregate(list_filter([CASE WHEN a.turn IS NOT NULL AND a.text IS NULL THEN 'text: missing' END, CASE WHEN role NOT IN ('user', 'system') THEN 'role: not in enum' END,
               CASE WHEN a.text IS NOT NULL AND length(a.text) NOT BETWEEN 1 AND 2000 THEN 'text: length' END,
               CASE WHEN a.turn < 0 THEN 'turn: range' END], lambda x: x IS NOT NULL), 'string_agg', '; ') AS errors
      FROM a LEFT JOIN d USING (conv_id, turn) FULL JOIN r ON r.conv_id = a.conv_id AND r.turn = a.turn)
SELECT conv, turn::VARCHAR AS call_id, depth::BIGINT AS depth, copies::BIGINT AS copies,
       CASE WHEN NOT called THEN 'orphan_result' WHEN errors <> '' THEN 'invalid' WHEN answered THEN 'ok' ELSE 'no_result' END AS status,
       CASE WHEN called THEN coalesce(errors, '') ELSE '' END AS errors,
       '{"call":' || CASE WHEN called THEN '{"arguments":{"role":' || to_json(role) || CASE WHEN text IS NULL THEN '' ELSE ',"text":' || to_json(text) END || ',"turn":' || turn || '},"id":"' || turn || '","name":"reply"}' ELSE 'null' END
       || ',"order":' || coalesce(depth::VARCHAR, 'null') || ',"result":'
       || CASE WHEN answered THEN '{"content":' || coalesce(to_json(content)::VARCHAR, 'null') || ',"id":"' || turn || '"}' ELSE 'null' END || '}' AS json
FROM j
"""
