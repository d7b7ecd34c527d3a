"""DuckDB SQL for the numbered queries that SQL can express."""

#: Pairs (a, b) to the smallest id that each id reaches; ids holds all of them.
_COMPONENTS = """
reach(id, other) AS (
    SELECT a, b FROM links UNION SELECT b, a FROM links
    UNION
    SELECT r.id, l.other FROM reach r JOIN (SELECT a AS id, b AS other FROM links UNION ALL SELECT b, a FROM links) l ON r.other = l.id
),
least AS (SELECT id, min(other) AS low FROM reach GROUP BY id)
"""

OP1 = f"""
WITH RECURSIVE
good AS (
    SELECT vec_id AS id, embedding::DOUBLE[] AS x FROM embeddings
    WHERE embedding IS NOT NULL AND list_count(embedding) = len(embedding) AND len(list_filter(embedding, lambda v: NOT isfinite(v))) = 0
      AND len(list_filter(embedding, lambda v: v <> 0)) > 0
),
links AS (SELECT p.id AS a, q.id AS b FROM good p JOIN good q ON p.id < q.id WHERE list_cosine_similarity(p.x, q.x) >= 0.9),
{_COMPONENTS}, degree AS (SELECT id, count(*) AS n FROM (SELECT a AS id FROM links UNION ALL SELECT b FROM links) GROUP BY id)
SELECT e.vec_id, coalesce(d.n, 0)::BIGINT AS n_links, least(e.vec_id, coalesce(l.low, e.vec_id))::BIGINT AS component_id,
       e.vec_id = least(e.vec_id, coalesce(l.low, e.vec_id)) AS kept
FROM embeddings e LEFT JOIN degree d ON d.id = e.vec_id LEFT JOIN least l ON l.id = e.vec_id
"""

_BLANK = "[\\x09-\\x0D\\x1C-\\x20\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]"

OP4 = f"""
WITH cut AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents WHERE text IS NOT NULL
),
placed AS (
    SELECT doc_id, line, coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM cut
),
units AS (
    SELECT doc_id, (start + length(regexp_extract(line, '^{_BLANK}*')))::INTEGER AS begin_at, (start + length(regexp_replace(line, '{_BLANK}+$', '')))::INTEGER AS end_at,
           trim(regexp_replace(lower(line), '{_BLANK}+', ' ', 'g')) AS normal FROM placed
),
ranked AS (
    SELECT *, first_value(doc_id) OVER w AS keep_doc_id, first_value(begin_at) OVER w AS keep_begin, row_number() OVER w AS k FROM units WHERE normal <> ''
    WINDOW w AS (PARTITION BY normal ORDER BY doc_id NULLS LAST, begin_at)
)
SELECT doc_id, begin_at AS "begin", end_at AS "end", len(string_split(normal, ' '))::INTEGER AS n_words, keep_doc_id, keep_begin FROM ranked WHERE k > 1
"""

OP7 = """
WITH turns AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS k,
           coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations WHERE conv_id IS NOT NULL
),
shown AS (
    SELECT *, '<|im_start|>' || replace(role, '<|', '< |') || chr(10) AS open, replace(text, '<|', '< |') || '<|im_end|>' || chr(10) AS body FROM turns
),
heads AS (SELECT conv_id, role || chr(1) || text AS head FROM turns WHERE k = 1),
pairs AS (
    SELECT a.conv_id AS chosen_id, b.conv_id AS rejected_id FROM heads a JOIN heads b ON a.conv_id % 2 = 0 AND b.conv_id = a.conv_id + 1
    UNION
    SELECT f.first, h.conv_id FROM heads h JOIN (SELECT head, min(conv_id) AS first FROM heads GROUP BY head) f USING (head) WHERE h.conv_id > f.first
),
sizes AS (SELECT conv_id, max(k) AS size FROM turns GROUP BY conv_id),
common AS (
    SELECT p.*, least(x.size, y.size,
        (SELECT coalesce(min(a.k) - 1, 1000000000) FROM turns a JOIN turns b ON a.k = b.k WHERE a.conv_id = p.chosen_id AND b.conv_id = p.rejected_id AND (a.role <> b.role OR a.text <> b.text))) AS n
    FROM pairs p JOIN sizes x ON x.conv_id = p.chosen_id JOIN sizes y ON y.conv_id = p.rejected_id
),
prompts AS (
    SELECT c.chosen_id, c.rejected_id, string_agg(s.open || s.body, '' ORDER BY s.k) AS prompt
    FROM common c JOIN shown s ON s.conv_id = c.chosen_id AND s.k <= c.n GROUP BY ALL
),
placed AS (
    SELECT c.chosen_id, c.rejected_id, side, s.k, s.role, s.open, s.body,
           sum(length(s.open) + length(s.body)) OVER (PARTITION BY c.chosen_id, c.rejected_id, side ORDER BY s.k) AS last
    FROM common c CROSS JOIN (VALUES ('chosen'), ('rejected')) v(side) JOIN shown s ON s.conv_id = CASE side WHEN 'chosen' THEN c.chosen_id ELSE c.rejected_id END AND s.k > c.n
),
sides AS (
    SELECT chosen_id, rejected_id, side, string_agg(open || body, '' ORDER BY k) AS text,
           string_agg(((last - length(body))::BIGINT)::VARCHAR || ':' || (last::BIGINT)::VARCHAR, ',' ORDER BY k) FILTER (role = 'assistant') AS mask
    FROM placed GROUP BY ALL
)
SELECT c.chosen_id, c.rejected_id, c.n::INTEGER AS n_prompt_turns, coalesce(p.prompt, '') AS prompt, coalesce(a.text, '') AS chosen, coalesce(b.text, '') AS rejected,
       coalesce(a.mask, '') AS chosen_mask, coalesce(b.mask, '') AS rejected_mask
FROM common c LEFT JOIN prompts p USING (chosen_id, rejected_id)
LEFT JOIN (SELECT * FROM sides WHERE side = 'chosen') a USING (chosen_id, rejected_id)
LEFT JOIN (SELECT * FROM sides WHERE side = 'rejected') b USING (chosen_id, rejected_id)
"""

OP8 = f"""
WITH RECURSIVE
words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
),
sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s FROM words
),
sizes AS MATERIALIZED (SELECT doc_id, len(s) AS n FROM sets),
items AS MATERIALIZED (SELECT doc_id, hash(unnest(s)) AS h FROM sets),
links AS MATERIALIZED (
    SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM items x JOIN items y ON x.h = y.h AND x.doc_id < y.doc_id GROUP BY ALL) m
    JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * shared >= 85 * (p.n + q.n - shared)
),
{_COMPONENTS}
SELECT z.doc_id, z.n::BIGINT AS n_shingles, least(z.doc_id, coalesce(l.low, z.doc_id))::BIGINT AS component_id,
       z.doc_id = least(z.doc_id, coalesce(l.low, z.doc_id)) AS kept
FROM sizes z LEFT JOIN least l ON l.id = z.doc_id
"""

_DIVERGE = "(p.p::HUGEINT - q.p) * (p.p::HUGEINT - q.p) // (p.p::HUGEINT + q.p)"

OP12 = f"""
WITH docs AS (
    SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms FROM documents
),
words AS (SELECT k, lang, source, unnest(terms) AS term FROM docs),
kept AS MATERIALIZED (SELECT lang, term FROM words GROUP BY ALL HAVING count(DISTINCT k) >= 10),
groups AS (SELECT DISTINCT lang, source FROM docs),
found AS (SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY ALL),
filled AS (SELECT g.lang, g.source, t.term, coalesce(f.n, 0) AS n FROM groups g JOIN kept t USING (lang) LEFT JOIN found f USING (lang, source, term)),
shares AS MATERIALIZED (
    SELECT lang, source, term, n, 1 + (1000000000::HUGEINT * (n + 2)) // (sum(n) OVER w + 2 * count(*) OVER w) AS p FROM filled WINDOW w AS (PARTITION BY lang, source)
),
per_lang AS (SELECT lang, term, sum(n) AS n FROM filled GROUP BY ALL),
of_lang AS (SELECT lang, term, 1 + (1000000000::HUGEINT * (n + 2)) // (sum(n) OVER w + 2 * count(*) OVER w) AS p FROM per_lang WINDOW w AS (PARTITION BY lang)),
pairs AS (SELECT a.lang, a.source, b.source AS item FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source),
summed AS (SELECT p.lang, p.source, q.source AS item, sum({_DIVERGE}) AS value FROM shares p JOIN shares q ON p.lang = q.lang AND p.term = q.term AND p.source <> q.source GROUP BY ALL),
parts AS (
    SELECT lang, source, 'pair' AS part, item, coalesce(value, 0)::BIGINT AS value FROM pairs LEFT JOIN summed USING (lang, source, item)
    UNION ALL
    SELECT p.lang, p.source, 'term', p.term, ({_DIVERGE})::BIGINT FROM shares p JOIN of_lang q USING (lang, term) WHERE p.n > 0 AND p.p > q.p
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM parts)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 10
"""

# Remainders of one byte, by their rule; a row's checksum is folded over the digits of its id.
_CRC_TABLE = "list_transform(range(256), lambda n: list_reduce(list_prepend(n::UBIGINT, [k::UBIGINT FOR k IN range(8)]), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END))"
_CRC = "xor(list_reduce(list_prepend(4294967295::UBIGINT, [ascii(d)::UBIGINT FOR d IN string_split(doc_id::VARCHAR, '')]), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255)::BIGINT + 1])), 4294967295::UBIGINT)::BIGINT"

OP13 = f"""
WITH crc AS MATERIALIZED (SELECT {_CRC_TABLE} AS t),
docs AS (
    SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w, {_CRC} AS h FROM documents, crc
),
placed AS (SELECT *, len(w)::BIGINT AS n, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a, (h // 10) % 8 AS g8 FROM docs),
words AS MATERIALIZED (
    SELECT k, i, CASE WHEN i >= a THEN w[a + (i - a) % (1 + (n - a) // (3 + g8)) + 1] ELSE w[i + 1] END AS word FROM (SELECT *, unnest(range(n)) AS i FROM placed)
),
sizes AS (SELECT k, n FROM placed),
same AS (SELECT x.k, x.i, y.i - x.i AS q FROM words x JOIN words y ON x.k = y.k AND x.word = y.word AND x.i < y.i JOIN sizes s ON s.k = x.k WHERE 2 * (y.i - x.i) <= s.n),
islands AS (SELECT k, q, i, i - row_number() OVER (PARTITION BY k, q ORDER BY i) AS island FROM same),
stretches AS MATERIALIZED (SELECT k, q, min(i) AS start, count(*) + q AS length FROM islands GROUP BY k, q, island HAVING count(*) + q >= greatest(12, 2 * q)),
runs AS MATERIALIZED (
    SELECT * FROM stretches r WHERE NOT EXISTS (SELECT 1 FROM stretches s WHERE s.k = r.k AND s.q < r.q AND s.start <= r.start AND s.start + s.length >= r.start + r.length)
),
per_doc AS (
    SELECT k, count(*) AS n_runs, string_agg(start || ',' || length || ',' || q || chr(10), '' ORDER BY start, q) AS lines, min([-length, start, q]) AS best FROM runs GROUP BY k
),
gone AS (SELECT DISTINCT w.k, w.i FROM words w JOIN runs r ON r.k = w.k AND w.i >= r.start + r.q AND w.i < r.start + r.length),
kept AS (SELECT k, string_agg(word, ' ' ORDER BY i) AS text FROM words w WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.k = w.k AND g.i = w.i) GROUP BY k)
SELECT p.doc_id, coalesce(d.n_runs, 0)::BIGINT AS n_runs, d.best[2]::BIGINT AS start, (-d.best[1])::BIGINT AS length, d.best[3]::BIGINT AS period,
       (1000 * -d.best[1] // d.best[3])::BIGINT AS exponent_milli, sha256(coalesce(d.lines, '')) AS runs_sha256, sha256(coalesce(t.text, '')) AS collapsed_sha256
FROM placed p LEFT JOIN per_doc d USING (k) LEFT JOIN kept t USING (k)
"""
