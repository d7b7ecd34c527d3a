"""DuckDB SQL for the registered queries, over the same derived inputs."""

from __future__ import annotations

from chemlake.plans import inputs, known_structures
from chemlake.plans.inputs import duck, inchikey, number


def _digits(x: str) -> str:
    return f"regexp_replace({x}, '[^0-9]', '', 'g')"


def _sum_ok(x: str) -> str:
    d = _digits(x)
    return f"(coalesce(list_sum(list_transform(range(1, length({d})), lambda i: TRY_CAST(substr({d}, length({d}) - i, 1) AS INT) * i)), 0) % 10 = TRY_CAST(right({d}, 1) AS INT))"


def _valid(x: str) -> str:
    return rf"coalesce(regexp_full_match(trim({x}), '\d{{1,7}}-\d{{2}}-\d') AND regexp_matches({x}, '[1-9]') AND {_sum_ok(x)}, false)"


def _cut(d: str) -> str:
    return f"(substr({d}, 1, length({d}) - 3) || '-' || substr({d}, length({d}) - 2, 2) || '-' || right({d}, 1))"


def _bare(x: str) -> str:
    """Without leading zeros."""
    return f"regexp_replace({x}, '^0+([0-9])', '\\1')"


_ALL_ZERO = "coalesce(regexp_full_match(regexp_replace(token, '[^0-9]', '', 'g'), '0+'), false)"
_TOKENS = rf"""cells AS ({duck(inputs.CELLS)}),
split AS (SELECT row, code, name, list_filter(list_transform(regexp_split_to_array(cas, '[\\/;,\r\n\t ]+'), lambda t: trim(t)), lambda t: t <> '') AS ts FROM cells),
toks AS (SELECT row, code, name, pos, token FROM (SELECT row, code, name, unnest(range(0, len(ts))) AS pos, unnest(ts) AS token FROM split) WHERE NOT {_ALL_ZERO})"""

_DATE_SHAPE = r"(\d{2,7})-(\d{2})-(\d{2})(?:\s+\d{2}:\d{2}:\d{2})?"
_HIDDEN = rf"(regexp_extract(t, '{_DATE_SHAPE}', 1) || '-' || regexp_extract(t, '{_DATE_SHAPE}', 2) || '-' || right(regexp_extract(t, '{_DATE_SHAPE}', 3), 1))"
_FROM_DATE = rf"CASE WHEN regexp_full_match(t, '{_DATE_SHAPE}') AND regexp_matches(regexp_extract(t, '{_DATE_SHAPE}', 3), '^0[1-9]$') AND {_valid(_HIDDEN)} THEN {_HIDDEN} END"

O: dict[str, str] = {}
O["cas_tokens"] = f"WITH {_TOKENS} SELECT row, pos::INTEGER AS pos, token FROM toks"

_S = "regexp_replace(trim(raw), '[^0-9-]', '', 'g')"
O["cas_validity"] = rf"""
WITH r AS ({duck(inputs.RAW)}), s AS (SELECT key, raw, {_S} AS s, {_digits('raw')} AS d FROM r),
n AS (SELECT *, CASE WHEN contains(s, '-') THEN CASE WHEN regexp_full_match(s, '\d+-\d+-\d+') THEN {_bare("split_part(s, '-', 1)")} || '-' || CASE WHEN length(split_part(s, '-', 2)) < 2 THEN lpad(split_part(s, '-', 2), 2, '0') ELSE split_part(s, '-', 2) END || '-' || split_part(s, '-', 3)
    WHEN len(string_split(s, '-')) <> 3 AND length(d) >= 4 THEN {_bare("substr(d, 1, length(d) - 3)")} || '-' || substr(d, length(d) - 2, 2) || '-' || right(d, 1) END
    WHEN length(d) >= 4 THEN {_bare("substr(d, 1, length(d) - 3)")} || '-' || substr(d, length(d) - 2, 2) || '-' || right(d, 1) END AS rc,
    CASE WHEN regexp_full_match(s, '\d{{2,7}}-\d{{2}}-\d') THEN s WHEN length(d) >= 3 THEN {_cut('d')} END AS pc,
    CASE WHEN regexp_full_match(raw, '\s*[0-9]{{2,7}}\s*-\s*[0-9]{{2}}\s*-\s*[0-9]\s*') THEN {_bare("split_part(trim(raw), '-', 1)")} || '-' || split_part(trim(raw), '-', 2) || '-' || split_part(trim(raw), '-', 3) END AS ic FROM s)
SELECT key, {_valid('raw')} AS cleaner_valid, rc AS resolver_cas, coalesce(regexp_full_match(rc, '\d{{1,7}}-\d{{2}}-\d') AND {_sum_ok('rc')}, false) AS resolver_valid,
    CASE WHEN regexp_full_match(pc, '\d+-\d+-\d') AND {_sum_ok('pc')} THEN pc END AS property_cas, ic AS ingest_cas,
    coalesce(regexp_full_match(ic, '[0-9]{{2,7}}-[0-9]{{2}}-[0-9]') AND {_sum_ok('ic')}, false) AS ingest_ok, regexp_full_match(d, '0+') AS all_zero FROM n"""

_TC = "(t || '-' || CAST(coalesce(list_sum(list_transform(range(0, length(replace(t, '-', ''))), lambda i: TRY_CAST(substr(replace(t, '-', ''), length(replace(t, '-', '')) - i, 1) AS INT) * (i + 1))), 0) % 10 AS VARCHAR))"
O["cas_recovered"] = rf"""
WITH r AS (SELECT key, trim(raw) AS t, {_digits('raw')} AS d FROM ({duck(inputs.RAW)}))
SELECT key, {_FROM_DATE} AS from_date, CASE WHEN regexp_full_match(d, '\d{{5,10}}') AND {_valid(_cut('d'))} THEN {_cut('d')} END AS from_digits,
    CASE WHEN regexp_full_match(t, '\d{{2,7}}-\d{{2}}') AND {_valid(_TC)} THEN {_TC} END AS with_check_digit, regexp_full_match(t, '{_DATE_SHAPE}') OR regexp_full_match(t, '\d{{1,2}}/\d{{1,2}}/\d{{2,7}}') AS date_like FROM r"""

O["cas_swaps"] = rf"""
WITH r AS (SELECT key, replace(trim(raw), ' ', '') AS t FROM ({duck(inputs.RAW)})),
v AS (SELECT key, unnest(list_transform(range(1, length(t)), lambda i: substr(t, 1, i - 1) || substr(t, i + 1, 1) || substr(t, i, 1) || substr(t, i + 2))) AS x FROM r)
SELECT r.key, coalesce(string_agg(DISTINCT x, ',' ORDER BY x), '') AS swapped FROM r LEFT JOIN (SELECT * FROM v WHERE {_valid('x')}) v ON v.key = r.key GROUP BY r.key"""

O["cas_evidence"] = f"""WITH {_TOKENS}, known AS (SELECT trim(code) AS code, CASE WHEN {_valid('token')} THEN token ELSE (SELECT {_FROM_DATE} FROM (SELECT token AS t)) END AS cas FROM toks) SELECT DISTINCT code, cas FROM known WHERE cas IS NOT NULL AND code <> ''"""

# The repair ladder: distinct tokens of a code and designation, edits of those that are neither valid nor a hidden number.
_NEXT = "(VALUES ('0', '29'), ('1', '24'), ('2', '0135'), ('3', '246'), ('4', '1357'), ('5', '2468'), ('6', '3579'), ('7', '468'), ('8', '579'), ('9', '068')) n(digit, near)"
_REPAIR = rf"""{_TOKENS},
keyed AS (SELECT *, token AS t, coalesce(trim(code), '') AS ck, upper(trim(regexp_replace(name, '\s+', ' ', 'g'))) AS nk FROM toks),
looked AS (SELECT DISTINCT t, ck, nk, CASE WHEN {_valid('t')} THEN t END AS ok, {_FROM_DATE} AS hid FROM keyed),
known AS (SELECT DISTINCT ck, nk, coalesce(ok, hid) AS cas FROM looked WHERE coalesce(ok, hid) IS NOT NULL),
lost AS (SELECT t, ck, nk FROM looked WHERE coalesce(ok, hid) IS NULL),
texts AS (SELECT DISTINCT t FROM lost),
edits AS (
    SELECT t, i AS place, 'swap' AS how, substr(t, 1, i - 1) || substr(t, i + 1, 1) || substr(t, i, 1) || substr(t, i + 2) AS x FROM (SELECT t, unnest(range(1, length(t))) AS i FROM texts)
    UNION ALL
    SELECT t, 1000 + i * 10 + j, 'near', substr(t, 1, i - 1) || substr(near, j, 1) || substr(t, i + 1) FROM (SELECT t, i, near, unnest(range(1, length(near) + 1)) AS j FROM (SELECT t, unnest(range(1, length(t) + 1)) AS i FROM texts) JOIN {_NEXT} ON digit = substr(t, i, 1))
),
firsts AS (SELECT t, x, min(place) AS place, bool_or(how = 'swap') AS swap, bool_or(how = 'near') AS near FROM edits GROUP BY ALL),
dated AS (SELECT o AS t, cas, min(place) AS place, arg_min(t, place) AS via FROM (SELECT t AS o, place, x AS t, {_FROM_DATE.replace(' t,', ' x,').replace('(t,', '(x,')} AS cas FROM firsts WHERE regexp_full_match(t, '{_DATE_SHAPE}') OR regexp_full_match(t, '\d{{1,2}}/\d{{1,2}}/\d{{2,7}}')) WHERE cas IS NOT NULL GROUP BY o, cas),
swapped AS (SELECT t, x AS cas, place, x AS via FROM firsts WHERE swap AND {_valid('x')}),
neared AS (SELECT t, x AS cas, place, x AS via FROM firsts WHERE near AND regexp_full_match(t, '\d{{1,7}}-\d{{2}}-\d') AND {_valid('x')}),
found AS (SELECT *, 'date' AS kind FROM dated UNION ALL SELECT *, 'swap' FROM swapped WHERE t NOT IN (SELECT t FROM dated) UNION ALL SELECT *, 'near' FROM neared WHERE t NOT IN (SELECT t FROM dated UNION SELECT t FROM swapped)),
scored AS (SELECT l.t, l.ck, l.nk, f.kind, f.place, f.cas, f.via,
    CASE WHEN l.ck <> '' AND EXISTS (SELECT 1 FROM known k WHERE k.ck = l.ck AND k.cas = f.cas) THEN 2 ELSE 0 END + CASE WHEN l.nk <> '' AND EXISTS (SELECT 1 FROM known k WHERE k.nk = l.nk AND k.cas = f.cas) THEN 1 ELSE 0 END AS score FROM lost l JOIN found f ON f.t = l.t),
ranked AS (SELECT *, row_number() OVER (PARTITION BY t, ck, nk ORDER BY score DESC, place) AS k, row_number() OVER (PARTITION BY t, ck, nk ORDER BY place) AS p FROM scored),
judged AS (SELECT t, ck, nk, any_value(kind) AS kind, count(*) AS n, max(cas) FILTER (k = 1) AS cas, max(via) FILTER (k = 1) AS via, max(score) FILTER (k = 1) AS best, max(score) FILTER (k = 2) AS next,
    string_agg(cas, ' | ' ORDER BY k) FILTER (k <= 5) AS byrank, string_agg(cas || ' (via ' || via || ')', ' | ' ORDER BY p) FILTER (p <= 5) AS byplace FROM ranked GROUP BY t, ck, nk),
taken AS (SELECT *, (best > 0 AND coalesce(next < best, true)) OR (kind = 'swap' AND n = 1) AS sure FROM judged),
ends AS (SELECT t, ck, nk, CASE WHEN regexp_full_match(d, '\d{{5,10}}') AND {_valid(_cut('d'))} THEN {_cut('d')} END AS dashed, CASE WHEN regexp_full_match(t, '\d{{2,7}}-\d{{2}}') AND {_valid(_TC)} THEN {_TC} END AS checked FROM (SELECT *, {_digits('t')} AS d FROM lost)),
decided AS (
    SELECT t, ck, nk, coalesce(ok, hid) AS fixed, CASE WHEN ok IS NOT NULL THEN 'valid' ELSE 'valid (fixed from: ' || t || ')' END AS status FROM looked WHERE coalesce(ok, hid) IS NOT NULL
    UNION ALL
    SELECT t, ck, nk, CASE WHEN sure THEN cas ELSE t END, CASE WHEN NOT sure THEN 'invalid (original: ' || t || '; suggestions: ' || CASE kind WHEN 'date' THEN byplace ELSE byrank END || ')'
        WHEN kind = 'date' THEN 'valid (fixed via date-edit from: ' || t || '; via: ' || via || ')' WHEN kind = 'swap' THEN 'valid (fixed swap from: ' || t || ')' ELSE 'valid (fixed adjacent-key from: ' || t || ')' END FROM taken
    UNION ALL
    SELECT t, ck, nk, coalesce(dashed, checked, t), CASE WHEN dashed IS NOT NULL THEN 'valid (fixed rehyphenated from: ' || t || ')' WHEN checked IS NOT NULL THEN 'valid (fixed checkdigit from: ' || t || ')' ELSE 'invalid (original: ' || t || ')' END
    FROM ends e WHERE NOT EXISTS (SELECT 1 FROM taken x WHERE x.t = e.t AND x.ck = e.ck AND x.nk = e.nk)
),
repaired AS (SELECT k.row, k.code, k.name, k.pos::INTEGER AS pos, k.token, d.fixed, d.status FROM keyed k JOIN decided d ON d.t = k.t AND d.ck = k.ck AND d.nk = k.nk)"""
O["cas_repair"] = f"WITH {_REPAIR} SELECT * FROM repaired"
O["cas_fixed_cells"] = f"""WITH {_REPAIR} SELECT c.row, coalesce(string_agg(CASE WHEN {_valid('r.fixed')} THEN r.fixed ELSE r.token || ' (invalid)' END, ' / ' ORDER BY r.pos), '') AS fixed_cas FROM cells c LEFT JOIN repaired r ON r.row = c.row GROUP BY c.row"""
O["cas_first_tokens"] = f"""WITH {_REPAIR} SELECT c.row, c.code, c.name, coalesce(r.fixed, '') AS cas, coalesce(r.status, 'invalid (original: )') AS status
    FROM cells c LEFT JOIN (SELECT row, arg_min(fixed, pos) AS fixed, arg_min(status, pos) AS status FROM repaired GROUP BY row) r ON r.row = c.row"""
_FIRST = "first_valid AS (SELECT DISTINCT 'c1' AS customer_id, c.code, c.name, coalesce(r.fixed, '') AS cas FROM cells c LEFT JOIN (SELECT row, arg_min(fixed, pos) AS fixed FROM repaired GROUP BY row) r ON r.row = c.row)"
O["cas_first_valid"] = f"WITH {_REPAIR}, {_FIRST} SELECT * FROM first_valid"
O["cas_run_counts"] = f"""WITH {_REPAIR}, {_FIRST}, exploded AS (SELECT DISTINCT code, name, fixed, status FROM repaired)
    SELECT (SELECT count(*) FROM cells) AS rows_input, (SELECT count(*) FROM exploded) AS rows_exploded, (SELECT count(DISTINCT fixed) FROM exploded) AS unique_cas_exploded, (SELECT count(*) FROM first_valid) AS rows_first_valid, (SELECT count(DISTINCT cas) FROM first_valid) AS unique_cas_first_valid"""
O["cas_exploded_table"] = f"WITH {_REPAIR} SELECT DISTINCT 'c1' AS customer_id, '2024-06-01T00:00:00Z' AS timestamp_seen_utc, code, name, fixed AS cas, status AS cas_validity FROM repaired"

_BLOCK = "TRY_CAST(split_part(cas, '-', 1) AS BIGINT)"
# What first blocks and parts of names stand for.
_CAS_KIND = """CASE WHEN b >= 90000 THEN 'natural product / UVCB' WHEN b BETWEEN 80000 AND 89999 THEN 'fragrance mixture' WHEN b BETWEEN 60000 AND 69999 THEN 'polymer / complex mixture' END"""
_NAME_KIND = """CASE WHEN regexp_matches(lower(name), 'ess|essential oil|eo|abs|absolute|extract|ext|he|huile|resinoid|oleoresin|infusion|balsam|tincture') THEN 'natural product / UVCB'
    WHEN regexp_matches(lower(name), 'mix|compound|accord|blend|fragrance|perfume|aroma') THEN 'fragrance mixture' WHEN regexp_matches(lower(name), 'poly|polymer|copolymer|oligomer|resin') THEN 'polymer / complex mixture' END"""
O["mixture_class"] = f"""
WITH p AS (SELECT p_partkey, CAST(p_partkey * 97 % 99000 + 100 AS VARCHAR) || '-00-1' AS cas, p_name AS name, CASE WHEN p_partkey % 5 = 0 THEN 'C.C' ELSE 'CC' END AS smiles FROM part),
k AS (SELECT *, {_BLOCK} AS b FROM p), j AS (SELECT p_partkey, coalesce({_CAS_KIND}, {_NAME_KIND}, CASE WHEN contains(smiles, '.') THEN 'mixture (multi-component structure)' END, 'single substance') AS kind, coalesce({_CAS_KIND}, 'single substance') AS block_kind FROM k)
SELECT *, CASE kind WHEN 'natural product / UVCB' THEN 'uvcb' WHEN 'single substance' THEN 'valid' ELSE 'mixture' END AS status FROM j"""

_ASCII = "regexp_replace(strip_accents({}), '[^\\x00-\\x7F]', '', 'g')"
_SPACE = "[\\x09-\\x0D\\x20\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]+"
O["ascii_names"] = f"""WITH t AS (SELECT doc_id, text, lower(trim(regexp_replace(coalesce(text, ''), '{_SPACE}', ' ', 'g'))) AS low FROM documents)
    SELECT doc_id, regexp_replace({_ASCII.format('low')}, '[,.;:]+$', '') AS resolver_name, length(strip_accents(text)) AS n, trim(regexp_replace(lower(text), '[^a-z0-9\\s\\x0B]', '', 'g'), ' ') AS entity_name FROM t"""

O["identifiers"] = f"""SELECT c_custkey AS key, CASE c_custkey % 6 WHEN 0 THEN 'cas' WHEN 1 THEN 'inchikey' WHEN 2 THEN 'inchi' WHEN 3 THEN 'smiles' WHEN 4 THEN 'smiles' ELSE 'name' END AS kind,
    CASE c_custkey % 6 WHEN 0 THEN {number('c_custkey')} WHEN 1 THEN {inchikey('c_custkey')} WHEN 2 THEN 'InChI=1S/CH4/h1H4' WHEN 3 THEN 'C1CC1' WHEN 4 THEN c_name ELSE 'cco' END AS normal FROM customer"""

_REG = ("cas_input", "cas_status", "inchi", "smiles", "mixture_type")
_MERGE = f"""
inc AS (SELECT * REPLACE (CASE WHEN cas_status IN ('valid', 'invalid', 'mixture') THEN cas_status ELSE 'unresolved' END AS cas_status) FROM ({duck(inputs.INCOMING)})),
good AS (SELECT *, _row AS o FROM inc WHERE cas_number_normalized <> '' AND cas_status <> 'invalid'),
allrows AS (SELECT *, -1::BIGINT AS o FROM ({duck(inputs.KNOWN)}) UNION ALL BY NAME SELECT * EXCLUDE (_row) FROM good),
fold AS (
    SELECT cas_number_normalized, inchi_key, {', '.join(f"coalesce(arg_min({c}, o) FILTER ({c} <> ''), '') AS {c}" for c in _REG)},
        max(resolver_confidence) AS resolver_confidence, arg_max(resolver_source, (resolver_confidence, -o)) AS resolver_source, max(resolution_timestamp_utc) AS resolution_timestamp_utc, min(o) AS first, count(*) FILTER (o >= 0) AS fresh
    FROM allrows GROUP BY ALL
),
texts AS (SELECT cas_number_normalized, inchi_key, string_agg(evidence, ' | ' ORDER BY o) AS evidence FROM (SELECT cas_number_normalized, inchi_key, evidence, min(o) AS o FROM allrows GROUP BY ALL) GROUP BY ALL),
said AS (SELECT cas_number_normalized, inchi_key, string_agg(notes, ' | ' ORDER BY o) AS notes FROM (SELECT cas_number_normalized, inchi_key, notes, min(o) AS o FROM allrows WHERE notes <> '' GROUP BY ALL) GROUP BY ALL),
many AS (SELECT cas_number_normalized, true AS dup, string_agg(DISTINCT inchi_key, ', ' ORDER BY inchi_key) AS keys FROM fold WHERE inchi_key <> '' AND cas_status NOT IN ('mixture', 'uvcb') GROUP BY cas_number_normalized HAVING count(DISTINCT inchi_key) >= 2),
merged AS (
    SELECT f.cas_input, f.cas_number_normalized, CASE WHEN m.dup AND f.inchi_key <> '' AND f.cas_status NOT IN ('mixture', 'uvcb') THEN 'ambiguous' ELSE f.cas_status END AS cas_status, f.inchi_key, f.inchi, f.smiles, f.resolver_source,
        f.resolver_confidence, f.resolution_timestamp_utc, t.evidence, coalesce(n.notes, '') AS notes, f.mixture_type, f.first, f.fresh
    FROM fold f JOIN texts t USING (cas_number_normalized, inchi_key) LEFT JOIN said n USING (cas_number_normalized, inchi_key) LEFT JOIN many m USING (cas_number_normalized)
)"""
O["db2_upsert"] = f"WITH {_MERGE} SELECT * EXCLUDE (first, fresh) FROM merged"
O["db2_audit"] = f"""WITH {_MERGE} SELECT CASE WHEN first >= 0 THEN 'insert_new_mapping' ELSE 'update_existing_mapping' END AS event, cas_number_normalized, inchi_key,
        CASE WHEN first >= 0 THEN 'Inserted new mapping row.' ELSE 'Filled blanks, kept the best confidence and the latest time.' END AS details FROM merged WHERE first >= 0 OR fresh > 0
    UNION ALL SELECT 'cas_conflict_mark_ambiguous', cas_number_normalized, '', 'Number maps to several keys: ' || keys FROM many"""
O["db2_rejected"] = f"WITH {_MERGE} SELECT cas_input, CASE WHEN cas_number_normalized = '' THEN 'missing cas_number_normalized' ELSE 'cas_status=invalid' END AS rejected_reason FROM inc WHERE cas_number_normalized = '' OR cas_status = 'invalid'"
O["db2_summary"] = f"WITH {_MERGE} SELECT count(*) AS total, count(*) FILTER (cas_status = 'valid' AND inchi_key <> '') AS joinable, count(*) FILTER (cas_status = 'ambiguous') AS ambiguous, count(*) FILTER (cas_status IN ('mixture', 'uvcb')) AS mixtures FROM merged"

_COLS = ("inchi", "smiles", "computed_mw", "experimental_logp", "alcohol_count")
_first = lambda src, where="true": f"(SELECT inchi_key, {', '.join(f'arg_min({c}, _row) FILTER ({c} IS NOT NULL) AS {c}' for c in _COLS)} FROM {src} WHERE inchi_key <> 'bad' AND {where} GROUP BY inchi_key)"
_PROPS = f"props AS ({duck(inputs.PROPERTIES)})"
O["db1_dedupe"] = f"WITH {_PROPS} SELECT * FROM {_first('props')}"
O["db1_rejects"] = f"WITH {_PROPS} SELECT _row, inchi_key FROM props WHERE inchi_key = 'bad'"
_TWO = f"{_PROPS}, a AS {_first('props', '_row % 2 = 1')}, b AS {_first('props', '_row % 2 = 0')}"
O["db1_upsert"] = f"""WITH {_TWO} SELECT coalesce(a.inchi_key, b.inchi_key) AS inchi_key, CASE WHEN a.inchi_key IS NULL OR a.inchi IS NULL THEN b.inchi ELSE a.inchi END AS inchi,
    CASE WHEN a.inchi_key IS NULL THEN b.smiles ELSE a.smiles END AS smiles, coalesce(b.computed_mw, a.computed_mw) AS computed_mw, coalesce(b.experimental_logp, a.experimental_logp) AS experimental_logp,
    CASE WHEN a.inchi_key IS NULL THEN b.alcohol_count ELSE a.alcohol_count END AS alcohol_count FROM a FULL JOIN b ON a.inchi_key = b.inchi_key"""
O["db1_merge_fields"] = f"""WITH {_TWO} SELECT coalesce(a.inchi_key, b.inchi_key) AS inchi_key, {', '.join(f'coalesce(b.{c}, a.{c}) AS {c}' for c in _COLS)},
    CASE WHEN b.inchi_key IS NULL THEN 'old' WHEN a.inchi_key IS NULL OR {' OR '.join(f'(b.{c} IS NOT NULL AND b.{c} IS DISTINCT FROM a.{c})' for c in _COLS)} THEN 'new' ELSE 'old' END AS timestamp_updated FROM a FULL JOIN b ON a.inchi_key = b.inchi_key"""
O["promoted_keys"] = f"WITH {_PROPS} SELECT _row, CASE WHEN inchi_key <> 'bad' THEN inchi_key WHEN _row % 34 = 0 THEN 'ABCDEFGHIJKLMN-OPQRSTUVWX-Y' END AS inchi_key, inchi, smiles FROM props"

_SEEN = f"seen AS ({duck(inputs.SEEN)})"
_LATEST = "row_number() OVER (PARTITION BY customer_id, cas_number_normalized ORDER BY timestamp_seen_utc DESC"
O["customer_feed"] = f"WITH {_SEEN} SELECT * EXCLUDE n FROM (SELECT *, {_LATEST}, code, name) AS n FROM seen WHERE cas_validity NOT LIKE '%invalid%') WHERE n = 1"
O["customer_map"] = f"WITH {_SEEN} SELECT * EXCLUDE n FROM (SELECT *, {_LATEST}, CASE WHEN code::BIGINT % 2 = 0 THEN 1 ELSE 0 END DESC, cas_number_normalized DESC, cas_validity DESC, code DESC) AS n FROM seen) WHERE n = 1"

_VIEW = f"{_PROPS}, known AS ({duck(inputs.KNOWN)}), one AS {_first('props')}"
O["cas_view"] = f"""WITH {_VIEW} SELECT k.cas_input, k.cas_number_normalized, k.cas_status, k.inchi_key, k.inchi AS inchi_registry, k.smiles AS smiles_registry, k.resolver_source, k.resolver_confidence, k.resolution_timestamp_utc, k.evidence, k.notes, k.mixture_type,
    o.inchi, o.smiles, o.computed_mw, o.experimental_logp, o.alcohol_count::DOUBLE AS alcohol_count FROM known k LEFT JOIN one o ON k.inchi_key = o.inchi_key"""
O["cas_view_exportable"] = f"WITH {_VIEW} SELECT k.cas_number_normalized, k.inchi_key, o.computed_mw FROM known k LEFT JOIN one o ON k.inchi_key = o.inchi_key WHERE k.cas_status = 'valid' AND k.inchi_key <> ''"
O["cas_view_overlay"] = f"""WITH {_VIEW}, {_SEEN}, m AS (SELECT * FROM (SELECT *, {_LATEST}, cas_number_normalized DESC, cas_validity DESC, code DESC) AS n FROM seen WHERE customer_id = 'c3') WHERE n = 1)
    SELECT k.cas_number_normalized, k.inchi_key, m.customer_id, m.timestamp_seen_utc, m.name FROM known k LEFT JOIN m USING (cas_number_normalized)"""

O["resolver_cache"] = f"""SELECT cas_number_normalized AS cas, arg_max(inchi_key, _row) AS inchi_key, arg_max(inchi, _row) AS inchi, arg_max(smiles, _row) AS smiles FROM ({duck(inputs.INCOMING)}) WHERE cas_number_normalized <> '' AND inchi_key <> '' AND cas_status = 'valid' GROUP BY 1"""
O["cache_ttl"] = """SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'success' WHEN 1 THEN 'negative' ELSE 'temporary' END AS status FROM events
    WHERE event_id % 3 = 0 OR (event_id % 3 = 1 AND floor(epoch(ts)) > epoch(TIMESTAMP '2024-01-20 00:00:00') - 30 * 86400) OR (event_id % 3 = 2 AND floor(epoch(ts)) > epoch(TIMESTAMP '2024-01-20 00:00:00') - 3600)"""
O["name_rank"] = """
WITH c AS (SELECT 'né' || CAST(p_partkey % 50 AS VARCHAR) AS name, p_partkey AS cid, CASE p_partkey % 4 WHEN 0 THEN 'CCO' WHEN 1 THEN 'CC.Cl' WHEN 2 THEN '[Na]O' ELSE 'CCCCCCO' END AS smiles, p_partkey % 50 = p_partkey % 70 AS same, p_partkey % 3 AS form, p_partkey % 5 + p_partkey % 3 AS marks FROM part),
z AS (SELECT *, length(regexp_replace(smiles, '[^A-Z]', '', 'g')) AS size FROM c), m AS (SELECT name, list(size ORDER BY size)[(count(*) // 2) + 1] AS median FROM z GROUP BY name),
s AS (SELECT z.name, cid, CASE WHEN same AND form = 0 THEN 1000.0 ELSE 0.0 END + CASE WHEN same AND form = 1 THEN 500.0 ELSE 0.0 END + CASE WHEN contains(lower(smiles), 'c') THEN 50.0 ELSE 0.0 END + CASE WHEN contains(smiles, '.') THEN 0.0 ELSE 25.0 END - marks - abs(size - median) + 1.0::DOUBLE / (1.0::DOUBLE + cid) AS score FROM z JOIN m USING (name))
SELECT name, cid, round(score::DOUBLE, 6) AS score, row_number() OVER (PARTITION BY name ORDER BY score DESC, cid)::INTEGER AS rank FROM s"""

# Cells' numbers in the resolver's form, found in the registry first, else in the first provider that has them.
_RAW = "regexp_replace(trim(raw), '[^0-9-]', '', 'g')"
O["resolver_winner"] = rf"""WITH cells AS ({duck(inputs.CELLS)}),
parts AS (SELECT row, name, pos, raw, {_RAW} AS s, {_digits('raw')} AS d FROM (SELECT row, name, unnest(range(0, len(ts))) AS pos, unnest(ts) AS raw FROM (SELECT row, name, list_filter(list_transform(string_split(replace(replace(coalesce(cas, ''), chr(160), ' '), '\', '/'), '/'), lambda t: trim(t)), lambda t: t <> '') AS ts FROM cells))),
made AS (SELECT row, name, pos, CASE WHEN contains(s, '-') THEN CASE WHEN regexp_full_match(s, '\d+-\d+-\d+') THEN {_bare("split_part(s, '-', 1)")} || '-' || CASE WHEN length(split_part(s, '-', 2)) < 2 THEN lpad(split_part(s, '-', 2), 2, '0') ELSE split_part(s, '-', 2) END || '-' || split_part(s, '-', 3)
    WHEN len(string_split(s, '-')) <> 3 AND length(d) >= 4 THEN {_bare("substr(d, 1, length(d) - 3)")} || '-' || substr(d, length(d) - 2, 2) || '-' || right(d, 1) END
    WHEN length(d) >= 4 THEN {_bare("substr(d, 1, length(d) - 3)")} || '-' || substr(d, length(d) - 2, 2) || '-' || right(d, 1) END AS cas FROM parts),
good AS (SELECT * FROM made WHERE coalesce(regexp_full_match(cas, '\d{{1,7}}-\d{{2}}-\d') AND {_sum_ok('cas')}, false)),
cached AS (SELECT cas_number_normalized AS cas, inchi_key, inchi, smiles FROM ({duck(inputs.KNOWN)}) WHERE cas_status = 'valid' AND inchi_key <> ''),
offered AS (SELECT {number('p_partkey')} AS cas, {inchikey('p_partkey')} AS inchi_key, p_partkey % 2 = 0 AS pubchem FROM part WHERE p_partkey % 2 = 0 OR p_partkey % 3 = 0),
hits AS (SELECT g.row, g.pos, g.cas, 0 AS rank, 'db2_cache' AS source, c.smiles, c.inchi, c.inchi_key FROM good g JOIN cached c USING (cas)
    UNION ALL SELECT g.row, g.pos, g.cas, CASE WHEN pubchem THEN 3 ELSE 4 END, CASE WHEN pubchem THEN 'pubchem' ELSE 'cactus' END, CASE WHEN pubchem THEN 'C2' ELSE 'C3' END, '', o.inchi_key FROM good g JOIN offered o USING (cas) WHERE g.cas NOT IN (SELECT cas FROM cached)),
placed AS (SELECT *, row_number() OVER (PARTITION BY row ORDER BY rank, pos) AS k FROM hits),
best AS (SELECT row, max(cas) FILTER (k = 1) AS cas, max(source) FILTER (k = 1) AS source, max(smiles) FILTER (k = 1) AS smiles, max(inchi) FILTER (k = 1) AS inchi, max(inchi_key) FILTER (k = 1) AS inchi_key, string_agg(cas, ' | ' ORDER BY k) FILTER (k > 1) AS alternates FROM placed GROUP BY row),
kinds AS (SELECT c.row, c.name, c.cas AS cas_input, b.*  EXCLUDE (row), TRY_CAST(split_part(b.cas, '-', 1) AS BIGINT) AS b FROM cells c LEFT JOIN best b ON b.row = c.row)
SELECT row, name, cas_input, cas, coalesce(source, 'unresolved') AS source, smiles, inchi, inchi_key, coalesce(alternates, '') AS alternates,
    CASE WHEN cas IS NULL THEN 'unknown' ELSE coalesce({_CAS_KIND}, {_NAME_KIND}, CASE WHEN contains(smiles, '.') THEN 'mixture (multi-component structure)' END, 'single substance') END AS mixture_type FROM kinds"""
O["resolver_merge"] = f"""WITH a AS (SELECT p_partkey AS r, CASE WHEN p_partkey % 5 = 0 THEN '' ELSE {number('(p_partkey % 300)')} END AS cas, p_brand AS input FROM part WHERE p_partkey % 3 < 2)
    SELECT cas, input, r AS found FROM (SELECT *, row_number() OVER (PARTITION BY CASE WHEN cas <> '' THEN cas ELSE input END ORDER BY r % 3, r) AS n FROM a) WHERE n = 1"""

_Q = "CAST(CAST(l_quantity AS INT) AS DOUBLE)"
O["unit_conversion"] = f"""
WITH m AS (SELECT l_orderkey * 8 + l_linenumber AS key, {_Q} AS v, l_partkey AS k, CASE WHEN l_suppkey % 3 = 0 THEN NULL ELSE l_extendedprice / 100 END AS w FROM lineitem),
c AS (SELECT key, v * CASE k % 10 WHEN 2 THEN 1000.0::DOUBLE WHEN 3 THEN 100000.0::DOUBLE WHEN 4 THEN 133.322368::DOUBLE WHEN 6 THEN 101325.0::DOUBLE WHEN 7 THEN 133.322368::DOUBLE WHEN 8 THEN 100.0::DOUBLE WHEN 9 THEN 1000000.0::DOUBLE ELSE 1.0::DOUBLE END AS pa,
    CASE WHEN k % 10 = 5 THEN 'Unit conversion: unsupported pressure unit ''furlong'' (kept raw numeric)' END AS pa_warning,
    round(CASE k % 5 WHEN 1 THEN v - 273.15::DOUBLE WHEN 2 THEN (v - 32.0::DOUBLE) * 5.0::DOUBLE / 9.0::DOUBLE ELSE v END, 6) AS celsius, v * CASE k % 5 WHEN 2 THEN 0.001::DOUBLE WHEN 3 THEN 0.001::DOUBLE ELSE 1.0::DOUBLE END AS g_ml,
    round(CASE k % 7 WHEN 1 THEN v * 1000.0::DOUBLE WHEN 3 THEN coalesce(v * w * 1000.0::DOUBLE, v) WHEN 4 THEN coalesce(v / 1000.0::DOUBLE * w * 1000.0::DOUBLE, v) ELSE v END, 6) AS mg_l,
    CASE WHEN k % 7 = 2 THEN 'Unit conversion: treated ppm as mg/L (aqueous approximation)' WHEN k % 7 IN (3, 4) AND w IS NULL THEN 'Unit conversion: solubility ''' || CASE k % 7 WHEN 3 THEN 'mol/L' ELSE 'mM' END || ''' requires MW (missing); kept raw numeric'
        WHEN k % 7 = 6 THEN 'Unit conversion: unsupported solubility unit ''cup'' (kept raw numeric)' END AS mg_l_warning FROM m)
SELECT *, CASE WHEN pa > 0 THEN round(log10(pa), 9) END AS log_pa FROM c"""

_U = "CASE k % 10 WHEN 0 THEN NULL WHEN 1 THEN 'Pa' WHEN 2 THEN 'kPa' WHEN 3 THEN 'bar' WHEN 4 THEN 'mmHg' WHEN 5 THEN 'furlong' WHEN 6 THEN 'atm' WHEN 7 THEN 'torr' WHEN 8 THEN 'mbar' ELSE 'MPa' END"
O["provider_units"] = f"""
WITH m AS (SELECT l_orderkey * 8 + l_linenumber AS key, {_Q} AS v, l_partkey AS k FROM lineitem), u AS (SELECT *, {_U} AS u, CASE k % 10 WHEN 2 THEN 1000.0::DOUBLE WHEN 3 THEN 100000.0::DOUBLE WHEN 4 THEN 133.322::DOUBLE WHEN 6 THEN 101325.0::DOUBLE WHEN 7 THEN 133.322::DOUBLE WHEN 8 THEN 100.0::DOUBLE WHEN 9 THEN 1000000.0::DOUBLE ELSE 1.0::DOUBLE END AS f FROM m)
SELECT key, round(v * f, 6) AS pa, CASE WHEN u IS NULL THEN 'Missing unit for provider property; value kept raw.' WHEN u = 'furlong' THEN 'Unknown unit ''furlong'' from provider; value kept unconverted.' END AS pa_warning,
    round(CASE k % 5 WHEN 1 THEN v - 273.15::DOUBLE WHEN 2 THEN (v - 32.0::DOUBLE) * 5.0::DOUBLE / 9.0::DOUBLE ELSE v END, 6) AS celsius, CASE k % 5 WHEN 0 THEN 'Missing unit for provider property; value kept raw.' WHEN 4 THEN 'Unknown unit ''X'' from provider; value kept unconverted.' END AS celsius_warning,
    round(CASE k % 5 WHEN 1 THEN v - 273.15::DOUBLE WHEN 2 THEN (v - 32.0::DOUBLE) * 5.0::DOUBLE / 9.0::DOUBLE ELSE v END, 6) AS first_celsius, round(CASE k % 5 WHEN 1 THEN v - 273.15::DOUBLE WHEN 3 THEN v END, 6) AS named_celsius,
    CASE WHEN u IS NOT NULL AND u <> 'furlong' THEN round(v * f, 6) END AS strict_pa, CASE WHEN u IS NULL THEN 'pressure without unit' WHEN u = 'furlong' THEN 'pressure unit not supported: furlong' END AS strict_warning FROM u"""
O["provider_properties"] = """
WITH p AS (SELECT p_partkey, p_partkey % 10 > 1 AS known, p_partkey % 10 = 1 AS second, p_partkey % 3 AS k, p_size AS n FROM part)
SELECT p_partkey, CASE WHEN known THEN round(n + 300 - 273.15::DOUBLE, 6) END AS boiling_point_c, CASE WHEN known AND k < 2 THEN round(n * CASE k WHEN 0 THEN 1000.0::DOUBLE ELSE 133.322::DOUBLE END, 6) END AS vapor_pressure_pa,
    CASE WHEN known AND n % 9 > 0 AND n % 9 < 5 THEN (n % 9)::DOUBLE END AS density_g_ml, CASE WHEN known THEN 1.4::DOUBLE + (n % 9) / 100.0::DOUBLE END AS refractive_index, CASE WHEN known THEN n + 0.5::DOUBLE END AS logp,
    CASE WHEN second THEN n::DOUBLE END AS melting_point_c, CASE WHEN known AND k < 2 THEN n * CASE k WHEN 0 THEN 1.0::DOUBLE ELSE 1000.0::DOUBLE END END AS water_solubility_mg_l,
    CASE WHEN known AND k < 2 THEN round(n * CASE k WHEN 0 THEN 1.0::DOUBLE ELSE 4.184::DOUBLE END, 6) END AS heat_of_vaporization_kj_mol,
    CASE WHEN known THEN 'pubchem' END AS source_density_g_ml, CASE WHEN second THEN 'pubchem' END AS source_melting_point_c, CASE WHEN known THEN 20.0::DOUBLE END AS experimental_refractive_index_temperature_c,
    CASE WHEN second THEN '' WHEN NOT known THEN 'no usable entries in the answer' ELSE concat_ws('; ', CASE WHEN k = 2 THEN 'pressure unit not supported: ell' END, CASE WHEN n % 9 = 0 OR n % 9 >= 5 THEN 'density without unit' END,
        CASE WHEN k = 2 THEN 'solubility unit not supported: cup' END, CASE WHEN k = 2 THEN 'heat of vaporization unit not supported' END) END AS warnings FROM p"""

O["fallback_estimates"] = """
WITH p AS (SELECT p_partkey, p_retailprice AS mw, p_size / 8.0::DOUBLE AS c, CASE WHEN p_partkey % 3 = 0 THEN 80.0::DOUBLE END AS e, p_partkey % 4 AS rings FROM part),
b AS (SELECT *, round_even(mw * 0.6::DOUBLE + rings * 25.0::DOUBLE, 1) AS bp FROM p)
SELECT p_partkey, round_even(CASE WHEN c > 3 THEN 0.8::DOUBLE WHEN c > 1 THEN 0.95::DOUBLE ELSE 1.15::DOUBLE END * (1 + (mw - 100) / 1500.0::DOUBLE), 3) AS computed_density_g_ml, bp AS computed_boiling_point_c, round(round_even(pow(10.0::DOUBLE, 8 - 2000 / (coalesce(e, bp) + 273.15::DOUBLE - 50)), 2), 1) AS vapour,
    CASE WHEN c < 0 THEN 1e5 WHEN c < 1 THEN 1e4 WHEN c < 3 THEN 1e3 WHEN c < 5 THEN 100.0::DOUBLE ELSE 1.0::DOUBLE END::DOUBLE AS computed_water_solubility_mg_l, 'fallback' AS source_density_g_ml,
    'boiling_point_c,vapor_pressure_pa,density_g_ml,water_solubility_mg_l' AS estimates FROM b"""
O["final_fields"] = """SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN CAST(p_size AS VARCHAR) WHEN p_partkey % 3 = 0 THEN CAST(p_size + 1 AS VARCHAR) END AS final_mw,
    CASE WHEN p_partkey % 2 = 0 THEN 'pubchem' WHEN p_partkey % 3 = 0 THEN CASE WHEN p_partkey % 5 = 0 THEN 'fallback' ELSE 'computed' END END AS source_mw FROM part"""

_CANON = f"""wide AS ({duck(inputs.WIDE)}),
canon AS (SELECT _row, final_inchikey AS inchi_key, "CAS_ID" AS cas_number, CASE WHEN _row % 2 = 0 THEN normalized_input END AS name_preferred, CASE WHEN _row % 3 = 0 THEN final_mw::DOUBLE ELSE 2.5::DOUBLE END AS logp,
    CASE WHEN _row % 2 = 0 THEN final_mw::DOUBLE * 1000 ELSE final_mw::DOUBLE END AS pa, round(final_mw::DOUBLE - 273.15::DOUBLE, 6) AS boiling, _row % 2 = 1 OR _row % 3 = 2 AS needs_review, source_mw AS source_primary,
    CASE WHEN _row % 5 = 0 THEN 'PubChem' ELSE 'fallback' END AS source_secondary,
    nullif(concat_ws(' ; ', CASE WHEN _row % 2 = 1 THEN 'Unit conversion: unsupported pressure unit ''ell'' (kept raw numeric)' END, CASE WHEN _row % 2 = 1 OR _row % 3 = 2 THEN '25C-check: ' || concat_ws(' | ', CASE WHEN _row % 3 = 2 THEN 'vapor_pressure_Pa_25C:not_25' END, CASE WHEN _row % 2 = 1 THEN 'density_g_mL_25C:not_25' END) END), '') AS warnings,
    (source_mw = 'pubchem')::INT + (_row % 5 = 0)::INT + (_row % 3 = 0)::INT AS rank_pubchem_count,
    CASE WHEN source_mw = 'pubchem' THEN 3 ELSE 1 END + CASE WHEN _row % 5 = 0 THEN 3 ELSE 2 END + CASE WHEN _row % 3 = 0 THEN 3 ELSE 1 END AS rank_score_sum, timestamp AS timestamp_updated FROM wide WHERE final_inchikey <> ''),
judged AS (SELECT *, row_number() OVER (PARTITION BY inchi_key ORDER BY rank_pubchem_count DESC, rank_score_sum DESC, timestamp_updated DESC, _row) = 1 AS selected FROM canon)"""
O["canonical_rows"] = f"WITH {_CANON} SELECT * EXCLUDE timestamp_updated FROM canon"
O["canonical_winners"] = f"WITH {_CANON} SELECT inchi_key, cas_number, timestamp_updated FROM judged WHERE selected"
O["canonical_audit"] = f"WITH {_CANON} SELECT _row, selected, CASE WHEN selected THEN 'winner' ELSE 'loser' END AS reason FROM judged UNION ALL SELECT _row, false, 'missing_inchi_key' FROM wide WHERE final_inchikey = ''"

O["henry_lookup"] = """
WITH h AS (SELECT p_partkey % 120 AS s, arg_min(CAST(CAST(p_size AS VARCHAR) || '.5e-' || CAST(p_partkey % 6 AS VARCHAR) AS DOUBLE), p_partkey) AS v FROM part GROUP BY 1)
SELECT c_custkey, v AS henry_constant_mol_m3_pa, round(log10(v), 9) AS log_henry, CASE WHEN v IS NOT NULL THEN 'henry table' END AS source_henry_constant
FROM customer LEFT JOIN (SELECT s_suppkey, v FROM supplier JOIN h ON h.s = s_suppkey) x ON x.s_suppkey = c_custkey"""
O["solubility_parameters"] = """
WITH t AS (SELECT p_partkey % 90 AS k, arg_min(p_size, p_partkey) AS size FROM part WHERE p_partkey % 3 <> 0 GROUP BY 1)
SELECT c_custkey, size + 0.5::DOUBLE AS experimental_hsp_delta_d_mpa05, size::DOUBLE AS experimental_hsp_delta_p_mpa05, CASE WHEN size IS NOT NULL THEN 3.25::DOUBLE END AS experimental_hsp_delta_h_mpa05,
    CASE WHEN size IS NOT NULL THEN 'measured table' END AS source_hsp FROM customer LEFT JOIN t ON t.k = c_custkey"""
O["computed_parameters"] = f"""SELECT {number('(l_partkey % 500)')} AS cas, arg_min(l_quantity * 1000, l_orderkey * 8 + l_linenumber) / 1000.0::DOUBLE AS computed_hsp_delta_d_mpa05, arg_min(l_quantity * 100, l_orderkey * 8 + l_linenumber) / 1000.0::DOUBLE AS computed_hsp_delta_p_mpa05,
    7.0::DOUBLE AS computed_hsp_delta_h_mpa05 FROM lineitem WHERE l_linenumber % 2 = 0 GROUP BY 1"""

_TITLE = r"trim(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1))"
O["page_facts"] = rf"""WITH p AS (SELECT page_id, {_TITLE} AS title, html FROM ({duck(inputs.PAGES)}))
SELECT page_id, title, CASE WHEN title = '' OR regexp_matches(lower(title), 'mixture|family|group|class') THEN 'GROUP' ELSE 'MATERIAL' END AS kind, trim(regexp_replace(split_part(title, '-', 1), '\s+', ' ', 'g')) AS name,
    coalesce(array_to_string(list_sort(list_distinct(list_transform(regexp_extract_all(html, '\b(\d{{2,7}}-\d{{2}}-\d)\b', 1), lambda x: {_bare('x')}))), ','), '') AS numbers, coalesce(TRY_CAST(regexp_extract(html, '(?i)Page\s+\d+\s+of\s+(\d+)', 1) AS INT), 1) AS last_page FROM p"""
O["page_discovery"] = f"""
WITH k AS (SELECT page_id, page_id % 10 AS m, {number('(page_id % 60)')} AS a, {number('(page_id % 60 + 1)')} AS b FROM pages), ref AS (SELECT {number('s_suppkey')} AS cas FROM supplier WHERE s_suppkey % 2 = 0),
f AS (SELECT page_id, unnest(list_distinct([a, b])) AS cas FROM k WHERE m NOT IN (0, 1, 2))
SELECT page_id, NULL::VARCHAR AS cas, CASE m WHEN 0 THEN 'not_found' WHEN 1 THEN 'group' ELSE 'no_cas' END AS route FROM k WHERE m IN (0, 1, 2)
UNION ALL SELECT page_id, cas, CASE WHEN cas IN (SELECT cas FROM ref) THEN 'reference' ELSE 'candidate' END FROM f"""

_ENT = f"""rows AS (SELECT l_orderkey % 1000 AS rw_id, l_orderkey * 8 + l_linenumber AS r, {number('(l_partkey % 200)')} AS cas, CASE l_linenumber WHEN 3 THEN 'Rose oil' WHEN 4 THEN 'Ethyl name, 7' WHEN 1 THEN NULL WHEN 2 THEN NULL ELSE 'Methyl name' END AS name, CAST(l_shipdate AS VARCHAR) AS t FROM lineitem),
ent AS (SELECT rw_id, list_sort(list_distinct(list(cas))) AS cs, arg_min(name, r) FILTER (name IS NOT NULL) AS name, min(t) AS discovered_at FROM rows GROUP BY rw_id)"""
O["entities"] = f"WITH {_ENT} SELECT rw_id, array_to_string(cs, ',') AS cas_list, name, discovered_at, CASE WHEN len(cs) > 1 THEN 'stereo_family' WHEN contains(lower(name), 'oil') THEN 'mixture_like' WHEN len(cs) = 1 THEN 'monomer' ELSE 'unknown' END AS entity_class FROM ent"
O["entity_shadows"] = f"""WITH {_ENT}, ref AS (SELECT DISTINCT {number('(s_suppkey % 20)')} AS cas FROM supplier), hit AS (SELECT rw_id, list(c ORDER BY c) AS sh FROM (SELECT rw_id, unnest(cs) AS c FROM ent) JOIN ref ON ref.cas = c GROUP BY rw_id), s AS (SELECT e.rw_id, coalesce(h.sh, []) AS sh, name FROM ent e LEFT JOIN hit h USING (rw_id))
    SELECT rw_id, array_to_string(sh, ',') AS shared, len(sh) > 0 OR coalesce(lower(name) = 'roseoil', false) AS shadowed FROM s"""
O["json_values"] = "SELECT event_id, CASE WHEN event_id % 2 = 0 AND (event_type LIKE 'c%' OR event_type LIKE 'p%') THEN 'text' ELSE '7.0' END AS found FROM events"
O["cache_keys"] = "SELECT event_id, sha256('GET | http://x/' || event_type || ' | a=' || CAST(event_id AS VARCHAR) || '&b=2') AS cache_key FROM events"
O["listed_substances"] = f"""SELECT {number('(page_id % 60)')} AS cas, string_agg(DISTINCT 'Name& ' || CAST(page_id % 7 AS VARCHAR), ',' ORDER BY 'Name& ' || CAST(page_id % 7 AS VARCHAR)) AS names, count(DISTINCT url)::BIGINT AS n_urls, true AS cas_ok FROM pages GROUP BY 1"""
O["smiles_clean"] = f"""WITH r AS ({duck(inputs.SMILES)}), k AS (SELECT p_partkey, p_partkey % 6 AS kind, p_partkey % 9 + 1 AS a, p_size % 9 + 1 AS b, p_size % 9 AS c, raw FROM part JOIN r USING (p_partkey))
    SELECT p_partkey, CASE kind WHEN 0 THEN CASE WHEN a > b + 1 THEN repeat('C', a) ELSE repeat('C', b) || 'O' END WHEN 1 THEN repeat('C', a) WHEN 2 THEN 'OS(=O)(=O)O' WHEN 3 THEN repeat('C', b) WHEN 4 THEN ''
        ELSE CASE WHEN c + 4 >= a + 2 THEN 'bad_' || repeat('x', c) ELSE repeat('y', a) || '_z' END END AS clean, raw AS cut FROM k"""


O["best_identifiers"] = f"""SELECT c_custkey AS key, CASE WHEN c_custkey % 3 = 0 THEN {inchikey('c_custkey')} WHEN c_custkey % 2 = 0 THEN {number('c_custkey')} ELSE c_name END AS identifier,
    CASE WHEN c_custkey % 3 = 0 THEN 'inchikey' WHEN c_custkey % 2 = 0 THEN 'cas' ELSE 'name' END AS identifier_type, CASE WHEN c_custkey % 3 = 0 THEN {inchikey('c_custkey')} WHEN c_custkey % 2 = 0 THEN {number('c_custkey')} ELSE lower(c_name) END AS normalized_input FROM customer"""
O["dump_rows"] = """SELECT CAST(p_partkey AS VARCHAR) AS a, 'it' || chr(39) || 's (' || p_brand || ')' AS b, CAST(NULL AS VARCHAR) AS c FROM part WHERE p_partkey % 10 <> 0
    UNION ALL SELECT CAST(p_size AS VARCHAR), '', '7' FROM part WHERE p_partkey % 10 <> 0"""
O["missing_requests"] = "SELECT DISTINCT sha256('GET | http://x/' || event_type || ' | a=1') AS cache_key, 'http://x/' || event_type AS url FROM events WHERE event_type NOT LIKE 'c%'"


def _molecules_sql() -> str:
    """Every feature of every part's molecule, from what is known of the molecules; 0 or '' where nothing is."""
    from chemlake.plans.known_molecules import KNOWN, features

    # every feature is not 0 in some molecule
    molecules, found = [*KNOWN, "not a smiles"], {s: features(s) for s in KNOWN}
    shown = lambda v: "'" + v.replace("'", "''") + "'" if isinstance(v, str) else f"{v}::DOUBLE" if isinstance(v, float) else str(v)
    empty = lambda name: "''" if name.endswith("Audit") else "'T1:0; T2:0'" if name.endswith("Summary") else "0.0::DOUBLE" if name in ("MolecularWeight", "FractionCSP3") else "0"
    columns = [f"CASE smiles {' '.join(f'WHEN {shown(s)} THEN {shown(f[n])}' for s, f in found.items() if n in f)} ELSE {empty(n)} END AS {n}" for n in dict.fromkeys(n for f in found.values() for n in f)]
    names = ", ".join(shown(m) for m in molecules)
    return f"WITH m AS (SELECT p_partkey, [{names}][p_partkey % {len(molecules)} + 1] AS smiles FROM part) SELECT p_partkey, smiles, {', '.join(columns)} FROM m"


O["mol_features"] = _molecules_sql()

_ORDER = "TRY_CAST(timestamp_updated AS TIMESTAMP) DESC NULLS LAST, (name_preferred IS NOT NULL)::INT + (computed_mw IS NOT NULL)::INT + (smiles IS NOT NULL)::INT + (timestamp_updated IS NOT NULL)::INT DESC, _row"
O["merged_groups"] = f"""
SELECT inchi_key, {', '.join(f"first({c} ORDER BY {_ORDER}) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in ("name_preferred", "computed_mw", "smiles", "timestamp_updated"))}, 'z' AS final_inchi
FROM ({duck(inputs.REPEATED)}) GROUP BY inchi_key"""
O["reindexed"] = f"SELECT _row AS key, inchi_key, CAST(NULL AS VARCHAR) AS cas_number, smiles, final_inchi, CAST(NULL AS VARCHAR) AS my_inchi, computed_mw FROM ({duck(inputs.REPEATED)})"
_FIRST = ", ".join(f"first({c} ORDER BY _row) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in ("smiles", "computed_mw"))
O["sanitized_rows"] = f"SELECT inchi_key, {_FIRST}, CAST(NULL AS VARCHAR) AS not_there, '2024-06-01T00:00:00Z' AS timestamp_updated FROM ({duck(inputs.PROPERTIES)}) WHERE inchi_key <> 'bad' GROUP BY inchi_key"
O["sanitized_rejects"] = f"SELECT _row, CAST(NULL AS VARCHAR) AS inchi_key, smiles FROM ({duck(inputs.PROPERTIES)}) WHERE inchi_key = 'bad'"
_EXPORT = (
    "CAS_ID final_inchi final_smiles normalized_input computed_exact_mass computed_clogp computed_tpsa computed_hbd computed_hba computed_rot_bonds computed_ring_count computed_fraction_csp3 computed_molar_refractivity source_logp "
    "computed_boiling_point_c computed_vapor_pressure_pa computed_density_g_ml computed_water_solubility_mg_l final_boiling_point_c final_vapor_pressure_pa final_water_solubility_mg_l final_density_g_ml final_mw final_exact_mass final_clogp "
    "final_tpsa final_hbd final_hba final_rot_bonds final_ring_count final_fraction_csp3 final_molar_refractivity experimental_henry_constant_mol_m3_pa source_henry_constant henry_constant_mol_m3_Pa_25C log_henry_constant_mol_m3_Pa_25C "
    "experimental_hsp_delta_d_mpa05 experimental_hsp_delta_p_mpa05 experimental_hsp_delta_h_mpa05 source_hsp computed_hsp_delta_d_mpa05 computed_hsp_delta_p_mpa05 computed_hsp_delta_h_mpa05 source_hsp_computed timestamp"
).split()
O["wide_export"] = f"SELECT upper(inchi_key) AS inchi_key, lower(inchi_key) AS final_inchikey, computed_mw, experimental_logp, {', '.join(f'CAST(NULL AS VARCHAR) AS {c}' for c in _EXPORT)} FROM ({duck(inputs.PROPERTIES)})"
O["rejected_structures"] = """
WITH c AS (SELECT p_partkey, p_partkey % 8 AS k FROM part WHERE p_partkey % 8 NOT IN (0, 6))
SELECT p_partkey, ['', ' ', 'nbsp', 'C(', 'not a smiles', '', 'Zz.Yy'][k] AS smiles, CASE WHEN k <= 3 THEN 'empty' ELSE 'invalid' END AS reason FROM c"""
O["newest_versions"] = """
WITH v AS (SELECT p_size, p_partkey % 3 AS a, p_partkey % 13 AS b, p_partkey % 101 AS c FROM part WHERE p_partkey % 11 <> 0),
n AS (SELECT p_size, max((a * 100 + b) * 1000 + c) AS m, count(*) AS n_versions FROM v GROUP BY p_size)
SELECT p_size, CASE WHEN m IS NOT NULL THEN (m // 100000)::VARCHAR || '.' || (m // 1000 % 100)::VARCHAR || '.' || (m % 1000)::VARCHAR END AS newest, coalesce(n_versions, 0)::BIGINT AS n_versions
FROM (SELECT DISTINCT p_size FROM part) LEFT JOIN n USING (p_size)"""

# Parts whose key leaves 2 or 4 of 7 have no text that can be read.
_N = len(known_structures.SPELLINGS)
O["completed_structures"] = f"""
SELECT p_partkey, CASE p_partkey % 7 WHEN 2 THEN '' WHEN 4 THEN 'bad' ELSE canonical END AS smiles, CASE p_partkey % 7 WHEN 5 THEN '' WHEN 2 THEN 'no text' WHEN 4 THEN 'InChI=1S/x' ELSE inchi END AS inchi,
    CASE WHEN p_partkey % 7 IN (2, 4, 5) THEN '' ELSE inchi_key END AS inchi_key, CASE WHEN p_partkey % 7 NOT IN (2, 4) THEN mw END AS mw,
    CASE p_partkey % 7 WHEN 2 THEN 'inchi_not_attempted_not_inchi' WHEN 3 THEN 'smiles_parse_failed' WHEN 4 THEN 'smiles_parse_failed' ELSE '' END AS structure_error
FROM part JOIN {known_structures.structures_sql()} ON s.k = p_partkey % {_N}"""
_SHOWN = ("mw", "exact_mass", "clogp", "tpsa", "hbd", "hba", "rot_bonds", "ring_count", "fraction_csp3", "molar_refractivity")
O["computed_descriptors"] = f"""
SELECT p_partkey, canonical AS computed_smiles, {', '.join(f'{c} AS computed_{c}' for c in _SHOWN)}, CASE WHEN canonical IS NOT NULL THEN 'computed' END AS source_tpsa
FROM part LEFT JOIN {known_structures.structures_sql()} ON s.k = p_partkey % {_N} AND p_partkey % 7 NOT IN (2, 4)"""
_MOTIFS = ", ".join("'" + m + "'" for m in known_structures.MOTIF_MOLECULES)
O["pattern_counts"] = f"SELECT p_partkey, [{_MOTIFS}][p_partkey % {len(known_structures.MOTIF_MOLECULES)} + 1] AS smiles, pattern, n FROM part JOIN {known_structures.motifs_sql()} ON m.k = p_partkey % {len(known_structures.MOTIF_MOLECULES)}"


def oracle_sql() -> dict[str, str]:
    return dict(O)
