"""The queries of the catalogue in SQL, for a second engine to compare with."""

from __future__ import annotations

from ..operators.sections import DENY_HEADINGS

_LICENCES = "'MIT', 'Apache-2.0', 'MS-PL', 'BSD-2-Clause', 'BSD-3-Clause', '0BSD', 'ISC'"
_DENY = ", ".join(f"'{x}'" for x in DENY_HEADINGS)


def _norm(t: str) -> str:
    return rf"lower(trim(regexp_replace(coalesce({t}, ''), '\s+', ' ', 'g')))"


def _bucket(t: str, n: int) -> str:
    return f"(('0x' || substr(sha1(coalesce({t}, '')), 1, 8))::UBIGINT % {n})"


def _clean(p: str) -> str:
    """A path's folders and name joined by single slashes ('..' does not occur in the tables)."""
    return f"array_to_string(list_filter(string_split(replace(trim({p}), '\\', '/'), '/'), lambda x: x NOT IN ('', '.')), '/')"


def _dir(p: str) -> str:
    return f"CASE WHEN contains(replace({p}, '\\', '/'), '/') THEN regexp_replace(replace({p}, '\\', '/'), '/[^/]*$', '') END"


_M = "m AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY member_id ORDER BY loaded_at) AS _n FROM members WHERE member_id IS NOT NULL) WHERE _n = 1)"
_C = (
    "c AS (SELECT *, messages[1].content AS first_text, coalesce(messages[-1].content, '') AS answer, meta.path AS path, meta.object AS object, meta.repo AS repo "
    "FROM (SELECT *, row_number() OVER (PARTITION BY cand_id ORDER BY made_at) AS _n FROM candidates WHERE cand_id IS NOT NULL) WHERE _n = 1)"
)
_DT = "CASE WHEN coalesce(length(rejected_al), 0) > 0 THEN coalesce(first_text, '') || chr(10) || coalesce(rejected_al, '') ELSE coalesce(target_al, '') || chr(10) || answer END"


def _hits(col: str = "analyzer_hits", name: str = "h") -> str:
    return f"{name} AS (SELECT member_id, path, object_kind, repo, x.code AS code, x.severity AS severity, x.line AS line FROM (SELECT *, unnest({col}) AS x FROM m))"


def _place(source: str, col: str, name: str) -> str:
    """path -> app of the deepest folder, case aside, for the distinct values of a column."""
    return f"""{name}_p AS (SELECT DISTINCT {col} AS path, {_clean(col)} AS cp FROM {source} WHERE {col} IS NOT NULL),
    {name} AS (SELECT path, arg_max(app_id, (length(d), d_exact, -app_id)) AS app FROM (
      SELECT p.path, a.app_id, a.d, (starts_with(p.cp || '/', a.raw || '/')) AS d_exact
      FROM {name}_p p JOIN (SELECT app_id, {_clean('app_dir')} AS raw, lower({_clean('app_dir')}) AS d FROM apps WHERE {_clean('app_dir')} <> '') a
      ON starts_with(lower(p.cp) || '/', a.d || '/')) GROUP BY path)"""


_EXACT = f"SELECT min(doc_id) AS doc_id FROM documents WHERE doc_id IS NOT NULL GROUP BY {_norm('text')}"
_B40 = f"(SELECT DISTINCT item_id, {_norm('text')} AS p FROM benchmark WHERE length({_norm('text')}) >= 40)"
_ROUTED = f"""{_C}, g AS (SELECT *, coalesce(nullif({_dir('path')}, ''), nullif(object, ''), gen) AS grp FROM c),
 r AS (SELECT *, CASE WHEN {_bucket('grp', 12)} = 0 THEN 'heldout' WHEN coalesce(length(rejected_al), 0) > 0 THEN 'preference' END AS p0 FROM g),
 s AS (SELECT cand_id, row_number() OVER (PARTITION BY gen ORDER BY sha1(gen || answer), cand_id) AS k, greatest(1, floor((SELECT count(*) FROM r WHERE p0 IS NULL) * 0.35)) AS cap FROM r WHERE p0 IS NULL),
 v AS (SELECT cand_id, (row_number() OVER (ORDER BY sha1('161' || cand_id::VARCHAR), cand_id) - 1) % 20 = 0 AS is_val FROM s WHERE k <= cap),
 parts AS (SELECT r.cand_id, gen, coalesce(p0, CASE WHEN v.cand_id IS NULL THEN 'capped' WHEN is_val THEN 'val' ELSE 'train' END) AS part FROM r LEFT JOIN v ON r.cand_id = v.cand_id)"""
_CTX = """rtrim(object_head, ' ' || chr(9) || chr(10) || chr(13)) || CASE WHEN len(list_filter(sibling_signatures, lambda s: s <> signature)) > 0
 THEN chr(10) || chr(10) || '    // other members:' || chr(10) || array_to_string(list_transform(list_filter(sibling_signatures, lambda s: s <> signature), lambda s: '    ' || s || ';'), chr(10)) ELSE '' END"""
_FENCE = "'```al' || chr(10) || {} || chr(10) || '```'"
_USABLE = "has_body AND NOT is_test AND body_loc BETWEEN 3 AND 45 AND member_kind = 'procedure' AND contains(body, 'begin')"
_SAID = r"trim(regexp_replace(trim(coalesce(doc_comment, '')), '(?m)^[ \t]*//+[ \t]?', '', 'g'))"
# the classification of the tables' codes, written down by hand from the rules and the entries that win over them
_CATALOGUE = """k(code, category, likelihood, strategy, mutation) AS (VALUES
      ('AL0104', 'syntax', 'high', 'deterministic', 'delete_token'), ('AL0111', 'syntax', 'high', 'deterministic', 'delete_semicolon'), ('AL0118', 'binding', 'high', 'model', 'rename_identifier'),
      ('AL0132', 'binding', 'high', 'model', 'rename_member'), ('AL0185', 'binding', 'high', 'model', 'rename_identifier'), ('AL0432', 'obsoletion', 'low', 'model', 'reference_obsolete'), ('AL0606', 'semantic', 'medium', 'model', NULL),
      ('AA0008', 'analyzer-style', 'medium', 'analyzer-codefix', 'strip_call_parens'), ('AA0021', 'analyzer-style', 'medium', 'analyzer-codefix', NULL), ('AA0137', 'analyzer-style', 'low', 'analyzer-codefix', NULL),
      ('AA0139', 'analyzer-style', 'low', 'analyzer-codefix', NULL), ('AA0181', 'analyzer-style', 'low', 'analyzer-codefix', NULL), ('AA0205', 'analyzer-style', 'low', 'analyzer-codefix', NULL),
      ('AA0215', 'analyzer-style', 'medium', 'analyzer-codefix', 'case_mismatch_keyword'), ('AC0012', 'analyzer-correctness', 'low', 'model', NULL), ('AW0006', 'analyzer-correctness', 'low', 'model', NULL),
      ('DC0004', 'analyzer-style', 'low', 'analyzer-codefix', NULL), ('FC0001', 'analyzer-style', 'medium', 'analyzer-codefix', 'mangle_operator_spacing'), ('LC0003', 'analyzer-correctness', 'low', 'model', NULL),
      ('LC0015', 'analyzer-correctness', 'low', 'analyzer-codefix', NULL), ('LC0052', 'analyzer-correctness', 'low', 'model', NULL), ('PC0007', 'analyzer-correctness', 'low', 'model', NULL),
      ('TA0002', 'analyzer-correctness', 'low', 'model', NULL), ('UI0005', 'analyzer-style', 'low', 'analyzer-codefix', NULL))"""
_SPANS = "spans AS (SELECT member_id AS owner, path, coalesce(sum(n) OVER w, 0)::BIGINT AS s, coalesce(sum(n) OVER w, 0)::BIGINT + n - 1 AS e FROM (SELECT *, greatest(body_loc + 6, 1) AS n FROM m WHERE path IS NOT NULL) WINDOW w AS (PARTITION BY path ORDER BY member_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"
_PIECES = r"pieces AS (SELECT doc_id, unnest(string_split(regexp_replace(text, '(?m)^(#{1,3}\s)', chr(1) || '\1', 'g'), chr(1))) AS piece FROM documents WHERE text IS NOT NULL)"


def _reference(t: str) -> str:
    pat = r"(?i)^(.+?)\s*(?:\([^)]*\))?\s+(Method|Property|Trigger|Attribute|Data Type|Keyword)\s*$"
    name = rf"trim(regexp_replace(regexp_extract(trim({t}), '{pat}', 1), '\s*\([^)]*\)\s*$', ''))"
    return rf"CASE WHEN regexp_matches({name}, '^[\w.:\[\], ]+$') THEN [{name}, lower(regexp_extract(trim({t}), '{pat}', 2))] END"


_H1 = r"nullif(regexp_extract(text, '(?m)^#[ \t]+(.+?)[ \t]*$', 1), '')"
_TITLE = r"nullif(regexp_replace(regexp_extract(regexp_extract(text, '(?s)\A---\s*\n(.*?)\n---\s*\n', 1), '(?m)^title:[ \t]*(.+?)[ \t]*$', 1), '^[""'']|[""'']$', '', 'g'), '')"
_SHINGLES = "list_distinct(list_transform(range(1, greatest(1, len(w) - 4) + 1), lambda k: array_to_string(w[k:k + 4], ' ')))"

SQL = {
    "corpus_funnel": f"""WITH d AS (SELECT * FROM documents WHERE doc_id IN ({_EXACT})),
      bad AS (SELECT DISTINCT doc_id FROM d JOIN {_B40} b ON contains({_norm('text')}, b.p))
      SELECT CASE WHEN {_bucket('lower(trim(source))', 12)} = 0 THEN 'heldout' ELSE 'train' END AS part, coalesce(lang, 'unknown') AS lang, count(*) AS n_docs
      FROM d WHERE doc_id NOT IN (SELECT doc_id FROM bad) GROUP BY ALL""",
    "exact_dedup_documents": _EXACT,
    "exact_dedup_candidates": f"WITH {_C} SELECT min(cand_id) AS cand_id, gen FROM c GROUP BY gen, {_norm(_DT)}",
    "filter_drop_reasons": f"""WITH {_C}, s AS (SELECT DISTINCT ON (src_key) * FROM sources),
      p AS (SELECT DISTINCT {_norm('first_text')} AS p FROM c WHERE lower(meta.author) IN ('build-agent', 'merge-queue') AND {_norm('first_text')} <> ''),
      g AS (SELECT c.cand_id, gen, first_text, rejected_al, target_al, answer, CASE
        WHEN s.src_key IS NOT NULL AND NOT (coalesce(spdx IN ({_LICENCES}), false) OR coalesce(src_role, '') = 'docs') THEN 'license'
        WHEN EXISTS (SELECT 1 FROM apps a WHERE exception IS NOT NULL AND contains(replace(path, '\\', '/'), '/' || string_split(a.app_dir, '/')[-2] || '/')) THEN 'contam_path'
        WHEN {_norm('first_text')} IN (SELECT p FROM p) THEN 'contam_prompt' END AS gate
        FROM c LEFT JOIN s ON c.repo = s.src_key),
      k AS (SELECT min(cand_id) AS cand_id FROM g WHERE gate IS NULL GROUP BY gen, {_norm(_DT)})
      SELECT gen, coalesce(gate, CASE WHEN k.cand_id IS NOT NULL THEN 'kept' ELSE 'exact' END) AS reason, count(*) AS n FROM g LEFT JOIN k ON g.cand_id = k.cand_id GROUP BY ALL""",
    "outside_slow_apps": f"WITH {_M} SELECT member_id FROM m WHERE NOT EXISTS (SELECT 1 FROM apps a WHERE exception = 'timeout' AND contains(replace(path, '\\', '/'), '/' || string_split(a.app_dir, '/')[-2] || '/'))",
    "page_paths": rf"""WITH {_C}, x AS (SELECT 'docs/' || meta.doc_section || '/' || meta.heading AS p FROM c WHERE meta.doc_section IS NOT NULL)
      SELECT coalesce(string_split(p, '/')[2] = 'developer' AND NOT regexp_matches(p, '(?i)(^|/)(administration|deployment|upgrade|analyzers|avs-diagnostics|diagnostics|readiness|includes)/|telemetry|monitor'), false) AS teaches, count(*) AS n FROM x GROUP BY ALL""",
    "decontam_exact": rf"""WITH d AS (SELECT *, coalesce(regexp_replace(lower(trim(source)), '[\s_]+', '-', 'g') = 'docs-portal', false) AS portal FROM documents)
      SELECT doc_id FROM d WHERE NOT portal AND {_norm('text')} IN (SELECT {_norm('text')} FROM d WHERE portal AND {_norm('text')} <> '')""",
    "decontam_substring": f"SELECT DISTINCT doc_id, item_id FROM documents JOIN {_B40} b ON contains({_norm('text')}, b.p)",
    "license_gate_members": f"""WITH {_M}, s AS (SELECT DISTINCT ON (src_key) * FROM sources)
      SELECT repo, CASE WHEN src_key IS NULL THEN true ELSE coalesce(spdx IN ({_LICENCES}), false) OR coalesce(src_role, '') = 'docs' END AS licence_ok, count(*) AS n
      FROM m LEFT JOIN s ON m.repo = s.src_key GROUP BY ALL""",
    "allowed_repositories": f"SELECT src_key, spdx, src_role, commit_id FROM sources WHERE (coalesce(spdx IN ({_LICENCES}), false) OR coalesce(src_role, '') = 'docs') AND commit_id IS NOT NULL",
    "shingle_stats": f"WITH {_C}, t AS (SELECT cand_id, string_split({_norm('answer')}, ' ') AS w FROM c) SELECT cand_id, len({_SHINGLES})::INT AS n_shingles FROM t",
    "near_dup_pairs_exact": f"""WITH {_C}, t AS (SELECT min(cand_id) AS id, string_split({_norm('answer')}, ' ') AS w FROM c GROUP BY {_norm('answer')}),
      s AS (SELECT id, {_SHINGLES} AS s FROM t), f AS (SELECT id, len(s) AS n, unnest(s) AS x FROM s),
      p AS (SELECT a.id AS id_a, b.id AS id_b, count(*) AS i, any_value(a.n) AS na, any_value(b.n) AS nb FROM f a JOIN f b ON a.x = b.x AND a.id < b.id GROUP BY ALL)
      SELECT id_a, id_b, round(i / (na + nb - i), 6) AS jaccard FROM p WHERE i / (na + nb - i) >= 0.8""",
    "hash_sample_members": f"WITH {_M} SELECT member_id FROM m WHERE {_bucket('path', 10)} = 0",
    "heldout_by_group": f"WITH {_C} SELECT gen, {_bucket('coalesce(nullif(' + _dir('path') + chr(44) + chr(39) * 2 + '), nullif(object, ' + chr(39) * 2 + '), gen)', 12)} = 0 AS held, count(*) AS n FROM c GROUP BY ALL",
    "kind_cap_candidates": f"""WITH {_C}, s AS (SELECT * FROM c WHERE coalesce(length(rejected_al), 0) = 0),
      k AS (SELECT cand_id, gen, row_number() OVER (PARTITION BY gen ORDER BY sha1(gen || answer), cand_id) AS k FROM s)
      SELECT cand_id, gen FROM k WHERE k <= greatest(1, floor((SELECT count(*) FROM s) * 0.35))""",
    "val_split_candidates": f"WITH {_C} SELECT cand_id, (row_number() OVER (ORDER BY sha1('161' || cand_id::VARCHAR), cand_id) - 1) % 20 = 0 AS is_val FROM c",
    "stride_sample_members": f"""WITH {_M}, s AS (SELECT member_id, row_number() OVER (ORDER BY member_id) - 1 AS r FROM m WHERE has_body AND body_loc BETWEEN 3 AND 40),
      n AS (SELECT greatest(1, count(*) // 110) AS step FROM s) SELECT member_id FROM s, n WHERE r % step = 0 AND r < step * 110""",
    "seeded_take": f"WITH {_M} SELECT member_id FROM m ORDER BY sha1('7:' || member_id::VARCHAR), member_id LIMIT 50",
    "members_by_app": f"WITH {_M}, {_place('m', 'path', 'pp')}, {_place('m', 'app_dir', 'pd')} SELECT member_id, coalesce(pp.app, pd.app) AS app_id FROM m LEFT JOIN pp ON m.path = pp.path LEFT JOIN pd ON m.app_dir = pd.path",
    "clean_app_members": f"""WITH {_M}, {_place('m', 'path', 'pp')}, {_place('m', 'app_dir', 'pd')}, x AS (SELECT member_id, coalesce(pp.app, pd.app) AS app_id FROM m LEFT JOIN pp ON m.path = pp.path LEFT JOIN pd ON m.app_dir = pd.path)
      SELECT member_id FROM x LEFT JOIN apps a ON x.app_id = a.app_id WHERE x.app_id IS NULL OR coalesce(a.error_clean, false)""",
    "candidate_baselines": f"WITH {_C}, {_place('c', 'path', 'pp')} SELECT gen, error_clean, symbol_version, count(*) AS n FROM c LEFT JOIN pp ON c.path = pp.path LEFT JOIN apps a ON a.app_id = pp.app GROUP BY ALL",
    "resume_anti_join": f"""WITH {_M}, {_C}, d AS (SELECT DISTINCT concat_ws('::', {_clean('path')}, meta.member) AS k FROM c)
      SELECT member_id FROM m WHERE has_body AND path IS NOT NULL AND concat_ws('::', {_clean('path')}, member_name) NOT IN (SELECT k FROM d)""",
    "severity_templates": f"""WITH {_M}, {_hits()}, cat(code, message) AS (VALUES ('AA0137', 'unused variable'), ('LC0003', 'magic number'), ('AW0006', 'page style'), ('FC0001', 'spacing'), ('DC0004', 'missing documentation'))
      SELECT h.code, CASE WHEN lower(trim(coalesce(severity, ''))) = 'error' THEN 'error' WHEN lower(trim(coalesce(severity, ''))) IN ('info', 'hidden') THEN 'info' ELSE 'warning' END AS severity,
      coalesce(message, '') AS message, count(*) AS n FROM h LEFT JOIN cat ON h.code = cat.code GROUP BY ALL""",
    "diagnostic_categories": f"""WITH {_M}, {_hits()}, {_hits('error_hits', 'e')}, b AS (SELECT code FROM h UNION ALL SELECT code FROM e), {_CATALOGUE}
      SELECT coalesce(category, 'analyzer-style') AS category, count(*) AS n FROM b LEFT JOIN k ON b.code = k.code GROUP BY ALL""",
    "error_catalogue": f"WITH {_M}, {_hits()}, {_hits('error_hits', 'e')}, b AS (SELECT code FROM h UNION SELECT code FROM e), {_CATALOGUE} SELECT k.code, category, likelihood, strategy, mutation FROM k JOIN b ON b.code = k.code",
    "parse_diagnostics": f"""WITH {_M}, {_hits()}, {_hits('error_hits', 'e')}, b AS (SELECT * FROM h UNION ALL SELECT * FROM e)
      SELECT repo, severity, code, substr(code, 1, 2) IN ('AA', 'AC', 'AW', 'DC', 'FC', 'LC', 'PC', 'TA', 'UI') AS analyzer, count(*) AS n, sum(line)::BIGINT AS lines FROM b WHERE path IS NOT NULL GROUP BY ALL""",
    "diagnostics_interval_join": f"WITH {_M}, {_hits()}, {_SPANS} SELECT owner, count(*) AS n, count(DISTINCT code) AS n_codes FROM h JOIN spans ON h.path = spans.path AND line - 1 BETWEEN s AND e GROUP BY owner",
    "near_hits": f"WITH {_M}, {_hits()}, {_hits('error_hits', 'e')} SELECT e.code AS error, h.code AS finding, count(*) AS n FROM e JOIN h ON e.member_id = h.member_id AND abs(e.line - h.line) <= 1 GROUP BY ALL",
    "code_histogram_topk": f"WITH {_M}, {_hits()}, n AS (SELECT object_kind, code, count(*) AS n FROM h GROUP BY ALL) SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY object_kind ORDER BY n DESC, code)::INT AS rank FROM n) WHERE rank <= 8",
    "mode_code": f"WITH {_M}, {_hits()}, n AS (SELECT object_kind, code, count(*) AS n FROM h GROUP BY ALL) SELECT object_kind, code, n FROM (SELECT *, row_number() OVER (PARTITION BY object_kind ORDER BY n DESC, code) AS r FROM n) WHERE r = 1",
    "code_combinations": f"WITH {_M}, {_hits()}, p AS (SELECT member_id, string_agg(code, '|' ORDER BY code) AS combination FROM h GROUP BY member_id) SELECT combination, count(*) AS n FROM p GROUP BY ALL",
    "multiset_difference": """WITH x AS (SELECT coalesce(repo, '') AS repo, symbol_version >= '24' AS new, unnest(error_codes) AS code FROM apps),
      b AS (SELECT repo, code, count(*) AS b FROM x WHERE new GROUP BY ALL), g AS (SELECT repo, code, count(*) AS g FROM x WHERE NOT new GROUP BY ALL)
      SELECT b.repo, b.code, b - coalesce(g, 0) AS n FROM b LEFT JOIN g ON b.repo = g.repo AND b.code = g.code WHERE b - coalesce(g, 0) > 0""",
    "baseline_codes": """WITH r AS (SELECT coalesce(repo, '') AS repo, count(*) AS n_apps, round(count(*) FILTER (error_clean) / greatest(count(*), 1), 3) AS clean_rate FROM apps GROUP BY 1),
      c AS (SELECT repo, string_agg(code, ',' ORDER BY code) AS codes FROM (SELECT DISTINCT coalesce(repo, '') AS repo, unnest(error_codes) AS code FROM apps) GROUP BY 1)
      SELECT r.repo, n_apps, clean_rate, codes FROM r LEFT JOIN c ON r.repo = c.repo""",
    "loc_buckets": f"""WITH {_M} SELECT member_kind, CASE WHEN body_loc = 0 THEN '0' WHEN body_loc <= 2 THEN '1-2' WHEN body_loc <= 10 THEN '3-10' WHEN body_loc <= 30 THEN '11-30' WHEN body_loc <= 60 THEN '31-60' ELSE '60+' END AS bucket,
      count(*) AS n FROM m GROUP BY ALL""",
    "rate_rollup": f"WITH {_M} SELECT coalesce(object_kind, 'ALL') AS object_kind, count(*) AS n, sum((len(analyzer_hits) > 0)::INT)::BIGINT AS n_hit, round(sum((len(analyzer_hits) > 0)::INT) / greatest(count(*), 1), 3) AS rate FROM m GROUP BY ROLLUP (object_kind)",
    "ranked_codes": f"WITH {_M}, {_hits()} SELECT code, count(*) AS n FROM h GROUP BY code ORDER BY n DESC, code LIMIT 40",
    "memo_lookup": f"""WITH {_C}, i AS (SELECT DISTINCT gen, target_al FROM c WHERE target_al IS NOT NULL), k AS (SELECT DISTINCT target_al FROM c WHERE rejected_al IS NOT NULL)
      SELECT gen, count(*) AS n_inputs, count(k.target_al) AS n_known FROM i LEFT JOIN k ON i.target_al = k.target_al GROUP BY gen""",
    "work_chunks": f"""WITH {_C}, x AS (SELECT cand_id, array_to_string(string_split({_clean('path')}, '/')[1:5], '/') AS app FROM c WHERE gen = 'g5_error_fix' AND path IS NOT NULL),
      y AS (SELECT app, (row_number() OVER (PARTITION BY app ORDER BY cand_id) - 1) // 40 AS chunk FROM x) SELECT app, chunk, count(*) AS n FROM y GROUP BY ALL""",
    "g1_candidates": f"""WITH {_M} SELECT member_id AS record_id, concat_ws(' ', object_kind, object_name) AS object,
      sha1('Complete the body of `' || member_name || '` in this AL ' || object_kind || '. Return only the full procedure.' || chr(10) || chr(10) || {_FENCE.format('(' + _CTX + ')')} || chr(10) || chr(10) || 'Procedure to implement:' || chr(10) || {_FENCE.format('signature')}) AS prompt_sha,
      sha1({_FENCE.format('member_text')}) AS answer_sha FROM m WHERE {_USABLE}""",
    "g2_candidates": f"""WITH {_M} SELECT member_id AS record_id, sha1('Implement this AL procedure in ' || object_kind || ' "' || object_name || '".' || chr(10) || chr(10) || 'Intent:' || chr(10) || {_SAID} || chr(10) || chr(10) || 'Signature:' || chr(10) || {_FENCE.format('signature')}) AS prompt_sha
      FROM m WHERE {_USABLE} AND length({_SAID}) >= 25 AND NOT regexp_matches(lower({_SAID}), '^(todo|wip)')""",
    "g3_candidates": rf"""WITH {_M}, x AS (SELECT *, list_sort(list_distinct(regexp_extract_all(body, '\b([A-Z][A-Za-z0-9_]*)\s*\(', 1))) AS calls,
      list_sort(list_distinct(list_transform(regexp_extract_all(member_text, '\bRecord\s+("[^"]+"|\w+)', 1), lambda r: replace(r, '"', '')))) AS recs, trim(regexp_extract(signature, '\)\s*:\s*(.+)$', 1)) AS ret FROM m WHERE has_body AND body_loc >= 4)
      SELECT member_id AS record_id, concat_ws(' ', '`' || member_name || '` is a' || CASE WHEN is_local THEN 'n internal' ELSE '' END || ' ' || member_kind || ' on ' || object_kind || ' "' || object_name || '".',
      CASE WHEN len(recs) > 0 THEN 'It works with the record type(s): ' || array_to_string(recs, ', ') || '.' END, CASE WHEN len(calls) > 0 THEN 'It calls: ' || array_to_string(calls[1:12], ', ') || '.' END,
      CASE WHEN ret <> '' THEN 'It returns `' || ret || '`.' END) AS answer FROM x""",
    "g7_probes": f"""WITH {_M}, a AS (SELECT 'g1_fim' AS probe_of, repo FROM m WHERE {_USABLE} UNION ALL
      SELECT 'g2_sig2body', repo FROM m WHERE {_USABLE} AND length({_SAID}) >= 25 AND NOT regexp_matches(lower({_SAID}), '^(todo|wip)')) SELECT probe_of, repo, count(*) AS n FROM a GROUP BY ALL""",
    "g8_reviews": f"""WITH {_M}, x AS (SELECT DISTINCT member_id, unnest(list_transform(analyzer_hits, lambda h: h.code)) AS rule FROM m),
      cat(rule, message) AS (VALUES ('AA0137', 'unused variable'), ('LC0003', 'magic number')), y AS (SELECT member_id, x.rule, '- ' || x.rule || CASE WHEN message IS NOT NULL THEN ': ' || message ELSE '' END AS line FROM x LEFT JOIN cat ON x.rule = cat.rule)
      SELECT member_id AS record_id, string_agg(rule, ',' ORDER BY rule) AS rules, 'Analyzer findings: ' || string_agg(rule, ', ' ORDER BY rule) || '.' || chr(10) || string_agg(line, chr(10) ORDER BY rule) || chr(10) || 'The code compiles but violates the rules above.' AS answer
      FROM y GROUP BY member_id""",
    "page_sections": rf"""WITH {_PIECES}, l AS (SELECT doc_id, trim(regexp_replace(regexp_extract(piece, '\A([^\n]*)', 1), '^#+\s+', '')) AS heading FROM pieces WHERE regexp_matches(piece, '\A#{{2,3}}\s+\S'))
      SELECT doc_id, count(*) AS n_sections, sum(length(heading))::BIGINT AS heading_chars FROM l GROUP BY doc_id""",
    "page_references": f"WITH d AS (SELECT doc_id, coalesce({_reference(_H1)}, {_reference(_TITLE)}) AS r, {_TITLE} AS title FROM documents) SELECT doc_id, r[1] AS name, r[2] AS kind, title FROM d WHERE r IS NOT NULL",
    "nearest_name": rf"""WITH {_M}, {_C}, p AS (SELECT DISTINCT member_name AS e FROM m WHERE member_name IS NOT NULL),
      b AS (SELECT DISTINCT unnest(regexp_extract_all(rejected_al, '\b(?:procedure|trigger) (\w+)', 1)) AS name FROM c),
      n AS (SELECT name, lower(e) AS le, min(e) AS e FROM b JOIN p ON abs(length(name) - length(e)) <= 2 AND levenshtein(lower(name), lower(e)) BETWEEN 1 AND 2 WHERE name NOT IN (SELECT e FROM p) GROUP BY ALL)
      SELECT name, min(e) AS nearest FROM n GROUP BY name HAVING count(*) = 1""",
    "vocabulary": rf"""WITH {_M}, w AS (SELECT unnest(regexp_extract_all(member_text, '[A-Za-z_][A-Za-z0-9_]*')) AS name FROM m UNION SELECT unnest(regexp_extract_all(s, '[A-Za-z_][A-Za-z0-9_]*')) FROM (SELECT unnest(sibling_signatures) AS s FROM m)
      UNION SELECT member_name FROM m UNION SELECT replace(object_name, '"', '') FROM m) SELECT lower(substr(name, 1, 1)) AS initial, count(*) AS n FROM w WHERE length(name) >= 3 GROUP BY ALL""",
    "sharegpt_rows": f"""WITH {_C} SELECT cand_id, array_to_string(list_transform(messages, lambda x: CASE x.role WHEN 'user' THEN 'human' WHEN 'assistant' THEN 'gpt' ELSE x.role END), ',') AS roles,
      sha1(array_to_string(list_transform(messages, lambda x: x.content), chr(10))) AS text_sha FROM c""",
    "preference_pairs": f"WITH {_C} SELECT cand_id, sha1(first_text) AS prompt_sha, sha1(messages[-1].content) AS chosen_sha, sha1(rejected_al) AS rejected_sha FROM c WHERE length(rejected_al) > 0",
    "assembled_parts": f"WITH {_ROUTED} SELECT gen, part, count(*) AS n FROM parts GROUP BY ALL",
    "datacard": f"""WITH {_ROUTED}, b AS (SELECT gen, count(*) FILTER (part <> 'heldout') AS n, count(*) FILTER (part = 'heldout') AS h FROM parts WHERE part <> 'capped' GROUP BY gen),
      n AS (SELECT count(*) AS n_rows, count(*) FILTER (part = 'train') AS n_train, count(*) FILTER (part = 'val') AS n_val, count(*) FILTER (part = 'preference') AS n_preference, count(*) FILTER (part = 'heldout') AS n_heldout, count(*) FILTER (part = 'capped') AS n_capped FROM parts)
      SELECT n.*, (SELECT '{{' || string_agg('"' || gen || '":' || n, ',' ORDER BY gen) || '}}' FROM b) AS by_gen, (SELECT '{{' || string_agg('"' || gen || '":' || h, ',' ORDER BY gen) || '}}' FROM b) AS heldout_by_gen FROM n""",
    "prose_filter": rf"""WITH l AS (SELECT doc_id, text, k, regexp_replace(regexp_replace(x, '^\s+', ''), '\s+$', '') AS line FROM (SELECT doc_id, text, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS k, unnest(string_split(text, chr(10))) AS x FROM documents WHERE text IS NOT NULL)),
      f AS (SELECT *, starts_with(line, '```') AS mark, sum(starts_with(line, '```')::INT) OVER (PARTITION BY doc_id ORDER BY k) % 2 = 1 AS fence FROM l WHERE line <> ''),
      r AS (SELECT doc_id, count(*) FILTER (NOT mark AND NOT fence) AS total, count(*) FILTER (NOT mark AND NOT fence AND NOT regexp_matches(line, '^[-*>\s]*\[[^\]]+\]\([^)]+\)[.\s]*$') AND NOT regexp_matches(line, '^(\||!\[|\[//\]|\[!INCLUDE|\[!NOTE|\[!TIP|\[!IMPORTANT|&emsp;|<)')) AS prose FROM f GROUP BY doc_id),
      p AS (SELECT d.doc_id, text, CASE WHEN coalesce(total, 0) > 0 THEN prose / total ELSE 0.0 END AS ratio, regexp_replace(text, '(?s)```.*?```', ' ', 'g') AS bare FROM documents d LEFT JOIN r ON d.doc_id = r.doc_id WHERE text IS NOT NULL)
      SELECT doc_id, round(ratio, 6) AS prose_ratio, length(text) BETWEEN 150 AND 6000 AND length(trim(regexp_replace(bare, '\[[^\]]+\]\([^)]+\)|[|>*#`_-]', '', 'g'))) >= 150
        AND (regexp_matches(text, '(?im)^\s*```\s*(al|c#|csharp|pascal)') OR (ratio >= 0.60 AND len(regexp_extract_all(bare, '[.!?](\s|$)')) >= 2)) AS teaches FROM p""",
    "incremental_dedup": f"SELECT count(DISTINCT {_norm('text')}) AS n_kept FROM documents",
    "events_per_day": "SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, event_type, count(*) AS n FROM events WHERE ts IS NOT NULL GROUP BY ALL",
}
