"""The queries that SQL can say, in SQL; exact versions over all rows, quadratic where the operators are not."""

from __future__ import annotations

from ..plans.oracle import _C, _M, _clean, _place

_THREE = "list_distinct(list_transform(range(1, len(w) - 1), lambda k: w[k] || ' ' || w[k + 1] || ' ' || w[k + 2]))"


def _pairs(source: str, extra: str = "", on: str = "a.id < b.id") -> str:
    """pairs(a, b) of ids whose three-word runs overlap by 0.6, of source(id, t)."""
    return f"""w AS (SELECT * FROM (SELECT *, regexp_extract_all(lower(t), '[a-z0-9_]+') AS w FROM {source}) WHERE len(w) >= 20),
      s AS (SELECT id{extra}, {_THREE} AS s FROM w), f AS (SELECT id{extra}, len(s) AS n, unnest(s) AS x FROM s),
      pairs AS (SELECT a.id AS a, b.id AS b FROM f a JOIN f b ON a.x = b.x AND {on} GROUP BY a.id, b.id HAVING count(*) / (any_value(a.n) + any_value(b.n) - count(*)) >= 0.6)"""


_SHARE = """g AS (SELECT row_id AS id, regexp_replace(lower(split), '\\s+', '', 'g') AS part, meta.repo AS repo,
      array_to_string(list_transform(list_filter(conversations, lambda x: coalesce(lower(trim(x."from")), '') <> 'system'), lambda x: x.value), chr(10)) AS t FROM sharegpt)"""
_PART = "f AS (SELECT * FROM g WHERE part = 'train' OR part IN ('val', 'heldout', 'test'))"
_P1 = f"{_SHARE}, {_pairs('g', ', part', chr(97) + '.part IN (' + repr('val') + ', ' + repr('heldout') + ', ' + repr('test') + ') AND b.part = ' + repr('train'))}"
_TWELVE = "list_transform(range(1, len(w) - 10), lambda k: array_to_string(w[k:k + 11], ' '))"
_PERSON = r"nullif(regexp_replace(regexp_replace(lower(trim(meta.author)), '^@+', ''), '[\s._-]+', '-', 'g'), '')"
_NOBODY = "('n/a', 'unknown', 'build-agent', 'merge-queue')"
_THING = r"""nullif(trim(regexp_replace(regexp_replace(lower(object), '["''`]', ' ', 'g'), '\s+', ' ', 'g')), '')"""
_RELATED = rf"""{_C}, {_place('c', 'path', 'pp')},
      k AS (SELECT DISTINCT pp.app, 'author ' || {_PERSON} AS k FROM c JOIN pp ON c.path = pp.path WHERE {_PERSON} NOT IN {_NOBODY}
        UNION SELECT pp.app, 'object ' || {_THING} FROM c JOIN pp ON c.path = pp.path WHERE {_THING} IS NOT NULL
        UNION SELECT app_id, 'folder ' || regexp_replace({_clean('app_dir')}, '/[^/]*$', '') FROM apps),
      e AS (SELECT DISTINCT x.app AS a, y.app AS b FROM k x JOIN k y ON x.k = y.k),
      r(a, b) AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)"""

SQL = {
    "p1_found": f"WITH {_P1} SELECT DISTINCT least(a, b) AS row_id_a, greatest(a, b) AS row_id_b FROM pairs",
    "p1_report": f"WITH {_P1} SELECT part AS split, repo, count(DISTINCT id) AS n_records, count(DISTINCT CASE WHEN id IN (SELECT a FROM pairs) THEN id END) AS n_leaked FROM (SELECT g.*, w.id AS wid FROM g JOIN w ON g.id = w.id) WHERE part IN ('val', 'heldout', 'test') GROUP BY ALL",
    "p3_found": f"WITH RECURSIVE {_RELATED} SELECT a AS app_id_a, b AS app_id_b FROM r WHERE a < b",
    "p3_totals": "SELECT s.split, CASE s.split WHEN 'train' THEN n - 2 * floor(n * 0.1 + 0.5)::BIGINT ELSE floor(n * 0.1 + 0.5)::BIGINT END AS n_candidates FROM (VALUES ('train'), ('validation'), ('test')) s(split), (SELECT count(DISTINCT cand_id) AS n FROM candidates) WHERE n > 0",
    "p3_groups": f"""WITH RECURSIVE {_RELATED}, {_M}, {_place('m', 'path', 'mp')}, {_place('m', 'app_dir', 'md')},
      root AS (SELECT app_id, least(app_id, coalesce(min(r.b), app_id)) AS root FROM apps LEFT JOIN r ON r.a = app_id GROUP BY app_id),
      rec AS (SELECT 'candidates' AS origin, cand_id AS id, pp.app FROM c JOIN pp ON c.path = pp.path UNION ALL
        SELECT 'members', member_id, coalesce(mp.app, md.app) FROM m LEFT JOIN mp ON m.path = mp.path LEFT JOIN md ON m.app_dir = md.path)
      SELECT root AS app_id, count(*) FILTER (origin = 'candidates') AS n_candidates, count(*) FILTER (origin = 'members') AS n_members, 1::BIGINT AS n_splits FROM rec JOIN root ON rec.app = root.app_id GROUP BY root""",
    "p4_found": f"WITH {_M}, t AS (SELECT member_id AS id, member_text AS t FROM m), {_pairs('t')} SELECT a AS member_id_a, b AS member_id_b FROM pairs",
    "p4_groups": f"""WITH RECURSIVE {_M}, t AS (SELECT member_id AS id, member_text AS t FROM m), {_pairs('t')},
      k AS (SELECT id, min(id) OVER (PARTITION BY list_sort(s)) AS copy_of, count(*) OVER (PARTITION BY list_sort(s)) AS copies FROM s),
      l AS (SELECT DISTINCT x.copy_of AS a, y.copy_of AS b FROM pairs JOIN k x ON pairs.a = x.id JOIN k y ON pairs.b = y.id WHERE x.copy_of <> y.copy_of),
      e AS (SELECT a, b FROM l UNION SELECT b, a FROM l), r(a, b) AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
      g AS (SELECT a, min(least(a, b)) AS grp FROM r GROUP BY a), d AS (SELECT a, count(DISTINCT b) AS n FROM e GROUP BY a)
      SELECT id AS member_id, copy_of, coalesce(d.n, 0) AS n_links, coalesce(g.grp, copy_of) AS "group" FROM k LEFT JOIN d ON copy_of = d.a LEFT JOIN g ON copy_of = g.a WHERE copies > 1 OR d.n IS NOT NULL""",
    "p5_found": rf"""WITH d AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+') AS w FROM documents), i AS (SELECT item_id, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+') AS w FROM benchmark),
      x AS (SELECT doc_id, unnest({_TWELVE}) AS s FROM d WHERE len(w) >= 12), y AS (SELECT item_id, unnest({_TWELVE}) AS s FROM i WHERE len(w) >= 12)
      SELECT DISTINCT doc_id, item_id FROM x JOIN y ON x.s = y.s""",
    "p6_texts": r"""WITH k AS (SELECT DISTINCT regexp_replace(lower(trim(source)), '[\s_]+', '-', 'g') AS source FROM mix_targets WHERE target_share > 0),
      d AS (SELECT doc_id, text, regexp_replace(lower(trim(source)), '[\s_]+', '-', 'g') AS source FROM documents WHERE length(text) > 0)
      SELECT source, count(*) AS n_texts, 0::BIGINT AS n_over_cap, 0::BIGINT AS n_repeated FROM (SELECT text, arg_min(source, doc_id) AS source FROM d WHERE source IN (SELECT source FROM k) GROUP BY text) GROUP BY source""",
    "p7_kept": "SELECT 0::BIGINT AS n_letters_changed, 0::BIGINT AS n_not_restored",
}
