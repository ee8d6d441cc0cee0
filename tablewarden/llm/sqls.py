"""DuckDB texts of the queries that SQL can express."""

from __future__ import annotations

from . import pii
from .conversations import NEXT, ROLE
from .fingerprints import DIGITS, PARAGRAPHS, PIECES

_TREE = f"""list_transform(string_split(regexp_replace({{0}}, '(' || chr(10) || chr(10) || '+)', '\\1' || chr(1), 'g'), chr(1)),
  lambda s: list_transform(regexp_extract_all(s, '{PARAGRAPHS}'),
    lambda p: list_transform(regexp_extract_all(p, '{PIECES}'),
      lambda q: substr(sha256(q), 1, {DIGITS}) || ':' || length(q))))"""
_BRANCHES = "list_transform({0}, lambda s: sha256(array_to_string(list_transform(s, lambda p: sha256(array_to_string(p, ','))), ',')))"
_SET = "list_distinct(flatten(flatten({0})))"
_WEIGHT = f"coalesce(list_sum(list_transform({{0}}, lambda k: CAST(substr(k, {DIGITS + 2}) AS BIGINT))), 0)"


def _near(a: str, b: str) -> str:
    both = f"({_WEIGHT.format(a)} + {_WEIGHT.format(b)})"
    return f"CASE WHEN {both} = 0 THEN 1.0 ELSE round({_WEIGHT.format(f'list_intersect({a}, {b})')} * 2.0 / {both}, 6) END"


OP1 = f"""
WITH own AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
nexts AS (SELECT doc_id, text, coalesce(lead(text) OVER w, first_value(text) OVER w) AS next_text FROM own
          WINDOW w AS (ORDER BY doc_id DESC NULLS LAST, sha256(text), text)),
edits AS (SELECT *, left(text, length(text) - CAST(floor(length(text) / 3) AS BIGINT)) || left(next_text, CAST(floor(length(text) / 3) AS BIGINT)) AS edited FROM nexts),
trees AS (SELECT *, {_TREE.replace("{0}", "text")} AS tree, {_TREE.replace("{0}", "edited")} AS edited_tree, {_TREE.replace("{0}", "next_text")} AS next_tree FROM edits),
sets AS (SELECT *, {_BRANCHES.format("tree")} AS branches, {_BRANCHES.format("edited_tree")} AS edited_branches,
         {_SET.format("tree")} AS own_set, {_SET.format("edited_tree")} AS edited_set, {_SET.format("next_tree")} AS next_set FROM trees)
SELECT doc_id, CAST(length(text) AS BIGINT) AS n_chars, sha256(edited) AS edited_sha256,
  sha256(array_to_string(branches, ',')) AS fingerprint, sha256(array_to_string(edited_branches, ',')) AS edited_fingerprint,
  {_near("own_set", "edited_set")} AS near_edited, {_near("own_set", "next_set")} AS near_next,
  CAST(len(own_set) AS BIGINT) AS n_leaves,
  CAST(len(list_filter(range(greatest(len(branches), len(edited_branches))), lambda i: branches[i + 1] IS DISTINCT FROM edited_branches[i + 1])) AS BIGINT) AS changed_sections
FROM sets
"""


#: Exact similarities of all pairs that share a shingle, and the smallest id that links reach.
OP7 = """
WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]] ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM words),
one AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS c FROM one a JOIN one b ON a.x = b.x AND a.doc_id < b.doc_id AND a.n * 5 >= b.n * 4 AND b.n * 5 >= a.n * 4 GROUP BY ALL),
links AS (SELECT a, b FROM pairs WHERE 100 * c >= 80 * (na + nb - c) UNION ALL SELECT b, a FROM pairs WHERE 100 * c >= 80 * (na + nb - c)),
reach AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least AS (SELECT a, min(b) AS m FROM reach GROUP BY a)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, coalesce(least(m, doc_id), doc_id) AS component_id, coalesce(least(m, doc_id), doc_id) = doc_id AS kept FROM sets LEFT JOIN least ON doc_id = a
"""

#: Every 200-byte string by its place, in hexadecimal text.
OP9 = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
starts AS (SELECT r, unnest(range(greatest(length(h) // 2 - 199, 0))) AS p, unnest(list_transform(range(greatest(length(h) // 2 - 199, 0)), lambda i: md5(substr(h, 2 * i + 1, 400)))) AS k FROM d),
again AS (SELECT r, p FROM starts WHERE k IN (SELECT k FROM starts GROUP BY k HAVING count(*) > 1)),
bytes AS (SELECT r, unnest(range(length(h) // 2)) AS p, unnest(list_transform(range(length(h) // 2), lambda i: substr(h, 2 * i + 1, 2))) AS x FROM d),
last AS (SELECT bytes.r, bytes.p, x, max(again.p) OVER (PARTITION BY bytes.r ORDER BY bytes.p) AS s FROM bytes LEFT JOIN again ON bytes.r = again.r AND bytes.p = again.p),
gone AS (SELECT r, p, x, coalesce(p - s < 200, false) AS g, lag(coalesce(p - s < 200, false), 1, false) OVER (PARTITION BY r ORDER BY p) AS before FROM last),
sums AS (SELECT r, count(*) FILTER (g) AS n_removed, count(*) FILTER (g AND NOT before) AS n_spans, string_agg(CASE WHEN g THEN '' ELSE x END, '' ORDER BY p) AS kept FROM gone GROUP BY r)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256 FROM d LEFT JOIN sums USING (r)
"""


def _moves_sql() -> str:
    """q, ins, edit, q2, initial that the edit needs, role that it gives: by state, whether an insertion comes first, and edit."""
    rows = []
    for q in range(4):
        for ins in (False, True):
            at = NEXT[q] if ins else q
            rows += [(q, ins, "D", at, None, None), (q, ins, "R", NEXT[at], None, ROLE[at]), (q, ins, "K", NEXT[at], ROLE[at][0], None)]
            if at == 0:
                rows.append((q, ins, "K", 1, "s", None))
    text = lambda x: "NULL" if x is None else f"'{x}'" if isinstance(x, str) else str(x).lower()
    return ", ".join(f"({', '.join(map(text, r))})" for r in rows)


#: The damage, its faults, and the program over states, one row of every conversation a step.
OP12 = f"""
WITH RECURSIVE
crcs AS MATERIALIZED (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
src AS (SELECT dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS c, conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda x: CAST(ascii(x) AS BIGINT)) AS codes FROM conversations),
kinds AS (SELECT src.*, xor(list_reduce(list_prepend(4294967295, codes), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS kind FROM src, crcs),
damaged AS (SELECT c, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
            unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM kinds),
placed AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, text) AS n FROM damaged),
faults AS (SELECT *, row_number() OVER (PARTITION BY c, role, text ORDER BY n) > 1 AS seen, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
           right(regexp_replace(text, '[\x20\x09-\x0D]+$', ''), 1) NOT IN ('.', '!', '?') AS cut, lag(left(role, 1)) OVER (PARTITION BY c ORDER BY n) AS before FROM placed),
marked AS MATERIALIZED (SELECT *, blank OR seen AS gone, cut AND NOT (blank OR seen) AS short FROM faults),
counts AS (SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (seen AND NOT blank) AS duplicate, count(*) FILTER (short) AS truncated,
           count(*) FILTER (before IS NOT NULL AND before || left(role, 1) NOT IN ('su', 'ua', 'au')) AS illegal, max(n) AS n FROM marked GROUP BY c),
moves(q, ins, edit, q2, needs, gives) AS (VALUES {_moves_sql()}),
roles(q, says) AS (VALUES {", ".join(f"({q}, '{r}')" for q, r in enumerate(ROLE))}),
steps(c, n, q, best) AS (
  SELECT DISTINCT c, CAST(0 AS BIGINT), 0, {{'cost': CAST(0 AS BIGINT), 'audit': '', 'rows': CAST([] AS VARCHAR[])}} FROM src
  UNION ALL
  SELECT s.c, m.n, v.q2, min({{'cost': s.best.cost + CASE WHEN ins THEN 5 ELSE 0 END + CASE edit WHEN 'D' THEN 2 WHEN 'R' THEN 1 ELSE 0 END + CASE WHEN edit <> 'D' AND m.short THEN 5 ELSE 0 END,
    'audit': s.best.audit || CASE WHEN ins THEN 'I' ELSE '' END || edit,
    'rows': list_concat(s.best.rows, list_concat(CASE WHEN ins THEN [r.says || ':'] ELSE [] END, CASE edit WHEN 'D' THEN [] ELSE [coalesce(gives, m.role) || ':' || m.text] END))}})
  FROM steps s JOIN marked m ON m.c = s.c AND m.n = s.n + 1 JOIN moves v ON v.q = s.q JOIN roles r ON r.q = s.q
  WHERE (edit = 'D' OR NOT m.gone) AND (needs IS NULL OR needs = left(m.role, 1))
  GROUP BY s.c, m.n, v.q2),
ends AS (SELECT s.c, min(CASE WHEN q = 2 THEN {{'cost': best.cost + 5, 'audit': best.audit || 'I', 'rows': list_concat(best.rows, ['assistant:'])}} ELSE best END) AS best
         FROM steps s LEFT JOIN counts USING (c) WHERE s.n = coalesce(counts.n, 0) AND q <> 1 GROUP BY s.c)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  best.cost AS cost, best.audit AS audit, sha256(array_to_string(best.rows, chr(10))) AS repaired_sha256, CAST(len(best.rows) AS BIGINT) AS n_repaired
FROM (SELECT DISTINCT c, conv_id FROM src) JOIN ends USING (c) LEFT JOIN counts USING (c)
"""


_ASCII = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_FIGURES = "regexp_replace({0}, '[^0-9]', '', 'g')"
_LUHN = f"""list_sum(list_transform(range(length({_FIGURES})), lambda i: CASE WHEN i % 2 = 0 THEN CAST(substr(reverse({_FIGURES}), i + 1, 1) AS BIGINT)
  ELSE (CAST(substr(reverse({_FIGURES}), i + 1, 1) AS BIGINT) * 2) % 10 + (CAST(substr(reverse({_FIGURES}), i + 1, 1) AS BIGINT) * 2) // 10 END)) % 10 = 0"""


def _pii() -> str:
    """The base spans, the graph of patterns and instances, and its rounds one after the other."""
    check = {"email": "true", "ip": f"regexp_matches({{0}}, '{pii.IP_PARTS}')", "card": f"length({_FIGURES}) BETWEEN 13 AND 19 AND {_LUHN}", "phone": f"length({_FIGURES}) BETWEEN 9 AND 15"}
    every = " UNION ALL ".join(f"SELECT r, {i} AS kind, regexp_extract_all(text, '{p}') AS m, string_split_regex(text, '{p}') AS g FROM d" for i, p in enumerate([*(pii.PLAIN[k] for k in pii.KINDS), pii.INSTANCE]))
    held = " OR ".join(f"kind = {i} AND {check[k].replace('{0}', 'v')}" for i, k in enumerate(pii.KINDS))
    seed = "coalesce(" + ", ".join(f"CASE WHEN regexp_full_match(v, '{pii.PLAIN[k]}') AND {check[k].replace('{0}', 'v')} THEN {i} END" for i, k in enumerate(pii.KINDS)) + ")"
    ks = range(len(pii.KINDS))
    p = ", ".join(f"CASE WHEN known{k} >= {pii.SEEDS} AND (known{k} * {pii.ONE} + s{k}) // (n + 1) >= {pii.SURE} THEN CAST((known{k} * {pii.ONE} + s{k}) // (n + 1) AS BIGINT) ELSE 0 END AS p{k}" for k in ks)
    rounds = f"p0 AS (SELECT pattern, {p} FROM (SELECT *, {', '.join(f'0 AS s{k}' for k in ks)} FROM counts))"
    for i in range(1, pii.ROUNDS):
        rounds += f""",
v{i} AS (SELECT value, {", ".join(f"max(CASE WHEN can{k} THEN p{k} ELSE 0 END) AS s{k}" for k in ks)} FROM edges JOIN p{i - 1} USING (pattern) WHERE seed IS NULL GROUP BY value),
p{i} AS (SELECT pattern, {p} FROM counts LEFT JOIN (SELECT pattern, {", ".join(f"CAST(sum(s{k}) AS BIGINT) AS t{k}" for k in ks)} FROM edges JOIN v{i} USING (value) WHERE seed IS NULL GROUP BY pattern) USING (pattern), LATERAL (SELECT {", ".join(f"coalesce(t{k}, 0) AS s{k}" for k in ks)}))"""
    best = f"greatest({', '.join(f'CASE WHEN can{k} THEN p{k} ELSE 0 END' for k in ks)})"
    names = "[" + ", ".join(f"'{k}'" for k in pii.KINDS) + "]"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
raw AS ({every}),
lens AS (SELECT *, list_transform(m, lambda x: length(x)) AS ml, list_transform(g, lambda x: length(x)) AS gl, unnest(range(1, len(m) + 1)) AS i FROM raw),
found AS (SELECT r, kind, m[i] AS v, coalesce(list_sum(gl[1:i]), 0) + coalesce(list_sum(ml[1:i - 1]), 0) AS a, right(g[i], {pii.BEFORE}) AS before, "left"(g[i + 1], {pii.AFTER}) AS after FROM lens),
base AS (SELECT r, kind, CAST(a AS BIGINT) AS a, CAST(a + length(v) AS BIGINT) AS b FROM found WHERE {held}),
runs AS MATERIALIZED (SELECT r, CAST(a AS BIGINT) AS a, CAST(a + length(v) AS BIGINT) AS b, regexp_matches(v, '@|[(]at[)]|[[]at[]]') AS address, contains(v, ':') AS colons, v, {_FIGURES.replace("{0}", "v")} AS figures, {seed} AS seed,
  regexp_extract_all({_ASCII.format("before")}, '{pii.WORD}') AS l, regexp_extract_all({_ASCII.format("after")}, '{pii.WORD}') AS w
  FROM found WHERE kind = {len(pii.KINDS)} AND NOT regexp_matches("right"(before, 1), '[A-Za-z0-9_]') AND NOT regexp_matches("left"(after, 1), '[A-Za-z0-9_]')),
places AS MATERIALIZED (SELECT r, a, b, seed, CASE WHEN address OR colons THEN {_ASCII.format("replace(v, ' ', '')")} ELSE figures END AS value, address AS can0, colons AS can1,
  NOT address AND NOT colons AND length(figures) BETWEEN 12 AND 19 AND regexp_full_match(v, '[0-9 -]+') AS can2, NOT address AND NOT colons AND length(figures) BETWEEN 7 AND 15 AS can3,
  unnest(list_filter(['2 ' || l[-2] || ' ' || l[-1], '1 ' || l[-1], 'r ' || l[-1] || ' _ ' || w[1]], lambda x: x IS NOT NULL)) AS pattern FROM runs),
edges AS MATERIALIZED (SELECT pattern, value, max(seed) AS seed, {", ".join(f"max(can{k}) AS can{k}" for k in ks)} FROM places GROUP BY pattern, value),
counts AS MATERIALIZED (SELECT pattern, count(*) AS n, {", ".join(f"count(*) FILTER (seed = {k}) AS known{k}" for k in ks)} FROM edges GROUP BY pattern),
{rounds},
named AS (SELECT r, a, b, max({{'p': {best}, 'k': CASE {" ".join(f"WHEN can{k} AND p{k} = {best} THEN {-k}" for k in ks)} END}}) AS best FROM places JOIN p{pii.ROUNDS - 1} USING (pattern) WHERE seed IS NULL AND {best} > 0 GROUP BY r, a, b),
new AS (SELECT r, -best.k AS kind, a, b FROM named WHERE NOT EXISTS (SELECT 1 FROM base WHERE base.r = named.r AND base.a < named.b AND base.b > named.a)),
sums AS (SELECT r, {", ".join(f"count(*) FILTER (kind = {k}) AS n_{name}" for k, name in enumerate(pii.KINDS))}, string_agg({names}[kind + 1] || ':' || a || ':' || b, ',' ORDER BY kind, a) AS said FROM base GROUP BY r),
alls AS (SELECT r, count(*) AS n, string_agg({names}[kind + 1] || ':' || a || ':' || b, ',' ORDER BY kind, a) AS said FROM (SELECT r, kind, a, b FROM base UNION ALL SELECT r, kind, a, b FROM new) GROUP BY r),
more AS (SELECT r, count(*) AS n FROM new GROUP BY r)
SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in pii.KINDS)}, sha256(coalesce(sums.said, '')) AS base_sha256, coalesce(alls.said, '') AS spans, coalesce(more.n, 0) AS n_found
FROM d LEFT JOIN sums USING (r) LEFT JOIN alls USING (r) LEFT JOIN more USING (r)
"""


OP13 = _pii()


def oracle_sql() -> dict[str, str]:
    return {"op1_fingerprints": OP1, "op7_near_dups": OP7, "op9_repeats": OP9, "op12_conversations": OP12, "op13_pii": OP13}
