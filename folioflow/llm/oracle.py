"""SQL of another engine (DuckDB) for the queries that SQL can express, each written apart from the operator it checks."""

from __future__ import annotations

from .decontam import NUMBER_WORDS, units


def _listed(words) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


# The reading without names alone. Tokens are told apart by their first character.
_DECONTAMINATION = rf"""
WITH src AS (SELECT 'd' AS side, doc_id AS id, coalesce(text, '') AS text FROM documents UNION ALL SELECT DISTINCT 'i', item_id, coalesce(text, '') FROM benchmark),
t AS (SELECT side, id, regexp_extract_all(regexp_replace(lower(text), '[' || chr(1) || '-' || chr(4) || ']', ' ', 'g'), '\p{{N}}+(?:[.,:]\p{{N}}+)*|[%$€£°]|\p{{L}}+|  *') AS t FROM src),
v AS (SELECT side, id, list_filter(list_transform(t, lambda x, i: CASE WHEN x IN ('%', '$', '€', '£', '°') AND (i = 1 OR NOT regexp_matches(t[i - 1][1], '\p{{N}}') AND NOT (i > 2 AND t[i - 1] IN (' ', '  ') AND regexp_matches(t[i - 2][1], '\p{{N}}'))) THEN ' ' ELSE x END), lambda x: x[1] <> ' ') AS t FROM t),
u AS (SELECT side, id, list_transform(t, lambda x, i: CASE
  WHEN regexp_matches(x[1], '\p{{N}}') OR list_contains({_listed(NUMBER_WORDS)}, x) THEN chr(2) || x
  WHEN x IN ('%', '$', '€', '£', '°') THEN chr(3) || x
  WHEN i > 1 AND (regexp_matches(t[i - 1][1], '\p{{N}}') OR list_contains({_listed(NUMBER_WORDS)}, t[i - 1])) AND list_contains({_listed(units())}, x) THEN chr(3) || x
  ELSE x END) AS t FROM v),
p AS (SELECT side, id, t, unnest(range(greatest(len(t) - 4, 1))) AS pos FROM u WHERE len(t) > 0),
w AS (SELECT side, id, pos, t[pos + 1:pos + 5] AS w FROM p),
k AS (SELECT *, CASE WHEN len(list_filter(w, lambda x: x < chr(4))) = 5 THEN array_to_string(w, ' ') ELSE array_to_string(list_transform(w, lambda x: CASE WHEN x < chr(4) THEN x[1] ELSE x END), ' ') END AS template FROM w),
n AS (SELECT id AS item_id, count(*) AS n_windows FROM k WHERE side = 'i' GROUP BY id),
h AS (SELECT d.id AS doc_id, i.id AS item_id, d.pos - i.pos AS shift, i.pos AS ip, d.w AS dw, i.w AS iw FROM k d JOIN k i ON d.side = 'd' AND i.side = 'i' AND d.template = i.template),
s AS (SELECT doc_id, item_id, shift, ip, iw[j] AS i, dw[j] AS t FROM (SELECT *, unnest(range(1, len(iw) + 1)) AS j FROM h) WHERE iw[j] < chr(4)),
m AS (SELECT doc_id, item_id, shift, i, arg_max(t, {{'n': n, 't': t}}) AS t FROM (SELECT doc_id, item_id, shift, i, t, count(*) AS n FROM s GROUP BY ALL) GROUP BY ALL),
o AS (SELECT * FROM h WHERE NOT EXISTS (FROM s JOIN m USING (doc_id, item_id, shift, i) WHERE s.doc_id = h.doc_id AND s.item_id = h.item_id AND s.shift = h.shift AND s.ip = h.ip AND s.t <> m.t)),
l AS (SELECT doc_id, item_id, arg_max(shift, {{'n': n, 's': -shift}}) AS shift FROM (SELECT doc_id, item_id, shift, count(*) AS n FROM o GROUP BY ALL) GROUP BY ALL),
f AS (SELECT doc_id, item_id, i, t FROM m JOIN l USING (doc_id, item_id, shift)),
g AS (SELECT * FROM o WHERE NOT EXISTS (FROM s JOIN f USING (doc_id, item_id, i) WHERE s.doc_id = o.doc_id AND s.item_id = o.item_id AND s.shift = o.shift AND s.ip = o.ip AND s.t <> f.t)),
r AS (SELECT doc_id, g.item_id, count(DISTINCT ip) / max(n_windows) AS share FROM g JOIN n ON n.item_id = g.item_id GROUP BY 1, 2 HAVING count(DISTINCT ip) >= ceil(0.8 * max(n_windows))),
x AS (SELECT doc_id, list(item_id ORDER BY item_id) AS item_ids, max(share) AS share FROM r GROUP BY doc_id)
SELECT c.doc_id, x.doc_id IS NOT NULL AS contaminated, coalesce(x.item_ids, CAST([] AS BIGINT[])) AS item_ids, coalesce(x.share, 0.0) AS share FROM documents c LEFT JOIN x ON x.doc_id = c.doc_id"""

_WARC = """
WITH p AS (SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS h FROM pages),
b AS (SELECT page_id, url, CAST(strlen(h) AS BIGINT) AS payload_bytes, sha1(h) AS x, min(page_id) OVER (PARTITION BY sha1(h)) AS response FROM p)
SELECT page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((CAST('0x' || substr(x || '0', 1 + CAST(i * 5 // 4 AS INTEGER), 2) AS BIGINT) >> (3 - i * 5 % 4)) & 31 AS INTEGER), 1)), '') AS payload_digest,
CASE WHEN page_id = response THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> response THEN response END AS refers_to, url FROM b"""

_JOIN = r"""
WITH RECURSIVE t AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '\s+'), lambda x: x <> '') AS t FROM documents),
s AS (SELECT doc_id, list_sort(list_distinct(CASE WHEN len(t) = 0 THEN [] WHEN len(t) < 5 THEN [array_to_string(t, ' ')] ELSE list_transform(range(len(t) - 4), lambda i: array_to_string(t[i + 1:i + 5], ' ')) END)) AS g FROM t),
k AS (SELECT doc_id, md5(array_to_string(g, '|')) AS k, g FROM s),
nodes AS (SELECT k, min(doc_id) AS id, count(*) AS copies, any_value(g) AS g FROM k GROUP BY k),
e AS (SELECT id, len(g) AS n, unnest(g) AS g FROM nodes),
links AS (SELECT a.id AS u, b.id AS v FROM e a JOIN e b ON a.g = b.g AND a.id <> b.id AND b.n BETWEEN 0.8 * a.n AND a.n / 0.8 GROUP BY a.id, b.id, a.n, b.n HAVING count(*) >= 0.8 * (a.n + b.n - count(*))),
reach(u, v) AS (SELECT id, id FROM nodes UNION SELECT r.u, l.v FROM reach r JOIN links l ON l.u = r.v),
classes AS (SELECT u, min(v) AS class_id FROM reach GROUP BY u),
weights AS (SELECT l.u, sum(m.copies) AS weight FROM links l JOIN nodes m ON m.id = l.v GROUP BY l.u)
SELECT k.doc_id, c.class_id, CAST(coalesce(w.weight, 0) + m.copies - 1 AS BIGINT) AS n_links, m.copies AS n_copies
FROM k JOIN nodes m ON m.k = k.k JOIN classes c ON c.u = m.id LEFT JOIN weights w ON w.u = m.id"""

# The folds of the contract; crc32 bit by bit.
_BITS = "flatten(list_transform(string_split({0}, ''), lambda ch: list_transform(range(8), lambda i: (ord(ch) >> i) & 1)))"
_CRC = "xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), CAST(" + _BITS + " AS BIGINT[])), lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1))), 4294967295)"

# Every batch of a user is folded anew over all events so far.
_SESSIONS = f"""
WITH f AS (SELECT conv_id, turn, {_CRC.format("CAST(conv_id AS VARCHAR)")} AS c, {_CRC.format("conv_id || ':' || turn")} AS h FROM conversations WHERE turn IS NOT NULL AND conv_id IS NOT NULL),
t AS (SELECT *, (c // 2) % 7200 + 300 * turn + h % 600 AS s, h // 600 AS g FROM f),
e AS (SELECT 2 * CAST(floor(conv_id / 8.0) AS BIGINT) + c % 2 AS u, s, CAST(floor(s / 1800.0) AS BIGINT) + CASE WHEN g % 3 = 0 THEN g % 4 ELSE 0 END AS b, h FROM t),
x AS (SELECT k.u, k.b AS batch, e.s, e.b, e.h, CASE WHEN e.s - lag(e.s) OVER (PARTITION BY k.u, k.b ORDER BY e.s) <= 240 THEN 0 ELSE 1 END AS cut FROM (SELECT DISTINCT u, b FROM e) k JOIN e ON e.u = k.u AND e.b <= k.b),
y AS (SELECT *, sum(cut) OVER (PARTITION BY u, batch ORDER BY s ROWS UNBOUNDED PRECEDING) AS part FROM x),
v AS (SELECT u, batch, min(s) AS start_s, max(s) AS end_s, count(*) AS n_events, count(*) FILTER (b = batch) AS n_new, sum(h) AS h_sum FROM y GROUP BY u, batch, part HAVING count(*) FILTER (b = batch) > 0),
r AS (SELECT v.u, v.batch, v.start_s, min(w.batch) AS rb, arg_min(w.start_s, w.batch) AS rs FROM v JOIN v w ON w.u = v.u AND w.batch > v.batch AND w.start_s <= v.start_s AND w.end_s >= v.end_s GROUP BY ALL),
n AS (SELECT u, rb, rs, count(*) AS n FROM r GROUP BY ALL)
SELECT v.u AS "user", v.batch, v.start_s, v.end_s, v.n_events, v.n_new, coalesce(n.n, 0) AS n_retracted, CAST(v.h_sum AS BIGINT) AS h_sum, r.rb AS retracted_batch, r.rs AS retracted_start_s
FROM v LEFT JOIN r ON r.u = v.u AND r.batch = v.batch AND r.start_s = v.start_s LEFT JOIN n ON n.u = v.u AND n.rb = v.batch AND n.rs = v.start_s"""


def _codes() -> str:
    """All entries compared with all parts, by squares and inner products of whole numbers."""
    steps = [
        "v AS (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r, vec_id, label, list_transform(embedding, lambda c: floor(1024.0 * c)) AS c FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0)",
        "x AS MATERIALIZED (SELECT r, p, c[p * (len(c) // 4) + 1:(p + 1) * (len(c) // 4)] AS c FROM (SELECT *, unnest(range(4)) AS p FROM v))",
        "k0 AS MATERIALIZED (SELECT p, r - 1 AS e, c FROM x WHERE r <= 256)",
    ]
    for i in range(5):
        d = "list_dot_product(x.c, x.c) - 2 * list_dot_product(x.c, k.c) + list_dot_product(k.c, k.c)"
        steps.append(f"a{i} AS MATERIALIZED (SELECT r, x.p, min({d}) AS d, arg_min(e, ({d}) * 256 + e) AS e FROM x JOIN k{i} k ON k.p = x.p GROUP BY r, x.p)")
        if i < 4:
            steps.append(f"m{i} AS (SELECT p, e, list(c ORDER BY j) AS c FROM (SELECT p, e, j, floor(sum(c) / count(*)) AS c FROM (SELECT a.p, a.e, unnest(x.c) AS c, unnest(range(len(x.c))) AS j FROM a{i} a JOIN x USING (r, p)) GROUP BY p, e, j) GROUP BY p, e)")
            steps.append(f"k{i + 1} AS MATERIALIZED (SELECT k.p, k.e, coalesce(m.c, k.c) AS c FROM k{i} k LEFT JOIN m{i} m USING (p, e))")
    steps.append("s AS (SELECT sha256(string_agg(array_to_string(list_transform(c, lambda y: CAST(y AS BIGINT)), ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM k4)")
    steps.append("c AS (SELECT r, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM a4 GROUP BY r)")
    return "WITH " + ",\n".join(steps) + "\nSELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256, label FROM v JOIN c USING (r) CROSS JOIN s"


ORACLE_SQL = {"op2_template_decontamination": _DECONTAMINATION, "op7_warc_index": _WARC, "op9_chosen_path_join": _JOIN, "op12_annular_codes": _codes(), "op13_late_sessions": _SESSIONS}
