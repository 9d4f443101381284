"""SQL on DuckDB for the operators that SQL can express, each by the plain definition of its result."""

from __future__ import annotations

from . import lines, secrets, spotsigs

WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

#: All pairs that share a shingle, and a recursive walk along the links.
NEAR_DUPLICATES = f"""
WITH RECURSIVE docs AS (SELECT doc_id, {WORDS.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS ws FROM documents),
listed AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 3 THEN list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i:i + 2], ' ')) WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS s FROM docs),
sizes AS (SELECT doc_id, count(*) AS n FROM listed GROUP BY doc_id),
common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM listed x JOIN listed y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * c >= 85 * (p.n + q.n - c)),
edge AS (SELECT a AS u, b AS v FROM link UNION ALL SELECT b, a FROM link),
reach(u, v) AS (SELECT DISTINCT u, u FROM edge UNION SELECT r.u, e.v FROM reach r JOIN edge e ON e.u = r.v),
least AS (SELECT u, min(v) AS v FROM reach GROUP BY u)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(v, d.doc_id) AS component_id, coalesce(v, d.doc_id) = d.doc_id AS kept
FROM docs d LEFT JOIN sizes USING (doc_id) LEFT JOIN least ON u = d.doc_id
"""

#: Every window of 35 words, counted.
REPEATED_WORDS = f"""
WITH docs AS (SELECT doc_id, {WORDS.format("coalesce(text, '')")} AS ws FROM documents),
win AS (SELECT doc_id, unnest(range(1, len(ws) - 33)) AS i, unnest(list_transform(range(1, len(ws) - 33), lambda i: md5(array_to_string(ws[i:i + 34], ' ')))) AS k FROM docs WHERE len(ws) >= 35),
again AS (SELECT doc_id, i FROM win WHERE k IN (SELECT k FROM win GROUP BY k HAVING count(*) > 1)),
word AS (SELECT doc_id, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS i FROM docs),
covered AS (SELECT doc_id, w, i, bool_or(a.i IS NOT NULL) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone FROM word LEFT JOIN again a USING (doc_id, i)),
kept AS (SELECT doc_id, count(*) AS n, sum(gone::INT) AS r, coalesce(string_agg(w, ' ' ORDER BY i) FILTER (NOT gone), '') AS t FROM covered GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_words, coalesce(r, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM docs d LEFT JOIN kept USING (doc_id)
"""

#: Every string of 50 bytes, as hexadecimal digits, with the least document that has it.
REPEATED_BYTES = """
WITH docs AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
win AS (SELECT doc_id, unnest(range(0, n - 49)) AS i, unnest(list_transform(range(0, n - 49), lambda i: md5(substr(h, 2 * i + 1, 100)))) AS k FROM docs WHERE n >= 50),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY k) AS first FROM win) WHERE first < doc_id),
byte AS (SELECT doc_id, unnest(range(0, n)) AS i, unnest(list_transform(range(0, n), lambda i: substr(h, 2 * i + 1, 2))) AS b FROM docs),
covered AS (SELECT doc_id, b, i, bool_or(a.i IS NOT NULL) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone FROM byte LEFT JOIN again a USING (doc_id, i)),
edged AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), false) AS opens FROM covered),
kept AS (SELECT doc_id, sum(gone::INT) AS r, sum(opens::INT) AS s, coalesce(string_agg(b, '' ORDER BY i) FILTER (NOT gone), '') AS t FROM edged GROUP BY doc_id)
SELECT d.doc_id, n::BIGINT AS n_bytes, coalesce(r, 0)::BIGINT AS n_removed, coalesce(s, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(t, ''))) AS kept_sha256 FROM docs d LEFT JOIN kept USING (doc_id)
"""

_SPLIT = "string_split(trim(regexp_replace(lower(t), '[^\\p{L}\\p{N}]+', ' ', 'g')), ' ')"

#: Chains by the rank of content words among the words; a text and its edit are two texts of a document.
SPOTSIGS = f"""
WITH base AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(lead(coalesce(text, '')) OVER w, first_value(coalesce(text, '')) OVER w) AS next, coalesce(lead(doc_id) OVER w, first_value(doc_id) OVER w) AS next_id FROM documents WINDOW w AS (ORDER BY doc_id DESC)),
cut AS (SELECT *, length(t) AS n, substr(t, 1, length(t) - length(t) // 3) || substr(next, 1, length(t) // 3) AS edited FROM base),
texts AS (SELECT doc_id, 0 AS e, t FROM cut UNION ALL SELECT doc_id, 1, edited FROM cut),
listed AS (SELECT doc_id, e, {_SPLIT} AS ws FROM texts WHERE t <> ''),
word AS (SELECT doc_id, e, unnest(ws) AS w, unnest(range(len(ws))) AS i FROM listed),
marked AS (SELECT *, w IN ({', '.join(f"'{a}'" for a in spotsigs.ANCHORS)}) AS anchor FROM word WHERE w <> ''),
ranked AS (SELECT *, sum((NOT anchor)::INT) OVER (PARTITION BY doc_id, e ORDER BY i) AS r FROM marked),
chain AS (SELECT a.doc_id, a.e, a.i, string_agg(c.w, ' ' ORDER BY c.i) AS c FROM ranked a JOIN ranked c ON c.doc_id = a.doc_id AND c.e = a.e AND NOT c.anchor AND c.r BETWEEN a.r + 1 AND a.r + {spotsigs.CHAIN} WHERE a.anchor GROUP BY ALL),
signed AS (SELECT DISTINCT doc_id, e, substr(md5(c), 1, 8) AS s FROM chain),
every AS (SELECT * FROM signed UNION ALL SELECT doc_id, e, substr(md5(t), 1, 8) FROM texts WHERE t <> '' AND (doc_id, e) NOT IN (SELECT (doc_id, e) FROM signed)),
prints AS (SELECT doc_id, e, count(*) AS n, string_agg(s, '' ORDER BY s) AS f FROM every GROUP BY ALL),
pair AS (SELECT doc_id, 'edited' AS k, doc_id AS other, 1 AS oe FROM cut UNION ALL SELECT doc_id, 'next', next_id, 0 FROM cut),
both AS (SELECT p.doc_id, p.k, count(*) AS c FROM pair p JOIN every x ON x.doc_id = p.doc_id AND x.e = 0 JOIN every y ON y.doc_id = p.other AND y.e = p.oe AND y.s = x.s GROUP BY ALL),
near AS (SELECT p.doc_id, p.k, CASE WHEN x.n IS NULL AND y.n IS NULL THEN 1.0 WHEN x.n IS NULL OR y.n IS NULL THEN 0.0 ELSE coalesce(b.c, 0) / (x.n + y.n - coalesce(b.c, 0)) END AS j
  FROM pair p LEFT JOIN both b USING (doc_id, k) LEFT JOIN prints x ON x.doc_id = p.doc_id AND x.e = 0 LEFT JOIN prints y ON y.doc_id = p.other AND y.e = p.oe)
SELECT c.doc_id, c.n::BIGINT AS n_chars, sha256(c.edited) AS edited_sha256, coalesce(x.f, '') AS fingerprint, coalesce(y.f, '') AS edited_fingerprint, a.j::DOUBLE AS near_edited, b.j::DOUBLE AS near_next
FROM cut c LEFT JOIN prints x ON x.doc_id = c.doc_id AND x.e = 0 LEFT JOIN prints y ON y.doc_id = c.doc_id AND y.e = 1 JOIN near a ON a.doc_id = c.doc_id AND a.k = 'edited' JOIN near b ON b.doc_id = c.doc_id AND b.k = 'next'
""".replace("both AS", "shared AS").replace("LEFT JOIN both b", "LEFT JOIN shared b")


def _all(kind: int, pattern: str, group: int) -> str:
    whole = f"(?s)(.*?)(?:({pattern})|\\z)".replace("'", "''")
    return f"SELECT doc_id, {kind} AS kind, regexp_extract_all(t, '{whole}', 1) AS pre, regexp_extract_all(t, '{whole}', 2) AS mat, regexp_extract_all(t, '{whole}', {group}) AS val FROM docs"


_RUNS = {kind: f"{characters}{{{secrets.WINDOW},}}" for kind, (characters, _) in secrets.CLASSES.items()}
_KINDS = ", ".join(f"'{k}'" for k in secrets.KINDS)

#: Offsets are sums of lengths; every window's entropy is counted anew.
SECRETS = f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
lists AS ({_all(1, secrets.ASSIGN, 3)} UNION ALL {_all(2, secrets.ACCESS, 2)} UNION ALL {_all(3, secrets.HEX, 2)} UNION ALL {_all(4, _RUNS["entropy_hex"], 2)} UNION ALL {_all(5, _RUNS["entropy_mixed"], 2)}),
piece AS (SELECT doc_id, kind, unnest(pre) AS pre, unnest(mat) AS mat, unnest(val) AS val, unnest(range(len(pre))) AS k FROM lists),
placed AS (SELECT *, sum(length(pre) + length(mat)) OVER (PARTITION BY doc_id, kind ORDER BY k) - length(mat) AS a FROM piece),
base AS (SELECT doc_id, kind, a, a + length(mat) AS b FROM placed WHERE mat <> '' AND kind <= 3 AND length(val) >= CASE kind WHEN 1 THEN {secrets.LEAST} ELSE 0 END),
cand AS (SELECT doc_id, kind, a, mat AS v FROM placed WHERE mat <> '' AND kind > 3 AND regexp_matches(mat, '[0-9]') AND regexp_matches(mat, '[A-Za-z]') AND NOT regexp_matches(mat, '{secrets.ALLOWED}')),
win AS (SELECT doc_id, kind, a, unnest(range(0, length(v) - {secrets.WINDOW - 1})) AS i, v FROM cand),
chars AS (SELECT doc_id, kind, a, i, unnest(string_split(substr(v, i + 1, {secrets.WINDOW}), '')) AS c FROM win),
counted AS (SELECT doc_id, kind, a, i, c, count(*) AS n FROM chars GROUP BY ALL),
entropy AS (SELECT doc_id, kind, a, i, -sum(n / {secrets.WINDOW} * log2(n / {secrets.WINDOW})) AS h FROM counted GROUP BY ALL),
high AS (SELECT *, coalesce(i - lag(i) OVER (PARTITION BY doc_id, kind, a ORDER BY i) > {secrets.WINDOW}, true)::INT AS opens FROM entropy WHERE h >= CASE kind WHEN 4 THEN {secrets.CLASSES["entropy_hex"][1]} ELSE {secrets.CLASSES["entropy_mixed"][1]} END - 1e-9),
island AS (SELECT *, sum(opens) OVER (PARTITION BY doc_id, kind, a ORDER BY i) AS g FROM high),
added AS (SELECT doc_id, kind, a + min(i) AS a, a + max(i) + {secrets.WINDOW} AS b FROM island GROUP BY doc_id, kind, a, g),
free AS (SELECT * FROM added x WHERE NOT EXISTS (SELECT 1 FROM base y WHERE y.doc_id = x.doc_id AND y.a < x.b AND x.a < y.b)),
shown AS (SELECT doc_id, kind, a, [{_KINDS}][kind] || ':' || a::BIGINT || ':' || b::BIGINT AS s FROM (SELECT * FROM base UNION ALL SELECT * FROM free)),
joined AS (SELECT doc_id, count(*) FILTER (kind = 1) AS n_assign, count(*) FILTER (kind = 2) AS n_access, count(*) FILTER (kind = 3) AS n_hex, string_agg(s, ',' ORDER BY a, kind) FILTER (kind <= 3) AS base, string_agg(s, ',' ORDER BY a, kind) AS spans FROM shown GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM docs d LEFT JOIN joined USING (doc_id)
"""

ORACLES = {"op1_line_dedup": lines.SQL, "op2_minhash": NEAR_DUPLICATES, "op3_secrets": SECRETS, "op4_recompression": REPEATED_WORDS, "op7_spotsigs": SPOTSIGS, "op10_suffix_dedup": REPEATED_BYTES}
