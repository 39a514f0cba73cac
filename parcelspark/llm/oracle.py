"""DuckDB statements for the queries that SQL can express."""

from __future__ import annotations

from parcelspark.llm.common import LOWER, UPPER

_LOW = f"translate(%s, '{UPPER}', '{LOWER}')"
_TRIM = "trim(%s, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
_WORDS = "regexp_extract_all(" + _LOW % "coalesce(text, '')" + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP7 = f"""
WITH doc AS (SELECT doc_id, {_WORDS} AS w FROM documents),
item AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, w[s : s + 12] AS g
  FROM item, LATERAL (SELECT unnest(generate_series(1, greatest(1, len(w) - 12))) AS s) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM win),
grams AS (
  SELECT doc_id, n, s, w[s : s + n - 1] AS g
  FROM doc, sizes, LATERAL (SELECT unnest(generate_series(1, len(w) - n + 1)) AS s)),
hit AS (SELECT DISTINCT doc_id, item_id, s, n FROM grams JOIN win USING (n, g)),
spots AS (SELECT DISTINCT doc_id, unnest(generate_series(s, s + n - 1)) AS p FROM hit),
hits AS (SELECT doc_id, count(*) AS n_hit FROM spots GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hit) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP9 = f"""
WITH parts AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
line AS (
  SELECT doc_id, l[i] AS line, i, {_LOW % (_TRIM % 'l[i]')} AS k
  FROM parts, LATERAL (SELECT unnest(generate_series(1, len(l))) AS i)),
often AS (
  SELECT k, max(doc_id) AS keeper FROM line WHERE length(k) >= 40
  GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
marked AS (SELECT line.*, keeper IS NOT NULL AND keeper <> doc_id AS gone FROM line LEFT JOIN often USING (k))
SELECT doc_id, count(*) AS n_lines, CAST(sum(CAST(gone AS INT)) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

# The checksum of a number's digits: per byte one step that takes it in, then eight that shift.
_CRC = """(
  xor(4294967295::BIGINT, list_reduce(
    list_prepend(4294967295::BIGINT, flatten(list_transform(
      regexp_extract_all(CAST(%s AS VARCHAR), '.'), lambda x: [ascii(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda c, s: CASE WHEN s >= 0 THEN xor(c, s) WHEN c %% 2 = 1 THEN xor(c // 2, 3988292384::BIGINT) ELSE c // 2 END)))"""

OP11 = f"""
WITH conv AS (
  SELECT conv_id, list(md5(concat(length(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) ORDER BY turn NULLS FIRST) AS k,
    list(length(coalesce(text, '')) ORDER BY turn NULLS FIRST) AS n
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
headed AS (SELECT *, CAST({_CRC % 'conv_id'} % 6 AS BIGINT) AS h FROM conv),
built AS (
  SELECT c.conv_id, list_concat(coalesce(b.k, [])[1 : h], c.k[h + 1 :]) AS k, list_concat(coalesce(b.n, [])[1 : h], c.n[h + 1 :]) AS n
  FROM headed c LEFT JOIN conv b ON b.conv_id = c.conv_id - c.conv_id % 100),
pre AS (
  SELECT conv_id, d, k[1 : d] AS p, coalesce(n[d], 0) AS chars, d = len(k) AS ends
  FROM built, LATERAL (SELECT unnest(generate_series(0, len(k))) AS d)),
node AS (
  SELECT d, p, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars,
    coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '') AS ids
  FROM pre GROUP BY d, p),
child AS (SELECT d - 1 AS d, p[1 : d - 1] AS p, count(*) AS n_children FROM node WHERE d > 0 GROUP BY 1, 2),
whole AS (SELECT node.*, coalesce(n_children, 0) AS n_children FROM node LEFT JOIN child USING (d, p)),
sub AS (
  SELECT a AS d, p[1 : a] AS p, CAST(sum(CAST(n_children = 0 AS INT)) AS BIGINT) AS n_leaves,
    CAST(sum((n_convs - 1) * chars) AS BIGINT) AS saved_tokens
  FROM whole, LATERAL (SELECT unnest(generate_series(0, d)) AS a) GROUP BY 1, 2)
SELECT w.conv_id, w.d AS depth, up.conv_id AS parent_conv_id, w.n_convs, w.n_children, n_leaves, saved_tokens, sha256(w.ids) AS ends_sha256
FROM whole w JOIN sub ON sub.d = w.d AND sub.p = w.p LEFT JOIN node up ON up.d = w.d - 1 AND up.p = w.p[1 : w.d - 1]
"""

OP12 = """
WITH doc AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
win AS (
  SELECT doc_id, s, w[s : s + 12] AS g
  FROM doc, LATERAL (SELECT unnest(generate_series(1, len(w) - 12)) AS s) WHERE len(w) >= 13),
first AS (SELECT g, min(doc_id) AS first_doc FROM win GROUP BY g HAVING count(*) > 1),
spots AS (
  SELECT DISTINCT doc_id, unnest(generate_series(s, s + 12)) AS p
  FROM win JOIN first USING (g) WHERE doc_id > first_doc),
gone AS (SELECT doc_id, list(p) AS ps FROM spots GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(ps), 0) AS BIGINT) AS n_removed,
  sha256(coalesce(array_to_string(
    CASE WHEN ps IS NULL THEN w ELSE list_filter(w, lambda x, i: NOT list_contains(ps, i)) END, ' '), '')) AS kept_sha256
FROM doc LEFT JOIN gone USING (doc_id)
"""


def oracle_sql() -> dict[str, str]:
    return {"op7_decontaminate": OP7, "op9_lines": OP9, "op11_trie": OP11, "op12_substrings": OP12}
