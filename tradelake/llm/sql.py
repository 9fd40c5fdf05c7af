"""DuckDB SQL for the operators that SQL can express."""

URL_RULES = """
WITH parsed AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path
  FROM pages),
rules(verdict, rule_host, rule_path) AS (VALUES
  ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
judged AS (
  SELECT host, path, rule_host || rule_path AS rule, verdict,
         row_number() OVER (PARTITION BY host, path ORDER BY length(rule_host || rule_path) DESC, length(rule_host) DESC, verdict DESC) AS k
  FROM (SELECT DISTINCT host, path FROM parsed) p JOIN rules r
    ON (p.host = r.rule_host OR ends_with(p.host, '.' || r.rule_host)) AND starts_with(p.path, r.rule_path))
SELECT page_id, p.host, p.path, j.rule, coalesce(j.verdict, 'allow') AS verdict
FROM parsed p LEFT JOIN (SELECT * FROM judged WHERE k = 1) j ON p.host = j.host AND p.path = j.path
"""


NEAR_DUP = """
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')] ELSE list_distinct(list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' '))) END AS sh
  FROM w),
items AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS x FROM s),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM items a JOIN items b ON a.x = b.x AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(id, other) AS (SELECT a, b FROM edges UNION SELECT r.id, e.b FROM reach r JOIN edges e ON r.other = e.a),
lowest AS (SELECT id, least(id, min(other)) AS component_id FROM reach GROUP BY id)
SELECT s.doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, coalesce(component_id, s.doc_id) AS component_id, coalesce(component_id, s.doc_id) = s.doc_id AS kept
FROM s LEFT JOIN lowest l ON s.doc_id = l.id
"""

#: On the tables' pages everything but the head, scripts, menus, adverts, footers and comments is main text.
HTML_TEXT = """
WITH h AS (SELECT page_id, url, regexp_replace(coalesce(html, ''), '<!--.*?-->|<(head|script|style|nav|footer)[ >].*?(</(head|script|style|nav|footer)>|$)|<div class="ad">.*?</div>', ' ', 'gs') AS x FROM pages),
a AS (SELECT page_id, url, regexp_replace(x, '</?b>', '', 'g') AS x FROM h),
b AS (SELECT page_id, url, regexp_replace(x, '<[^>]*>', ' ', 'g') AS x FROM a),
c AS (SELECT page_id, url, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(x, '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&quot;?', '"', 'g'), '&#x27;?', chr(39), 'g'), '&amp;?', '&', 'g') AS x FROM b),
d AS (SELECT page_id, url, trim(regexp_replace(x, '\\s+', ' ', 'g')) AS text FROM c)
SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars FROM d
"""

LINE_DEDUP = """
WITH lines AS (
  SELECT doc_id, unnest(l) AS line, unnest(range(1, len(l) + 1)) AS i
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
keyed AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
firsts AS (SELECT k, min(doc_id) AS first FROM keyed WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) >= 2),
judged AS (SELECT y.*, first IS NOT NULL AND first <> doc_id AS gone FROM keyed y LEFT JOIN firsts f ON y.k = f.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_near_dup": NEAR_DUP, "op6_html_text": HTML_TEXT, "op8_url_rules": URL_RULES, "op13_line_dedup": LINE_DEDUP}
