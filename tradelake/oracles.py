"""DuckDB SQL for the catalogue's queries, over views of the driver's tables."""

from __future__ import annotations

M = ["export_usd", "export_weight_kg", "import_usd", "import_weight_kg", "trade_balance_usd"]


def two(x: str) -> str:
    return f"lpad(CAST({x} AS VARCHAR), 2, '0')"


FACTS = f"""facts AS (
  SELECT strftime(l_shipdate, '%Y%m') AS month, n_name AS country_code,
         {two('l_partkey % 97')} || {two('l_partkey % 7')} || {two('l_partkey % 5')} || {two('l_linenumber')} || {two('CAST(l_quantity AS BIGINT)')} AS hs10,
         CASE WHEN l_linestatus = 'O' THEN CAST(round(l_extendedprice * 100) AS BIGINT) ELSE 0 END AS export_usd,
         CASE WHEN l_linestatus = 'O' THEN CAST(l_quantity AS BIGINT) ELSE 0 END AS export_weight_kg,
         CASE WHEN l_linestatus = 'O' THEN 0 ELSE CAST(round(l_extendedprice * 100) AS BIGINT) END AS import_usd,
         CASE WHEN l_linestatus = 'O' THEN 0 ELSE CAST(l_quantity AS BIGINT) END AS import_weight_kg,
         CASE WHEN l_linestatus = 'O' THEN 1 ELSE -1 END * CAST(round(l_extendedprice * 100) AS BIGINT) AS trade_balance_usd,
         l_orderkey, l_linenumber, l_partkey
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey)"""
RAW_CODE = "CASE WHEN l_orderkey % 97 = 0 THEN left(hs10, 6) WHEN l_orderkey % 89 = 0 THEN left(hs10, 9) WHEN l_orderkey % 83 = 0 THEN left(hs10, 9) || 'X' ELSE hs10 END"
SUMS = ", ".join(f"CAST(sum({m}) AS BIGINT) AS {m}" for m in M)
SPLIT = f"coded AS (SELECT *, {RAW_CODE} AS hs_code_raw FROM facts), full_facts AS (SELECT * FROM coded WHERE hs_code_raw = hs10), short_rows AS (SELECT * FROM coded WHERE hs_code_raw <> hs10 AND month IN (SELECT month FROM full_facts))"
SOURCES = """sources AS (
  SELECT n_name AS country, strftime(o_orderdate, '%Y%m') AS window_start, strftime(o_orderdate + to_months(CAST(o_orderkey % 12 AS INTEGER)), '%Y%m') AS window_end,
         strftime(o_orderdate, '%Y%m%d') AS finished_at, o_orderkey AS path, year(o_orderdate) * 12 + month(o_orderdate) - 1 AS i0, o_orderkey % 12 AS span
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
months AS (SELECT *, lpad(CAST(i // 12 AS VARCHAR), 4, '0') || lpad(CAST(i % 12 + 1 AS VARCHAR), 2, '0') AS month FROM (SELECT *, unnest(range(i0, i0 + span + 1)) AS i FROM sources)),
expanded AS (SELECT * FROM months)"""
BEST = "row_number() OVER (PARTITION BY country, month ORDER BY finished_at DESC, span, path DESC)"
SELECTED = f"selected AS (SELECT country, month, path, candidates FROM (SELECT *, {BEST} AS k, count(*) OVER (PARTITION BY country, month) AS candidates FROM expanded) WHERE k = 1)"
RAW = f"""raw AS (
  SELECT 'src' || CAST(l_orderkey % 500 AS VARCHAR) AS source, l_orderkey * 10 + l_linenumber AS ordinal, month, country_code AS requested_country,
         CASE WHEN l_orderkey % 101 = 0 THEN 'ZZ' WHEN l_orderkey % 7 = 0 THEN '' ELSE country_code END AS country_code_raw, {RAW_CODE} AS hs_code_raw,
         'item ' || CAST(l_partkey AS VARCHAR) AS name_ko, 'request_' || CAST(l_orderkey % 500 AS VARCHAR) || '.json' AS source_manifest, '2026-01-' || lpad(CAST(l_orderkey % 28 + 1 AS VARCHAR), 2, '0') AS source_finished_at,
         CASE WHEN l_orderkey % 103 = 0 THEN NULL WHEN l_orderkey % 107 = 0 THEN -(export_usd + 1) ELSE export_usd END AS export_usd,
         CASE WHEN l_orderkey % 113 = 0 THEN -(export_weight_kg + 1) ELSE export_weight_kg END AS export_weight_kg, import_usd, import_weight_kg,
         CASE WHEN l_orderkey % 109 = 0 THEN trade_balance_usd + 1 ELSE trade_balance_usd END AS trade_balance_usd
  FROM facts),
tested AS (SELECT *, country_code_raw <> '' AND country_code_raw <> requested_country AS mismatch, regexp_full_match(hs_code_raw, '[0-9]{{10}}') AS full_code FROM raw),
numbered AS (SELECT *, row_number() OVER (PARTITION BY source, month, hs_code_raw, NOT mismatch AND full_code ORDER BY ordinal) AS nth FROM tested),
reasoned AS (SELECT *, CASE WHEN mismatch THEN 'country_mismatch' WHEN NOT full_code THEN 'non_hs10_code' WHEN nth > 1 THEN 'duplicate_key' WHEN export_usd IS NULL THEN 'missing/invalid numeric field expDlr'
   WHEN export_usd < 0 OR import_usd < 0 THEN 'negative amount' WHEN export_usd - import_usd <> trade_balance_usd THEN 'trade balance mismatch' END AS reason FROM numbered),
bucketed AS (SELECT *, CASE WHEN reason IS NULL THEN 'canonical' WHEN reason = 'non_hs10_code' THEN 'quarantine' ELSE 'fatal' END AS bucket FROM reasoned),
classified AS (SELECT *, CASE WHEN bucket = 'canonical' AND (export_weight_kg < 0 OR import_weight_kg < 0) THEN 'negative_weight' END AS warning FROM bucketed)"""
EDITIONS = "codes AS (SELECT hs10, 'part ' || CAST(min(l_partkey) AS VARCHAR) AS name_ko FROM facts WHERE l_partkey % 20 <> 0 GROUP BY hs10), editions AS (SELECT *, 'HSK-' || CAST(reference_year AS VARCHAR) AS hs_revision FROM codes, (SELECT unnest(range(1994, 2003)) AS reference_year))"
LOOKED = "looked AS (SELECT f.*, e.hs_revision FROM facts f LEFT JOIN editions e ON left(f.month, 4) = CAST(e.reference_year AS VARCHAR) AND f.hs10 = e.hs10)"
NAMES = "partners AS (SELECT n_name AS country_code, n_name || ' / ' || r_name AS partner_name FROM nation JOIN region ON n_regionkey = r_regionkey)"
EVENTS = """e0 AS (SELECT event_id, event_id // 6 AS n, CAST(event_id % 6 AS INTEGER) AS slot FROM events),
e1 AS (SELECT *, n % 4 = 1 AS split, n % 12 = 1 AS again, 'C' || CAST(n AS VARCHAR) AS country, (slot = 0 AND n % 4 IN (1, 3)) OR (slot = 1 AND n % 12 = 1) AS raised FROM e0),
e2 AS (SELECT *, CASE WHEN slot = 0 THEN 1 WHEN slot = 5 THEN CASE WHEN again THEN 1 ELSE 12 END ELSE slot * 3 - 2 END AS m0, CASE WHEN slot = 0 THEN 12 WHEN slot = 5 THEN CASE WHEN again THEN 1 ELSE 12 END ELSE slot * 3 END AS m1,
         CASE WHEN slot = 0 OR (slot BETWEEN 1 AND 4 AND split) OR (slot = 5 AND again) THEN '2024' ELSE '2023' END AS y,
         CASE WHEN slot = 0 AND n % 4 = 1 THEN CASE WHEN n % 8 = 1 THEN NULL ELSE 503 END WHEN slot = 0 AND n % 4 = 3 THEN CASE WHEN n % 8 = 3 THEN 200 ELSE 410 END WHEN slot = 1 AND again THEN 504 WHEN event_id % 23 = 0 THEN 403 WHEN event_id % 37 = 0 THEN 429 ELSE 200 END AS http,
         CASE WHEN event_id % 17 = 0 THEN '22' WHEN event_id % 19 = 0 THEN '23' WHEN event_id % 41 = 0 THEN '30' WHEN event_id % 31 = 0 OR (slot = 0 AND n % 4 = 2) THEN '99' ELSE '00' END AS code FROM e1),
events1 AS (SELECT event_id, country, y || lpad(CAST(m0 AS VARCHAR), 2, '0') AS window_start, y || lpad(CAST(m1 AS VARCHAR), 2, '0') AS window_end, m0, m1, y, http, code, m1 - m0 + 1 AS months,
         CASE WHEN slot BETWEEN 1 AND 4 AND split THEN country || ':202401-202412' WHEN slot = 5 AND again THEN country || ':202401-202403' END AS parent_request,
         CASE WHEN raised AND http = 410 THEN 'http_error' WHEN raised THEN 'transport_error' WHEN http = 200 AND code = '00' AND event_id % 29 <> 0 THEN 'success' WHEN code = '22' OR (event_id % 62 = 0 AND event_id % 43 <> 0) THEN 'quota_exceeded'
              WHEN code = '23' OR event_id % 43 = 0 OR http = 429 THEN 'rate_limited' WHEN code = '30' OR http = 403 THEN 'auth_error' WHEN event_id % 29 = 0 THEN 'parse_error' ELSE 'api_error' END AS status,
         CASE WHEN event_id % 10 = 0 THEN 0 ELSE event_id % 1000 END AS f, CASE WHEN event_id % 7 = 0 THEN event_id % 3 ELSE 0 END AS short, CASE WHEN event_id % 11 = 0 THEN 1 ELSE 0 END AS dup, CASE WHEN event_id % 13 = 0 THEN 2 ELSE 0 END AS other, event_id % 5 AS bal,
         CASE WHEN event_id % 9 = 0 AND m1 > m0 THEN m1 - 1 ELSE m1 END AS m_last
  FROM e2),
leaves AS (SELECT *, status = 'success' AS good FROM events1 e WHERE NOT EXISTS (SELECT 1 FROM events1 p WHERE p.parent_request = e.country || ':' || e.window_start || '-' || e.window_end)),
roots AS (SELECT DISTINCT country FROM events1 UNION ALL SELECT 'XX'), inside AS (SELECT r.country AS root, l.* FROM roots r LEFT JOIN leaves l ON l.country = r.country AND l.y = '2024')"""
LABELS = "labels AS (SELECT CAST(p_partkey // 6 AS VARCHAR) AS hs10, p_partkey AS ordinal, substring(p_type, 1, 3 + CAST(p_partkey % 9 AS INTEGER)) AS ko, CASE WHEN p_partkey % 4 = 0 THEN '' ELSE substring(p_brand, 1, 5 + CAST(p_partkey % 4 AS INTEGER)) END AS en FROM part)"
FITS = " AND ".join(f"(trim(a.{c}) = '' OR trim(b.{c}) = '' OR starts_with(trim(a.{c}), trim(b.{c})) OR starts_with(trim(b.{c}), trim(a.{c})))" for c in ("ko", "en"))


def score(t: str) -> str:
    return f"(CAST({t}.ko <> '' AS INTEGER) + CAST({t}.en <> '' AS INTEGER), length({t}.ko) + length({t}.en), length({t}.ko))"


BETTER = f"({FITS}) AND {score('b')} > {score('a')}"
#: A left fold over the copies of a code: ``folded`` holds the label kept after each.
FOLD = f"""{LABELS}, nth AS (SELECT *, row_number() OVER (PARTITION BY hs10 ORDER BY ordinal) AS n FROM labels),
folded(hs10, n, ko, en, conflicts) AS (SELECT hs10, n, ko, en, 0 FROM nth WHERE n = 1
  UNION ALL SELECT a.hs10, b.n, CASE WHEN {BETTER} THEN b.ko ELSE a.ko END, CASE WHEN {BETTER} THEN b.en ELSE a.en END, a.conflicts + CASE WHEN {FITS} THEN 0 ELSE 1 END FROM folded a JOIN nth b ON a.hs10 = b.hs10 AND b.n = a.n + 1)"""
LABEL, ENGLISH = "CASE ({0}) WHEN 1 THEN 'new' WHEN 0 THEN 'old' END", "CASE WHEN k % 7 = 0 THEN 'same' WHEN ({0}) = 1 THEN 'en new' ELSE 'en old' END"
#: Conflicts of two years, the second reviewed after the first: a label is a bit of the part's key.
REVIEW = """e AS (SELECT p_partkey AS k, CAST(p_partkey AS VARCHAR) AS hs10, y, (p_partkey >> CAST(y - 2020 AS INTEGER)) & 1 AS b FROM part, (SELECT unnest([2020, 2021, 2022, 2023]) AS y) WHERE p_partkey % 10 <> 0 OR y <> 2023),
near AS (SELECT m.*, p.b AS previous, f.b AS following FROM e m LEFT JOIN e p ON p.hs10 = m.hs10 AND p.y = m.y - 1 LEFT JOIN e f ON f.hs10 = m.hs10 AND f.y = m.y + 1),
one AS (SELECT *, coalesce(previous = b AND following = 1 - b, false) AS used, coalesce(previous = 1 - b AND following = b, false) AS stays FROM near WHERE y = 2021),
carried AS (SELECT n.k, n.hs10, n.y, n.b, CASE WHEN o.used THEN 1 - o.b ELSE n.previous END AS previous, n.following FROM near n JOIN one o ON o.hs10 = n.hs10 WHERE n.y = 2022),
two AS (SELECT *, coalesce(previous = b AND following = 1 - b, false) AS used, coalesce(previous = 1 - b AND following = b, false) AS stays FROM carried),
judged AS (SELECT *, CASE WHEN stays THEN 'adjacent_year_validated_revision_transition_first_is_current' WHEN used THEN 'adjacent_year_validated_revision_transition_second_is_current' ELSE 'unresolved_conflicting_label_after_adjacent_year_review' END AS resolution FROM (SELECT * FROM one UNION ALL SELECT * FROM two))"""
#: Nations as partners, and those with an international code.
PARTNERS = """coded AS (SELECT n_nationkey AS k, n_name, CASE n_nationkey WHEN 0 THEN 'NA' WHEN 1 THEN 'TW' WHEN 2 THEN 'KR' ELSE chr(CAST(65 + n_nationkey % 26 AS INTEGER)) || chr(CAST(66 + n_nationkey // 26 AS INTEGER)) END AS c FROM nation),
partner AS (SELECT c AS country_code, '나라 ' || n_name AS country_name_ko, CASE WHEN k % 3 <> 1 THEN 'Nation ' || CAST(k AS VARCHAR) ELSE '' END AS country_name_en, CASE WHEN k % 3 <> 1 THEN lpad(CAST(k AS VARCHAR), 3, '0') ELSE '' END AS un_m49, CASE WHEN k % 3 <> 1 THEN c || 'X' ELSE '' END AS iso_alpha3,
  CASE WHEN k % 3 <> 1 THEN 'matched_current_un' ELSE 'unmatched_kcs_code' END AS un_match_status FROM coded),
universe AS (SELECT country_code, country_name_ko, un_match_status FROM partner WHERE (un_match_status = 'matched_current_un' OR country_code = 'TW') AND country_code NOT IN ('KR', 'NA'))"""
#: The tariff pages' codes: labels of each year, and the second one that 2022 has for some.
TARIFF = """p AS (SELECT p_partkey AS k, p_name, lpad(CAST(p_partkey % 20 + 1 AS VARCHAR), 2, '0') AS chapter FROM part),
t AS (SELECT *, chapter || lpad(CAST(k AS VARCHAR), 8, '0') AS hs10 FROM p, (SELECT unnest([2021, 2022, 2023]) AS y)),
named AS (SELECT *, CASE WHEN k % 15 <> 0 THEN '품' WHEN y = 2022 THEN CASE WHEN k % 2 = 0 THEN '신' ELSE '구' END WHEN (y = 2023) = (k % 2 = 0) THEN '신' ELSE '구' END AS mark FROM t)"""
SUMMED = """k0 AS (SELECT source, CAST(substring(source, 4) AS INTEGER) AS k, * EXCLUDE (source) FROM totals)"""


def json_list(x: str) -> str:
    return f"""'["' || array_to_string(list_sort(list_distinct(list({x}))), '","') || '"]'"""


def ym(i: str) -> str:
    return f"lpad(CAST(({i}) // 12 AS VARCHAR), 4, '0') || lpad(CAST(({i}) % 12 + 1 AS VARCHAR), 2, '0')"


PANEL = f"""leveled AS (SELECT *, left(hs10, 4) AS hs4 FROM facts),
ends AS (SELECT CAST(left(min(month), 4) AS INTEGER) * 12 + CAST(right(min(month), 2) AS INTEGER) - 1 AS i0, CAST(left(max(month), 4) AS INTEGER) * 12 + CAST(right(max(month), 2) AS INTEGER) - 1 AS i1 FROM facts),
chosen AS (SELECT hs4, CAST(sum(import_usd) AS BIGINT) AS import_usd FROM leveled, ends WHERE month BETWEEN {ym('i1 - 35')} AND {ym('i1 - 12')} GROUP BY hs4 ORDER BY 2 DESC, hs4 LIMIT 100),
grid AS (SELECT hs4, {ym('i')} AS month FROM chosen, (SELECT unnest(range(CAST(greatest(i0, i1 - 102) AS BIGINT), CAST(i1 + 1 AS BIGINT))) AS i FROM ends)),
cut AS (SELECT {ym('i1 - 12')} AS train_end, {ym('i1 + 1')} AS following FROM ends),
sums AS (SELECT month, hs4, CAST(sum(import_usd) AS BIGINT) AS v FROM leveled GROUP BY ALL),
panel AS (SELECT g.hs4, g.month, coalesce(v, 0) AS import_usd FROM grid g LEFT JOIN sums s ON s.hs4 = g.hs4 AND s.month = g.month)"""
LAGGED = "lagged AS (SELECT *, " + ", ".join(f"lag(import_usd, {n}) OVER (PARTITION BY hs4 ORDER BY month) AS lag_{n}" for n in (1, 2, 3, 6, 12)) + " FROM panel)"


def rolled(n: int) -> str:
    over = f"OVER (PARTITION BY hs4 ORDER BY month ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
    return f"CASE WHEN count(import_usd) {over} = {n} THEN round(avg(import_usd) {over}, 6) END AS mean_{n}"


ROLLED = ", ".join(map(rolled, (3, 6, 12)))
SHARED = """level6 AS (SELECT *, left(hs10, {n}) AS code FROM facts WHERE import_usd > 0), s1 AS (SELECT code, country_code, CAST(sum(import_usd) AS BIGINT) AS v FROM level6 GROUP BY ALL),
s2 AS (SELECT *, CAST(sum(v) OVER (PARTITION BY code) AS BIGINT) AS total FROM s1), shares AS (SELECT *, v / total AS share, row_number() OVER (PARTITION BY code ORDER BY v / total DESC, country_code) AS rank FROM s2)"""
METRICS = """metrics AS (SELECT code AS hs6, max(total) AS total, count(*) AS partners, round(sum(share * share), 9) AS hhi, round(max(share), 9) AS top1_share, min_by(country_code, rank) AS top1_partner,
  round(sum(CASE WHEN rank <= 3 THEN share ELSE 0 END), 9) AS top3_share FROM shares GROUP BY code), exposed AS (SELECT *, round(total * hhi, 3) AS exposure FROM metrics)"""


def rollup(level: int) -> str:
    coarser = "".join(f", left(hs{level}, {n}) AS hs{n}" for n in (6, 4, 2) if n < level)
    return f"WITH {FACTS}, r AS (SELECT month, country_code, left(hs10, {level}) AS hs{level}, {SUMS}, count(*) AS source_row_count FROM facts GROUP BY ALL) SELECT *{coarser} FROM r"


def residual_level(n: int) -> str:
    own = f"SELECT month, country_code, left(hs10, {n}) AS code, {', '.join(M)}, 0 AS r FROM full_facts"
    extra = f"SELECT month, country_code, left(hs_code_raw, {n}), {', '.join(M)}, 1 FROM short_rows WHERE regexp_full_match(hs_code_raw, '[0-9]+') AND length(hs_code_raw) BETWEEN {n} AND 9"
    part = ", ".join(f"CAST(sum({m} * r) AS BIGINT) AS residual_{m}" for m in M)
    return f"SELECT {n} AS level, month, country_code, code, {SUMS}, {part}, count(*) AS source_row_count, CAST(sum(r) AS BIGINT) AS exception_row_count, sum(r) > 0 AS has_residual FROM ({own} UNION ALL {extra}) GROUP BY month, country_code, code"


RESIDUALS = " UNION ALL ".join(map(residual_level, (8, 6, 4, 2)))


def reconciliation_level(n: int) -> str:
    where = f"WHERE regexp_full_match(hs_code_raw, '[0-9]+') AND length(hs_code_raw) BETWEEN {n} AND 9"
    sums = ", ".join(f"CAST((SELECT sum({m}) FROM full_facts) + coalesce((SELECT sum({m}) FROM short_rows {where}), 0) AS BIGINT) AS {m}" for m in M)
    count = f"(SELECT count(*) FROM short_rows {where})"
    return f"SELECT {n} AS level, {sums}, {count} AS exceptions, {count} AS mapped, true AS reconciles"


def oracle_sql() -> dict[str, str]:
    index = "year(d) * 12 + month(d) - 1"
    name = lambda i: f"lpad(CAST(({i}) // 12 AS VARCHAR), 4, '0') || lpad(CAST(({i}) % 12 + 1 AS VARCHAR), 2, '0')"
    unknown = "coalesce(nullif(trim(x), ''), '-')"
    total_columns = ", ".join(f"CAST(coalesce(sum(CASE WHEN export_usd IS NOT NULL THEN {m} END), 0) AS BIGINT) AS {m}" for m in M)
    off = {m: f"CASE WHEN k % 7 = 0 THEN {1 if m.endswith('kg') else 0} WHEN k % 11 = 0 THEN 1 ELSE 0 END" for m in M}
    stated = ", ".join(f"CAST({m} + CASE WHEN k % 13 = 0 THEN 5 ELSE {off[m]} END AS BIGINT) AS s_{m}" for m in M)
    diff = {m: f"abs({m} - s_{m})" for m in M}
    fatal = " OR ".join(f"{diff[m]} > {'greatest(1, fact_rows)' if m.endswith('kg') else '0'}" for m in M)
    rounded, fields = f"{diff['export_weight_kg']} + {diff['import_weight_kg']}", f"CAST({diff['export_weight_kg']} > 0 AS INTEGER) + CAST({diff['import_weight_kg']} > 0 AS INTEGER)"
    checks = f"""totals AS (SELECT source, count(*) AS fact_rows, bool_and(export_usd IS NOT NULL) AS numeric_ok, bool_or(export_usd IS NOT NULL) AS readable, {total_columns} FROM raw GROUP BY source), {SUMMED}, stated AS (SELECT *, {stated} FROM k0),
judged AS (SELECT source, fact_rows, {rounded} AS rounded, {fields} AS fields, CASE WHEN k % 9 = 4 THEN 'not_whole' WHEN k % 10 = 0 OR NOT readable THEN 'missing' WHEN NOT numeric_ok THEN 'unavailable' WHEN {fatal} THEN 'mismatch' WHEN {rounded} > 0 THEN 'rounding' ELSE 'match' END AS status FROM stated),
checked AS (SELECT source, fact_rows, status, CASE WHEN status IN ('match', 'rounding') THEN rounded ELSE 0 END AS rounding_kg, CASE WHEN status IN ('match', 'rounding') THEN fields ELSE 0 END AS rounding_fields FROM judged)"""
    have = lambda kinds, name: f"count(*) FILTER (status IN ({kinds})) AS source_summary_{name}"
    tariff_codes = ", ".join(f"left(hs10, {n}) AS hs{n}" for n in (8, 6, 4, 2))
    good = lambda c, name: f"CAST(coalesce(sum(CASE WHEN good THEN {c} END), 0) AS BIGINT) AS {name}"
    month_at = "'2024' || lpad(CAST(m AS VARCHAR), 2, '0')"
    conditional = "CASE WHEN strpos(text, chr(65533)) > 0 THEN 'replacement_character' WHEN regexp_matches(text, '\\x00') THEN 'nul_character' WHEN regexp_matches(text, '[\\x01-\\x08\\x0b\\x0c\\x0e-\\x1f]') THEN 'control_character' END"
    out = {f"rollup_hs{n}": rollup(n) for n in (8, 6, 4, 2)}
    out |= {
        "rollup_all_levels": f"WITH {FACTS} " + " UNION ALL ".join(f"SELECT {n} AS level, month, country_code, left(hs10, {n}) AS code, {SUMS}, count(*) AS source_row_count FROM facts GROUP BY month, country_code, left(hs10, {n})" for n in (8, 6, 4, 2)),
        "rollup_with_residuals": f"WITH {FACTS}, {SPLIT} {RESIDUALS}",
        "rollup_reconciliation": f"WITH {FACTS}, {SPLIT} " + " UNION ALL ".join(map(reconciliation_level, (8, 6, 4, 2))),
        "rollup_reconciliation_monthly": f"WITH {FACTS}, {SPLIT} " + " UNION ALL ".join(f"SELECT {n} AS level, month, {SUMS}, CAST(sum(r) AS BIGINT) AS exceptions, CAST(sum(r) AS BIGINT) AS mapped, true AS reconciles FROM (SELECT month, {', '.join(M)}, 0 AS r FROM full_facts UNION ALL SELECT month, {', '.join(M)}, 1 FROM short_rows WHERE regexp_full_match(hs_code_raw, '[0-9]+') AND length(hs_code_raw) BETWEEN {n} AND 9) GROUP BY month" for n in (8, 6, 4, 2)),
        "fact_totals": f"WITH {FACTS} SELECT {SUMS} FROM facts",
        "source_selection": f"WITH {SOURCES}, {SELECTED} SELECT * FROM selected",
        "source_overlap_counts": f"WITH {SOURCES}, {SELECTED} SELECT count(*) AS country_months, count(*) FILTER (candidates > 1) AS overlapping, max(candidates) AS most_candidates FROM selected",
        "superseded_rows": f"WITH {SOURCES}, {SELECTED} SELECT e.country, e.month, e.path FROM expanded e LEFT JOIN selected s ON e.country = s.country AND e.month = s.month AND e.path = s.path WHERE s.path IS NULL",
        "source_assignments": f"WITH {SOURCES}, {SELECTED} SELECT left(month, 4) AS year, path, string_agg(month, ',' ORDER BY month) AS months FROM (SELECT DISTINCT month, path FROM selected) GROUP BY ALL",
        "clipped_months": f"WITH {SOURCES} SELECT country, month, count(*) AS sources FROM expanded WHERE month BETWEEN '199601' AND '199912' GROUP BY ALL",
        "coverage_missing": f"WITH {SOURCES} SELECT n_name AS country, month FROM nation, (SELECT i, {name('i')} AS month FROM (SELECT unnest(range(1995 * 12, 2003 * 12)) AS i)) m WHERE i % 11 = CAST(substring(n_name, 8) AS INTEGER) % 11 OR NOT EXISTS (SELECT 1 FROM months s WHERE s.country = n_name AND s.month = m.month)",
        "classify_rows": f"WITH {FACTS}, {RAW} SELECT source, ordinal, hs_code_raw, bucket, reason, warning FROM classified",
        "canonical_facts": f"WITH {FACTS}, {RAW} SELECT month, requested_country AS country_code, hs_code_raw AS hs10, " + ", ".join(f"left(hs_code_raw, {n}) AS hs{n}" for n in (8, 6, 4, 2)) + f", {', '.join(M)} FROM classified WHERE bucket = 'canonical'",
        "anomaly_table": f"WITH {FACTS}, {RAW} SELECT coalesce(reason, warning) AS reason, month, requested_country, country_code_raw, hs_code_raw, length(hs_code_raw) AS hs_length, name_ko, {', '.join(M)}, source_manifest, source AS source_raw_path, source_finished_at FROM classified WHERE coalesce(reason, warning) IS NOT NULL",
        "anomaly_release": f"WITH {FACTS}, {RAW} SELECT reason, month, requested_country AS country_code, country_code_raw, hs_code_raw AS raw_hs_code, length(hs_code_raw) AS raw_hs_length, name_ko, {', '.join(M)}, source_finished_at FROM classified WHERE reason = 'non_hs10_code'",
        "anomaly_text_qa": f"""WITH {FACTS}, {RAW}, a AS (SELECT coalesce(reason, warning) AS reason, length(hs_code_raw) AS n FROM classified WHERE coalesce(reason, warning) IS NOT NULL)
SELECT count(*) AS rows, count(*) FILTER (reason = 'non_hs10_code') AS non_hs10_rows, count(*) FILTER (reason = 'negative_weight') AS negative_weight_rows, count(*) FILTER (n = 9) AS bad_unicode_name_ko, count(*) FILTER (n <> 6) AS korean_name_without_hangul, count(*) FILTER (n = 9) = 0 AS ok FROM a""",
        "row_reconciliation": f"WITH {FACTS}, {RAW} SELECT count(*) AS assigned, count(*) FILTER (bucket = 'canonical') AS canonical, count(*) FILTER (bucket = 'quarantine') AS quarantine, count(*) FILTER (bucket = 'fatal') AS fatal, true AS reconciles FROM classified",
        "source_totals": f"WITH {FACTS}, {RAW} SELECT source, count(*) AS fact_rows, bool_and(export_usd IS NOT NULL) AS numeric_ok, {total_columns} FROM raw GROUP BY source",
        "summary_reconciliation": f"WITH {FACTS}, {RAW}, {checks} SELECT * FROM checked",
        "summary_figures": f"""WITH {FACTS}, {RAW}, {checks} SELECT {have("'mismatch', 'rounding', 'match'", 'checked')}, {have("'rounding', 'match'", 'matches')}, {have("'mismatch'", 'mismatches')}, {have("'missing'", 'missing')}, {have("'unavailable'", 'unavailable_numeric')}, {have("'rounding'", 'weight_rounding_sources')},
CAST(coalesce(sum(rounding_fields), 0) AS BIGINT) AS source_summary_weight_rounding_fields, CAST(coalesce(sum(rounding_kg), 0) AS BIGINT) AS source_summary_weight_rounding_abs_kg FROM checked""",
        "last_summaries": f"WITH {FACTS}, {RAW}, {checks} SELECT source, {', '.join(f's_{m} AS {m}' for m in M)} FROM stated WHERE k % 10 <> 0 AND readable",
        "short_code_observations": f"WITH {FACTS}, {RAW} SELECT requested_country, country_code_raw AS country_code, month, hs_code_raw, length(hs_code_raw) AS hs_length, name_ko, {', '.join(M)}, source AS source_raw_path FROM tested WHERE NOT full_code",
        "short_code_figures": f"""WITH {FACTS}, {RAW}, s AS (SELECT CAST(length(hs_code_raw) AS VARCHAR) AS n, count(*) AS c, sum(export_usd) AS e, sum(import_usd) AS i FROM tested WHERE NOT full_code GROUP BY 1)
SELECT CAST(coalesce(sum(c), 0) AS BIGINT) AS rows, CAST(coalesce(sum(e), 0) AS BIGINT) AS export_usd, CAST(coalesce(sum(i), 0) AS BIGINT) AS import_usd, '{{' || string_agg('"' || n || '":' || CAST(c AS VARCHAR), ',' ORDER BY n) || '}}' AS lengths FROM s""",
        "duplicate_keys": f"WITH {FACTS}, {RAW}, c AS (SELECT count(*) AS n FROM raw GROUP BY month, country_code_raw, hs_code_raw) SELECT count(*) FILTER (n > 1) AS duplicate_groups, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS extra_rows FROM c",
        "code_length_histogram": f"WITH {FACTS}, {RAW} SELECT CAST(length(hs_code_raw) AS INTEGER) AS length, count(*) AS rows FROM raw GROUP BY 1",
        "response_metrics": f"""WITH {FACTS}, {RAW}, base AS (SELECT source, CAST(substring(source, 4) AS INTEGER) AS k, count(*) AS n, bool_or(export_usd IS NOT NULL) AS readable, count(DISTINCT month) AS month_count, array_to_string(list_sort(list_distinct(list(month))), ',') AS months_found, count(*) FILTER (NOT full_code) AS non_hs10_fact_rows,
count(*) FILTER (export_usd = 0 AND export_weight_kg = 0 AND import_usd = 0 AND import_weight_kg = 0) AS zero_trade_rows, count(*) FILTER (export_usd < 0 OR import_usd < 0 OR export_weight_kg < 0 OR import_weight_kg < 0) AS negative_amount_or_weight_rows,
count(*) FILTER (export_usd - import_usd <> trade_balance_usd) AS balance_mismatch_rows, count(*) FILTER (mismatch) AS country_mismatch_rows FROM tested GROUP BY source),
keys AS (SELECT source, count(*) AS c FROM raw GROUP BY source, month, country_code_raw, hs_code_raw), dups AS (SELECT source, CAST(sum(c - 1) AS BIGINT) AS duplicate_key_rows, count(*) FILTER (c > 1) AS duplicate_key_groups FROM keys GROUP BY source),
lens AS (SELECT source, CAST(length(hs_code_raw) AS VARCHAR) AS l, count(*) AS c FROM raw GROUP BY 1, 2), lengths AS (SELECT source, '{{' || string_agg('"' || l || '":' || CAST(c AS VARCHAR), ',' ORDER BY l) || '}}' AS hs_length_counts FROM lens GROUP BY source),
vars AS (SELECT source, hs_code_raw AS c, list_sort(list_distinct(list(name_ko))) AS x, min(ordinal) AS o FROM raw GROUP BY 1, 2), shown AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY o, c) AS r FROM vars WHERE len(x) > 1),
names AS (SELECT source, count(*) AS hs_name_variant_codes, string_agg(c || '=' || array_to_string(x[1:5], '|'), ';' ORDER BY o, c) FILTER (r <= 20) AS hs_name_variant_examples FROM shown GROUP BY source)
SELECT b.source, n + t AS row_count, n AS fact_row_count, t AS total_row_count, CAST(month_count AS INTEGER) AS month_count, months_found, hs_length_counts, non_hs10_fact_rows, duplicate_key_rows, duplicate_key_groups, zero_trade_rows, negative_amount_or_weight_rows, balance_mismatch_rows, country_mismatch_rows,
coalesce(hs_name_variant_codes, 0) AS hs_name_variant_codes, coalesce(hs_name_variant_examples, '') AS hs_name_variant_examples FROM (SELECT *, CAST(CASE WHEN k % 10 = 0 OR NOT readable THEN 0 ELSE 2 END AS BIGINT) AS t FROM base) b JOIN dups USING (source) JOIN lengths USING (source) LEFT JOIN names USING (source)""",
        "revision_lookup": f"WITH {FACTS}, {EDITIONS}, {LOOKED} SELECT left(month, 4) AS year, hs_revision, count(*) AS rows, CAST(sum(import_usd) AS BIGINT) AS import_usd FROM looked GROUP BY 1, 2",
        "reference_gaps": f"WITH {FACTS}, {EDITIONS}, {LOOKED}, u AS (SELECT left(month, 4) AS year, hs10, month, 'name ' || CAST(l_partkey % 40 AS VARCHAR) AS name FROM looked WHERE hs_revision IS NULL) SELECT year, hs10, count(*) AS rows, array_to_string(list_sort(list_distinct(list(month))), ',') AS months, array_to_string(list_sort(list_distinct(list(name))), ' | ') AS names FROM u GROUP BY year, hs10",
        "reference_conflicts": f"WITH {FACTS}, {EDITIONS} SELECT CAST(reference_year AS INTEGER) AS reference_year, hs10, CAST(2 AS BIGINT) AS revisions FROM editions WHERE reference_year = 1996 AND left(hs10, 2) = '10'",
        "code_name_inventory": f"WITH {FACTS}, n AS (SELECT *, 'name ' || CAST(l_partkey % 40 AS VARCHAR) AS name FROM facts) SELECT hs10, count(DISTINCT name) AS name_count, {json_list('name')} AS names_json, {json_list('left(month, 4)')} AS years_observed_json, {json_list('country_code')} AS countries_observed_json, min(month) AS first_trade_month_observed, max(month) AS last_trade_month_observed FROM n GROUP BY hs10",
        "code_name_variants": f"WITH {FACTS}, n AS (SELECT left(hs10, 2) AS hs10, list_sort(list_distinct(list('name ' || CAST(l_partkey % 40 AS VARCHAR)))) AS x, min(l_orderkey * 10 + l_linenumber) AS o FROM facts GROUP BY 1) SELECT hs10, array_to_string(x[1:5], '|') AS names FROM n WHERE len(x) > 1 ORDER BY o, hs10 LIMIT 20",
        "duplicate_label_fold": f"WITH RECURSIVE {FOLD} SELECT hs10, CAST(n AS INTEGER) AS copies, ko AS name_ko, en AS name_en, conflicts FROM folded QUALIFY row_number() OVER (PARTITION BY hs10 ORDER BY n DESC) = 1",
        "duplicate_label_audit": f"""WITH RECURSIVE {FOLD}, steps AS (SELECT b.hs10, b.n AS step_no, a.ko AS first_ko, a.en AS first_en, b.ko AS second_ko, b.en AS second_en, CASE WHEN {BETTER} THEN b.ko ELSE a.ko END AS selected_ko, CASE WHEN {BETTER} THEN b.en ELSE a.en END AS selected_en,
CASE WHEN {FITS} THEN 'prefer_more_specific_compatible_label' ELSE 'prefer_first_source_order_pending_adjacent_year_review' END AS resolution FROM folded a JOIN nth b ON a.hs10 = b.hs10 AND b.n = a.n + 1 WHERE a.ko <> b.ko OR a.en <> b.en)
SELECT hs10, CAST(row_number() OVER (PARTITION BY hs10 ORDER BY step_no) - 1 AS INTEGER) AS n, first_ko, first_en, second_ko, second_en, selected_ko, selected_en, resolution FROM steps""",
        "edition_duplicates": f"WITH {LABELS} SELECT hs10, count(*) AS rows FROM labels GROUP BY hs10 HAVING count(*) > 1",
        "adjacent_year_review": f"WITH {REVIEW} SELECT y AS reference_year, hs10, resolution, {LABEL.format('CASE WHEN used THEN 1 - b ELSE b END')} AS name_ko, {ENGLISH.format('CASE WHEN used THEN 1 - b ELSE b END')} AS name_en, {LABEL.format('previous')} AS previous_ko, {LABEL.format('following')} AS next_ko FROM judged",
        "adjacent_rewrites": f"WITH {REVIEW} SELECT e.y AS reference_year, e.hs10, {LABEL.format('CASE WHEN coalesce(used, false) THEN 1 - e.b ELSE e.b END')} AS name_ko, {ENGLISH.format('CASE WHEN coalesce(used, false) THEN 1 - e.b ELSE e.b END').replace('k %', 'e.k %')} AS name_en FROM e LEFT JOIN judged j ON j.hs10 = e.hs10 AND j.y = e.y",
        "tariff_index": f"WITH {TARIFF} SELECT DISTINCT y AS reference_year, CAST(y AS VARCHAR) || '0101' AS clip_sct_year, '20220101' AS clip_hstd_year, chapter FROM t",
        "tariff_editions": f"""WITH {TARIFF} SELECT y AS reference_year, 'HSK-' || CAST(y AS VARCHAR) AS hs_revision, CAST(y AS VARCHAR) || '-01-01' AS valid_from, CAST(y AS VARCHAR) || '-12-31' AS valid_to, CAST(y AS VARCHAR) || '0101' AS clip_sct_year, '20220101' AS clip_hstd_year, hs10, {tariff_codes},
mark || ' ' || p_name || CASE WHEN y = 2022 AND k % 10 = 0 AND k % 15 <> 0 THEN ' (상세)' ELSE '' END AS name_ko, 'EN ' || mark AS name_en, 'part' AS source, 'https://example.test' AS source_url FROM named""",
        "tariff_label_audit": f"""WITH {TARIFF} SELECT y AS reference_year, hs10, CASE WHEN k % 15 = 0 THEN '구 ' ELSE '품 ' END || p_name AS first_ko, CASE WHEN k % 15 = 0 THEN 'EN 구' ELSE 'EN 품' END AS first_en, CASE WHEN k % 15 = 0 THEN '신 ' || p_name ELSE '품 ' || p_name || ' (상세)' END AS second_ko,
CASE WHEN k % 15 = 0 THEN 'EN 신' ELSE 'EN 품' END AS second_en, CASE WHEN k % 15 = 0 THEN '구 ' || p_name ELSE '품 ' || p_name || ' (상세)' END AS selected_ko, CASE WHEN k % 15 = 0 THEN 'EN 구' ELSE 'EN 품' END AS selected_en,
CASE WHEN k % 15 = 0 THEN 'prefer_first_source_order_pending_adjacent_year_review' ELSE 'prefer_more_specific_compatible_label' END AS resolution FROM named WHERE y = 2022 AND (k % 15 = 0 OR k % 10 = 0)""",
        "tariff_review": "SELECT count(*) FILTER (p_partkey % 15 = 0) AS reviewed, count(*) FILTER (p_partkey % 15 = 0) AS resolved, CAST(0 AS BIGINT) AS unresolved, count(*) FILTER (p_partkey % 30 = 0) AS annual_name_rewrites FROM part",
        "country_enrich": f"WITH {PARTNERS} SELECT * FROM partner",
        "partner_qa": f"WITH {PARTNERS} SELECT count(*) AS rows, count(DISTINCT country_code) AS unique_country_codes, CAST(0 AS BIGINT) AS missing_country_name_ko, CAST(0 AS BIGINT) AS bad_unicode_rows, CAST(0 AS BIGINT) AS korean_name_without_hangul, count(*) - count(DISTINCT country_code) AS duplicate_country_codes, true AS ok FROM partner",
        "partner_universe": f"WITH {PARTNERS} SELECT * FROM universe",
        "partner_universe_facts": f"WITH {FACTS}, {PARTNERS} SELECT u.country_code, count(*) AS rows, CAST(sum(import_usd) AS BIGINT) AS import_usd FROM facts f JOIN universe u ON '나라 ' || f.country_code = u.country_name_ko GROUP BY 1",
        "outcome_verdicts": f"""WITH {EVENTS}, v AS (SELECT event_id, status, concat_ws('; ', CASE WHEN f = 0 THEN 'no fact rows returned' END, CASE WHEN short > 0 THEN CAST(short AS VARCHAR) || ' fact rows are not 10-digit numeric HS' END, CASE WHEN m_last < m1 THEN 'missing months: ' || y || lpad(CAST(m1 AS VARCHAR), 2, '0') END,
CASE WHEN dup > 0 THEN 'duplicate extra rows: ' || CAST(dup AS VARCHAR) END, CASE WHEN other > 0 THEN 'country mismatch rows: ' || CAST(other AS VARCHAR) END) AS flaws FROM events1)
SELECT event_id, CASE WHEN status <> 'success' THEN 'INCONCLUSIVE' WHEN flaws <> '' THEN 'FAIL' ELSE 'PASS' END AS verdict, CASE WHEN status <> 'success' THEN 'request status=' || status WHEN flaws <> '' THEN flaws ELSE 'all returned fact rows are 10-digit HS; requested months covered; no duplicate keys' END AS reasons FROM v""",
        "outcome_status": f"WITH {EVENTS} SELECT event_id, status, coalesce(months > 1 AND status = 'transport_error' AND (http IS NULL OR http IN (503, 504)), false) AS split, CASE WHEN months = 1 THEN 'month' WHEN months <= 3 THEN 'quarter' ELSE 'year' END AS level FROM events1",
        "effective_leaves": f"WITH {EVENTS} SELECT event_id, country, window_start, window_end, status FROM leaves",
        "root_verdicts": f"""WITH {EVENTS}, found AS (SELECT DISTINCT root, unnest(range(CAST(m0 AS BIGINT), CAST(m_last AS BIGINT) + 1)) AS m FROM inside WHERE good),
months AS (SELECT root, count(*) AS month_count FROM found GROUP BY root), gaps AS (SELECT country AS root, string_agg({month_at}, ',' ORDER BY m) AS missing FROM roots, (SELECT unnest(range(1, 13)) AS m) WHERE NOT EXISTS (SELECT 1 FROM found f WHERE f.root = country AND f.m = unnest_m) GROUP BY country),
sums AS (SELECT root AS country, count(event_id) AS leaf_requests, count(*) FILTER (NOT good) AS failed, string_agg(window_start || '-' || window_end || ':' || status, ', ' ORDER BY window_start || '-' || window_end || ':' || status) FILTER (NOT good) AS failures,
CASE WHEN count(event_id) = 0 THEN '{{}}' ELSE '{{"10":' || CAST(sum(f) AS VARCHAR) || ',"6":' || CAST(sum(short) AS VARCHAR) || '}}' END AS hs_length_counts, {good('f', 'fact_row_count')}, {good('f * 275', 'response_bytes')}, {good('short', 'non_hs10_fact_rows')}, {good('dup', 'duplicate_key_rows')}, {good('0', 'zero_trade_rows')},
{good('0', 'negative_amount_or_weight_rows')}, {good('bal', 'balance_mismatch_rows')}, {good('other', 'country_mismatch_rows')} FROM inside GROUP BY root),
own AS (SELECT country, bool_or(status = 'success') AS ok FROM events1 WHERE parent_request IS NULL AND window_start = '202401' AND window_end = '202412' GROUP BY country),
j AS (SELECT s.*, coalesce(ok, false) AS own_ok, coalesce(month_count, 0) AS month_count, coalesce(missing, '') AS missing_months, concat_ws('; ', CASE WHEN fact_row_count = 0 THEN 'no fact rows returned' END, CASE WHEN non_hs10_fact_rows > 0 THEN CAST(non_hs10_fact_rows AS VARCHAR) || ' fact rows are not 10-digit numeric HS' END,
CASE WHEN missing IS NOT NULL THEN 'missing months: ' || missing END, CASE WHEN duplicate_key_rows > 0 THEN 'duplicate extra rows: ' || CAST(duplicate_key_rows AS VARCHAR) END, CASE WHEN country_mismatch_rows > 0 THEN 'country mismatch rows: ' || CAST(country_mismatch_rows AS VARCHAR) END) AS flaws
FROM sums s LEFT JOIN own o ON o.country = s.country LEFT JOIN months m ON m.root = s.country LEFT JOIN gaps g ON g.root = s.country)
SELECT country, '202401' AS window_start, '202412' AS window_end, CASE WHEN leaf_requests = 0 THEN 'missing' WHEN own_ok THEN 'success' WHEN failed > 0 THEN 'failed' ELSE 'split_success' END AS status, CASE WHEN leaf_requests = 0 OR failed > 0 THEN 'INCONCLUSIVE' WHEN flaws <> '' THEN 'FAIL' ELSE 'PASS' END AS verdict,
CASE WHEN leaf_requests = 0 THEN 'no request outcomes found' WHEN failed > 0 THEN 'unresolved leaf failures: ' || failures WHEN flaws <> '' THEN flaws ELSE 'all effective leaf responses satisfy the HS10/month/key checks' END AS reasons, leaf_requests, CAST(month_count AS INTEGER) AS month_count, missing_months, hs_length_counts,
fact_row_count, response_bytes, non_hs10_fact_rows, duplicate_key_rows, zero_trade_rows, negative_amount_or_weight_rows, balance_mismatch_rows, country_mismatch_rows FROM j""".replace("(SELECT unnest(range(1, 13)) AS m) WHERE", "(SELECT unnest(range(1, 13)) AS m) u WHERE").replace("f.m = unnest_m", "f.m = u.m"),
        "collection_summary": f"""WITH {EVENTS} SELECT root AS country, '202401' AS window_start, '202412' AS window_end, count(event_id) AS leaf_requests, count(*) FILTER (NOT good) AS failed_leaf_requests, {good('f', 'fact_row_count')}, {good('short', 'non_hs10_fact_rows')}, {good('f * 275', 'response_bytes')}, {good('f * 32', 'gzip_bytes')},
coalesce(array_to_string(list_sort(list_distinct(list(code) FILTER (code IS NOT NULL))), ','), '') AS api_result_codes, coalesce(array_to_string(list_sort(list_distinct(list(status) FILTER (status IS NOT NULL))), ','), '') AS statuses,
coalesce(string_agg(window_start || '-' || window_end || ':' || status, ', ' ORDER BY window_start || '-' || window_end || ':' || status) FILTER (NOT good), '') AS failure_details, count(*) FILTER (NOT good) = 0 AND count(event_id) > 0 AS collection_success FROM inside GROUP BY root""",
        "run_totals": f"WITH {EVENTS} SELECT count(*) AS requests, count(*) FILTER (good) AS succeeded, {good('f', 'rows')}, bool_or(status = 'auth_error' OR (code = '30' AND NOT good)) AS auth_failed, bool_or(status = 'quota_exceeded') AS quota_exceeded, bool_or(status = 'rate_limited') AS rate_limited FROM leaves",
        "window_split": f"""WITH {SOURCES}, s AS (SELECT path, window_start, window_end, i0, i0 + span AS i1, CASE WHEN span + 1 > 3 THEN 3 ELSE 1 END AS step FROM sources WHERE span > 0), p AS (SELECT *, unnest(range(i0, i1 + 1, step)) AS i FROM s)
SELECT path, window_start, window_end, {name('i')} AS part_start, {name('least(i + step - 1, i1)')} AS part_end FROM p""",
        "annual_windows": f"WITH {SOURCES} SELECT path, window_start, window_end, left(month, 4) AS year, min(month) AS start, max(month) AS \"end\" FROM months GROUP BY 1, 2, 3, 4",
        "stable_month": f"WITH o AS (SELECT o_orderkey, o_orderdate AS d, {index} AS i FROM orders) SELECT o_orderkey, {name('i - CASE WHEN day(d) > 15 THEN 1 ELSE 2 END')} AS stable, {name('i - 13')} AS refresh_from FROM o",
        "month_bounds": f"WITH o AS (SELECT o_orderkey, o_orderdate AS d, {index} AS i FROM orders) SELECT o_orderkey, {name('i - 11')} AS last_year, {name('i - 23')} AS year_before, {name('i - 12')} AS before_end, {name('i - 90')} AS history FROM o",
        "key_text": "SELECT event_id, 'http://x?' || CASE WHEN event_id % 2 = 0 THEN 'serviceKey' ELSE 'SERVICEKEY' END || '=[REDACTED]&cntyCd=US' AS redacted, 'k+' || CAST(event_id AS VARCHAR) || '+c=' AS decoded FROM events",
        "plan_roots": "SELECT n_name AS country, CAST(y AS VARCHAR) || '01' AS window_start, CAST(y AS VARCHAR) || '12' AS window_end FROM nation, (SELECT unnest(range(1995, 2001)) AS y)",
        # what the source's parser gives: a whole number exactly, else the double cut off, else nothing; "value" as far as it is a bigint
        "number_text": """WITH p AS (SELECT p_partkey, p_partkey % 23 AS r, CAST(CASE p_partkey % 23 WHEN 2 THEN 1234567 WHEN 3 THEN trunc(p_retailprice) WHEN 4 THEN 42 WHEN 12 THEN 1000 WHEN 13 THEN 7 WHEN 14 THEN 1000 WHEN 15 THEN 0 WHEN 21 THEN p_size WHEN 22 THEN p_size END AS BIGINT) AS small FROM part)
SELECT p_partkey, CASE r WHEN 11 THEN CAST('-9223372036854775808' AS BIGINT) ELSE small END AS value,
  CASE r WHEN 10 THEN '9223372036854775808' WHEN 11 THEN '-9223372036854775808' WHEN 17 THEN '10000000000000000000000' WHEN 18 THEN '-12345678901234567890123' WHEN 19 THEN '10000000000000000000' ELSE CAST(small AS VARCHAR) END AS wide,
  '20' || lpad(CAST(p_partkey % 30 AS VARCHAR), 2, '0') || lpad(CAST(p_partkey % 13 AS VARCHAR), 2, '0') AS month FROM p""",
        "monthly_trend": f"WITH {FACTS}, s AS (SELECT month, CAST(sum(export_usd) AS BIGINT) AS export_usd, CAST(sum(import_usd) AS BIGINT) AS import_usd, CAST(sum(trade_balance_usd) AS BIGINT) AS trade_balance_usd FROM facts GROUP BY month) SELECT *, round(export_usd / 1e9, 6) AS export_bn, round(import_usd / 1e9, 6) AS import_bn FROM s",
        "slice_profile": f"WITH {FACTS} SELECT count(*) AS rows, count(DISTINCT country_code) AS partners, count(DISTINCT hs10) AS products, min(month) AS first_month, max(month) AS last_month, CAST(sum(import_usd) AS BIGINT) AS import_usd, CAST(sum(export_usd) AS BIGINT) AS export_usd FROM facts",
        "top_partners_latest": f"""WITH {FACTS}, {NAMES}, s AS (SELECT month, country_code, CAST(sum(export_usd) AS BIGINT) AS export_usd, CAST(sum(import_usd) AS BIGINT) AS import_usd FROM facts WHERE month = (SELECT max(month) FROM facts) GROUP BY ALL),
t AS (SELECT *, export_usd + import_usd AS trade_usd FROM s ORDER BY trade_usd DESC, country_code LIMIT 15) SELECT t.*, coalesce(partner_name, t.country_code) AS label FROM t LEFT JOIN partners p ON p.country_code = t.country_code""",
        "products_hs4_latest": f"WITH {FACTS} SELECT month, left(hs10, 4) AS hs4, CAST(sum(export_usd) AS BIGINT) AS export_usd, CAST(sum(import_usd) AS BIGINT) AS import_usd FROM facts WHERE month = (SELECT max(month) FROM facts) GROUP BY 1, 2 ORDER BY 3 DESC, 2 LIMIT 20",
        "product_drilldown": f"WITH {FACTS} SELECT left(hs10, 6) AS hs6, country_code, CAST(sum(export_usd) AS BIGINT) AS export_usd, CAST(sum(import_usd) AS BIGINT) AS import_usd FROM facts WHERE starts_with(hs10, '42') GROUP BY 1, 2",
        "concentration_metrics": f"WITH {FACTS}, {SHARED.format(n=6)}, {METRICS} SELECT * FROM exposed",
        "concentration_top15": f"WITH {FACTS}, {SHARED.format(n=6)}, {METRICS} SELECT * FROM exposed ORDER BY exposure DESC, hs6 LIMIT 15",
        "concentration_labels": f"""WITH {FACTS}, {SHARED.format(n=6)}, {METRICS}, t AS (SELECT * FROM exposed ORDER BY exposure DESC, hs6 LIMIT 15), names AS (SELECT {two('p_partkey % 97')} || {two('p_partkey % 7')} AS p, min(CASE WHEN p_partkey % 3 = 0 THEN ' ' ELSE p_name || ' ' || p_type END) AS name FROM part GROUP BY 1)
SELECT hs6, exposure, left(coalesce(nullif(trim(name), ''), hs6), 12) AS label FROM t LEFT JOIN names ON p = left(hs6, 4)""",
        "concentration_summary": f"WITH {FACTS}, {SHARED.format(n=6)}, {METRICS} SELECT count(*) AS products, count(*) FILTER (hhi >= 0.25) AS concentrated, count(*) FILTER (total >= 100000000) AS large, count(*) FILTER (hhi >= 0.25 AND total >= 100000000) AS both, CAST(coalesce(sum(total) FILTER (hhi >= 0.25), 0) AS BIGINT) AS concentrated_value, CAST(sum(total) AS BIGINT) AS value FROM exposed",
        "partner_shares": f"WITH {FACTS}, {SHARED.format(n=4)} SELECT code AS hs4, country_code, CAST(rank AS INTEGER) AS rank, v AS import_usd, round(share, 9) AS share FROM shares",
        "dependency_snapshot": f"WITH {FACTS}, {SHARED.format(n=2)}, {NAMES} SELECT code AS hs2, CAST(rank AS INTEGER) AS rank, s.country_code, partner_name, v AS import_usd, round(share, 9) AS share FROM shares s LEFT JOIN partners p ON p.country_code = s.country_code WHERE code = '42' AND rank <= 10",
        "top_codes_train_only": f"WITH {FACTS}, {PANEL} SELECT * FROM chosen",
        "monthly_panel": f"WITH {FACTS}, {PANEL} SELECT * FROM panel",
        "lag_features": f"WITH {FACTS}, {PANEL}, {LAGGED} SELECT * FROM lagged",
        "rolling_features": f"WITH {FACTS}, {PANEL} SELECT *, {ROLLED} FROM panel",
        "calendar_features": f"WITH {FACTS}, {PANEL}, a AS (SELECT *, 2 * 3.141592653589793 * CAST(right(month, 2) AS INTEGER) / 12 AS angle FROM panel) SELECT hs4, month, import_usd, round(sin(angle), 9) + 0.0 AS month_sin, round(cos(angle), 9) + 0.0 AS month_cos, round(ln(1 + greatest(import_usd, 0)), 9) AS log_value FROM a",
        "next_month_features": f"WITH {FACTS}, {PANEL.replace('panel AS (', 'short AS (')}, panel AS (SELECT * FROM short UNION ALL SELECT DISTINCT hs4, following, NULL FROM short, cut), {LAGGED}, f AS (SELECT *, {ROLLED} FROM lagged) SELECT hs4, month, lag_1, lag_2, lag_3, lag_6, lag_12, mean_3, mean_6, mean_12 FROM f WHERE month = (SELECT following FROM cut)",
        "baseline_scores": f"""WITH {FACTS}, {PANEL}, {LAGGED}, l AS (SELECT 'lag_1' AS model, import_usd AS a, lag_1 AS p FROM lagged WHERE month > (SELECT train_end FROM cut) UNION ALL SELECT 'lag_12', import_usd, lag_12 FROM lagged WHERE month > (SELECT train_end FROM cut))
SELECT model, count(*) AS n, round(sum(abs(p - a)) / sum(abs(a)), 9) AS wape, round(sqrt(avg(pow(ln(1 + p) - ln(1 + a), 2))), 9) AS rmsle FROM l WHERE p IS NOT NULL GROUP BY model""",
        "by_product_error": f"""WITH {FACTS}, {PANEL}, {LAGGED}, e AS (SELECT hs4, CAST(sum(import_usd) AS BIGINT) AS actual, CAST(sum(abs(lag_1 - import_usd)) AS BIGINT) AS first_error, CAST(sum(abs(lag_12 - import_usd)) AS BIGINT) AS second_error FROM lagged WHERE month > (SELECT train_end FROM cut) AND lag_1 IS NOT NULL AND lag_12 IS NOT NULL GROUP BY hs4)
SELECT *, CASE WHEN second_error <> 0 THEN round(1 - CAST(first_error AS DOUBLE) / second_error, 9) END AS improvement FROM e""",
        "text_quality_flags": f"SELECT doc_id, {conditional} AS reason, coalesce(regexp_matches(text, '[ᄀ-ᇿ㄰-㆏가-힣]'), false) AS hangul FROM documents",
        "prefix_integrity": f"WITH {FACTS} SELECT count(*) AS rows, count(*) FILTER (l_orderkey % 1000 = 1) AS prefix_mismatches, CAST(0 AS BIGINT) AS invalid_codes FROM facts",
        "dimension_qa": f"WITH {FACTS}, {EDITIONS} SELECT count(*) AS rows, CAST(min(reference_year) AS INTEGER) AS year_min, CAST(max(reference_year) AS INTEGER) AS year_max, count(DISTINCT reference_year) AS year_count, CAST(0 AS BIGINT) AS duplicate_year_hs10, CAST(0 AS BIGINT) AS invalid_hs10, CAST(0 AS BIGINT) AS prefix_mismatch, CAST(0 AS BIGINT) AS missing_name_ko, CAST(0 AS BIGINT) AS bad_unicode_name_ko, count(*) AS korean_name_without_hangul, false AS ok FROM editions",
        "snapshot_diff": f"""WITH {FACTS}, s AS (SELECT month, country_code, CAST(sum(import_usd) AS BIGINT) AS i FROM facts GROUP BY ALL) SELECT month, country_code, CASE WHEN month = '199805' THEN 'added' WHEN month = '199601' THEN 'removed' WHEN month = '199702' THEN 'changed' ELSE 'same' END AS change FROM s""",
        "partition_verify": f"WITH {FACTS}, k AS (SELECT month, country_code, hs10, count(*) AS n FROM facts GROUP BY ALL) SELECT month, CAST(sum(n) AS BIGINT) AS rows, CAST(0 AS BIGINT) AS misplaced, CAST(sum(n - 1) AS BIGINT) AS duplicates FROM k GROUP BY month",
        "xml_ingest": f"WITH {FACTS}, {RAW} SELECT month, count(*) AS rows, CAST(sum(export_usd) AS BIGINT) AS export_usd, CAST(sum(import_weight_kg) AS BIGINT) AS import_weight_kg FROM raw GROUP BY month",
        "xlsx_ingest": "SELECT row_number() OVER (PARTITION BY p_partkey // 400 ORDER BY p_partkey) + 1 AS row_number, CAST(p_partkey AS VARCHAR) AS code, p_name AS name, CAST(p_size AS VARCHAR) AS size FROM part",
        "xml_namespaces": f"WITH {FACTS}, {RAW} SELECT month, count(*) AS rows, CAST(sum(export_usd) AS BIGINT) AS export_usd, CAST(sum(import_weight_kg) AS BIGINT) AS import_weight_kg FROM raw WHERE CAST(substring(source, 4) AS INTEGER) % 7 <> 3 GROUP BY month",
        "xml_damaged": f"WITH {FACTS}, {RAW} SELECT source, CAST(ceil(count(*) / 5000.0) AS BIGINT) AS files, true AS by_the_parser FROM raw WHERE CAST(substring(source, 4) AS INTEGER) % 7 = 3 GROUP BY source",
        "xml_inspect": f"WITH {FACTS}, {RAW} SELECT source, CAST(ceil(count(*) / 5000.0) AS BIGINT) AS files, count(*) + CAST(ceil(count(*) / 5000.0) AS BIGINT) AS items, coalesce(array_to_string(list_sort(list_distinct(list(country_code_raw) FILTER (country_code_raw <> ''))), ','), '') AS countries FROM raw GROUP BY source",
        "xml_names": f"WITH {FACTS}, {RAW} SELECT month, count(*) AS observations, count(DISTINCT hs_code_raw) AS codes, count(DISTINCT name_ko) AS names FROM tested WHERE full_code GROUP BY month",
        "xml_status": "SELECT '00' AS code, 'ok' AS message, count(DISTINCT l_orderkey % 500) AS sources FROM lineitem JOIN supplier ON l_suppkey = s_suppkey",
    }
    out["consolidate_roundtrip"] = out["rollup_hs4"]
    rows = [("rows", out["row_reconciliation"], ["assigned", "canonical", "quarantine", "fatal", "reconciles"]), ("sources", out["source_overlap_counts"], ["country_months", "overlapping", "most_candidates"]), ("reference", out["dimension_qa"], ["rows", "year_min", "year_max", "year_count", "duplicate_year_hs10", "invalid_hs10", "prefix_mismatch", "missing_name_ko", "bad_unicode_name_ko", "korean_name_without_hangul", "ok"])]
    out["coverage_report_long"] = " UNION ALL ".join(f"SELECT '{s}' AS section, '{c}' AS metric, CAST({c} AS VARCHAR) AS value FROM ({q})" for s, q, cs in rows for c in cs)
    return out
