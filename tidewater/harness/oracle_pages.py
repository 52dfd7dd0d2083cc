"""DuckDB oracles for the page-side queries.

The matrix pages are built from ``part`` rows (stand-in ``matrix_parts``), so the expected cards
are derived directly from those rows: position among valid cards, the value of table column i for
card i, the last grid of a name for the last card of that name. The Spark side parses the HTML and
runs the relational extraction; agreement checks the whole parse → extract path.
"""

from __future__ import annotations

import json

from ..functions import rules as R
from ..plans.ingest import CARD_JSON_FIELDS

MATRIX_CTES = """
mp_keys AS (
  SELECT *, CASE WHEN k % 5 = 1 THEN concat('h', CAST(k AS VARCHAR)) ELSE concat('m', CAST(k AS VARCHAR)) END
    AS monthly_key
  FROM matrix_parts),
mp_valid AS (
  SELECT *, CASE WHEN k % 3 = 0 THEN concat('h', CAST(k AS VARCHAR)) ELSE monthly_key END AS hourly_key,
    trim(regexp_replace(p_name, '\\s+', ' ', 'g')) AS plan_name
  FROM mp_keys WHERE k % 17 <> 0 AND k % 19 <> 0 AND (k % 5 <> 1 OR k % 3 = 0)),
mp_cards AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY page_id ORDER BY k) - 1 AS INTEGER) AS position,
    count(*) OVER (PARTITION BY page_id) AS n_cards
  FROM mp_valid),
mp_cols AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY page_id ORDER BY k) - 1 AS INTEGER) AS col,
    count(*) OVER (PARTITION BY page_id) AS n_cols
  FROM matrix_parts),
mp_table_cards AS (
  SELECT c.page_id, c.position, c.line, c.plan_name, c.monthly_key AS plan_id, CAST(NULL AS INTEGER) AS cpu_count,
    replace(v.cpu_text, '™', '') AS cpu_model,
    CAST(CASE v.s % 4 WHEN 0 THEN 8 WHEN 1 THEN v.s WHEN 2 THEN NULL ELSE 6 END AS INTEGER) AS cores_count,
    CASE v.s % 3 WHEN 0 THEN 'Zen 4' WHEN 1 THEN NULL ELSE 'Raptor Lake' END AS cpu_arch,
    v.detail_text AS cpu_detail_raw, CAST(NULL AS VARCHAR) AS frequency,
    concat(CAST(v.s * 2 AS VARCHAR), ' GB DDR5') AS ram,
    NULLIF(concat_ws(', ',
      CASE WHEN v.k % 3 = 1 THEN concat('2 x ', CAST(v.s * 64 AS VARCHAR), ' GB NVMe') END,
      CASE WHEN v.k % 4 = 1 THEN concat(CAST(v.s * 100 AS VARCHAR), ' GB SSD') END,
      CASE WHEN v.k % 5 = 0 THEN concat(CAST(v.s AS VARCHAR), ' TB HDD') END), '') AS storage,
    CAST(NULL AS VARCHAR) AS gpu, CAST(NULL AS VARCHAR) AS gpu_vram, CAST(NULL AS VARCHAR) AS gpu_tflops,
    CAST(NULL AS VARCHAR) AS cpu_cores_raw,
    CASE WHEN v.k % 2 = 0 THEN '1 Gbit/s' ELSE '10 Gbit/s' END AS bandwidth,
    CASE WHEN c.position < 3 THEN 'unlimited' WHEN c.position = 3 OR c.page_id % 3 = 1 THEN '20 TB' END AS traffic,
    c.monthly_key, c.hourly_key
  FROM mp_cards c JOIN mp_cols v ON v.page_id = c.page_id AND v.col = c.position
  WHERE c.line <> 'gpu'),
mp_last_grid AS (
  SELECT page_id, trim(regexp_replace(p_name, '\\s+', ' ', 'g')) AS plan_name, arg_max(k, k) AS k,
    arg_max(s, k) AS s, arg_max(cpu_text, k) AS cpu_text
  FROM matrix_parts WHERE line = 'gpu' GROUP BY 1, 2),
mp_gpu_cards AS (
  SELECT c.page_id, c.position, c.line, c.plan_name, c.monthly_key AS plan_id, CAST(NULL AS INTEGER) AS cpu_count,
    CASE WHEN hit THEN replace(g.cpu_text, '™', '') END AS cpu_model,
    CAST(CASE WHEN hit THEN CASE g.s % 3 WHEN 0 THEN g.s + g.s % 8 ELSE g.s END END AS INTEGER) AS cores_count,
    CAST(NULL AS VARCHAR) AS cpu_arch, CAST(NULL AS VARCHAR) AS cpu_detail_raw, CAST(NULL AS VARCHAR) AS frequency,
    CASE WHEN hit THEN concat(CAST(g.s * 4 AS VARCHAR), ' GB') END AS ram,
    CAST(NULL AS VARCHAR) AS storage,
    CASE WHEN hit THEN CASE WHEN g.k % 2 = 0 THEN 'NVIDIA RTX 6000 Ada' ELSE 'NVIDIA L40S' END END AS gpu,
    CASE WHEN hit THEN '48 GB' END AS gpu_vram,
    CASE WHEN hit AND g.k % 6 <> 0 THEN concat(CAST(g.s AS VARCHAR), '.5 TFLOPS') END AS gpu_tflops,
    CASE WHEN hit THEN CASE g.s % 3
      WHEN 0 THEN concat(CAST(g.s AS VARCHAR), ' Performance Cores ', CAST(g.s % 8 AS VARCHAR), ' Efficient Cores')
      WHEN 1 THEN concat(CAST(g.s AS VARCHAR), ' Cores') ELSE CAST(g.s AS VARCHAR) END END AS cpu_cores_raw,
    CAST(NULL AS VARCHAR) AS bandwidth, CAST(NULL AS VARCHAR) AS traffic, c.monthly_key, c.hourly_key
  FROM (SELECT *, k = max(k) OVER (PARTITION BY page_id, plan_name) AS hit FROM mp_cards WHERE line = 'gpu') c
  LEFT JOIN mp_last_grid g ON g.page_id = c.page_id AND g.plan_name = c.plan_name),
mp_enriched AS (SELECT * FROM mp_table_cards UNION ALL SELECT * FROM mp_gpu_cards)"""
MATRIX_INPUTS = ["matrix_parts"]

CARDS_SQL_FINAL = "SELECT page_id, position, plan_name, monthly_key, hourly_key FROM mp_cards"
ENRICHED_FINAL = "SELECT * FROM mp_enriched"
POSITIONAL_FINAL = "SELECT page_id, position, cpu_model, bandwidth FROM mp_table_cards"
GPU_FINAL = ("SELECT page_id, position, plan_name, cpu_model, cores_count, cpu_cores_raw, ram, gpu, gpu_vram, "
             "gpu_tflops FROM mp_gpu_cards")
LAST_WINS_FINAL = "SELECT page_id, position, plan_name, gpu IS NOT NULL AS enriched FROM mp_gpu_cards"
KEYS_FINAL = ("SELECT DISTINCT product_key FROM (SELECT monthly_key AS product_key FROM mp_cards "
              "UNION ALL SELECT hourly_key FROM mp_cards)")
_LATEST = """(SELECT product_key, prices FROM prices WHERE priced_at <= TIMESTAMP '{until}'
  QUALIFY row_number() OVER (PARTITION BY product_key ORDER BY priced_at DESC) = 1)"""
# pages fetched on the third, fourth and fifth of May: a price of the fifth holds for the last only
_AS_OF = """LEFT JOIN LATERAL (SELECT prices FROM prices x WHERE x.product_key = c.{key}
  AND x.priced_at <= TIMESTAMP '2026-05-04 06:00:00' + to_days(CAST(c.page_id % 3 - 1 AS INTEGER))
  ORDER BY x.priced_at DESC LIMIT 1) {name} ON TRUE"""
TWO_ROLES_FINAL = f"""SELECT c.page_id, c.position, c.monthly_key, c.hourly_key, pm.prices AS monthly_prices,
  ph.prices AS hourly_prices
FROM mp_cards c {_AS_OF.format(key='monthly_key', name='pm')} {_AS_OF.format(key='hourly_key', name='ph')}"""
JSON_ROUNDTRIP_FINAL = """SELECT page_id, position, CAST(json_object('plan_name', plan_name, 'monthly_key', monthly_key,
  'hourly_key', hourly_key, 'cores_count', cores_count, 'cpu_model', cpu_model) AS VARCHAR) AS doc FROM mp_enriched"""

_ATTR_ROWS = [  # attribute, expected label, value column of matrix_parts (None: fixed row)
    ("cpu", "cpu", "cpu_text"), ("cpu_detail", "cpu details", "detail_text"), ("ram", "ram", "ram_text"),
    ("nvme", "drives nvme ssd", "nvme_text"), ("ssd", "sata ssd", "ssd_text"), ("hdd", "nvme hdd", "hdd_text"),
    ("bandwidth", "connection", "conn_text"),
]
SPEC_ROWS_FINAL = " UNION ALL ".join(
    f"""SELECT page_id, '{a}' AS attribute, '{label}' AS label, CAST(count(*) AS INTEGER) AS n_cells,
  trim(regexp_replace(arg_min({col}, k), '\\s+', ' ', 'g')) AS first_cell
FROM matrix_parts WHERE line <> 'gpu' GROUP BY page_id""" for a, label, col in _ATTR_ROWS
) + """ UNION ALL SELECT DISTINCT page_id, 'traffic', 'traffic', 2, 'unlimited™' FROM matrix_parts WHERE line <> 'gpu'"""

EXPAND_FINAL = """SELECT page_id, string_agg(CASE WHEN position < 3 THEN 'unlimited™' WHEN position = 3 OR page_id % 3 = 1
  THEN '20 TB' ELSE '' END, '|' ORDER BY position) AS traffic_cells
FROM mp_cards WHERE line <> 'gpu' GROUP BY page_id"""

# ------------------------------------------------------------------------------------------------
# stored responses
# ------------------------------------------------------------------------------------------------
# the hostile ones, by construction: which are read, and as what
_DEEP_FIELDS = {"line": "deep", "plan_name": "Deep", "plan_id": "mdeep", "monthly_key": "mdeep", "hourly_key": "mdeep"}
DEEP_CARD = "[" + json.dumps({f: _DEEP_FIELDS.get(f) for f in [*CARD_JSON_FIELDS, "monthly_prices", "hourly_prices"]}, separators=(",", ":")) + "]"
HOSTILE_CTE = f"""
hostile AS (
  SELECT *, (response_id - 300000000) % 5 IN (1, 3) AS ok, CASE (response_id - 300000000) % 5
    WHEN 1 THEN '["' || chr(92) || 'ud800"]' WHEN 3 THEN '{DEEP_CARD}' END AS payload
  FROM stored_responses WHERE provider = 'provider-f'),
tame AS (SELECT * FROM stored_responses WHERE provider <> 'provider-f')"""
_M = R.GROUPS_MARKER
GROUPS_CTE = f"""
g_resp AS (
  SELECT response_id, body, strpos(body, '{_M}') AS pos FROM tame WHERE kind = 'groups'),
g_obj AS (
  SELECT response_id, body, pos,
    CASE WHEN pos > 0 AND strpos(substr(body, pos + {len(_M)}), ';</script>') > 0
      THEN substr(body, pos + {len(_M)}, strpos(substr(body, pos + {len(_M)}), ';</script>') - 1) END AS obj
  FROM g_resp),
g_out AS (
  SELECT response_id, body,
    COALESCE(json_valid(obj) AND json_array_length(last_groups) > 0, FALSE) AS ok,
    CASE WHEN json_valid(obj) AND json_array_length(last_groups) > 0 THEN CAST(json(last_groups) AS VARCHAR) END AS payload
  FROM (SELECT *, NULLIF(regexp_extract(obj, '.*"plansGroups":(\\[[^\\]]*\\])', 1), '') AS last_groups FROM g_obj)
  UNION ALL SELECT response_id, body, ok, payload FROM hostile WHERE kind = 'groups')"""
GROUPS_FINAL = "SELECT response_id, ok, payload FROM g_out"

ARRAYS_CTE = """
a_resp AS (
  SELECT response_id, body, replace(body, '\\"', '"') AS u FROM tame WHERE kind = 'arrays'),
a_parts AS (
  SELECT response_id, body,
    CASE WHEN response_id % 8 <> 7 THEN NULLIF(regexp_extract(u, '"servers":(\\[[^\\]]*\\])', 1), '') END AS a1,
    NULLIF(regexp_extract(u, '"virtualMachines":(\\[[^\\]]*\\])', 1), '') AS a2
  FROM a_resp),
a_inner AS (
  SELECT response_id, body,
    CASE WHEN json_array_length(a1) > 0 THEN substr(CAST(json(a1) AS VARCHAR), 2, length(CAST(json(a1) AS VARCHAR)) - 2) END AS i1,
    CASE WHEN json_array_length(a2) > 0 THEN substr(CAST(json(a2) AS VARCHAR), 2, length(CAST(json(a2) AS VARCHAR)) - 2) END AS i2
  FROM a_parts),
a_out AS (
  SELECT response_id, body, (i1 IS NOT NULL OR i2 IS NOT NULL) AS ok,
    CASE WHEN i1 IS NOT NULL OR i2 IS NOT NULL THEN concat('[', concat_ws(',', i1, i2), ']') END AS payload
  FROM a_inner
  UNION ALL SELECT response_id, body, ok, payload FROM hostile WHERE kind = 'arrays')"""
ARRAYS_FINAL = "SELECT response_id, ok, payload FROM a_out"

CATALOG_OK = ("CASE WHEN json_valid(body) THEN COALESCE(json_type(body) = 'OBJECT' AND list_contains(json_keys(body), 'plans'), FALSE) "
              "ELSE FALSE END")
SHAPE_FINAL = f"SELECT response_id, {CATALOG_OK} AS ok FROM stored_responses WHERE kind = 'catalog'"
PAYLOAD_ROWS_FINAL = """SELECT response_id, CAST(CASE WHEN json_type(body) = 'ARRAY' THEN json_array_length(body)
  WHEN json_type(body) = 'OBJECT' AND json_type(body, '$.plans') = 'ARRAY' THEN json_array_length(body, '$.plans')
  ELSE 1 END AS INTEGER) AS n_rows
FROM stored_responses WHERE kind = 'catalog'"""
EXPLODE_FINAL = """SELECT response_id, CAST(i AS INTEGER) AS item_pos,
  json_extract_string(body, concat('$.plans[', CAST(i AS VARCHAR), '].k')) AS k
FROM (SELECT response_id, body, unnest(range(CAST(json_array_length(body, '$.plans') AS BIGINT))) AS i
      FROM stored_responses WHERE kind = 'catalog' AND {ok})""".format(ok=CATALOG_OK)

_FINE = f"length(body) >= {R.MIN_PAGE_CHARS}"
# every distinct response with its verdict and, where it is fine, its payload
RESULTS_CTES = f"""
known_prices AS {_LATEST.format(until='2026-05-04 06:00:00')},
card_json AS (
  SELECT page_id, position, CAST(to_json(struct_pack({', '.join(f'{f} := {f}' for f in (
      'line', 'plan_name', 'plan_id', 'cpu_count', 'cpu_model', 'cores_count', 'cpu_arch', 'cpu_detail_raw', 'frequency', 'ram', 'storage',
      'gpu', 'gpu_vram', 'gpu_tflops', 'cpu_cores_raw', 'bandwidth', 'traffic', 'monthly_key', 'hourly_key'))})) AS VARCHAR) AS plain,
    coalesce(pm.prices, 'null') AS pm, coalesce(ph.prices, 'null') AS ph
  FROM mp_enriched LEFT JOIN known_prices pm ON pm.product_key = monthly_key LEFT JOIN known_prices ph ON ph.product_key = hourly_key),
page_json AS (
  SELECT page_id, '[' || string_agg(left(plain, length(plain) - 1) || ',"monthly_prices":' || pm || ',"hourly_prices":' || ph || '}}', ','
    ORDER BY position) || ']' AS payload
  FROM card_json GROUP BY page_id),
results AS (
  SELECT provider, source_url, fetched_at, g.ok AND length(s.body) >= {R.MIN_PAGE_CHARS} AS ok, payload
  FROM stored_responses s JOIN g_out g USING (response_id) WHERE kind = 'groups'
  UNION ALL
  SELECT provider, source_url, fetched_at, a.ok AND length(s.body) >= {R.MIN_PAGE_CHARS}, payload
  FROM stored_responses s JOIN a_out a USING (response_id) WHERE kind = 'arrays'
  UNION ALL
  SELECT provider, source_url, fetched_at, {CATALOG_OK}, body FROM stored_responses WHERE kind = 'catalog'
  UNION ALL
  SELECT DISTINCT provider, source_url, fetched_at, {_FINE}, coalesce(payload, '[]')
  FROM tame LEFT JOIN page_json ON response_id = 100000000 + page_id WHERE kind = 'matrix'
  UNION ALL
  SELECT provider, source_url, fetched_at, ok, payload FROM hostile WHERE kind = 'matrix'
  UNION ALL
  SELECT provider, source_url, fetched_at, FALSE, NULL FROM stored_responses WHERE kind = 'rss' OR kind IS NULL)"""
STATUS_FINAL = """SELECT provider, CAST(count_if(ok) AS BIGINT) AS n_ok, CAST(count_if(NOT ok) AS BIGINT) AS n_failed,
  count_if(ok) = 0 AS failed FROM results GROUP BY provider"""
QUARANTINE_FINAL = "SELECT provider, source_url, fetched_at FROM results WHERE NOT ok"
RAW_ROWS_FINAL = """SELECT provider, CAST(fetched_at AS DATE) AS extracted_date, source_url, payload, fetched_at
FROM results WHERE ok"""

UPSERT_FINAL = """SELECT first_provider AS provider, extracted_date, source_url, payload, fetched_at
FROM (
  SELECT *, first_value(provider) OVER (PARTITION BY extracted_date, source_url
      ORDER BY is_new, fetched_at NULLS FIRST, provider NULLS LAST) AS first_provider
  FROM (SELECT *, 0 AS is_new FROM raw_existing UNION ALL SELECT *, 1 FROM raw_incoming))
QUALIFY row_number() OVER (PARTITION BY extracted_date, source_url
  ORDER BY fetched_at DESC NULLS LAST, is_new DESC, payload DESC NULLS LAST) = 1"""

# texts and links of the element table, read off the raw pages
TEXTS_FINAL = """SELECT page_id, tag, href, n, trim(regexp_replace(replace(replace(replace(replace(t, '&lt;', '<'), '&gt;', '>'),
  '&quot;', '"'), '&amp;', '&'), '\\s+', ' ', 'g')) AS text
FROM (
  SELECT page_id, 'title' AS tag, CAST(NULL AS VARCHAR) AS href, 1 AS n, regexp_extract(html, '<title>([^<]*)</title>', 1) AS t FROM pages
  UNION ALL
  SELECT page_id, 'a', x[1], CAST(count(*) AS INTEGER), x[2]
  FROM (SELECT page_id, unnest(list_zip(regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1),
    regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2))) AS x FROM pages) GROUP BY ALL)"""
ELEMENTS_FINAL = """SELECT page_id, lower(t) AS tag, count(*) AS n_elements
FROM (SELECT page_id, unnest(regexp_extract_all(html, '<([a-zA-Z][^\\s/>]*)', 1)) AS t FROM pages)
GROUP BY 1, 2"""
VALID_PAGES_FINAL = f"SELECT page_id, length(html) AS n_chars, length(html) >= {R.MIN_PAGE_CHARS} AS ok FROM pages"
