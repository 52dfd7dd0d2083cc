"""Stand-in inputs for the models, derived from the driver's test tables (FIXTURES.md §4).

The test tables hold no web sessions, so each input contract of the reference is derived with
SQL that runs unchanged in Spark and DuckDB: ``CASE id % n`` value lists (never row filters),
``split_part``, ``concat`` of non-NULL parts, integer/decimal casts. Every stand-in reads whole
tables, so its work grows with the scale factor.

Each stand-in is a template with ``{name}`` placeholders for the tables/stand-ins it reads.
Spark runs it with ``spark.sql(text, **frames)``; DuckDB inlines it as a CTE.
"""

from __future__ import annotations

from pyspark.sql import functions as F

# one row per event, with the web columns every event source shares
WEB_EVENTS = """
SELECT e.event_id, e.ts AS original_timestamp, e.event_type,
  CASE WHEN e.event_id % 3 = 2 THEN NULL ELSE concat('a', CAST(e.user_id AS STRING)) END AS anonymous_id,
  CASE WHEN e.user_id % 3 = 0 THEN concat('u', CAST(e.user_id AS STRING)) END AS user_id,
  CASE WHEN e.event_id % 13 = 0 THEN NULL
       ELSE concat(CAST(e.user_id AS STRING), '-', CAST(dayofyear(e.ts) AS STRING)) END AS session_id,
  p.url AS page_url,
  concat('/', split_part(split_part(split_part(p.url, '/', 4), '?', 1), '#', 1)) AS page_path,
  CASE e.event_id % 5 WHEN 0 THEN '[S] brand' WHEN 1 THEN '[DG] reach' WHEN 2 THEN '[V] film'
       WHEN 3 THEN '[S]' END AS campaign_name,
  CASE e.event_id % 9 WHEN 0 THEN 'google' WHEN 1 THEN 'newsletter' WHEN 2 THEN 'linkedin'
       WHEN 3 THEN 'chatgpt.com' END AS campaign_source,
  CASE e.event_id % 7 WHEN 0 THEN 'cpc' WHEN 1 THEN 'email' WHEN 2 THEN 'social' WHEN 3 THEN 'ppc' END
       AS campaign_medium,
  CASE e.event_id % 17 WHEN 0 THEN 'banner' END AS campaign_content,
  CASE e.event_id % 19 WHEN 0 THEN 'servers' END AS campaign_term,
  CASE e.event_id % 12 WHEN 0 THEN 'www.google.com' WHEN 1 THEN 'gemini.google.com' WHEN 2 THEN 't.co'
       WHEN 3 THEN 'youtube.com' WHEN 4 THEN 'acs.bank.com' WHEN 5 THEN 'blog.example.org'
       WHEN 6 THEN 'accounts.google.com' WHEN 7 THEN 'korys.cherryservers.com'
       WHEN 8 THEN split_part(p.url, '/', 3) END AS page_initial_referrer_domain,
  CASE e.event_id % 23 WHEN 0 THEN concat('g', CAST(CAST((e.event_id - e.event_id % 30) / 30 AS BIGINT) AS STRING)) END AS gclid,
  CASE e.event_id % 29 WHEN 0 THEN concat('aff', CAST(e.user_id % 5 AS STRING)) END AS affiliate_code,
  CASE e.event_id % 6 WHEN 0 THEN 'Mozilla/5.0 (Windows NT 10.0; Win64)' WHEN 1 THEN 'X11; compatible; bot'
       WHEN 2 THEN 'Mozilla/5.0 (iPhone; CPU iPhone OS 17)' WHEN 3 THEN 'Googlebot (compatible)'
       WHEN 4 THEN 'curl/8.1' END AS user_agent
FROM (SELECT *, event_id % (SELECT count(*) FROM {pages}) AS page_slot FROM {events}) e
LEFT JOIN (SELECT page_id, url FROM {pages}) p ON p.page_id = e.page_slot
"""

PAGEVIEWS = """
SELECT w.*,
  CAST(row_number() OVER (PARTITION BY coalesce(w.session_id, concat('~', CAST(w.event_id AS STRING)))
                          ORDER BY w.original_timestamp, w.event_id) AS INT) AS session_step,
  concat(split_part(w.page_url, '/', 3), w.page_path) AS page_full_path
FROM {web_events} w WHERE w.event_type = 'view'
"""

INTERACTIONS = "SELECT * FROM {web_events} WHERE event_type = 'click'"

IDENTIFIES = """
SELECT event_id, anonymous_id, session_id, user_id, original_timestamp
FROM {web_events} WHERE event_type = 'signup'
"""

GADS = """
SELECT concat('g', CAST(block AS STRING)) AS gclid,
  CASE WHEN block % 97 < 50 THEN block * 10 ELSE block * 10 + event_id % 2 END AS ad_group_id,
  CASE WHEN block % 4 = 0 THEN NULL ELSE concat('kw', CAST(block AS STRING)) END AS keyword_info_text
FROM (SELECT event_id, CAST((event_id - event_id % 30) / 30 AS BIGINT) AS block FROM {events} WHERE event_type = 'purchase') x
"""

CLIENTS = """
SELECT concat('u', CAST(c_custkey AS STRING)) AS korys_client_id,
  CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_custkey % 7 = 0 END AS is_company_partner
FROM {customer}
"""

# one row per ordering client, some clients twice, and rows without a key
DIM_CLIENTS = """
SELECT concat('u', CAST(o_custkey AS STRING)) AS korys_client_id,
  min(CASE WHEN o_custkey % 4 = 0 THEN NULL ELSE o_orderdate + INTERVAL 28 YEAR END) AS korys_contact_created_date
FROM {orders} GROUP BY o_custkey
UNION ALL
SELECT concat('u', CAST(o_custkey AS STRING)), max(o_orderdate + INTERVAL 28 YEAR) FROM {orders} WHERE o_custkey % 9 = 1 GROUP BY o_custkey
UNION ALL
SELECT CAST(NULL AS STRING), o_orderdate + INTERVAL 28 YEAR FROM {orders} WHERE o_orderkey % 50 = 0
"""

WEB_ORDERS = """
SELECT anonymous_id,
  CASE event_id % 8 WHEN 0 THEN 'order_complete' WHEN 1 THEN 'choose_payment' WHEN 2 THEN 'proceed_to_merchant'
       WHEN 3 THEN 'add_to_cart' WHEN 4 THEN 'proceed_to_cart' WHEN 5 THEN 'view_product'
       WHEN 6 THEN 'configure' END AS order_type,
  original_timestamp
FROM {web_events} WHERE event_type = 'purchase'
"""

WEB_FORMS = """
SELECT anonymous_id,
  CASE event_id % 6 WHEN 0 THEN 'custom_server' WHEN 1 THEN 'gpu_pre_order' WHEN 2 THEN 'test_server'
       WHEN 3 THEN 'waiting_list' WHEN 4 THEN 'contact_us' END AS form_name,
  original_timestamp
FROM {web_events} WHERE event_type = 'error'
"""

SALES = """
SELECT CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE concat('u', CAST(o_custkey AS STRING)) END AS korys_client_id,
  CASE o_orderkey % 4 WHEN 0 THEN 'new_new' WHEN 1 THEN 'new_old' WHEN 2 THEN 'renewal' END AS order_state,
  CAST(o_orderdate + INTERVAL 28 YEAR AS DATE) AS resource_date_start,
  CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CAST(o_orderdate + INTERVAL 28 YEAR AS DATE) - CAST(o_orderkey % 20 AS INT) END
    AS resource_value_date,
  o_custkey AS partner_id,
  concat('att', CAST(CAST((o_orderkey - o_orderkey % 8) / 8 AS BIGINT) AS STRING)) AS attribution_id,
  CAST(o_totalprice AS DECIMAL(18,2)) * CAST(0.37 AS DECIMAL(3,2)) AS amount,
  CASE o_orderkey % 5 WHEN 0 THEN 'paid' WHEN 1 THEN 'confirm' WHEN 2 THEN 'invoice' WHEN 3 THEN 'draft' END
    AS invoice_state
FROM {orders}
"""

TEAMS = """
SELECT c.c_custkey AS odoo_partner_id, concat('u', CAST(c.c_custkey - c.c_custkey % 3 AS STRING)) AS team_owner_client_id,
  f.first_order_date
FROM {customer} c
LEFT JOIN (SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS first_order_date FROM {orders} GROUP BY o_custkey) f
  ON f.o_custkey = c.c_custkey
"""

RESOURCES = """
SELECT l.l_orderkey * 10 + l.l_linenumber AS resource_id, o.o_custkey AS partner_id,
  CAST(l.l_shipdate + INTERVAL 28 YEAR AS DATE) AS date_start,
  CASE WHEN l.l_orderkey % 3 = 0 THEN NULL ELSE CAST(l.l_shipdate + INTERVAL 28 YEAR AS DATE) + 30 END AS date_cancel,
  CASE WHEN l.l_linenumber % 4 = 0 THEN NULL ELSE CAST(l.l_shipdate + INTERVAL 28 YEAR AS DATE) + 365 END
    AS resource_value_date
FROM {lineitem} l JOIN {orders} o ON o.o_orderkey = l.l_orderkey
"""

ATTRIBUTION = """
SELECT concat('att', CAST(block AS STRING)) AS attribution_id,
  CASE block % 4 WHEN 0 THEN 'cpc' WHEN 1 THEN 'ppc' WHEN 2 THEN 'email' END AS medium,
  CASE block % 3 WHEN 0 THEN 'Affiliate' WHEN 1 THEN 'Direct' ELSE 'Paid Search' END AS default_channel_grouping
FROM (SELECT DISTINCT CAST((o_orderkey - o_orderkey % 8) / 8 AS BIGINT) AS block FROM {orders}) x
"""

AD_COST = "SELECT CAST(l_shipdate AS DATE) AS date, CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(0.0101 AS DECIMAL(5,4)) AS cost FROM {lineitem}"

AFFILIATE_COST = """
SELECT CAST(o_orderdate AS DATE) AS date_invoice, CAST(o_totalprice AS DECIMAL(18,2)) * CAST(0.0003 AS DECIMAL(5,4)) AS commission_amt,
  CASE o_orderkey % 4 WHEN 0 THEN 'paid' WHEN 1 THEN 'confirm' WHEN 2 THEN 'cancel' END AS state
FROM {orders}
"""

COUNTRIES = """
SELECT concat('N', CAST(n.n_nationkey AS STRING)) AS iso_2_code,
  CASE WHEN n.n_nationkey = 24 THEN 'United States' ELSE n.n_name END AS country,
  CASE r.r_name WHEN 'EUROPE' THEN 'Europe' WHEN 'AMERICA' THEN 'Americas' ELSE r.r_name END AS region
FROM {nation} n JOIN {region} r ON r.r_regionkey = n.n_regionkey
"""

# FIXED VALUES: the CPU models of the hand-derived golden rows (FIXTURES.md §3.1) plus two more.
CPU_MODELS = [
    "Intel Xeon E5-2680v4", "Xeon E3-1240 v6", "Intel Xeon E-2288G", "Xeon-D 1540", "Intel Xeon Platinum 8358",
    "Intel Xeon Gold 6142", "Intel Xeon Gold 6530P", "Intel Xeon Gold 5515+", "Intel Xeon Silver 4210",
    "Intel Xeon Bronze 3408U", "Intel Core Ultra 7 265K", "Intel Core i9-13900K", "Intel Core i7-6700",
    "Intel Core i5-1135G7 (Gen 11)", "Intel Xeon 6421N", "Intel Xeon 6421n", "Intel Xeon 5412U",
    "AMD Ryzen Threadripper PRO 7965WX", "AMD Ryzen 9 5950X", "AMD EPYC 7402P", "AMD 4344P", "Marigold 1234",
    "Ampere Altra Q80-30", "AMD EPYC 9654", "Intel Xeon D-2141I",
]
_cpu_case = "CASE p_partkey % {n} {whens} END".format(
    n=len(CPU_MODELS), whens=" ".join(f"WHEN {i} THEN '{m}'" for i, m in enumerate(CPU_MODELS)))

PRICE_LIST = """
SELECT CAST('2026-05-01' AS DATE) AS extracted_date, concat('company-', lower(p_type)) AS company,
  CASE WHEN p_size % 2 = 0 THEN 'dedicated' ELSE 'virtual' END AS product_type,
  p_name AS plan_name, concat('p', CAST(p_partkey AS STRING)) AS plan_id,
  CPU_CASE AS cpu_model,
  CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE CAST(p_partkey % 3 + 1 AS INT) END AS cpu_count,
  CAST(p_size AS INT) AS cores_count,
  concat(CAST(p_size % 4 + 2 AS STRING), ' GHz') AS frequency,
  concat(CAST(p_size * 2 AS STRING), ' GB') AS ram,
  concat(CAST(p_size * 100 AS STRING), ' GB NVMe') AS storage,
  CASE WHEN p_size % 5 = 0 THEN 'RTX 4000' END AS gpu,
  CASE p_partkey % 3 WHEN 0 THEN '1 Gbps' WHEN 1 THEN '10 G bps' END AS bandwidth,
  CASE WHEN p_partkey % 2 = 0 THEN 'unlimited' END AS traffic,
  CASE p_partkey % 7 WHEN 0 THEN 'N3' WHEN 1 THEN 'NATION_5' WHEN 2 THEN 'United States' WHEN 3 THEN 'N24'
       WHEN 4 THEN 'ZZ' WHEN 5 THEN 'N1' END AS location,
  CASE WHEN p_size % 3 = 0 THEN 'out of stock' ELSE 'available' END AS availability,
  CAST(p_size AS DECIMAL(18,2)) AS setup_fee,
  CAST(p_retailprice AS DECIMAL(18,2)) AS price_monthly,
  CAST(NULL AS DECIMAL(18,2)) AS price_hourly,
  'EUR' AS currency
FROM {part} WHERE p_type = 'PTYPE'
""".replace("CPU_CASE", _cpu_case)
PRICE_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]

# name -> (template, inputs)
STANDINS = {
    "web_events": (WEB_EVENTS, ["events", "pages"]),
    "pageviews": (PAGEVIEWS, ["web_events"]),
    "interactions": (INTERACTIONS, ["web_events"]),
    "identifies": (IDENTIFIES, ["web_events"]),
    "gads": (GADS, ["events"]),
    "clients": (CLIENTS, ["customer"]),
    "dim_clients": (DIM_CLIENTS, ["orders"]),
    "web_orders": (WEB_ORDERS, ["web_events"]),
    "web_forms": (WEB_FORMS, ["web_events"]),
    "sales": (SALES, ["orders"]),
    "teams": (TEAMS, ["customer", "orders"]),
    "resources": (RESOURCES, ["lineitem", "orders"]),
    "attribution": (ATTRIBUTION, ["orders"]),
    "ad_cost": (AD_COST, ["lineitem"]),
    "affiliate_cost": (AFFILIATE_COST, ["orders"]),
    "countries": (COUNTRIES, ["nation", "region"]),
    **{f"price_list_{t.lower()}": (PRICE_LIST.replace("PTYPE", t), ["part"]) for t in PRICE_TYPES},
}
PRICE_LISTS = [f"price_list_{t.lower()}" for t in PRICE_TYPES]
BASE_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
               "embeddings", "pages", "benchmark", "labels", "conversations"]


def _balanced_arg(text: str, start: int) -> int:
    depth = 0
    for i in range(start, len(text)):
        if text[i] == "(":
            depth += 1
        elif text[i] == ")":
            depth -= 1
            if depth == 0:
                return i
    raise ValueError("unbalanced AGG(")


def expand_agg(text: str, engine: str, key: str = "k") -> str:
    """``AGG(expr)``: string concatenation of ``expr`` over the group in ``key`` order."""
    out, i = [], 0
    while True:
        j = text.find("AGG(", i)
        if j < 0:
            out.append(text[i:])
            return "".join(out)
        end = _balanced_arg(text, j + 3)
        expr = text[j + 4:end]
        if engine == "spark":
            rep = (f"array_join(transform(array_sort(collect_list(named_struct('k', {key}, 's', {expr}))), "
                   f"e -> e.s), '')")
        else:
            rep = f"string_agg({expr}, '' ORDER BY {key})"
        out.append(text[i:j] + rep)
        i = end + 1


#: Stand-ins that make many bytes of a small row: their table's rows are dealt by this key first, so that the texts are made in all
#: tasks, not in the few that a small file is read by, and a page's rows already lie together.
DEALT_BY = {"matrix_parts": ("part", "CAST((p_partkey - p_partkey % 40) / 40 AS BIGINT)")}


class Inputs:
    """Lazily built Spark frames for the base tables and stand-ins of one scale-factor folder."""

    def __init__(self, spark, sf_dir: str):
        self.spark, self.sf_dir, self._cache = spark, sf_dir, {}

    def __getitem__(self, name: str):
        if name not in self._cache:
            if name in BASE_TABLES:
                self._cache[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
            else:
                text, deps = STANDINS[name]
                frames = {d: self[d] for d in deps}
                if name in DEALT_BY:
                    table, key = DEALT_BY[name]
                    n = max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), self.spark.sparkContext.defaultParallelism)
                    frames[table] = frames[table].repartition(n, F.expr(key))
                self._cache[name] = self.spark.sql(expand_agg(text, "spark"), **frames)
        return self._cache[name]


def duck_ctes(names) -> list[str]:
    """``name AS (...)`` CTE bodies for DuckDB, dependencies first, each once."""
    order: list[str] = []

    def visit(n):
        if n in BASE_TABLES or n in order:
            return
        for d in STANDINS[n][1]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    out = []
    for n in order:
        text, deps = STANDINS[n]
        out.append(f"{n} AS ({expand_agg(text, 'duck').format(**{d: d for d in deps})})")
    return out


# ------------------------------------------------------------------------------------------------
# stored pages and responses
# ------------------------------------------------------------------------------------------------
# one row per part: the HTML fragments of its plan card, its table cells and its GPU grid
MATRIX_PARTS = """
SELECT k, page_id, p_name, s, cpu_text, detail_text, ram_text, nvme_text, hdd_text, ssd_text, conn_text,
  CASE WHEN page_id % 4 = 3 THEN 'gpu' ELSE concat('ax', CAST(page_id % 7 AS STRING)) END AS line,
  concat('<div class="product product-type-HetznerProduct" id="c', CAST(k AS STRING), '">',
    CASE WHEN k % 17 = 0 THEN '' ELSE concat('<h3 class="product-text-name">',
      CASE WHEN k % 19 = 0 THEN ' ' ELSE concat(' ', p_name, CASE WHEN k % 4 = 0 THEN ' &trade; ' ELSE ' ' END) END,
      '</h3>') END,
    CASE WHEN k % 5 = 1 THEN '' ELSE concat('<ho-split-price-container product-key="m', CAST(k AS STRING),
      '"></ho-split-price-container>') END,
    CASE WHEN k % 3 = 0 THEN concat('<ho-price-container price-type="hourly" product-key="h', CAST(k AS STRING),
      '"></ho-price-container>') ELSE '' END,
    '<p>from <b>', CAST(s AS STRING), '</b> EUR<br/></p></div>') AS card_html,
  concat('<div class="gpu-information-grid"><div class="grid-header-name">', p_name, '</div>',
    '<div class="item-a">', cpu_text, '</div><div class="item-b">',
    CASE s % 3 WHEN 0 THEN concat(CAST(s AS STRING), ' Performance Cores ', CAST(s % 8 AS STRING), ' Efficient Cores')
         WHEN 1 THEN concat(CAST(s AS STRING), ' Cores') ELSE CAST(s AS STRING) END,
    '</div><div class="item-c">', CAST(s * 4 AS STRING), ' GB</div><div class="item-d">',
    CASE WHEN k % 2 = 0 THEN 'NVIDIA RTX 6000 Ada' ELSE 'NVIDIA L40S' END, '</div>',
    CASE WHEN k % 6 = 0 THEN '' ELSE concat('<div class="item-e">', CAST(s AS STRING), '.5 TFLOPS</div>') END,
    '<div class="item-f">48 GB</div></div>') AS grid_html
FROM (
  SELECT p_partkey AS k, CAST((p_partkey - p_partkey % 40) / 40 AS BIGINT) AS page_id, p_name, p_size AS s,
    concat(CPU_CASE, CASE WHEN p_partkey % 4 = 0 THEN '™' ELSE '' END) AS cpu_text,
    concat(CASE p_size % 4 WHEN 0 THEN 'Octa-Core' WHEN 1 THEN concat(CAST(p_size AS STRING), ' Core')
                WHEN 2 THEN 'Dual-Cores' ELSE 'Hexa-Core' END,
           ' (', CASE p_size % 3 WHEN 0 THEN 'Zen 4' WHEN 1 THEN 'VT-x' ELSE 'Raptor Lake' END, ')') AS detail_text,
    concat(CAST(p_size * 2 AS STRING), ' GB DDR5', CASE WHEN p_partkey % 2 = 0 THEN ' Upgradeable to 256 GB' ELSE '' END)
      AS ram_text,
    CASE p_partkey % 3 WHEN 0 THEN '-' WHEN 1 THEN concat('2 x ', CAST(p_size * 64 AS STRING), ' GB optionally more')
         ELSE 'none' END AS nvme_text,
    CASE WHEN p_partkey % 5 = 0 THEN concat(CAST(p_size AS STRING), ' TB') ELSE '' END AS hdd_text,
    CASE p_partkey % 4 WHEN 1 THEN concat(CAST(p_size * 100 AS STRING), ' GB') WHEN 2 THEN ' ' ELSE '-' END AS ssd_text,
    CASE WHEN p_partkey % 2 = 0 THEN '1 Gbit/s Upgradeable to 10 Gbit/s' ELSE '10 Gbit/s' END AS conn_text
  FROM {part}) x
""".replace("CPU_CASE", _cpu_case)

MATRIX_PAGES = """
SELECT page_id, max(line) AS line, concat('https://example.test/matrix-', CAST(page_id AS STRING), '/') AS url,
  concat('<!DOCTYPE html><html><head><title>Matrix</title><script>var x = "<td>";</script></head><body>',
    '<div class="cards">', AGG(card_html), '</div>',
    CASE WHEN max(line) = 'gpu' THEN AGG(grid_html) ELSE concat('<table class="hw">',
      '<tr><th>CPU</th>', AGG(concat('<td>', cpu_text, '</td>')), '</tr>',
      '<tr><td>CPU <i>Details</i></td>', AGG(concat('<td>\n  ', detail_text, '\n</td>')), '</tr>',
      '<tr></tr>',
      '<tr><th>RAM</th>', AGG(concat('<td>', ram_text, '</td>')), '</tr>',
      '<tr><th> Drives <b>NVMe</b> SSD </th>', AGG(concat('<td>', nvme_text, '</td>')), '</tr>',
      '<tr><th>CPU</th>', AGG('<td>other</td>'), '</tr>',
      '<tr><th>NVMe HDD</th>', AGG(concat('<td>', hdd_text, '</td>')), '</tr>',
      '<tr><th>HDD</th>', AGG('<td>9 TB</td>'), '</tr>',
      '<tr><th>SATA SSD</th>', AGG(concat('<td>', ssd_text, '</td>')), '</tr>',
      '<tr><th>Connection</th>', AGG(concat('<td colspan="x">', conn_text, '</td>')), '</tr>',
      '<tr><th>Traffic</th><td colspan="3">unlimited&trade;</td><td colspan="', CASE WHEN page_id % 3 = 1 THEN '2000000000' ELSE '-2' END,
      '">20 TB</td></tr>',
      '</table>') END,
    '</body></html>') AS html
FROM {matrix_parts} GROUP BY page_id
"""

# three prices per key: an old one, the one that holds when the pages are fetched, and a later one
PRICES = " UNION ALL ".join(f"""
SELECT concat('{role}', CAST(p_partkey AS STRING)) AS product_key,
  CASE WHEN p_partkey % 7 <> {slot} THEN concat('{{{{"currency":"EUR","price":', CAST(p_size * {factor} AS STRING), ',"role":"{role}"}}}}') END
    AS prices, CAST('{priced} 00:00:00' AS TIMESTAMP) AS priced_at
FROM {{part}}""" for role, slot in (("m", 1), ("h", 2)) for priced, factor in (("2026-04-01", 11), ("2026-05-01", 9), ("2026-05-05", 8)))

# an escaped double quote (backslash + quote), spelled the same way for both engines
_BQ = "concat(chr(92), '\"')"
STORED_RESPONSES = """
SELECT event_id AS response_id, 'provider-a' AS provider, 'groups' AS kind, CAST(NULL AS STRING) AS line,
  concat('https://example.test/pricing/', CAST(user_id AS STRING)) AS source_url, ts AS fetched_at,
  concat('<html><head><script>',
    CASE event_id % 5 WHEN 0 THEN 'window.OTHER_DATA = {{"plansGroups":[' WHEN 3 THEN 'window.PLANS_PRICING_DATA = {{"plansGroups":[0],"plansGroups":['
      ELSE 'window.PLANS_PRICING_DATA = {{"plansGroups":[' END,
    CASE event_id % 5 WHEN 1 THEN '' ELSE props END,
    CASE event_id % 5 WHEN 2 THEN ' </script>' ELSE '],"currency":"EUR"}};</script>' END,
    '</head><body>', CASE WHEN event_id % 13 = 0 THEN '' ELSE repeat('<p>plans</p>', 90) END, '</body></html>') AS body
FROM {events} WHERE event_type = 'view'
UNION ALL
SELECT event_id, 'provider-b', 'arrays', CAST(NULL AS STRING),
  concat('https://example.test/lat/', CAST(event_id AS STRING)), ts,
  concat('<html><body>', repeat('<div>plan</div>', 80), '<script>self.__next_f.push([1,"{{',
    CASE WHEN event_id % 4 IN (1, 2) THEN '' ELSE concat(BQ, 'servers', BQ, ':[', replace(props, '"', BQ),
      CASE WHEN event_id % 8 = 7 THEN ',' ELSE '],' END) END,
    CASE WHEN event_id % 4 IN (0, 2) THEN '' ELSE concat(BQ, 'virtualMachines', BQ, ':[', replace(props, '"', BQ), ',',
      replace(props, '"', BQ), ']') END,
    '}}"])</script></body></html>')
FROM {events} WHERE event_type = 'click'
UNION ALL
SELECT event_id, 'provider-c', 'catalog', CAST(NULL AS STRING),
  concat('https://example.test/catalog?subsidiary=', CAST(event_id AS STRING)), ts,
  CASE event_id % 3 WHEN 0 THEN concat('{{"catalogId":1,"plans":[', props, ',', props, ']}}')
       WHEN 1 THEN concat('[', props, ']') ELSE props END
FROM {events} WHERE event_type = 'signup'
UNION ALL
SELECT 100000000 + page_id, 'provider-d', 'matrix', line, url, CAST('2026-05-04 06:00:00' AS TIMESTAMP), html
FROM {matrix_pages}
UNION ALL
SELECT 100000000 + page_id, 'provider-d', 'matrix', line, url, CAST('2026-05-04 06:00:00' AS TIMESTAMP), html
FROM {matrix_pages} WHERE page_id % 3 = 0
UNION ALL
SELECT 200000000 + page_id, 'provider-d', 'matrix', 'ex', url, CAST('2026-05-04 06:00:00' AS TIMESTAMP), html
FROM {pages}
UNION ALL
SELECT event_id, 'provider-e', CASE WHEN event_id % 2 = 0 THEN 'rss' END, CAST(NULL AS STRING), 'https://example.test/feed', ts, props
FROM {events} WHERE event_type = 'purchase'
"""
# bodies that break parsers: JSON nested beyond the decoder's stack (twice), a lone surrogate, a marked section, and a card in
# 50,000 nested elements
HOSTILE_CARD = ('<div class="product product-type-HetznerProduct"><h3 class="product-text-name">Deep</h3>'
                '<ho-split-price-container product-key="mdeep"></ho-split-price-container></div>')
STORED_RESPONSES += f"""
UNION ALL
SELECT 300000000 + n_nationkey, 'provider-f', CASE n_nationkey % 5 WHEN 2 THEN 'matrix' WHEN 3 THEN 'matrix' WHEN 4 THEN 'arrays' ELSE 'groups' END,
  'deep', concat('https://example.test/hostile/', CAST(n_nationkey AS STRING)), CAST('2026-05-04 06:00:00' AS TIMESTAMP),
  CASE n_nationkey % 5
    WHEN 0 THEN concat('window.PLANS_PRICING_DATA = {{{{"plansGroups":', repeat('[', 60000), repeat(']', 60000), '}}}}')
    WHEN 1 THEN concat('window.PLANS_PRICING_DATA = {{{{"plansGroups":["', chr(92), 'ud800"]}}}}', repeat(' ', 1000))
    WHEN 2 THEN concat('<![foo[x]]>', repeat('<p>plans</p>', 90))
    WHEN 3 THEN concat(repeat('<div>', 50000), '{HOSTILE_CARD}')
    ELSE concat(BQ, 'servers', BQ, ':', repeat('[', 60000), repeat(']', 60000)) END
FROM {{nation}}
"""

STORED_RESPONSES = STORED_RESPONSES.replace("BQ", _BQ)

# versions of a key: several, equal ones, and (mostly) NULL ones
RAW_EXISTING = """
SELECT CASE event_id % 3 WHEN 0 THEN 'provider-a' WHEN 1 THEN 'provider-b' ELSE 'provider-c' END AS provider,
  CASE WHEN event_id % 11 <> 0 THEN CAST(ts AS DATE) END AS extracted_date, concat('https://example.test/src/', CAST(user_id AS STRING)) AS source_url,
  props AS payload, CASE event_id % 4 WHEN 0 THEN NULL WHEN 1 THEN CAST(CAST(ts AS DATE) AS TIMESTAMP) ELSE ts END AS fetched_at
FROM {events} WHERE event_type IN ('view', 'click', 'error')
"""
RAW_INCOMING = RAW_EXISTING.replace("('view', 'click', 'error')", "('purchase', 'signup')")

STANDINS.update({
    "matrix_parts": (MATRIX_PARTS, ["part"]),
    "matrix_pages": (MATRIX_PAGES, ["matrix_parts"]),
    "prices": (PRICES, ["part"]),
    "stored_responses": (STORED_RESPONSES, ["events", "matrix_pages", "pages", "nation"]),
    "raw_existing": (RAW_EXISTING, ["events"]),
    "raw_incoming": (RAW_INCOMING, ["events"]),
})
