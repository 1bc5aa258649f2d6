"""DuckDB oracles of the marts run on adapted driver tables.

Each oracle repeats the adapter derivation (``sources.adapters``) in SQL and
then the mart logic, independently of the Spark code.
"""

from __future__ import annotations

from martforge.plans.oracle import ORACLE

_HOST = r"lower(nullif(regexp_extract({c}, '^(?:[A-Za-z][A-Za-z0-9+.-]*://)?(?:[^/?#@]*@)?([^/?#:]+)', 1), ''))"


def _m(pat: str, col: str, ci: bool = True) -> str:
    flag = ", 'i'" if ci else ""
    return f"coalesce(regexp_matches({col}, '{pat}'{flag}), false)"


_RUN = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
_ALL = "ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING"
_VD = "PARTITION BY anonymous_id, seg_date ORDER BY original_timestamp, id"

#: The agents of the adapted page views and their parse, by hand.
_AGENTS = """
agents(slot, agent, ua_family, device_family, device_brand, device_model, os_family, os_major) AS (VALUES
 (0, 'Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/119.0.0.0 Safari/537.36',
  'Chrome', 'Other', NULL, NULL, 'Windows', '10'),
 (1, 'Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/119.0.0.0 Safari/537.36 Edg/119.0',
  'Edge', 'Other', NULL, NULL, 'Windows', '10'),
 (2, 'Mozilla/5.0 (Macintosh; Intel Mac OS X 13_4) AppleWebKit/605.1.15 (KHTML, like Gecko) Version/16.5 Safari/605.1.15',
  'Safari', 'Mac', 'Apple', 'Mac', 'Mac OS X', '13'),
 (3, 'Mozilla/5.0 (iPhone; CPU iPhone OS 16_5 like Mac OS X) AppleWebKit/605.1.15 Version/16.5 Mobile/15E148 Safari/604.1',
  'Mobile Safari', 'iPhone', 'Apple', 'iPhone', 'iOS', '16'),
 (4, 'Mozilla/5.0 (Linux; Android 13; SM-S911B) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/118.0.0.0 Mobile Safari/537.36',
  'Chrome Mobile', 'Samsung', 'Samsung', 'SM-S911B', 'Android', '13'),
 (5, 'Mozilla/5.0 (Linux; Android 14; Pixel 8 Pro) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/118.0.0.0 Mobile Safari/537.36',
  'Chrome Mobile', 'Pixel', 'Google', 'Pixel 8 Pro', 'Android', '14'),
 (6, 'Mozilla/5.0 (X11; Linux x86_64; rv:120.0) Gecko/20100101 Firefox/120.0', 'Firefox', 'Other', NULL, NULL, 'Linux', NULL),
 (7, 'curl/8.4.0', 'curl', 'Other', NULL, NULL, 'Other', NULL),
 (8, 'Mozilla/5.0 (compatible; ExampleBot/2.1; +https://bot.example/about)', 'ExampleBot', 'Spider', NULL, NULL, 'Other', NULL),
 (9, 'Mozilla/5.0 (iPhone; CPU iPhone OS 15_2 like Mac OS X) Ads-Overview/7.1', 'Other', 'iPhone', 'Apple', 'iPhone', 'iOS',
  '15')),
"""

WEB_SOURCES = _AGENTS + rf"""
n AS (SELECT max(page_id) + 1 AS n FROM pages),
pv AS (
  SELECT CAST(e.event_id AS VARCHAR) AS id, e.ts AS original_timestamp,
         '10.0.0.' || CAST(e.user_id % 120 AS VARCHAR) AS context_ip,
         CASE WHEN e.event_type = 'purchase' THEN 'cpc' END AS context_campaign_medium,
         CASE WHEN e.event_type = 'purchase' THEN 'newsletter' END AS context_campaign_source,
         CASE WHEN e.event_type = 'purchase' THEN 'promo ' || CAST(p.page_id AS VARCHAR) END AS context_campaign_name,
         CASE WHEN e.event_type = 'click' THEN CASE e.event_id % 4 WHEN 1 THEN 'https://www.search.example/search?q=a|b c'
                   WHEN 2 THEN 'www.search.example/x' WHEN 3 THEN 'https://my_search.example:8080/'
                   ELSE 'https://www.search.example/' END
              WHEN e.event_type = 'signup' THEN 'https://parent.example/home'
              WHEN e.event_type <> 'view' THEN p.url END AS referrer,
         regexp_extract(p.url, '^[A-Za-z]+://[^/?#]+([^?#]*)', 1) AS path,
         CASE WHEN e.event_type = 'click' AND e.value > 100
              THEN p.url || CASE WHEN contains(p.url, '?') THEN '&' ELSE '?' END || 'gclid=G'
                   || CAST(e.event_id % 7 AS VARCHAR)
              ELSE p.url END AS url,
         CAST(NULL AS VARCHAR) AS user_id,
         CASE WHEN e.event_type = 'error' THEN '404 Not Found'
              ELSE upper(substr(e.event_type, 1, 1)) || lower(substr(e.event_type, 2)) END AS title,
         CAST(e.user_id AS VARCHAR) AS anonymous_id,
         (SELECT ua.agent FROM agents ua WHERE ua.slot = CASE WHEN e.value > 200 THEN 8 WHEN e.user_id % 37 = 0 THEN 9
                                                            ELSE e.user_id % 8 END) AS context_user_agent
  FROM events e JOIN pages p ON e.event_id % (SELECT n FROM n) = p.page_id),
internal AS (SELECT DISTINCT '10.0.0.' || CAST(user_id % 120 AS VARCHAR) AS context_ip FROM events
             WHERE event_type = 'error' AND value > 200),
ipo AS (SELECT i.context_ip, c.c_mktsegment AS org FROM (SELECT DISTINCT context_ip FROM pv) i
        JOIN customer c ON CAST(split_part(i.context_ip, '.', 4) AS BIGINT) = c.c_custkey),
ua AS (SELECT agent AS userAgent, ua_family, device_family, device_brand, device_model, os_family, os_major FROM agents
       WHERE agent IN (SELECT context_user_agent FROM pv)),
click_ids AS (SELECT DISTINCT 'G' || CAST(event_id % 7 AS VARCHAR) AS gcl_id FROM events
              WHERE event_type = 'click' AND value > 100),
clicks AS (SELECT gcl_id FROM click_ids UNION ALL SELECT gcl_id FROM click_ids WHERE gcl_id = 'G0'),
forms AS (
  SELECT CAST(event_id AS VARCHAR) AS id, ts AS original_timestamp, '/contact' AS context_page_path,
         'https://site.example/contact' AS context_page_url, CAST(user_id AS VARCHAR) AS anonymous_id,
         CAST(NULL AS VARCHAR) AS digital_tracking_code, 'contact form' AS form_name,
         CASE WHEN event_type = 'signup' THEN 'lead_form_viewed' ELSE 'lead_form_submitted' END AS event
  FROM events WHERE event_type IN ('signup', 'purchase'))
"""

PAGEVIEWS = rf"""
test_ips AS (SELECT DISTINCT context_ip FROM pv
             WHERE {_m('qa-|staging|localhost', 'referrer')} OR {_m('qa', 'path')} OR {_m('localhost', 'url')}),
top AS (SELECT context_ip FROM pv GROUP BY context_ip ORDER BY count(*) DESC, context_ip ASC NULLS FIRST LIMIT 100),
top_org AS (SELECT t.context_ip FROM top t JOIN ipo ON ipo.context_ip = t.context_ip WHERE {_m('building', 'ipo.org')}),
excl AS (SELECT context_ip FROM internal UNION SELECT context_ip FROM test_ips UNION SELECT context_ip FROM top_org),
s1 AS (SELECT * FROM pv WHERE NOT {_m('404', 'title')}
       AND NOT EXISTS (SELECT 1 FROM excl WHERE excl.context_ip IS NOT DISTINCT FROM pv.context_ip)),
s2 AS (SELECT s1.*, ua.ua_family, ua.device_family, ua.device_brand, ua.device_model, ua.os_family, ua.os_major
       FROM s1 LEFT JOIN ua ON s1.context_user_agent IS NOT DISTINCT FROM ua.userAgent
       WHERE NOT {_m('bot|crawl|spider', 'ua.ua_family')} AND NOT {_m('Ads-Overview', 's1.context_user_agent', False)}),
s3 AS (SELECT * REPLACE (string_split(url, 'gclid=')[1] AS url), string_split(url, 'gclid=')[2] AS gcl_id FROM s2),
s4 AS (SELECT s3.* FROM s3 LEFT JOIN clicks c ON s3.gcl_id = c.gcl_id),
s5 AS (SELECT *, CAST(original_timestamp AS DATE) AS seg_date,
         CASE WHEN referrer IS NULL THEN 'none' ELSE {_HOST.format(c='referrer')} END AS host,
         coalesce(context_campaign_name, nullif(regexp_extract(url, '[?&]utm_campaign=([^&#]*)', 1), ''),
                  CASE WHEN gcl_id IS NOT NULL THEN 'not captured' END) AS cn,
         coalesce(context_campaign_medium, nullif(regexp_extract(url, '[?&]utm_medium=([^&#]*)', 1), ''),
                  CASE WHEN gcl_id IS NOT NULL THEN 'cpc' END) AS cm,
         coalesce(context_campaign_source, nullif(regexp_extract(url, '[?&]utm_source=([^&#]*)', 1), ''),
                  CASE WHEN gcl_id IS NOT NULL THEN 'google' END) AS cs
       FROM s4),
f1 AS (SELECT *,
         coalesce(last_value(cm IGNORE NULLS) OVER ({_VD} {_RUN}), first_value(cm IGNORE NULLS) OVER ({_VD} {_ALL})) AS m1,
         coalesce(last_value(cs IGNORE NULLS) OVER ({_VD} {_RUN}), first_value(cs IGNORE NULLS) OVER ({_VD} {_ALL}))
           AS campaign_source,
         coalesce(last_value(cn IGNORE NULLS) OVER ({_VD} {_RUN}), first_value(cn IGNORE NULLS) OVER ({_VD} {_ALL}))
           AS campaign_name
       FROM s5),
f2 AS (SELECT *, CASE WHEN m1 IS NULL AND {_m('yahoo|bing|duckduckgo|google|search\\.example', 'host')}
                      THEN 'organic' ELSE m1 END AS m2 FROM f1),
f3 AS (SELECT *, coalesce(last_value(m2 IGNORE NULLS) OVER ({_VD} {_RUN}),
                          first_value(m2 IGNORE NULLS) OVER ({_VD} {_ALL})) AS m3 FROM f2),
f4 AS (SELECT *, CASE WHEN {_m('paid|ppc|cpc', 'm3')} THEN 'paid'
                      WHEN m3 = 'organic' THEN 'organic'
                      WHEN m3 IS NOT NULL THEN 'other'
                      WHEN m3 IS NULL AND host = 'none' THEN 'direct'
                      WHEN m3 IS NULL AND {_m('parent\\.example', 'host')} THEN 'referral (internal)'
                      WHEN m3 IS NULL AND {_m('\\.example\\.org', 'host')} THEN NULL
                      WHEN m3 IS NULL THEN 'referral'
                      ELSE 'other' END AS m4 FROM f3),
f5 AS (SELECT *, last_value(m4 IGNORE NULLS) OVER (PARTITION BY anonymous_id ORDER BY original_timestamp, id {_RUN})
                 AS m5 FROM f4),
f6 AS (SELECT *, coalesce(m5, first_value(m5 IGNORE NULLS) OVER ({_VD} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
                 AS m6,
              first_value(url) OVER ({_VD} {_ALL}) AS landing_content FROM f5),
pve AS (SELECT id, anonymous_id, seg_date, original_timestamp, host, path, url, coalesce(m6, 'unknown') AS campaign_medium,
               campaign_source, campaign_name, landing_content, ua_family, device_family, device_brand, device_model,
               os_family, os_major FROM f6)
"""

ORACLE["user_agents"] = f"WITH {WEB_SOURCES} SELECT * FROM ua"

ORACLE["attributed_pageviews"] = f"WITH {WEB_SOURCES}, {PAGEVIEWS} SELECT * FROM pve"

_MODE_COLS = ["campaign_medium", "campaign_source", "campaign_name", "city", "location_id", "product"]
_GK = "seg_date, anonymous_id, landing_content"

DAILY = rf"""
d AS (SELECT *,
        CASE WHEN {_m('/fr/', 'path')} THEN 'Paris' WHEN {_m('/de/', 'path')} THEN 'Berlin'
             WHEN {_m('/es/', 'path')} THEN 'Madrid' END AS city,
        CASE WHEN {_m('/fr/[0-4]', 'path')} THEN 'FR-1' WHEN {_m('/fr/', 'path')} THEN 'FR-2'
             WHEN {_m('/de/', 'path')} THEN 'DE-1' END AS location_id,
        CASE WHEN {_m('promo', 'campaign_name')} OR {_m('promo', 'path')} THEN 'Suite'
             WHEN {_m('\\.html', 'campaign_name')} OR {_m('\\.html', 'path')} THEN 'Desk'
             WHEN {_m('/es/', 'campaign_name')} OR {_m('/es/', 'path')} THEN 'Room' END AS product,
        row_number() OVER (PARTITION BY {_GK} ORDER BY original_timestamp, id) AS pos
      FROM pve),
cnt AS ({' UNION ALL '.join(f"SELECT {_GK}, '{c}' AS name, {c} AS v, count(*) AS n, min(pos) AS fp FROM d GROUP BY ALL"
                            for c in _MODE_COLS)}),
best AS (SELECT *, row_number() OVER (PARTITION BY {_GK}, name ORDER BY (v IS NULL), n DESC, fp) AS rk FROM cnt),
dau AS (
  SELECT seg_date AS dau_date, anonymous_id, landing_content,
         {', '.join(f"max(v) FILTER (WHERE name = '{c}') AS {c}" for c in _MODE_COLS)}
  FROM best WHERE rk = 1 GROUP BY {_GK}),
dau_out AS (
  SELECT dau_date, anonymous_id, landing_content, campaign_medium, campaign_source, campaign_name, city,
         location_id AS unit, product AS product_orig,
         CASE WHEN campaign_medium = 'paid' THEN 1 ELSE 0 END AS true_paid,
         CAST(isodow(dau_date) AS INTEGER) AS dau_day,
         CAST(date_trunc('week', dau_date) AS DATE) AS week_start,
         CAST(date_trunc('month', dau_date) AS DATE) AS month_start,
         CAST(date_trunc('quarter', dau_date) AS DATE) AS quarter_start
  FROM dau)
"""

ORACLE["daily_visitors"] = f"WITH {WEB_SOURCES}, {PAGEVIEWS}, {DAILY} SELECT * FROM dau_out"

ORACLE["form_conversions"] = f"""
WITH {WEB_SOURCES}, {PAGEVIEWS}, {DAILY},
fu AS (SELECT DISTINCT * FROM forms)
SELECT v.dau_date, v.anonymous_id, f.id, f.original_timestamp, f.context_page_path, f.context_page_url,
       f.digital_tracking_code, f.form_name, f.event
FROM dau_out v JOIN fu f ON CAST(f.original_timestamp AS DATE) IS NOT DISTINCT FROM v.dau_date
                        AND f.anonymous_id IS NOT DISTINCT FROM v.anonymous_id
"""

# ---------------------------------------------------------------- CRM: stage history and deal mart

_HS_LABEL = ("CASE event_type WHEN 'signup' THEN 'Tour Scheduled' WHEN 'view' THEN 'Qualified - Local Fill Opportunity' "
             "WHEN 'click' THEN 'Contract Negotiation' WHEN 'purchase' THEN 'Closed Won' WHEN 'error' THEN 'Cold/Dead' END")
_CRM_LABEL = ("CASE event_type WHEN 'signup' THEN 'Touring' WHEN 'view' THEN 'Prospecting' "
              "WHEN 'click' THEN 'Negotiation/Proposal' WHEN 'purchase' THEN 'Closed Won' WHEN 'error' THEN 'Closed Lost' END")
_RT = ("CASE {c} WHEN 'FURNITURE' THEN 'Broker-Led' WHEN 'MACHINERY' THEN 'Enterprise' "
       "WHEN 'HOUSEHOLD' THEN 'Partner' ELSE 'Local Fill' END")

DEAL_HISTORY = rf"""
ph AS (SELECT user_id + 100000 AS deal_id,
              CASE WHEN value < 19 THEN 'deal_pipeline_stage_id' ELSE 'dealname' END AS name,
              'st_' || event_type AS value, ts AS timestamp FROM events WHERE value < 20),
types AS (SELECT DISTINCT event_type FROM events),
stages AS (SELECT 'st_' || event_type AS stage_id, 'default' AS pipeline_id, {_HS_LABEL} AS label FROM types
           UNION ALL SELECT 'st_' || event_type, 'other', upper(event_type) FROM types),
hs AS (SELECT ph.deal_id, date_trunc('minute', ph.timestamp) AS date_created, s.label AS pipeline_stage
       FROM ph JOIN stages s ON ph.value = s.stage_id AND s.pipeline_id = 'default'
       WHERE ph.name = 'deal_pipeline_stage_id'),
imp AS (SELECT 'OPP' || CAST(user_id AS VARCHAR) AS sid,
               user_id + CASE WHEN value < 300 THEN 100000 ELSE 200000 END AS hid, ts AS synced FROM events),
syn AS (SELECT sid, hid FROM (SELECT *, rank() OVER (PARTITION BY sid ORDER BY synced DESC NULLS FIRST) AS pos FROM imp)
        WHERE pos = 1),
oh AS (SELECT 'OPP' || CAST(user_id AS VARCHAR) AS opportunity_id, ts AS created_date,
              CASE WHEN value <= 250 THEN {_CRM_LABEL} END AS stage_name, value > 480 AS is_deleted
       FROM events WHERE value >= 20),
op AS (SELECT 'OPP' || CAST(c_custkey AS VARCHAR) AS id, 'RT_' || c_mktsegment AS record_type_id FROM customer),
rt AS (SELECT 'RT_' || seg AS id, {_RT.format(c='seg')} AS name, 'Opportunity' AS sobject_type
       FROM (SELECT DISTINCT c_mktsegment AS seg FROM customer)),
crm AS (SELECT oh.opportunity_id, oh.created_date, oh.stage_name FROM oh
        JOIN op ON oh.opportunity_id = op.id
        JOIN rt ON op.record_type_id = rt.id AND rt.sobject_type = 'Opportunity'
                AND rt.name IN ('Local Fill', 'Broker-Led', 'Enterprise')
        WHERE oh.is_deleted IS false),
hboth AS (SELECT syn.sid AS opportunity_id, hs.date_created AS created_date, hs.pipeline_stage AS pipeline_stage_detail,
                 'MKT' AS source FROM hs JOIN syn ON hs.deal_id = syn.hid
          UNION ALL SELECT opportunity_id, created_date, stage_name, 'SALES' FROM crm),
hlag AS (SELECT *, lag(pipeline_stage_detail, 1, '1') OVER (PARTITION BY opportunity_id
           ORDER BY created_date NULLS FIRST, source NULLS FIRST, pipeline_stage_detail NULLS FIRST) AS prev FROM hboth),
hist AS (
  SELECT opportunity_id, created_date AS stage_date, pipeline_stage_detail, source,
         CASE WHEN pipeline_stage_detail = 'Cold/Dead' THEN 'Closed Lost'
              WHEN pipeline_stage_detail = 'Contract Negotiation' THEN 'Negotiation/Proposal'
              WHEN pipeline_stage_detail = 'Tour Scheduled' THEN 'Touring'
              WHEN regexp_matches(pipeline_stage_detail,
                   '(Qualified - Local Fill Opportunity|Touring|Negotiation/Proposal|Contract Sent|Closed Won|Closed Lost)')
                THEN pipeline_stage_detail
              ELSE 'Upper Funnel' END AS pipeline_stage
  FROM hlag WHERE pipeline_stage_detail <> prev)
"""

ORACLE["deal_stage_history"] = f"WITH {DEAL_HISTORY} SELECT * FROM hist"

_D = "CAST(2.0 AS DOUBLE)"
DEAL_MART = rf"""
hlast AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY opportunity_id
                                   ORDER BY stage_date DESC, pipeline_stage DESC) AS rn FROM hist) WHERE rn = 1),
closed AS (SELECT opportunity_id AS id, stage_date AS close_date FROM hlast
           WHERE pipeline_stage IN ('Closed Lost', 'Closed Won')),
hsd AS (SELECT o_custkey + 100000 AS deal_id, max(o_totalprice) AS property_amount FROM orders GROUP BY o_custkey),
amounts AS (SELECT syn.sid AS salesforce_opportunity_id, hsd.property_amount AS hs_monthly_amount
            FROM hsd JOIN syn ON hsd.deal_id = syn.hid),
roles AS (SELECT 'OPP' || CAST(o_custkey AS VARCHAR) AS opportunity_id,
                 CASE WHEN o_orderpriority = '1-URGENT' THEN 'Broker Contact' ELSE 'Decision Maker' END AS role,
                 CASE WHEN o_orderstatus = 'F' THEN 'Unknown'
                      WHEN o_orderstatus = 'O' THEN 'Acct ' || CAST(o_orderkey % 5 AS VARCHAR) END AS account,
                 'Contact ' || CAST(o_orderkey % 3 AS VARCHAR) AS name FROM orders),
brokers AS (SELECT DISTINCT opportunity_id, true AS broker_roles FROM roles WHERE regexp_matches(role, 'broker', 'i')),
contacts AS (SELECT opportunity_id, string_agg(DISTINCT dc, '; ' ORDER BY dc) AS associated_contacts
             FROM (SELECT opportunity_id, coalesce(coalesce(nullif(account, 'Unknown'), name), 'NA') AS dc FROM roles)
             GROUP BY opportunity_id),
span AS (SELECT o_custkey, min(o_orderdate) AS first_order, max(o_orderdate) AS last_order FROM orders GROUP BY o_custkey),
opp AS (
  SELECT 'OPP' || CAST(c.c_custkey AS VARCHAR) AS id, {_RT.format(c='c.c_mktsegment')} AS record_type,
         {_RT.format(c='c.c_mktsegment')} AS oppty_type, c.c_name AS name,
         CASE c.c_mktsegment WHEN 'BUILDING' THEN 'Closed Won' WHEN 'AUTOMOBILE' THEN 'Touring' ELSE 'Upper Funnel' END
           AS stage_name,
         span.first_order AS created_date, span.last_order AS customer_create_date,
         CAST(span.last_order AS DATE) AS anticipated_close_date, CAST(c.c_nationkey AS DOUBLE) AS desks_max_c,
         CASE WHEN c.c_acctbal > 8000 THEN 'Room' END AS fill_product_c,
         CASE c.c_nationkey % 5 WHEN 0 THEN 'Online' WHEN 1 THEN 'Offline' WHEN 3 THEN 'Enterprise Referral'
                                WHEN 4 THEN 'Broker Referral' END AS lead_source0,
         CASE c.c_custkey % 6 WHEN 0 THEN 'DIRECT_TRAFFIC' WHEN 1 THEN 'ORGANIC_SEARCH' WHEN 2 THEN 'PAID_SEARCH'
                              WHEN 3 THEN 'PAID_SOCIAL' WHEN 4 THEN '3rd Party Aggregator' END AS data_source_1_c,
         CASE c.c_custkey % 7 WHEN 0 THEN 'https://own.example/' WHEN 1 THEN 'Blog post' WHEN 2 THEN 'own.example/page'
                              WHEN 3 THEN 'meetings.example' WHEN 4 THEN 'Facebook ads' WHEN 5 THEN 'LinkedIn'
                              ELSE 'auto-tagged' END AS data_source_2_c,
         CASE WHEN c.c_acctbal < 0 THEN 'lead-gen form' END AS data_source_3_c,
         n.n_name AS location_name, 'LOC' || CAST(c.c_nationkey AS VARCHAR) AS location_id, n.n_name AS city_c,
         r.r_name AS region_c, c.c_acctbal AS total_deal_amount_c, CAST(12.0 AS DOUBLE) AS term_length_max_c,
         CAST(span.last_order AS DATE) AS anticipated_start_date,
         concat_ws(';', CASE WHEN c.c_mktsegment = 'AUTOMOBILE' THEN 'price' END,
                   CASE WHEN c.c_acctbal < 0 THEN 'low quality' END,
                   CASE WHEN c.c_nationkey = 3 THEN 'wrong product' END) AS closed_lost_reason,
         CASE WHEN c.c_acctbal > 5000 THEN c.c_acctbal END AS price_range_min_c,
         CASE WHEN c.c_acctbal >= 0 AND c.c_acctbal <= 5000 THEN c.c_acctbal / {_D} END AS budget_min_c,
         CAST(NULL AS DOUBLE) AS price_range_max_c, CAST(NULL AS DOUBLE) AS budget_max_c,
         CASE WHEN c.c_acctbal > 0 THEN 'summary ' || c.c_mktsegment END AS executive_summary_c,
         CASE WHEN c.c_nationkey < 5 THEN 'NAtional account' END AS enterprise_notes_c,
         CASE WHEN c.c_nationkey > 20 THEN 'TC' || CAST(c.c_nationkey AS VARCHAR) END AS digital_tracking_code_c,
         c.c_name AS customer_name, 'owner ' || CAST(c.c_custkey % 10 AS VARCHAR) AS owner_name
  FROM customer c LEFT JOIN span ON c.c_custkey = span.o_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey LEFT JOIN region r ON n.n_regionkey = r.r_regionkey),
m AS (SELECT opp.*, closed.close_date AS close_date_h, amounts.hs_monthly_amount, brokers.broker_roles,
             contacts.associated_contacts, coalesce(opp.lead_source0, opp.oppty_type) AS lead_source
      FROM opp LEFT JOIN closed ON opp.id IS NOT DISTINCT FROM closed.id
      LEFT JOIN amounts ON opp.id IS NOT DISTINCT FROM amounts.salesforce_opportunity_id
      LEFT JOIN brokers ON opp.id IS NOT DISTINCT FROM brokers.opportunity_id
      LEFT JOIN contacts ON opp.id IS NOT DISTINCT FROM contacts.opportunity_id
      WHERE opp.record_type = 'Local Fill'),
m2 AS (SELECT *,
         CASE WHEN lead_source = 'Online' AND data_source_1_c = 'DIRECT_TRAFFIC' THEN 'Direct'
              WHEN lead_source = 'Online' AND data_source_1_c = 'ORGANIC_SEARCH' THEN 'Organic'
              WHEN lead_source = 'Online' AND data_source_1_c IN ('PAID_SEARCH', 'PAID_SOCIAL') THEN 'Paid'
              WHEN lead_source = 'Offline' AND data_source_1_c = '3rd Party Aggregator' THEN 'Aggregator' END
           AS digital_channel
       FROM m)
SELECT id AS deal_id, name AS deal_name, CAST(created_date AS DATE) AS create_date,
       CAST(date_trunc('week', created_date) AS DATE) AS create_week,
       CAST(date_trunc('month', created_date) AS DATE) AS create_month,
       CAST(date_trunc('quarter', created_date) AS DATE) AS create_quarter,
       CAST(isodow(created_date) AS INTEGER) AS create_wday,
       CAST(customer_create_date AS DATE) AS contact_create_date, desks_max_c AS seats, location_name AS unit,
       location_id, city_c AS city, region_c AS region, stage_name AS pipeline_stage,
       stage_name AS pipeline_stage_detail,
       CASE WHEN fill_product_c IS NOT NULL THEN fill_product_c
            WHEN {_m('enterprise|broker', 'oppty_type')} THEN 'Suite'
            WHEN desks_max_c > 1 THEN 'Suite' ELSE 'Desk' END AS product,
       coalesce(price_range_min_c, budget_min_c, price_range_max_c, budget_max_c, hs_monthly_amount) AS monthly_amount,
       total_deal_amount_c AS total_deal_amount, term_length_max_c AS lease_term, anticipated_start_date,
       closed_lost_reason,
       CASE WHEN {_m('enterprise', 'lead_source')} THEN 'Enterprise' WHEN {_m('broker', 'lead_source')} THEN 'Broker'
            WHEN lead_source = 'Online' THEN 'Marketing' WHEN lead_source = 'Local Fill' THEN 'Local Sales'
            WHEN data_source_1_c = '3rd Party Aggregator' THEN 'Marketing' ELSE 'Local Sales' END
         AS acquisition_channel,
       CASE WHEN digital_channel = 'Paid' AND {_m('lead.gen', 'data_source_3_c', False)}
              THEN 'Off-platform(' || coalesce(data_source_2_c, 'NA') || ')'
            WHEN digital_channel = 'Direct' AND {_m('own\\.example/$', 'data_source_2_c')} THEN 'Direct(homepage)'
            WHEN digital_channel = 'Direct' AND {_m('blog', 'data_source_2_c')} THEN 'Direct(blog)'
            WHEN digital_channel = 'Direct' AND {_m('own\\.example', 'data_source_2_c')} THEN 'Direct(website)'
            WHEN digital_channel = 'Direct' AND {_m('meetings\\.example', 'data_source_2_c')}
              THEN 'Direct(meeting link)'
            WHEN digital_channel = 'Direct' THEN 'Direct(other)'
            WHEN digital_channel = 'Organic' THEN lower(data_source_2_c)
            WHEN digital_channel = 'Paid' AND {_m('facebook', 'data_source_2_c')} THEN 'Paid Social(Facebook)'
            WHEN digital_channel = 'Paid' AND {_m('linkedin', 'data_source_2_c')} THEN 'Paid Social(LinkedIn)'
            WHEN digital_channel = 'Paid' AND {_m('auto-tagged', 'data_source_2_c')} THEN 'Paid Search(Google)'
            WHEN digital_channel = 'Paid' AND data_source_1_c = 'PAID_SEARCH' THEN 'Paid Search(Google*)'
            ELSE 'Other' END AS acquisition_source,
       digital_channel, digital_tracking_code_c AS tracking_code, customer_name, associated_contacts, owner_name,
       coalesce(executive_summary_c, '') || '<br>' || coalesce(enterprise_notes_c, '') AS notes,
       '<a href=''https://crm.example/opportunity/' || coalesce(id, 'NA') || '/view ''target=''_blank''>'
         || coalesce(name, 'NA') || '</a>' AS deal_link,
       CAST(coalesce(close_date_h, anticipated_close_date) AS DATE) AS close_date,
       CAST(date_trunc('week', CAST(customer_create_date AS DATE)) AS DATE) AS contact_create_week,
       CASE WHEN broker_roles IS TRUE THEN 'Broker' WHEN oppty_type = 'Broker-Led' THEN 'Broker'
            WHEN {_m('broker', 'oppty_type')} THEN 'Broker' WHEN {_m('enterprise', 'oppty_type')} THEN 'Enterprise'
            WHEN {_m('local', 'oppty_type')} THEN 'Local' ELSE 'Unspecified' END AS sales_channel
FROM m2
"""

ORACLE["deal_mart"] = f"WITH {DEAL_HISTORY}, {DEAL_MART}"

# ---------------------------------------------------------------- CRM: contact mart

CONTACT_SOURCES = r"""
span AS (SELECT o_custkey, min(o_orderdate) AS first_order, max(o_orderdate) AS last_order FROM orders GROUP BY o_custkey),
ct AS (
  SELECT c.c_custkey AS id, span.first_order AS property_createdate,
         CASE WHEN c.c_custkey % 50 = 0 THEN 'Test' ELSE 'Pat' END AS property_firstname,
         c.c_name AS property_lastname,
         CASE WHEN c.c_nationkey = 7 THEN 'OwnCo Ltd' ELSE c.c_mktsegment END AS property_company,
         CASE WHEN c.c_nationkey <> 3 THEN lower(c.c_name) || '@mail.example' END AS property_email,
         CASE c.c_nationkey % 6 WHEN 0 THEN 'lead' WHEN 1 THEN 'subscriber' WHEN 2 THEN 'other'
                                WHEN 3 THEN 'opportunity' WHEN 4 THEN 'customer' END AS property_lifecyclestage,
         CAST(c.c_nationkey AS BIGINT) AS property_associatedcompanyid,
         CASE c.c_custkey % 8 WHEN 0 THEN 'DIRECT_TRAFFIC' WHEN 1 THEN 'ORGANIC_SEARCH' WHEN 2 THEN 'PAID_SEARCH'
              WHEN 3 THEN 'PAID_SOCIAL' WHEN 4 THEN 'SOCIAL_MEDIA' WHEN 5 THEN 'OFFLINE' WHEN 6 THEN 'REFERRALS' END AS src,
         CASE c.c_custkey % 5 WHEN 0 THEN 'SALESFORCE' WHEN 1 THEN 'Broker portal' WHEN 2 THEN 'Enterprise list'
              WHEN 3 THEN 'own.example/' ELSE 'Facebook' END AS d1,
         CASE c.c_custkey % 4 WHEN 0 THEN 'lead-gen' WHEN 1 THEN 'Google' WHEN 2 THEN 'Blog' END AS d2,
         CASE WHEN c.c_acctbal > 7000 THEN 'https://adwords.example/' END AS first_ref,
         'https://own.example/lp/' || CAST(c.c_nationkey AS VARCHAR) || '?ref=x' AS first_url,
         CASE WHEN c.c_custkey % 9 = 0 THEN '3rd Party Aggregator' END AS drill,
         CASE WHEN c.c_custkey % 11 = 0 THEN 'team-9' END AS team_ids,
         CASE WHEN c.c_acctbal > 3000 THEN c.c_acctbal END AS p_budget,
         CASE WHEN c.c_acctbal > 0 THEN c.c_acctbal / CAST(2.0 AS DOUBLE) END AS p_amount,
         CASE WHEN c.c_nationkey % 2 = 0 THEN span.last_order END AS p_start, span.first_order AS p_move_in,
         CASE WHEN c.c_nationkey < 10 THEN 'NATION_' || CAST(c.c_nationkey AS VARCHAR) END AS loc_i,
         CASE WHEN c.c_custkey % 3 = 0 THEN 'Suite' END AS svc_i,
         CASE WHEN c.c_custkey % 3 = 1 THEN 'Desk' END AS ws_i,
         CASE WHEN c.c_custkey % 3 <> 0 THEN span.first_order + INTERVAL 36 HOUR END AS lead_date,
         span.last_order AS mql_date,
         CASE WHEN c.c_acctbal < 0 THEN 'budget' END AS disq,
         'TC' || CAST(c.c_nationkey AS VARCHAR) AS tracking_code,
         CASE WHEN c.c_custkey % 4 = 0 THEN 'Yes' END AS isr_review,
         'L' || CAST(c.c_custkey AS VARCHAR) AS salesforce_lead_id
  FROM customer c LEFT JOIN span ON c.c_custkey = span.o_custkey),
mem AS (SELECT c_custkey AS contact_id, CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 31 ELSE 30 END AS list_id,
               c_acctbal < -900 AS deleted FROM customer
        UNION ALL SELECT c_custkey, 30, false FROM customer WHERE c_acctbal > 9900),
lc AS (SELECT ct.* FROM mem JOIN ct ON mem.contact_id = ct.id WHERE mem.list_id = 30 AND mem.deleted = false),
comp AS (SELECT CAST(n_nationkey AS BIGINT) AS cid, CASE WHEN n_nationkey <> 4 THEN n_name END AS property_name FROM nation),
eng AS (SELECT event_id, user_id AS contact_id, event_type, value, ts AS created_at,
               CASE event_type WHEN 'click' THEN 'EMAIL' WHEN 'view' THEN 'INCOMING_EMAIL' WHEN 'purchase' THEN 'CALL'
                               WHEN 'signup' THEN 'MEETING' ELSE 'TASK' END AS type
        FROM events),
meet AS (SELECT event_id AS engagement_id,
                CASE event_id % 3 WHEN 0 THEN 'Excited for your TOUR!' WHEN 1 THEN 'Learn more about the space'
                                  ELSE 'Weekly sync' END AS title,
                ts + INTERVAL 1 DAY AS start_time FROM events WHERE event_type = 'signup'),
tours AS (SELECT eng.contact_id, ct.property_email,
                 CASE WHEN regexp_matches(lower(meet.title), 'excited for your tour|tour of the space') THEN 'Tour'
                      ELSE 'Call' END AS meeting_type,
                 meet.start_time AS tour_time, eng.created_at AS create_time
          FROM meet JOIN eng ON meet.engagement_id = eng.event_id JOIN ct ON eng.contact_id = ct.id
          WHERE regexp_matches(lower(meet.title), 'excited for your tour|learn more about the space|tour of the space'))
"""


def _sched(kind: str) -> str:
    k = kind.lower()
    return f"""
SELECT property_email, count(*) AS total_scheduled_{k}s,
       CAST(CASE WHEN count(tour_time) = count(*) THEN max(tour_time) END AS DATE) AS most_recent_scheduled_{k},
       CAST(CASE WHEN count(create_time) = count(*) THEN min(create_time) END AS DATE) AS first_created_scheduled_{k}
FROM tours WHERE meeting_type = '{kind}' GROUP BY property_email"""


CONTACT_MART = rf"""
sc AS ({_sched('Call')}),
st AS ({_sched('Tour')}),
em AS (SELECT contact_id AS id, min(created_at) FILTER (WHERE type = 'EMAIL') AS first_outbound_email,
              min(created_at) FILTER (WHERE type = 'INCOMING_EMAIL') AS first_email_response
       FROM eng WHERE event_type IN ('click', 'view') GROUP BY contact_id),
cb AS (SELECT contact_id AS id, CASE WHEN count(created_at) = count(*) THEN min(created_at) END AS first_outbound_call,
              min(created_at) FILTER (WHERE event_id % 8 = 1) AS first_call_connected
       FROM eng WHERE event_type = 'purchase' GROUP BY contact_id),
f AS (SELECT lc.*, comp.property_name FROM lc LEFT JOIN comp ON lc.property_associatedcompanyid IS NOT DISTINCT FROM comp.cid
      WHERE NOT {_m('TEST', 'lc.property_lastname')} AND NOT {_m('TEST', 'lc.property_firstname')}
        AND NOT {_m('ownco', 'lc.property_company')}
        AND (lc.property_lifecyclestage IS NULL OR lc.property_lifecyclestage NOT IN ('subscriber', 'other'))),
g AS (SELECT *, CAST(property_createdate AS DATE) AS create_date,
        CASE WHEN drill = '3rd Party Aggregator' OR NOT {_m('offline', 'src')} THEN 'Marketing'
             WHEN d1 = 'SALESFORCE' OR src = 'OFFLINE' THEN 'Sales'
             WHEN {_m('broker', 'd1')} OR team_ids = 'team-9' THEN 'Broker'
             WHEN {_m('enterprise', 'd1')} THEN 'Enterprise' ELSE 'Local' END AS acquisition_channel,
        CASE WHEN src = 'DIRECT_TRAFFIC' THEN 'Direct' WHEN src = 'ORGANIC_SEARCH' THEN 'Organic'
             WHEN src IN ('PAID_SEARCH', 'PAID_SOCIAL') THEN 'Paid' WHEN drill = '3rd Party Aggregator' THEN 'Aggregator'
             WHEN src = 'OFFLINE' THEN 'N/A' ELSE 'Other' END AS digital_channel
      FROM f),
h AS (SELECT *,
        CASE WHEN digital_channel = 'Paid' AND {_m('lead.gen', 'd2', False)} THEN 'Off-platform(' || coalesce(d1, 'NA') || ')'
             WHEN digital_channel = 'Direct' AND {_m('own\\.example/$', 'd1')} THEN 'Direct(homepage)'
             WHEN digital_channel = 'Direct' AND {_m('blog', 'd1')} THEN 'Direct(blog)'
             WHEN digital_channel = 'Direct' AND {_m('own\\.example', 'd1')} THEN 'Direct(website)'
             WHEN digital_channel = 'Direct' AND {_m('meetings\\.example', 'd1')} THEN 'Direct(meeting link)'
             WHEN digital_channel = 'Direct' THEN 'Direct(other)'
             WHEN digital_channel = 'Organic' THEN lower(d2)
             WHEN digital_channel = 'Other' AND src = 'SOCIAL_MEDIA' THEN 'Social(' || coalesce(lower(d1), 'NA') || ')'
             WHEN digital_channel = 'Paid' AND {_m('facebook', 'd1')} THEN 'Paid Social(Facebook)'
             WHEN digital_channel = 'Paid' AND {_m('linkedin', 'd1')} THEN 'Paid Social(LinkedIn)'
             WHEN digital_channel = 'Paid' AND {_m('auto-tagged', 'd1')} THEN 'Paid Search(Google)'
             WHEN digital_channel = 'Paid' AND {_m('google|adwords', 'first_ref')} THEN 'Paid Search(Google)'
             WHEN digital_channel = 'Other' THEN lower(src)
             WHEN digital_channel = 'N/A' THEN lower(drill)
             ELSE 'Other' END AS acquisition_source
      FROM g),
j AS (SELECT h.*, sc.total_scheduled_calls, sc.most_recent_scheduled_call, sc.first_created_scheduled_call,
             st.total_scheduled_tours, st.most_recent_scheduled_tour, st.first_created_scheduled_tour,
             em.first_outbound_email, em.first_email_response, cb.first_outbound_call, cb.first_call_connected
      FROM h LEFT JOIN sc ON h.property_email IS NOT DISTINCT FROM sc.property_email
      LEFT JOIN st ON h.property_email IS NOT DISTINCT FROM st.property_email
      LEFT JOIN em ON h.id IS NOT DISTINCT FROM em.id
      LEFT JOIN cb ON h.id IS NOT DISTINCT FROM cb.id)
SELECT id AS contact_id, coalesce(loc_i, 'Not Specified') AS location, property_firstname AS first_name,
       property_lastname AS last_name, property_email AS contact_email, coalesce(property_name, property_company) AS company,
       property_associatedcompanyid AS company_id, coalesce(svc_i, ws_i, 'Not Specified') AS product,
       property_lifecyclestage AS lifecycle_stage, create_date,
       CAST(date_trunc('week', create_date) AS DATE) AS create_week,
       CAST(date_trunc('month', create_date) AS DATE) AS create_month,
       CAST(date_trunc('quarter', create_date) AS DATE) AS create_quarter,
       CAST(isodow(create_date) AS INTEGER) AS create_wday,
       lead_date, mql_date, CAST(NULL AS TIMESTAMP) AS sql_date, CAST(NULL AS TIMESTAMP) AS oppty_date,
       CAST(NULL AS TIMESTAMP) AS customer_date, disq AS disqualify_reason, coalesce(p_budget, p_amount) AS budget,
       total_scheduled_calls, most_recent_scheduled_call, first_created_scheduled_call, total_scheduled_tours,
       most_recent_scheduled_tour, first_created_scheduled_tour, first_outbound_email, first_email_response,
       first_outbound_call, first_call_connected, coalesce(p_start, p_move_in) AS desired_move_in_date, tracking_code,
       digital_channel, acquisition_channel, acquisition_source, regexp_replace(first_url, '\?.*$', '') AS first_page,
       isr_review, salesforce_lead_id, CAST(NULL AS VARCHAR) AS salesforce_contact_id,
       CASE WHEN CAST(first_created_scheduled_tour IS NULL AS INTEGER)
                 + CAST(first_created_scheduled_call IS NULL AS INTEGER) = 2 THEN 0 ELSE 1 END AS scheduled_meeting,
       CASE WHEN CAST(first_email_response IS NULL AS INTEGER) + CAST(first_call_connected IS NULL AS INTEGER) < 2
            THEN 1 ELSE 0 END AS engaged_contact,
       coalesce(first_outbound_email, TIMESTAMP '2024-02-01 00:00:00') AS first_outreach,
       CASE WHEN CAST(first_outbound_call IS NULL AS INTEGER) + CAST(first_outbound_email IS NULL AS INTEGER) = 2
            THEN 1 ELSE 0 END AS no_outreach,
       round_even((epoch_us(coalesce(first_outbound_email, TIMESTAMP '2024-02-01 00:00:00')) - epoch_us(lead_date))
                  / 3.6e9, 1) AS time_to_first_contact
FROM j
"""

ORACLE["contact_mart"] = f"WITH {CONTACT_SOURCES}, {CONTACT_MART}"

# ---------------------------------------------------------------- rep activity marts and location hierarchy

_CM_SPLIT = CONTACT_MART.index("SELECT id AS contact_id")
CONTACT_MART_CTE = CONTACT_MART[:_CM_SPLIT] + ", cm AS (" + CONTACT_MART[_CM_SPLIT:] + ")"

REP = r"""
reng AS (
  SELECT user_id AS contact_id, 'Call' AS engagement_type, ts AS created_at,
         CASE event_id % 8 WHEN 0 THEN 'Busy' WHEN 1 THEN 'Connected' WHEN 2 THEN 'Left live message'
              WHEN 3 THEN 'Left voicemail' WHEN 4 THEN 'No answer' WHEN 5 THEN 'Wrong number'
              WHEN 6 THEN '00000000-0000-0000-0000-000000000000' END AS status, '' AS subject,
         CASE WHEN event_id % 2 = 0 THEN 'call notes ' || event_id % 5 END AS body
  FROM events WHERE event_type = 'purchase' AND value < 50
  UNION
  SELECT user_id, 'Meeting', ts, '',
         CASE event_id % 3 WHEN 0 THEN 'Excited for your TOUR!' WHEN 1 THEN 'Learn more about the space'
              ELSE 'Weekly sync' END, 'agenda ' || event_id % 3
  FROM events WHERE event_type = 'signup' AND value < 50
  UNION
  SELECT user_id, 'Email', ts, CASE WHEN value > 60 THEN 'BOUNCED' ELSE 'SENT' END,
         'subject ' || CAST(user_id AS VARCHAR), CASE WHEN event_id % 3 <> 0 THEN 'mail ' || event_id % 4 END
  FROM events WHERE event_type = 'click' AND value < 50),
tdet AS (SELECT event_id, CASE WHEN value > 30 THEN 'CALL' ELSE 'EMAIL' END AS task_type,
                CASE WHEN value < 100 THEN epoch_us(ts) // 1000 + CAST(floor(value * 3600000.0) AS BIGINT) END
                  AS completion_date,
                CASE WHEN value < 100 THEN 'COMPLETED' WHEN value <= 150 THEN 'NOT_STARTED' END AS status
         FROM events WHERE event_type = 'error' AND value > 1),
rtask AS (SELECT e.user_id AS contact_id, t.task_type, e.ts AS created_at,
                 make_timestamp((t.completion_date // 1000) * 1000000) AS completed_date, t.status
          FROM events e LEFT JOIN tdet t ON e.event_id = t.event_id
          WHERE e.event_type = 'error' AND e.value < 50),
lm AS (SELECT n.n_name AS hs_locations, r.r_name AS city, lower(n.n_name) AS site_name
       FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey)
"""

ACTIVITY_SUMMARY = r"""
ts1 AS (SELECT contact_id, count(*) AS num_tasks, count(*) FILTER (WHERE status = 'COMPLETED') AS completed_tasks,
               CASE WHEN count(created_at) = count(*) THEN min(created_at) END AS first_task_create_date,
               CASE WHEN count(completed_date) = count(*) THEN min(completed_date) END AS first_task_completed_date
        FROM rtask GROUP BY contact_id),
ts2 AS (SELECT *, round_even((epoch_us(first_task_completed_date) - epoch_us(first_task_create_date)) / 3.6e9, 1)
                  AS time_to_first_completed_task FROM ts1),
hist AS (SELECT user_id AS contact_id, ts AS timestamp, CASE WHEN value < 5 THEN 'Yes' ELSE 'No' END AS status
         FROM events WHERE event_type = 'view' AND value < 10),
hl AS (SELECT contact_id, CAST(timestamp AS DATE) AS isr_status_date
       FROM (SELECT *, row_number() OVER (PARTITION BY contact_id ORDER BY timestamp DESC, status ASC) AS rn FROM hist)
       WHERE rn = 1),
sj AS (SELECT ts2.*, hl.isr_status_date, reng.engagement_type, reng.created_at AS eng_at
       FROM ts2 LEFT JOIN hl ON ts2.contact_id IS NOT DISTINCT FROM hl.contact_id
       LEFT JOIN reng ON ts2.contact_id IS NOT DISTINCT FROM reng.contact_id),
sg AS (SELECT contact_id, num_tasks, completed_tasks, first_task_create_date, first_task_completed_date,
              time_to_first_completed_task, isr_status_date,
              count(engagement_type) AS total_engagements,
              CASE WHEN count(engagement_type) = count(*)
                   THEN CAST(sum(CAST(engagement_type = 'Email' AS BIGINT)) AS BIGINT) END AS email_engagements,
              CASE WHEN count(engagement_type) = count(*)
                   THEN CAST(sum(CAST(engagement_type = 'Call' AS BIGINT)) AS BIGINT) END AS phone_engagements,
              CASE WHEN count(eng_at) = count(*) THEN min(eng_at) END AS first_eng
       FROM sj GROUP BY contact_id, num_tasks, completed_tasks, first_task_create_date, first_task_completed_date,
                        time_to_first_completed_task, isr_status_date),
ss AS (SELECT contact_id, num_tasks, completed_tasks, CAST(first_task_create_date AS DATE) AS first_task_create_date,
              CAST(first_task_completed_date AS DATE) AS first_task_completed_date, time_to_first_completed_task,
              isr_status_date, total_engagements, email_engagements, phone_engagements,
              round_even((epoch_us(first_eng) - epoch_us(first_task_create_date)) / 3.6e9, 1) AS time_to_first_engagement
       FROM sg),
sm AS (SELECT ss.*, cm.create_date AS contact_create_date, cm.isr_review, cm.lifecycle_stage, cm.location, cm.product
       FROM ss JOIN cm ON ss.contact_id IS NOT DISTINCT FROM cm.contact_id)
SELECT sm.contact_id, num_tasks, completed_tasks, first_task_create_date, first_task_completed_date,
       time_to_first_completed_task, isr_status_date, total_engagements, email_engagements, phone_engagements,
       time_to_first_engagement, contact_create_date, coalesce(isr_review, 'Not Specified') AS isr_review,
       coalesce(lifecycle_stage, 'Not Specified') AS lifecycle_stage, coalesce(location, 'Not Specified') AS location,
       coalesce(product, 'Not Specified') AS product, coalesce(lm.city, 'Not Specified') AS city,
       coalesce(lm.site_name, 'Not Specified') AS site_name
FROM sm LEFT JOIN lm ON sm.location IS NOT DISTINCT FROM lm.hs_locations
"""

ORACLE["activity_summary"] = f"WITH {CONTACT_SOURCES}, {CONTACT_MART_CTE}, {REP}, {ACTIVITY_SUMMARY}"

ORACLE["activity_detail"] = f"""
WITH {CONTACT_SOURCES}, {CONTACT_MART_CTE}, {REP},
dj AS (SELECT reng.*, cm.location, cm.product FROM reng LEFT JOIN cm ON reng.contact_id IS NOT DISTINCT FROM cm.contact_id
       WHERE reng.engagement_type IN ('Email', 'Call')),
dg AS (SELECT CAST(created_at AS DATE) AS engagement_date, engagement_type, location AS loc, product AS prod,
              count(*) AS engagements FROM dj GROUP BY 1, 2, 3, 4),
dc AS (SELECT engagement_date, engagement_type, coalesce(loc, 'Not Specified') AS location,
              coalesce(prod, 'Not Specified') AS product, engagements FROM dg)
SELECT dc.*, coalesce(lm.city, 'Not Specified') AS city, coalesce(lm.site_name, 'Not Specified') AS site_name
FROM dc LEFT JOIN lm ON dc.location IS NOT DISTINCT FROM lm.hs_locations
"""

ORACLE["geo_hierarchy"] = """
WITH b AS (
  SELECT DISTINCT 'LOC' || CAST(c.c_nationkey AS VARCHAR) AS location_id, n.n_name AS unit_name,
         'hood ' || c.c_mktsegment AS neighborhood_name_c,
         CASE WHEN c.c_nationkey < 12 THEN 'sub ' || CAST(c.c_nationkey AS VARCHAR) END AS submarket_temp_c,
         n.n_name AS city_c, CAST(NULL AS VARCHAR) AS state_province_c, r.r_name AS sub_region_c,
         n.n_name AS country_c, r.r_name AS region_c
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey)
SELECT location_id, unit_name AS unit, coalesce(submarket_temp_c, neighborhood_name_c) AS submarket, city_c AS city,
       state_province_c AS state, country_c AS country, sub_region_c AS sub_region, region_c AS region FROM b
UNION ALL
SELECT 'Not Specified', 'Not Specified', 'Not Specified', 'Not Specified', 'Not Specified', 'Not Specified',
       'Not Specified', 'Not Specified'
"""

# ---------------------------------------------------------------- five-network marketing spend (+ allocation)

_MONEY = "CAST(sum(CAST({} AS DECIMAL(28,6))) AS DOUBLE)"


def _search(flag_cond: str) -> str:
    return f"""
SELECT p.p_name AS campaign_name, CAST(l.l_shipdate AS DATE) AS date, CAST(l.l_quantity * 10 AS BIGINT) AS impressions,
       CAST(l.l_quantity AS BIGINT) AS clicks, CAST(l.l_linenumber AS DOUBLE) AS conversions, l.l_extendedprice AS cost
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey WHERE {flag_cond}"""


def _search_leg(src: str) -> str:
    return f"""
SELECT campaign_name, date AS campaign_date, CAST(sum(impressions) AS BIGINT) AS impressions,
       CAST(sum(clicks) AS BIGINT) AS clicks, sum(conversions) AS conversions, {_MONEY.format('cost')} AS spend,
       'Google' AS source
FROM {src} GROUP BY date, campaign_name"""


SPEND = f"""
la AS (SELECT l_partkey AS campaign_id, l_shipdate AS day, CAST(l_quantity * 10 AS BIGINT) AS impressions,
              CAST(l_quantity AS BIGINT) AS clicks, CAST(l_linenumber AS BIGINT) AS conv, l_extendedprice AS cost
       FROM lineitem WHERE l_returnflag = 'A' AND l_linestatus = 'F'),
lc AS (SELECT p_partkey AS id, CAST(p_size AS BIGINT) AS gid,
              CAST(CASE WHEN p_brand = 'Brand#1' THEN 999 WHEN p_brand = 'Brand#2' THEN 998 ELSE 1 END AS BIGINT) AS account_id FROM part),
lg AS (SELECT CAST(p_size AS BIGINT) AS id, p_type || ' group' AS name,
              CASE WHEN p_partkey % 7 <> 0 THEN TIMESTAMP '2024-01-01 00:00:00' + to_seconds(p_partkey) END AS lmt
       FROM part),
lgl AS (SELECT id, name FROM (SELECT *, rank() OVER (PARTITION BY id ORDER BY lmt DESC NULLS FIRST) AS pos FROM lg)
        WHERE pos = 1),
leg_li AS (SELECT lgl.name AS campaign_name, CAST(la.day AS DATE) AS campaign_date, la.impressions, la.clicks,
                  CAST(la.conv AS DOUBLE) AS conversions, la.cost AS spend, 'LinkedIn' AS source
           FROM la JOIN lc ON la.campaign_id = lc.id JOIN lgl ON lc.gid = lgl.id WHERE lc.account_id NOT IN (999)),
br AS (SELECT l_partkey AS campaign_id, CAST(l_shipdate AS DATE) AS date, CAST(l_quantity * 10 AS BIGINT) AS impressions,
              CAST(l_quantity AS BIGINT) AS clicks, CAST(l_linenumber AS BIGINT) AS conversions, l_extendedprice AS spend
       FROM lineitem WHERE l_returnflag = 'A' AND l_linestatus = 'O'),
bc AS (SELECT DISTINCT id, name FROM (SELECT p_partkey AS id, p_name AS name FROM part
                                      UNION ALL SELECT p_partkey, p_name || ' (renamed)' FROM part WHERE p_size > 45)),
leg_bing AS (SELECT bc.name AS campaign_name, br.date AS campaign_date, CAST(sum(br.impressions) AS BIGINT) AS impressions,
                    CAST(sum(br.clicks) AS BIGINT) AS clicks, CAST(sum(br.conversions) AS DOUBLE) AS conversions,
                    {_MONEY.format('br.spend')} AS spend, 'Bing' AS source
             FROM br JOIN bc ON br.campaign_id = bc.id GROUP BY bc.name, br.date),
fa AS (SELECT p.p_name AS campaign_name, CAST(l.l_shipdate AS DATE) AS date, l.l_orderkey AS ad_id,
              CASE WHEN l.l_suppkey = 1 THEN 998 WHEN l.l_suppkey = 2 THEN 999 ELSE 2 END AS account_id,
              CAST(l.l_quantity * 10 AS BIGINT) AS impressions, CAST(l.l_quantity AS BIGINT) AS inline_link_clicks,
              l.l_extendedprice AS spend
       FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey WHERE l.l_returnflag = 'N' AND l.l_linestatus = 'F'),
fx AS (SELECT CAST(l_shipdate AS DATE) AS date, l_orderkey AS ad_id,
              CASE WHEN l_discount > 0.05 THEN 'onsite_conversion.post_save' WHEN l_discount > 0.02 THEN 'leadgen.other'
                   ELSE 'link_click' END AS action_type
       FROM lineitem WHERE l_returnflag = 'N' AND l_linestatus = 'F'),
fc AS (SELECT date, ad_id, count(*) AS conversions FROM fx
       WHERE action_type IN ('onsite_conversion.post_save', 'leadgen.other') GROUP BY date, ad_id),
leg_fb AS (SELECT fa.campaign_name, fa.date AS campaign_date, fa.impressions, fa.inline_link_clicks AS clicks,
                  CAST(fc.conversions AS DOUBLE) AS conversions, fa.spend, 'Facebook' AS source
           FROM fa LEFT JOIN fc ON fa.ad_id = fc.ad_id AND fa.date = fc.date WHERE fa.account_id NOT IN (998)),
sm AS ({_search("l.l_returnflag = 'N' AND l.l_linestatus = 'O'")}),
su AS ({_search("l.l_returnflag = 'R'")}),
spend AS (SELECT * FROM leg_li UNION SELECT * FROM leg_bing UNION SELECT * FROM leg_fb
          UNION {_search_leg('sm')} UNION {_search_leg('su')})
"""

ORACLE["marketing_spend"] = f"WITH {SPEND} SELECT * FROM spend"

ORACLE["marketing_spend_allocated"] = f"""
WITH {SPEND},
f AS (SELECT campaign_name, campaign_date, coalesce(impressions, 0) AS impressions, coalesce(clicks, 0) AS clicks,
             coalesce(conversions, 0) AS conversions, coalesce(spend, 0) AS spend, source FROM spend),
p AS (SELECT *,
        CASE WHEN {_m('ring', 'campaign_name')} THEN 'Suite' WHEN {_m('gear', 'campaign_name')} THEN 'Room'
             WHEN {_m('bolt', 'campaign_name')} THEN 'Desk' ELSE 'Non-Specific' END AS product,
        CASE WHEN {_m('small', 'campaign_name')} THEN 'North' WHEN {_m('red', 'campaign_name')} THEN 'South'
             WHEN {_m('blue', 'campaign_name')} THEN 'West' ELSE 'Non-Specific' END AS market
      FROM f)
SELECT *, CAST(date_trunc('week', campaign_date) AS DATE) AS spend_week,
       CAST(date_trunc('month', campaign_date) AS DATE) AS spend_month,
       CASE WHEN product = 'Suite' THEN spend WHEN product = 'Non-Specific' THEN spend * CAST(0.4 AS DOUBLE) ELSE 0.0 END
         AS suite,
       CASE WHEN product = 'Desk' THEN spend WHEN product = 'Non-Specific' THEN spend * CAST(0.4 AS DOUBLE) ELSE 0.0 END
         AS desk,
       CASE WHEN product = 'Room' THEN spend WHEN product = 'Non-Specific' THEN spend * CAST(0.2 AS DOUBLE) ELSE 0.0 END
         AS room
FROM p
"""

# ---------------------------------------------------------------- workspace extracts

_T0 = "TIMESTAMP '2024-01-01 00:00:00'"


def _latest(src: str, keys: str, order: str) -> str:
    return (f"(SELECT * EXCLUDE (pos) FROM (SELECT *, rank() OVER (PARTITION BY {keys} ORDER BY {order} DESC NULLS FIRST)"
            f" AS pos FROM {src}) WHERE pos = 1)")


WORKSPACE = f"""
cw AS (SELECT c_custkey AS id, lower(c_name) || '@member.example' AS email, CAST(NULL AS VARCHAR) AS billingemail,
              c_mktsegment AS custom6, CASE WHEN c_acctbal > 0 THEN 'Paying' ELSE 'Guest' END AS custom8,
              c_custkey // 10 AS teamid, {_T0} AS updatedon FROM customer
       UNION ALL
       SELECT c_custkey, lower(c_name) || '@member.example', CAST(NULL AS VARCHAR), c_mktsegment,
              CASE WHEN c_acctbal > 0 THEN 'Paying' ELSE 'Guest' END, c_custkey // 10 + 1, {_T0} + INTERVAL 2 DAY
       FROM customer WHERE c_acctbal > 9000),
tm AS (SELECT c_custkey // 10 AS id, CAST(c_nationkey + 1 AS BIGINT) AS businessid, c_custkey // 10 + 1000 AS payingmemberid,
              (c_custkey // 10) % 2 = 0 AS sharetimepasses, (c_custkey // 10) % 3 = 0 AS shareextraservices,
              true AS sharebookingcredit, false AS discountextraservices, 'm' || CAST(c_custkey AS VARCHAR) AS coworkerids,
              '' AS activecontracts,
              CASE WHEN c_custkey // 10 <> 0 THEN 'Team ' || CAST(c_custkey // 10 AS VARCHAR) || ' ' || lower(c_mktsegment)
                   END AS name,
              {_T0} + to_days(c_nationkey) AS updatedon
       FROM customer),
sizes AS (SELECT DISTINCT CAST(p_size AS BIGINT) AS id FROM part),
biz AS (SELECT id, 'Site ' || CAST(id AS VARCHAR) AS name, {_T0} AS updatedon FROM sizes
        UNION ALL SELECT id, 'Site ' || CAST(id AS VARCHAR) || ' (moved)', {_T0} + INTERVAL 3 DAY FROM sizes WHERE id > 45)
"""

ORACLE["meeting_bookings"] = f"""
WITH {WORKSPACE},
bk AS (SELECT l.l_orderkey AS id, o.o_custkey AS coworkerid, 'Member ' || CAST(o.o_custkey AS VARCHAR) AS coworkerfullname,
              l.l_partkey AS resourceid, 'Room ' || CAST(l.l_partkey AS VARCHAR) AS resourcename,
              'Meeting room' AS resourceresourcetypename, o.o_orderpriority AS teamsatthetimeofbooking,
              'Standard' AS tariffatthetimeofbooking, l.l_shipdate AS fromtime, l.l_shipdate + INTERVAL 1 HOUR AS totime,
              l.l_tax * CAST(100.0 AS DOUBLE) AS coworkerextraserviceprice, l.l_shipdate AS createdon,
              CASE WHEN l.l_linenumber <> 3 THEN l.l_shipdate + to_minutes(l.l_linenumber) END AS updatedon,
              CASE WHEN l.l_returnflag = 'R' THEN 'YES' ELSE 'NO' END AS is_deleted
       FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
vb AS (SELECT DISTINCT * FROM (
         SELECT id AS booking_id, coworkerid, coworkerfullname, resourceid, resourcename, resourceresourcetypename,
                teamsatthetimeofbooking, tariffatthetimeofbooking, fromtime, totime, coworkerextraserviceprice, createdon,
                updatedon, is_deleted,
                CAST(rank() OVER (PARTITION BY id ORDER BY updatedon DESC NULLS FIRST) AS INTEGER) AS pos
         FROM bk) WHERE pos = 1),
res AS (SELECT p_partkey AS id, p_name AS name, p_type AS resourcetypename, CAST(p_size AS BIGINT) AS businessid,
               {_T0} AS updatedon FROM part
        UNION ALL SELECT p_partkey, p_name || ' v2', p_type, CAST(p_size - 1 AS BIGINT), {_T0} + INTERVAL 5 DAY
        FROM part WHERE p_size > 40),
rooms AS (SELECT DISTINCT r.id AS resource_id, b.id AS business_id, b.name AS location, r.name AS room_name,
                 r.resourcetypename AS room_size
          FROM {_latest('biz', 'id', 'updatedon')} b JOIN {_latest('res', 'id', 'updatedon')} r ON b.id = r.businessid),
types AS (SELECT id AS type_id, custom6 AS member_product, custom8 AS member_type FROM {_latest('cw', 'id', 'updatedon')}),
mteams AS (SELECT DISTINCT coworker_id, team_name FROM (
             SELECT cw.id AS coworker_id, t.name AS team_name,
                    rank() OVER (PARTITION BY cw.id, t.id ORDER BY t.updatedon DESC NULLS FIRST) AS pos
             FROM cw JOIN tm t ON cw.teamid = t.id WHERE t.name IS NOT NULL) WHERE pos = 1),
ext AS (SELECT l.l_orderkey * 10 + l.l_linenumber AS id, l.l_orderkey AS bookingid,
               CASE WHEN l.l_linenumber = 2 THEN o.o_custkey + 1 ELSE o.o_custkey END AS coworkerid,
               l.l_extendedprice AS price, l.l_shipdate AS updatedon
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
        UNION ALL
        SELECT l.l_orderkey * 10 + l.l_linenumber, l.l_orderkey,
               CASE WHEN l.l_linenumber = 2 THEN o.o_custkey + 1 ELSE o.o_custkey END, -l.l_extendedprice,
               l.l_shipdate + INTERVAL 1 DAY
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey WHERE l.l_discount = 0),
costs AS (SELECT bookingid,
                 CAST(sum(CASE WHEN CAST(price AS DECIMAL(28,6)) < 0 THEN CAST(price AS DECIMAL(28,6)) ELSE 0 END) AS DOUBLE)
                   AS discount,
                 CAST(sum(CASE WHEN CAST(price AS DECIMAL(28,6)) > 0 THEN CAST(price AS DECIMAL(28,6)) ELSE 0 END) AS DOUBLE)
                   AS gross_price
          FROM {_latest('ext', 'id', 'updatedon')} GROUP BY bookingid, coworkerid),
md AS (SELECT c_custkey AS coworker_id, lower(c_name) || '@member.example' AS email,
              'Company ' || CAST(c_nationkey AS VARCHAR) AS companyname FROM customer)
SELECT vb.*, costs.bookingid, costs.discount, costs.gross_price, md.email, md.companyname, types.member_product,
       types.member_type, rooms.location, rooms.room_size, mteams.team_name
FROM vb JOIN md ON vb.coworkerid = md.coworker_id
LEFT JOIN costs ON vb.booking_id = costs.bookingid
JOIN types ON md.coworker_id = types.type_id
JOIN rooms ON vb.resourceid = rooms.resource_id
LEFT JOIN mteams ON md.coworker_id = mteams.coworker_id
"""

ORACLE["contracts"] = f"""
WITH {WORKSPACE},
ctr AS (SELECT o_orderkey AS id, o_custkey AS coworkerid, CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS tariffid,
               o_orderpriority AS tariffname, CAST(NULL AS VARCHAR) AS nexttariffname, o_orderdate AS createdon,
               o_orderdate AS startdate, o_orderdate + INTERVAL 365 DAY AS renewaldate,
               CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 90 DAY END AS cancellationdate,
               o_orderdate AS invoicedperiod, o_orderdate AS contractterm,
               CASE WHEN o_orderstatus = 'O' THEN 'true' ELSE 'false' END AS active,
               CASE WHEN o_orderstatus = 'F' THEN 'true' ELSE 'false' END AS cancelled,
               '' AS floorplandeskids, '' AS floorplandesknames, 'C' || CAST(o_orderkey AS VARCHAR) AS uniqueid,
               o_totalprice / CAST(100.0 AS DOUBLE) AS tariffprice, o_orderdate AS updatedon FROM orders
        UNION ALL
        SELECT o_orderkey, o_custkey, CAST(substr(o_orderpriority, 1, 1) AS BIGINT), o_orderpriority,
               CAST(NULL AS VARCHAR), o_orderdate, o_orderdate, o_orderdate + INTERVAL 365 DAY,
               CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 90 DAY END, o_orderdate, o_orderdate,
               CASE WHEN o_orderstatus = 'O' THEN 'true' ELSE 'false' END,
               CASE WHEN o_orderstatus = 'F' THEN 'true' ELSE 'false' END, '', '', 'C' || CAST(o_orderkey AS VARCHAR),
               o_totalprice / CAST(50.0 AS DOUBLE), o_orderdate + INTERVAL 30 DAY
        FROM orders WHERE o_orderstatus = 'P'),
inv AS (SELECT l_orderkey * 10 + l_linenumber AS id,
               CASE WHEN l_linenumber = 7 THEN '' WHEN l_linenumber = 6 THEN NULL ELSE 'C' || CAST(l_orderkey AS VARCHAR) END
                 AS contractguid,
               l_extendedprice AS totalamount, CASE WHEN l_linestatus = 'F' THEN l_extendedprice ELSE 0.0 END AS paidamount,
               l_shipdate AS updatedon FROM lineitem
        UNION ALL
        SELECT l_orderkey * 10 + l_linenumber,
               CASE WHEN l_linenumber = 7 THEN '' WHEN l_linenumber = 6 THEN NULL ELSE 'C' || CAST(l_orderkey AS VARCHAR) END,
               l_extendedprice + CAST(10.0 AS DOUBLE), 0.0, l_shipdate + INTERVAL 1 DAY FROM lineitem WHERE l_discount = 0),
cp AS (SELECT contractguid, count(*) AS num_periods,
              CAST(sum(CAST(totalamount AS DECIMAL(28,6))) AS DOUBLE) AS total_billed,
              CAST(sum(CAST(paidamount AS DECIMAL(28,6))) AS DOUBLE) AS total_paid
       FROM {_latest('inv', 'id', 'updatedon')} WHERE contractguid IS NOT NULL AND contractguid <> ''
       GROUP BY contractguid),
tf AS (SELECT DISTINCT o_orderpriority FROM orders),
tar AS (SELECT CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS id, 'Main site' AS businessname, o_orderpriority AS name,
               CAST(CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS DOUBLE) * CAST(100.0 AS DOUBLE) AS price,
               {_T0} AS hdp_created_ts FROM tf
        UNION ALL
        SELECT 1, 'Main site', o_orderpriority || ' plus', CAST(150.0 AS DOUBLE), {_T0} + INTERVAL 7 DAY FROM tf
        WHERE CAST(substr(o_orderpriority, 1, 1) AS BIGINT) = 1),
pn AS (SELECT id AS plan_id, businessname, name AS plan_name, price AS plan_price
       FROM {_latest('tar', 'id', 'hdp_created_ts')}),
ct AS (SELECT id, email, billingemail, custom6 AS product, custom8 AS customer_role, teamid
       FROM {_latest('cw', 'id', 'updatedon')}),
tl AS (SELECT id AS team_id, name AS team_name FROM {_latest('tm', 'id', 'updatedon')})
SELECT cc.coworkerid, cc.tariffid, cc.tariffname, cc.nexttariffname, cc.createdon, cc.startdate, cc.renewaldate,
       cc.cancellationdate, cc.invoicedperiod, cc.contractterm, cc.active, cc.cancelled, cc.floorplandeskids,
       cc.floorplandesknames, cc.uniqueid, cc.tariffprice, ct.*, cp.*, pn.businessname, pn.plan_name, pn.plan_price,
       tl.team_name
FROM {_latest('ctr', 'id', 'updatedon')} cc JOIN ct ON cc.coworkerid = ct.id
LEFT JOIN cp ON cc.uniqueid = cp.contractguid
LEFT JOIN pn ON cc.tariffid = pn.plan_id
LEFT JOIN tl ON ct.teamid = tl.team_id
"""

ORACLE["teams"] = f"""
WITH {WORKSPACE}
SELECT nt.id, nt.businessid, nt.name AS business_team_name, nt.payingmemberid, nt.sharetimepasses,
       nt.shareextraservices, nt.sharebookingcredit, nt.discountextraservices, nt.coworkerids, nt.activecontracts,
       b.name AS location
FROM {_latest('tm', 'id', 'updatedon')} nt JOIN {_latest('biz', 'id', 'updatedon')} b ON nt.businessid = b.id
"""

ORACLE["spaces"] = f"""
SELECT p_partkey AS id, p_name AS name, CAST(p_size AS BIGINT) AS floorplanid, p_type AS floorplanname,
       'Site ' || CAST(p_size AS VARCHAR) AS floorplanbusinessname, CAST(p_size AS DOUBLE) AS size,
       CAST(p_size AS BIGINT) AS capacity, p_partkey AS coworkerid, '' AS coworkercontractids,
       '' AS coworkercontractstartdates, {_T0} AS createdon, {_T0} + INTERVAL 1 DAY AS updatedon
FROM part WHERE p_size <= 48
"""

# ---------------------------------------------------------------- save-only extracts

ORACLE["pipeline_moves"] = """
WITH h AS (SELECT user_id + 100000 AS deal_id,
                  CASE WHEN event_type IN ('click', 'view') THEN 'default' WHEN event_type = 'signup' THEN 'other'
                       ELSE 'archive' END AS value FROM events)
SELECT deal_id, 'yes' AS broker_pipeline FROM h WHERE value IN ('default', 'other')
GROUP BY deal_id HAVING count(DISTINCT value) = 2
"""

ORACLE["second_pipeline_history"] = f"""
WITH ph AS (SELECT user_id + 100000 AS deal_id,
                   CASE WHEN value < 19 THEN 'deal_pipeline_stage_id' ELSE 'dealname' END AS name,
                   'st_' || event_type AS value, ts AS timestamp, 'CRM_UI' AS source,
                   CAST(event_id AS VARCHAR) AS source_id FROM events WHERE value < 20),
types AS (SELECT DISTINCT event_type FROM events),
stages AS (SELECT 'st_' || event_type AS stage_id, 'default' AS pipeline_id, {_HS_LABEL} AS label FROM types
           UNION ALL SELECT 'st_' || event_type, 'other', upper(event_type) FROM types)
SELECT ph.deal_id, ph.name, date_trunc('minute', ph.timestamp) AS date_created, s.label AS pipeline_stage,
       ph.source_id, ph.source
FROM ph JOIN stages s ON ph.value = s.stage_id AND s.pipeline_id = 'other'
WHERE ph.name = 'deal_pipeline_stage_id'
"""

ORACLE["form_hits"] = r"""
WITH n AS (SELECT max(page_id) + 1 AS n FROM pages),
h AS (SELECT lower(regexp_extract(p.url, '^[A-Za-z]+://([^/?#:]+)', 1)) AS page_hostname,
             regexp_extract(p.url, '^[A-Za-z]+://[^/?#]+([^?#]*)', 1) AS page_page_path,
             date_trunc('hour', e.ts) AS visit_start_time, e.user_id AS visit_id,
             CASE WHEN e.event_type IN ('signup', 'purchase', 'click') THEN 'lead form' ELSE 'page' END
               AS event_info_category,
             CASE WHEN e.event_type = 'signup' THEN 'lead form viewed'
                  WHEN e.event_type = 'purchase' THEN 'lead form submitted'
                  WHEN e.event_type = 'click' THEN 'lead form closed' ELSE 'scroll' END AS event_info_action
      FROM events e JOIN pages p ON e.event_id % (SELECT n FROM n) = p.page_id)
SELECT page_hostname, page_page_path, visit_start_time, visit_id, event_info_action, count(*) AS count
FROM h WHERE event_info_category = 'lead form' AND event_info_action IN ('lead form viewed', 'lead form submitted')
GROUP BY page_hostname, page_page_path, visit_start_time, visit_id, event_info_action
"""

ORACLE["deleted_deals"] = """
SELECT user_id + 100000 AS deal_id FROM events WHERE event_type = 'error' AND value < 100
UNION
SELECT user_id + 100000 FROM events WHERE event_type = 'view' AND value > 150
"""

ORACLE["tours"] = """
WITH b AS (SELECT 'B' || CAST(n_nationkey AS VARCHAR) AS b_id, n_name AS unit FROM nation),
c AS (SELECT 'CT' || CAST(c_custkey AS VARCHAR) AS c_id, c_name AS contact FROM customer),
o AS (SELECT 'OPP' || CAST(c_custkey AS VARCHAR) AS o_id, 'B' || CAST(c_nationkey AS VARCHAR) AS building_fill_c
      FROM customer),
awt AS (SELECT 'AT' || CAST(o_orderkey AS VARCHAR) AS id, 'B' || CAST(o_custkey % 30 AS VARCHAR) AS building_c,
               'CT' || CAST(o_custkey AS VARCHAR) AS contact_c, 'Tour ' || o_orderstatus AS name,
               o_orderdate AS created_date, CAST(o_orderdate AS DATE) + 7 AS date_toured_c,
               o_orderstatus = 'F' AS is_deleted
        FROM orders WHERE o_orderpriority = '1-URGENT'),
ev AS (SELECT 'EV' || CAST(event_id AS VARCHAR) AS id, 'OPP' || CAST(user_id AS VARCHAR) AS what_id,
              'CT' || CAST(user_id AS VARCHAR) AS who_id,
              CASE event_type WHEN 'signup' THEN 'Tour booked' WHEN 'click' THEN 'tour follow-up'
                              WHEN 'view' THEN 'Call' ELSE 'Meeting' END AS subject,
              CASE WHEN value < 30 THEN 'about the tour' ELSE 'general' END AS description,
              ts AS created_date, CAST(ts AS DATE) AS activity_date, value > 200 AS is_deleted FROM events)
SELECT awt.id, awt.building_c AS what_id, b.unit, awt.contact_c AS who_id, c.contact, awt.name AS tour_type,
       awt.created_date, awt.date_toured_c AS activity_date, 'Awareness Tours' AS source
FROM awt LEFT JOIN b ON awt.building_c = b.b_id LEFT JOIN c ON awt.contact_c = c.c_id
WHERE awt.is_deleted IS false
UNION
SELECT ev.id, ev.what_id, b.unit, ev.who_id, c.contact, ev.subject AS tour_type, ev.created_date, ev.activity_date,
       'Events' AS source
FROM ev LEFT JOIN o ON ev.what_id = o.o_id LEFT JOIN b ON o.building_fill_c = b.b_id LEFT JOIN c ON ev.who_id = c.c_id
WHERE ev.subject LIKE '%Tour%' OR ev.description LIKE '%tour%' AND ev.is_deleted IS false
"""

ORACLE["access_events"] = """
WITH ev AS (SELECT 'AE' || CAST(event_id AS VARCHAR) AS event_id,
                   CASE WHEN event_type = 'view' THEN 'Access Granted' WHEN event_type = 'error' THEN 'Access denied'
                        ELSE 'Door held' END AS message_short, ts AS published_on, ts AS occurred_on FROM events),
links AS (
  SELECT 'AE' || CAST(event_id AS VARCHAR) AS event_id, 'P' || CAST(user_id AS VARCHAR) AS linked_object_id,
         'person ' || CAST(user_id AS VARCHAR) AS common_name, 'Person' AS relation, ts AS hdp_created_ts FROM events
  UNION ALL
  SELECT 'AE' || CAST(event_id AS VARCHAR), 'P' || CAST(user_id AS VARCHAR),
         'person ' || CAST(user_id AS VARCHAR) || ' (updated)', 'Person', ts + INTERVAL 1 HOUR FROM events WHERE value > 100
  UNION ALL
  SELECT 'AE' || CAST(event_id AS VARCHAR), 'R' || CAST(CAST(floor(value / 50) AS BIGINT) AS VARCHAR),
         'reader ' || CAST(CAST(floor(value / 50) AS BIGINT) AS VARCHAR), 'Reader', ts FROM events
  UNION ALL
  SELECT 'AE' || CAST(event_id AS VARCHAR), 'CTRL', 'controller', 'Controller', ts FROM events
  WHERE event_type = 'signup'),
lo AS (SELECT * FROM (SELECT l.*, rank() OVER (PARTITION BY l.event_id, l.linked_object_id, l.relation
                                               ORDER BY l.hdp_created_ts DESC NULLS FIRST) AS pos
                      FROM ev e JOIN links l ON e.event_id = l.event_id)
       WHERE pos = 1 AND relation IN ('Person', 'Reader')),
pl AS (SELECT 'P' || CAST(c_custkey AS VARCHAR) AS people_id, c_name AS common_name FROM customer),
addr AS (SELECT 'A' || CAST(c_custkey AS VARCHAR) AS address_id, 'P' || CAST(c_custkey AS VARCHAR) AS people_id,
                lower(c_name) || '@mail.example' AS mail_to, TIMESTAMP '2024-01-01 00:00:00' AS hdp_created_ts
         FROM customer
         UNION ALL
         SELECT 'A' || CAST(c_custkey AS VARCHAR), 'P' || CAST(c_custkey AS VARCHAR),
                'new.' || lower(c_name) || '@mail.example', TIMESTAMP '2024-01-02 00:00:00' FROM customer
         WHERE c_acctbal > 5000),
fe AS (SELECT people_id, mail_to AS member_email FROM (
         SELECT *, rank() OVER (PARTITION BY address_id ORDER BY hdp_created_ts DESC NULLS FIRST) AS pos FROM addr)
       WHERE pos = 1)
SELECT ev.event_id, ev.message_short, ev.published_on, ev.occurred_on, pl.common_name AS member_name, fe.member_email,
       lo2.common_name AS reader_name
FROM ev JOIN lo ON ev.event_id = lo.event_id AND lo.relation = 'Person'
JOIN lo lo2 ON ev.event_id = lo2.event_id AND lo2.relation = 'Reader'
JOIN pl ON lo.linked_object_id = pl.people_id
JOIN fe ON pl.people_id = fe.people_id
WHERE ev.message_short IN ('Access Granted', 'Access denied')
"""

ORACLE["crm_activity"] = f"""
WITH u AS (SELECT 'U' || CAST(s_suppkey AS VARCHAR) AS id, 'u' || CAST(s_suppkey AS VARCHAR) AS alias, s_name AS name
           FROM supplier),
op AS (SELECT 'OPP' || CAST(c_custkey AS VARCHAR) AS id, 'RT_' || c_mktsegment AS record_type_id FROM customer),
rt AS (SELECT 'RT_' || seg AS id, {_RT.format(c='seg')} AS name FROM (SELECT DISTINCT c_mktsegment AS seg FROM customer)),
t AS (SELECT 'Call' AS task_subtype, 'Follow up ' || o_orderpriority AS subject, o_orderdate AS created_date,
             CAST(o_orderdate AS DATE) AS activity_date, 'CT' || CAST(o_custkey AS VARCHAR) AS who_id,
             'OPP' || CAST(o_custkey AS VARCHAR) AS what_id, 'U' || CAST(o_orderkey % 10 AS VARCHAR) AS created_by_id
      FROM orders),
e AS (SELECT 'Event' AS event_subtype,
             CASE event_type WHEN 'signup' THEN 'Tour booked' WHEN 'click' THEN 'tour follow-up'
                             WHEN 'view' THEN 'Call' ELSE 'Meeting' END AS subject,
             ts AS created_date, CAST(ts AS DATE) AS activity_date, 'CT' || CAST(user_id AS VARCHAR) AS who_id,
             'OPP' || CAST(user_id AS VARCHAR) AS what_id, 'U' || CAST(user_id % 10 AS VARCHAR) AS created_by_id
      FROM events)
SELECT t.task_subtype AS subtype, t.subject, t.created_date, t.activity_date, t.who_id AS contact_id,
       t.what_id AS opportunity_id, u.alias, u.name AS creator, 'task' AS type
FROM t JOIN u ON t.created_by_id = u.id JOIN op ON t.what_id = op.id JOIN rt ON op.record_type_id = rt.id
                                                                    AND rt.name != 'Partner'
UNION
SELECT e.event_subtype, e.subject, e.created_date, e.activity_date, e.who_id, e.what_id, u.alias, u.name, 'event'
FROM e JOIN u ON e.created_by_id = u.id JOIN op ON e.what_id = op.id JOIN rt ON op.record_type_id = rt.id
                                                                    AND rt.name != 'Partner'
"""

ORACLE["lifecycle_history"] = """
SELECT user_id AS contact_id, 'lifecyclestage' AS property_name,
       CASE WHEN event_type = 'signup' THEN 'lead' WHEN event_type = 'purchase' THEN 'customer'
            WHEN event_type = 'view' THEN 'Yes' ELSE 'opportunity' END AS value,
       ts AS timestamp
FROM events WHERE value < 20 AND event_type <> 'view'
"""

ORACLE["deals_with_owner"] = """
WITH d AS (SELECT o_custkey + 100000 AS deal_id, o_custkey % 150 AS owner_id, max(o_totalprice) AS property_amount,
                  max(o_orderdate) AS property_closedate FROM orders GROUP BY o_custkey),
o AS (SELECT s_suppkey AS owner_id, lower(s_name) || '@sales.example' AS email FROM supplier)
SELECT d.*, o.email AS sales_owner FROM d LEFT JOIN o ON d.owner_id = o.owner_id
"""

ORACLE["stage_probabilities"] = f"""
WITH types AS (SELECT DISTINCT event_type FROM events),
st AS (SELECT 'st_' || event_type AS stage_id, 'default' AS pipeline_id, {_HS_LABEL} AS label FROM types
       UNION ALL SELECT 'st_' || event_type, 'other', upper(event_type) FROM types),
ps AS (SELECT *, CAST(length(label) AS DOUBLE) / CAST(40.0 AS DOUBLE) AS probability,
              CASE WHEN contains(label, 'Dead') OR label = 'ERROR' THEN 'false' ELSE 'true' END AS active FROM st),
pl AS (SELECT pipeline_id, upper(substr(pipeline_id, 1, 1)) || lower(substr(pipeline_id, 2)) || ' pipeline' AS label
       FROM (SELECT DISTINCT pipeline_id FROM st))
SELECT ps.pipeline_id, pl.label AS pipeline, ps.label AS pipeline_stage, ps.stage_id, ps.probability
FROM ps JOIN pl ON ps.pipeline_id = pl.pipeline_id WHERE ps.active = 'true'
"""

ORACLE["crm_leads"] = """
WITH l AS (
  SELECT 'LD' || CAST(c_custkey AS VARCHAR) AS id, 'LRT_' || c_mktsegment AS record_type_id,
         'U' || CAST(c_custkey % 10 AS VARCHAR) AS created_by_id, 'Pat' AS first_name, c_name AS last_name,
         c_mktsegment AS company, CAST(NULL AS VARCHAR) AS contact_company_c, c_acctbal > 5000 AS is_converted,
         TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST(c_custkey AS INTEGER)) AS created_date,
         CASE WHEN c_acctbal > 5000
              THEN TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST(c_custkey AS INTEGER)) + INTERVAL 3 DAY END
           AS converted_date,
         CASE WHEN c_acctbal > 5000 THEN 'CT' || CAST(c_custkey AS VARCHAR) END AS converted_contact_id,
         CASE WHEN c_acctbal > 5000 THEN 'AC' || CAST(c_custkey AS VARCHAR) END AS converted_account_id,
         CASE WHEN c_acctbal > 5000 THEN 'OPP' || CAST(c_custkey AS VARCHAR) END AS converted_opportunity_id,
         CASE WHEN c_acctbal > 8000 THEN 'Room' END AS fill_product_c,
         'NATION_' || CAST(c_nationkey AS VARCHAR) AS location_c, 'Online' AS lead_source, 'web' AS source_c,
         'ORGANIC_SEARCH' AS data_source_1_c, CAST(NULL AS VARCHAR) AS data_source_2_c,
         CAST(NULL AS VARCHAR) AS data_source_3_c, CAST(NULL AS VARCHAR) AS digital_tracking_code_c,
         c_acctbal < -900 AS is_deleted
  FROM customer),
rt AS (SELECT 'LRT_' || seg AS id, CASE WHEN seg = 'BUILDING' THEN 'Other' ELSE 'Fill' END AS name,
              CASE WHEN seg = 'MACHINERY' THEN 'Opportunity' ELSE 'Lead' END AS sobject_type
       FROM (SELECT DISTINCT c_mktsegment AS seg FROM customer)),
u AS (SELECT 'U' || CAST(s_suppkey AS VARCHAR) AS id, s_name AS name FROM supplier)
SELECT l.* EXCLUDE (record_type_id, created_by_id, is_deleted), u.name AS creator
FROM l JOIN rt ON l.record_type_id = rt.id AND rt.sobject_type = 'Lead' AND rt.name = 'Fill'
JOIN u ON l.created_by_id = u.id
WHERE l.is_deleted IS false
"""

ORACLE["chatter_posts"] = f"""
WITH f AS (SELECT 'OPP' || CAST(user_id AS VARCHAR) AS parent_id, ts AS created_date,
                  'U' || CAST(user_id % 10 AS VARCHAR) AS created_by_id, 'note ' || event_type AS body,
                  CASE WHEN event_type IN ('click', 'signup') THEN 'TextPost' ELSE 'TrackedChange' END AS type,
                  value > 200 AS is_deleted FROM events),
op AS (SELECT 'OPP' || CAST(c_custkey AS VARCHAR) AS id, 'RT_' || c_mktsegment AS record_type_id FROM customer),
rt AS (SELECT 'RT_' || seg AS id, {_RT.format(c='seg')} AS name, 'Opportunity' AS sobject_type
       FROM (SELECT DISTINCT c_mktsegment AS seg FROM customer))
SELECT f.parent_id AS opportunity_id, f.created_date, f.created_by_id, f.body
FROM f JOIN op ON f.parent_id = op.id
JOIN rt ON op.record_type_id = rt.id AND rt.sobject_type = 'Opportunity'
        AND rt.name IN ('Broker-Led', 'Local Fill', 'Enterprise')
WHERE f.type = 'TextPost' AND f.is_deleted IS false
"""

# Ranges: networks of customers (one of 256 addresses each, nested in one of 65 536 per nation) and odd ranges that
# begin and end inside them; every seventh visitor has an IPv6 address.
ORACLE["ip_range_lookup"] = """
WITH a AS (
  SELECT DISTINCT user_id AS u FROM events
), x AS (
  SELECT CASE WHEN u % 7 = 0 THEN '2001:db8:' || to_hex(u % 25) || '::' || to_hex(u % 4096)
              ELSE '10.' || (u % 25) || '.' || (u % 211) || '.' || (u % 256) END AS context_ip,
         u % 7 = 0 AS v6, (u % 25)::HUGEINT AS n, CASE WHEN u % 7 = 0 THEN (u % 4096)::HUGEINT ELSE 256 * (u % 211) + u % 256 END AS k
  FROM a
), r AS (
  SELECT false AS v6, n_nationkey::HUGEINT AS n, 0::HUGEINT AS lo, 65535::HUGEINT AS hi, n_name AS org FROM nation
  UNION ALL SELECT false, c_nationkey, 256 * (c_custkey % 256), 256 * (c_custkey % 256) + 255, c_name FROM customer WHERE c_custkey % 3 = 0
  UNION ALL SELECT false, s_nationkey, 256 * (s_suppkey % 200) + 17, 256 * (s_suppkey % 200) + 300, s_name FROM supplier
  UNION ALL SELECT true, s_nationkey, 64 * (s_suppkey % 61) + 1, 64 * (s_suppkey % 61) + 64, s_name || ' v6' FROM supplier
)
SELECT context_ip, org FROM (SELECT DISTINCT * FROM x) x JOIN r ON x.v6 = r.v6 AND x.n = r.n AND x.k BETWEEN r.lo AND r.hi
QUALIFY row_number() OVER (PARTITION BY context_ip ORDER BY r.lo DESC, r.hi ASC, org ASC) = 1
"""
