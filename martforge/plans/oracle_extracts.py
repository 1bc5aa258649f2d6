"""DuckDB oracles of the CRM extracts, written from the source's SQL over the driver tables."""

from __future__ import annotations

from martforge.plans.oracle import ORACLE

_RTN = ("CASE c.c_mktsegment WHEN 'FURNITURE' THEN 'Broker-Led' WHEN 'MACHINERY' THEN 'Enterprise' "
        "WHEN 'HOUSEHOLD' THEN 'Partner' ELSE 'Local Fill' END")

ORACLE["crm_opportunities"] = f"""
WITH span AS (SELECT o_custkey, min(o_orderdate) AS f, max(o_orderdate) AS l,
                     min(o_orderdate) FILTER (WHERE o_orderkey % 11 <> 0) AS fc FROM orders GROUP BY o_custkey),
ids AS (SELECT c_custkey AS k, 'OPP' || c_custkey AS id FROM customer)
SELECT ids.id, {_RTN} AS oppty_type, n.n_name AS location_name, 'LOC' || c.c_nationkey AS location_id,
       n.n_name AS city_c, 'sub ' || r.r_name AS sub_region_c, r.r_name AS region_c, c.c_name AS customer_name,
       span.l AS customer_create_date, span.fc AS first_contact_create, CAST(span.l AS DATE) AS anticipated_start_date,
       CAST(span.l AS DATE) AS anticipated_close_date,
       CASE c.c_mktsegment WHEN 'BUILDING' THEN 'Closed Won' WHEN 'AUTOMOBILE' THEN 'Touring' ELSE 'Upper Funnel' END
         AS stage_name,
       span.f AS created_date, c.c_name AS name, CASE WHEN c.c_nationkey < 5 THEN 'NAtional account' END AS enterprise_notes_c,
       'note ' || c.c_name AS additional_notes_text_c, c.c_mktsegment AS opportunity_type_c,
       CASE WHEN c.c_acctbal > 8000 THEN 'Room' END AS fill_product_c, CAST(c.c_nationkey AS DOUBLE) AS desks_max_c,
       c.c_nationkey / 2.0::DOUBLE AS desks_min_c, 12.0::DOUBLE AS term_length_max_c, 6.0::DOUBLE AS term_length_min_c,
       'months' AS term_length_period_c, CASE WHEN c.c_acctbal > 5000 THEN c.c_acctbal END AS price_range_min_c,
       CAST(NULL AS DOUBLE) AS price_range_max_c,
       CASE WHEN c.c_acctbal BETWEEN 0 AND 5000 THEN c.c_acctbal / 2.0::DOUBLE END AS budget_min_c,
       CAST(NULL AS DOUBLE) AS budget_max_c, c.c_acctbal AS total_deal_amount_c, CAST(NULL AS VARCHAR) AS enterprise_portfolio_c,
       CAST(NULL AS VARCHAR) AS executive_spotlight_c,
       CASE WHEN c.c_acctbal > 0 THEN 'summary ' || c.c_mktsegment END AS executive_summary_c,
       CAST(NULL AS VARCHAR) AS closed_lost_reasons_c,
       CASE WHEN c.c_acctbal < 0 THEN 'local' END AS local_fill_closed_lost_reasons_c,
       CASE c.c_nationkey % 5 WHEN 0 THEN 'Online' WHEN 1 THEN 'Offline' WHEN 3 THEN 'Enterprise Referral'
                              WHEN 4 THEN 'Broker Referral' END AS lead_source,
       ['DIRECT_TRAFFIC', 'ORGANIC_SEARCH', 'PAID_SEARCH', 'PAID_SOCIAL', '3rd Party Aggregator', NULL][c.c_custkey % 6 + 1]
         AS data_source_1_c,
       ['https://own.example/', 'Blog post', 'own.example/page', 'meetings.example', 'Facebook ads', 'LinkedIn',
        'auto-tagged'][c.c_custkey % 7 + 1] AS data_source_2_c,
       CASE WHEN c.c_acctbal < 0 THEN 'lead-gen form' END AS data_source_3_c,
       CASE WHEN c.c_nationkey > 20 THEN 'TC' || c.c_nationkey END AS digital_tracking_code_c,
       concat_ws(';', CASE WHEN c.c_mktsegment = 'AUTOMOBILE' THEN 'price' END,
                 CASE WHEN c.c_acctbal < 0 THEN 'low quality' END, CASE WHEN c.c_nationkey = 3 THEN 'wrong product' END)
         AS closed_lost_reason,
       'owner ' || c.c_custkey % 10 AS owner_name, 'user' || c.c_custkey % 10 || '@crm.example' AS username,
       'role ' || (c.c_custkey % 10) % 3 AS sales_role, 'owner ' || (c.c_custkey + 1) % 10 AS creator,
       {_RTN} AS record_type
FROM ids JOIN customer c ON c.c_custkey = ids.k LEFT JOIN span ON c.c_custkey = span.o_custkey
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
"""

ORACLE["opportunity_roles"] = """
SELECT 'Contact ' || o.o_orderkey % 3 AS name,
       CASE o.o_orderstatus WHEN 'F' THEN 'Unknown' WHEN 'O' THEN 'Acct ' || o.o_orderkey % 5 END AS account,
       CASE WHEN o.o_orderpriority = '1-URGENT' THEN 'Broker Contact' ELSE 'Decision Maker' END AS role,
       'C' || o.o_orderkey AS contact_id, 'OPP' || o.o_custkey AS opportunity_id
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
"""

ORACLE["deal_contact_links"] = "SELECT o_orderkey + 100000 AS deal_id, o_custkey AS contact_id FROM orders"

ORACLE["deal_company_links"] = """
SELECT o_orderkey + 100000 AS deal_id, CAST(c_nationkey AS BIGINT) AS company_id
FROM orders JOIN customer ON o_custkey = c_custkey
"""

ORACLE["companies"] = """
SELECT CAST(n_nationkey AS BIGINT) AS id, CASE WHEN n_nationkey <> 4 THEN n_name END AS property_name FROM nation
"""

_TYPE = """CASE event_type WHEN 'click' THEN 'EMAIL' WHEN 'view' THEN 'INCOMING_EMAIL' WHEN 'purchase' THEN 'CALL'
                          WHEN 'signup' THEN 'MEETING' WHEN 'error' THEN 'TASK' END"""

ORACLE["contact_engagements"] = f"""
SELECT user_id AS contact_id, {_TYPE} AS type, count(*) AS engagements FROM events GROUP BY ALL
"""

ORACLE["engagements_by_contact"] = f"""
WITH e AS (SELECT user_id AS id, {_TYPE} AS type FROM events)
SELECT id, CAST(count(*) FILTER (WHERE type = 'CALL') AS DOUBLE) AS "CALL",
       CAST(count(*) FILTER (WHERE type = 'EMAIL') AS DOUBLE) AS "EMAIL",
       CAST(count(*) FILTER (WHERE type = 'INCOMING_EMAIL') AS DOUBLE) AS "INCOMING_EMAIL",
       CAST(count(*) FILTER (WHERE type = 'MEETING') AS DOUBLE) AS "MEETING",
       CAST(count(*) FILTER (WHERE type = 'TASK') AS DOUBLE) AS "TASK" FROM e GROUP BY id
"""

_DISPOSITION = """['9d9162e7-6cf3-4944-bf63-4dff82258764', 'f240bbac-87c9-4f6e-bf70-924b57d47db7',
        'a4c4c377-d246-4b32-a13b-75a56a4cd0ff', 'b2cf5968-551e-4856-9783-52b3da59a7d0',
        '73a0d17f-1163-4015-bdd5-ec830791da20', '17b47fee-58de-441e-a44c-c6300d46f273',
        '00000000-0000-0000-0000-000000000000', NULL][event_id % 8 + 1]"""
_TITLE = "['Excited for your TOUR!', 'Learn more about the space', 'Weekly sync'][event_id % 3 + 1]"

ORACLE["phone_call_log"] = f"""
SELECT user_id AS contact_id, {_DISPOSITION} AS disposition, ts AS created_at, '+1' || user_id AS to_number,
       '+2' || event_id % 4 AS from_number, CASE WHEN value > 100 THEN 'COMPLETED' ELSE 'CALLING' END AS status,
       'x' || event_id AS external_id, CAST(floor(value * 1000) AS BIGINT) AS duration_milliseconds,
       CASE WHEN event_id % 2 = 0 THEN 'call notes ' || event_id % 5 END AS body
FROM events WHERE event_type = 'purchase'
"""

ORACLE["tours_and_calls"] = f"""
SELECT e.user_id AS contact_id, CASE WHEN c.c_nationkey <> 3 THEN lower(c.c_name) || '@mail.example' END AS property_email,
       CASE WHEN c.c_custkey % 3 = 0 THEN 'Suite' END AS property_in_which_service_are_you_interested_,
       CASE WHEN c.c_nationkey < 10 THEN 'NATION_' || c.c_nationkey END AS property_in_which_location_are_you_interested_,
       CASE WHEN e.event_id % 3 = 0 THEN 'Tour' ELSE 'Call' END AS meeting_type,
       ['DIRECT_TRAFFIC', 'ORGANIC_SEARCH', 'PAID_SEARCH', 'PAID_SOCIAL', 'SOCIAL_MEDIA', 'OFFLINE', 'REFERRALS',
        NULL][c.c_custkey % 8 + 1] AS property_hs_analytics_source,
       e.ts + INTERVAL 1 DAY AS tour_time, e.ts AS create_time, 'First tour' AS activity_type
FROM events e JOIN customer c ON e.user_id = c.c_custkey WHERE e.event_type = 'signup' AND e.event_id % 3 < 2
"""

ORACLE["rep_engagements"] = f"""
SELECT user_id AS contact_id, 'Call' AS engagement_type, ts AS created_at, {_DISPOSITION} AS status, '' AS subject,
       CASE WHEN event_id % 2 = 0 THEN 'call notes ' || event_id % 5 END AS body
FROM events WHERE event_type = 'purchase' AND value < 50
UNION
SELECT user_id, 'Meeting', ts, '', {_TITLE}, 'agenda ' || event_id % 3
FROM events WHERE event_type = 'signup' AND value < 50
UNION
SELECT user_id, 'Email', ts, CASE WHEN value > 60 THEN 'BOUNCED' ELSE 'SENT' END, 'subject ' || user_id,
       CASE WHEN event_id % 3 <> 0 THEN 'mail ' || event_id % 4 END
FROM events WHERE event_type = 'click' AND value < 50
"""

ORACLE["rep_tasks"] = """
SELECT user_id AS contact_id, CASE WHEN value > 1 THEN CASE WHEN value > 30 THEN 'CALL' ELSE 'EMAIL' END END AS task_type,
       ts AS created_at,
       CASE WHEN value > 1 THEN make_timestamp(((epoch_us(ts) // 1000 + CAST(floor(value * 3600000.0) AS BIGINT)) // 1000)
                                               * 1000000) END AS completed_date,
       CASE WHEN value > 1 THEN 'COMPLETED' END AS status, CASE WHEN value > 1 THEN 'follow up' END AS subject,
       CASE WHEN value > 1 AND event_id % 2 = 1 THEN 'task ' || event_id END AS body
FROM events WHERE event_type = 'error' AND value < 50
"""
