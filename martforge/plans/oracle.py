"""Independent DuckDB SQL for every registered query (same output column names).

Conventions (DuckDB vs Spark): ``isodow`` = Spark ``weekday + 1``;
``date_trunc`` returns TIMESTAMP in DuckDB, so it is cast to DATE; ``round_even``
matches Spark ``bround``; integer sums are cast to BIGINT; ranks to BIGINT.
"""

from __future__ import annotations

MEDIUM_SQL = ("CASE event_type WHEN 'purchase' THEN 'cpc' WHEN 'click' THEN 'organic' "
              "WHEN 'signup' THEN 'newsletter' END")

ORACLE: dict[str, str] = {}

ORACLE["web_daily_attribution"] = f"""
WITH e AS (
  SELECT event_id, ts, user_id, event_type, value, CAST(ts AS DATE) AS day, {MEDIUM_SQL} AS m0
  FROM events),
f1 AS (
  SELECT *, coalesce(
    last_value(m0 IGNORE NULLS) OVER (PARTITION BY user_id, day ORDER BY ts, event_id
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
    first_value(m0 IGNORE NULLS) OVER (PARTITION BY user_id, day ORDER BY ts, event_id
                                       ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS m1
  FROM e),
l AS (
  SELECT *, CASE WHEN regexp_matches(m1, 'paid|ppc|cpc', 'i') THEN 'paid'
                 WHEN m1 = 'organic' THEN 'organic'
                 WHEN m1 IS NOT NULL THEN 'other'
                 WHEN value < 5 THEN 'direct'
                 WHEN value >= 45 THEN NULL
                 ELSE 'referral' END AS m2
  FROM f1),
f2 AS (
  SELECT *, last_value(m2 IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id
                                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS m3
  FROM l),
f3 AS (
  SELECT *, coalesce(m3, first_value(m3 IGNORE NULLS) OVER (PARTITION BY user_id, day ORDER BY ts, event_id
                                       ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 'unknown') AS medium,
         row_number() OVER (PARTITION BY user_id, day ORDER BY ts, event_id) AS pos
  FROM f2),
cnt AS (
  SELECT day, user_id, 'medium' AS name, medium AS v, count(*) AS n, min(pos) AS fp FROM f3 GROUP BY ALL
  UNION ALL
  SELECT day, user_id, 'event_type' AS name, event_type AS v, count(*) AS n, min(pos) AS fp FROM f3 GROUP BY ALL),
best AS (
  SELECT day, user_id, name, v,
         row_number() OVER (PARTITION BY day, user_id, name ORDER BY (v IS NULL), n DESC, fp) AS rk
  FROM cnt),
landing AS (SELECT day, user_id, event_type AS landing_content FROM f3 WHERE pos = 1)
SELECT l.day AS dau_date, l.user_id, l.landing_content,
       m.v AS campaign_medium, t.v AS top_event,
       CASE WHEN m.v = 'paid' THEN 1 ELSE 0 END AS true_paid,
       CAST(isodow(l.day) AS INTEGER) AS dau_day,
       CAST(date_trunc('week', l.day) AS DATE) AS week_start,
       CAST(date_trunc('month', l.day) AS DATE) AS month_start,
       CAST(date_trunc('quarter', l.day) AS DATE) AS quarter_start
FROM landing l
JOIN best m ON m.day = l.day AND m.user_id = l.user_id AND m.name = 'medium' AND m.rk = 1
JOIN best t ON t.day = l.day AND t.user_id = l.user_id AND t.name = 'event_type' AND t.rk = 1
"""

_ME = f"SELECT event_id, ts, user_id, event_type, value, CAST(ts AS DATE) AS day, {MEDIUM_SQL} AS medium FROM events"

ORACLE["fill_down_up"] = f"""
WITH e AS ({_ME})
SELECT event_id, user_id, day, coalesce(
  last_value(medium IGNORE NULLS) OVER (PARTITION BY user_id, day ORDER BY ts, event_id
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  first_value(medium IGNORE NULLS) OVER (PARTITION BY user_id, day ORDER BY ts, event_id
                                         ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS medium
FROM e
"""

ORACLE["fill_down_then_up"] = f"""
WITH e AS ({_ME}),
d AS (SELECT *, last_value(medium IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS m_down FROM e)
SELECT event_id, user_id, day,
       coalesce(m_down, first_value(m_down IGNORE NULLS) OVER (PARTITION BY user_id, day ORDER BY ts, event_id
                ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS medium
FROM d
"""

ORACLE["landing_value"] = f"""
WITH e AS ({_ME}),
r AS (SELECT *, row_number() OVER (PARTITION BY day, user_id ORDER BY ts, event_id) AS pos FROM e)
SELECT day, user_id, medium AS landing_medium FROM r WHERE pos = 1
"""

ORACLE["mode_first_seen"] = f"""
WITH e AS ({_ME}),
r AS (SELECT *, row_number() OVER (PARTITION BY day, user_id ORDER BY ts, event_id) AS pos FROM e),
c AS (SELECT day, user_id, medium, count(*) AS n, min(pos) AS fp FROM r GROUP BY ALL),
b AS (SELECT *, row_number() OVER (PARTITION BY day, user_id ORDER BY (medium IS NULL), n DESC, fp) AS rk FROM c)
SELECT day, user_id, medium AS mode_medium FROM b WHERE rk = 1
"""

ORACLE["stage_change_points"] = """
WITH e AS (SELECT event_id, user_id, ts, CASE WHEN event_type <> 'error' THEN event_type END AS stage FROM events),
l AS (SELECT *, lag(stage, 1, '1') OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM e)
SELECT event_id, user_id, ts, stage FROM l WHERE stage <> prev
"""

ORACLE["anti_join_exclusions"] = """
WITH ev AS (SELECT event_id, CASE WHEN user_id <> 0 THEN user_id END AS visitor, event_type, value FROM events),
top AS (SELECT visitor FROM ev GROUP BY visitor ORDER BY count(*) DESC, visitor ASC NULLS FIRST LIMIT 5),
excl AS (SELECT visitor FROM top
         UNION SELECT CAST(v AS BIGINT) FROM (VALUES (NULL), (1), (2)) t(v)
         UNION SELECT visitor FROM ev WHERE event_type = 'error' AND value > 150)
SELECT event_id, visitor FROM ev
WHERE NOT EXISTS (SELECT 1 FROM excl WHERE excl.visitor IS NOT DISTINCT FROM ev.visitor)
"""

ORACLE["top_k_by_count"] = """
SELECT user_id, count(*) AS pv FROM events GROUP BY user_id ORDER BY pv DESC, user_id LIMIT 100
"""

ORACLE["not_like_keep_null"] = """
SELECT event_id, t FROM (SELECT event_id, CASE WHEN event_type <> 'view' THEN event_type END AS t FROM events)
WHERE NOT coalesce(regexp_matches(t, 'err', 'i'), false) AND (t IS NULL OR t NOT IN ('signup'))
"""

ORACLE["inner_same_day"] = """
WITH ev AS (SELECT *, CAST(ts AS DATE) AS day FROM events),
v AS (SELECT DISTINCT day, user_id FROM ev WHERE event_type = 'view')
SELECT v.day, v.user_id, b.event_id
FROM v JOIN ev b ON b.event_type = 'purchase' AND b.day = v.day AND b.user_id = v.user_id
"""

ORACLE["first_contact_min"] = """
SELECT user_id, min(ts) AS first_event,
       min(ts) FILTER (WHERE event_type = 'purchase' AND value > 150) AS first_big_purchase
FROM events GROUP BY user_id
"""

ORACLE["strict_min_max"] = """
WITH e AS (SELECT user_id, CASE WHEN NOT (event_type = 'error' AND value > 200) THEN value END AS v FROM events)
SELECT user_id, CASE WHEN count(v) = count(*) THEN min(v) END AS min_v,
       CASE WHEN count(v) = count(*) THEN max(v) END AS max_v
FROM e GROUP BY user_id
"""

ORACLE["engagement_summary"] = """
WITH ev AS (SELECT *, CASE WHEN event_type <> 'view' THEN event_type END AS t FROM events),
pu AS (SELECT user_id, count(*) AS n_events, min(ts) AS first_ts FROM ev GROUP BY user_id)
SELECT pu.user_id, pu.n_events, pu.first_ts,
       count(*) FILTER (WHERE ev.event_type = 'purchase') AS n_purchase,
       count(ev.t) AS n_typed,
       CASE WHEN count(ev.t) = count(*) THEN CAST(sum(CAST(ev.t = 'click' AS INTEGER)) AS BIGINT) END AS click_flags,
       round_even((epoch_us(min(ev.ts) FILTER (WHERE ev.event_type = 'purchase')) - epoch_us(pu.first_ts)) / 3.6e9, 1)
         AS hours_to_purchase
FROM pu JOIN ev ON ev.user_id = pu.user_id
GROUP BY pu.user_id, pu.n_events, pu.first_ts
"""

ORACLE["pivot_counts"] = """
SELECT user_id,
       count(*) FILTER (WHERE event_type = 'click') AS click,
       count(*) FILTER (WHERE event_type = 'error') AS error,
       count(*) FILTER (WHERE event_type = 'purchase') AS purchase,
       count(*) FILTER (WHERE event_type = 'signup') AS signup,
       count(*) FILTER (WHERE event_type = 'view') AS view
FROM events GROUP BY user_id
"""

_PFT = """
SELECT user_id, min(ts) FILTER (WHERE event_type = 'signup') AS first_signup,
       min(ts) FILTER (WHERE event_type = 'purchase') AS first_purchase
FROM events WHERE value > 100 GROUP BY user_id
"""
ORACLE["pivot_first_ts"] = _PFT

ORACLE["null_flags"] = f"""
WITH p AS ({_PFT}), f AS (
  SELECT user_id, CAST(first_signup IS NULL AS INTEGER) + CAST(first_purchase IS NULL AS INTEGER) AS na FROM p)
SELECT user_id, CASE WHEN na = 2 THEN 0 ELSE 1 END AS scheduled_meeting,
       CASE WHEN na < 2 THEN 1 ELSE 0 END AS engaged_contact,
       CASE WHEN na = 2 THEN 1 ELSE 0 END AS no_outreach
FROM f
"""

ORACLE["hours_between"] = """
SELECT user_id, round_even((epoch_us(max(ts)) - epoch_us(min(ts))) / 3.6e9, 1) AS active_hours
FROM events GROUP BY user_id
"""

ORACLE["minute_trunc"] = "SELECT event_id, date_trunc('minute', ts) AS ts_minute FROM events"

ORACLE["epoch_ms"] = """
SELECT event_id, epoch_us(ts) // 1000 AS epoch_ms, make_timestamp(((epoch_us(ts) // 1000) // 1000) * 1000000) AS ts_second
FROM events
"""

ORACLE["date_spine_weeks"] = """
WITH b AS (SELECT min(CAST(ts AS DATE)) AS s, max(CAST(ts AS DATE)) AS e FROM events),
d AS (SELECT CAST(unnest(generate_series(CAST(s AS TIMESTAMP), CAST(e AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS day
      FROM b)
SELECT CAST(date_trunc('week', day) AS DATE) AS report_week, count(*) AS days FROM d GROUP BY 1
"""

ORACLE["fill_by_type"] = """
SELECT event_id, user_id,
       coalesce(CASE WHEN event_type <> 'error' THEN value END, 0) AS v,
       coalesce(CASE WHEN event_type <> 'view' THEN event_type END, 'Not Specified') AS t,
       coalesce(CASE WHEN value <= 100 THEN props END, 'unknown') AS p
FROM events
"""

ORACLE["lookup_top_k"] = """
WITH top AS (SELECT user_id, count(*) AS pv FROM events GROUP BY user_id ORDER BY pv DESC, user_id LIMIT 100)
SELECT top.user_id, top.pv, c.c_mktsegment
FROM top JOIN customer c ON c.c_custkey = top.user_id
WHERE regexp_matches(c.c_mktsegment, 'build|auto', 'i')
"""

ORACLE["union_all_tagged"] = """
SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS day, 'orders' AS source FROM orders
UNION ALL
SELECT event_id AS id, CAST(ts AS DATE) AS day, 'events' AS source FROM events
"""

ORACLE["daily_activity_detail"] = """
WITH ev AS (
  SELECT ts, user_id, CASE event_type WHEN 'click' THEN 'Email' WHEN 'purchase' THEN 'Call'
                                       WHEN 'signup' THEN 'Meeting' END AS engagement_type
  FROM events),
c AS (
  SELECT c_custkey AS user_id,
         CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'Not Specified'
              WHEN c_mktsegment <> 'MACHINERY' THEN c_mktsegment END AS loc,
         CASE WHEN c_acctbal > 5000 THEN 'Suite' END AS prod
  FROM customer),
g AS (
  SELECT CAST(ev.ts AS DATE) AS engagement_date, ev.engagement_type, c.loc, c.prod, count(*) AS engagements
  FROM ev LEFT JOIN c ON c.user_id = ev.user_id
  WHERE ev.engagement_type IN ('Email', 'Call')
  GROUP BY 1, 2, 3, 4)
SELECT engagement_date, engagement_type, coalesce(loc, 'Not Specified') AS location,
       coalesce(prod, 'Not Specified') AS product, engagements
FROM g
"""

# ---------------------------------------------------------------- versioned tables, roll-ups, joins

_M = "CAST(sum(CAST({} AS DECIMAL(28,6))) AS DOUBLE)"

ORACLE["latest_version"] = """
WITH o AS (SELECT *, CASE WHEN NOT (o_orderpriority = '1-URGENT' AND o_orderstatus = 'F') THEN o_orderdate END
                     AS version_ts FROM orders),
r AS (SELECT *, rank() OVER (PARTITION BY o_custkey ORDER BY version_ts DESC NULLS FIRST) AS pos FROM o)
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, version_ts FROM r WHERE pos = 1
"""

ORACLE["latest_version_distinct"] = """
WITH r AS (SELECT o_custkey, o_orderdate,
                  rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS FIRST) AS pos FROM orders)
SELECT DISTINCT o_custkey, CAST(o_orderdate AS DATE) AS order_date FROM r WHERE pos = 1
"""

ORACLE["latest_composite_key"] = """
WITH r AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity,
                  rank() OVER (PARTITION BY l_partkey, l_suppkey ORDER BY l_shipdate DESC NULLS FIRST) AS pos
           FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity FROM r WHERE pos = 1
"""

_TOP = """
SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS pos FROM orders
"""

ORACLE["top_row_per_group"] = f"""
SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice FROM ({_TOP}) WHERE pos = 1
"""

ORACLE["latest_then_terminal"] = f"""
SELECT o_custkey, CAST(o_orderdate AS DATE) AS close_date, o_orderstatus
FROM ({_TOP}) WHERE pos = 1 AND o_orderstatus IN ('F', 'P')
"""

ORACLE["latest_then_aggregate"] = f"""
WITH r AS (SELECT o_orderkey, o_custkey, o_orderpriority,
                  rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS FIRST) AS pos FROM orders),
l AS (SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN ''
                              WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_orderpriority END AS contract
      FROM r WHERE pos = 1)
SELECT contract, {_M.format("li.l_extendedprice")} AS billed,
       CAST(sum(CASE WHEN li.l_linestatus = 'F' THEN CAST(li.l_extendedprice AS DECIMAL(28,6)) ELSE 0 END) AS DOUBLE)
         AS paid,
       count(*) AS n_lines
FROM l JOIN lineitem li ON li.l_orderkey = l.o_orderkey
WHERE contract IS NOT NULL AND contract <> ''
GROUP BY contract
"""

ORACLE["stage_rollup"] = """
WITH d AS (SELECT o_orderkey, concat_ws('-', o_orderstatus, o_orderpriority) AS stage_detail FROM orders)
SELECT o_orderkey, stage_detail,
       CASE WHEN stage_detail = 'F-5-LOW' THEN 'Closed Lost'
            WHEN stage_detail = 'O-4-NOT SPECIFIED' THEN 'Negotiation/Proposal'
            WHEN stage_detail = 'P-3-MEDIUM' THEN 'Touring'
            WHEN regexp_matches(stage_detail, 'URGENT|HIGH') THEN stage_detail
            ELSE 'Upper Funnel' END AS pipeline_stage
FROM d
"""

ORACLE["null_safe_left_join"] = """
WITH o AS (SELECT o_orderkey, CASE WHEN o_custkey > 10 THEN o_custkey END AS o_key FROM orders),
c AS (SELECT CASE WHEN c_custkey <> 1 THEN c_custkey END AS c_key, c_name FROM customer)
SELECT o.o_orderkey, o.o_key, c.c_name FROM o LEFT JOIN c ON o.o_key IS NOT DISTINCT FROM c.c_key
"""

ORACLE["star_join"] = f"""
SELECT r.r_name, n.n_name, c.c_mktsegment, count(*) AS orders, {_M.format("o.o_totalprice")} AS revenue
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
WHERE o.o_orderstatus <> 'O'
GROUP BY 1, 2, 3
"""

ORACLE["two_role_join"] = """
SELECT cn.n_name AS cust_nation, sn.n_name AS supp_nation, count(*) AS lines
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation cn ON c.c_nationkey = cn.n_nationkey
JOIN nation sn ON s.s_nationkey = sn.n_nationkey
GROUP BY 1, 2
"""

ORACLE["on_clause_constant"] = """
SELECT c.c_custkey, c.c_name, n.n_name
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey AND n.n_regionkey = 1
"""

ORACLE["membership_join"] = """
WITH m AS (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'
           UNION ALL
           SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal > 9000)
SELECT o.o_orderkey, o.o_custkey FROM orders o JOIN m ON o.o_custkey = m.c_custkey
"""

ORACLE["count_distinct_having"] = """
SELECT o_custkey, count(DISTINCT o_orderstatus) AS n_status
FROM orders WHERE o_orderstatus IN ('F', 'O')
GROUP BY o_custkey HAVING count(DISTINCT o_orderstatus) = 2
"""

ORACLE["string_agg_distinct"] = """
WITH o AS (SELECT o_custkey, coalesce(nullif(o_orderpriority, '5-LOW'), 'NA') AS p FROM orders)
SELECT o_custkey, string_agg(DISTINCT p, '; ' ORDER BY p) AS priorities FROM o GROUP BY o_custkey
"""

ORACLE["code_map_two_else"] = """
SELECT o_orderkey,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'Busy' WHEN '2-HIGH' THEN 'Connected'
                            WHEN '3-MEDIUM' THEN 'Left voicemail' ELSE 'Not Specified' END AS label_ns,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'Busy' WHEN '2-HIGH' THEN 'Connected'
                            WHEN '3-MEDIUM' THEN 'Left voicemail' ELSE o_orderpriority END AS label_orig
FROM orders
"""

ORACLE["calendar_columns"] = """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date,
       CAST(isodow(o_orderdate) AS INTEGER) AS order_wday,
       CAST(date_trunc('week', o_orderdate) AS DATE) AS order_week,
       CAST(date_trunc('month', o_orderdate) AS DATE) AS order_month,
       CAST(date_trunc('quarter', o_orderdate) AS DATE) AS order_quarter
FROM orders
"""

ORACLE["concat_forms"] = """
WITH c AS (SELECT c_custkey, c_name, nullif(c_mktsegment, 'HOUSEHOLD') AS seg FROM customer)
SELECT c_custkey, concat_ws(';', c_name, seg) AS ws, 'Social(' || coalesce(lower(seg), 'NA') || ')' AS pasted FROM c
"""

ORACLE["literal_table_join"] = """
SELECT c.c_custkey, n.n_name FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
WHERE n.n_name IN ('NATION_3', 'NATION_7', 'NATION_11')
"""

ORACLE["cond_sum"] = """
SELECT c_nationkey,
       CAST(sum(CASE WHEN c_acctbal < 0 THEN CAST(c_acctbal AS DECIMAL(28,6)) ELSE 0 END) AS DOUBLE) AS discount,
       CAST(sum(CASE WHEN c_acctbal > 0 THEN CAST(c_acctbal AS DECIMAL(28,6)) ELSE 0 END) AS DOUBLE) AS gross
FROM customer GROUP BY c_nationkey
"""

ORACLE["sentinel_row"] = """
SELECT DISTINCT c.c_mktsegment AS segment, n.n_name AS nation, r.r_name AS region
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
UNION ALL
SELECT 'Not Specified', 'Not Specified', 'Not Specified'
"""

ORACLE["fanout_join"] = f"""
WITH cost AS (SELECT l_orderkey, l_suppkey, {_M.format("l_extendedprice")} AS cost FROM lineitem GROUP BY 1, 2)
SELECT o.o_orderkey, cost.l_suppkey, o.o_orderdate, cost.cost FROM orders o JOIN cost ON o.o_orderkey = cost.l_orderkey
"""

ORACLE["composite_left_join"] = f"""
WITH li AS (SELECT l_partkey, CAST(l_shipdate AS DATE) AS ship_date, l_quantity, l_returnflag FROM lineitem),
s AS (SELECT l_partkey, ship_date, {_M.format("l_quantity")} AS qty FROM li GROUP BY 1, 2),
r AS (SELECT l_partkey, ship_date, {_M.format("l_quantity")} AS returned_qty FROM li WHERE l_returnflag = 'R'
      GROUP BY 1, 2)
SELECT s.l_partkey, s.ship_date, s.qty, r.returned_qty
FROM s LEFT JOIN r ON s.l_partkey = r.l_partkey AND s.ship_date = r.ship_date
"""

ORACLE["or_and_precedence"] = """
SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%bolt%' OR p_brand = 'Brand#1' AND p_size < 10
"""

ORACLE["similar_to_class"] = """
SELECT p_partkey, p_name,
       CASE WHEN regexp_matches(lower(p_name), 'ring|gear') THEN 'Tour'
            WHEN regexp_matches(lower(p_name), 'bolt|rod') THEN 'Call' END AS meeting_type
FROM part WHERE regexp_matches(lower(p_name), 'ring|gear|bolt|rod')
"""

# ---------------------------------------------------------------- spend

_LINES = """
SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS campaign_date, p_name, l_quantity, l_extendedprice,
       l_returnflag, l_discount
FROM lineitem JOIN part ON l_partkey = p_partkey
"""

ORACLE["spend_union"] = f"""
WITH l AS ({_LINES})
SELECT 'A' AS source, campaign_date, p_name AS campaign_name, l_quantity AS clicks, l_extendedprice AS spend
FROM l WHERE l_returnflag = 'A'
UNION
SELECT 'N', campaign_date, p_name, {_M.format("l_quantity")}, {_M.format("l_extendedprice")}
FROM l WHERE l_returnflag = 'N' GROUP BY campaign_date, p_name
UNION
SELECT 'R', campaign_date, p_name, l_quantity, l_extendedprice FROM l WHERE l_returnflag = 'R'
"""

ORACLE["spend_allocation"] = f"""
WITH l AS ({_LINES}),
s AS (SELECT l_orderkey, l_linenumber, p_name AS campaign_name, campaign_date,
             coalesce(CASE WHEN l_discount > 0 THEN l_extendedprice END, 0) AS spend FROM l),
p AS (SELECT *,
        CASE WHEN regexp_matches(campaign_name, 'ring', 'i') THEN 'Suite'
             WHEN regexp_matches(campaign_name, 'gear', 'i') THEN 'Room'
             WHEN regexp_matches(campaign_name, 'bolt', 'i') THEN 'Desk' ELSE 'Non-Specific' END AS product,
        CASE WHEN regexp_matches(campaign_name, 'small', 'i') THEN 'North'
             WHEN regexp_matches(campaign_name, 'red', 'i') THEN 'South'
             WHEN regexp_matches(campaign_name, 'blue', 'i') THEN 'West' ELSE 'Non-Specific' END AS market
      FROM s)
SELECT l_orderkey, l_linenumber, product, market,
       CAST(date_trunc('week', campaign_date) AS DATE) AS spend_week,
       CAST(date_trunc('month', campaign_date) AS DATE) AS spend_month, spend,
       CASE WHEN product = 'Suite' THEN spend WHEN product = 'Non-Specific'
            THEN spend * CAST(0.4 AS DOUBLE) ELSE 0.0 END AS suite,
       CASE WHEN product = 'Desk' THEN spend WHEN product = 'Non-Specific'
            THEN spend * CAST(0.4 AS DOUBLE) ELSE 0.0 END AS desk,
       CASE WHEN product = 'Room' THEN spend WHEN product = 'Non-Specific'
            THEN spend * CAST(0.2 AS DOUBLE) ELSE 0.0 END AS room
FROM p
"""

# ---------------------------------------------------------------- pages / URLs

_HOST = r"lower(nullif(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]*)', 1), ''))"

ORACLE["url_split"] = """
SELECT page_id, string_split(url, 'utm_source=')[1] AS url, string_split(url, 'utm_source=')[2] AS utm_tail FROM pages
"""

ORACLE["url_params"] = rf"""
SELECT page_id, {_HOST} AS host,
       nullif(regexp_extract(url, '[?&]utm_source=([^&#]*)', 1), '') AS utm_source,
       nullif(regexp_extract(url, '[?&]utm_medium=([^&#]*)', 1), '') AS utm_medium,
       nullif(regexp_extract(url, '[?&]utm_campaign=([^&#]*)', 1), '') AS utm_campaign,
       regexp_replace(url, '\?.*$', '') AS first_page
FROM pages
"""

ORACLE["distinct_dim_enrich"] = rf"""
WITH p AS (SELECT page_id, {_HOST} AS host FROM pages),
d AS (SELECT DISTINCT host,
        CASE WHEN regexp_matches(host, '^blog\.', 'i') THEN 'Blog'
             WHEN regexp_matches(host, '^m\.', 'i') THEN 'Mobile'
             WHEN regexp_matches(host, '\.org$', 'i') THEN 'Organisation' ELSE 'Web' END AS site_kind
      FROM p)
SELECT p.page_id, p.host, d.site_kind FROM p LEFT JOIN d ON p.host = d.host
"""
