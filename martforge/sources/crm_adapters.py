"""CRM-shaped source tables derived from the driver tables.

Stage histories come from events (an event is a stage change of the
visitor's opportunity), opportunities and roles from customer / orders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.sources.io import read_table

# Event type -> stage label in the marketing CRM and in the sales CRM.
HS_STAGE_OF_EVENT = {"signup": "Tour Scheduled", "view": "Qualified - Local Fill Opportunity",
                     "click": "Contract Negotiation", "purchase": "Closed Won", "error": "Cold/Dead"}
CRM_STAGE_OF_EVENT = {"signup": "Touring", "view": "Prospecting", "click": "Negotiation/Proposal",
                      "purchase": "Closed Won", "error": "Closed Lost"}
# Record type per customer segment.
RECORD_TYPE_OF_SEGMENT = {"FURNITURE": "Broker-Led", "MACHINERY": "Enterprise", "HOUSEHOLD": "Partner"}


def _map(col: str, mapping: dict, default=None):
    expr = None
    for k, v in mapping.items():
        expr = F.when(F.col(col) == k, F.lit(v)) if expr is None else expr.when(F.col(col) == k, F.lit(v))
    return expr.otherwise(F.lit(default)) if default is not None else expr


def _events(spark, sf_dir):
    return read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value"])


def deal_property_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events(spark, sf_dir).where(F.col("value") < 20)
    return ev.select((F.col("user_id") + 100000).alias("deal_id"),
                     F.when(F.col("value") < 19, F.lit("deal_pipeline_stage_id")).otherwise(F.lit("dealname"))
                     .alias("name"),
                     F.concat(F.lit("st_"), F.col("event_type")).alias("value"), F.col("ts").alias("timestamp"),
                     F.lit("CRM_UI").alias("source"), F.col("event_id").cast("string").alias("source_id"))


def deal_pipeline_stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    types = _events(spark, sf_dir).select("event_type").distinct()
    default = types.select(F.concat(F.lit("st_"), F.col("event_type")).alias("stage_id"),
                           F.lit("default").alias("pipeline_id"), _map("event_type", HS_STAGE_OF_EVENT).alias("label"))
    other = types.select(F.concat(F.lit("st_"), F.col("event_type")).alias("stage_id"),
                         F.lit("other").alias("pipeline_id"), F.upper(F.col("event_type")).alias("label"))
    return default.unionByName(other)


def opportunity_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events(spark, sf_dir).where(F.col("value") >= 20)
    return ev.select(F.concat(F.lit("OPP"), F.col("user_id").cast("string")).alias("opportunity_id"),
                     F.col("ts").alias("created_date"),
                     F.when(F.col("value") <= 250, _map("event_type", CRM_STAGE_OF_EVENT)).alias("stage_name"),
                     (F.col("value") > 480).alias("is_deleted"))


def _customers(spark, sf_dir):
    return read_table(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"])


def opportunities(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _customers(spark, sf_dir)
    return c.select(F.concat(F.lit("OPP"), F.col("c_custkey").cast("string")).alias("id"),
                    F.concat(F.lit("RT_"), F.col("c_mktsegment")).alias("record_type_id"))


def record_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    seg = _customers(spark, sf_dir).select("c_mktsegment").distinct()
    return seg.select(F.concat(F.lit("RT_"), F.col("c_mktsegment")).alias("id"),
                      _map("c_mktsegment", RECORD_TYPE_OF_SEGMENT, "Local Fill").alias("name"),
                      F.lit("Opportunity").alias("sobject_type"))


def imported_deals(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events(spark, sf_dir)
    return ev.select(F.concat(F.lit("OPP"), F.col("user_id").cast("string")).alias("salesforce_opportunity_id"),
                     (F.col("user_id") + F.when(F.col("value") < 300, F.lit(100000)).otherwise(F.lit(200000)))
                     .alias("hubspot_opportunity_id"),
                     F.col("ts").alias("_fivetran_synced"))


def marketing_deals(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders", ["o_custkey", "o_totalprice", "o_orderdate"])
    g = o.groupBy("o_custkey").agg(F.max("o_totalprice").alias("property_amount"),
                                   F.max("o_orderdate").alias("property_closedate"))
    return g.select((F.col("o_custkey") + 100000).alias("deal_id"), "property_amount", "property_closedate")


# ---------------------------------------------------------------- engagement log and contacts

# Call disposition code -> label (the CRM's standard call outcomes).
DISPOSITION_LABELS = {
    "9d9162e7-6cf3-4944-bf63-4dff82258764": "Busy",
    "f240bbac-87c9-4f6e-bf70-924b57d47db7": "Connected",
    "a4c4c377-d246-4b32-a13b-75a56a4cd0ff": "Left live message",
    "b2cf5968-551e-4856-9783-52b3da59a7d0": "Left voicemail",
    "73a0d17f-1163-4015-bdd5-ec830791da20": "No answer",
    "17b47fee-58de-441e-a44c-c6300d46f273": "Wrong number",
}
# Event type -> engagement type.
ENGAGEMENT_TYPE_OF_EVENT = {"click": "EMAIL", "view": "INCOMING_EMAIL", "purchase": "CALL", "signup": "MEETING",
                            "error": "TASK"}
REP_OWNER_ID = 7
CONTACT_LIST_ID = 30
BROKER_TEAM_ID = "team-9"


def engagement(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events(spark, sf_dir)
    return ev.select(F.col("event_id").alias("id"), _map("event_type", ENGAGEMENT_TYPE_OF_EVENT).alias("type"),
                     F.when(F.col("value") < 50, F.lit(REP_OWNER_ID)).otherwise(F.lit(8)).alias("owner_id"),
                     F.col("ts").alias("created_at"),
                     F.when(F.col("event_type") == "signup", F.lit("First tour")).alias("activity_type"))


def engagement_contact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).select(F.col("event_id").alias("engagement_id"), F.col("user_id").alias("contact_id"))


def engagement_call(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events(spark, sf_dir).where(F.col("event_type") == "purchase")
    slot = F.pmod(F.col("event_id"), F.lit(8))
    disp = None
    for i, code in enumerate(DISPOSITION_LABELS):
        disp = F.when(slot == i, F.lit(code)) if disp is None else disp.when(slot == i, F.lit(code))
    disp = disp.when(slot == 6, F.lit("00000000-0000-0000-0000-000000000000"))
    return ev.select(F.col("event_id").alias("engagement_id"), disp.alias("disposition"),
                     F.when(F.col("value") > 100, F.lit("COMPLETED")).otherwise(F.lit("CALLING")).alias("status"),
                     F.concat(F.lit("+1"), F.col("user_id").cast("string")).alias("to_number"),
                     F.concat(F.lit("+2"), F.pmod("event_id", F.lit(4)).cast("string")).alias("from_number"),
                     F.concat(F.lit("x"), F.col("event_id").cast("string")).alias("external_id"),
                     F.floor(F.col("value") * 1000).cast("long").alias("duration_milliseconds"),
                     F.when(F.pmod("event_id", F.lit(2)) == 0,
                            F.concat(F.lit("call notes "), F.pmod("event_id", F.lit(5)).cast("string"))).alias("body"))


def engagement_email(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events(spark, sf_dir).where(F.col("event_type").isin("click", "view"))
    return ev.select(F.col("event_id").alias("engagement_id"),
                     F.when(F.col("value") > 60, F.lit("BOUNCED")).otherwise(F.lit("SENT")).alias("status"),
                     F.concat(F.lit("subject "), F.col("user_id").cast("string")).alias("subject"),
                     F.when(F.pmod("event_id", F.lit(3)) != 0,
                            F.concat(F.lit("mail "), F.pmod("event_id", F.lit(4)).cast("string"))).alias("text"))


def engagement_meeting(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events(spark, sf_dir).where(F.col("event_type") == "signup")
    slot = F.pmod(F.col("event_id"), F.lit(3))
    title = (F.when(slot == 0, F.lit("Excited for your TOUR!")).when(slot == 1, F.lit("Learn more about the space"))
             .otherwise(F.lit("Weekly sync")))
    return ev.select(F.col("event_id").alias("engagement_id"), title.alias("title"),
                     (F.col("ts") + F.expr("INTERVAL 1 DAY")).alias("start_time"),
                     F.concat(F.lit("agenda "), F.pmod("event_id", F.lit(3)).cast("string")).alias("body"))


def contact_list_member(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _customers(spark, sf_dir)
    base = c.select(F.col("c_custkey").alias("contact_id"),
                    F.when(F.col("c_mktsegment") == "HOUSEHOLD", F.lit(31)).otherwise(F.lit(CONTACT_LIST_ID)).alias("contact_list_id"),
                    (F.col("c_acctbal") < -900).alias("_fivetran_deleted"))
    dup = c.where(F.col("c_acctbal") > 9900).select(F.col("c_custkey").alias("contact_id"),
                                                    F.lit(CONTACT_LIST_ID).alias("contact_list_id"),
                                                    F.lit(False).alias("_fivetran_deleted"))
    return base.unionByName(dup)


def company(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name"])
    return n.select(F.col("n_nationkey").cast("long").alias("id"),
                    F.when(F.col("n_nationkey") != 4, F.col("n_name")).alias("property_name"))


def contact(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _customers(spark, sf_dir)
    o = read_table(spark, sf_dir, "orders", ["o_custkey", "o_orderdate"])
    span = o.groupBy("o_custkey").agg(F.min("o_orderdate").alias("first_order"), F.max("o_orderdate").alias("last_order"))
    j = c.join(span, c["c_custkey"] == span["o_custkey"], "left")
    k, bal, nat, seg = F.col("c_custkey"), F.col("c_acctbal"), F.col("c_nationkey"), F.col("c_mktsegment")
    sources = ["DIRECT_TRAFFIC", "ORGANIC_SEARCH", "PAID_SEARCH", "PAID_SOCIAL", "SOCIAL_MEDIA", "OFFLINE", "REFERRALS"]
    src = None
    for i, s in enumerate(sources):
        src = F.when(F.pmod(k, F.lit(8)) == i, F.lit(s)) if src is None else src.when(F.pmod(k, F.lit(8)) == i, F.lit(s))
    d1 = (F.when(F.pmod(k, F.lit(5)) == 0, F.lit("SALESFORCE")).when(F.pmod(k, F.lit(5)) == 1, F.lit("Broker portal"))
          .when(F.pmod(k, F.lit(5)) == 2, F.lit("Enterprise list")).when(F.pmod(k, F.lit(5)) == 3, F.lit("own.example/"))
          .otherwise(F.lit("Facebook")))
    d2 = (F.when(F.pmod(k, F.lit(4)) == 0, F.lit("lead-gen")).when(F.pmod(k, F.lit(4)) == 1, F.lit("Google"))
          .when(F.pmod(k, F.lit(4)) == 2, F.lit("Blog")))
    stage = (F.when(F.pmod(nat, F.lit(6)) == 0, F.lit("lead")).when(F.pmod(nat, F.lit(6)) == 1, F.lit("subscriber"))
             .when(F.pmod(nat, F.lit(6)) == 2, F.lit("other")).when(F.pmod(nat, F.lit(6)) == 3, F.lit("opportunity"))
             .when(F.pmod(nat, F.lit(6)) == 4, F.lit("customer")))
    return j.select(
        k.alias("id"), F.col("first_order").alias("property_createdate"),
        F.when(F.pmod(k, F.lit(50)) == 0, F.lit("Test")).otherwise(F.lit("Pat")).alias("property_firstname"),
        F.col("c_name").alias("property_lastname"),
        F.when(nat == 7, F.lit("OwnCo Ltd")).otherwise(seg).alias("property_company"),
        F.when(nat != 3, F.concat(F.lower(F.col("c_name")), F.lit("@mail.example"))).alias("property_email"),
        stage.alias("property_lifecyclestage"), nat.cast("long").alias("property_associatedcompanyid"),
        src.alias("property_hs_analytics_source"), d1.alias("property_hs_analytics_source_data_1"),
        d2.alias("property_hs_analytics_source_data_2"),
        F.when(bal > 7000, F.lit("https://adwords.example/")).alias("property_hs_analytics_first_referrer"),
        F.concat(F.lit("https://own.example/lp/"), nat.cast("string"), F.lit("?ref=x")).alias(
            "property_hs_analytics_first_url"),
        F.when(F.pmod(k, F.lit(9)) == 0, F.lit("3rd Party Aggregator")).alias("property_offline_source_drill_down_1"),
        F.when(F.pmod(k, F.lit(11)) == 0, F.lit(BROKER_TEAM_ID)).alias("property_hs_all_team_ids"),
        F.when(bal > 3000, bal).alias("property_budget"), F.when(bal > 0, bal / F.lit(2.0)).alias("property_amount"),
        F.when(F.pmod(nat, F.lit(2)) == 0, F.col("last_order")).alias("property_start_date"),
        F.col("first_order").alias("property_move_in_date"),
        F.when(nat < 10, F.concat(F.lit("NATION_"), nat.cast("string"))).alias(
            "property_in_which_location_are_you_interested_"),
        F.when(F.pmod(k, F.lit(3)) == 0, F.lit("Suite")).alias("property_in_which_service_are_you_interested_"),
        F.when(F.pmod(k, F.lit(3)) == 1, F.lit("Desk")).alias("property_what_type_of_workspace_are_you_interested_in_"),
        F.when(F.pmod(k, F.lit(3)) != 0, F.col("first_order") + F.expr("INTERVAL 36 HOURS")).alias(
            "property_hs_lifecyclestage_lead_date"),
        F.col("last_order").alias("property_hs_lifecyclestage_marketingqualifiedlead_date"),
        F.lit(None).cast("timestamp_ntz").alias("property_hs_lifecyclestage_salesqualifiedlead_date"),
        F.lit(None).cast("timestamp_ntz").alias("property_hs_lifecyclestage_opportunity_date"),
        F.lit(None).cast("timestamp_ntz").alias("property_hs_lifecyclestage_customer_date"),
        F.when(bal < 0, F.lit("budget")).alias("property_disqualified_reason"),
        F.concat(F.lit("TC"), nat.cast("string")).alias("property_digital_tracking_code"),
        F.when(F.pmod(k, F.lit(4)) == 0, F.lit("Yes")).alias("property_isr_review"),
        F.concat(F.lit("L"), k.cast("string")).alias("property_salesforceleadid"),
        F.lit(None).cast("string").alias("property_salesforcecontactid"))


def engagement_task(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Task details for most task engagements (some have none: the extract left-joins)."""
    ev = _events(spark, sf_dir).where((F.col("event_type") == "error") & (F.col("value") > 1))
    done = F.col("value") < 100
    ms = F.unix_millis(F.col("ts").cast("timestamp")) + F.floor(F.col("value") * F.lit(3600000.0)).cast("long")
    return ev.select(F.col("event_id").alias("engagement_id"),
                     F.when(F.col("value") > 30, F.lit("CALL")).otherwise(F.lit("EMAIL")).alias("task_type"),
                     F.when(done, ms).alias("completion_date"),
                     F.when(done, F.lit("COMPLETED")).when(F.col("value") <= 150, F.lit("NOT_STARTED"))
                     .alias("status"),
                     F.lit("follow up").alias("subject"),
                     F.when(F.pmod("event_id", F.lit(2)) == 1,
                            F.concat(F.lit("task "), F.col("event_id").cast("string"))).alias("body"))


def contact_property_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events(spark, sf_dir).where((F.col("event_type") == "view") & (F.col("value") < 10))
    return ev.select(F.col("user_id").alias("contact_id"), F.lit("isr_review").alias("name"),
                     F.when(F.col("value") < 5, F.lit("Yes")).otherwise(F.lit("No")).alias("value"),
                     F.col("ts").alias("timestamp"))


def location_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """External location dimension: location label -> city and site name."""
    n = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    r = read_table(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    j = n.join(r, n["n_regionkey"] == r["r_regionkey"])
    return j.select(F.col("n_name").alias("hs_locations"), F.col("r_name").alias("city"),
                    F.lower(F.col("n_name")).alias("site_name"))


def buildings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Building records (one per customer, many duplicates: the extract is DISTINCT)."""
    c = _customers(spark, sf_dir)
    n = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    r = read_table(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    j = c.join(n, c["c_nationkey"] == n["n_nationkey"]).join(r, n["n_regionkey"] == r["r_regionkey"])
    nat = F.col("c_nationkey")
    return j.select(F.concat(F.lit("LOC"), nat.cast("string")).alias("building_name_c"),
                    F.col("n_name").alias("name"),
                    F.concat(F.lit("hood "), F.col("c_mktsegment")).alias("neighborhood_name_c"),
                    F.when(nat < 12, F.concat(F.lit("sub "), nat.cast("string"))).alias("submarket_temp_c"),
                    F.col("n_name").alias("city_c"), F.lit(None).cast("string").alias("state_province_c"),
                    F.col("r_name").alias("sub_region_c"), F.col("n_name").alias("country_c"),
                    F.col("r_name").alias("region_c"))
