"""Source tables of the save-only extracts, derived from the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.sources.io import read_table

PORTAL_ID = 42


def _events(spark, sf_dir):
    return read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value"])


def deal_pipeline_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pipeline-change log: each event moves the visitor's deal into a pipeline."""
    ev = _events(spark, sf_dir)
    pipe = (F.when(F.col("event_type").isin("click", "view"), F.lit("default"))
            .when(F.col("event_type") == "signup", F.lit("other")).otherwise(F.lit("archive")))
    return ev.select((F.col("user_id") + 100000).alias("deal_id"), F.lit("deal_pipeline_id").alias("name"),
                     pipe.alias("value"), F.col("ts").alias("timestamp"))


def session_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events(spark, sf_dir)
    pages = read_table(spark, sf_dir, "pages", ["page_id", "url"])
    n = int(pages.agg(F.max("page_id")).first()[0]) + 1
    j = ev.join(pages, F.pmod(ev["event_id"], F.lit(n)) == pages["page_id"])
    et = F.col("event_type")
    return j.select(
        F.lower(F.regexp_extract("url", r"^[A-Za-z]+://([^/?#:]+)", 1)).alias("page_hostname"),
        F.regexp_extract("url", r"^[A-Za-z]+://[^/?#]+([^?#]*)", 1).alias("page_page_path"),
        F.date_trunc("hour", F.col("ts")).cast("timestamp_ntz").alias("visit_start_time"),
        F.col("user_id").alias("visit_id"),
        F.when(et.isin("signup", "purchase", "click"), F.lit("lead form")).otherwise(F.lit("page")).alias(
            "event_info_category"),
        F.when(et == "signup", F.lit("lead form viewed")).when(et == "purchase", F.lit("lead form submitted"))
        .when(et == "click", F.lit("lead form closed")).otherwise(F.lit("scroll")).alias("event_info_action"))


def deal_deletions(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events(spark, sf_dir).where(F.col("event_type") == "error")
    return ev.select((F.col("user_id") + 100000).alias("object_id"),
                     F.when(F.col("value") < 100, F.lit(PORTAL_ID)).otherwise(F.lit(7)).cast("long").alias("portal_id"))


def deal_deletions_before_webhook(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events(spark, sf_dir).where((F.col("event_type") == "view") & (F.col("value") > 150))
    return ev.select((F.col("user_id") + 100000).alias("deal_id"))


def buildings(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name"])
    return n.select(F.concat(F.lit("B"), F.col("n_nationkey").cast("string")).alias("id"), F.col("n_name").alias("name"))


def contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_name"])
    return c.select(F.concat(F.lit("CT"), F.col("c_custkey").cast("string")).alias("id"), F.col("c_name").alias("name"))


def opportunities(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey"])
    return c.select(F.concat(F.lit("OPP"), F.col("c_custkey").cast("string")).alias("id"),
                    F.concat(F.lit("B"), F.col("c_nationkey").cast("string")).alias("building_fill_c"))


def awareness_tours(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate",
                                             "o_orderpriority"]).where(F.col("o_orderpriority") == "1-URGENT")
    return o.select(F.concat(F.lit("AT"), F.col("o_orderkey").cast("string")).alias("id"),
                    F.concat(F.lit("B"), F.pmod(F.col("o_custkey"), F.lit(30)).cast("string")).alias("building_c"),
                    F.concat(F.lit("CT"), F.col("o_custkey").cast("string")).alias("contact_c"),
                    F.concat(F.lit("Tour "), F.col("o_orderstatus")).alias("name"),
                    F.col("o_orderdate").alias("created_date"),
                    F.date_add(F.to_date("o_orderdate"), 7).alias("date_toured_c"),
                    (F.col("o_orderstatus") == "F").alias("is_deleted"))


def crm_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events(spark, sf_dir)
    et = F.col("event_type")
    subject = (F.when(et == "signup", F.lit("Tour booked")).when(et == "click", F.lit("tour follow-up"))
               .when(et == "view", F.lit("Call")).otherwise(F.lit("Meeting")))
    return ev.select(F.concat(F.lit("EV"), F.col("event_id").cast("string")).alias("id"),
                     F.concat(F.lit("OPP"), F.col("user_id").cast("string")).alias("what_id"),
                     F.concat(F.lit("CT"), F.col("user_id").cast("string")).alias("who_id"), subject.alias("subject"),
                     F.when(F.col("value") < 30, F.lit("about the tour")).otherwise(F.lit("general")).alias(
                         "description"),
                     F.col("ts").alias("created_date"), F.to_date("ts").alias("activity_date"),
                     F.concat(F.lit("U"), F.pmod(F.col("user_id"), F.lit(10)).cast("string")).alias("created_by_id"),
                     (F.col("value") > 200).alias("is_deleted"))


# ---------------------------------------------------------------- access control and sales-CRM activity

T0 = "2024-01-01 00:00:00"


def access_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events(spark, sf_dir)
    msg = (F.when(F.col("event_type") == "view", F.lit("Access Granted"))
           .when(F.col("event_type") == "error", F.lit("Access denied")).otherwise(F.lit("Door held")))
    return ev.select(F.concat(F.lit("AE"), F.col("event_id").cast("string")).alias("event_id"), msg.alias("message_short"),
                     F.col("ts").alias("published_on"), F.col("ts").alias("occurred_on"))


def access_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event -> person / reader / controller links; some person links have a later version."""
    ev = _events(spark, sf_dir)
    eid = F.concat(F.lit("AE"), F.col("event_id").cast("string")).alias("event_id")
    person = F.concat(F.lit("P"), F.col("user_id").cast("string")).alias("linked_object_id")
    reader_no = F.floor(F.col("value") / F.lit(50)).cast("long").cast("string")
    p1 = ev.select(eid, person, F.concat(F.lit("person "), F.col("user_id").cast("string")).alias("common_name"),
                   F.lit("Person").alias("relation"), F.col("ts").alias("hdp_created_ts"))
    p2 = ev.where(F.col("value") > 100).select(
        eid, person, F.concat(F.lit("person "), F.col("user_id").cast("string"), F.lit(" (updated)")).alias("common_name"),
        F.lit("Person").alias("relation"), (F.col("ts") + F.expr("INTERVAL 1 HOUR")).alias("hdp_created_ts"))
    rd = ev.select(eid, F.concat(F.lit("R"), reader_no).alias("linked_object_id"),
                   F.concat(F.lit("reader "), reader_no).alias("common_name"), F.lit("Reader").alias("relation"),
                   F.col("ts").alias("hdp_created_ts"))
    ct = ev.where(F.col("event_type") == "signup").select(
        eid, F.lit("CTRL").alias("linked_object_id"), F.lit("controller").alias("common_name"),
        F.lit("Controller").alias("relation"), F.col("ts").alias("hdp_created_ts"))
    return p1.unionByName(p2).unionByName(rd).unionByName(ct)


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_name"])
    return c.select(F.concat(F.lit("P"), F.col("c_custkey").cast("string")).alias("people_id"),
                    F.col("c_name").alias("common_name"))


def addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_acctbal"])
    key = [F.concat(F.lit("A"), F.col("c_custkey").cast("string")).alias("address_id"),
           F.concat(F.lit("P"), F.col("c_custkey").cast("string")).alias("people_id")]
    v1 = c.select(*key, F.concat(F.lower(F.col("c_name")), F.lit("@mail.example")).alias("mail_to"),
                  F.lit(T0).cast("timestamp_ntz").alias("hdp_created_ts"))
    v2 = c.where(F.col("c_acctbal") > 5000).select(
        *key, F.concat(F.lit("new."), F.lower(F.col("c_name")), F.lit("@mail.example")).alias("mail_to"),
        (F.lit(T0).cast("timestamp_ntz") + F.expr("INTERVAL 1 DAY")).alias("hdp_created_ts"))
    return v1.unionByName(v2)


def crm_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read_table(spark, sf_dir, "supplier", ["s_suppkey", "s_name"])
    return s.select(F.concat(F.lit("U"), F.col("s_suppkey").cast("string")).alias("id"),
                    F.concat(F.lit("u"), F.col("s_suppkey").cast("string")).alias("alias"), F.col("s_name").alias("name"))


def crm_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"])
    return o.select(F.lit("Call").alias("task_subtype"), F.concat(F.lit("Follow up "), F.col("o_orderpriority")).alias(
        "subject"), F.col("o_orderdate").alias("created_date"), F.to_date("o_orderdate").alias("activity_date"),
                    F.concat(F.lit("CT"), F.col("o_custkey").cast("string")).alias("who_id"),
                    F.concat(F.lit("OPP"), F.col("o_custkey").cast("string")).alias("what_id"),
                    F.concat(F.lit("U"), F.pmod(F.col("o_orderkey"), F.lit(10)).cast("string")).alias("created_by_id"))


def crm_calendar_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crm_events(spark, sf_dir).select(F.lit("Event").alias("event_subtype"), "subject", "created_date",
                                            "activity_date", "who_id", "what_id", "created_by_id")


# ---------------------------------------------------------------- marketing-CRM small extracts

def contact_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contact property log with two properties (lifecycle stage and review status)."""
    ev = _events(spark, sf_dir).where(F.col("value") < 20)
    name = F.when(F.col("event_type") == "view", F.lit("isr_review")).otherwise(F.lit("lifecyclestage"))
    value = (F.when(F.col("event_type") == "signup", F.lit("lead")).when(F.col("event_type") == "purchase",
                                                                          F.lit("customer"))
             .when(F.col("event_type") == "view", F.lit("Yes")).otherwise(F.lit("opportunity")))
    return ev.select(F.col("user_id").alias("contact_id"), name.alias("name"), value.alias("value"),
                     F.col("ts").alias("timestamp"))


def crm_deals(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders", ["o_custkey", "o_totalprice", "o_orderdate"])
    g = o.groupBy("o_custkey").agg(F.max("o_totalprice").alias("property_amount"),
                                   F.max("o_orderdate").alias("property_closedate"))
    return g.select((F.col("o_custkey") + 100000).alias("deal_id"),
                    F.pmod(F.col("o_custkey"), F.lit(150)).alias("owner_id"), "property_amount", "property_closedate")


def crm_owners(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read_table(spark, sf_dir, "supplier", ["s_suppkey", "s_name"])
    return s.select(F.col("s_suppkey").alias("owner_id"),
                    F.concat(F.lower(F.col("s_name")), F.lit("@sales.example")).alias("email"))


def pipeline_stage_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    from martforge.sources.crm_adapters import deal_pipeline_stages
    st = deal_pipeline_stages(spark, sf_dir)
    return st.select("stage_id", "pipeline_id", "label",
                     (F.length("label").cast("double") / F.lit(40.0)).alias("probability"),
                     F.when(F.col("label").contains("Dead") | (F.col("label") == "ERROR"), F.lit("false"))
                     .otherwise(F.lit("true")).alias("active"))


def pipelines(spark: SparkSession, sf_dir: str) -> DataFrame:
    st = pipeline_stage_table(spark, sf_dir).select("pipeline_id").distinct()
    return st.select("pipeline_id", F.concat(F.initcap(F.col("pipeline_id")), F.lit(" pipeline")).alias("label"))


def leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"])
    k, bal = F.col("c_custkey"), F.col("c_acctbal")
    conv = bal > 5000
    created = F.lit(T0).cast("timestamp_ntz") + F.make_interval(mins=k.cast("int"))
    return c.select(
        F.concat(F.lit("LD"), k.cast("string")).alias("id"), F.concat(F.lit("LRT_"), F.col("c_mktsegment")).alias(
            "record_type_id"), F.concat(F.lit("U"), F.pmod(k, F.lit(10)).cast("string")).alias("created_by_id"),
        F.lit("Pat").alias("first_name"), F.col("c_name").alias("last_name"), F.col("c_mktsegment").alias("company"),
        F.lit(None).cast("string").alias("contact_company_c"), conv.alias("is_converted"), created.alias("created_date"),
        F.when(conv, created + F.expr("INTERVAL 3 DAYS")).alias("converted_date"),
        F.when(conv, F.concat(F.lit("CT"), k.cast("string"))).alias("converted_contact_id"),
        F.when(conv, F.concat(F.lit("AC"), k.cast("string"))).alias("converted_account_id"),
        F.when(conv, F.concat(F.lit("OPP"), k.cast("string"))).alias("converted_opportunity_id"),
        F.when(bal > 8000, F.lit("Room")).alias("fill_product_c"),
        F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string")).alias("location_c"),
        F.lit("Online").alias("lead_source"), F.lit("web").alias("source_c"),
        F.lit("ORGANIC_SEARCH").alias("data_source_1_c"), F.lit(None).cast("string").alias("data_source_2_c"),
        F.lit(None).cast("string").alias("data_source_3_c"), F.lit(None).cast("string").alias("digital_tracking_code_c"),
        (bal < -900).alias("is_deleted"))


def lead_record_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    seg = read_table(spark, sf_dir, "customer", ["c_mktsegment"]).distinct()
    s = F.col("c_mktsegment")
    return seg.select(F.concat(F.lit("LRT_"), s).alias("id"),
                      F.when(s == "BUILDING", F.lit("Other")).otherwise(F.lit("Fill")).alias("name"),
                      F.when(s == "MACHINERY", F.lit("Opportunity")).otherwise(F.lit("Lead")).alias("sobject_type"))


def opportunity_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events(spark, sf_dir)
    return ev.select(F.concat(F.lit("OPP"), F.col("user_id").cast("string")).alias("parent_id"),
                     F.col("ts").alias("created_date"),
                     F.concat(F.lit("U"), F.pmod(F.col("user_id"), F.lit(10)).cast("string")).alias("created_by_id"),
                     F.concat(F.lit("note "), F.col("event_type")).alias("body"),
                     F.when(F.col("event_type").isin("click", "signup"), F.lit("TextPost"))
                     .otherwise(F.lit("TrackedChange")).alias("type"),
                     (F.col("value") > 200).alias("is_deleted"))
