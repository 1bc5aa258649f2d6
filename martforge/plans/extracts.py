"""Save-only extracts: datasets the source job writes but no transform reads.

* ``pipeline_moves``: deals seen in both of two pipelines (count distinct + HAVING),
* ``second_pipeline_history``: stage log of the second pipeline (constant in the ON clause),
* ``form_hits``: form views / submits per visit (IN filter + grouped count),
* ``deleted_deals``: deletion ids from two lists (UNION, distinct),
* ``tours``: tours from two sources (UNION); the second leg keeps the source's
  ``A OR B AND C`` precedence, so a deleted event whose subject names a tour is kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.operators.setops import union_distinct
from martforge.plans.crm_marts import DealRules, marketing_deal_history


def pipeline_moves(history: DataFrame, pipelines: tuple[str, str]) -> DataFrame:
    h = history.where((F.col("name") == "deal_pipeline_id") & F.col("value").isin(*pipelines))
    g = h.groupBy("deal_id").agg(F.count_distinct("value").alias("num_pipelines"))
    return g.where(F.col("num_pipelines") == 2).select("deal_id", F.lit("yes").alias("broker_pipeline"))


def form_hits(hits: DataFrame) -> DataFrame:
    h = hits.where((F.col("event_info_category") == "lead form")
                   & F.col("event_info_action").isin("lead form viewed", "lead form submitted"))
    keys = ["page_hostname", "page_page_path", "visit_start_time", "visit_id", "event_info_action"]
    return h.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))


def deleted_deals(deletions: DataFrame, before_webhook: DataFrame, portal_id: int) -> DataFrame:
    a = deletions.where(F.col("portal_id") == portal_id).select(F.col("object_id").alias("deal_id"))
    return union_distinct([a, before_webhook.select("deal_id")])


def tours(awareness: DataFrame, events: DataFrame, buildings: DataFrame, contacts: DataFrame,
          opportunities: DataFrame) -> DataFrame:
    b = buildings.select(F.col("id").alias("b_id"), F.col("name").alias("unit"))
    c = contacts.select(F.col("id").alias("c_id"), F.col("name").alias("contact"))
    leg1 = (awareness.where(F.col("is_deleted") == F.lit(False))
            .join(b, F.col("building_c") == F.col("b_id"), "left")
            .join(c, F.col("contact_c") == F.col("c_id"), "left")
            .select("id", F.col("building_c").alias("what_id"), "unit", F.col("contact_c").alias("who_id"), "contact",
                    F.col("name").alias("tour_type"), "created_date", F.col("date_toured_c").alias("activity_date"),
                    F.lit("Awareness Tours").alias("source")))
    o = opportunities.select(F.col("id").alias("o_id"), "building_fill_c")
    keep = F.col("subject").contains("Tour") | (F.col("description").contains("tour")
                                                & (F.col("is_deleted") == F.lit(False)))
    leg2 = (events.join(o, F.col("what_id") == F.col("o_id"), "left")
            .join(b, F.col("building_fill_c") == F.col("b_id"), "left")
            .join(c, F.col("who_id") == F.col("c_id"), "left")
            .where(keep)
            .select("id", "what_id", "unit", "who_id", "contact", F.col("subject").alias("tour_type"), "created_date",
                    "activity_date", F.lit("Events").alias("source")))
    return union_distinct([leg1, leg2])


# ---------------------------------------------------------------- adapted runs on the driver tables

def pipeline_moves_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from martforge.sources import extract_adapters as A
    return pipeline_moves(A.deal_pipeline_history(spark, sf_dir), ("default", "other"))


def second_pipeline_history_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from martforge.sources import crm_adapters as C
    return marketing_deal_history(C.deal_property_history(spark, sf_dir), C.deal_pipeline_stages(spark, sf_dir),
                                  DealRules(pipeline_id="other"))


def form_hits_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from martforge.sources import extract_adapters as A
    return form_hits(A.session_hits(spark, sf_dir))


def deleted_deals_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from martforge.sources import extract_adapters as A
    return deleted_deals(A.deal_deletions(spark, sf_dir), A.deal_deletions_before_webhook(spark, sf_dir), A.PORTAL_ID)


def tours_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from martforge.sources import extract_adapters as A
    return tours(A.awareness_tours(spark, sf_dir), A.crm_events(spark, sf_dir), A.buildings(spark, sf_dir),
                 A.contacts(spark, sf_dir), A.opportunities(spark, sf_dir))


def access_events(events: DataFrame, links: DataFrame, people: DataFrame, addresses: DataFrame) -> DataFrame:
    """Granted / denied swipes with member and reader: the link table is used in two
    roles (person, reader), each the latest link version per (event, object, relation)."""
    from martforge.operators.history import latest_version
    ev = events.where(F.col("message_short").isin("Access Granted", "Access denied"))
    wanted = links.where(F.col("relation").isin("Person", "Reader"))
    lo = latest_version(wanted.join(ev.select(F.col("event_id").alias("e_id")), F.col("event_id") == F.col("e_id")),
                        ["event_id", "linked_object_id", "relation"], "hdp_created_ts")
    lo = lo.select("event_id", "linked_object_id", "common_name",
                                                                     "relation")
    person = lo.where(F.col("relation") == "Person").select(F.col("event_id").alias("p_event"),
                                                            F.col("linked_object_id").alias("person_id"))
    reader = lo.where(F.col("relation") == "Reader").select(F.col("event_id").alias("r_event"),
                                                            F.col("common_name").alias("reader_name"))
    emails = latest_version(addresses, ["address_id"], "hdp_created_ts").select(
        F.col("people_id").alias("e_people"), F.col("mail_to").alias("member_email"))
    j = (ev.join(person, ev["event_id"] == F.col("p_event"))
         .join(reader, ev["event_id"] == F.col("r_event"))
         .join(people, F.col("person_id") == people["people_id"])
         .join(emails, people["people_id"] == F.col("e_people")))
    return j.select(ev["event_id"], "message_short", "published_on", "occurred_on",
                    people["common_name"].alias("member_name"), "member_email", "reader_name")


def crm_activity(tasks: DataFrame, events: DataFrame, users: DataFrame, opportunities: DataFrame,
                 record_types: DataFrame, excluded_type: str) -> DataFrame:
    """Tasks and calendar events on opportunities of every record type but one (UNION)."""
    rt = record_types.where(F.col("name") != excluded_type).select(F.col("id").alias("rt_id"))
    opp = opportunities.join(rt, F.col("record_type_id") == F.col("rt_id")).select(F.col("id").alias("o_id"))
    u = users.select(F.col("id").alias("u_id"), "alias", F.col("name").alias("creator"))

    def leg(df, subtype, kind):
        j = df.join(u, F.col("created_by_id") == F.col("u_id")).join(opp, F.col("what_id") == F.col("o_id"))
        return j.select(F.col(subtype).alias("subtype"), "subject", "created_date", "activity_date",
                        F.col("who_id").alias("contact_id"), F.col("what_id").alias("opportunity_id"), "alias",
                        "creator", F.lit(kind).alias("type"))

    return union_distinct([leg(tasks, "task_subtype", "task"), leg(events, "event_subtype", "event")])


def access_events_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from martforge.sources import extract_adapters as A
    return access_events(A.access_events(spark, sf_dir), A.access_links(spark, sf_dir), A.people(spark, sf_dir),
                         A.addresses(spark, sf_dir))


def crm_activity_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from martforge.sources import crm_adapters as C
    from martforge.sources import extract_adapters as A
    return crm_activity(A.crm_tasks(spark, sf_dir), A.crm_calendar_events(spark, sf_dir), A.crm_users(spark, sf_dir),
                        C.opportunities(spark, sf_dir), C.record_types(spark, sf_dir), "Partner")


def lifecycle_history(history: DataFrame) -> DataFrame:
    """Lifecycle-stage changes; the second column is renamed by position in the source."""
    h = history.where(F.col("name") == "lifecyclestage")
    cols = h.columns
    return h.select(*[F.col(c).alias("property_name") if i == 1 else F.col(c) for i, c in enumerate(cols)])


def deals_with_owner(deals: DataFrame, owners: DataFrame) -> DataFrame:
    o = owners.select(F.col("owner_id").alias("o_owner_id"), F.col("email").alias("sales_owner"))
    return deals.join(o, deals["owner_id"] == F.col("o_owner_id"), "left").drop("o_owner_id")


def stage_probabilities(stages: DataFrame, pipelines: DataFrame) -> DataFrame:
    pl = pipelines.select(F.col("pipeline_id").alias("pl_id"), F.col("label").alias("pipeline"))
    j = stages.where(F.col("active") == "true").join(pl, F.col("pipeline_id") == F.col("pl_id"))
    return j.select("pipeline_id", "pipeline", F.col("label").alias("pipeline_stage"), "stage_id", "probability")


def lifecycle_history_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from martforge.sources import extract_adapters as A
    return lifecycle_history(A.contact_history(spark, sf_dir))


def deals_with_owner_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from martforge.sources import extract_adapters as A
    return deals_with_owner(A.crm_deals(spark, sf_dir), A.crm_owners(spark, sf_dir))


def stage_probabilities_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from martforge.sources import extract_adapters as A
    return stage_probabilities(A.pipeline_stage_table(spark, sf_dir), A.pipelines(spark, sf_dir))


LEAD_COLUMNS = ["id", "first_name", "last_name", "company", "contact_company_c", "is_converted", "created_date",
                "converted_date", "converted_contact_id", "converted_account_id", "converted_opportunity_id",
                "fill_product_c", "location_c", "lead_source", "source_c", "data_source_1_c", "data_source_2_c",
                "data_source_3_c", "digital_tracking_code_c"]


def crm_leads(leads: DataFrame, record_types: DataFrame, users: DataFrame, lead_type: str) -> DataFrame:
    """Leads of one record type (constants in the ON clause), not deleted, with their creator."""
    rt = (record_types.where((F.col("sobject_type") == "Lead") & (F.col("name") == lead_type))
                           .select(F.col("id").alias("rt_id")))
    u = users.select(F.col("id").alias("u_id"), F.col("name").alias("creator"))
    j = (leads.where(F.col("is_deleted") == F.lit(False)).join(rt, F.col("record_type_id") == F.col("rt_id"))
         .join(u, F.col("created_by_id") == F.col("u_id")))
    return j.select(*LEAD_COLUMNS, "creator")


def chatter_posts(feed: DataFrame, opportunities: DataFrame, record_types: DataFrame,
                  types: tuple[str, ...]) -> DataFrame:
    """Text posts on opportunities of the listed record types, not deleted."""
    rt = (record_types.where((F.col("sobject_type") == "Opportunity") & F.col("name").isin(*types))
                           .select(F.col("id").alias("rt_id")))
    opp = opportunities.join(rt, F.col("record_type_id") == F.col("rt_id")).select(F.col("id").alias("o_id"))
    j = (feed.where((F.col("type") == "TextPost") & (F.col("is_deleted") == F.lit(False)))
         .join(opp, F.col("parent_id") == F.col("o_id")))
    return j.select(F.col("parent_id").alias("opportunity_id"), "created_date", "created_by_id", "body")


def crm_leads_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from martforge.sources import extract_adapters as A
    return crm_leads(A.leads(spark, sf_dir), A.lead_record_types(spark, sf_dir), A.crm_users(spark, sf_dir), "Fill")


def chatter_posts_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from martforge.sources import crm_adapters as C
    from martforge.sources import extract_adapters as A
    return chatter_posts(A.opportunity_feed(spark, sf_dir), C.opportunities(spark, sf_dir),
                         C.record_types(spark, sf_dir), ("Broker-Led", "Local Fill", "Enterprise"))
