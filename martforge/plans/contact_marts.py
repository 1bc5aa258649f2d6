"""Contact mart: marketing-CRM contacts enriched with meetings, emails, calls,
channel ladders, outreach flags and hours to first contact.

Extracts: list members (membership list joined as an inner join, so a
duplicated membership duplicates the contact), companies, engagement counts,
call log, first email per type, tours-and-calls classified by title.
Transforms: scheduled calls / tours per e-mail (strict min / max), first
email times (pivot, NULL fill), first call and first connected call,
then the contact mart.  ``as_of`` replaces the wall clock.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.functions.dates import hours_between, month_start, quarter_start, week_start, weekday_mon1
from martforge.functions.nulls import (eq_or_false, matches, not_in_keep_null, not_matches, null_safe_on, paste,
                                       strict_max, strict_min)
from martforge.functions.rules import code_map, ladder
from martforge.functions.urls import strip_query
from martforge.operators.aggregates import min_if
from martforge.operators.joins import null_safe_join, null_salted_join
from martforge.operators.reshape import pivot
from martforge.plans.acquisition import acquisition_source


@dataclass(frozen=True)
class ContactRules:
    contact_list_id: int
    broker_team_id: str
    tour_titles: str = r"excited for your tour|learn more about the space|tour of the space"
    tour_class: str = r"excited for your tour|tour of the space"
    test_name: str = "TEST"
    company_drop: str = r"ownco"
    stages_drop: tuple[str, ...] = ("subscriber", "other")
    aggregator: str = "3rd Party Aggregator"
    own_home: str = r"own\.example/$"
    own_site: str = r"own\.example"
    meeting_host: str = r"meetings\.example"
    disposition_labels: tuple[tuple[str, str], ...] = ()


# ---------------------------------------------------------------- extracts

def list_contacts(members: DataFrame, contacts: DataFrame, rules: ContactRules) -> DataFrame:
    m = members.where((F.col("contact_list_id") == rules.contact_list_id) & (F.col("_fivetran_deleted") == F.lit(False)))
    return m.select("contact_id").join(contacts, F.col("contact_id") == contacts["id"]).drop("contact_id")


def contact_engagements(eng_contact: DataFrame, engagement: DataFrame) -> DataFrame:
    j = eng_contact.join(engagement, eng_contact["engagement_id"] == engagement["id"])
    return j.groupBy("contact_id", "type").agg(F.count(F.lit(1)).alias("engagements"))


def phone_call_log(calls: DataFrame, eng_contact: DataFrame, engagement: DataFrame) -> DataFrame:
    j = calls.join(eng_contact, "engagement_id").join(engagement, calls["engagement_id"] == engagement["id"])
    return j.select("contact_id", "disposition", "created_at", "to_number", "from_number", calls["status"],
                    "external_id", "duration_milliseconds", "body")


def email_log(emails: DataFrame, eng_contact: DataFrame, engagement: DataFrame) -> DataFrame:
    j = emails.join(eng_contact, "engagement_id").join(engagement, emails["engagement_id"] == engagement["id"])
    return j.groupBy("contact_id", "type").agg(F.min("created_at").alias("min"))


def tours_and_calls(meetings: DataFrame, eng_contact: DataFrame, contacts: DataFrame, engagement: DataFrame,
                    rules: ContactRules) -> DataFrame:
    title = F.lower(F.col("title"))
    m = meetings.where(matches(title, rules.tour_titles, False))
    j = (m.join(eng_contact, "engagement_id").join(contacts, F.col("contact_id") == contacts["id"])
         .join(engagement, m["engagement_id"] == engagement["id"]))
    return j.select(contacts["id"].alias("contact_id"), "property_email", "property_in_which_service_are_you_interested_",
                    "property_in_which_location_are_you_interested_",
                    F.when(matches(title, rules.tour_class, False), F.lit("Tour")).otherwise(F.lit("Call"))
                    .alias("meeting_type"),
                    "property_hs_analytics_source", F.col("start_time").alias("tour_time"),
                    F.col("created_at").alias("create_time"), "activity_type")


# ---------------------------------------------------------------- pre-aggregates

def scheduled_by_email(tours: DataFrame, kind: str) -> DataFrame:
    """Count, latest meeting day and first creation day per e-mail (strict: NULL if any NULL)."""
    k = kind.lower()
    g = tours.where(F.col("meeting_type") == kind).groupBy("property_email").agg(
        F.count(F.lit(1)).alias(f"total_scheduled_{k}s"),
        F.to_date(strict_max("tour_time")).alias(f"most_recent_scheduled_{k}"),
        F.to_date(strict_min("create_time")).alias(f"first_created_scheduled_{k}"))
    return g


def engagements_by_contact(engagements: DataFrame, types: list[str]) -> DataFrame:
    e = engagements.withColumn("engagements", F.col("engagements").cast("double"))
    return pivot(e, ["contact_id"], "type", types, "engagements", agg="sum", fill=0).withColumnRenamed("contact_id", "id")


def emails_by_contact(emails: DataFrame) -> DataFrame:
    return pivot(emails, ["contact_id"], "type", ["EMAIL", "INCOMING_EMAIL"], "min", agg="min").withColumnRenamed(
        "contact_id", "id")


def calls_by_contact(calls: DataFrame, rules: ContactRules) -> DataFrame:
    """First call (strict) and first connected call (NULL when there is none)."""
    c = calls.withColumn("disposition", code_map("disposition", dict(rules.disposition_labels),
                                                 default="Not Specified"))
    return c.groupBy(F.col("contact_id").alias("id")).agg(
        strict_min("created_at").alias("first_outbound_call"),
        min_if("created_at", F.col("disposition") == "Connected").alias("first_call_connected"))


# ---------------------------------------------------------------- the mart

def _acquisition_source(rules: ContactRules):
    channel, src = F.col("digital_channel"), F.col("property_hs_analytics_source")
    d1, d2 = F.col("property_hs_analytics_source_data_1"), F.col("property_hs_analytics_source_data_2")
    other = eq_or_false(channel, "Other")
    return acquisition_source(
        d1, d2, d2, rules, social=[(other & eq_or_false(src, "SOCIAL_MEDIA"), paste("Social(", F.lower(d1), ")"))],
        last_paid=[(matches("property_hs_analytics_first_referrer", "google|adwords"), "Paid Search(Google)")],
        last=[(other, F.lower(src)),
              (eq_or_false(channel, "N/A"), F.lower(F.col("property_offline_source_drill_down_1")))])


def contact_mart(contacts: DataFrame, companies: DataFrame, calls_sched: DataFrame, tours_sched: DataFrame,
                 emails: DataFrame, calls: DataFrame, rules: ContactRules, as_of: dt.datetime) -> DataFrame:
    """``as_of`` is the run's clock: contacts without outreach count up to it."""
    df = contacts.withColumn("create_date", F.to_date("property_createdate"))
    df = df.where(not_matches("property_lastname", rules.test_name) & not_matches("property_firstname", rules.test_name)
                  & not_matches("property_company", rules.company_drop)
                  & not_in_keep_null("property_lifecyclestage", rules.stages_drop))
    comp = companies.select(F.col("id").alias("company_key"), "property_name")
    df = df.join(comp, null_safe_on(df, comp, [("property_associatedcompanyid", "company_key")]), "left").drop(
        "company_key")
    src, d1 = F.col("property_hs_analytics_source"), F.col("property_hs_analytics_source_data_1")
    drill = F.col("property_offline_source_drill_down_1")
    df = df.withColumns({
        "create_week": week_start("create_date"), "create_month": month_start("create_date"),
        "create_quarter": quarter_start("create_date"), "create_wday": weekday_mon1("create_date"),
        "acquisition_channel": ladder([
            ((drill == rules.aggregator) | not_matches(src, "offline"), "Marketing"),
            ((d1 == "SALESFORCE") | (src == "OFFLINE"), "Sales"),
            (matches(d1, "broker") | (F.col("property_hs_all_team_ids") == rules.broker_team_id), "Broker"),
            ((d1, "enterprise"), "Enterprise")], default="Local"),
        "digital_channel": ladder([
            (src == "DIRECT_TRAFFIC", "Direct"), (src == "ORGANIC_SEARCH", "Organic"),
            (src.isin("PAID_SEARCH", "PAID_SOCIAL"), "Paid"), (drill == rules.aggregator, "Aggregator"),
            (src == "OFFLINE", "N/A")], default="Other"),
        "first_page": strip_query("property_hs_analytics_first_url"),
        "budget": F.coalesce("property_budget", "property_amount"),
        "desired_move_in_date": F.coalesce("property_start_date", "property_move_in_date"),
        "location": F.coalesce(F.col("property_in_which_location_are_you_interested_"), F.lit("Not Specified")),
        "product": F.coalesce(F.col("property_in_which_service_are_you_interested_"),
                              F.col("property_what_type_of_workspace_are_you_interested_in_"), F.lit("Not Specified")),
        "company": F.coalesce("property_name", "property_company"),
    })
    df = df.withColumn("acquisition_source", _acquisition_source(rules))
    df = null_salted_join(df, calls_sched, "property_email")  # many contacts have no e-mail
    df = null_salted_join(df, tours_sched, "property_email")
    df = null_safe_join(df, emails, ["id"], "left")
    df = null_safe_join(df, calls, ["id"], "left")
    out = df.select(
        F.col("id").alias("contact_id"), "location", F.col("property_firstname").alias("first_name"),
        F.col("property_lastname").alias("last_name"), F.col("property_email").alias("contact_email"), "company",
        F.col("property_associatedcompanyid").alias("company_id"), "product",
        F.col("property_lifecyclestage").alias("lifecycle_stage"), "create_date", "create_week", "create_month",
        "create_quarter", "create_wday", F.col("property_hs_lifecyclestage_lead_date").alias("lead_date"),
        F.col("property_hs_lifecyclestage_marketingqualifiedlead_date").alias("mql_date"),
        F.col("property_hs_lifecyclestage_salesqualifiedlead_date").alias("sql_date"),
        F.col("property_hs_lifecyclestage_opportunity_date").alias("oppty_date"),
        F.col("property_hs_lifecyclestage_customer_date").alias("customer_date"),
        F.col("property_disqualified_reason").alias("disqualify_reason"), "budget", "total_scheduled_calls",
        "most_recent_scheduled_call", "first_created_scheduled_call", "total_scheduled_tours",
        "most_recent_scheduled_tour", "first_created_scheduled_tour",
        F.col("EMAIL").alias("first_outbound_email"), F.col("INCOMING_EMAIL").alias("first_email_response"),
        "first_outbound_call", "first_call_connected", "desired_move_in_date",
        F.col("property_digital_tracking_code").alias("tracking_code"), "digital_channel", "acquisition_channel",
        "acquisition_source", "first_page", F.col("property_isr_review").alias("isr_review"),
        F.col("property_salesforceleadid").alias("salesforce_lead_id"),
        F.col("property_salesforcecontactid").alias("salesforce_contact_id"))
    na = lambda c: F.col(c).isNull().cast("int")
    out = out.withColumns({
        "scheduled_meeting": F.when(na("first_created_scheduled_tour") + na("first_created_scheduled_call") == 2, 0)
        .otherwise(1),
        "engaged_contact": F.when(na("first_email_response") + na("first_call_connected") < 2, 1).otherwise(0),
        "first_outreach": F.coalesce(F.col("first_outbound_email"), F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")),
        "no_outreach": F.when(na("first_outbound_call") + na("first_outbound_email") == 2, 1).otherwise(0),
    })
    return out.withColumn("time_to_first_contact", hours_between("first_outreach", "lead_date"))


# ---------------------------------------------------------------- adapted runs on the driver tables

#: The clock of the runs on the driver tables, whose events end at this time.
ADAPTED_AS_OF = dt.datetime(2024, 2, 1)


def adapted_rules() -> ContactRules:
    """Rules that fit the contacts derived from the driver tables."""
    from martforge.sources import crm_adapters as A
    return ContactRules(contact_list_id=A.CONTACT_LIST_ID, broker_team_id=A.BROKER_TEAM_ID,
                        disposition_labels=tuple(A.DISPOSITION_LABELS.items()))


ENGAGEMENT_TYPES = ["CALL", "EMAIL", "INCOMING_EMAIL", "MEETING", "TASK"]


def contact_engagements_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from martforge.sources import crm_adapters as A
    return contact_engagements(A.engagement_contact(spark, sf_dir), A.engagement(spark, sf_dir))


def engagements_by_contact_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return engagements_by_contact(contact_engagements_q(spark, sf_dir), ENGAGEMENT_TYPES)


def phone_call_log_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from martforge.sources import crm_adapters as A
    return phone_call_log(A.engagement_call(spark, sf_dir), A.engagement_contact(spark, sf_dir),
                          A.engagement(spark, sf_dir))


def tours_and_calls_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from martforge.sources import crm_adapters as A
    return tours_and_calls(A.engagement_meeting(spark, sf_dir), A.engagement_contact(spark, sf_dir),
                           A.contact(spark, sf_dir), A.engagement(spark, sf_dir), adapted_rules())


def contact_mart_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from martforge.sources import crm_adapters as A
    rules = adapted_rules()
    eng, ec = A.engagement(spark, sf_dir), A.engagement_contact(spark, sf_dir)
    contacts_all = A.contact(spark, sf_dir)
    tours = tours_and_calls(A.engagement_meeting(spark, sf_dir), ec, contacts_all, eng, rules)
    return contact_mart(
        list_contacts(A.contact_list_member(spark, sf_dir), contacts_all, rules), A.company(spark, sf_dir),
        scheduled_by_email(tours, "Call"), scheduled_by_email(tours, "Tour"),
        emails_by_contact(email_log(A.engagement_email(spark, sf_dir), ec, eng)),
        calls_by_contact(phone_call_log(A.engagement_call(spark, sf_dir), ec, eng), rules), rules, ADAPTED_AS_OF)
