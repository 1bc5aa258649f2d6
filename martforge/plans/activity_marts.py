"""Sales-rep activity marts and the location hierarchy.

Extracts: one rep's engagement log (calls, meetings, e-mails: UNION of three
legs), the rep's tasks (completion time from epoch milliseconds), the review
status history, distinct building records.
Transforms: status recode, hours to complete, per-contact task and
engagement summary joined to the contact mart, daily Email / Call counts by
location and product (labels coalesced *after* grouping), and the location
hierarchy with a sentinel row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.functions.dates import epoch_ms_to_timestamp, hours_between
from martforge.functions.nulls import strict_min, strict_sum
from martforge.functions.rules import code_map
from martforge.operators.aggregates import count_if, fill_by_type
from martforge.operators.history import top_row
from martforge.operators.joins import null_safe_join
from martforge.operators.setops import append_row, union_distinct

NOT_SPECIFIED = "Not Specified"


# ---------------------------------------------------------------- extracts

def rep_engagements(engagement: DataFrame, eng_contact: DataFrame, calls: DataFrame, meetings: DataFrame,
                    emails: DataFrame, owner_id: int) -> DataFrame:
    own = engagement.where(F.col("owner_id") == owner_id)

    def leg(kind: str, detail: DataFrame, label: str, status, subject, body):
        ids = own.where(F.col("type") == kind).select(F.col("id").alias("eid"), "created_at")
        j = eng_contact.join(ids, eng_contact["engagement_id"] == ids["eid"]).join(detail, "engagement_id", "left")
        return j.select("contact_id", F.lit(label).alias("engagement_type"), "created_at", status.alias("status"),
                        subject.alias("subject"), body.alias("body"))

    return union_distinct([
        leg("CALL", calls.select("engagement_id", "disposition", "body"), "Call", F.col("disposition"), F.lit(""),
            F.col("body")),
        leg("MEETING", meetings.select("engagement_id", "title", "body"), "Meeting", F.lit(""), F.col("title"),
            F.col("body")),
        leg("EMAIL", emails.select("engagement_id", F.col("status").alias("email_status"), "subject", "text"), "Email",
            F.col("email_status"), F.col("subject"), F.col("text")),
    ])


def rep_tasks(engagement: DataFrame, eng_contact: DataFrame, tasks: DataFrame, owner_id: int) -> DataFrame:
    ids = engagement.where((F.col("owner_id") == owner_id) & (F.col("type") == "TASK")).select(
        F.col("id").alias("eid"), "created_at")
    j = eng_contact.join(ids, eng_contact["engagement_id"] == ids["eid"]).join(tasks, "engagement_id", "left")
    return j.select("contact_id", "task_type", "created_at",
                    epoch_ms_to_timestamp("completion_date").alias("completed_date"), "status", "subject", "body")


def review_history(history: DataFrame) -> DataFrame:
    return history.where(F.col("name") == "isr_review").select("contact_id", "timestamp", F.col("value").alias("status"))


# ---------------------------------------------------------------- transforms

def recode_engagements(eng: DataFrame, labels: dict) -> DataFrame:
    return eng.withColumn("status", code_map("status", labels, keep_original=True))


def task_durations(tasks: DataFrame) -> DataFrame:
    return tasks.withColumn("time_to_complete", hours_between("completed_date", "created_at"))


def activity_summary(tasks: DataFrame, history: DataFrame, engagements: DataFrame, contacts: DataFrame,
                     locations: DataFrame) -> DataFrame:
    t = tasks.groupBy("contact_id").agg(
        F.count(F.lit(1)).alias("num_tasks"), count_if(F.col("status") == "COMPLETED").alias("completed_tasks"),
        strict_min("created_at").alias("first_task_create_date"),
        strict_min("completed_date").alias("first_task_completed_date"))
    t = t.withColumn("time_to_first_completed_task",
                     hours_between("first_task_completed_date", "first_task_create_date"))
    last = top_row(history, ["contact_id"], [F.col("timestamp").desc(), F.col("status").asc()]).select(
        "contact_id", F.to_date("timestamp").alias("isr_status_date"))
    j = null_safe_join(t, last, ["contact_id"], "left")
    e = engagements.groupBy("contact_id").agg(
        F.count("engagement_type").alias("total_engagements"),
        strict_sum((F.col("engagement_type") == "Email").cast("long")).alias("email_engagements"),
        strict_sum((F.col("engagement_type") == "Call").cast("long")).alias("phone_engagements"),
        strict_min("created_at").alias("__first_eng"))
    g = null_safe_join(j, e, ["contact_id"], "left").fillna({"total_engagements": 0})
    g = g.withColumn("time_to_first_engagement", hours_between("__first_eng", "first_task_create_date")).drop(
        "__first_eng")
    g = g.withColumns({"first_task_create_date": F.to_date("first_task_create_date"),
                       "first_task_completed_date": F.to_date("first_task_completed_date")})
    c = contacts.select("contact_id", F.col("create_date").alias("contact_create_date"), "isr_review",
                        "lifecycle_stage", "location", "product")
    g = null_safe_join(g, c, ["contact_id"], "inner")
    g = null_safe_join(g, locations.select("hs_locations", "city", "site_name"),
                       [("location", "hs_locations")], "left").drop("hs_locations")
    return fill_by_type(g, text=NOT_SPECIFIED)


def activity_detail(engagements: DataFrame, contacts: DataFrame, locations: DataFrame) -> DataFrame:
    e = null_safe_join(engagements, contacts.select("contact_id", "location", "product"), ["contact_id"], "left")
    e = e.where(F.col("engagement_type").isin("Email", "Call"))
    g = e.groupBy(F.to_date("created_at").alias("engagement_date"), "engagement_type", "location", "product").agg(
        F.count(F.lit(1)).alias("engagements"))
    g = g.fillna({"location": NOT_SPECIFIED, "product": NOT_SPECIFIED})
    g = null_safe_join(g, locations.select("hs_locations", "city", "site_name"),
                       [("location", "hs_locations")], "left").drop("hs_locations")
    return fill_by_type(g, text=NOT_SPECIFIED)


def geo_hierarchy(buildings: DataFrame) -> DataFrame:
    b = buildings.select(F.col("building_name_c").alias("location_id"), F.col("name").alias("unit_name"),
                         "neighborhood_name_c", "submarket_temp_c", "city_c", "state_province_c", "sub_region_c",
                         "country_c", "region_c").distinct()
    out = b.select("location_id", F.col("unit_name").alias("unit"),
                   F.coalesce("submarket_temp_c", "neighborhood_name_c").alias("submarket"),
                   F.col("city_c").alias("city"), F.col("state_province_c").alias("state"),
                   F.col("country_c").alias("country"), F.col("sub_region_c").alias("sub_region"),
                   F.col("region_c").alias("region"))
    return append_row(out, [NOT_SPECIFIED] * 8)


# ---------------------------------------------------------------- adapted runs on the driver tables

def rep_engagements_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from martforge.sources import crm_adapters as A
    return rep_engagements(A.engagement(spark, sf_dir), A.engagement_contact(spark, sf_dir),
                           A.engagement_call(spark, sf_dir), A.engagement_meeting(spark, sf_dir),
                           A.engagement_email(spark, sf_dir), A.REP_OWNER_ID)


def rep_tasks_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from martforge.sources import crm_adapters as A
    return rep_tasks(A.engagement(spark, sf_dir), A.engagement_contact(spark, sf_dir),
                     A.engagement_task(spark, sf_dir), A.REP_OWNER_ID)


def _rep_inputs(spark, sf_dir):
    from martforge.sources import crm_adapters as A
    eng, ec = A.engagement(spark, sf_dir), A.engagement_contact(spark, sf_dir)
    engagements = recode_engagements(
        rep_engagements(eng, ec, A.engagement_call(spark, sf_dir), A.engagement_meeting(spark, sf_dir),
                        A.engagement_email(spark, sf_dir), A.REP_OWNER_ID), A.DISPOSITION_LABELS)
    tasks = task_durations(rep_tasks(eng, ec, A.engagement_task(spark, sf_dir), A.REP_OWNER_ID))
    return A, engagements, tasks


def activity_summary_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from martforge.plans.contact_marts import contact_mart_q
    A, engagements, tasks = _rep_inputs(spark, sf_dir)
    return activity_summary(tasks, review_history(A.contact_property_history(spark, sf_dir)), engagements,
                            contact_mart_q(spark, sf_dir), A.location_map(spark, sf_dir))


def activity_detail_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from martforge.plans.contact_marts import contact_mart_q
    A, engagements, _ = _rep_inputs(spark, sf_dir)
    return activity_detail(engagements, contact_mart_q(spark, sf_dir), A.location_map(spark, sf_dir))


def geo_hierarchy_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from martforge.sources import crm_adapters as A
    return geo_hierarchy(A.buildings(spark, sf_dir))
