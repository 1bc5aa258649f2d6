"""Visitor / contact activity queries on the events table (engagement logs,
exclusion lists, pivots, strict aggregates, calendar helpers)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.functions.dates import epoch_ms_to_timestamp, hours_between, minute_trunc
from martforge.functions.nulls import matches, not_in_keep_null, strict_max, strict_min, strict_sum
from martforge.functions.rules import code_map
from martforge.operators.aggregates import count_if, date_spine, days_per_week, fill_by_type, min_if, top_k_by_count
from martforge.operators.joins import anti_join_any, null_safe_join
from martforge.operators.reshape import pivot
from martforge.operators.setops import union_tagged
from martforge.plans.common import event_day, events
from martforge.sources.io import read_table

EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
# Engagement type per event type (the rest are other activity).
ENGAGEMENT_OF_EVENT = {"click": "Email", "purchase": "Call", "signup": "Meeting"}


def anti_join_exclusions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drop events of excluded visitors: top-5 visitors by views, a literal list
    (with NULL) and visitors with a large error; NULL visitor keys match NULL."""
    ev = events(spark, sf_dir).withColumn("visitor", F.when(F.col("user_id") != 0, F.col("user_id")))
    top = top_k_by_count(ev, "visitor", 5).select("visitor")
    literal = spark.createDataFrame([(None,), (1,), (2,)], "visitor long")
    flagged = ev.where((F.col("event_type") == "error") & (F.col("value") > 150)).select("visitor")
    kept = anti_join_any(ev, "visitor", [top, literal, flagged])
    return kept.select("event_id", "visitor")


def top_k_by_count_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top 100 visitors by events; ties by visitor id ascending."""
    return top_k_by_count(events(spark, sf_dir), "user_id", 100, "pv")


def not_like_keep_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regex drop and NOT IN that both keep NULL rows."""
    ev = events(spark, sf_dir).withColumn("t", F.when(F.col("event_type") != "view", F.col("event_type")))
    return ev.where(~matches("t", "err") & not_in_keep_null("t", ["signup"])).select("event_id", "t")


def inner_same_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases joined to the same-day visitor list (one row per visitor-day)."""
    ev = events(spark, sf_dir).withColumn("day", event_day())
    visitors = ev.where(F.col("event_type") == "view").select("day", "user_id").distinct()
    buys = ev.where(F.col("event_type") == "purchase").select("day", "user_id", "event_id")
    return null_safe_join(visitors, buys, ["day", "user_id"], "inner")


def first_contact_min(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First event and first large purchase per visitor (NULL when none)."""
    big_buy = (F.col("event_type") == "purchase") & (F.col("value") > 150)
    return events(spark, sf_dir).groupBy("user_id").agg(
        F.min("ts").alias("first_event"), min_if("ts", big_buy).alias("first_big_purchase"))


def _nullable_value():
    return F.when(~((F.col("event_type") == "error") & (F.col("value") > 200)), F.col("value"))


def strict_min_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Min / max that are NULL when any value of the visitor is NULL."""
    ev = events(spark, sf_dir).withColumn("v", _nullable_value())
    return ev.groupBy("user_id").agg(strict_min("v").alias("min_v"), strict_max("v").alias("max_v"))


def engagement_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, filtered count, count of non-missing, strict sum of a boolean and
    hours between two minima, grouped by carried per-visitor columns."""
    ev = events(spark, sf_dir).withColumn("t", F.when(F.col("event_type") != "view", F.col("event_type")))
    per_user = ev.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_events"), F.min("ts").alias("first_ts"))
    joined = per_user.join(ev, "user_id")
    grouped = joined.groupBy("user_id", "n_events", "first_ts").agg(
        count_if(F.col("event_type") == "purchase").alias("n_purchase"),
        F.count("t").alias("n_typed"),
        strict_sum((F.col("t") == "click").cast("int")).alias("click_flags"),
        min_if("ts", F.col("event_type") == "purchase").alias("__first_buy"))
    return grouped.withColumn("hours_to_purchase", hours_between("__first_buy", "first_ts")).drop("__first_buy")


def pivot_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visitor x event type counts, absent combinations 0."""
    ev = events(spark, sf_dir).withColumn("one", F.lit(1).cast("long"))
    return pivot(ev, ["user_id"], "event_type", EVENT_TYPES, "one", agg="sum", fill=0)


def _big_events(spark, sf_dir) -> DataFrame:
    return events(spark, sf_dir).where(F.col("value") > 100)


def pivot_first_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First time of each of two types per visitor; absent -> NULL."""
    return pivot(_big_events(spark, sf_dir), ["user_id"], "event_type", ["signup", "purchase"], "ts",
                 agg="min", names=["first_signup", "first_purchase"])


def null_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """0/1 flags from the missingness of two pivoted timestamps."""
    p = pivot_first_ts(spark, sf_dir)
    na_s = F.col("first_signup").isNull().cast("int")
    na_p = F.col("first_purchase").isNull().cast("int")
    return p.select("user_id",
                    F.when(na_s + na_p == 2, 0).otherwise(1).alias("scheduled_meeting"),
                    F.when(na_s + na_p < 2, 1).otherwise(0).alias("engaged_contact"),
                    F.when(na_s + na_p == 2, 1).otherwise(0).alias("no_outreach"))


def hours_between_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours from first to last event per visitor, one digit, half-to-even."""
    g = events(spark, sf_dir).groupBy("user_id").agg(F.min("ts").alias("t0"), F.max("ts").alias("t1"))
    return g.select("user_id", hours_between("t1", "t0").alias("active_hours"))


def minute_trunc_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select("event_id", minute_trunc("ts").alias("ts_minute"))


def epoch_ms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Epoch milliseconds and back to a whole-second timestamp (integer division)."""
    ev = events(spark, sf_dir).withColumn("epoch_ms", F.unix_millis(F.col("ts").cast("timestamp")))
    return ev.select("event_id", "epoch_ms", epoch_ms_to_timestamp("epoch_ms").alias("ts_second"))


def date_spine_weeks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days per Monday week between the first and last event day."""
    ev = events(spark, sf_dir)
    spine = date_spine(ev, F.min(event_day()), F.max(event_day()))
    return days_per_week(spine)


def fill_by_type_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One column to 'unknown', then every numeric NULL to 0 and text NULL to 'Not Specified'."""
    ev = read_table(spark, sf_dir, "events", ["event_id", "user_id", "event_type", "value", "props"])
    df = ev.select(
        "event_id", "user_id",
        F.when(F.col("event_type") != "error", F.col("value")).alias("v"),
        F.when(F.col("event_type") != "view", F.col("event_type")).alias("t"),
        F.when(F.col("value") <= 100, F.col("props")).alias("p"))
    df = df.fillna({"p": "unknown"})
    return fill_by_type(df, numeric=0, text="Not Specified")


def lookup_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top 100 visitors joined to an organisation dimension, kept by a regex on it."""
    top = top_k_by_count(events(spark, sf_dir), "user_id", 100, "pv")
    org = read_table(spark, sf_dir, "customer", ["c_custkey", "c_mktsegment"])
    joined = top.join(org, top["user_id"] == org["c_custkey"], "inner")
    return joined.where(matches("c_mktsegment", "build|auto")).select("user_id", "pv", "c_mktsegment")


def union_all_tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and events stacked by name with a source tag."""
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_orderdate"]).select(
        F.col("o_orderkey").alias("id"), F.to_date("o_orderdate").alias("day"))
    e = events(spark, sf_dir, ["event_id", "ts"]).select(F.col("event_id").alias("id"), event_day().alias("day"))
    return union_tagged([("orders", o), ("events", e)], "source")


def daily_activity_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily Email/Call counts by location and product; labels coalesced *after*
    grouping, so an unknown contact and a 'Not Specified' one give two rows."""
    ev = events(spark, sf_dir).withColumn("engagement_type", code_map("event_type", ENGAGEMENT_OF_EVENT))
    contacts = read_table(spark, sf_dir, "customer", ["c_custkey", "c_mktsegment", "c_acctbal"]).select(
        F.col("c_custkey").alias("user_id"),
        F.when(F.col("c_mktsegment") == "HOUSEHOLD", F.lit("Not Specified"))
         .when(F.col("c_mktsegment") != "MACHINERY", F.col("c_mktsegment")).alias("location"),
        F.when(F.col("c_acctbal") > 5000, F.lit("Suite")).alias("product"))
    df = ev.join(contacts, "user_id", "left")
    df = df.where(F.col("engagement_type").isin("Email", "Call"))
    g = df.groupBy(event_day().alias("engagement_date"), "engagement_type", "location", "product").agg(
        F.count(F.lit(1)).alias("engagements"))
    return g.fillna({"location": "Not Specified", "product": "Not Specified"})
