"""Web analytics on the events table: channel attribution per visitor-day.

``web_daily_attribution`` follows the attribution order of the source mart:

1. medium from the event (NULL for some types),
2. fill down-then-up per visitor-day (ordered by time, id),
3. medium ladder: paid / organic / other; missing medium classified by a
   second attribute (here the event value stands in for the referrer host:
   low -> direct, high -> stays missing, else referral),
4. fill down per visitor over all days, then up per visitor-day,
5. missing -> ``unknown``,
6. one row per visitor-day: first-seen mode of medium and of event type,
   landing content (first event of the day), paid flag, calendar columns.

Skew: all fills work on chunks of one minute (``operators.attribution``, ``operators.fill``), so a visitor
with a third of all events is spread over many tasks.  The plan does not depend on sizes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.functions.dates import month_start, quarter_start, week_start, weekday_mon1
from martforge.functions.rules import ladder
from martforge.operators.attribution import attribute
from martforge.operators.fill import fill, first_in_group
from martforge.operators.history import change_points
from martforge.operators.mode import mode, modes
from martforge.plans.common import event_day, events, medium_of_event, minute_chunk

ORDER = ["ts", "event_id"]


def attribute_events(ev: DataFrame) -> DataFrame:
    """Per-event attributed medium (steps 1-5)."""
    df = ev.withColumns({"day": event_day(), "medium": medium_of_event()})

    def label(medium):
        return ladder([((medium, "paid|ppc|cpc"), "paid"), (medium == "organic", "organic")], default="other")

    missing = ladder([(F.col("value") < 5, "direct"), (F.col("value") >= 45, F.lit(None).cast("string"))],
                     default="referral")
    return attribute(df, "user_id", "day", ORDER, ["medium"], "medium", label, missing, unknown="unknown")


def web_daily_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = attribute_events(events(spark, sf_dir))
    keys = ["day", "user_id"]
    out = modes(df, keys, ["medium", "event_type"], ORDER, firsts={"event_type": "landing_content"})
    return out.select(
        F.col("day").alias("dau_date"), "user_id", "landing_content",
        F.col("medium").alias("campaign_medium"), F.col("event_type").alias("top_event"),
        F.when(F.col("medium") == "paid", 1).otherwise(0).alias("true_paid"),
        weekday_mon1("day").alias("dau_day"), week_start("day").alias("week_start"),
        month_start("day").alias("month_start"), quarter_start("day").alias("quarter_start"))


# ---------------------------------------------------------------- operator-level queries on events

def _medium_events(spark, sf_dir) -> DataFrame:
    return events(spark, sf_dir).select("event_id", "ts", "user_id", event_day().alias("day"),
                                        medium_of_event().alias("medium"))


def fill_down_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Medium filled down, then up, within each visitor-day."""
    df, chunk = _medium_events(spark, sf_dir), minute_chunk()
    df = fill(df, ["user_id", "day"], ORDER, ["medium"], "downup", chunk=chunk, chunk_by=["user_id"])
    return df.select("event_id", "user_id", "day", "medium")


def fill_down_then_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Medium filled down per visitor over all days, then up within the visitor-day."""
    df, chunk = _medium_events(spark, sf_dir), minute_chunk()
    df = fill(df, ["user_id"], ORDER, ["medium"], "down", chunk=chunk, chunk_by=["user_id"])
    df = fill(df, ["user_id", "day"], ORDER, ["medium"], "up", chunk=chunk, chunk_by=["user_id"])
    return df.select("event_id", "user_id", "day", "medium")


def landing_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Medium of the first event of each visitor-day (a NULL first value stays NULL)."""
    return first_in_group(_medium_events(spark, sf_dir), ["day", "user_id"], ORDER, "medium", "landing_medium")


def mode_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Most frequent medium per visitor-day; tie -> first seen; no medium -> NULL."""
    return mode(_medium_events(spark, sf_dir), ["day", "user_id"], "medium", ORDER, out="mode_medium")


def stage_change_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose stage differs from the previous row of the user (default '1');
    a NULL stage row and the row after it drop out (three-valued comparison)."""
    ev = events(spark, sf_dir).select(
        "event_id", "user_id", "ts", F.when(F.col("event_type") != "error", F.col("event_type")).alias("stage"))
    out = change_points(ev, ["user_id"], ORDER, "stage", default="1", chunk=minute_chunk())
    return out.select("event_id", "user_id", "ts", "stage")
