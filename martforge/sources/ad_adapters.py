"""Ad-network source tables derived from lineitem / part.

Line items are split into five networks by (return flag, line status); a
part is a campaign, a ship date a campaign day, quantity the clicks and the
extended price the spend.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.sources.io import read_table

#: Each network has an account of both numbers; each excludes another one.
LINKEDIN_EXCLUDED, FACEBOOK_EXCLUDED = (999,), (998,)
FB_CONVERSION_TYPES = ("onsite_conversion.post_save", "leadgen.other")


def _lines(spark, sf_dir, flag, status=None) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                                                 "l_extendedprice", "l_discount", "l_returnflag", "l_linestatus",
                                                 "l_shipdate"])
    cond = F.col("l_returnflag") == flag
    if status is not None:
        cond = cond & (F.col("l_linestatus") == status)
    return li.where(cond)


def _parts(spark, sf_dir) -> DataFrame:
    return read_table(spark, sf_dir, "part", ["p_partkey", "p_name", "p_brand", "p_type", "p_size"])


def _metrics(prefix_clicks: str = "clicks"):
    return [(F.col("l_quantity") * F.lit(10)).cast("long").alias("impressions"),
            F.col("l_quantity").cast("long").alias(prefix_clicks)]


def linkedin_analytics(spark, sf_dir) -> DataFrame:
    li = _lines(spark, sf_dir, "A", "F")
    return li.select(F.col("l_partkey").alias("campaign_id"), F.col("l_shipdate").alias("day"), *_metrics(),
                     F.col("l_linenumber").cast("long").alias("external_website_conversions"),
                     F.col("l_extendedprice").alias("cost_in_usd"))


def linkedin_campaigns(spark, sf_dir) -> DataFrame:
    p = _parts(spark, sf_dir)
    return p.select(F.col("p_partkey").alias("id"), F.col("p_size").cast("long").alias("campaign_group_id"),
                    F.when(F.col("p_brand") == "Brand#1", F.lit(999)).when(F.col("p_brand") == "Brand#2", F.lit(998))
                    .otherwise(F.lit(1)).cast("long").alias("account_id"))


def linkedin_groups(spark, sf_dir) -> DataFrame:
    """Campaign-group versions: one per part; the latest name of a group wins."""
    p = _parts(spark, sf_dir)
    return p.select(F.col("p_size").cast("long").alias("id"), F.concat(F.col("p_type"), F.lit(" group")).alias("name"),
                    F.when(F.pmod("p_partkey", F.lit(7)) != 0, F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
                           + F.make_interval(secs=F.col("p_partkey").cast("decimal(18,6)"))).alias("last_modified_time"))


def bing_report(spark, sf_dir) -> DataFrame:
    li = _lines(spark, sf_dir, "A", "O")
    return li.select(F.col("l_partkey").alias("campaign_id"), F.to_date("l_shipdate").alias("date"), *_metrics(),
                     F.col("l_linenumber").cast("long").alias("conversions"), F.col("l_extendedprice").alias("spend"))


def bing_campaigns(spark, sf_dir) -> DataFrame:
    """Campaign history: renamed campaigns have two names (fan-out kept)."""
    p = _parts(spark, sf_dir)
    base = p.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))
    renamed = p.where(F.col("p_size") > 45).select(F.col("p_partkey").alias("id"),
                                                   F.concat(F.col("p_name"), F.lit(" (renamed)")).alias("name"))
    return base.unionByName(renamed)


def facebook_ads(spark, sf_dir) -> DataFrame:
    li = _lines(spark, sf_dir, "N", "F").join(_parts(spark, sf_dir), F.col("l_partkey") == F.col("p_partkey"))
    return li.select(F.col("p_name").alias("campaign_name"), F.to_date("l_shipdate").alias("date"),
                     F.col("l_orderkey").alias("ad_id"),
                     F.when(F.col("l_suppkey") == 1, F.lit(998)).when(F.col("l_suppkey") == 2, F.lit(999))
                     .otherwise(F.lit(2)).cast("long").alias("account_id"),
                     (F.col("l_quantity") * F.lit(10)).cast("long").alias("impressions"),
                     F.col("l_quantity").cast("long").alias("inline_link_clicks"),
                     F.col("l_extendedprice").alias("spend"))


def facebook_actions(spark, sf_dir) -> DataFrame:
    li = _lines(spark, sf_dir, "N", "F")
    return li.select(F.to_date("l_shipdate").alias("date"), F.col("l_orderkey").alias("ad_id"),
                     F.when(F.col("l_discount") > 0.05, F.lit(FB_CONVERSION_TYPES[0]))
                     .when(F.col("l_discount") > 0.02, F.lit(FB_CONVERSION_TYPES[1]))
                     .otherwise(F.lit("link_click")).alias("action_type"))


def search_hourly(spark, sf_dir, region: str) -> DataFrame:
    li = (_lines(spark, sf_dir, "N", "O") if region == "main" else _lines(spark, sf_dir, "R"))
    li = li.join(_parts(spark, sf_dir), F.col("l_partkey") == F.col("p_partkey"))
    return li.select(F.col("p_name").alias("campaign_name"), F.to_date("l_shipdate").alias("date"), *_metrics(),
                     F.col("l_linenumber").cast("double").alias("conversions"), F.col("l_extendedprice").alias("cost"))
