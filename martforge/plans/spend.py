"""Marketing spend: multi-source daily spend (UNION of network legs) and the
allocation of spend to products (own product 100 %, unspecified 40/40/20)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.functions.dates import month_start, week_start
from martforge.functions.rules import ladder, regex_ladder
from martforge.operators.aggregates import fill_by_type
from martforge.operators.setops import union_distinct
from martforge.sources.io import read_table

MONEY = "decimal(18,6)"


@dataclass(frozen=True)
class SpendRules:
    """How spend is labelled and split: patterns of the campaign name in rule order (first match wins), and the
    products' shares of spend that no rule places."""

    products: tuple[tuple[str, str], ...] = ()
    markets: tuple[tuple[str, str], ...] = ()
    split: tuple[tuple[str, float], ...] = ()
    unplaced: str = "Non-Specific"


#: Rules for campaigns derived from the driver tables.
ADAPTED_RULES = SpendRules(products=(("ring", "Suite"), ("gear", "Room"), ("bolt", "Desk")),
                           markets=(("small", "North"), ("red", "South"), ("blue", "West")),
                           split=(("Suite", 0.4), ("Desk", 0.4), ("Room", 0.2)))


def _campaign_lines(spark, sf_dir) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem", ["l_partkey", "l_shipdate", "l_quantity", "l_extendedprice",
                                                 "l_returnflag", "l_orderkey", "l_linenumber", "l_discount"])
    p = read_table(spark, sf_dir, "part", ["p_partkey", "p_name"])
    return li.join(p, li["l_partkey"] == p["p_partkey"])


def spend_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three network legs -> one daily spend table with UNION (distinct) semantics:
    two ad-level legs are not aggregated, so equal rows collapse."""
    lines = _campaign_lines(spark, sf_dir).withColumn("campaign_date", F.to_date("l_shipdate"))
    cols = ["campaign_date", "p_name", "l_quantity", "l_extendedprice"]
    leg_a = lines.where(F.col("l_returnflag") == "A").select(F.lit("A").alias("source"), *cols)
    leg_r = lines.where(F.col("l_returnflag") == "R").select(F.lit("R").alias("source"), *cols)
    leg_n = (lines.where(F.col("l_returnflag") == "N").groupBy("campaign_date", "p_name")
             .agg(F.sum(F.col("l_quantity").cast(MONEY)).cast("double").alias("l_quantity"),
                  F.sum(F.col("l_extendedprice").cast(MONEY)).cast("double").alias("l_extendedprice"))
             .select(F.lit("N").alias("source"), *cols))
    out = union_distinct([leg_a, leg_n, leg_r])
    return out.toDF("source", "campaign_date", "campaign_name", "clicks", "spend")


def allocate_spend(df: DataFrame, rules: SpendRules, name_col: str = "campaign_name", date_col: str = "campaign_date",
                   spend_col: str = "spend") -> DataFrame:
    """Numeric NULL -> 0, product / market from the campaign name, week / month,
    and one column of spend per product of the split."""
    df = fill_by_type(df, numeric=0)
    df = df.withColumns({
        "product": regex_ladder(name_col, rules.products, default=rules.unplaced),
        "market": regex_ladder(name_col, rules.markets, default=rules.unplaced),
        "spend_week": week_start(date_col),
        "spend_month": month_start(date_col),
    })
    spend = F.col(spend_col)
    prod = F.col("product")
    split = {}
    for product, share in rules.split:
        split[product.lower()] = ladder([(prod == product, spend),
                                 (prod == rules.unplaced, spend * F.lit(share))], default=F.lit(0.0))
    return df.withColumns(split)


def spend_allocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _campaign_lines(spark, sf_dir)
    df = lines.select("l_orderkey", "l_linenumber", F.col("p_name").alias("campaign_name"),
                      F.to_date("l_shipdate").alias("campaign_date"),
                      F.when(F.col("l_discount") > 0, F.col("l_extendedprice")).alias("spend"))
    out = allocate_spend(df, ADAPTED_RULES)
    return out.select("l_orderkey", "l_linenumber", "product", "market", "spend_week", "spend_month",
                      "spend", "suite", "desk", "room")


# ---------------------------------------------------------------- five-network daily spend

def _money(col: str) -> F.Column:
    return F.sum(F.col(col).cast(MONEY)).cast("double")


SPEND_COLUMNS = ["campaign_name", "campaign_date", "impressions", "clicks", "conversions", "spend", "source"]


def marketing_spend(li_analytics: DataFrame, li_campaigns: DataFrame, li_groups: DataFrame, bing_report: DataFrame,
                    bing_campaigns: DataFrame, fb_ads: DataFrame, fb_actions: DataFrame, search_main: DataFrame,
                    search_uk: DataFrame, linkedin_excluded: tuple[int, ...] = (),
                    facebook_excluded: tuple[int, ...] = (), conversion_types: tuple[str, ...] = ()) -> DataFrame:
    """UNION (distinct) of five network legs; two legs are ad-level and not aggregated.

    Account numbers are a network's own: each of the two networks with accounts has its list.
    """
    from martforge.operators.history import latest_version
    # versions that tie as latest multiply the rows; the UNION keeps only their different names
    groups = latest_version(li_groups, ["id"], "last_modified_time").select(
        F.col("id").alias("group_id"), F.col("name").alias("group_name")).distinct()
    li = (li_analytics.join(li_campaigns, li_analytics["campaign_id"] == li_campaigns["id"])
          .join(groups, F.col("campaign_group_id") == F.col("group_id")))
    if linkedin_excluded:
        li = li.where(~F.col("account_id").isin(*linkedin_excluded))
    leg_li = li.select(F.col("group_name").alias("campaign_name"), F.to_date("day").alias("campaign_date"),
                       "impressions", "clicks", F.col("external_website_conversions").cast("double").alias("conversions"),
                       F.col("cost_in_usd").alias("spend"), F.lit("LinkedIn").alias("source"))

    names = bing_campaigns.select("id", "name").distinct()
    bing = bing_report.join(names, bing_report["campaign_id"] == names["id"])
    leg_bing = bing.groupBy(F.col("name").alias("campaign_name"), F.col("date").alias("campaign_date")).agg(
        F.sum("impressions").alias("impressions"), F.sum("clicks").alias("clicks"),
        F.sum("conversions").cast("double").alias("conversions"), _money("spend").alias("spend")).withColumn(
        "source", F.lit("Bing"))

    conv = (fb_actions.where(F.col("action_type").isin(*conversion_types)) if conversion_types else fb_actions)
    conv = conv.groupBy("date", "ad_id").agg(F.count(F.lit(1)).alias("conversions"))
    fb = fb_ads.join(conv, ["ad_id", "date"], "left")
    if facebook_excluded:
        fb = fb.where(~F.col("account_id").isin(*facebook_excluded))
    leg_fb = fb.select("campaign_name", F.col("date").alias("campaign_date"), "impressions",
                       F.col("inline_link_clicks").alias("clicks"), F.col("conversions").cast("double"), "spend",
                       F.lit("Facebook").alias("source"))

    def search_leg(df):
        return df.groupBy(F.col("date").alias("campaign_date"), "campaign_name").agg(
            F.sum("impressions").alias("impressions"), F.sum("clicks").alias("clicks"),
            F.sum("conversions").alias("conversions"), _money("cost").alias("spend")).select(
            "campaign_name", "campaign_date", "impressions", "clicks", "conversions", "spend",
            F.lit("Google").alias("source"))

    legs = [leg_li, leg_bing.select(*SPEND_COLUMNS), leg_fb, search_leg(search_main), search_leg(search_uk)]
    return union_distinct([leg.select(*SPEND_COLUMNS) for leg in legs])


def marketing_spend_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from martforge.sources import ad_adapters as A
    return marketing_spend(A.linkedin_analytics(spark, sf_dir), A.linkedin_campaigns(spark, sf_dir),
                           A.linkedin_groups(spark, sf_dir), A.bing_report(spark, sf_dir),
                           A.bing_campaigns(spark, sf_dir), A.facebook_ads(spark, sf_dir),
                           A.facebook_actions(spark, sf_dir), A.search_hourly(spark, sf_dir, "main"),
                           A.search_hourly(spark, sf_dir, "uk"), linkedin_excluded=A.LINKEDIN_EXCLUDED,
                           facebook_excluded=A.FACEBOOK_EXCLUDED, conversion_types=A.FB_CONVERSION_TYPES)


def marketing_spend_allocated_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return allocate_spend(marketing_spend_q(spark, sf_dir), ADAPTED_RULES)
