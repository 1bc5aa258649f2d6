"""Adapters: give the driver tables the shape of the mart sources, so the mart
code runs unchanged on them (and grows with them).

Every adapter is a DataFrame derived from the driver tables; nothing is
synthesised on the driver.  The SQL oracle of each adapted mart repeats the
same derivation in DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.sources.io import read_table

# Fixed values used by the adapted web data (hosts, agent strings, click ids).
SEARCH_REFERRERS = ("https://www.search.example/", "https://www.search.example/search?q=a|b c",
                    "www.search.example/x", "https://my_search.example:8080/")
PARENT_REFERRER = "https://parent.example/home"
BOT_AGENT = "Mozilla/5.0 (compatible; ExampleBot/2.1; +https://bot.example/about)"
ADS_AGENT = "Mozilla/5.0 (iPhone; CPU iPhone OS 15_2 like Mac OS X) Ads-Overview/7.1"
AGENTS = (
    "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/119.0.0.0 Safari/537.36",
    "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/119.0.0.0 Safari/537.36 Edg/119.0",
    "Mozilla/5.0 (Macintosh; Intel Mac OS X 13_4) AppleWebKit/605.1.15 (KHTML, like Gecko) Version/16.5 Safari/605.1.15",
    "Mozilla/5.0 (iPhone; CPU iPhone OS 16_5 like Mac OS X) AppleWebKit/605.1.15 Version/16.5 Mobile/15E148 Safari/604.1",
    "Mozilla/5.0 (Linux; Android 13; SM-S911B) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/118.0.0.0 Mobile Safari/537.36",
    "Mozilla/5.0 (Linux; Android 14; Pixel 8 Pro) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/118.0.0.0 Mobile Safari/537.36",
    "Mozilla/5.0 (X11; Linux x86_64; rv:120.0) Gecko/20100101 Firefox/120.0",
    "curl/8.4.0")


def element_of(slot, values):
    """The value at position ``slot`` (from 0)."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), slot.cast("int") + 1)


def _n_pages(pages: DataFrame) -> int:
    """Number of page slots (one-row aggregate; bounded driver result)."""
    return int(pages.agg(F.max("page_id")).first()[0]) + 1


def tracking_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page-view tracking table (id, original_timestamp, context_ip, context_campaign_*,
    referrer, path, url, user_id, title, anonymous_id, context_user_agent)."""
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value"])
    pages = read_table(spark, sf_dir, "pages", ["page_id", "url"])
    n = _n_pages(pages)
    j = ev.join(pages, F.pmod(ev["event_id"], F.lit(n)) == pages["page_id"])
    et = F.col("event_type")
    with_click = (et == "click") & (F.col("value") > 100)
    url = F.when(with_click, F.concat(
        F.col("url"), F.when(F.col("url").contains("?"), F.lit("&")).otherwise(F.lit("?")),
        F.lit("gclid=G"), F.pmod(F.col("event_id"), F.lit(7)).cast("string"))).otherwise(F.col("url"))
    return j.select(
        F.col("event_id").cast("string").alias("id"),
        F.col("ts").alias("original_timestamp"),
        F.concat(F.lit("10.0.0."), F.pmod(F.col("user_id"), F.lit(120)).cast("string")).alias("context_ip"),
        F.when(et == "purchase", F.lit("cpc")).alias("context_campaign_medium"),
        F.when(et == "purchase", F.lit("newsletter")).alias("context_campaign_source"),
        F.when(et == "purchase", F.concat(F.lit("promo "), F.col("page_id").cast("string"))).alias(
            "context_campaign_name"),
        F.when(et == "click", element_of(F.pmod("event_id", F.lit(4)), SEARCH_REFERRERS))
         .when(et == "signup", F.lit(PARENT_REFERRER))
         .when(et != "view", F.col("url")).alias("referrer"),
        F.regexp_extract(F.col("url"), r"^[A-Za-z]+://[^/?#]+([^?#]*)", 1).alias("path"),
        url.alias("url"),
        F.lit(None).cast("string").alias("user_id"),
        F.when(et == "error", F.lit("404 Not Found")).otherwise(F.initcap(et)).alias("title"),
        F.col("user_id").cast("string").alias("anonymous_id"),
        F.when(F.col("value") > 200, F.lit(BOT_AGENT))
         .when(F.pmod(F.col("user_id"), F.lit(37)) == 0, F.lit(ADS_AGENT))
         .otherwise(element_of(F.pmod(F.col("user_id"), F.lit(8)), AGENTS))
         .alias("context_user_agent"))


def internal_ips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known internal addresses: visitors that hit a large error."""
    ev = read_table(spark, sf_dir, "events", ["user_id", "event_type", "value"])
    return ev.where((F.col("event_type") == "error") & (F.col("value") > 200)).select(
        F.concat(F.lit("10.0.0."), F.pmod(F.col("user_id"), F.lit(120)).cast("string")).alias("ip_address")
    ).distinct()


def ip_org(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IP -> organisation lookup: the segment of the customer whose key is the last address byte."""
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_mktsegment"])
    return c.where(F.col("c_custkey").between(0, 119)).select(
        F.concat(F.lit("10.0.0."), F.col("c_custkey").cast("string")).alias("context_ip"), F.col("c_mktsegment").alias("org"))


def click_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ad click ids -> campaign; one id is listed twice (fan-out must be kept)."""
    ev = read_table(spark, sf_dir, "events", ["event_id", "event_type", "value"])
    ids = ev.where((F.col("event_type") == "click") & (F.col("value") > 100)).select(
        F.concat(F.lit("G"), F.pmod(F.col("event_id"), F.lit(7)).cast("string")).alias("gcl_id")).distinct()
    base = ids.select("gcl_id", F.concat(F.lit("search "), F.col("gcl_id")).alias("campaign_name"))
    dup = ids.where(F.col("gcl_id") == "G0").select("gcl_id", F.lit("search G0 copy").alias("campaign_name"))
    return base.unionByName(dup)


def lead_forms(spark: SparkSession, sf_dir: str, event: str) -> DataFrame:
    """Form tracking table (viewed = signup events, submitted = purchase events)."""
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type"])
    et = "signup" if event == "viewed" else "purchase"
    return ev.where(F.col("event_type") == et).select(
        F.col("event_id").cast("string").alias("id"), F.col("ts").alias("original_timestamp"),
        F.lit("/contact").alias("context_page_path"), F.lit("https://site.example/contact").alias("context_page_url"),
        F.col("user_id").cast("string").alias("anonymous_id"),
        F.lit(None).cast("string").alias("digital_tracking_code"),
        F.lit("contact form").alias("form_name"), F.lit(f"lead_form_{event}").alias("event"))


def visitor_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``context_ip`` of the events' users: an address in their nation's network, every seventh an IPv6 one."""
    u = F.col("user_id")
    six = F.concat(F.lit("2001:db8:"), F.hex(u % 25), F.lit("::"), F.hex(u % 4096))
    four = F.concat_ws(".", F.lit("10"), u % 25, u % 211, u % 256)
    return read_table(spark, sf_dir, "events", ["user_id"]).select(F.when(u % 7 == 0, six).otherwise(four).alias("context_ip"))


def address_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``first, last, org``: nations' networks, customers' nested and adjacent ones, suppliers' ranges across them."""
    def four(nation, number):
        return F.concat_ws(".", F.lit("10"), F.col(nation), F.call_function("div", number, F.lit(256)), number % 256)

    def rows(df, nation, lo, hi, org):
        return df.select(four(nation, lo).alias("first"), four(nation, hi).alias("last"), org.alias("org"))

    n = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name"])
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_nationkey"]).where(F.col("c_custkey") % 3 == 0)
    s = read_table(spark, sf_dir, "supplier", ["s_suppkey", "s_name", "s_nationkey"])
    net, odd, six = F.col("c_custkey") % 256 * 256, F.col("s_suppkey") % 200 * 256, F.col("s_suppkey") % 61 * 64
    v6 = lambda k: F.concat(F.lit("2001:db8:"), F.hex("s_nationkey"), F.lit("::"), F.hex(k))
    legs = [rows(n, "n_nationkey", F.lit(0).cast("long"), F.lit(65_535).cast("long"), F.col("n_name")),
            rows(c, "c_nationkey", net, net + 255, F.col("c_name")), rows(s, "s_nationkey", odd + 17, odd + 300, F.col("s_name")),
            s.select(v6(six + 1).alias("first"), v6(six + 64).alias("last"), F.concat("s_name", F.lit(" v6")).alias("org"))]
    out = legs[0]
    for leg in legs[1:]:
        out = out.unionByName(leg)
    return out
