"""Web marts: attributed page views, daily visitors and form conversions.

``attributed_pageviews`` applies the attribution steps in the source's order:

1. drop page views whose title matches the error pattern (NULL kept),
2. anti-join internal, test-traffic, top-k-organisation and literal IPs
   (one null-safe anti join against the de-duplicated union),
3. join the parsed user agent, drop bots and one agent string,
4. cut the URL at the click-id marker; the text before it replaces the URL,
5. left join ad clicks on the click id (a duplicated click id fans out),
6. visit date, referrer host (``none`` without referrer), UTM parameters of
   the cut URL, click-id defaults, coalesce context -> URL -> click,
7. fill medium / source / name down-then-up per visitor-day,
8. a missing medium with a search-engine host becomes ``organic``; fill the
   medium again,
9. medium ladder (paid / organic / other; missing: direct, internal
   referral, own host stays missing, referral),
10. fill medium down per visitor over all days, then up per visitor-day,
11. landing content = first cut URL of the visitor-day; missing medium ->
    ``unknown``.

Brand hosts, IP lists and label patterns are parameters (``WebRules``).
Skew: the fills work on one-minute chunks of a visitor (``operators.attribution``), in one plan for all sizes.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.functions.agents import parse_agents
from martforge.functions.dates import month_start, quarter_start, week_start, weekday_mon1
from martforge.functions.nulls import any_matches, matches, not_matches
from martforge.functions.rules import ladder, regex_ladder
from martforge.functions.urls import referrer_host, split_at, url_param
from martforge.operators.attribution import attribute
from martforge.operators.ip_ranges import lookup
from martforge.operators.joins import anti_join_any, null_safe_join
from martforge.operators.mode import modes
from martforge.operators.setops import union_distinct

ORDER = ["original_timestamp", "id"]
POSITION = "__position"

PAGEVIEW_COLUMNS = ["id", "anonymous_id", "seg_date", "original_timestamp", "host", "path", "url",
                    "campaign_medium", "campaign_source", "campaign_name", "landing_content", "ua_family",
                    "device_family", "device_brand", "device_model", "os_family", "os_major"]


@dataclass(frozen=True)
class WebRules:
    """Patterns of the attribution (all regexes are case-insensitive unless noted)."""
    test_referrer: str = r"qa-|staging|localhost"
    test_path: str = r"qa"
    test_url: str = r"localhost"
    org_keep: str = r"building"
    top_ips: int = 100
    literal_ips: tuple[str, ...] = ()
    title_drop: str = r"404"
    bot_family: str = r"bot|crawl|spider"
    agent_drop: str = r"Ads-Overview"          # case-sensitive
    click_marker: str = "gclid="
    search_hosts: str = r"yahoo|bing|duckduckgo|google|search\.example"
    paid_media: str = r"paid|ppc|cpc"
    own_home: str | None = None                # referrer equal to the own home page -> direct
    parent_host: str | None = r"parent\.example"
    own_host: str | None = r"\.example\.org"
    city_rules: tuple[tuple[str, str], ...] = ()
    unit_rules: tuple[tuple[str, str], ...] = ()
    product_rules: tuple[tuple[str, str], ...] = (("suite", "Suite"), ("desk", "Desk"), ("room", "Room"))


def ip_profile(pages: DataFrame, rules: WebRules) -> DataFrame:
    """One row per address: its page views, and whether any has a test referrer, path or URL."""
    test = any_matches([("referrer", rules.test_referrer), ("path", rules.test_path), ("url", rules.test_url)])
    return pages.groupBy("context_ip").agg(F.count(F.lit(1)).alias("views"),
                                           F.max(F.coalesce(test, F.lit(False))).alias("test"))


def excluded_ips(profile: DataFrame, ip_org: DataFrame, rules: WebRules) -> list[DataFrame]:
    """Addresses of test traffic, and the most active addresses whose organisation matches ``org_keep``.

    Both lists use all columns of the profile, so they read one aggregation of the page views.
    """
    testing = profile.where(F.col("test") & (F.col("views") > 0)).select("context_ip")
    top = profile.orderBy(F.desc("views"), F.asc_nulls_first("context_ip")).limit(rules.top_ips).where(~F.col("test"))
    return [testing, top.join(ip_org, "context_ip").where(matches("org", rules.org_keep)).select("context_ip")]


def _label(rules: WebRules):
    """Label of a known medium."""
    return lambda m: ladder([((m, rules.paid_media), "paid"), (m == "organic", "organic")], default="other")


def _label_without_medium(rules: WebRules):
    """Label of a row on a day without medium, from its referrer; NULL on own pages."""
    host = F.col("host")
    out = [(host == "none", "direct")]
    if rules.own_home:
        out.append((F.col("referrer") == rules.own_home, "direct"))
    if rules.parent_host:
        out.append((matches(host, rules.parent_host), "referral (internal)"))
    if rules.own_host:
        out.append((matches(host, rules.own_host), F.lit(None).cast("string")))
    return ladder(out, default="referral")


def attributed_pageviews(spark: SparkSession, pages: DataFrame, internal_ips: DataFrame, ip_org: DataFrame,
                         ua_dim: DataFrame, clicks: DataFrame, rules: WebRules = WebRules(),
                         position: str | None = None) -> DataFrame:
    """``position`` names a further column, a row's place in its visitor's order (``operators.mode`` reads it)."""
    literal = spark.createDataFrame([(ip,) for ip in rules.literal_ips], "context_ip string")
    df = pages.where(not_matches("title", rules.title_drop))
    df = anti_join_any(df, "context_ip", [internal_ips.select(F.col("ip_address").alias("context_ip")),
                                          *excluded_ips(ip_profile(pages, rules), ip_org, rules), literal])
    df = null_safe_join(df, ua_dim, [("context_user_agent", "userAgent")], "left")
    df = df.where(not_matches("ua_family", rules.bot_family)
                  & not_matches("context_user_agent", rules.agent_drop, ignore_case=False))
    before, after = split_at("url", rules.click_marker)
    df = df.withColumns({"url": before, "gcl_id": after})
    # click ids are never NULL in the click table: a plain equi join keeps the fan-out
    df = df.join(clicks.select("gcl_id"), "gcl_id", "left")
    has_click = F.col("gcl_id").isNotNull()
    df = df.withColumns({
        "seg_date": F.to_date("original_timestamp"),
        "host": referrer_host("referrer"),
        "campaign_name": F.coalesce(F.col("context_campaign_name"), url_param("url", "utm_campaign"),
                                    F.when(has_click, F.lit("not captured"))),
        "campaign_medium": F.coalesce(F.col("context_campaign_medium"), url_param("url", "utm_medium"),
                                      F.when(has_click, F.lit("cpc"))),
        "campaign_source": F.coalesce(F.col("context_campaign_source"), url_param("url", "utm_source"),
                                      F.when(has_click, F.lit("google"))),
    })
    df = df.select(*[c for c in PAGEVIEW_COLUMNS if c != "landing_content"], "referrer")  # what the dealt rows carry
    df = attribute(df, "anonymous_id", "seg_date", ORDER, ["campaign_medium", "campaign_source", "campaign_name"],
                   "campaign_medium", _label(rules), _label_without_medium(rules),
                   promote=matches("host", rules.search_hosts), landing=("url", "landing_content"), unknown="unknown",
                   position=position)
    return df.select(*PAGEVIEW_COLUMNS, *([position] if position else []))


def daily_visitors(pageviews: DataFrame, rules: WebRules = WebRules()) -> DataFrame:
    """One row per visitor-day: first-seen modes, paid flag and calendar columns."""
    path, name = F.col("path"), F.col("campaign_name")
    product = ladder([(matches(name, p) | matches(path, p), label) for p, label in rules.product_rules])
    df = pageviews.withColumns({
        "city": regex_ladder("path", rules.city_rules) if rules.city_rules else F.lit(None).cast("string"),
        "location_id": regex_ladder("path", rules.unit_rules) if rules.unit_rules else F.lit(None).cast("string"),
        "product": product if rules.product_rules else F.lit(None).cast("string"),
    })
    keys = ["seg_date", "anonymous_id", "landing_content"]
    cols = ["campaign_medium", "campaign_source", "campaign_name", "city", "location_id", "product"]
    m = modes(df, keys, cols, [POSITION] if POSITION in pageviews.columns else ORDER)
    return m.select(
        F.col("seg_date").alias("dau_date"), "anonymous_id", "landing_content", "campaign_medium",
        "campaign_source", "campaign_name", "city", F.col("location_id").alias("unit"),
        F.col("product").alias("product_orig"),
        F.when(F.col("campaign_medium") == "paid", 1).otherwise(0).alias("true_paid"),
        weekday_mon1("seg_date").alias("dau_day"), week_start("seg_date").alias("week_start"),
        month_start("seg_date").alias("month_start"), quarter_start("seg_date").alias("quarter_start"))


def tracked_forms(viewed: DataFrame, submitted: DataFrame) -> DataFrame:
    """Viewed and submitted form events, UNION (distinct)."""
    return union_distinct([viewed, submitted])


def form_conversions(visitors: DataFrame, forms: DataFrame) -> DataFrame:
    """Form events of visitors on the same day (visitor-day list x forms, null-safe)."""
    v = visitors.select("dau_date", "anonymous_id")
    f = forms.withColumn("dau_date", F.to_date("original_timestamp"))
    return null_safe_join(v, f, ["dau_date", "anonymous_id"], "inner")


@dataclass
class WebSources:
    pages: DataFrame
    internal_ips: DataFrame
    ip_org: DataFrame
    ua_dim: DataFrame
    clicks: DataFrame
    forms_viewed: DataFrame
    forms_submitted: DataFrame
    extra: dict = field(default_factory=dict)


def web_marts(spark: SparkSession, src: WebSources, rules: WebRules = WebRules()) -> dict[str, DataFrame]:
    pv = attributed_pageviews(spark, src.pages, src.internal_ips, src.ip_org, src.ua_dim, src.clicks, rules)
    dau = daily_visitors(pv, rules)
    conv = form_conversions(dau, tracked_forms(src.forms_viewed, src.forms_submitted))
    return {"attributed_pageviews": pv, "daily_visitors": dau, "form_conversions": conv}


# Rules for the adapted driver data: path / campaign patterns that occur in it.
ADAPTED_RULES = WebRules(
    city_rules=(("/fr/", "Paris"), ("/de/", "Berlin"), ("/es/", "Madrid")),
    unit_rules=(("/fr/[0-4]", "FR-1"), ("/fr/", "FR-2"), ("/de/", "DE-1")),
    product_rules=(("promo", "Suite"), ("\\.html", "Desk"), ("/es/", "Room")),
)


def adapted_sources(spark: SparkSession, sf_dir: str) -> WebSources:
    from martforge.sources import adapters as A
    pages = A.tracking_pages(spark, sf_dir)
    return WebSources(pages=pages, internal_ips=A.internal_ips(spark, sf_dir), ip_org=A.ip_org(spark, sf_dir),
                      ua_dim=parse_agents(pages), clicks=A.click_performance(spark, sf_dir),
                      forms_viewed=A.lead_forms(spark, sf_dir, "viewed"),
                      forms_submitted=A.lead_forms(spark, sf_dir, "submitted"))


def _adapted_pageviews(spark: SparkSession, src: WebSources, position: str | None = None) -> DataFrame:
    return attributed_pageviews(spark, src.pages, src.internal_ips, src.ip_org, src.ua_dim, src.clicks, ADAPTED_RULES,
                                position)


def attributed_pageviews_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _adapted_pageviews(spark, adapted_sources(spark, sf_dir))


def daily_visitors_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_visitors(_adapted_pageviews(spark, adapted_sources(spark, sf_dir), POSITION), ADAPTED_RULES)


def form_conversions_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = adapted_sources(spark, sf_dir)
    visitors = daily_visitors(_adapted_pageviews(spark, src, POSITION), ADAPTED_RULES)
    return form_conversions(visitors, tracked_forms(src.forms_viewed, src.forms_submitted))


def user_agents_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The distinct agents of the page views, parsed."""
    from martforge.sources import adapters as A
    return parse_agents(A.tracking_pages(spark, sf_dir))


def ip_range_lookup_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Organisation of each visitor's address, from a dimension of address ranges."""
    from martforge.sources import adapters as A
    return lookup(A.visitor_addresses(spark, sf_dir), "context_ip", A.address_ranges(spark, sf_dir), "first", "last", ["org"])
