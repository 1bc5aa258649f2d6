"""User agents and address ranges against rows written by hand."""

import ipaddress
import random

import pytest
from pyspark.sql import functions as F

from martforge.functions.agents import parse_agents
from martforge.operators.aggregates import join_distinct
from martforge.operators.ip_ranges import address_bits, lookup
from tests.conftest import rows

W = "AppleWebKit/537.36 (KHTML, like Gecko)"
N, O = None, "Other"
# agent, family, device, brand, model, system, version
AGENTS = [
    ("facebookexternalhit/1.1 (+http://www.facebook.com/externalhit_uatext.php)", "FacebookBot", "Spider", N, N, O, N),
    ("Mozilla/5.0 (compatible; Yahoo! Slurp; http://help.yahoo.com/help/us/ysearch/slurp)", "Yahoo! Slurp", "Spider", N, N, O, N),
    ("Mozilla/5.0 (compatible; Googlebot/2.1; +http://www.google.com/bot.html)", "Googlebot", "Spider", N, N, O, N),
    (f"Mozilla/5.0 (Linux; Android 6.0.1; Nexus 5X Build/MMB29P) {W} Chrome/99.0 Mobile Safari/537.36 (compatible; Googlebot/2.1)",
     "Googlebot", "Spider", N, N, "Android", "6"),
    ("Mozilla/5.0 (compatible; bingbot/2.0; +http://www.bing.com/bingbot.htm)", "bingbot", "Spider", N, N, O, N),
    ("my-crawler/1.0", "my-crawler", "Spider", N, N, O, N), ("Baiduspider+(+http://www.baidu.com)", "Baiduspider", "Spider", N, N, O, N),
    (f"Mozilla/5.0 (X11; Linux x86_64) {W} HeadlessChrome/110.0 Safari/537.36", "HeadlessChrome", "Spider", N, N, "Linux", N),
    ("curl/7.88.1", "curl", O, N, N, O, N), ("Wget/1.21.3", "Wget", O, N, N, O, N), ("Java/17.0.2", "Java", O, N, N, O, N),
    ("python-requests/2.31.0", "Python Requests", O, N, N, O, N), ("Go-http-client/1.1", "Go-http-client", O, N, N, O, N),
    ("okhttp/4.9.3", "okhttp", O, N, N, O, N), ("PostmanRuntime/7.32", "PostmanRuntime", O, N, N, O, N),
    ("Mozilla/5.0 (Windows NT 6.1; WOW64; Trident/7.0; rv:11.0) like Gecko", "IE", O, N, N, "Windows", "7"),
    ("Mozilla/4.0 (compatible; MSIE 8.0; Windows NT 5.1; Trident/4.0)", "IE", O, N, N, "Windows", "XP"),
    ("Mozilla/5.0 (compatible; MSIE 9.0; Windows NT 6.0; Trident/5.0)", "IE", O, N, N, "Windows", "Vista"),
    (f"Mozilla/5.0 (Windows NT 6.3; Win64; x64) {W} Chrome/109.0 Safari/537.36", "Chrome", O, N, N, "Windows", "8"),
    (f"Mozilla/5.0 (Windows NT 6.2) {W} Chrome/100.0 Safari/537.36", "Chrome", O, N, N, "Windows", "8"),
    ("Mozilla/5.0 (Windows NT 10.0; Win64; x64; rv:120.0) Gecko/20100101 Firefox/120.0", "Firefox", O, N, N, "Windows", "10"),
    (f"Mozilla/5.0 (Windows NT 10.0) {W} Chrome/118.0 Safari/537.36 OPR/104.0", "Opera", O, N, N, "Windows", "10"),
    ("Opera/9.80 (Windows NT 6.1; U; en) Presto/2.8 Version/11.0", "Opera", O, N, N, "Windows", "7"),
    (f"Mozilla/5.0 (Windows NT 10.0) {W} Chrome/116.0 YaBrowser/23.9 Safari/537.36", "Yandex Browser", O, N, N, "Windows", "10"),
    (f"Mozilla/5.0 (Windows NT 10.0) {W} Chrome/116.0 Safari/537.36 Vivaldi/6.2", "Vivaldi", O, N, N, "Windows", "10"),
    ("Mozilla/5.0 (Macintosh; Intel Mac OS X 10_15_7) AppleWebKit/605.1.15 Version/17.1 Safari/605.1.15", "Safari", "Mac", "Apple", "Mac",
     "Mac OS X", "10"),
    ("Mozilla/5.0 (iPad; CPU OS 16_6 like Mac OS X) AppleWebKit/605.1.15 Version/16.6 Mobile/15E148 Safari/604.1", "Mobile Safari", "iPad",
     "Apple", "iPad", "iOS", "16"),
    ("Mozilla/5.0 (iPhone; CPU iPhone OS 17_1 like Mac OS X) AppleWebKit/605.1.15 CriOS/119.0 Mobile/15E148 Safari/604.1",
     "Chrome Mobile iOS", "iPhone", "Apple", "iPhone", "iOS", "17"),
    ("Mozilla/5.0 (iPhone; CPU iPhone OS 16_0 like Mac OS X) AppleWebKit/605.1.15 Mobile/15E148 [FBAN/FBIOS;FBAV/440.0]", "Facebook",
     "iPhone", "Apple", "iPhone", "iOS", "16"),
    ("Mozilla/5.0 (iPhone; CPU iPhone OS 16_0 like Mac OS X) AppleWebKit/605.1 Mobile/15E148 Instagram 305.0", "Instagram", "iPhone",
     "Apple", "iPhone", "iOS", "16"),
    (f"Mozilla/5.0 (Linux; Android 13; SAMSUNG SM-A536B) {W} SamsungBrowser/22.0 Chrome/111.0 Mobile Safari/537.36", "Samsung Internet",
     O, N, N, "Android", "13"),
    (f"Mozilla/5.0 (Linux; Android 12; SM-G991U) {W} Chrome/112.0 Mobile Safari/537.36", "Chrome Mobile", "Samsung", "Samsung", "SM-G991U",
     "Android", "12"),
    (f"Mozilla/5.0 (Linux; Android 11; Redmi Note 9 Pro) {W} Chrome/118.0 Mobile Safari/537.36", "Chrome Mobile", "XiaoMi", "XiaoMi",
     "Redmi Note 9 Pro", "Android", "11"),
    (f"Mozilla/5.0 (Linux; Android 10; Mi 9T Build/QKQ1; wv) {W} Version/4.0 Chrome/110.0 Mobile Safari/537.36", "Chrome Mobile WebView",
     "XiaoMi", "XiaoMi", "Mi 9T", "Android", "10"),
    (f"Mozilla/5.0 (Linux; Android 9; HUAWEI P30 Build/X) {W} Chrome/78.0 Mobile Safari/537.36", "Chrome Mobile", "Huawei", "Huawei", "P30",
     "Android", "9"),
    (f"Mozilla/5.0 (Linux; Android 11; ONEPLUS A6003) {W} Chrome/90.0 Mobile Safari/537.36", "Chrome Mobile", "OnePlus", "OnePlus", "A6003",
     "Android", "11"),
    (f"Mozilla/5.0 (Linux; Android 12; CPH2211) {W} Chrome/90.0 Mobile Safari/537.36", "Chrome Mobile", "Oppo", "Oppo", "CPH2211", "Android", "12"),
    (f"Mozilla/5.0 (Linux; Android 11; RMX2170) {W} Chrome/90.0 Mobile Safari/537.36", "Chrome Mobile", "Realme", "Realme", "RMX2170",
     "Android", "11"),
    (f"Mozilla/5.0 (Linux; Android 10; moto g(8) power) {W} Chrome/90.0 Mobile Safari/537.36", "Chrome Mobile", "Motorola", "Motorola",
     "moto g(8", "Android", "10"),
    (f"Mozilla/5.0 (Linux; Android 10; LM-K500) {W} Chrome/90.0 Mobile Safari/537.36", "Chrome Mobile", "LG", "LG", "LM-K500", "Android", "10"),
    (f"Mozilla/5.0 (Linux; Android 7.1.2; KFMUWI) {W} Chrome/90.0 Safari/537.36", "Chrome", "Kindle", "Amazon", "KFMUWI", "Android", "7"),
    ("Mozilla/5.0 (Android 13; Mobile; rv:109.0) Gecko/118.0 Firefox/118.0", "Firefox Mobile", O, N, N, "Android", "13"),
    ("Mozilla/5.0 (X11; Ubuntu; Linux x86_64; rv:109.0) Gecko/20100101 Firefox/117.0", "Firefox", O, N, N, "Ubuntu", N),
    (f"Mozilla/5.0 (X11; CrOS x86_64 14541.0.0) {W} Chrome/110.0 Safari/537.36", "Chrome", O, N, N, "Chrome OS", "14541"),
    (f"Mozilla/5.0 (X11; Linux x86_64) {W} Ubuntu Chromium/80.0 Chrome/80.0 Safari/537.36", "Chromium", O, N, N, "Ubuntu", N),
    ("Mozilla/5.0 (Windows Phone 10.0; Android 6.0.1; Microsoft; Lumia 950) Edge/15.15063", "Edge", O, N, N, "Windows Phone", "10"),
    ("something else", O, O, N, N, O, N), ("", O, O, N, N, O, N), (None, O, O, N, N, O, N),
]


def test_agents_against_rows_by_hand(spark):
    df = spark.createDataFrame([(a[0],) for a in AGENTS * 3], "context_user_agent string")
    got = {r["userAgent"]: tuple(r) for r in parse_agents(df).collect()}
    assert len(got) == len(AGENTS)
    wrong = [(a, got[a[0]]) for a in AGENTS if got[a[0]] != a]
    assert wrong == []


@pytest.mark.parametrize("text", ["1.2.3.4", "255.255.255.255", "0.0.0.0", "::", "::1", "2001:db8::1", "fe80:0:0:0:1:2:3:4", "1::",
                                  "2001:DB8:a:b:c:d:e:f", "a::b:c"])
def test_addresses_have_their_bits(spark, text):
    a = ipaddress.ip_address(text)
    want = int(a) if a.version == 6 else (0xFFFF << 32) + int(a)
    assert rows(spark.createDataFrame([(text,)], "a string").select(address_bits("a").alias("b"))) == [(f"{want:0128b}",)]


@pytest.mark.parametrize("text", [None, "", "1.2.3", "1.2.3.256", "a.b.c.d", "1:2:3", "1:2:3:4:5:6:7:8:9", "::1::", ":::", "12345::", "x"])
def test_what_is_no_address_has_none(spark, text):
    assert rows(spark.createDataFrame([(text,)], "a string").select(address_bits("a").alias("b"))) == [(None,)]


def test_ranges_against_a_linear_search(spark):
    """Nested, adjacent, overlapping, single, whole, reversed and repeated ranges of both versions."""
    rnd = random.Random(3)
    four = lambda k: str(ipaddress.IPv4Address((10 << 24) + k))
    six = lambda k: str(ipaddress.IPv6Address((0x20010DB8 << 96) + k))
    spans = [(0, 1023, "all"), (0, 255, "a"), (256, 511, "b"), (17, 300, "odd"), (64, 64, "one"), (64, 64, "another"), (9, 3, "reversed"),
             *[(x, x + rnd.randrange(200), f"r{i}") for i, x in enumerate(rnd.sample(range(1000), 25))]]
    ranges = [(f(lo), f(hi), org + tag) for f, tag in ((four, "4"), (six, "6")) for lo, hi, org in spans] + [("0.0.0.0", "9.255.255.255", "low")]
    asked = [*range(0, 1300, 3), 64, 255, 256]
    addresses = [(f(k),) for f in (four, six) for k in asked] * 2 + [("3.4.5.6",), (None,), ("no address",)]
    got = dict(rows(lookup(spark.createDataFrame(addresses, "ip string"), "ip",
                           spark.createDataFrame(ranges, "lo string, hi string, org string"), "lo", "hi", ["org"])))
    want = {"3.4.5.6": "low"}
    for f, tag in ((four, "4"), (six, "6")):
        for k in asked:
            inside = [(-lo, hi, org + tag) for lo, hi, org in spans if lo <= k <= hi]
            if inside:
                want[f(k)] = min(inside)[2]
    assert got == want


def test_distinct_texts_are_reduced_before_they_are_joined(spark):
    df = spark.createDataFrame([("g", "b"), ("g", "a"), ("g", "b"), ("g", None), (None, "x"), ("e", None)], "g string, t string")
    assert dict(rows(join_distinct(df, ["g"], "t", "s"))) == {"g": "NA; a; b", None: "x", "e": "NA"}
    assert dict(rows(join_distinct(df, ["g"], "t", "s", sep="'", na=None))) == {"g": "a'b", None: "x", "e": ""}
    plan = join_distinct(df.union(df), ["g"], "t", "s")
    plan.collect()
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("HashAggregate") >= 2 and "SortAggregate" not in text


def test_each_network_has_its_own_accounts(spark):
    """The same account number is excluded in one network and counted in the other."""
    from martforge.plans import spend
    from martforge.sources import ad_adapters as A
    sf = "/root/testdata/sf0.001"
    args = [A.linkedin_analytics(spark, sf), A.linkedin_campaigns(spark, sf), A.linkedin_groups(spark, sf), A.bing_report(spark, sf),
            A.bing_campaigns(spark, sf), A.facebook_ads(spark, sf), A.facebook_actions(spark, sf), A.search_hourly(spark, sf, "main"),
            A.search_hourly(spark, sf, "uk")]
    n = lambda **kw: dict(rows(spend.marketing_spend(*args, **kw).groupBy("source").agg(F.count(F.lit(1)).alias("n"))))
    none, one = n(), n(linkedin_excluded=(2,))  # account 2 exists in the second network only
    assert one == none
    assert n(facebook_excluded=(2,))["LinkedIn"] == none["LinkedIn"] and n(facebook_excluded=(2,)).get("Facebook", 0) < none["Facebook"]


def test_tied_group_versions_do_not_multiply_spend_rows(spark, monkeypatch):
    """Versions without a time tie as latest; a line meets each of their names once, before the UNION too."""
    from martforge.plans import spend
    make = spark.createDataFrame
    analytics = make([(1, "2024-01-02", 10, 1, 2, 3.5), (1, "2024-01-03", 20, 2, 0, None)],
                     "campaign_id long, day string, impressions long, clicks long, external_website_conversions long, cost_in_usd double")
    campaigns = make([(1, 7, 5)], "id long, campaign_group_id long, account_id long")
    groups = make([(7, n, None) for n in ("a", "b", None) for _ in range(40)] + [(7, "old", "2024-01-01")], "id long, name string, t string")
    groups = groups.select("id", "name", F.col("t").cast("timestamp_ntz").alias("last_modified_time"))
    daily = make([], "campaign_id long, campaign_name string, date date, ad_id long, account_id long, impressions long, clicks long, "
                     "inline_link_clicks long, conversions long, spend double, cost double, action_type string")
    args = [analytics, campaigns, groups, daily, make([], "id long, name string"), daily.drop("conversions"), daily, daily, daily]
    want = sorted((n or "", d, s or 0) for n in ("a", "b", None) for d, s in (("2024-01-02", 3.5), ("2024-01-03", None)))
    found = lambda df: sorted((r["campaign_name"] or "", str(r["campaign_date"]), r["spend"] or 0) for r in df.collect())
    assert found(spend.marketing_spend(*args)) == want
    union = spend.union_distinct
    monkeypatch.setattr(spend, "union_distinct", lambda legs: union(legs, distinct=False))
    assert found(spend.marketing_spend(*args)) == want
