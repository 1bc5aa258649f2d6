"""User-agent strings parsed by ordered rules, as built-in expressions.

Six columns: agent family, device family / brand / model, system family and its major version.
Parse the distinct agents, not the page views.  Each rule names a literal word that the agent must hold before its
pattern is tested, and the rules of a column form one ladder, so an agent costs a word search per rule and few
patterns.  A rule's group, where it has one, names the family, the model or the version; the first rule that
matches decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values: (word, pattern, family) of clients that are programs, in rule order.  They come before browsers.
BOTS = (
    ("facebookexternalhit", r"facebookexternalhit", "FacebookBot"), ("facebookcatalog", r"facebookcatalog", "FacebookBot"),
    ("Slurp", r"Slurp", "Yahoo! Slurp"), ("Google-InspectionTool", r"Google-InspectionTool", "Google-InspectionTool"),
    ("ia_archiver", r"ia_archiver", "ia_archiver"), ("HeadlessChrome", r"HeadlessChrome/", "HeadlessChrome"))
PROGRAMS = (
    ("curl", r"^curl/", "curl"), ("Wget", r"^Wget/", "Wget"), ("python-requests", r"python-requests/", "Python Requests"),
    ("Go-http-client", r"Go-http-client/", "Go-http-client"), ("okhttp", r"okhttp/", "okhttp"),
    ("Java", r"^Java/", "Java"), ("Apache-HttpClient", r"Apache-HttpClient/", "Apache-HttpClient"),
    ("PostmanRuntime", r"PostmanRuntime/", "PostmanRuntime"))
#: Words of which one makes any agent a bot of that name.
BOT = r"([A-Za-z0-9_-]*(?:bot|crawler|spider)[A-Za-z0-9_-]*)"
BOT_WORDS = ("bot", "crawler", "spider")
# Fixed values: (word, pattern, family) of browsers; those that also name others come first.
FAMILIES = (
    ("Edg", r"Edg(?:e|A|iOS)?/", "Edge"), ("OPR", r"OPR/", "Opera"), ("Opera", r"Opera", "Opera"), ("OPiOS", r"OPiOS/", "Opera"),
    ("SamsungBrowser", r"SamsungBrowser/", "Samsung Internet"), ("YaBrowser", r"YaBrowser/", "Yandex Browser"),
    ("Vivaldi", r"Vivaldi/", "Vivaldi"), ("UCBrowser", r"UCBrowser/", "UC Browser"), ("FBAN", r"\[FBAN", "Facebook"),
    ("Instagram", r"Instagram ", "Instagram"), ("GSA", r"GSA/", "Google"), ("DuckDuckGo", r"DuckDuckGo/", "DuckDuckGo Mobile"),
    ("FxiOS", r"FxiOS/", "Firefox iOS"), ("CriOS", r"CriOS/", "Chrome Mobile iOS"), ("Seamonkey", r"Seamonkey/", "SeaMonkey"),
    ("Firefox", r"Mobile; rv:[0-9.]+\) Gecko/\S+ Firefox/", "Firefox Mobile"), ("Firefox", r"Firefox/", "Firefox"),
    ("; wv)", r"; wv\).*Chrome/", "Chrome Mobile WebView"), ("Mobile", r"Chrome/[0-9.]+ Mobile", "Chrome Mobile"),
    ("Chromium", r"Chromium/", "Chromium"), ("Chrome", r"Chrome/", "Chrome"),
    ("Mobile", r"Version/[0-9.]+ Mobile/\S+ Safari/", "Mobile Safari"), ("Safari", r"Version/[0-9.]+ Safari/", "Safari"),
    ("MSIE", r"MSIE ", "IE"), ("Trident", r"Trident/", "IE"))
# Fixed values: (word, pattern, family, version pattern) of systems, in rule order.
SYSTEMS = (
    ("Windows Phone", r"Windows Phone", "Windows Phone", r"Windows Phone (?:OS )?([0-9]+)"),
    ("iPhone", r"iPhone", "iOS", r"OS ([0-9]+)_"), ("iPad", r"iPad", "iOS", r"OS ([0-9]+)_"),
    ("iPod", r"iPod", "iOS", r"OS ([0-9]+)_"), ("Tizen", r"Tizen", "Tizen", r"Tizen ([0-9]+)"),
    ("Android", r"Android", "Android", r"Android ([0-9]+)"), ("Windows NT", r"Windows NT", "Windows", r"Windows NT ([0-9.]+)"),
    ("Mac OS X", r"Mac OS X", "Mac OS X", r"Mac OS X ([0-9]+)"), ("CrOS", r"CrOS", "Chrome OS", r"CrOS \S+ ([0-9]+)"),
    ("Ubuntu", r"Ubuntu", "Ubuntu", r"Ubuntu[/ ]([0-9]+)"), ("Fedora", r"Fedora", "Fedora", r"Fedora[/ ]([0-9]+)"),
    ("FreeBSD", r"FreeBSD", "FreeBSD", r"FreeBSD ([0-9]+)"), ("Linux", r"Linux", "Linux", r"Linux ([0-9]+)"))
# Kernel number -> version that Windows is sold as.
WINDOWS = {"10.0": "10", "6.3": "8", "6.2": "8", "6.1": "7", "6.0": "Vista", "5.2": "XP", "5.1": "XP", "5.0": "2000"}
# Fixed values: (word, pattern, device, brand, model); NULL model: the text that the pattern's group holds.
DEVICES = (
    ("iPhone", r"iPhone", "iPhone", "Apple", "iPhone"), ("iPad", r"iPad", "iPad", "Apple", "iPad"),
    ("iPod", r"iPod", "iPod", "Apple", "iPod"), ("Macintosh", r"Macintosh", "Mac", "Apple", "Mac"),
    ("SM-", r"; (SM-[A-Z0-9]+)", "Samsung", "Samsung", None), ("GT-", r"; (GT-[A-Z0-9]+)", "Samsung", "Samsung", None),
    ("Pixel", r"; (Pixel [A-Za-z0-9 ]+?)(?: Build|[;)])", "Pixel", "Google", None),
    ("Nexus", r"; (Nexus [A-Za-z0-9 ]+?)(?: Build|[;)])", "Nexus", "Google", None),
    ("Redmi", r"; (Redmi [A-Za-z0-9+ ]+?)(?: Build|[;)])", "XiaoMi", "XiaoMi", None),
    ("POCO", r"; (POCO [A-Za-z0-9+ ]+?)(?: Build|[;)])", "XiaoMi", "XiaoMi", None),
    ("Mi ", r"; (Mi [A-Za-z0-9+ ]+?)(?: Build|[;)])", "XiaoMi", "XiaoMi", None),
    ("HUAWEI", r"; HUAWEI ([A-Za-z0-9 -]+?)(?: Build|[;)])", "Huawei", "Huawei", None),
    ("HONOR", r"; HONOR ([A-Za-z0-9 -]+?)(?: Build|[;)])", "Honor", "Honor", None),
    ("ONEPLUS", r"; ONEPLUS ([A-Za-z0-9]+)", "OnePlus", "OnePlus", None), ("CPH", r"; (CPH[0-9]+)", "Oppo", "Oppo", None),
    ("RMX", r"; (RMX[0-9]+)", "Realme", "Realme", None), ("vivo", r"; vivo ([A-Za-z0-9]+)", "Vivo", "vivo", None),
    ("moto", r"; (moto [A-Za-z0-9 ()]+?)(?: Build|[;)])", "Motorola", "Motorola", None),
    ("Nokia", r"; Nokia ([A-Za-z0-9. ]+?)(?: Build|[;)])", "Nokia", "Nokia", None),
    ("LM-", r"; (LM-[A-Z0-9]+)", "LG", "LG", None), ("XQ-", r"; (XQ-[A-Z0-9]+)", "Sony", "Sony", None),
    ("HTC", r"; HTC[ _]([A-Za-z0-9 _]+?)(?: Build|[;)])", "HTC", "HTC", None),
    ("ASUS_", r"; (ASUS_[A-Z0-9]+)", "Asus", "Asus", None), ("Lenovo", r"; Lenovo ([A-Za-z0-9 -]+?)(?: Build|[;)])", "Lenovo", "Lenovo", None),
    ("KF", r"; (KF[A-Z]{2,6})\b", "Kindle", "Amazon", None))


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _group(col: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(col, pattern, 1), F.lit(""))


def _ladder(agent: Column, rules, result) -> Column:
    """``result(rule)`` of the first rule whose word and then whose pattern the agent holds."""
    out = None
    for rule in rules:
        hit = agent.contains(rule[0]) & agent.rlike(rule[1])
        out = F.when(hit, result(rule)) if out is None else out.when(hit, result(rule))
    return out


def agent_columns(agent) -> dict[str, Column]:
    """The six columns of an agent string (``Other`` where no rule matches; brand, model and version NULL)."""
    a = _c(agent)
    lower = F.lower(a)
    worded = lower.contains(BOT_WORDS[0])
    for word in BOT_WORDS[1:]:
        worded = worded | lower.contains(word)
    named = lambda rules: _ladder(a, rules, lambda r: F.lit(r[2]))
    spider = F.coalesce(named(BOTS), F.when(worded, _group(a, f"(?i){BOT}")))
    windows = F.create_map(*[F.lit(x) for pair in WINDOWS.items() for x in pair])

    def version(rule):
        found = _group(a, rule[3])
        if rule[2] != "Windows":
            return found
        return F.coalesce(F.try_element_at(windows, found), F.regexp_extract(found, r"^([0-9]+)", 1))

    other = F.lit("Other")
    device = F.when(spider.isNotNull(), "Spider")
    return {
        "ua_family": F.coalesce(spider, named(PROGRAMS), named(FAMILIES), other),
        "device_family": F.coalesce(device, named(DEVICES), other),
        "device_brand": F.when(device.isNull(), _ladder(a, DEVICES, lambda r: F.lit(r[3]))),
        "device_model": F.when(device.isNull(), _ladder(a, DEVICES, lambda r: F.lit(r[4]) if r[4] else _group(a, r[1]))),
        "os_family": F.coalesce(named(SYSTEMS), other),
        "os_major": _ladder(a, SYSTEMS, version)}


def parse_agents(rows: DataFrame, agent_col: str = "context_user_agent") -> DataFrame:
    """``userAgent`` and its six columns for the distinct agents of ``rows``."""
    return rows.select(F.col(agent_col).alias("userAgent")).distinct().withColumns(agent_columns("userAgent"))
