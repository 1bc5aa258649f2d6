"""Mart-level rules on hand-made fixtures, and the batch job end to end."""

import dataclasses
import datetime as dt
import os
import subprocess
import sys

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from martforge import jobs
from martforge.functions import dates
from martforge.functions.urls import url_host
from martforge.plans import activity_marts, crm_marts, spend
from martforge.plans.catalog import QUERIES
from martforge.sources import runs
from martforge.sources.catalog import AdapterCatalog, SourceMissing, TableCatalog
from tests.conftest import rows

SF = "/root/testdata/sf0.001"

D = dt.datetime


def test_close_date_from_latest_stage_only(spark):
    """Latest stage 'Closed Won' gives its date; 'Closed Lost' followed by 'Touring'
    falls back to the anticipated close date (the filter runs after picking the latest)."""
    hist = spark.createDataFrame(
        [("A", D(2024, 1, 1), "Touring", "SFDC", "Touring"), ("A", D(2024, 1, 5), "Closed Won", "SFDC", "Closed Won"),
         ("B", D(2024, 1, 1), "Closed Lost", "SFDC", "Closed Lost"), ("B", D(2024, 1, 9), "Touring", "SFDC", "Touring")],
        "opportunity_id string, stage_date timestamp_ntz, pipeline_stage_detail string, source string, "
        "pipeline_stage string")
    last = crm_marts.top_row(hist, ["opportunity_id"], [F.col("stage_date").desc(), F.col("pipeline_stage").desc()])
    closed = dict(rows(last.where(F.col("pipeline_stage").isin(*crm_marts.TERMINAL_STAGES)), "opportunity_id",
                       "stage_date"))
    assert closed == {"A": D(2024, 1, 5)}


def test_stage_rollup_rules(spark):
    df = spark.createDataFrame([("Cold/Dead",), ("Tour Scheduled",), ("Closed Won - late",), ("Prospecting",),
                                ("touring",)], "pipeline_stage_detail string")
    out = [r[0] for r in rows(df.select(crm_marts.stage_rollup()))]
    assert out == ["Closed Lost", "Touring", "Closed Won - late", "Upper Funnel", "Upper Funnel"]


def test_activity_detail_equal_keys(spark):
    """An unknown contact and a contact whose location is 'Not Specified' give two rows with equal keys."""
    eng = spark.createDataFrame([(1, "Email", D(2024, 1, 1, 9)), (2, "Email", D(2024, 1, 1, 10))],
                                "contact_id long, engagement_type string, created_at timestamp_ntz")
    contacts = spark.createDataFrame([(2, "Not Specified", "Not Specified")],
                                     "contact_id long, location string, product string")
    locs = spark.createDataFrame([("X", "c", "s")], "hs_locations string, city string, site_name string")
    out = rows(activity_marts.activity_detail(eng, contacts, locs), "location", "product", "engagements")
    assert sorted(out) == [("Not Specified", "Not Specified", 1), ("Not Specified", "Not Specified", 1)]


def test_geo_hierarchy_sentinel(spark):
    b = spark.createDataFrame([("L1", "U", None, "sub", "c", None, "sr", "co", "r")] * 2,
                              "building_name_c string, name string, neighborhood_name_c string, submarket_temp_c string,"
                              " city_c string, state_province_c string, sub_region_c string, country_c string,"
                              " region_c string")
    out = rows(activity_marts.geo_hierarchy(b))
    assert len(out) == 2 and ("Not Specified",) * 8 in out


def test_rep_engagements_keep_calls_that_differ_in_body(spark):
    eng = spark.createDataFrame([(1, "CALL", 7, D(2024, 1, 1)), (2, "CALL", 7, D(2024, 1, 1)), (3, "CALL", 7, D(2024, 1, 1))],
                                "id long, type string, owner_id int, created_at timestamp_ntz")
    links = spark.createDataFrame([(1, 5), (2, 5), (3, 5)], "engagement_id long, contact_id long")
    calls = spark.createDataFrame([(1, "x", "first"), (2, "x", "second"), (3, "x", "second")],
                                  "engagement_id long, disposition string, body string")
    none = spark.createDataFrame([], "engagement_id long, title string, body string, status string, subject string, text string")
    out = rows(activity_marts.rep_engagements(eng, links, calls, none, none, 7), "contact_id", "body")
    assert sorted(out) == [(5, "first"), (5, "second")]


def test_spend_below_a_cent_is_summed_exactly(spark):
    df = spark.range(1000).selectExpr("'c' as name", "0.004D as cost")
    assert rows(df.groupBy("name").agg(spend._money("cost").alias("cost")), "cost") == [(4.0,)]


def test_spend_follows_the_rules_it_is_given(spark):
    rules = spend.SpendRules(products=(("alpha", "One"),), markets=(("north", "N"),), split=(("One", 0.75), ("Two", 0.25)),
                             unplaced="?")
    df = spark.createDataFrame([("Alpha north", dt.date(2024, 1, 3), 10.0), ("other", dt.date(2024, 1, 3), 8.0)],
                               "campaign_name string, campaign_date date, spend double")
    out = rows(spend.allocate_spend(df, rules), "product", "market", "one", "two")
    assert sorted(out) == [("?", "?", 6.0, 2.0), ("One", "N", 10.0, 0.0)]


@pytest.mark.parametrize("url,host", [
    ("https://www.google.com/search?q=a|b", "www.google.com"), ("https://www.google.com/a b", "www.google.com"),
    ("www.Google.com/x", "www.google.com"), ("http://my_host:8080/y", "my_host"), ("https://u:p@site.org/z", "site.org"),
    ("", None), (None, None), ("/only/a/path", None)])
def test_hosts_are_cut_leniently(spark, url, host):
    df = spark.createDataFrame([(url,)], "u string")
    assert rows(df.select(url_host("u").alias("h"))) == [(host,)]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_times_do_not_depend_on_the_session_zone(spark, zone):
    """On 2024-03-10 New York has no 02:00-03:00: zone-less times have."""
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.sql("SELECT timestamp_ntz'2024-03-10 01:00:00' AS a, timestamp_ntz'2024-03-10 04:00:00' AS b, "
                       "timestamp_ntz'2024-03-10 02:30:45' AS c, -1500L AS e, 9007199254740993L AS big")
        got = rows(df.select(dates.hours_between("b", "a"), dates.minute_trunc("c").cast("string"),
                             dates.epoch_ms_to_timestamp("e").cast("string"), dates.days_between("a", "b", 3)))
        assert got == [(3.0, "2024-03-10 02:30:00", "1969-12-31 23:59:59", -0.125)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_null_keys_match_in_the_stage_history(spark):
    hs = spark.createDataFrame([(None, D(2024, 1, 1), "Touring")], "deal_id long, date_created timestamp_ntz, pipeline_stage string")
    synced = spark.createDataFrame([("A", None)], "salesforce_opportunity_id string, hubspot_opportunity_id long")
    crm = spark.createDataFrame([], "opportunity_id string, created_date timestamp_ntz, stage_name string")
    rules = crm_marts.DealRules(source_tags=("left", "right"))
    out = rows(crm_marts.deal_stage_history(hs, synced, crm, rules), "opportunity_id", "pipeline_stage", "source")
    assert out == [("A", "Touring", "left")]


# ---------------------------------------------------------------- the batch job

@pytest.fixture(scope="module")
def job_run(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("job"))
    written = jobs.run(spark, AdapterCatalog(spark, SF), out, jobs.adapter_params(), run_id="one")
    return out, written


def test_job_writes_every_extract_and_mart(spark, job_run):
    out, written = job_run
    assert set(written) == set(jobs.EXTRACTS) | set(jobs.MARTS) and len(jobs.MARTS) == 10
    assert [r["run"] for r in runs.published(spark, out)] == ["one"]
    assert all(e.origin == "one" and os.path.isdir(os.path.join(out, "one", e.folder, e.name)) for e in written.values())


@pytest.mark.parametrize("name", ["attributed_pageviews", "daily_visitors", "form_conversions", "marketing_spend", "contracts",
                                  "contact_mart", "activity_summary", "activity_detail", "deal_mart", "crm_opportunities",
                                  "opportunity_roles", "rep_engagements", "access_events", "geo_hierarchy", "crm_leads"])
def test_written_tables_hold_the_queries_rows(spark, job_run, name):
    want = QUERIES[name](spark, SF)
    got = runs.read_run(spark, job_run[0], "one", name)
    assert got.count() == want.count() == job_run[1][name].rows > 0
    assert sorted(got.columns) == sorted(want.columns)


def _only(monkeypatch, *names):
    monkeypatch.setattr(jobs, "EXTRACTS", {k: jobs.EXTRACTS[k] for k in names})
    monkeypatch.setattr(jobs, "MARTS", {})


def test_gated_and_missing_extracts_are_carried_over(spark, tmp_path, monkeypatch):
    """... from the newest complete run that has them; the manifest keeps the run that computed them."""
    _only(monkeypatch, "access_events", "companies")
    out, real = str(tmp_path), AdapterCatalog(spark, SF)
    on = jobs.adapter_params()
    off = dataclasses.replace(on, include_access_events=False)

    def without_company(name):
        if name == "mkt.company":
            raise SourceMissing(name)
        return real(name)

    first = jobs.run(spark, real, out, off, "a")
    assert set(first) == {"companies"}  # nothing to carry over yet
    events = jobs.run(spark, real, out, on, "b")["access_events"]
    carried = jobs.run(spark, without_company, out, off, "c")
    assert {e.name: (e.origin, e.rows) for e in carried.values()} == {"access_events": ("b", events.rows), "companies": ("b", 25)}
    assert jobs.run(spark, real, out, off, "d")["access_events"].origin == "b"  # not "c", which only carried it
    assert sorted(runs.read_run(spark, out, "d", "access_events").collect(), key=str) == sorted(
        jobs.EXTRACTS["access_events"](real, on).collect(), key=str)
    with pytest.raises(SourceMissing):
        jobs.run(spark, without_company, str(tmp_path / "empty"), off, "a")


def test_a_run_killed_half_way_is_no_run(spark, tmp_path, monkeypatch):
    _only(monkeypatch, "access_events", "companies")
    out, real, params = str(tmp_path), AdapterCatalog(spark, SF), jobs.adapter_params()
    jobs.run(spark, real, out, params, "a")

    def dies(s, p):
        raise KeyboardInterrupt

    monkeypatch.setitem(jobs.EXTRACTS, "companies", dies)
    with pytest.raises(KeyboardInterrupt):
        jobs.run(spark, real, out, params, "b")
    assert os.path.isdir(os.path.join(out, "b", "raw", "access_events"))  # written, not published
    assert [r["run"] for r in runs.published(spark, out)] == ["a"]
    with pytest.raises(LookupError):
        runs.read_run(spark, out, "b", "access_events")
    assert runs.newest_with(spark, out, "access_events")[1].origin == "a"


def test_half_a_manifest_is_none(spark, tmp_path):
    entry = runs.write_table(spark.range(3), str(tmp_path), "a", "raw", "t")
    row = [("a", "2024", "2024", 2, "t", "raw", "a", entry.rows, entry.schema)]
    spark.createDataFrame(row, runs.MANIFEST_COLUMNS).write.json(str(tmp_path / "a" / runs.MANIFEST))
    assert runs.published(spark, str(tmp_path)) == [] and runs.newest_with(spark, str(tmp_path), "t") is None
    assert runs.published(spark, str(tmp_path / "none")) == []


def test_a_table_with_repeated_keys_is_not_published(spark, tmp_path):
    rows_ = spark.createDataFrame([(1, "x"), (1, "y")], "k int, v string")
    with pytest.raises(runs.RunFailed):
        runs.write_table(rows_, str(tmp_path), "a", "raw", "t", keys=["k"])
    assert runs.write_table(rows_, str(tmp_path), "a", "raw", "u", keys=["k", "v"]).rows == 2


def test_a_bug_ends_the_run(spark, job_run, monkeypatch):
    out, _ = job_run
    monkeypatch.setattr(jobs, "EXTRACTS", {"companies": lambda s, p: s("mkt.company").select("no_such_column")})
    with pytest.raises(AnalysisException):
        jobs.run(spark, AdapterCatalog(spark, SF), out, jobs.adapter_params(), "bug")
    monkeypatch.setattr(jobs, "EXTRACTS", {"companies": lambda s, p: s("mkt.company")})
    with pytest.raises(AnalysisException):  # a run's folder is never written twice
        jobs.run(spark, AdapterCatalog(spark, SF), out, jobs.adapter_params(), "one")


def test_one_clock_moves_the_marts(spark):
    """``time_to_first_contact`` of a contact without outreach counts up to the run's ``as_of``."""
    source, params = AdapterCatalog(spark, SF), jobs.adapter_params()
    tables = {n: jobs.EXTRACTS[n](source, params) for n in ("contacts", "companies", "tours_and_calls", "email_log", "phone_call_log")}

    def hours(days):
        p = dataclasses.replace(params, as_of=params.as_of + dt.timedelta(days=days))
        mart = jobs.MARTS["contact_mart"](tables.__getitem__, p)
        return dict(mart.where("first_outbound_email IS NULL AND lead_date IS NOT NULL")
                    .select("contact_id", "time_to_first_contact").distinct().collect()), p.report_dates()[1]

    (early, last), (late, later) = hours(0), hours(10)
    assert early and all(late[k] == pytest.approx(v + 240) for k, v in early.items()) and (later - last).days == 10


def test_sources_by_path_and_by_sql(spark, tmp_path):
    spark.createDataFrame([(1, "a")], "`Deal ID` long, Name string").write.parquet(str(tmp_path / "t"))
    source = TableCatalog(spark, {"t": {"parquet": str(tmp_path / "t")}, "gone": {"parquet": str(tmp_path / "none")},
                                  "q": {"sql": "SELECT id AS ID FROM range(10) WHERE id < :top", "args": {"top": 3}}})
    assert source("t").columns == ["deal_id", "name"]
    assert source("q").count() == 3 and source("q").columns == ["id"]
    for name in ("gone", "unknown"):
        with pytest.raises(SourceMissing):
            source(name)


def test_parameters_from_json():
    p = jobs.params_from({"contact_rules": {"contact_list_id": 4, "broker_team_id": "t", "stages_drop": ["a"]},
                          "rep_owner_id": 3, "disposition_labels": {}, "as_of": "2024-03-01T00:00:00",
                          "spend_rules": {"products": [["x", "X"]]}})
    assert p.report_dates() == (dt.date(2023, 2, 28), dt.date(2024, 2, 29))
    assert p.contact_rules.stages_drop == ("a",) and p.spend_rules.products == (("x", "X"),)


def test_a_session_starts_without_site_defaults(tmp_path):
    code = ("from martforge.session import get_session; s = get_session('local[1]', 1); "
            "print('ROWS', s.range(3).count()); s.stop()")
    env = {k: v for k, v in os.environ.items() if not k.startswith("SPARK_")} | {
        "SPARK_CONF_DIR": str(tmp_path), "PYTHONPATH": os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
        "MARTFORGE_DRIVER_MEMORY": "1g"}
    done = subprocess.run([sys.executable, "-c", code], env=env, cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert "ROWS 3" in done.stdout, done.stderr[-2000:]
