"""Batch job: all extracts and marts, one Parquet table each, in a new run folder.

    python -m martforge.jobs --catalog sources.json --out <shared folder>
    python -m martforge.jobs --sf-dir <driver tables> --out <shared folder>

* Extracts are written under ``<out>/<run>/raw/<name>``.  An extract that is gated off, or whose source table is missing
  (and only that), is carried over from the newest complete run below ``out`` that has it; the manifest names the
  run that computed it.  A missing source without such a run, and any other error, end the run.
* Marts are written under ``<out>/<run>/marts/<name>`` from the written extracts and marts, never from a plan that
  reads the sources again.  The attributed page views are partitioned by date.
* Every table is read back and checked; the manifest is written last and publishes the run (``sources.runs``).
* One clock: ``JobParams.as_of`` bounds the calendar and stands for "now" in the marts.

``out`` must be a shared location (the cluster's storage).
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import logging
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from martforge.functions.agents import parse_agents
from martforge.operators.aggregates import date_spine, days_per_week
from martforge.operators.setops import union_distinct
from martforge.plans import activity_marts, contact_marts, crm_extracts, crm_marts, extracts, spend, web_marts, workspace
from martforge.sources.catalog import AdapterCatalog, SourceMissing, TableCatalog
from martforge.sources.runs import TableEntry, newest_with, published, publish, write_table

log = logging.getLogger(__name__)
Source = Callable[[str], DataFrame]


@dataclass(frozen=True)
class JobParams:
    """What a run is told: report dates, tenant constants and gates.

    ``as_of`` is the run's only clock.  ``yesterday`` and ``year_ago`` bound the report's calendar; by default the day
    before ``as_of`` and the same date one year earlier.
    """

    contact_rules: contact_marts.ContactRules
    rep_owner_id: int
    disposition_labels: dict
    as_of: dt.datetime
    yesterday: dt.date | None = None
    year_ago: dt.date | None = None
    include_access_events: bool = False
    portal_id: int = 0
    excluded_type: str = "Find"
    activity_excluded_type: str = "Partner"
    lead_type: str = "Fill"
    second_pipeline: str = "other"
    linkedin_excluded: tuple[int, ...] = ()
    facebook_excluded: tuple[int, ...] = ()
    conversion_types: tuple[str, ...] = ()
    deal_rules: crm_marts.DealRules = crm_marts.DealRules()
    web_rules: web_marts.WebRules = web_marts.WebRules()
    spend_rules: spend.SpendRules = field(default_factory=lambda: spend.SpendRules())

    def report_dates(self) -> tuple[dt.date, dt.date]:
        last = self.yesterday or (self.as_of - dt.timedelta(days=1)).date()
        first = self.year_ago or (last.replace(year=last.year - 1) if (last.month, last.day) != (2, 29)
                                  else last.replace(year=last.year - 1, day=28))
        return first, last


def adapter_params() -> JobParams:
    """Parameters that fit the sources derived from the driver tables."""
    from martforge.sources import ad_adapters, crm_adapters, extract_adapters
    labels = dict(crm_adapters.DISPOSITION_LABELS)
    return JobParams(contact_rules=contact_marts.adapted_rules(), rep_owner_id=crm_adapters.REP_OWNER_ID,
                     disposition_labels=labels, include_access_events=True, portal_id=extract_adapters.PORTAL_ID,
                     as_of=contact_marts.ADAPTED_AS_OF, linkedin_excluded=ad_adapters.LINKEDIN_EXCLUDED,
                     facebook_excluded=ad_adapters.FACEBOOK_EXCLUDED, conversion_types=ad_adapters.FB_CONVERSION_TYPES,
                     web_rules=web_marts.ADAPTED_RULES, spend_rules=spend.ADAPTED_RULES)


def params_from(given: dict) -> JobParams:
    """Parameters from a dictionary (a JSON file's ``params``); rule groups are dictionaries of their own fields."""
    kinds = {"contact_rules": contact_marts.ContactRules, "deal_rules": crm_marts.DealRules,
             "web_rules": web_marts.WebRules, "spend_rules": spend.SpendRules}
    parse = {"as_of": dt.datetime.fromisoformat, "yesterday": dt.date.fromisoformat, "year_ago": dt.date.fromisoformat}

    def fixed(x):  # JSON has lists where the rules have tuples
        return tuple(fixed(y) for y in x) if isinstance(x, list) else x

    def value(k, v):
        if k in kinds:
            return kinds[k](**{f: parse[f](x) if f in parse else fixed(x) for f, x in v.items()})
        return parse[k](v) if k in parse else fixed(v)

    return JobParams(**{k: value(k, v) for k, v in given.items()})


def _second_rules(p: JobParams) -> crm_marts.DealRules:
    from dataclasses import replace
    return replace(p.deal_rules, pipeline_id=p.second_pipeline)


#: Every extract of the source job, by name; ``s`` gives a source table, ``p`` the parameters.
EXTRACTS: dict[str, Callable[[Source, JobParams], DataFrame]] = {
    "contacts": lambda s, p: contact_marts.list_contacts(s("mkt.contact_list_member"), s("mkt.contact"), p.contact_rules),
    "lifecycle_history": lambda s, p: extracts.lifecycle_history(s("mkt.contact_history")),
    "deals_with_owner": lambda s, p: extracts.deals_with_owner(s("mkt.deal"), s("mkt.owner")),
    "marketing_deal_history": lambda s, p: crm_marts.marketing_deal_history(
        s("mkt.deal_property_history"), s("mkt.pipeline_stage_labels"), p.deal_rules),
    "review_history": lambda s, p: activity_marts.review_history(s("mkt.contact_property_history")),
    "deal_contact_links": lambda s, p: crm_extracts.link_table(s("mkt.deal_contact"), ["deal_id", "contact_id"]),
    "deal_company_links": lambda s, p: crm_extracts.link_table(s("mkt.deal_company"), ["deal_id", "company_id"]),
    "companies": lambda s, p: s("mkt.company"),
    "stage_probabilities": lambda s, p: extracts.stage_probabilities(s("mkt.pipeline_stage"), s("mkt.pipeline")),
    "contact_engagements": lambda s, p: contact_marts.contact_engagements(s("mkt.engagement_contact"), s("mkt.engagement")),
    "phone_call_log": lambda s, p: contact_marts.phone_call_log(s("mkt.engagement_call"), s("mkt.engagement_contact"),
                                                                s("mkt.engagement")),
    "email_log": lambda s, p: contact_marts.email_log(s("mkt.engagement_email"), s("mkt.engagement_contact"),
                                                      s("mkt.engagement")),
    "tours_and_calls": lambda s, p: contact_marts.tours_and_calls(
        s("mkt.engagement_meeting"), s("mkt.engagement_contact"), s("mkt.contact"), s("mkt.engagement"), p.contact_rules),
    "pipeline_moves": lambda s, p: extracts.pipeline_moves(
        s("mkt.deal_pipeline_history"), (p.deal_rules.pipeline_id, p.second_pipeline)),
    "second_pipeline_history": lambda s, p: crm_marts.marketing_deal_history(
        s("mkt.deal_property_history"), s("mkt.pipeline_stage_labels"), _second_rules(p)),
    "form_hits": lambda s, p: extracts.form_hits(s("web.hits")),
    "marketing_spend": lambda s, p: spend.marketing_spend(
        s("ads.linkedin_analytics"), s("ads.linkedin_campaigns"), s("ads.linkedin_groups"), s("ads.bing_report"),
        s("ads.bing_campaigns"), s("ads.facebook_ads"), s("ads.facebook_actions"), s("ads.search_main"),
        s("ads.search_uk"), p.linkedin_excluded, p.facebook_excluded, p.conversion_types),
    "rep_engagements": lambda s, p: activity_marts.rep_engagements(
        s("mkt.engagement"), s("mkt.engagement_contact"), s("mkt.engagement_call"), s("mkt.engagement_meeting"),
        s("mkt.engagement_email"), p.rep_owner_id),
    "rep_tasks": lambda s, p: activity_marts.rep_tasks(s("mkt.engagement"), s("mkt.engagement_contact"),
                                                       s("mkt.engagement_task"), p.rep_owner_id),
    "meeting_bookings": lambda s, p: workspace.meeting_bookings(
        s("ws.bookings"), s("ws.resources"), s("ws.businesses"), s("ws.coworkers"), s("ws.teams"),
        s("ws.extra_services"), s("ws.members")),
    "spaces": lambda s, p: workspace.spaces(s("ws.desk_offices")),
    "contracts": lambda s, p: workspace.contracts(s("ws.contracts"), s("ws.coworkers"), s("ws.invoices"),
                                                  s("ws.tariffs"), s("ws.teams")),
    "teams": lambda s, p: workspace.teams(s("ws.teams"), s("ws.businesses")),
    "space_assignments": lambda s, p: workspace.spaces(s("ws.desk_offices")),
    "access_events": lambda s, p: extracts.access_events(s("access.events"), s("access.links"), s("access.people"),
                                                         s("access.addresses")),
    "deleted_deals": lambda s, p: extracts.deleted_deals(s("mkt.deal_deletion"), s("mkt.deal_deletion_before_webhook"),
                                                         p.portal_id),
    "crm_opportunities": lambda s, p: crm_extracts.crm_opportunities(
        s("crm.opportunities"), s("crm.record_types"), s("crm.accounts"), s("crm.landlord_companies"),
        s("crm.account_contacts"), s("crm.contacts"), s("crm.users"), s("crm.user_roles"), s("crm.buildings"),
        p.excluded_type),
    "crm_deal_history": lambda s, p: crm_marts.crm_deal_history(s("crm.opportunity_history"), s("crm.opportunities"),
                                                                s("crm.record_types"), p.deal_rules),
    "crm_leads": lambda s, p: extracts.crm_leads(s("crm.leads"), s("crm.lead_record_types"), s("crm.activity_users"),
                                                 p.lead_type),
    "crm_activity": lambda s, p: extracts.crm_activity(s("crm.tasks"), s("crm.calendar_events"), s("crm.activity_users"),
                                                       s("crm.opportunities"), s("crm.record_types"),
                                                       p.activity_excluded_type),
    "opportunity_roles": lambda s, p: crm_extracts.opportunity_roles(
        s("crm.contact_roles"), s("crm.opportunities"), s("crm.record_types"), s("crm.contacts"),
        s("crm.landlord_companies"), p.excluded_type),
    "tours": lambda s, p: extracts.tours(s("crm.awareness_tours"), s("crm.events"), s("crm.buildings"), s("crm.contacts"),
                                         s("crm.opportunities")),
    "building_records": lambda s, p: s("crm.building_records").distinct(),
    "chatter_posts": lambda s, p: extracts.chatter_posts(s("crm.feed"), s("crm.opportunities"), s("crm.record_types"),
                                                         p.deal_rules.record_types),
    "internal_ips": lambda s, p: s("web.internal_ips"),
    "page_views": lambda s, p: s("web.pages"),
    "ad_clicks": lambda s, p: s("web.ad_clicks"),
    "tracked_forms": lambda s, p: union_distinct([s("web.forms_viewed"), s("web.forms_submitted")]),
    "synced_deals": lambda s, p: crm_marts.synced_deals(s("mkt.imported_deal")),
    "report_weeks": lambda s, p: days_per_week(date_spine(s.spark.range(1), *map(F.lit, p.report_dates()))),
}
#: Lookups that are no extracts of their own, but that marts read.
DIMENSIONS = ("dim.ip_org", "dim.locations")


def _sales_contacts(t: Source, p: JobParams) -> DataFrame:
    tours = t("tours_and_calls")
    return contact_marts.contact_mart(
        t("contacts"), t("companies"), contact_marts.scheduled_by_email(tours, "Call"),
        contact_marts.scheduled_by_email(tours, "Tour"), contact_marts.emails_by_contact(t("email_log")),
        contact_marts.calls_by_contact(t("phone_call_log"), p.contact_rules), p.contact_rules, p.as_of)


def _summary(t: Source, p: JobParams) -> DataFrame:
    return activity_marts.activity_summary(
        activity_marts.task_durations(t("rep_tasks")), t("review_history"),
        activity_marts.recode_engagements(t("rep_engagements"), p.disposition_labels), t("contact_mart"), t("dim.locations"))


#: Marts in dependency order; ``t`` gives a written extract or mart.
MARTS: dict[str, Callable[[Source, JobParams], DataFrame]] = {
    "attributed_pageviews": lambda t, p: web_marts.attributed_pageviews(
        t.spark, t("page_views"), t("internal_ips"), t("dim.ip_org"), parse_agents(t("page_views")), t("ad_clicks"),
        p.web_rules),
    "daily_visitors": lambda t, p: web_marts.daily_visitors(t("attributed_pageviews"), p.web_rules),
    "form_conversions": lambda t, p: web_marts.form_conversions(t("daily_visitors"), t("tracked_forms")),
    "marketing_spend_allocated": lambda t, p: spend.allocate_spend(t("marketing_spend"), p.spend_rules),
    "deal_stage_history": lambda t, p: crm_marts.deal_stage_history(
        t("marketing_deal_history"), t("synced_deals"), t("crm_deal_history"), p.deal_rules),
    "deal_mart": lambda t, p: crm_marts.deal_mart(
        t("crm_opportunities"), t("deal_stage_history"), crm_marts.deal_amounts(t("deals_with_owner"), t("synced_deals")),
        crm_marts.broker_deals(t("opportunity_roles")), crm_marts.deal_contacts(t("opportunity_roles")), p.deal_rules),
    "geo_hierarchy": lambda t, p: activity_marts.geo_hierarchy(t("building_records")),
    "contact_mart": _sales_contacts,
    "activity_summary": _summary,
    "activity_detail": lambda t, p: activity_marts.activity_detail(
        activity_marts.recode_engagements(t("rep_engagements"), p.disposition_labels), t("contact_mart"),
        t("dim.locations")),
}
PARTITIONED = {"attributed_pageviews": ["seg_date"]}
#: Columns that must not repeat in a written table.
KEYS = {"daily_visitors": ["dau_date", "anonymous_id", "landing_content"], "report_weeks": ["report_week"]}
#: Extracts that run only if the parameter of this name is set.
GATES = {"access_events": "include_access_events"}


class Written:
    """Tables that the run has written, read from storage; dimensions come from the sources."""

    def __init__(self, spark: SparkSession, source: Source, folder: str, entries: dict[str, TableEntry]):
        self.spark, self.source, self.folder, self.entries = spark, source, folder, entries

    def __call__(self, name: str) -> DataFrame:
        if name in DIMENSIONS:
            return self.source(name)
        entry = self.entries[name]
        return self.spark.read.schema(StructType.fromJson(json.loads(entry.schema))).parquet(
            f"{self.folder}/{entry.folder}/{name}")


def write_extracts(spark: SparkSession, source: Source, out: str, run_id: str, params: JobParams) -> dict[str, TableEntry]:
    """Write all extracts of a run; those that are gated off or missing come from an earlier run."""
    written, earlier = {}, published(spark, out)
    for name, build in EXTRACTS.items():
        df, origin, reason = None, run_id, None
        if name in GATES and not getattr(params, GATES[name]):
            reason = f"{GATES[name]} is off"
        else:
            try:
                df = build(source, params)
            except SourceMissing as missing:
                reason = missing
        if df is None:
            old = newest_with(spark, out, name, earlier)
            if old is None and isinstance(reason, SourceMissing):
                raise reason
            if old is None:
                log.warning("extract %s: %s and no complete run has it; left out", name, reason)
                continue
            df, origin = old[0], old[1].origin
            log.warning("extract %s: %s; carried over from run %s", name, reason, origin)
        written[name] = write_table(df, out, run_id, "raw", name, origin, keys=KEYS.get(name, ()))
    return written


def write_marts(spark: SparkSession, source: Source, out: str, run_id: str, params: JobParams,
                raw: dict[str, TableEntry]) -> dict[str, TableEntry]:
    """Write all marts of a run from its written tables."""
    entries = dict(raw)
    tables = Written(spark, source, f"{out}/{run_id}", entries)
    for name, build in MARTS.items():
        entries[name] = write_table(build(tables, params), out, run_id, "marts", name,
                                    partition_by=PARTITIONED.get(name, ()), keys=KEYS.get(name, ()))
    return {name: entries[name] for name in MARTS}


def run(spark: SparkSession, source: Source, out: str, params: JobParams, run_id: str | None = None) -> dict[str, TableEntry]:
    """One run in a new folder below ``out``, published when all of it is written and checked."""
    run_id = run_id or dt.datetime.now(dt.timezone.utc).strftime("run-%Y%m%dT%H%M%S")
    raw = write_extracts(spark, source, out, run_id, params)
    entries = raw | write_marts(spark, source, out, run_id, params, raw)
    publish(spark, out, run_id, params.as_of, list(entries.values()))
    return entries


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--sf-dir", help="driver tables")
    ap.add_argument("--catalog", help='JSON file: {"sources": {name: place}, "params": {...}}')
    ap.add_argument("--out", required=True, help="shared output folder")
    ap.add_argument("--master")
    args = ap.parse_args(argv)
    if bool(args.sf_dir) == bool(args.catalog):
        ap.error("give either --sf-dir or --catalog")
    if args.master:
        from martforge.session import get_session
        spark = get_session(master=args.master)
    else:
        spark = SparkSession.builder.getOrCreate()
    if args.catalog:
        text = "".join(r[0] + "\n" for r in spark.read.text(args.catalog).toLocalIterator())
        given = json.loads(text)
        source, params = TableCatalog(spark, given["sources"]), params_from(given["params"])
    else:
        source, params = AdapterCatalog(spark, args.sf_dir), adapter_params()
    for name, entry in run(spark, source, args.out, params).items():
        print(f"{name}\t{entry.rows} rows, computed by {entry.origin}")


if __name__ == "__main__":
    main()
