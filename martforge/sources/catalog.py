"""Where a job's source tables come from.

``TableCatalog`` reads a dictionary of source name -> place: a Parquet path, a JDBC table, or SQL text with
named arguments.  Column names are normalised when read, so marts can rely on lower-case names.
``AdapterCatalog`` gives the same names from the driver tables.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from martforge.sources import (ad_adapters, adapters, crm_adapters, extract_adapters, opportunity_adapters,
                               workspace_adapters)
from martforge.sources.io import read_jdbc

#: Error classes that mean "the source is not there"; anything else is a bug or an outage and is raised.
MISSING = ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


class SourceMissing(LookupError):
    """A source table does not exist."""


def normalised(df: DataFrame) -> DataFrame:
    """Columns in lower case, with anything but letters, digits and underscores as underscores."""
    names = [re.sub(r"\W+", "_", c.strip()).lower() for c in df.columns]
    doubles = {n for n in names if names.count(n) > 1}
    if doubles:
        raise ValueError(f"columns that differ in case or marks only: {sorted(doubles)}")
    return df.toDF(*names)


class TableCatalog:
    """Sources by name: ``{"parquet": path}``, ``{"jdbc": {url, table, partition_column, ...}}`` or
    ``{"sql": text, "args": {...}}``."""

    def __init__(self, spark: SparkSession, places: dict[str, dict]):
        self.spark, self.places = spark, places

    def __call__(self, name: str) -> DataFrame:
        if name not in self.places:
            raise SourceMissing(name)
        place = self.places[name]
        try:
            if "parquet" in place:
                return normalised(self.spark.read.parquet(place["parquet"]))
            if "sql" in place:
                return normalised(self.spark.sql(place["sql"], args=place.get("args") or {}))
            return normalised(read_jdbc(self.spark, **place["jdbc"]))
        except AnalysisException as e:
            if (e.getCondition() or "").split(".")[0] in MISSING:
                raise SourceMissing(name) from e
            raise


class AdapterCatalog:
    """The sources derived from the driver tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __call__(self, name: str) -> DataFrame:
        if name not in ADAPTERS:
            raise SourceMissing(name)
        return ADAPTERS[name](self.spark, self.sf_dir)


_M, _X, _O, _W, _A = crm_adapters, extract_adapters, opportunity_adapters, workspace_adapters, ad_adapters
ADAPTERS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "mkt.contact_list_member": _M.contact_list_member, "mkt.contact": _M.contact, "mkt.company": _M.company,
    "mkt.contact_history": _X.contact_history, "mkt.contact_property_history": _M.contact_property_history,
    "mkt.deal": _X.crm_deals, "mkt.owner": _X.crm_owners, "mkt.deal_property_history": _M.deal_property_history,
    "mkt.deal_pipeline_history": _X.deal_pipeline_history, "mkt.pipeline_stage_labels": _M.deal_pipeline_stages,
    "mkt.pipeline_stage": _X.pipeline_stage_table, "mkt.pipeline": _X.pipelines, "mkt.deal_contact": _O.deal_contact,
    "mkt.deal_company": _O.deal_company, "mkt.engagement": _M.engagement, "mkt.engagement_contact": _M.engagement_contact,
    "mkt.engagement_call": _M.engagement_call, "mkt.engagement_email": _M.engagement_email,
    "mkt.engagement_meeting": _M.engagement_meeting, "mkt.engagement_task": _M.engagement_task,
    "mkt.deal_deletion": _X.deal_deletions, "mkt.deal_deletion_before_webhook": _X.deal_deletions_before_webhook,
    "mkt.imported_deal": _M.imported_deals, "web.hits": _X.session_hits, "web.pages": adapters.tracking_pages,
    "web.internal_ips": adapters.internal_ips, "web.ad_clicks": adapters.click_performance,
    "web.forms_viewed": lambda s, d: adapters.lead_forms(s, d, "viewed"),
    "web.forms_submitted": lambda s, d: adapters.lead_forms(s, d, "submitted"),
    "ads.linkedin_analytics": _A.linkedin_analytics, "ads.linkedin_campaigns": _A.linkedin_campaigns,
    "ads.linkedin_groups": _A.linkedin_groups, "ads.bing_report": _A.bing_report, "ads.bing_campaigns": _A.bing_campaigns,
    "ads.facebook_ads": _A.facebook_ads, "ads.facebook_actions": _A.facebook_actions,
    "ads.search_main": lambda s, d: _A.search_hourly(s, d, "main"),
    "ads.search_uk": lambda s, d: _A.search_hourly(s, d, "uk"),
    "ws.bookings": _W.bookings, "ws.resources": _W.resource, "ws.businesses": _W.business, "ws.coworkers": _W.coworker,
    "ws.teams": _W.team, "ws.extra_services": _W.extra_services, "ws.members": _W.member_directory,
    "ws.contracts": _W.contracts, "ws.invoices": _W.invoices, "ws.tariffs": _W.tariffs, "ws.desk_offices": _W.desk_offices,
    "access.events": _X.access_events, "access.links": _X.access_links, "access.people": _X.people,
    "access.addresses": _X.addresses, "crm.opportunities": _O.opportunities, "crm.record_types": _O.record_types,
    "crm.accounts": _O.accounts, "crm.landlord_companies": _O.landlord_companies,
    "crm.account_contacts": _O.account_contacts, "crm.contacts": _O.contacts, "crm.users": _O.users,
    "crm.user_roles": _O.user_roles, "crm.buildings": _O.buildings, "crm.building_records": _M.buildings,
    "crm.contact_roles": _O.opportunity_contact_roles, "crm.opportunity_history": _M.opportunity_history,
    "crm.leads": _X.leads, "crm.lead_record_types": _X.lead_record_types, "crm.activity_users": _X.crm_users,
    "crm.tasks": _X.crm_tasks, "crm.calendar_events": _X.crm_calendar_events, "crm.awareness_tours": _X.awareness_tours,
    "crm.events": _X.crm_events, "crm.feed": _X.opportunity_feed, "dim.locations": _M.location_map,
    "dim.ip_org": adapters.ip_org,
}
