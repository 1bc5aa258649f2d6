"""CRM marts: deal stage history across two CRMs and the deal mart.

Extracts (source tables -> extract shape):
* ``marketing_deal_history``: stage-change log of the marketing CRM (property
  history joined to its pipeline stages with a constant in the ON clause),
* ``crm_deal_history``: stage history of the sales CRM for selected record types,
* ``synced_deals``: latest id map between the two CRMs (rank = 1, ties kept).

Transforms:
* ``deal_stage_history``: both histories unioned by name, change points per
  opportunity (``lag`` with default, NULL drops), stage roll-up ladder,
* ``deal_mart``: opportunities of one record type + close date from the
  latest history row (filtered *after* picking it) + mapped amounts + broker
  flag + distinct contact list + calendar columns + channel ladders.
Label patterns and host names are parameters (``DealRules``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.functions.dates import minute_trunc, month_start, quarter_start, week_start, weekday_mon1
from martforge.functions.nulls import eq_or_false, matches, paste
from martforge.functions.rules import ladder
from martforge.operators.aggregates import join_distinct
from martforge.operators.history import change_points, latest_version, top_row
from martforge.operators.joins import null_safe_join
from martforge.operators.setops import union_tagged
from martforge.plans.acquisition import acquisition_source

# Stage roll-up rules (detail -> main stage), in rule order.
STAGE_RENAMES = [("Cold/Dead", "Closed Lost"), ("Contract Negotiation", "Negotiation/Proposal"),
                 ("Tour Scheduled", "Touring")]
MAIN_STAGES = "(Qualified - Local Fill Opportunity|Touring|Negotiation/Proposal|Contract Sent|Closed Won|Closed Lost)"
TERMINAL_STAGES = ("Closed Lost", "Closed Won")


@dataclass(frozen=True)
class DealRules:
    pipeline_id: str = "default"
    record_types: tuple[str, ...] = ("Local Fill", "Broker-Led", "Enterprise")
    mart_record_type: str = "Local Fill"
    link_base: str = "https://crm.example/opportunity/"
    own_home: str = r"own\.example/$"
    own_site: str = r"own\.example"
    meeting_host: str = r"meetings\.example"
    aggregator: str = "3rd Party Aggregator"
    products: tuple[str, str] = ("Suite", "Desk")     # (multi-seat product, single-seat product)
    source_tags: tuple[str, str] = ("MKT", "SALES")   # (marketing CRM, sales CRM) in the stage history


# ---------------------------------------------------------------- extracts

def marketing_deal_history(property_history: DataFrame, pipeline_stages: DataFrame, rules: DealRules = DealRules()) -> DataFrame:
    stages = pipeline_stages.where(F.col("pipeline_id") == rules.pipeline_id)
    ph = property_history.where(F.col("name") == "deal_pipeline_stage_id")
    j = ph.join(stages, ph["value"] == stages["stage_id"])
    return j.select("deal_id", ph["name"], minute_trunc("timestamp").alias("date_created"),
                    F.col("label").alias("pipeline_stage"), "source_id", "source")


def crm_deal_history(history: DataFrame, opportunities: DataFrame, record_types: DataFrame,
                     rules: DealRules = DealRules()) -> DataFrame:
    rt = record_types.where((F.col("sobject_type") == "Opportunity") & F.col("name").isin(*rules.record_types))
    op = opportunities.select(F.col("id").alias("op_id"), "record_type_id")
    j = (history.where(F.col("is_deleted") == F.lit(False))
         .join(op, history["opportunity_id"] == op["op_id"])
         .join(rt.select(F.col("id").alias("rt_id")), F.col("record_type_id") == F.col("rt_id")))
    return j.select("opportunity_id", "created_date", "stage_name")


def synced_deals(imported: DataFrame) -> DataFrame:
    lv = latest_version(imported, ["salesforce_opportunity_id"], "_fivetran_synced")
    return lv.select("salesforce_opportunity_id", "hubspot_opportunity_id")


# ---------------------------------------------------------------- transforms

def stage_rollup(detail: str = "pipeline_stage_detail"):
    d = F.col(detail)
    return ladder([(d == a, b) for a, b in STAGE_RENAMES] + [((d, MAIN_STAGES, False), d)], default="Upper Funnel")


def deal_stage_history(hs_history: DataFrame, synced: DataFrame, crm_history: DataFrame,
                       rules: DealRules = DealRules()) -> DataFrame:
    hs = hs_history.join(synced, hs_history["deal_id"].eqNullSafe(synced["hubspot_opportunity_id"])).select(
        F.col("salesforce_opportunity_id").alias("opportunity_id"), F.col("date_created").alias("created_date"),
        F.col("pipeline_stage").alias("pipeline_stage_detail"))
    crm = crm_history.select("opportunity_id", "created_date", F.col("stage_name").alias("pipeline_stage_detail"))
    both = union_tagged(list(zip(rules.source_tags, (hs, crm))), "source")
    # order ties of the source are undefined: tiebreak by source, then detail
    cp = change_points(both, ["opportunity_id"], ["created_date", "source", "pipeline_stage_detail"],
                       "pipeline_stage_detail", default="1", chunk=minute_trunc("created_date"))
    return cp.select("opportunity_id", F.col("created_date").alias("stage_date"), "pipeline_stage_detail", "source",
                     stage_rollup().alias("pipeline_stage"))


def deal_amounts(hs_deals: DataFrame, synced: DataFrame) -> DataFrame:
    j = hs_deals.join(synced, hs_deals["deal_id"].eqNullSafe(synced["hubspot_opportunity_id"]))
    return j.select("salesforce_opportunity_id", F.col("property_amount").alias("hs_monthly_amount"),
                    F.col("property_closedate").alias("hs_close_date"))


def broker_deals(roles: DataFrame) -> DataFrame:
    return (roles.where(matches("role", "broker")).select("opportunity_id")
            .withColumn("broker_roles", F.lit(True)).distinct())


def deal_contacts(roles: DataFrame) -> DataFrame:
    r = roles.withColumn("deal_contact", F.coalesce(F.nullif(F.col("account"), F.lit("Unknown")), F.col("name")))
    return join_distinct(r, ["opportunity_id"], "deal_contact", "associated_contacts")


def _acquisition_source(rules: DealRules):
    ds1, ds2, ds3 = F.col("data_source_1_c"), F.col("data_source_2_c"), F.col("data_source_3_c")
    return acquisition_source(ds2, ds3, ds2, rules,
                              last_paid=[(eq_or_false(ds1, "PAID_SEARCH"), "Paid Search(Google*)")])


DEAL_COLUMNS = ["deal_id", "deal_name", "create_date", "create_week", "create_month", "create_quarter", "create_wday",
                "contact_create_date", "seats", "unit", "location_id", "city", "region", "pipeline_stage",
                "pipeline_stage_detail", "product", "monthly_amount", "total_deal_amount", "lease_term",
                "anticipated_start_date", "closed_lost_reason", "acquisition_channel", "acquisition_source",
                "digital_channel", "tracking_code", "customer_name", "associated_contacts", "owner_name", "notes",
                "deal_link", "close_date", "contact_create_week", "sales_channel"]


def deal_mart(opptys: DataFrame, history: DataFrame, amounts: DataFrame, brokers: DataFrame, contacts: DataFrame,
              rules: DealRules = DealRules()) -> DataFrame:
    last = top_row(history, ["opportunity_id"], [F.col("stage_date").desc(), F.col("pipeline_stage").desc()])
    closed = last.where(F.col("pipeline_stage").isin(*TERMINAL_STAGES)).select(
        F.col("opportunity_id").alias("id"), F.col("stage_date").alias("close_date"))
    df = opptys.where(F.col("record_type") == rules.mart_record_type)
    df = null_safe_join(df, closed, ["id"], "left")
    df = null_safe_join(df, amounts, [("id", "salesforce_opportunity_id")], "left")
    df = null_safe_join(df, brokers, [("id", "opportunity_id")], "left")
    df = null_safe_join(df, contacts, [("id", "opportunity_id")], "left")
    multi, single = rules.products
    df = df.withColumns({
        "create_date": F.to_date("created_date"),
        "create_week": week_start("created_date"),
        "create_month": month_start("created_date"),
        "create_quarter": quarter_start("created_date"),
        "create_wday": weekday_mon1("created_date"),
        "contact_create_date": F.to_date("customer_create_date"),
        "product": ladder([(F.col("fill_product_c").isNotNull(), F.col("fill_product_c")),
                           (("oppty_type", "enterprise|broker"), multi),
                           (F.col("desks_max_c") > 1, multi)], default=single),
        "deal_link": paste(f"<a href='{rules.link_base}", F.col("id"), "/view 'target='_blank'>", F.col("name"),
                           "</a>"),
        "lead_source": F.coalesce(F.col("lead_source"), F.col("oppty_type")),
        "close_date": F.to_date(F.coalesce(F.col("close_date"), F.col("anticipated_close_date"))),
        "monthly_amount": F.coalesce("price_range_min_c", "budget_min_c", "price_range_max_c", "budget_max_c",
                                     "hs_monthly_amount"),
        "notes": F.concat(F.coalesce(F.col("executive_summary_c"), F.lit("")), F.lit("<br>"),
                          F.coalesce(F.col("enterprise_notes_c"), F.lit(""))),
    })
    ls, ds1 = F.col("lead_source"), F.col("data_source_1_c")
    online = eq_or_false(ls, "Online")
    df = df.withColumns({
        "contact_create_week": week_start("contact_create_date"),
        "acquisition_channel": ladder([((ls, "enterprise"), "Enterprise"), ((ls, "broker"), "Broker"),
                                       (online, "Marketing"), (ls == rules.mart_record_type, "Local Sales"),
                                       (ds1 == rules.aggregator, "Marketing")], default="Local Sales"),
        "digital_channel": ladder([(online & (ds1 == "DIRECT_TRAFFIC"), "Direct"),
                                   (online & (ds1 == "ORGANIC_SEARCH"), "Organic"),
                                   (online & ds1.isin("PAID_SEARCH", "PAID_SOCIAL"), "Paid"),
                                   ((ls == "Offline") & (ds1 == rules.aggregator), "Aggregator")]),
        "sales_channel": ladder([(eq_or_false(F.col("broker_roles"), True), "Broker"),
                                 (F.col("oppty_type") == "Broker-Led", "Broker"),
                                 (("oppty_type", "broker"), "Broker"), (("oppty_type", "enterprise"), "Enterprise"),
                                 (("oppty_type", "local"), "Local")], default="Unspecified"),
    })
    df = df.withColumn("acquisition_source", _acquisition_source(rules))
    return df.select(
        F.col("id").alias("deal_id"), F.col("name").alias("deal_name"), "create_date", "create_week", "create_month",
        "create_quarter", "create_wday", "contact_create_date", F.col("desks_max_c").alias("seats"),
        F.col("location_name").alias("unit"), "location_id", F.col("city_c").alias("city"),
        F.col("region_c").alias("region"), F.col("stage_name").alias("pipeline_stage"),
        F.col("stage_name").alias("pipeline_stage_detail"), "product", "monthly_amount",
        F.col("total_deal_amount_c").alias("total_deal_amount"), F.col("term_length_max_c").alias("lease_term"),
        "anticipated_start_date", "closed_lost_reason", "acquisition_channel", "acquisition_source",
        "digital_channel", F.col("digital_tracking_code_c").alias("tracking_code"), "customer_name",
        "associated_contacts", "owner_name", "notes", "deal_link", "close_date", "contact_create_week",
        "sales_channel")


# ---------------------------------------------------------------- adapted runs on the driver tables

def deal_stage_history_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from martforge.sources import crm_adapters as A
    hs = marketing_deal_history(A.deal_property_history(spark, sf_dir), A.deal_pipeline_stages(spark, sf_dir))
    crm = crm_deal_history(A.opportunity_history(spark, sf_dir), A.opportunities(spark, sf_dir),
                           A.record_types(spark, sf_dir))
    return deal_stage_history(hs, synced_deals(A.imported_deals(spark, sf_dir)), crm)


def deal_mart_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from martforge.plans.crm_extracts import crm_opportunities_q, opportunity_roles_q
    from martforge.sources import crm_adapters as A
    synced = synced_deals(A.imported_deals(spark, sf_dir))
    roles = opportunity_roles_q(spark, sf_dir)
    return deal_mart(crm_opportunities_q(spark, sf_dir), deal_stage_history_q(spark, sf_dir),
                     deal_amounts(A.marketing_deals(spark, sf_dir), synced), broker_deals(roles), deal_contacts(roles))
