"""Sales-CRM extracts that the deal mart is built on: the wide opportunity list and
the contacts' roles in opportunities; and the small link extracts of the marketing CRM.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.operators.setops import union_distinct

#: Columns of the opportunity itself that the extract passes on.
OPPORTUNITY_COLUMNS = (
    "stage_name", "created_date", "name", "enterprise_notes_c", "additional_notes_text_c", "opportunity_type_c",
    "fill_product_c", "desks_max_c", "desks_min_c", "term_length_max_c", "term_length_min_c", "term_length_period_c",
    "price_range_min_c", "price_range_max_c", "budget_min_c", "budget_max_c", "total_deal_amount_c",
    "enterprise_portfolio_c", "executive_spotlight_c", "executive_summary_c", "closed_lost_reasons_c",
    "local_fill_closed_lost_reasons_c", "lead_source", "data_source_1_c", "data_source_2_c", "data_source_3_c",
    "digital_tracking_code_c")
#: Parts of the closed-lost reason, in order; NULL parts are left out.
LOST_REASON_PARTS = ("negotiation_deal_terms_c", "lead_quality_c", "client_interest_c", "product_alignment_c")


def first_contact_dates(relationships: DataFrame, contacts: DataFrame) -> DataFrame:
    """Earliest creation of a contact still related to each account."""
    r = relationships.where(F.col("is_deleted") == F.lit(False)).select("account_id", "contact_id")
    c = contacts.select(F.col("id").alias("c_id"), F.col("created_date").alias("c_created"))
    return (r.join(c, r["contact_id"] == c["c_id"])
            .groupBy("account_id").agg(F.min("c_created").alias("first_contact_create")))


def consolidated_accounts(accounts: DataFrame, landlords: DataFrame) -> DataFrame:
    """Accounts and landlord companies, UNION (equal rows once)."""
    return union_distinct([t.select("id", "name", "created_date") for t in (accounts, landlords)])


def crm_opportunities(opportunities: DataFrame, record_types: DataFrame, accounts: DataFrame, landlords: DataFrame,
                      relationships: DataFrame, contacts: DataFrame, users: DataFrame, roles: DataFrame,
                      buildings: DataFrame, excluded_type: str) -> DataFrame:
    """One row per open-or-closed opportunity (not deleted, not of ``excluded_type``).

    Owner, creator, the owner's role and the record type must exist (inner joins); account, first
    contact and building may be missing.  An id among both accounts and landlords with different
    attributes yields a row each, as in the source.
    """
    o = opportunities.where(F.col("is_deleted") == F.lit(False))
    rt = record_types.where((F.col("sobject_type") == "Opportunity") & (F.col("name") != excluded_type)).select(
        F.col("id").alias("rt_id"), F.col("name").alias("rt_name"))
    a = consolidated_accounts(accounts, landlords).select(
        F.col("id").alias("a_id"), F.col("name").alias("customer_name"), F.col("created_date").alias("customer_create_date"))
    first = first_contact_dates(relationships, contacts).withColumnRenamed("account_id", "f_id")
    owner = users.select(F.col("id").alias("u_id"), F.col("name").alias("owner_name"), "username", "user_role_id")
    role = roles.select(F.col("id").alias("r_id"), F.col("name").alias("sales_role"))
    creator = users.select(F.col("id").alias("u2_id"), F.col("name").alias("creator"))
    b = buildings.select(F.col("id").alias("b_id"), F.col("name").alias("location_name"),
                         F.col("building_name_c").alias("location_id"), "city_c", "sub_region_c", "region_c")
    j = (o.join(rt, o["record_type_id"] == rt["rt_id"])
         .join(owner, o["owner_id"] == owner["u_id"]).join(role, owner["user_role_id"] == role["r_id"])
         .join(creator, o["created_by_id"] == creator["u2_id"])
         .join(b, o["building_fill_c"] == b["b_id"], "left")
         .join(a, o["account_id"] == a["a_id"], "left")
         .join(first, o["account_id"] == first["f_id"], "left"))
    return j.select(
        o["id"], F.col("rt_name").alias("oppty_type"), "location_name", "location_id", "city_c", "sub_region_c",
        "region_c", "customer_name", "customer_create_date", "first_contact_create",
        F.to_date("date_needed_lease_expiration_c").alias("anticipated_start_date"),
        F.col("close_date").alias("anticipated_close_date"), *OPPORTUNITY_COLUMNS,
        F.concat_ws(";", *LOST_REASON_PARTS).alias("closed_lost_reason"),
        "owner_name", "username", "sales_role", "creator", F.col("rt_name").alias("record_type"))


def opportunity_roles(contact_roles: DataFrame, opportunities: DataFrame, record_types: DataFrame, contacts: DataFrame,
                      landlords: DataFrame, excluded_type: str) -> DataFrame:
    """Contacts in their opportunity roles, with the landlord company they belong to (if any)."""
    o = opportunities.select(F.col("id").alias("o_id"), F.col("record_type_id").alias("o_rt"))
    rt = record_types.where(F.col("name") != excluded_type).select(F.col("id").alias("rt_id"))
    c = contacts.select(F.col("id").alias("c_id"), "name", F.col("account_id").alias("c_account"))
    lc = landlords.select(F.col("id").alias("lc_id"), F.col("name").alias("account"))
    return (contact_roles.join(o, contact_roles["opportunity_id"] == o["o_id"]).join(rt, o["o_rt"] == rt["rt_id"])
            .join(c, contact_roles["contact_id"] == c["c_id"]).join(lc, c["c_account"] == lc["lc_id"], "left")
            .select("name", "account", "role", "contact_id", "opportunity_id"))


def link_table(links: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A link table reduced to its keys (deal-contact, deal-company)."""
    return links.select(*columns)


# ---------------------------------------------------------------- adapted runs on the driver tables

def crm_opportunities_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from martforge.sources import opportunity_adapters as A
    return crm_opportunities(
        A.opportunities(spark, sf_dir), A.record_types(spark, sf_dir), A.accounts(spark, sf_dir),
        A.landlord_companies(spark, sf_dir), A.account_contacts(spark, sf_dir), A.contacts(spark, sf_dir),
        A.users(spark, sf_dir), A.user_roles(spark, sf_dir), A.buildings(spark, sf_dir), A.EXCLUDED_TYPE)


def opportunity_roles_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from martforge.sources import opportunity_adapters as A
    return opportunity_roles(A.opportunity_contact_roles(spark, sf_dir), A.opportunities(spark, sf_dir),
                             A.record_types(spark, sf_dir), A.contacts(spark, sf_dir),
                             A.landlord_companies(spark, sf_dir), A.EXCLUDED_TYPE)


def deal_contact_links_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from martforge.sources import opportunity_adapters as A
    return link_table(A.deal_contact(spark, sf_dir), ["deal_id", "contact_id"])


def deal_company_links_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from martforge.sources import opportunity_adapters as A
    return link_table(A.deal_company(spark, sf_dir), ["deal_id", "company_id"])


def companies_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole company table (the source selects every column)."""
    from martforge.sources import crm_adapters as A
    return A.company(spark, sf_dir)
