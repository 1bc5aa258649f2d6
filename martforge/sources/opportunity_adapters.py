"""Input tables of the opportunity extracts, derived from customer, orders, nation and region.

A customer is an opportunity's account (or a landlord company, or both); its orders are the
contacts related to it.  Some rows are deleted, of the excluded record type, or lack
an owner's role, so every join condition of the extracts decides something.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.sources.crm_adapters import _customers, _map, record_types as _record_types
from martforge.sources.io import read_table

EXCLUDED_TYPE = "Find"


def _id(prefix: str, col) -> F.Column:
    return F.concat(F.lit(prefix), col.cast("string"))


def _spans(spark, sf_dir) -> DataFrame:
    o = read_table(spark, sf_dir, "orders", ["o_custkey", "o_orderdate"])
    return o.groupBy("o_custkey").agg(F.min("o_orderdate").alias("first_order"), F.max("o_orderdate").alias("last_order"))


def _spanned(spark, sf_dir) -> DataFrame:
    c, s = _customers(spark, sf_dir), _spans(spark, sf_dir)
    return c.join(s, c["c_custkey"] == s["o_custkey"], "left")


def record_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _record_types(spark, sf_dir)
    extra = read_table(spark, sf_dir, "region", ["r_regionkey"]).where("r_regionkey = 0").select(
        F.lit("RT_FIND").alias("id"), F.lit(EXCLUDED_TYPE).alias("name"), F.lit("Opportunity").alias("sobject_type"))
    return base.unionByName(extra)


def opportunities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One live opportunity per customer; deleted and excluded ones beside some."""
    c = _spanned(spark, sf_dir)
    k, bal, nat, seg = F.col("c_custkey"), F.col("c_acctbal"), F.col("c_nationkey"), F.col("c_mktsegment")
    none = F.lit(None).cast("string")
    live = c.select(
        _id("OPP", k).alias("id"), F.concat(F.lit("RT_"), seg).alias("record_type_id"), _id("ACC", k).alias("account_id"),
        F.col("c_name").alias("name"), F.lit(False).alias("is_deleted"),
        _id("U", F.pmod(k, F.lit(10))).alias("owner_id"), _id("U", F.pmod(k + 1, F.lit(10))).alias("created_by_id"),
        _id("B", nat).alias("building_fill_c"), F.col("first_order").alias("created_date"),
        F.to_date("last_order").alias("close_date"), F.col("last_order").alias("date_needed_lease_expiration_c"),
        _map("c_mktsegment", {"BUILDING": "Closed Won", "AUTOMOBILE": "Touring"}, "Upper Funnel").alias("stage_name"),
        F.when(nat < 5, F.lit("NAtional account")).alias("enterprise_notes_c"),
        F.concat(F.lit("note "), F.col("c_name")).alias("additional_notes_text_c"), seg.alias("opportunity_type_c"),
        F.when(bal > 8000, F.lit("Room")).alias("fill_product_c"), nat.cast("double").alias("desks_max_c"),
        (nat / F.lit(2.0)).alias("desks_min_c"), F.lit(12.0).alias("term_length_max_c"),
        F.lit(6.0).alias("term_length_min_c"), F.lit("months").alias("term_length_period_c"),
        F.when(bal > 5000, bal).alias("price_range_min_c"), F.lit(None).cast("double").alias("price_range_max_c"),
        F.when((bal >= 0) & (bal <= 5000), bal / F.lit(2.0)).alias("budget_min_c"),
        F.lit(None).cast("double").alias("budget_max_c"), bal.alias("total_deal_amount_c"),
        none.alias("enterprise_portfolio_c"), none.alias("executive_spotlight_c"),
        F.when(bal > 0, F.concat(F.lit("summary "), seg)).alias("executive_summary_c"),
        none.alias("closed_lost_reasons_c"),
        F.when(seg == "AUTOMOBILE", F.lit("price")).alias("negotiation_deal_terms_c"),
        F.when(bal < 0, F.lit("low quality")).alias("lead_quality_c"), none.alias("client_interest_c"),
        F.when(nat == 3, F.lit("wrong product")).alias("product_alignment_c"),
        F.when(bal < 0, F.lit("local")).alias("local_fill_closed_lost_reasons_c"),
        F.when(F.pmod(nat, F.lit(5)) == 0, F.lit("Online")).when(F.pmod(nat, F.lit(5)) == 1, F.lit("Offline"))
        .when(F.pmod(nat, F.lit(5)) == 3, F.lit("Enterprise Referral"))
        .when(F.pmod(nat, F.lit(5)) == 4, F.lit("Broker Referral")).alias("lead_source"),
        F.element_at(F.array(*[F.lit(x) for x in ("DIRECT_TRAFFIC", "ORGANIC_SEARCH", "PAID_SEARCH", "PAID_SOCIAL",
                                                   "3rd Party Aggregator", None)]),
                     F.pmod(k, F.lit(6)).cast("int") + 1).alias("data_source_1_c"),
        F.element_at(F.array(*[F.lit(x) for x in ("https://own.example/", "Blog post", "own.example/page",
                                                   "meetings.example", "Facebook ads", "LinkedIn", "auto-tagged")]),
                     F.pmod(k, F.lit(7)).cast("int") + 1).alias("data_source_2_c"),
        F.when(bal < 0, F.lit("lead-gen form")).alias("data_source_3_c"),
        F.when(nat > 20, _id("TC", nat)).alias("digital_tracking_code_c"))
    deleted = live.where(F.col("total_deal_amount_c") < -500).withColumns(
        {"id": F.concat(F.lit("DEL"), F.col("id")), "is_deleted": F.lit(True)})
    found = live.where(F.col("total_deal_amount_c") > 9500).withColumns(
        {"id": F.concat(F.lit("FIND"), F.col("id")), "record_type_id": F.lit("RT_FIND")})
    roleless = live.where(F.col("total_deal_amount_c").between(9000, 9500)).withColumns(
        {"id": F.concat(F.lit("NOROLE"), F.col("id")), "owner_id": F.lit("UX")})
    return live.unionByName(deleted).unionByName(found).unionByName(roleless)


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two customers in three are accounts."""
    c = _spanned(spark, sf_dir).where(F.pmod("c_custkey", F.lit(3)) != 0)
    return c.select(_id("ACC", F.col("c_custkey")).alias("id"), F.col("c_name").alias("name"),
                    F.col("last_order").alias("created_date"))


def landlord_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The other customers, some accounts again (equal rows, UNION keeps one), and the contacts' companies."""
    c = _spanned(spark, sf_dir).where((F.pmod("c_custkey", F.lit(3)) == 0) | (F.pmod("c_custkey", F.lit(10)) == 1))
    own = c.select(_id("ACC", F.col("c_custkey")).alias("id"), F.col("c_name").alias("name"),
                   F.col("last_order").alias("created_date"))
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_orderstatus"]).where(F.col("o_orderstatus").isin("F", "O"))
    firm = o.select(_company_of_order().alias("id"),
                    F.when(F.col("o_orderstatus") == "F", F.lit("Unknown"))
                    .otherwise(_id("Acct ", F.pmod("o_orderkey", F.lit(5)))).alias("name"),
                    F.lit(None).cast(own.schema["created_date"].dataType).alias("created_date")).distinct()
    return own.unionByName(firm)


def _company_of_order() -> F.Column:
    return (F.when(F.col("o_orderstatus") == "F", F.lit("LCU"))
            .when(F.col("o_orderstatus") == "O", _id("LC", F.pmod("o_orderkey", F.lit(5)))))


def contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_orderstatus", "o_orderdate"])
    return o.select(_id("C", F.col("o_orderkey")).alias("id"),
                    _id("Contact ", F.pmod("o_orderkey", F.lit(3))).alias("name"),
                    F.col("o_orderdate").alias("created_date"), _company_of_order().alias("account_id"))


def account_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey"])
    return o.select(_id("ACC", F.col("o_custkey")).alias("account_id"), _id("C", F.col("o_orderkey")).alias("contact_id"),
                    (F.pmod("o_orderkey", F.lit(11)) == 0).alias("is_deleted"))


def opportunity_contact_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An order's contact in the customer's opportunity; also in an excluded one, which the extract leaves out."""
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderpriority"])
    role = F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("Broker Contact")).otherwise(F.lit("Decision Maker"))
    base = o.select(_id("C", F.col("o_orderkey")).alias("contact_id"), role.alias("role"),
                    _id("OPP", F.col("o_custkey")).alias("opportunity_id"))
    return base.unionByName(base.where(F.col("role") == "Broker Contact").withColumn(
        "opportunity_id", F.concat(F.lit("FIND"), F.col("opportunity_id"))))


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten users, and one whose role does not exist."""
    n = read_table(spark, sf_dir, "nation", ["n_nationkey"])
    slot = F.pmod("n_nationkey", F.lit(10))
    base = n.select(_id("U", slot).alias("id"), _id("owner ", slot).alias("name"),
                    F.concat(F.lit("user"), slot.cast("string"), F.lit("@crm.example")).alias("username"),
                    _id("R", F.pmod(slot, F.lit(3))).alias("user_role_id")).distinct()
    return base.unionByName(base.where(F.col("id") == "U0").select(
        F.lit("UX").alias("id"), F.lit("owner x").alias("name"), F.lit("ux").alias("username"),
        F.lit("RX").alias("user_role_id")))


def user_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read_table(spark, sf_dir, "nation", ["n_nationkey"]).where("n_nationkey < 3")
    return n.select(_id("R", F.col("n_nationkey")).alias("id"), _id("role ", F.col("n_nationkey")).alias("name"))


def buildings(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    r = read_table(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    return n.join(r, n["n_regionkey"] == r["r_regionkey"]).select(
        _id("B", F.col("n_nationkey")).alias("id"), F.col("n_name").alias("name"),
        _id("LOC", F.col("n_nationkey")).alias("building_name_c"), F.col("n_name").alias("city_c"),
        F.concat(F.lit("sub "), F.col("r_name")).alias("sub_region_c"), F.col("r_name").alias("region_c"))


def deal_contact(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey"])
    return o.select((F.col("o_orderkey") + 100000).alias("deal_id"), F.col("o_custkey").alias("contact_id"),
                    F.lit("primary").alias("category"))


def deal_company(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey"])
    c = _customers(spark, sf_dir)
    return o.join(c, o["o_custkey"] == c["c_custkey"]).select(
        (F.col("o_orderkey") + 100000).alias("deal_id"), F.col("c_nationkey").cast("long").alias("company_id"))
