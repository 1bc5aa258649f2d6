"""Workspace-operations extracts over versioned landing tables.

* ``meeting_bookings``: latest booking versions (DISTINCT after the window)
  joined to members, booking costs (extras summed per (booking, member) but
  joined on the booking only: a fan-out the source keeps), member type,
  rooms (latest resource x latest site) and teams per member,
* ``contracts``: latest contract x latest member x invoice totals per
  contract (latest invoices with a non-empty contract id) x latest plan x
  latest team,
* ``teams``: latest team x latest site,
* ``spaces``: desk / office records that are not deleted.

Every "latest" is ``latest_version``: rank 1 by version time, NULL first,
ties kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.operators.aggregates import cond_sums
from martforge.operators.history import latest_version

MONEY = "decimal(18,6)"

BOOKING_COLUMNS = ["id", "coworkerid", "coworkerfullname", "resourceid", "resourcename", "resourceresourcetypename",
                   "teamsatthetimeofbooking", "tariffatthetimeofbooking", "fromtime", "totime",
                   "coworkerextraserviceprice", "createdon", "updatedon", "is_deleted"]


def _rank1_pos(df: DataFrame, keys, order: str) -> DataFrame:
    """Latest version with its rank column kept (always 1), as ``SELECT *, rank() ... WHERE pos = 1``."""
    return latest_version(df, keys, order).withColumn("pos", F.lit(1))


def member_teams(coworkers: DataFrame, teams: DataFrame) -> DataFrame:
    """Teams per member: every member version x team version, rank by team time per
    (member, team), DISTINCT (member, team name) after the window."""
    t = teams.where(F.col("name").isNotNull()).select(F.col("id").alias("t_id"), F.col("name").alias("team_name"),
                                                      F.col("updatedon").alias("t_updatedon"))
    j = coworkers.select(F.col("id").alias("coworker_id"), "teamid").join(t, F.col("teamid") == F.col("t_id"))
    lv = latest_version(j, ["coworker_id", "t_id"], "t_updatedon")
    return lv.select("coworker_id", "team_name").distinct()


def meeting_bookings(bookings: DataFrame, resources: DataFrame, businesses: DataFrame, coworkers: DataFrame,
                     teams: DataFrame, extras: DataFrame, members: DataFrame) -> DataFrame:
    valid = _rank1_pos(bookings.select(*BOOKING_COLUMNS), ["id"], "updatedon").withColumnRenamed(
        "id", "booking_id").distinct()
    res = latest_version(resources, ["id"], "updatedon")
    biz = latest_version(businesses, ["id"], "updatedon")
    rooms = (biz.select(F.col("id").alias("business_id"), F.col("name").alias("location"))
             .join(res.select(F.col("id").alias("resource_id"), F.col("name").alias("room_name"),
                              F.col("resourcetypename").alias("room_size"), "businessid"),
                   F.col("business_id") == F.col("businessid"))
             .select("resource_id", "business_id", "location", "room_name", "room_size").distinct())
    types = latest_version(coworkers, ["id"], "updatedon").select(
        F.col("id").alias("type_id"), F.col("custom6").alias("member_product"), F.col("custom8").alias("member_type"))
    costs = (latest_version(extras, ["id"], "updatedon")
             .withColumn("price", F.col("price").cast(MONEY))
             .groupBy("bookingid", F.col("coworkerid").alias("cost_coworkerid")).agg(*cond_sums("price", "discount",
                                                                                                "gross_price"))
             .select("bookingid", F.col("discount").cast("double"), F.col("gross_price").cast("double")))
    mt = member_teams(coworkers, teams)
    # joined key by key (booking, member, room), so the bookings are shuffled once for each
    j = (valid.join(costs, F.col("booking_id") == costs["bookingid"], "left")
         .join(members, valid["coworkerid"] == members["coworker_id"])
         .join(types, F.col("coworker_id") == F.col("type_id"))
         .join(mt.withColumnRenamed("coworker_id", "mt_coworker_id"), F.col("coworker_id") == F.col("mt_coworker_id"),
               "left")
         .join(rooms, F.col("resourceid") == F.col("resource_id")))
    return j.select("booking_id", *BOOKING_COLUMNS[1:], "pos", "bookingid", "discount", "gross_price", "email",
                    "companyname", "member_product", "member_type", "location", "room_size", "team_name")


def contracts(contract_versions: DataFrame, coworkers: DataFrame, invoices: DataFrame, tariffs: DataFrame,
              teams: DataFrame) -> DataFrame:
    cc = latest_version(contract_versions, ["id"], "updatedon").drop("id", "updatedon")
    ct = latest_version(coworkers, ["id"], "updatedon").select(
        "id", "email", "billingemail", F.col("custom6").alias("product"), F.col("custom8").alias("customer_role"),
        "teamid")
    inv = latest_version(invoices, ["id"], "updatedon")
    inv = inv.where(F.col("contractguid").isNotNull() & (F.col("contractguid") != ""))
    cp = inv.groupBy("contractguid").agg(
        F.count(F.lit(1)).alias("num_periods"),
        F.sum(F.col("totalamount").cast(MONEY)).cast("double").alias("total_billed"),
        F.sum(F.col("paidamount").cast(MONEY)).cast("double").alias("total_paid"))
    pn = latest_version(tariffs, ["id"], "hdp_created_ts").select(
        F.col("id").alias("plan_id"), "businessname", F.col("name").alias("plan_name"),
        F.col("price").alias("plan_price"))
    tm = latest_version(teams, ["id"], "updatedon").select(F.col("id").alias("team_id"), F.col("name").alias("team_name"))
    j = (cc.join(ct, cc["coworkerid"] == ct["id"])
         .join(cp, cc["uniqueid"] == cp["contractguid"], "left")
         .join(pn, F.col("tariffid") == F.col("plan_id"), "left")
         .join(tm, F.col("teamid") == F.col("team_id"), "left"))
    return j.drop("plan_id", "team_id")


def teams(team_versions: DataFrame, businesses: DataFrame) -> DataFrame:
    nt = latest_version(team_versions, ["id"], "updatedon")
    b = latest_version(businesses, ["id"], "updatedon").select(F.col("id").alias("b_id"),
                                                               F.col("name").alias("location"))
    j = nt.join(b, nt["businessid"] == F.col("b_id"))
    return j.select("id", "businessid", F.col("name").alias("business_team_name"), "payingmemberid",
                    "sharetimepasses", "shareextraservices", "sharebookingcredit", "discountextraservices",
                    "coworkerids", "activecontracts", "location")


def spaces(desk_offices: DataFrame) -> DataFrame:
    return desk_offices.where(F.col("is_deleted") == "NO").select(
        "id", "name", "floorplanid", "floorplanname", "floorplanbusinessname", "size", "capacity", "coworkerid",
        "coworkercontractids", "coworkercontractstartdates", "createdon", "updatedon")


# ---------------------------------------------------------------- adapted runs on the driver tables

def meeting_bookings_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from martforge.sources import workspace_adapters as A
    return meeting_bookings(A.bookings(spark, sf_dir), A.resource(spark, sf_dir), A.business(spark, sf_dir),
                            A.coworker(spark, sf_dir), A.team(spark, sf_dir), A.extra_services(spark, sf_dir),
                            A.member_directory(spark, sf_dir))


def contracts_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from martforge.sources import workspace_adapters as A
    return contracts(A.contracts(spark, sf_dir), A.coworker(spark, sf_dir), A.invoices(spark, sf_dir),
                     A.tariffs(spark, sf_dir), A.team(spark, sf_dir))


def teams_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from martforge.sources import workspace_adapters as A
    return teams(A.team(spark, sf_dir), A.business(spark, sf_dir))


def spaces_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from martforge.sources import workspace_adapters as A
    return spaces(A.desk_offices(spark, sf_dir))
