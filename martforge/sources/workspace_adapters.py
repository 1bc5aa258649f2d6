"""Versioned workspace landing tables derived from the driver tables.

Every landing table holds several versions per id (an ``updatedon`` or
ingest time per version, sometimes NULL, sometimes tied), like the
replicated source tables the workspace extracts read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.sources.io import read_table

T0 = "2024-01-01 00:00:00"


def _ts(days) -> F.Column:
    return F.lit(T0).cast("timestamp_ntz") + F.make_interval(days=days)


def _versioned(rows: DataFrame, key, first, later, has_later) -> DataFrame:
    """Rows with their first version and, where ``has_later``, a later one: each table is read once."""
    versions = F.when(has_later, F.array(F.struct(*first), F.struct(*later))).otherwise(F.array(F.struct(*first)))
    return rows.select(*key, F.explode(versions).alias("v")).select(
        *[c for c in rows.select(*key).columns], "v.*")


def bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One version per line item of an order (the order is the booking)."""
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_partkey", "l_linenumber", "l_tax", "l_returnflag",
                                                 "l_shipdate"])
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderpriority"])
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"])
    return j.select(
        F.col("l_orderkey").alias("id"), F.col("o_custkey").alias("coworkerid"),
        F.concat(F.lit("Member "), F.col("o_custkey").cast("string")).alias("coworkerfullname"),
        F.col("l_partkey").alias("resourceid"), F.concat(F.lit("Room "), F.col("l_partkey").cast("string"))
        .alias("resourcename"), F.lit("Meeting room").alias("resourceresourcetypename"),
        F.col("o_orderpriority").alias("teamsatthetimeofbooking"), F.lit("Standard").alias("tariffatthetimeofbooking"),
        F.col("l_shipdate").alias("fromtime"), (F.col("l_shipdate") + F.expr("INTERVAL 1 HOUR")).alias("totime"),
        (F.col("l_tax") * F.lit(100.0)).alias("coworkerextraserviceprice"), F.col("l_shipdate").alias("createdon"),
        F.when(F.col("l_linenumber") != 3, F.col("l_shipdate") + F.make_interval(mins=F.col("l_linenumber")))
        .alias("updatedon"),
        F.when(F.col("l_returnflag") == "R", F.lit("YES")).otherwise(F.lit("NO")).alias("is_deleted"))


def _parts(spark, sf_dir):
    return read_table(spark, sf_dir, "part", ["p_partkey", "p_name", "p_type", "p_size"])


def resource(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _parts(spark, sf_dir)
    return _versioned(
        p, [F.col("p_partkey").alias("id"), F.col("p_type").alias("resourcetypename")],
        [F.col("p_name").alias("name"), F.col("p_size").cast("long").alias("businessid"), _ts(F.lit(0)).alias("updatedon")],
        [F.concat(F.col("p_name"), F.lit(" v2")).alias("name"), (F.col("p_size") - 1).cast("long").alias("businessid"),
         _ts(F.lit(5)).alias("updatedon")], F.col("p_size") > 40)


def business(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = _parts(spark, sf_dir).select(F.col("p_size").cast("long").alias("id")).distinct()
    v1 = sizes.select("id", F.concat(F.lit("Site "), F.col("id").cast("string")).alias("name"),
                      _ts(F.lit(0)).alias("updatedon"))
    v2 = sizes.where(F.col("id") > 45).select("id", F.concat(F.lit("Site "), F.col("id").cast("string"),
                                                             F.lit(" (moved)")).alias("name"),
                                              _ts(F.lit(3)).alias("updatedon"))
    return v1.unionByName(v2)


def _customers(spark, sf_dir):
    return read_table(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"])


def coworker(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Member records; members with a high balance have a later version in another team."""
    c = _customers(spark, sf_dir)
    base = [F.col("c_custkey").alias("id"), F.concat(F.lower(F.col("c_name")), F.lit("@member.example")).alias("email"),
            F.lit(None).cast("string").alias("billingemail"), F.col("c_mktsegment").alias("custom6"),
            F.when(F.col("c_acctbal") > 0, F.lit("Paying")).otherwise(F.lit("Guest")).alias("custom8")]
    tid = F.floor(F.col("c_custkey") / F.lit(10)).cast("long")
    return _versioned(c, base, [tid.alias("teamid"), _ts(F.lit(0)).alias("updatedon")],
                      [(tid + 1).alias("teamid"), _ts(F.lit(2)).alias("updatedon")], F.col("c_acctbal") > 9000)


def team(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Team versions: ten members per team, each member row is one version of its team
    (versions of one team can tie on time; team 0 has no name)."""
    c = _customers(spark, sf_dir)
    tid = F.floor(F.col("c_custkey") / F.lit(10)).cast("long")
    return c.select(
        tid.alias("id"), (F.col("c_nationkey") + 1).cast("long").alias("businessid"),
        (tid + 1000).alias("payingmemberid"), (F.pmod(tid, F.lit(2)) == 0).alias("sharetimepasses"),
        (F.pmod(tid, F.lit(3)) == 0).alias("shareextraservices"), F.lit(True).alias("sharebookingcredit"),
        F.lit(False).alias("discountextraservices"), F.concat(F.lit("m"), F.col("c_custkey").cast("string"))
        .alias("coworkerids"), F.lit("").alias("activecontracts"),
        F.when(tid != 0, F.concat(F.lit("Team "), tid.cast("string"), F.lit(" "), F.lower(F.col("c_mktsegment"))))
        .alias("name"),
        _ts(F.col("c_nationkey")).alias("updatedon"))


def extra_services(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extras per booking line; undiscounted lines get a later, negative (discount) version."""
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_extendedprice", "l_discount",
                                                 "l_shipdate"])
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey"])
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"])
    key = [(F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), F.col("l_orderkey").alias("bookingid"),
           F.when(F.col("l_linenumber") == 2, F.col("o_custkey") + 1).otherwise(F.col("o_custkey")).alias("coworkerid")]
    return _versioned(
        j, key, [F.col("l_extendedprice").alias("price"), F.col("l_shipdate").alias("updatedon")],
        [(-F.col("l_extendedprice")).alias("price"), (F.col("l_shipdate") + F.expr("INTERVAL 1 DAY")).alias("updatedon")],
        F.col("l_discount") == 0)


def member_directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operational member table (one row per member)."""
    c = _customers(spark, sf_dir)
    return c.select(F.col("c_custkey").alias("coworker_id"),
                    F.concat(F.lower(F.col("c_name")), F.lit("@member.example")).alias("email"),
                    F.concat(F.lit("Company "), F.col("c_nationkey").cast("string")).alias("companyname"))


def contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
                                             "o_orderpriority"])
    tariff = F.substring(F.col("o_orderpriority"), 1, 1).cast("long")
    cols = [F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("coworkerid"), tariff.alias("tariffid"),
            F.col("o_orderpriority").alias("tariffname"), F.lit(None).cast("string").alias("nexttariffname"),
            F.col("o_orderdate").alias("createdon"), F.col("o_orderdate").alias("startdate"),
            (F.col("o_orderdate") + F.expr("INTERVAL 365 DAYS")).alias("renewaldate"),
            F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate") + F.expr("INTERVAL 90 DAYS"))
            .alias("cancellationdate"), F.col("o_orderdate").alias("invoicedperiod"),
            F.col("o_orderdate").alias("contractterm"),
            F.when(F.col("o_orderstatus") == "O", F.lit("true")).otherwise(F.lit("false")).alias("active"),
            F.when(F.col("o_orderstatus") == "F", F.lit("true")).otherwise(F.lit("false")).alias("cancelled"),
            F.lit("").alias("floorplandeskids"), F.lit("").alias("floorplandesknames"),
            F.concat(F.lit("C"), F.col("o_orderkey").cast("string")).alias("uniqueid")]
    v1 = o.select(*cols, (F.col("o_totalprice") / F.lit(100.0)).alias("tariffprice"),
                  F.col("o_orderdate").alias("updatedon"))
    v2 = o.where(F.col("o_orderstatus") == "P").select(*cols, (F.col("o_totalprice") / F.lit(50.0)).alias("tariffprice"),
                                                       (F.col("o_orderdate") + F.expr("INTERVAL 30 DAYS"))
                                                       .alias("updatedon"))
    return v1.unionByName(v2)


def invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_extendedprice", "l_discount",
                                                 "l_linestatus", "l_shipdate"])
    guid = (F.when(F.col("l_linenumber") == 7, F.lit("")).when(F.col("l_linenumber") == 6, F.lit(None).cast("string"))
            .otherwise(F.concat(F.lit("C"), F.col("l_orderkey").cast("string"))))
    key = [(F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), guid.alias("contractguid")]
    paid = F.when(F.col("l_linestatus") == "F", F.col("l_extendedprice")).otherwise(F.lit(0.0))
    v1 = li.select(*key, F.col("l_extendedprice").alias("totalamount"), paid.alias("paidamount"),
                   F.col("l_shipdate").alias("updatedon"))
    v2 = li.where(F.col("l_discount") == 0).select(*key, (F.col("l_extendedprice") + F.lit(10.0)).alias("totalamount"),
                                                   F.lit(0.0).alias("paidamount"),
                                                   (F.col("l_shipdate") + F.expr("INTERVAL 1 DAY")).alias("updatedon"))
    return v1.unionByName(v2)


def tariffs(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders", ["o_orderpriority"]).distinct()
    tid = F.substring(F.col("o_orderpriority"), 1, 1).cast("long")
    v1 = o.select(tid.alias("id"), F.lit("Main site").alias("businessname"), F.col("o_orderpriority").alias("name"),
                  (tid * F.lit(100.0)).alias("price"), _ts(F.lit(0)).alias("hdp_created_ts"))
    v2 = o.where(tid == 1).select(tid.alias("id"), F.lit("Main site").alias("businessname"),
                                  F.concat(F.col("o_orderpriority"), F.lit(" plus")).alias("name"),
                                  F.lit(150.0).alias("price"), _ts(F.lit(7)).alias("hdp_created_ts"))
    return v1.unionByName(v2)


def desk_offices(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _parts(spark, sf_dir)
    return p.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"),
                    F.col("p_size").cast("long").alias("floorplanid"), F.col("p_type").alias("floorplanname"),
                    F.concat(F.lit("Site "), F.col("p_size").cast("string")).alias("floorplanbusinessname"),
                    F.col("p_size").cast("double").alias("size"), F.col("p_size").cast("long").alias("capacity"),
                    F.col("p_partkey").alias("coworkerid"), F.lit("").alias("coworkercontractids"),
                    F.lit("").alias("coworkercontractstartdates"), _ts(F.lit(0)).alias("createdon"),
                    _ts(F.lit(1)).alias("updatedon"),
                    F.when(F.col("p_size") > 48, F.lit("YES")).otherwise(F.lit("NO")).alias("is_deleted"))
