"""CRM-shaped queries on orders / customer / nation / region / supplier / lineitem:
versioned tables, stage roll-ups, join shapes and grouped text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.functions.dates import calendar_columns
from martforge.functions.nulls import matches, paste
from martforge.functions.rules import code_map, ladder
from martforge.operators.aggregates import cond_sums, join_distinct
from martforge.operators.history import latest_version, top_row
from martforge.operators.joins import null_safe_join
from martforge.operators.setops import append_row
from martforge.sources.io import read_table

MONEY = "decimal(18,6)"


def _orders(spark, sf_dir, cols=("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
                                 "o_orderpriority")) -> DataFrame:
    return read_table(spark, sf_dir, "orders", list(cols))


def money_sum(col) -> F.Column:
    """Exact sum of a money column: DECIMAL(18,6) rows (up to 10^12), DECIMAL(28,6) sums, DOUBLE result."""
    return F.sum(F.col(col).cast(MONEY)).cast("double")


# ---------------------------------------------------------------- versioned tables

def _versioned_orders(spark, sf_dir) -> DataFrame:
    """Orders as a versioned table: a NULL version time on some rows."""
    o = _orders(spark, sf_dir)
    nullify = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "F")
    return o.withColumn("version_ts", F.when(~nullify, F.col("o_orderdate")))


def latest_version_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rank-1 rows per customer by version time, NULL first, ties kept."""
    lv = latest_version(_versioned_orders(spark, sf_dir), ["o_custkey"], "version_ts")
    return lv.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "version_ts")


def latest_version_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct (customer, day) of the latest orders: window first, distinct after."""
    lv = latest_version(_orders(spark, sf_dir, ("o_custkey", "o_orderdate")), ["o_custkey"], "o_orderdate")
    return lv.select("o_custkey", F.to_date("o_orderdate").alias("order_date")).distinct()


def latest_composite_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest shipment per (part, supplier) pair."""
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                                 "l_shipdate", "l_quantity"])
    return latest_version(li, ["l_partkey", "l_suppkey"], "l_shipdate")


def top_row_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exactly one order per customer: latest date, then highest key."""
    o = _orders(spark, sf_dir, ("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice"))
    return top_row(o, ["o_custkey"], [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()])


def latest_then_terminal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest order per customer, kept only if its status is terminal (filter *after* picking)."""
    o = _orders(spark, sf_dir, ("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus"))
    last = top_row(o, ["o_custkey"], [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()])
    return last.where(F.col("o_orderstatus").isin("F", "P")).select(
        "o_custkey", F.to_date("o_orderdate").alias("close_date"), "o_orderstatus")


def latest_then_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest orders per customer (ties kept) -> their line totals per contract
    label; rows with an empty or missing label are dropped."""
    o = _orders(spark, sf_dir, ("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"))
    latest = latest_version(o, ["o_custkey"], "o_orderdate").withColumn(
        "contract", F.when(F.col("o_orderpriority") == "5-LOW", F.lit(""))
                     .when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("o_orderpriority")))
    latest = latest.where(F.col("contract").isNotNull() & (F.col("contract") != ""))
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_extendedprice", "l_linestatus"])
    j = latest.join(li, latest["o_orderkey"] == li["l_orderkey"])
    return j.groupBy("contract").agg(
        money_sum("l_extendedprice").alias("billed"),
        F.sum(F.when(F.col("l_linestatus") == "F", F.col("l_extendedprice").cast(MONEY))
              .otherwise(F.lit(0).cast(MONEY))).cast("double").alias("paid"),
        F.count(F.lit(1)).alias("n_lines"))


def stage_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detail stage -> roll-up stage: exact renames, detail kept when it contains
    a main stage (case-sensitive), else 'Upper Funnel'."""
    o = _orders(spark, sf_dir, ("o_orderkey", "o_orderstatus", "o_orderpriority"))
    d = o.withColumn("stage_detail", F.concat_ws("-", "o_orderstatus", "o_orderpriority"))
    stage = ladder([
        (F.col("stage_detail") == "F-5-LOW", "Closed Lost"),
        (F.col("stage_detail") == "O-4-NOT SPECIFIED", "Negotiation/Proposal"),
        (F.col("stage_detail") == "P-3-MEDIUM", "Touring"),
        (("stage_detail", "URGENT|HIGH", False), F.col("stage_detail")),
    ], default="Upper Funnel")
    return d.select("o_orderkey", "stage_detail", stage.alias("pipeline_stage"))


# ---------------------------------------------------------------- joins

def null_safe_left_join_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Left join where a NULL key matches the (single) NULL-keyed customer."""
    o = _orders(spark, sf_dir, ("o_orderkey", "o_custkey")).select(
        "o_orderkey", F.when(F.col("o_custkey") > 10, F.col("o_custkey")).alias("o_key"))
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_name"]).select(
        F.when(F.col("c_custkey") != 1, F.col("c_custkey")).alias("c_key"), "c_name")
    return null_safe_join(o, c, [("o_key", "c_key")], "left").select("o_orderkey", "o_key", "c_name")


def _geo(spark, sf_dir) -> DataFrame:
    n = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    r = read_table(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    return F.broadcast(n.join(F.broadcast(r), n["n_regionkey"] == r["r_regionkey"], "left"))


def star_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders x customer (inner) x nation x region (left), status <> 'O', revenue by geography."""
    o = _orders(spark, sf_dir, ("o_custkey", "o_orderstatus", "o_totalprice")).where(F.col("o_orderstatus") != "O")
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey", "c_mktsegment"])
    j = o.join(c, o["o_custkey"] == c["c_custkey"]).join(_geo(spark, sf_dir),
                                                       F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return j.groupBy("r_name", "n_name", "c_mktsegment").agg(
        F.count(F.lit(1)).alias("orders"), money_sum("o_totalprice").alias("revenue"))


def two_role_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nation joined twice: customer nation and supplier nation of each line."""
    n = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name"])
    cn = F.broadcast(n.select(F.col("n_nationkey").alias("cn_key"), F.col("n_name").alias("cust_nation")))
    sn = F.broadcast(n.select(F.col("n_nationkey").alias("sn_key"), F.col("n_name").alias("supp_nation")))
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_suppkey"])
    o = _orders(spark, sf_dir, ("o_orderkey", "o_custkey"))
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey"])
    s = read_table(spark, sf_dir, "supplier", ["s_suppkey", "s_nationkey"])
    j = (li.join(o, li["l_orderkey"] == o["o_orderkey"])
         .join(c, F.col("o_custkey") == c["c_custkey"])
         .join(s, F.col("l_suppkey") == s["s_suppkey"])
         .join(cn, F.col("c_nationkey") == F.col("cn_key"))
         .join(sn, F.col("s_nationkey") == F.col("sn_key")))
    return j.groupBy("cust_nation", "supp_nation").agg(F.count(F.lit(1)).alias("lines"))


def on_clause_constant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers joined to nation with a constant in the ON clause (region 1)."""
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_nationkey"])
    n = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    j = c.join(F.broadcast(n), (c["c_nationkey"] == n["n_nationkey"]) & (n["n_regionkey"] == 1))
    return j.select("c_custkey", "c_name", "n_name")


def membership_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders inner-joined to a member list that has duplicates (rows multiply; not a semi join)."""
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_mktsegment", "c_acctbal"])
    members = (c.where(F.col("c_mktsegment") == "BUILDING").select("c_custkey")
               .unionAll(c.where((F.col("c_mktsegment") == "BUILDING") & (F.col("c_acctbal") > 9000))
                         .select("c_custkey")))
    o = _orders(spark, sf_dir, ("o_orderkey", "o_custkey"))
    return o.join(members, o["o_custkey"] == members["c_custkey"]).select("o_orderkey", "o_custkey")


def count_distinct_having(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with both of two statuses (count distinct + post-aggregate filter)."""
    o = _orders(spark, sf_dir, ("o_custkey", "o_orderstatus")).where(F.col("o_orderstatus").isin("F", "O"))
    g = o.groupBy("o_custkey").agg(F.count_distinct("o_orderstatus").alias("n_status"))
    return g.where(F.col("n_status") == 2)


def string_agg_distinct_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sorted distinct priorities per customer; one value replaced by NULL prints 'NA'."""
    o = _orders(spark, sf_dir, ("o_custkey", "o_orderpriority")).withColumn(
        "p", F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")))
    return join_distinct(o, ["o_custkey"], "p", "priorities")


# Code -> label map for the two-else recode.
PRIORITY_LABELS = {"1-URGENT": "Busy", "2-HIGH": "Connected", "3-MEDIUM": "Left voicemail"}


def code_map_two_else(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _orders(spark, sf_dir, ("o_orderkey", "o_orderpriority"))
    return o.select("o_orderkey",
                    code_map("o_orderpriority", PRIORITY_LABELS, default="Not Specified").alias("label_ns"),
                    code_map("o_orderpriority", PRIORITY_LABELS, keep_original=True).alias("label_orig"))


def calendar_columns_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _orders(spark, sf_dir, ("o_orderkey", "o_orderdate"))
    return o.select("o_orderkey", F.to_date("o_orderdate").alias("order_date"),
                    *[c.alias(n) for n, c in calendar_columns("order", "o_orderdate").items()])


def concat_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """concat_ws skips NULL; paste prints it as 'NA'."""
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_mktsegment"]).withColumn(
        "seg", F.nullif(F.col("c_mktsegment"), F.lit("HOUSEHOLD")))
    return c.select("c_custkey", F.concat_ws(";", "c_name", "seg").alias("ws"),
                    paste("Social(", F.lower(F.col("seg")), ")").alias("pasted"))


# Inline list of nation names.
LISTED_NATIONS = ["NATION_3", "NATION_7", "NATION_11"]


def literal_table_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of the nations named in an inline literal table."""
    lst = spark.createDataFrame([(n,) for n in LISTED_NATIONS], "n_name string")
    n = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name"]).join(F.broadcast(lst), "n_name")
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey"])
    return c.join(F.broadcast(n), c["c_nationkey"] == n["n_nationkey"]).select("c_custkey", "n_name")


def cond_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Negative (discount) and positive (gross) balances per nation."""
    c = read_table(spark, sf_dir, "customer", ["c_nationkey", "c_acctbal"]).withColumn(
        "bal", F.col("c_acctbal").cast(MONEY))
    g = c.groupBy("c_nationkey").agg(*cond_sums("bal"))
    return g.select("c_nationkey", F.col("discount").cast("double"), F.col("gross").cast("double"))


def sentinel_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct customer geography plus one all-'Not Specified' row."""
    c = read_table(spark, sf_dir, "customer", ["c_nationkey", "c_mktsegment"])
    geo = c.join(_geo(spark, sf_dir), c["c_nationkey"] == F.col("n_nationkey"), "left").select(
        F.col("c_mktsegment").alias("segment"), F.col("n_name").alias("nation"), F.col("r_name").alias("region"))
    return append_row(geo.distinct(), ["Not Specified"] * 3)


def fanout_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line cost grouped by (order, supplier) joined to orders on order only."""
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_suppkey", "l_extendedprice"])
    cost = li.groupBy("l_orderkey", "l_suppkey").agg(money_sum("l_extendedprice").alias("cost"))
    o = _orders(spark, sf_dir, ("o_orderkey", "o_orderdate"))
    return o.join(cost, o["o_orderkey"] == cost["l_orderkey"]).select("o_orderkey", "l_suppkey", "o_orderdate", "cost")


def composite_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily shipped quantity per part left-joined to returned quantity on (part, day)."""
    li = read_table(spark, sf_dir, "lineitem", ["l_partkey", "l_shipdate", "l_quantity", "l_returnflag"]).withColumn(
        "ship_date", F.to_date("l_shipdate"))
    shipped = li.groupBy("l_partkey", "ship_date").agg(money_sum("l_quantity").alias("qty"))
    returned = li.where(F.col("l_returnflag") == "R").groupBy("l_partkey", "ship_date").agg(
        money_sum("l_quantity").alias("returned_qty"))
    return shipped.join(returned, ["l_partkey", "ship_date"], "left")


def or_and_precedence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A OR (B AND C): AND binds first."""
    p = read_table(spark, sf_dir, "part", ["p_partkey", "p_name", "p_brand", "p_size"])
    cond = F.col("p_name").contains("bolt") | ((F.col("p_brand") == "Brand#1") & (F.col("p_size") < 10))
    return p.where(cond).select("p_partkey", "p_name")


def similar_to_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alternation match on the lower-cased name (SIMILAR TO '%(a|b)%') and a class label."""
    p = read_table(spark, sf_dir, "part", ["p_partkey", "p_name"])
    name = F.lower(F.col("p_name"))
    label = ladder([((name, "ring|gear", False), "Tour"), ((name, "bolt|rod", False), "Call")])
    return p.where(matches(name, "ring|gear|bolt|rod", False)).select("p_partkey", "p_name",
                                                                       label.alias("meeting_type"))
