"""Physical-plan properties the scale design relies on."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from martforge.plans.common import minute_chunk
from martforge.plans.web import attribute_events

SF = "/root/testdata/sf0.001"


def _executed(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def _jobs(spark, build) -> int:
    """Spark jobs that building a query starts."""
    sc = spark.sparkContext
    sc.setJobGroup("plan-test", "plan-test")
    build()
    ids = sc.statusTracker().getJobIdsForGroup("plan-test")
    sc.setLocalProperty("spark.jobGroup.id", None)
    return len(ids)


@pytest.mark.parametrize("name", ["web_daily_attribution", "fill_down_up", "fill_down_then_up", "stage_change_points",
                                  "deal_stage_history", "marketing_spend", "contracts", "crm_opportunities"])
def test_building_a_query_starts_no_job(spark, name):
    entry.queries()[name](spark, SF)  # reads the tables' schemas
    assert _jobs(spark, lambda: entry.queries()[name](spark, SF)) == 0


def _final(df) -> str:
    """The plan that ran, without the one that adaptive execution began with."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in plan
    return plan.split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", ["fill_down_up", "fill_down_then_up", "stage_change_points", "web_daily_attribution"])
def test_rows_and_summaries_read_one_exchange(spark, name):
    plan = _final(entry.queries()[name](spark, SF))
    assert plan.count("FileScan parquet") == 1 and "ReusedExchange" in plan
    assert "SortAggregate" not in plan and "Checkpoint" not in plan and "ExistingRDD" not in plan


def test_page_views_are_read_three_times(spark):
    """Once for the rows, once for the profile of the addresses, once for the agents."""
    for name in ("attributed_pageviews", "daily_visitors"):
        plan = _final(entry.queries()[name](spark, SF))
        assert plan.count("pages.parquet") == 3 and "SortAggregate" not in plan


def test_modes_hold_no_text_in_buffers(spark):
    assert "SortAggregate" not in _final(entry.queries()["mode_first_seen"](spark, SF))


def test_a_hot_visitor_is_spread_over_tasks(spark):
    """One visitor holds nine tenths of an hour's events: no partition of the window holds them all."""
    rows = spark.range(6000).selectExpr(
        "id as event_id", "timestamp_ntz'2024-01-01 10:00:00' + make_dt_interval(0, 0, 0, id % 3600) as ts",
        "case when id % 10 = 0 then id else 7 end as user_id", "'click' as event_type", "double(id % 60) as value")
    out = attribute_events(rows)
    plan = _executed(out)
    assert "hashpartitioning(__nk_user_id" in plan and "__nk___chunk" in plan
    dealt = rows.withColumn("m", minute_chunk()).where("user_id = 7").repartition(8, "user_id", "m")
    assert dealt.select(F.spark_partition_id()).distinct().count() >= 6
    assert out.count() == 6000


def test_latest_version_limits_map_side(spark):
    plan = _executed(entry.queries()["latest_version"](spark, SF))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_filters_and_columns_reach_the_scan(spark):
    df = entry.queries()["star_join"](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderstatus), Not(EqualTo(o_orderstatus,O))" in plan
    assert "ReadSchema: struct<o_custkey:bigint,o_orderstatus:string,o_totalprice:double>" in plan


def test_top_k_is_take_ordered(spark):
    df = entry.queries()["top_k_by_count"](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
