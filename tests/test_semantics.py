"""Mini-fixtures with expected rows for the NULL / ordering / rounding rules."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from martforge.functions import (epoch_ms_to_timestamp, hours_between, matches, not_in_keep_null, paste,
                                 split_at, strict_min, week_start, weekday_mon1)
from martforge.functions.rules import code_map, ladder
from martforge.operators import (anti_join_any, append_row, change_points, date_spine, days_per_week, fill,
                                 latest_version, mode, null_safe_join, pivot, string_agg_distinct,
                                 top_k_by_count, union_distinct)
from tests.conftest import rows


def test_regex_drop_keeps_null(spark):
    df = spark.createDataFrame([(None,), ("404 page",), ("home",)], "title string")
    assert sorted(rows(df.where(~matches("title", "404"))), key=str) == [("home",), (None,)]


def test_not_in_keeps_null(spark):
    df = spark.createDataFrame([(None,), ("other",), ("lead",)], "stage string")
    out = rows(df.where(not_in_keep_null("stage", ["subscriber", "other"])))
    assert sorted(out, key=str) == [("lead",), (None,)]


def test_null_safe_anti_join(spark):
    left = spark.createDataFrame([(None,), ("a",), ("b",)], "ip string")
    right = spark.createDataFrame([(None,), ("a",)], "ip string")
    assert rows(anti_join_any(left, "ip", [right])) == [("b",)]


def test_null_safe_join_matches_null(spark):
    left = spark.createDataFrame([(None, 1), ("a", 2)], "k string, x int")
    right = spark.createDataFrame([(None, "n"), ("a", "A")], "k string, y string")
    out = sorted(rows(null_safe_join(left, right, ["k"], "left"), "x", "y"))
    assert out == [(1, "n"), (2, "A")]


def test_paste_prints_na(spark):
    df = spark.createDataFrame([(None,)], "s string")
    assert rows(df.select(paste("Off-platform(", F.col("s"), ")"))) == [("Off-platform(NA)",)]


def test_strict_min(spark):
    df = spark.createDataFrame([(1, 1), (1, None), (2, 1), (2, 2), (3, None)], "g int, v int")
    out = dict(rows(df.groupBy("g").agg(strict_min("v").alias("m"))))
    assert out == {1: None, 2: 1, 3: None}


def test_latest_version_null_first_and_ties(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, 5, "b"), (2, 5, "c"), (2, 5, "d"), (2, 4, "e")],
                               "k int, t int, x string")
    out = sorted(rows(latest_version(df, ["k"], "t"), "x"))
    assert out == [("a",), ("c",), ("d",)]


def test_half_even_rounding(spark):
    df = spark.createDataFrame([(0,)], "z int")
    out = rows(df.select(F.bround(F.lit(0.25).cast("decimal(3,2)"), 1).cast("double"),
                         F.bround(F.lit(0.35).cast("decimal(3,2)"), 1).cast("double"),
                         F.bround(F.lit(2.5), 0)))
    assert out == [(0.2, 0.4, 2.0)]


def test_split_at_gclid(spark):
    df = spark.createDataFrame([("u?a=1&gclid=Z&b=2",), ("u",), (None,)], "url string")
    a, b = split_at("url", "gclid=")
    out = rows(df.select(a.alias("url"), b.alias("gcl_id")))
    assert out == [("u?a=1&", "Z&b=2"), ("u", None), (None, None)]


def test_monday_week(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 7),)], "d date")
    assert rows(df.select(week_start("d"), weekday_mon1("d"))) == [(dt.date(2024, 1, 1), 7)]


def test_epoch_ms_integer_division(spark):
    df = spark.createDataFrame([(1570000000999,)], "ms long")
    assert rows(df.select(epoch_ms_to_timestamp("ms"))) == [(dt.datetime(2019, 10, 2, 7, 6, 40),)]


def test_or_and_precedence(spark):
    df = spark.createDataFrame([("Tour", True, "x"), ("x", True, "tour"), ("x", False, "tour")],
                               "subject string, deleted boolean, description string")
    cond = F.col("subject").contains("Tour") | (~F.col("deleted") & F.lower("description").contains("tour"))
    assert rows(df.where(cond), "subject", "deleted") == [("Tour", True), ("x", False)]


def test_change_points(spark):
    vals = ["x", "x", "y", None, "y", "y", "x"]
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate(vals)], "g int, i int, v string")
    for chunk in (None, F.floor(F.col("i") / 2)):
        out = [r[0] for r in rows(change_points(df, ["g"], ["i"], "v", "1", chunk=chunk).orderBy("i"), "v")]
        assert out == ["x", "y", "x"]


def test_fill_down_up(spark):
    vals = [None, "a", None, "b", None]
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate(vals)], "g int, i int, v string")
    for chunk in (None, F.floor(F.col("i") / 2)):
        out = [r[0] for r in rows(fill(df, ["g"], ["i"], ["v"], "downup", chunk=chunk).orderBy("i"), "v")]
        assert out == ["a", "a", "a", "b", "b"]


def _down_then_up(spark, data):
    df = spark.createDataFrame(data, "u int, d int, i int, v string")
    df = fill(df, ["u"], ["d", "i"], ["v"], "down")
    df = fill(df, ["u", "d"], ["i"], ["v"], "up")
    return [r[0] for r in rows(df.orderBy("d", "i"), "v")]


def test_fill_down_over_days_then_up_in_day(spark):
    assert _down_then_up(spark, [(1, 1, 0, None), (1, 1, 1, "a"), (1, 2, 0, None), (1, 2, 1, "b")]) == \
        ["a", "a", "a", "b"]
    assert _down_then_up(spark, [(1, 1, 0, None), (1, 1, 1, None), (1, 2, 0, None), (1, 2, 1, "b")]) == \
        [None, None, "b", "b"]


def test_mode_first_seen(spark):
    data = [(1, i, v) for i, v in enumerate(["b", "a", "a", "b"])] + \
           [(2, i, None) for i in range(2)] + [(3, 0, None), (3, 1, "c")]
    df = spark.createDataFrame(data, "g int, i int, v string")
    assert dict(rows(mode(df, ["g"], "v", ["i"]))) == {1: "b", 2: None, 3: "c"}


def test_string_agg_sorted_with_na(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (1, None)], "g int, x string")
    assert rows(df.groupBy("g").agg(string_agg_distinct("x").alias("s")), "s") == [("NA; a; b",)]


def test_union_distinct_collapses(spark):
    a = spark.createDataFrame([("ad", 1.0)], "n string, s double")
    assert union_distinct([a, a]).count() == 1


def test_top_k_tie_by_key(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), ("b",), ("c",)], "k string")
    assert rows(top_k_by_count(df, "k", 1), "k") == [("a",)]


def test_pivot_fill(spark):
    df = spark.createDataFrame([(1, "EMAIL", 3)], "id int, t string, n int")
    assert rows(pivot(df, ["id"], "t", ["EMAIL", "CALL"], "n", fill=0), "EMAIL", "CALL") == [(3, 0)]
    assert rows(pivot(df, ["id"], "t", ["EMAIL", "CALL"], "n", agg="min"), "EMAIL", "CALL") == [(3, None)]


def test_spend_split(spark):
    from martforge.plans.spend import ADAPTED_RULES, allocate_spend
    df = spark.createDataFrame([("ring x", dt.date(2024, 1, 3), 100.0), ("plate", dt.date(2024, 1, 3), 100.0),
                                ("gear", dt.date(2024, 1, 3), None)],
                               "campaign_name string, campaign_date date, spend double")
    out = rows(allocate_spend(df, ADAPTED_RULES), "suite", "desk", "room")
    assert out == [(100.0, 0.0, 0.0), (40.0, 40.0, 20.0), (0.0, 0.0, 0.0)]


def test_date_spine_weeks(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1),), (dt.date(2024, 1, 17),)], "d date")
    spine = date_spine(df, F.min("d"), F.max("d"))
    out = sorted(rows(days_per_week(spine)))
    assert out == [(dt.date(2024, 1, 1), 7), (dt.date(2024, 1, 8), 7), (dt.date(2024, 1, 15), 3)]


def test_code_map_two_else(spark):
    df = spark.createDataFrame([("a",), ("z",), (None,)], "c string")
    out = rows(df.select(code_map("c", {"a": "A"}, default="Not Specified"), code_map("c", {"a": "A"},
                                                                                     keep_original=True)))
    assert out == [("A", "A"), ("Not Specified", "z"), ("Not Specified", None)]


def test_ladder_first_match_wins(spark):
    df = spark.createDataFrame([("paid cpc",), ("organic",), ("x",), (None,)], "m string")
    lab = ladder([(("m", "paid|ppc|cpc"), "paid"), (F.col("m") == "organic", "organic"),
                  (F.col("m").isNotNull(), "other")])
    assert rows(df.select(lab)) == [("paid",), ("organic",), ("other",), (None,)]


def test_hours_between_half_even(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0), dt.datetime(2024, 1, 1, 0, 15))], "a timestamp, b timestamp")
    # 0.25 h -> 0.2 (half-to-even)
    assert rows(df.select(hours_between("b", "a"))) == [(0.2,)]


def test_append_sentinel(spark):
    df = spark.createDataFrame([("x", "y")], "a string, b string")
    assert sorted(rows(append_row(df, ["Not Specified"] * 2))) == [("Not Specified", "Not Specified"), ("x", "y")]


@pytest.mark.parametrize("ids", [["10", "9"], ["0b5e6c1a-aaaa", "9f00-bbbb", "a000-cccc", "A000-dddd"]])
def test_modes_and_first_rows_agree_on_textual_tiebreaks(spark, ids):
    """Equal times: the smallest id as text is first, in the mode, the first value and the first row alike."""
    from martforge.operators.fill import first_in_group
    from martforge.operators.mode import mode, modes
    rows = spark.createDataFrame([("g", i, f"v{i}") for i in reversed(ids)], "g string, id string, v string").withColumn(
        "t", F.expr("timestamp_ntz'2024-01-01 10:00:30'"))
    first = f"v{min(ids)}"
    assert mode(rows, ["g"], "v", ["t", "id"]).collect()[0]["v"] == first
    both = modes(rows, ["g"], ["v", "id"], ["t", "id"], firsts={"v": "f"}).collect()[0]
    assert (both["v"], both["id"], both["f"]) == (first, min(ids), first)
    assert first_in_group(rows, ["g"], ["t", "id"], "v", "f").collect()[0]["f"] == first


def test_modes_without_values_and_times(spark):
    from martforge.operators.mode import modes
    rows = spark.createDataFrame([("a", None, "1", None), ("a", None, "2", "x"), ("b", None, "1", None), (None, None, "3", "y")],
                                 "g string, t timestamp_ntz, id string, v string").withColumn("w", F.lit(1))
    got = {r["g"]: (r["v"], r["w"], r["f"]) for r in modes(rows, ["g"], ["v", "w"], ["t", "id"], firsts={"v": "f"}).collect()}
    assert got == {"a": ("x", 1, None), "b": (None, 1, None), None: ("y", 1, "y")}
