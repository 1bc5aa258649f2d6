"""Randomised checks of the segmented (skew-safe) operators against plain
Python brute force and against the plain-window versions."""

import random

import pytest
from pyspark.sql import functions as F

from martforge.operators import change_points, fill, lag_in_group, modes
from martforge.operators.attribution import attribute
from tests.conftest import rows


def _data(seed, n=400, groups=6):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        g = rnd.choice([None] + list(range(groups)))
        v = rnd.choice([None, None, "a", "b", "c"])
        out.append((g, rnd.randint(0, 60), i, v))
    return out


def _brute_fill(data, direction):
    groups = {}
    for g, t, i, v in data:
        groups.setdefault(g, []).append((t, i, v))
    res = {}
    for g, lst in groups.items():
        lst.sort()
        vals = [v for _, _, v in lst]
        down, last = [], None
        for v in vals:
            last = v if v is not None else last
            down.append(last)
        up, nxt = [], None
        for v in reversed(vals):
            nxt = v if v is not None else nxt
            up.append(nxt)
        up.reverse()
        for k, (_, i, _) in enumerate(lst):
            if direction == "down":
                res[i] = down[k]
            elif direction == "up":
                res[i] = up[k]
            elif direction == "downup":
                res[i] = down[k] if down[k] is not None else up[k]
            else:
                res[i] = up[k] if up[k] is not None else down[k]
    return res


@pytest.mark.parametrize("direction", ["down", "up", "downup", "updown"])
@pytest.mark.parametrize("seed", [1, 2])
def test_fill_matches_brute_force(spark, direction, seed):
    data = _data(seed)
    df = spark.createDataFrame(data, "g int, t int, i int, v string")
    expect = _brute_fill(data, direction)
    for chunk in (None, F.floor(F.col("t") / 7)):
        got = dict(rows(fill(df, ["g"], ["t", "i"], ["v"], direction, chunk=chunk), "i", "v"))
        assert got == expect


def test_fill_chunk_by_subset(spark):
    """by=(g, day) with chunk inside the day and chunk_by=(g,) equals the plain fill."""
    data = [(g, t, i, v) for g, t, i, v in _data(7)]
    df = spark.createDataFrame(data, "g int, t int, i int, v string").withColumn("day", F.floor(F.col("t") / 20))
    plain = dict(rows(fill(df, ["g", "day"], ["t", "i"], ["v"], "downup"), "i", "v"))
    seg = dict(rows(fill(df, ["g", "day"], ["t", "i"], ["v"], "downup", chunk=F.floor(F.col("t") / 5),
                         chunk_by=["g"]), "i", "v"))
    assert plain == seg


@pytest.mark.parametrize("seed", [3, 4])
def test_lag_and_change_points_segmented(spark, seed):
    data = _data(seed)
    df = spark.createDataFrame(data, "g int, t int, i int, v string")
    plain = dict(rows(lag_in_group(df, ["g"], ["t", "i"], "v", "p", "1"), "i", "p"))
    seg = dict(rows(lag_in_group(df, ["g"], ["t", "i"], "v", "p", "1", chunk=F.floor(F.col("t") / 9)), "i", "p"))
    assert plain == seg
    a = sorted(r[0] for r in rows(change_points(df, ["g"], ["t", "i"], "v"), "i"))
    b = sorted(r[0] for r in rows(change_points(df, ["g"], ["t", "i"], "v", chunk=F.floor(F.col("t") / 9)), "i"))
    assert a == b


@pytest.mark.parametrize("seed", [5, 6])
def test_mode_matches_brute_force(spark, seed):
    data = _data(seed)
    df = spark.createDataFrame(data, "g int, t int, i int, v string")
    groups = {}
    for g, t, i, v in sorted(data, key=lambda r: (r[1], r[2])):
        groups.setdefault(g, []).append(v)
    expect = {}
    for g, vals in groups.items():
        seen = [v for v in dict.fromkeys(vals) if v is not None]
        expect[g] = max(seen, key=lambda v: (vals.count(v), -vals.index(v))) if seen else None
    got = dict(rows(modes(df, ["g"], ["v"], ["t", "i"]), "g", "v"))
    assert got == expect


@pytest.mark.parametrize("seed", [8, 9, 10])
def test_attribution_equals_four_fills(spark, seed):
    """The one-pass attribution gives what the source's four fills in a row give."""
    rnd = random.Random(seed)
    data = [(rnd.choice([None, 1, 2, 3]), rnd.choice([0, 0, 1, 2]) * 1440 + rnd.randint(0, 6), i,
             rnd.choice([None, None, None, "cpc", "organic", "mail"]), rnd.choice([None, None, "s"]),
             rnd.choice(["none", "own", "own", "other", "search"])) for i in range(250)]
    df = (spark.createDataFrame(data, "v int, minute int, i int, m string, s string, host string")
          .withColumn("ts", F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, minute, i % 60)"))
          .withColumn("day", F.to_date("ts")).withColumn("url", F.concat(F.lit("u"), F.col("i").cast("string"))))
    label = lambda m: F.when(m == "cpc", "paid").when(m == "organic", "organic").otherwise("other")
    missing = F.when(F.col("host") == "none", "direct").when(F.col("host") == "own", None).otherwise("referral")
    order = ["ts", "i"]
    got = attribute(df, "v", "day", order, ["m", "s"], "m", label, missing, promote=F.col("host") == "search",
                    landing=("url", "landing"), unknown="unknown")
    w = fill(df, ["v", "day"], order, ["m", "s"], "downup")
    w = w.withColumn("m", F.when(F.col("m").isNull() & (F.col("host") == "search"), "organic").otherwise(F.col("m")))
    w = fill(w, ["v", "day"], order, ["m"], "downup")
    w = w.withColumn("m", F.when(F.col("m").isNotNull(), label(F.col("m"))).otherwise(missing))
    w = fill(w, ["v"], order, ["m"], "down")
    w = fill(w, ["v", "day"], order, ["m"], "up").fillna({"m": "unknown"})
    first = {}
    for r in sorted(rows(df, "v", "day", "ts", "i", "url"), key=lambda r: (str(r[0]), r[1], r[2], r[3])):
        first.setdefault((r[0], r[1]), r[4])
    want = sorted((i, m, s, first[(v, d)]) for i, m, s, v, d in rows(w, "i", "m", "s", "v", "day"))
    assert sorted(rows(got, "i", "m", "s", "landing")) == want
