import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from airlake.operators import scan
from airlake.operators.series import day_islands, episodes, fill, gap_fill

T0 = dt.datetime(2024, 3, 1)
SCHEMA = "s string, t timestamp_ntz, v double"


def hours(n):
    return T0 + dt.timedelta(hours=n)


def plain_fill(rows):
    """By walking each series hour by hour."""
    out = []
    for s in {r[0] for r in rows}:
        mine = {}
        for _, t, v in (r for r in rows if r[0] == s and r[1] is not None):
            h = int((t - T0).total_seconds() // 3600)
            mine[h] = max([x for x in (mine.get(h), v) if x is not None], default=None)
        for h in range(min(mine), max(mine) + 1) if mine else ():
            before = next((k for k in range(h, min(mine) - 1, -1) if mine.get(k) is not None), None)
            after = next((k for k in range(h, max(mine) + 1) if mine.get(k) is not None), None)
            out.append((s, hours(h), mine.get(h), mine.get(before), mine.get(after),
                        None if before is None else h - before, None if after is None else after - h))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_gap_fill_equals_a_walk(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.choice(["a", "a", "a", "b", None]), T0 + dt.timedelta(minutes=rng.randrange(-60 * 200, 60 * 2000)),
             rng.choice([None, float(rng.randrange(9))])) for _ in range(60)]
    rows += [("a", hours(5), 1.0), ("a", hours(5), 3.0), ("a", hours(6), None), ("only null", hours(3), None), ("a", None, 9.0), ("one", hours(700), 2.0)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(gap_fill(df, ["s"], "t", ["v"])) == plain_fill(rows)


def test_gap_fill_of_nothing(spark):
    assert gap_fill(spark.createDataFrame([], SCHEMA), ["s"], "t", ["v"]).count() == 0


def test_ten_years_of_one_station_are_in_no_single_window(spark, monkeypatch):
    """The windows' groups, counted: a day of hours, or FAN summaries."""
    most = []
    nearest = scan._nearest

    def spied(names, window, place, to):
        most.append(place)
        return nearest(names, window, place, to)

    monkeypatch.setattr(scan, "_nearest", spied)
    n = 10 * 365 * 24
    df = spark.range(n).select(F.lit("hot").alias("s"), F.expr("timestampadd(HOUR, cast(id as int), TIMESTAMP_NTZ'2014-01-01 00:00:00') as t"),
                               F.when(F.col("id") % 1000 == 0, F.col("id").cast("double")).alias("v"))
    out = gap_fill(df, ["s"], "t", ["v"])
    assert out.count() == n
    assert out.where("v_last <> floor(((datediff(t, DATE'2014-01-01')) * 24 + hour(t)) / 1000) * 1000").count() == 0
    assert most == ["__bucket", "__bucket", "__bucket", "__place"]
    days = 10 * 365
    assert days / scan.FAN / scan.FAN < 1.5                # rows of the topmost window


def test_fill_methods(spark):
    df = spark.createDataFrame([("a", hours(0), 10.0), ("a", hours(4), 20.0), ("a", hours(10), 0.0)], SCHEMA)
    spine = gap_fill(df, ["s"], "t", ["v"])
    values = lambda **kw: [r.v for r in fill(spine, "v", **kw).orderBy("t").collect()]
    assert values(method="last")[:5] == [10.0, 10.0, 10.0, 10.0, 20.0]
    assert values(method="next")[:5] == [10.0, 20.0, 20.0, 20.0, 20.0]
    assert values(method="nearest")[:5] == [10.0, 10.0, 10.0, 20.0, 20.0]
    assert values(method="linear")[:5] == [10.0, 12.5, 15.0, 17.5, 20.0]
    assert values(method="last", most_hours=2) == [10.0, 10.0, 10.0, None, 20.0, 20.0, 20.0, None, None, None, 0.0]
    with pytest.raises(ValueError):
        fill(spine, "v", "spline")


def test_days_outside_the_calendar_are_not_in_the_spine_but_are_carried(spark):
    df = spark.createDataFrame([("a", hours(0), 1.0), ("a", hours(30), 5.0), ("a", hours(50), None)], SCHEMA)
    days = spark.createDataFrame([(dt.date(2024, 3, 1),), (dt.date(2024, 3, 3),)], "d date")
    out = gap_fill(df, ["s"], "t", ["v"], days).orderBy("t").collect()
    assert [r.t for r in out] == [hours(h) for h in [*range(24), 48, 49, 50]]
    assert out[-1].v_last == 5.0 and out[-1].v_last_hours == 20 and out[5].v_next == 5.0


# -- episodes ------------------------------------------------------------------------

def plain_episodes(rows, limit, least):
    out = []
    for s in {r[0] for r in rows}:
        mine = {}
        for _, t, v in (r for r in rows if r[0] == s and r[1] is not None and r[2] is not None):
            h = int((t - T0).total_seconds() // 3600)
            mine[h] = max(mine.get(h, v), v)
        above = sorted(h for h, v in mine.items() if v >= limit)
        run = []
        for h in above + [None]:
            if run and (h is None or h != run[-1] + 1):
                if len(run) >= least:
                    vs = [mine[k] for k in run]
                    out.append((s, hours(run[0]), hours(run[-1]), len(run), max(vs), sum(vs) / len(run)))
                run = []
            run.append(h)
    return sorted(out, key=repr)


@pytest.mark.parametrize("least", [1, 3])
def test_episodes_equal_a_walk(spark, least):
    rng = random.Random(7)
    rows = [(s, hours(h), rng.choice([None, 50.0, 150.0, 160.0, 170.0])) for s in ("a", "b", None) for h in range(-80, 400) if rng.random() < 0.95]
    rows += [("long", hours(h), 200.0) for h in range(-100, 2500)] + [("a", hours(3), 120.0), ("a", None, 500.0)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(episodes(day_islands(df, ["s"], "t", "v", 100), ["s"], least)) == plain_episodes(rows, 100, least)


def test_a_changed_day_changes_its_own_islands_only(spark):
    """An episode over midnight is one row, from all days or from one refreshed day."""
    rows = [("a", hours(h), 150.0) for h in range(20, 30)]
    later = [("a", hours(h), 150.0) for h in range(30, 60)]
    before = day_islands(spark.createDataFrame(rows, SCHEMA), ["s"], "t", "v", 100)
    touched = [dt.date(2024, 3, 2), dt.date(2024, 3, 3)]
    full = spark.createDataFrame(rows + later, SCHEMA)
    fresh = day_islands(full.where(F.to_date("t").isin(touched)), ["s"], "t", "v", 100)
    merged = before.where(~F.col("measurement_date").isin(touched)).unionByName(fresh)
    assert got(episodes(merged, ["s"])) == got(episodes(day_islands(full, ["s"], "t", "v", 100), ["s"])) == [("a", hours(20), hours(59), 40, 150.0, 150.0)]
    assert episodes(day_islands(full.limit(0), ["s"], "t", "v", 100), ["s"]).count() == 0
