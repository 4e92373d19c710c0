import datetime as dt
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from airlake.operators.temporal import asof_join, interval_join, validity
from airlake.plans import products as P
from airlake.sources import testbed as TB
from conftest import SF_SMALL

T0 = dt.datetime(2024, 3, 1)


def at(hours):
    return None if hours is None else T0 + dt.timedelta(hours=hours)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def case(seed):
    rng = random.Random(seed)
    keys = ["hot"] * 6 + ["b", "c", None]
    left = [(i, rng.choice(keys), at(rng.choice([None, rng.randrange(-50, 5000) / 4]))) for i in range(300)] + [(7, "hot", at(5))] * 3
    right = [(rng.choice(keys), at(rng.choice([None, rng.randrange(0, 4000) / 4])), float(rng.randrange(100))) for _ in range(120)]
    right += [("hot", at(5), 1.0), ("hot", at(5), 2.0), ("b", at(9), None)]
    return left, right


@pytest.mark.parametrize("seed", range(3))
def test_asof_equals_the_asof_join_of_sql(spark, seed):
    left, right = case(seed)
    l, r = spark.createDataFrame(left, "id int, k string, t timestamp_ntz"), spark.createDataFrame(right, "k string, t timestamp_ntz, v double")
    mine = asof_join(l, r, ["k"], "t", "t", ["v"], as_time="seen")
    con = duckdb.connect()
    con.execute("create table l(id int, k varchar, t timestamp); create table r(k varchar, t timestamp, v double)")
    con.executemany("insert into l values (?, ?, ?)", left)
    con.executemany("insert into r values (?, ?, ?)", right)
    # of right rows of one time the greatest counts (null below all)
    want = con.execute("select id, l.k, l.t, v, r.t from l asof left join (select k, t, max(v) as v from r where t is not null group by k, t) r "
                       "on l.k = r.k and l.t >= r.t").fetchall()
    assert rows(mine) == sorted(want, key=repr)


def test_asof_tolerance_empty_sides_and_hot_buckets(spark):
    l = spark.createDataFrame([(1, "a", at(10)), (2, "a", at(40))], "id int, k string, t timestamp_ntz")
    r = spark.createDataFrame([("a", at(8), 1.0)], "k string, t timestamp_ntz, v double")
    assert rows(asof_join(l, r, ["k"], "t", "t", ["v"], tolerance_hours=2).select("id", "v")) == [(1, 1.0), (2, None)]
    assert rows(asof_join(l, r.limit(0), ["k"], "t", "t", ["v"]).select("id", "v")) == [(1, None), (2, None)]
    assert asof_join(l.limit(0), r, ["k"], "t", "t", ["v"]).count() == 0
    # a year between the reading and its match, over empty buckets
    far = spark.createDataFrame([(3, "a", at(9000))], l.schema)
    assert rows(asof_join(far, r, ["k"], "t", "t", ["v"]).select("id", "v")) == [(3, 1.0)]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_nested_loops_and_no_window_over_a_whole_key(spark):
    left, right = case(0)
    l, r = spark.createDataFrame(left, "id int, k string, t timestamp_ntz"), spark.createDataFrame(right, "k string, t timestamp_ntz, v double")
    text = plan(asof_join(l, r, ["k"], "t", "t", ["v"]))
    assert "NestedLoop" not in text and "Cartesian" not in text
    assert "SinglePartition" not in text


# -- validity ---------------------------------------------------------------------

def day(n):
    return (T0 + dt.timedelta(days=n)).date()


def test_versions_and_the_join_by_them(spark):
    seen = spark.createDataFrame(
        [("a", day(0), "x"), ("a", day(1), "x"), ("a", day(5), "y"), ("a", day(5), "z"), ("a", day(6), "x"), ("b", day(2), None), ("b", day(4), "q"), ("c", None, "n")],
        "k string, d date, name string")
    versions = validity(seen, "k", "d", ["name"])
    assert rows(versions) == sorted([("a", "x", day(0), day(5)), ("a", "y", day(5), day(6)), ("a", "x", day(6), None), ("b", None, day(2), day(4)), ("b", "q", day(4), None)], key=repr)
    events = spark.createDataFrame([(i, k, at(h)) for i, (k, h) in enumerate([("a", -1), ("a", 0), ("a", 119.9), ("a", 120), ("a", 143), ("a", 144), ("a", 24 * 4000),
                                                                              ("b", 0), ("b", 50), ("b", 96), ("c", 5), (None, 5), ("a", None)])], "i int, k string, t timestamp_ntz")
    joined = interval_join(events, versions, "k", "t", ["name"])
    assert [r.name for r in joined.orderBy("i").collect()] == [None, "x", "x", "y", "y", "x", "x", None, None, "q", None, None, None]
    inner = interval_join(events, versions, "k", "t", ["name"], how="inner")
    assert sorted(r.i for r in inner.collect()) == [1, 2, 3, 4, 5, 6, 8, 9]
    assert interval_join(events.limit(0), versions, "k", "t", ["name"]).count() == 0
    assert interval_join(events, versions.limit(0), "k", "t", ["name"]).count() == events.count()


def test_shared_coordinate_keys_do_not_fan_out(spark):
    flat = P.clean_flatten(TB.readings(spark, SF_SMALL))
    fact = P.air_quality_fact(flat).withColumn("at", F.col("measurement_date").cast("timestamp_ntz"))
    # two stations at one place, on every day
    twice = P.location_days(flat).unionByName(P.location_days(flat.withColumn("station", F.concat("station", F.lit(" (old)")))))
    joined = interval_join(fact, validity(twice, "location_pk", "measurement_date", ["state", "city", "station"]), "location_fk", "at",
                           ["state", "city", "station"], interval_key="location_pk")
    assert joined.count() == fact.count()
    assert joined.where("station IS NULL OR station LIKE '%(old)'").count() == 0
    text = plan(joined)
    assert "NestedLoop" not in text and "Cartesian" not in text
