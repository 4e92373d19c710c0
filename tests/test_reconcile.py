"""Digests by day, and the rows that two tables do not share."""

import datetime
import random
from collections import Counter

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from airlake.operators.reconcile import day_digests, differing_days, reconcile

SCHEMA = "d date, a string, b string, x double, n long"
DAYS = [datetime.date(2024, 1, k) for k in range(1, 7)]


def some_rows(seed, n=400):
    rng = random.Random(seed)
    return [(rng.choice([*DAYS, None]), rng.choice(["p", "q", "", None]), rng.choice(["p", None]), rng.choice([0.5, None, float("inf")]), rng.randrange(3)) for _ in range(n)]


def brute(left, right):
    a, b = Counter(left), Counter(right)
    return sorted([("left", *r) for r in (a - b).elements()] + [("right", *r) for r in (b - a).elements()], key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_equals_except_all_both_ways(spark, seed):
    left = some_rows(seed)
    rng = random.Random(seed + 100)
    right = [r for r in left if rng.random() > 0.01] + some_rows(seed + 50, 3) + left[:2]
    rng.shuffle(right)
    a, b = spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA).select("n", "x", "b", "a", "d")
    want = brute(left, right)
    assert got(reconcile(a, b, "d").select("side", "d", "a", "b", "x", "n")) == want
    assert got(reconcile(b, a, "d").where("side = 'left'").select("side", "d", "a", "b", "x", "n")) == [("left", *r[1:]) for r in want if r[0] == "right"]
    days = {r.day: (r.left_rows, r.right_rows) for r in differing_days(a, b.select(*a.columns), "d").collect()}
    assert days == {d: (sum(r[0] == d for r in left), sum(r[0] == d for r in right)) for d in {r[1] for r in want}}


def test_digests_do_not_depend_on_order_or_tasks(spark):
    rows = some_rows(7)
    one = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    many = spark.createDataFrame(rows[::-1], SCHEMA).repartition(7, "n")
    assert got(day_digests(one, "d")) == got(day_digests(many, "d"))
    assert differing_days(one, many, "d").count() == 0 and reconcile(one, many, "d").count() == 0


def test_nulls_in_other_columns_and_repeated_rows_are_told_apart(spark):
    day = DAYS[0]
    a = [(day, "p", None, None, 1), (day, "q", "q", 1.0, 1)]
    b = [(day, None, "p", None, 1), (day, "q", "q", 1.0, 1)]
    assert got(reconcile(spark.createDataFrame(a, SCHEMA), spark.createDataFrame(b, SCHEMA), "d")) == brute(a, b)
    twice = [a[1]] * 3
    assert got(reconcile(spark.createDataFrame(a[1:], SCHEMA), spark.createDataFrame(twice, SCHEMA), "d")) == brute(a[1:], twice)


def test_empty_tables_and_other_columns(spark):
    none, some = spark.createDataFrame([], SCHEMA), spark.createDataFrame(some_rows(3, 20), SCHEMA)
    assert reconcile(none, none, "d").count() == 0
    assert reconcile(none, some, "d").where("side = 'right'").count() == 20
    with pytest.raises(ValueError, match="different columns"):
        reconcile(none, some.drop("n"), "d")
    with pytest.raises(AnalysisException):
        day_digests(some.withColumn("m", F.create_map("a", "b")), "d")


def test_only_differing_days_are_compared(spark, tmp_path):
    paths = [str(tmp_path / s) for s in "ab"]
    rows = [r for r in some_rows(5) if r[0]]
    changed = [(*r[:4], r[4] + 5) if r[0] == DAYS[2] else r for r in rows]
    for path, content in zip(paths, (rows, changed)):
        spark.createDataFrame(content, SCHEMA).write.partitionBy("d").parquet(path)
    a, b = (spark.read.parquet(p) for p in paths)
    found = reconcile(a, b, "d")
    # the comparison's scans, planned by now, cannot read the other days
    for path in paths:
        for day in DAYS:
            if day != DAYS[2]:
                for f in (tmp_path / path / f"d={day}").glob("*.parquet"):
                    f.write_bytes(b"not a table")
    assert found.count() == len(brute(rows, changed)) > 0


def test_a_hot_day_is_condensed_in_every_task(spark):
    df = spark.range(0, 100_000, 1, 4).select(F.lit(DAYS[0]).alias("d"), "id")
    plan = day_digests(df, "d")._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan and "SinglePartition" not in plan
