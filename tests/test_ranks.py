"""Ranks over a whole table, against a sort of all rows."""

import random

import pytest
from pyspark.sql import functions as F

from airlake.operators.ranks import HOT, global_ranks, value_ranks


def plain_ranks(values, descending):
    order = sorted({v for v in values if v is not None}, reverse=descending) + [None] * (None in values)
    out, before, n = {}, 0, len(values)
    for k, v in enumerate(order):
        count = values.count(v)
        out[v] = (before + 1, k + 1, before / (n - 1) if n > 1 else 0.0, (before + count) / n)
        before += count
    return out


def check(spark, values, descending, ranges, schema="id long, v double"):
    df = spark.createDataFrame(list(enumerate(values)), schema)
    want = plain_ranks(values, descending)
    got = global_ranks(df, "v", descending, ranges).collect()
    assert sorted(r["id"] for r in got) == list(range(len(values)))
    for r in got:
        assert (r["rank"], r["dense_rank"], r["percent_rank"], r["cume_dist"]) == want[values[r["id"]]], r


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("ranges", [2, 7, 256])
def test_ranks_equal_a_sort(spark, descending, ranges):
    rng = random.Random(ranges)
    values = [rng.choice([None, 0.0, 0.0, 0.0, float(rng.randrange(40)), rng.random() * 40]) for _ in range(400)]
    check(spark, values, descending, ranges)


@pytest.mark.parametrize("values", [[], [3.0], [None], [None, None], [1.0, 1.0, 1.0], [2.0, None, 1.0]])
def test_small_tables(spark, values):
    check(spark, values, False, 4)
    check(spark, values, True, 4)


def test_values_below_the_hot_share_take_the_shuffle(spark):
    """More distinct values than can be hot, beside one that half of the rows hold."""
    values = [float(k) for k in range(2 * HOT)] + [7.5] * (2 * HOT)
    random.Random(1).shuffle(values)
    check(spark, values, False, 16)


def test_dates_and_replaced_columns(spark):
    df = spark.sql("SELECT DATE'2024-01-01' + CAST(id % 5 AS INT) AS v, id AS rank FROM range(20)")
    got = {(str(r["v"]), r["rank"], r["dense_rank"]) for r in global_ranks(df, "v", ranges=3).collect()}
    assert got == {(f"2024-01-0{k + 1}", 4 * k + 1, k + 1) for k in range(5)}


def test_no_window_holds_the_table(spark):
    """A value of a third of all rows is one row of a window over distinct values."""
    df = spark.range(0, 20_000, 1, 4).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).cast("double").alias("v"))
    ranked = value_ranks(df, "v", ranges=8)
    plan = ranked._jdf.queryExecution().optimizedPlan().toString()
    windows = [x for x in plan.splitlines() if x.strip(" +-:").startswith("Window")]
    assert windows and "partial_count" in ranked._jdf.queryExecution().executedPlan().toString()
    for line in windows:                                      # by range, or over one row for each range
        assert "[range#" in line or "rows#" in line, line
    assert ranked.count() == 20_000 - 6_667 + 1 and ranked.agg(F.max("cume_dist")).first()[0] == 1.0


def test_ranges_are_found_for_distinct_values_only(spark):
    """No row is placed among the cuts before the counting (here: in a filter below it)."""
    df = spark.range(0, 2_000, 1, 4).select((F.col("id") % 50).cast("double").alias("v"))
    for ranked in (value_ranks(df, "v"), value_ranks(df, "v", descending=True), global_ranks(df, "v")):
        plan = ranked._jdf.queryExecution().optimizedPlan().toString()
        assert "lambda" in plan
        assert not [line for line in plan.splitlines() if "Filter" in line and "lambda" in line], plan


def test_the_query_makes_its_rows_once(spark):
    from conftest import SF_SMALL

    import __spark_entry__ as E

    plan = E.queries()["aqi_ranks"](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "aqi#" in plan and "l_shipdate" not in plan and "max(" not in plan
