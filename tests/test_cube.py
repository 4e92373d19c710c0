"""Partial states, their cubes, and the state tables of a graph."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from airlake.operators.cube import cube_states, levels, means, merge_states, partial_states
from airlake.plans import graph as G

SCHEMA = "a string, b string, y int, m int, v long, w long"
SIDES = [["a", "b"], ["y", "m"]]


def some_rows(seed, n=300):
    rng = random.Random(seed)
    rows = [(rng.choice(["x", "x", "x", "z", None]), rng.choice(["p", "q", None]), rng.choice([2023, 2024, None]), rng.randrange(1, 4),
             rng.choice([None, rng.randrange(-5, 60)]), rng.randrange(9)) for _ in range(n)]
    return rows + [("only null", "p", 2023, 1, None, 1)] * 2 + rows[:20]


def plain_cube(rows):
    out = {}
    for chosen in levels(SIDES):
        bits = sum(1 << (3 - k) for k, c in enumerate("abym") if c not in chosen)
        for r in rows:
            key = tuple(v if c in chosen else None for c, v in zip("abym", r)) + (bits,)
            out.setdefault(key, []).append(r[4:])
    def stats(vs):
        vs = [v for v in vs if v is not None]
        return (len(vs), sum(vs) / len(vs), min(vs), max(vs)) if vs else (0, None, None, None)
    return sorted(((*k, *stats([v for v, _ in g]), *stats([w for _, w in g])) for k, g in out.items()), key=repr)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_cube_of_merged_states_equals_a_walk(spark, seed):
    rows = some_rows(seed)
    df = spark.createDataFrame(rows, SCHEMA).withColumn("part", F.expr("hash(v, w) % 5"))
    fine = partial_states(df, ["a", "b", "y", "m", "part"], ["v", "w"])
    coarse = merge_states(fine, ["a", "b", "y", "m"], ["v", "w"])
    for states in (fine, coarse):
        assert result(means(cube_states(states, SIDES, ["v", "w"]), ["v", "w"])) == plain_cube(rows)


def test_cube_of_nothing(spark):
    states = partial_states(spark.createDataFrame([], SCHEMA), ["a", "b", "y", "m"], ["v", "w"])
    assert cube_states(states, SIDES, ["v", "w"]).count() == 0


def test_totals_are_merged_in_every_task(spark):
    df = spark.range(0, 40_000, 1, 4).select(F.lit("hot").alias("a"), F.lit("h").alias("b"), F.lit(2024).alias("y"), (F.col("id") % 3).cast("int").alias("m"),
                                             F.col("id").alias("v"), F.col("id").alias("w"))
    plan = cube_states(partial_states(df, ["a", "b", "y", "m"], ["v"]), SIDES, ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan and "SinglePartition" not in plan and "Window" not in plan


def flatten(spark, rows):
    schema = "index_record_ts timestamp_ntz, country string, state string, city string, station string, x long"
    df = spark.createDataFrame([(datetime.datetime(2024, m, d, h), "India", "K", c, s, v) for m, d, h, c, s, v in rows], schema)
    return df.withColumn(G.DAY, F.to_date("index_record_ts"))


def stored(df, path):
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(G.DAY).parquet(path)


def test_a_touched_day_reads_its_own_states_only(spark, tmp_path):
    base = [(m, d, h, c, f"{c}{h % 2}", m * d + h) for m in (1, 2, 3) for d in (1, 2) for h in range(4) for c in "AB"]
    path = str(tmp_path / "flat")
    stored(flatten(spark, base), path)
    g = G.TableGraph(spark, str(tmp_path / "t"))
    g.source("clean_flatten", path, G.DAY)
    G.state_tables(g, ["x"])
    g.refresh()
    fixed = [(*r[:5], r[5] + 100) for r in base if r[:2] == (2, 1)] + [(2, 1, 5, "C", "C0", 7)]
    stored(flatten(spark, fixed), path)
    # readings of other days, and day states of other months, cannot be read now
    for m, d in [(1, 1), (1, 2), (2, 2), (3, 1), (3, 2)]:
        day = f"{G.DAY}={datetime.date(2024, m, d)}"
        (tmp_path / "flat" / day / "part-00000-spoiled.parquet").write_bytes(b"not a table")
        if m != 2:
            (tmp_path / "t/consumption/station_day_states" / day / "part-00000-spoiled.parquet").write_bytes(b"not a table")
    g.refresh(days=[datetime.date(2024, 2, 1)])
    every = [r for r in base if r[:2] != (2, 1)] + fixed
    cube = {(r["city"], r["month"], r["level"]): r for r in G.place_time_cube(g, ["x"]).collect()}
    values = lambda c=None, m=None: [r[5] for r in every if c in (None, r[3]) and m in (None, r[0])]
    for c, m, level in [("A", 2, 0), ("B", 1, 0), ("C", 2, 0), ("A", None, 1), (None, 2, 28), (None, None, 31)]:
        got, want = cube[(c, m, level)], values(c, m)
        assert (got["x_n"], got["x_mean"], got["x_min"], got["x_max"]) == (len(want), sum(want) / len(want), min(want), max(want))


def test_a_day_that_comes_out_empty_leaves_the_states(spark, tmp_path):
    path = str(tmp_path / "flat")
    stored(flatten(spark, [(1, 1, 0, "A", "s", 5), (1, 2, 0, "A", "s", 9)]), path)
    g = G.TableGraph(spark, str(tmp_path / "t"))
    g.source("clean_flatten", path, G.DAY)
    G.state_tables(g, ["x"])
    g.refresh()
    day = datetime.date(2024, 1, 2)
    from airlake.session import delete
    delete(spark, f"{path}/{G.DAY}={day}")
    spark.catalog.clearCache()
    g.refresh(days=[day])
    total = G.place_time_cube(g, ["x"]).where("level = 31").collect()
    assert [(r["x_n"], r["x_max"]) for r in total] == [(1, 5)]
