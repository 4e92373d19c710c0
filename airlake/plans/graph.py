"""Materialised tables kept fresh along their dependency graph.

Each table is a builder ``(inputs, days) -> DataFrame`` over named input tables and is
stored as Parquet under ``base/<name>``. ``refresh(target)`` rebuilds the target and
everything it depends on, in dependency order. ``refresh(target, days=[...])`` gives the
same tables as a full rebuild would, from the given days: day-partitioned tables overwrite
just those partitions, and a day that comes out empty is cleared. The location dimension is
built from the stations of each month (``location_months``), and these from the stations of
each day (``location_days``): a refresh reads the days of the touched months and a row for each
station and month, never all days. Only where descriptions have changed are the days of those
locations looked up, in the months that hold them; they join the scope of the tables behind. The
dimension is written as a new version beside the old one, so readers and failures never meet half a table.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airlake.operators.cube import cube_states, means, merge_states, partial_states
from airlake.plans import layers as L
from airlake.plans import products as P
from airlake.plans.compaction import raw_days, read_raw
from airlake.schemas import STORED_COLUMNS
from airlake.session import FREED, delete, file_system, read_if_there, settings

DAY = "measurement_date"

# The layer of every table, and the table names SQL users query.
LAYERS = {
    "raw": "stage", "clean_aqi": "clean", "clean_flatten": "clean", "aqi_wide": "consumption",
    "date_dim": "consumption", "location_days": "consumption", "location_months": "consumption", "location_dim": "consumption",
    "air_quality_fact": "consumption",
    "city_hour": "consumption", "city_day": "consumption", "weather_data": "consumption",
    "city_day_weather": "consumption", "station_day_states": "consumption", "city_month_states": "consumption",
}
SQL_NAMES = {
    "raw": "raw_aqi", "clean_aqi": "clean_aqi_dt", "clean_flatten": "clean_flatten_aqi_dt",
    "aqi_wide": "aqi_final_wide_dt", "date_dim": "date_dim", "location_dim": "location_dim",
    "air_quality_fact": "air_quality_fact", "city_hour": "agg_city_fact_hour_level",
    "city_day": "agg_city_fact_day_level", "weather_data": "weather_data",
    "city_day_weather": "agg_delhi_fact_day_level",
}


#: Days that one job of a full refresh takes on, which bounds what it broadcasts.
REFRESH_DAYS = 31


@dataclass
class Table:
    name: str
    inputs: Sequence[str]
    build: Callable[[dict[str, DataFrame], Sequence | None], DataFrame] | None
    partition_by: str | None = DAY
    path: str = ""
    show_day: bool = True              # the day column belongs to the table, not to its layout only
    by_day_runs: bool = False          # a full refresh goes through the days of its (raw) input
    by_month: bool = False             # a partition holds a month, under its first day
    raw: bool = False                  # a raw table: old days may be folded (see compaction)


class TableGraph:
    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")
        self.tables: dict[str, Table] = {}

    # -- registration ---------------------------------------------------------
    def source(self, name: str, path: str, partition_by: str | None = None, raw: bool = False) -> None:
        """An input table maintained elsewhere (raw load, weather snapshot)."""
        self.tables[name] = Table(name, [], None, partition_by, path=path, raw=raw)

    def add(self, name: str, inputs: Sequence[str], build, partition_by: str | None = DAY, **more) -> None:
        missing = [i for i in inputs if i not in self.tables]
        if missing:
            raise KeyError(f"{name}: unknown inputs {missing}")
        layer = LAYERS.get(name, "consumption")
        self.tables[name] = Table(name, list(inputs), build, partition_by,
                                  path=f"{self.base}/{layer}/{name}", **more)

    # -- access ---------------------------------------------------------------
    def read(self, name: str, days: Sequence | None = None, layout: bool = False, months: bool = False) -> DataFrame:
        """A stored table (of the given days, by partition; ``months``: of the months that begin on
        them); ``layout`` keeps a day column that is not the table's own."""
        t = self.tables[name]
        path = self._current(t)
        if t.raw and (df := read_raw(self.spark, path, days)) is not None:
            return df
        df = read_if_there(self.spark, path) if self._finished(t) else self.spark.read.parquet(path)
        if df is None:                                        # built, and every day came out empty
            df = t.build({i: self.read(i, [], layout=True) for i in t.inputs}, []).limit(0)
        if days is not None and t.partition_by == DAY:
            day = F.trunc(DAY, "month") if months else F.col(DAY)
            df = df.filter(day.isin(list(days)) if len(days) else F.lit(False))
        return df if layout or t.show_day else df.drop(DAY)

    def _versions(self, t: Table) -> list[int]:
        """Complete versions of an unpartitioned table, oldest first."""
        fs, pattern = file_system(self.spark, f"{t.path}/version=*/_SUCCESS")
        return sorted(int(x.getPath().getParent().getName().partition("=")[2]) for x in fs.globStatus(pattern) or [])

    def _current(self, t: Table) -> str:
        if t.partition_by or t.build is None:
            return t.path
        versions = self._versions(t)
        return f"{t.path}/version={versions[-1]}" if versions else t.path

    def _finished(self, t: Table) -> bool:
        """A table of ours that has been written, with or without rows."""
        fs, folder = file_system(self.spark, self._current(t))
        return t.build is not None and fs.exists(folder)

    def stored(self, name: str) -> bool:
        t = self.tables[name]
        if t.raw:
            return read_raw(self.spark, t.path) is not None
        return self._finished(t) or read_if_there(self.spark, self._current(t)) is not None

    def register_views(self, sql_names: dict[str, str] | None = None) -> list[str]:
        """Temp views over the stored tables, under the names SQL users know."""
        names = SQL_NAMES if sql_names is None else sql_names
        done = []
        for name in self.tables:
            if self.stored(name):
                self.read(name).createOrReplaceTempView(names.get(name, name))
                done.append(names.get(name, name))
        return done

    def order(self, target: str | None = None) -> list[str]:
        """Dependency order of ``target`` and its ancestors (all tables if None)."""
        seen: list[str] = []

        def visit(n, stack=()):
            if n in stack:
                raise ValueError(f"cycle at {n}")
            for i in self.tables[n].inputs:
                visit(i, stack + (n,))
            if n not in seen:
                seen.append(n)

        for n in ([target] if target else list(self.tables)):
            visit(n)
        return [n for n in seen if self.tables[n].build is not None]

    def ancestors(self, name: str) -> set[str]:
        found: set[str] = set()
        for i in self.tables[name].inputs:
            found |= {i} | self.ancestors(i)
        return found

    # -- refresh --------------------------------------------------------------
    def refresh(self, target: str | None = None, days: Sequence | None = None) -> list[str]:
        """Rebuild ``target`` (all tables if None) and what it depends on; with ``days``, as far
        as those days' input can have changed."""
        return self._build(self.order(target), days)

    def refresh_consumers(self, source: str, days: Sequence | None = None) -> list[str]:
        """Rebuild the tables behind ``source``, of the given days, from stored inputs."""
        names = [n for n in self.order() if source in self.ancestors(n)]
        ready = [n for n in names if all(self.stored(i) or i in names for i in self.tables[n].inputs)]
        return self._build(ready, days)

    def _build(self, names: list[str], days: Sequence | None) -> list[str]:
        wider = days
        for name in names:
            t = self.tables[name]
            if t.partition_by == DAY:
                behind = any(not self.tables[i].partition_by and self.tables[i].build for i in self.ancestors(name))
                self._build_days(t, wider if behind else days)
                continue
            old = self.read(name) if days is not None and self.stored(name) else None
            self._write_version(t, t.build({i: self.read(i, layout=True) for i in t.inputs}, None))
            if days is not None:
                wider = sorted({*wider, *self._days_of_changes(t, old)})
        return list(names)

    def _build_days(self, t: Table, days: Sequence | None) -> None:
        if t.by_month and days is not None:
            # a lake of before this table was kept has all its months to build
            days = sorted({datetime.date.fromisoformat(str(d)[:10]).replace(day=1) for d in days}) if self.stored(t.name) else None
        runs: list = [days]
        if days is None and t.by_day_runs:
            every = self._raw_days(self.tables[t.inputs[0]])
            if every is not None:
                self._clear(t, [d for d in self._stored_days(t) if d not in set(every)])
                runs = [every[k: k + REFRESH_DAYS] for k in range(0, len(every), REFRESH_DAYS)] or [[]]
        elif days is not None and t.by_day_runs:
            given = list(days)
            runs = [given[k: k + REFRESH_DAYS] for k in range(0, len(given), REFRESH_DAYS)] or [[]]
        for run in runs:
            inputs = {i: self.read(i, run, layout=True, months=t.by_month) for i in t.inputs}
            before = self._files(t, run)
            df = t.build(inputs, run)
            # REBALANCE on the partition column: AQE sizes the write tasks by the day they
            # hold, so a day gets a few right-sized files instead of one file from every task
            with settings(self.spark, FREED):
                (df.hint("rebalance", DAY).write.mode("overwrite")
                 .option("partitionOverwriteMode", "static" if run is None else "dynamic")
                 .partitionBy(DAY).parquet(t.path))
            # an overwritten day has new files; one that kept its files got no rows
            after = self._files(t, run)
            self._clear(t, [d for d, files in before.items() if files and after[d] == files])

    def _files(self, t: Table, days: Sequence | None) -> dict:
        """File names of each given day's partition."""
        out = {}
        for d in days or []:
            fs, folder = file_system(self.spark, f"{t.path}/{DAY}={d}")
            out[d] = {x.getPath().getName() for x in fs.listStatus(folder)} if fs.exists(folder) else set()
        return out

    def _stored_days(self, t: Table, column: str = DAY) -> list:
        fs, pattern = file_system(self.spark, f"{t.path}/{column}=*")
        names = [x.getPath().getName().partition("=")[2] for x in fs.globStatus(pattern) or []]
        return sorted(datetime.date.fromisoformat(n) for n in names if n[:1].isdigit())

    def _raw_days(self, t: Table) -> list | None:
        """Record days of the raw table; None if it is not stored by day."""
        return (raw_days(self.spark, t.path) if t.raw else self._stored_days(t, L.RAW_DAY)) or None

    def _clear(self, t: Table, days: Sequence) -> None:
        for d in days:
            delete(self.spark, f"{t.path}/{DAY}={d}")

    def _write_version(self, t: Table, df: DataFrame) -> None:
        """A new version beside the current one; the one before that goes."""
        versions = self._versions(t)
        new = versions[-1] + 1 if versions else 0
        with settings(self.spark, FREED):
            df.hint("rebalance").write.mode("overwrite").parquet(f"{t.path}/version={new}")
        for old in versions[:-1]:
            delete(self.spark, f"{t.path}/version={old}")

    def _days_of_changes(self, t: Table, old: DataFrame | None) -> list:
        """Days of the locations whose descriptions the new version changes; no day is read if
        none does, else those of the months that hold such a location."""
        new = self.read(t.name)
        changed = new if old is None else new.exceptAll(old).unionByName(old.exceptAll(new))
        changed = changed.select("location_pk").distinct()
        months = self.read(t.inputs[0], layout=True).join(changed, "location_pk", "left_semi").select(DAY).distinct()
        held = [r[0] for r in months.collect()]
        if not held:
            return []
        days = self.read(self.tables[t.inputs[0]].inputs[0], held, layout=True, months=True)
        return [r[0] for r in days.join(changed, "location_pk", "left_semi").select(DAY).distinct().collect()]


def _with_day(df: DataFrame, time_col: str) -> DataFrame:
    return df.withColumn(DAY, F.to_date(time_col))


def aqi_pipeline(spark: SparkSession, base: str, raw_path: str, weather_path: str | None = None,
                 round_inputs: bool = True, strict: bool = True, numeric_max: bool = False) -> TableGraph:
    """The whole chain from the raw table to the (weather-enriched) day level.

    ``strict=False`` turns unparsable coordinates into NULL instead of failing the refresh.
    ``numeric_max=True`` pivots with a numeric max (opt-in; see ``products.pivot_pollutants``).
    """
    g = TableGraph(spark, base)
    g.source("raw", raw_path, raw=True)
    g.add("clean_aqi", ["raw"],
          lambda t, d: _with_day(L.clean(t["raw"], d, strict=strict), "index_record_ts"), by_day_runs=True)
    g.add("clean_flatten", ["clean_aqi"],
          lambda t, d: _with_day(P.clean_flatten(t["clean_aqi"], numeric_max), "index_record_ts"))
    g.add("aqi_wide", ["clean_flatten"],
          lambda t, d: _with_day(P.aqi_wide(t["clean_flatten"].drop(DAY)), "index_record_ts"))
    g.add("date_dim", ["clean_flatten"], lambda t, d: _with_day(P.date_dim(t["clean_flatten"]), "measurement_time"),
          show_day=False)
    g.add("location_days", ["clean_flatten"], lambda t, d: P.location_days(t["clean_flatten"]))
    g.add("location_months", ["location_days"], lambda t, d: t["location_days"].withColumn(DAY, F.trunc(DAY, "month")).distinct(), by_month=True)
    g.add("location_dim", ["location_months"], lambda t, d: t["location_months"].drop(DAY).distinct(), partition_by=None)
    g.add("air_quality_fact", ["clean_flatten"], lambda t, d: P.air_quality_fact(t["clean_flatten"]))
    g.add("city_hour", ["air_quality_fact", "date_dim", "location_dim"],
          lambda t, d: _with_day(P.city_hour(t["air_quality_fact"], t["date_dim"].drop(DAY), t["location_dim"],
                                             round_inputs=round_inputs), "measurement_time"))
    g.add("city_day", ["city_hour"], lambda t, d: P.city_day(t["city_hour"].drop(DAY)))
    if weather_path:
        g.source("weather_data", weather_path, partition_by=None)
        g.add("city_day_weather", ["city_day", "weather_data"],
              lambda t, d: P.city_day_weather(t["city_day"], t["weather_data"] if d is None else
                                              t["weather_data"].filter(F.col("measurement_dt").isin(list(d)) if len(d) else F.lit(False))))
    return g


def state_tables(g: TableGraph, values: Sequence[str] = STORED_COLUMNS) -> TableGraph:
    """Adds partial states to a graph that has ``clean_flatten``: of each station and day, from the
    readings of that day alone, and of each city and month, from the day states of that month."""
    def month(t: dict[str, DataFrame], d: Sequence | None) -> DataFrame:
        return merge_states(t["station_day_states"].withColumn(DAY, F.trunc(DAY, "month")), [DAY, "country", "state", "city"], values)

    g.add("station_day_states", ["clean_flatten"], lambda t, d: partial_states(t["clean_flatten"], [DAY, "country", "state", "city", "station"], values))
    g.add("city_month_states", ["station_day_states"], month, by_month=True)
    return g


def place_time_cube(g: TableGraph, values: Sequence[str] = STORED_COLUMNS) -> DataFrame:
    """Count, mean, least and greatest value of country, state and city by year and month with all
    totals, from the stored month states."""
    months = g.read("city_month_states", layout=True).withColumns({"year": F.year(DAY), "month": F.month(DAY)})
    return means(cube_states(months, [["country", "state", "city"], ["year", "month"]], values), values)


def incremental_refresh(graph: TableGraph, target: str | None = None) -> Callable[[int, list], None]:
    """An ``on_batch`` callback for ``ingest``: refresh the days a batch touched, in all tables
    or as far as ``target``."""
    def on_batch(batch_id: int, days: list) -> None:
        if days:
            graph.refresh(target, days=days)
    return on_batch


# -- weather snapshot (CTAS) and daily append ------------------------------------

def snapshot_weather(weather: DataFrame, path: str, graph: TableGraph | None = None) -> None:
    """Replace the weather table with ``weather`` (create-or-replace); ``graph``: then rebuild
    the tables behind it."""
    weather.hint("rebalance", "measurement_dt").write.mode("overwrite") \
        .option("partitionOverwriteMode", "static").partitionBy("measurement_dt").parquet(path)
    if graph is not None:
        graph.refresh_consumers("weather_data")


def append_weather_day(weather_day: DataFrame, path: str, graph: TableGraph | None = None) -> None:
    """Add one day's rows; re-running for the same day replaces that day (idempotent).
    ``graph``: then refresh that day in the tables behind the weather."""
    weather_day.hint("rebalance", "measurement_dt").write.mode("overwrite") \
        .option("partitionOverwriteMode", "dynamic").partitionBy("measurement_dt").parquet(path)
    if graph is not None:
        days = [r[0] for r in weather_day.select("measurement_dt").distinct().collect()]
        graph.refresh_consumers("weather_data", days)
