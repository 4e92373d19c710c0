"""Compaction of the raw table's old days.

A load leaves one folder for each day, load and batch, which is what lets a batch run again
replace its own rows. ``compact_raw`` folds the folders of old days into a few right-sized
files for each day, in ``<raw>_compacted/run=<n>/record_day=<day>``, where load and batch are columns.
``read_raw`` gives both parts as one table.

* A batch that is run again after its folder was folded writes its folder anew. Its day's
  folded rows of that load and batch then count no more, so it still replaces its own rows.
* The folded days are written as a new run first (complete once it has its ``_SUCCESS``) and the
  folders are removed afterwards. Until they are, the same rule hides the folded copy, so a
  failure at any point neither loses nor repeats a row.
* A folder goes only if it still holds the files that were folded.

No loads should write to the very days while they are folded; later days are free.
"""

from __future__ import annotations

import datetime
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airlake.plans.layers import RAW_DAY, RAW_GROUP, WHOLE_DOCUMENTS
from airlake.session import FREED, delete, file_system, read_if_there, settings

#: What a folder of the raw table is for.
_FOLDER = [RAW_DAY, "ingest_load", "ingest_batch"]


def _value(path, levels: int) -> str:
    for _ in range(levels):
        path = path.getParent()
    return path.getName().partition("=")[2]


def _folders(spark: SparkSession, raw_path: str) -> dict[tuple, str]:
    """(day, load, batch) of every folder of the raw table, with its path."""
    fs, pattern = file_system(spark, f"{raw_path}/{RAW_DAY}=*/ingest_load=*/ingest_batch=*")
    paths = [x.getPath() for x in fs.globStatus(pattern) or []]
    return {(datetime.date.fromisoformat(_value(p, 2)), _value(p, 1), int(_value(p, 0))): p.toString() for p in paths if _value(p, 2)[:1].isdigit()}


def _files(spark: SparkSession, folder: str) -> set[str]:
    fs, there = file_system(spark, folder)
    return {x.getPath().getName() for x in fs.listStatus(there)} if fs.exists(there) else set()


def _runs(spark: SparkSession, raw_path: str) -> list[int]:
    """Complete runs, oldest first."""
    fs, pattern = file_system(spark, f"{raw_path}_compacted/run=*/_SUCCESS")
    return sorted(int(_value(x.getPath(), 1)) for x in fs.globStatus(pattern) or [])


def compacted_days(spark: SparkSession, raw_path: str) -> dict[datetime.date, int]:
    """The folded days and the run that holds each: the newest complete one that has it."""
    done = set(_runs(spark, raw_path))
    fs, pattern = file_system(spark, f"{raw_path}_compacted/run=*/{RAW_DAY}=*")
    held = [(int(_value(x.getPath(), 1)), datetime.date.fromisoformat(_value(x.getPath(), 0))) for x in fs.globStatus(pattern) or []]
    return {day: run for run, day in sorted(held) if run in done}


def raw_days(spark: SparkSession, raw_path: str) -> list[datetime.date]:
    """Record days of the raw table, folded or not."""
    return sorted({f[0] for f in _folders(spark, raw_path)} | set(compacted_days(spark, raw_path)))


def read_raw(spark: SparkSession, raw_path: str, days: Sequence | None = None) -> DataFrame | None:
    """The raw table (of the given days): what was folded and what was not; None if nothing has
    been loaded. Without folded days this is the plain scan."""
    wanted = None if days is None else {datetime.date.fromisoformat(str(d)[:10]) for d in days}
    kept = {d: run for d, run in compacted_days(spark, raw_path).items() if wanted is None or d in wanted}
    fresh = read_if_there(spark, raw_path)
    if fresh is not None and wanted is not None and RAW_DAY in fresh.columns:
        fresh = fresh.filter(F.col(RAW_DAY).isin(sorted(wanted)) if wanted else F.lit(False))
    if not kept:
        return fresh
    base = f"{raw_path}_compacted"
    # a run is read with its own base path, so the run is no column of the table
    by_run = {run: [f"{base}/run={run}/{RAW_DAY}={d}" for d in kept if kept[d] == run] for run in sorted(set(kept.values()))}
    folded = reduce(DataFrame.unionByName, [spark.read.option("basePath", f"{base}/run={run}").parquet(*paths) for run, paths in by_run.items()])
    again = [f for f in _folders(spark, raw_path) if f[0] in kept]
    if again:
        replaced = spark.createDataFrame(again, f"{RAW_DAY} date, ingest_load string, ingest_batch long")
        # the listing is on the driver already, and its size is unknown to the planner: without the
        # hint it would shuffle the documents
        folded = folded.join(F.broadcast(replaced), _FOLDER, "left_anti").select(folded.columns)
    if fresh is None:
        return folded
    return fresh.withColumns({"ingest_load": F.col("ingest_load").cast("string"), "ingest_batch": F.col("ingest_batch").cast("bigint")}).unionByName(folded)


def compact_raw(spark: SparkSession, raw_path: str, before: datetime.date, days_at_once: int = 31) -> list[datetime.date]:
    """Fold the folders of all days before ``before``; the days that were folded now.

    A day with a single folder and nothing folded yet is left as it is. One job takes on at
    most ``days_at_once`` days; what runs on the driver is a listing of folders.
    """
    folders, folded = _folders(spark, raw_path), compacted_days(spark, raw_path)
    count: dict[datetime.date, int] = {}
    for day, _, _ in folders:
        count[day] = count.get(day, 0) + 1
    todo = sorted(d for d, n in count.items() if d < before and (n > 1 or d in folded))
    for k in range(0, len(todo), days_at_once):
        days = todo[k: k + days_at_once]
        mine = {p: _files(spark, p) for f, p in folders.items() if f[0] in set(days)}
        # the number after all runs, complete or not: a broken one is never taken for this
        fs, pattern = file_system(spark, f"{raw_path}_compacted/run=*")
        run = max([int(_value(x.getPath(), 0)) for x in fs.globStatus(pattern) or []], default=-1) + 1
        rows = read_raw(spark, raw_path, days)
        with settings(spark, WHOLE_DOCUMENTS | FREED):
            rows.hint("rebalance", RAW_DAY).write.mode("error").options(**RAW_GROUP).partitionBy(RAW_DAY).parquet(f"{raw_path}_compacted/run={run}")
        for path, files in mine.items():
            if _files(spark, path) == files:
                delete(spark, path)
        for day in days:
            if day in folded:
                delete(spark, f"{raw_path}_compacted/run={folded[day]}/{RAW_DAY}={day}")
    return todo
