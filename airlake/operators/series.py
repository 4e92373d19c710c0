"""Hourly series: filling of gaps, and episodes above a limit.

Hours are whole numbers since 1970 on the wall clock (``timestamp_ntz``), days 24 of them. Every
window holds one day of one key, or summaries of days (see ``scan``), so a station with years of
hours is worked on by as many tasks as it has days.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airlake.operators.scan import carried

_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _hour_number(time: str) -> Column:
    return F.expr(f"CAST(floor(timestampdiff(SECOND, {_EPOCH}, CAST(`{time}` AS TIMESTAMP_NTZ)) / 3600) AS BIGINT)")


def _hour_time(number: str) -> Column:
    return F.expr(f"timestampadd(HOUR, CAST({number} AS INT), {_EPOCH})")


def _day(hour: Column) -> Column:
    return F.floor(hour / 24).cast("bigint")


def gap_fill(readings: DataFrame, keys: Sequence[str], time: str, values: Sequence[str], days: DataFrame | None = None) -> DataFrame:
    """One row for every hour of each key, from its first to its last one, with what was read
    before and after.

    Columns: ``keys``, ``time`` (start of the hour) and for each value ``v`` the reading itself
    (null where there is none), ``v_last`` and ``v_next``, the last one at or before and the next at
    or after the hour, and ``v_last_hours``, ``v_next_hours``, how many hours away they are.

    Several readings of a key in one hour count as the greatest. Rows without a time are left out.
    Null keys are a series of their own. ``days`` (one column, dates) leaves out the hours of other
    days; readings of such days are still carried. The spine is made day by day after the days are
    dealt out, so it is never a task's work for a whole key.
    """
    number = _hour_number(time)
    seen = readings.where(F.col(time).isNotNull()).select(F.struct(*keys).alias("__k"), number.alias("__hour"), *values)
    span = seen.groupBy("__k").agg(F.min("__hour").alias("lo"), F.max("__hour").alias("hi"))
    per_day = span.select("__k", "lo", "hi", F.explode(F.sequence(_day(F.col("lo")), _day(F.col("hi")))).alias("day"))
    if days is not None:
        wanted = days.select(F.expr(f"CAST(datediff(`{days.columns[0]}`, DATE'1970-01-01') AS BIGINT)").alias("day")).distinct()
        per_day = per_day.join(wanted, "day", "left_semi")
    per_day = per_day.repartition("__k", "day")
    hours = F.sequence(F.greatest(F.col("day") * 24, "lo"), F.least(F.col("day") * 24 + 23, "hi"))
    spine = per_day.select("__k", F.explode(hours).alias("__hour"), *[F.lit(None).cast(readings.schema[v].dataType).alias(v) for v in values], F.lit(True).alias("__spine"))
    rows = seen.withColumn("__spine", F.lit(False)).unionByName(spine)
    rows = rows.groupBy("__k", "__hour").agg(*[F.max(v).alias(v) for v in values], F.max("__spine").alias("__spine"))
    found = lambda v: F.when(F.col(v).isNotNull(), F.struct(F.col(v).alias("value"), F.col("__hour").alias("hour")))
    filled = carried(rows, ["__k"], F.col("__hour"), _day(F.col("__hour")), last={f"{v}_last": found(v) for v in values}, next={f"{v}_next": found(v) for v in values})
    out = [F.col(f"__k.{k}").alias(k) for k in keys] + [_hour_time("__hour").alias(time)]
    for v in values:
        out += [F.col(v), F.col(f"{v}_last.value").alias(f"{v}_last"), F.col(f"{v}_next.value").alias(f"{v}_next"),
                (F.col("__hour") - F.col(f"{v}_last.hour")).alias(f"{v}_last_hours"), (F.col(f"{v}_next.hour") - F.col("__hour")).alias(f"{v}_next_hours")]
    return filled.where("__spine").select(*out)


def fill(filled: DataFrame, value: str, method: str = "last", most_hours: int | None = None) -> DataFrame:
    """``filled`` (of ``gap_fill``) with ``value`` filled by ``method``: ``last``, ``next``,
    ``nearest`` (the earlier at equal distance) or ``linear`` (between both neighbours; one alone
    does not fill). Beyond ``most_hours`` from a reading nothing is filled."""
    last, after = F.col(f"{value}_last"), F.col(f"{value}_next")
    back, ahead = F.col(f"{value}_last_hours"), F.col(f"{value}_next_hours")
    limit = F.lit(most_hours) if most_hours is not None else None
    from_last = last if limit is None else F.when(back <= limit, last)
    from_next = after if limit is None else F.when(ahead <= limit, after)
    if method == "last":
        new = from_last
    elif method == "next":
        new = from_next
    elif method == "nearest":
        new = F.when(ahead.isNull() | (back <= ahead), from_last).otherwise(from_next)
    elif method == "linear":
        between = last + (after - last) * back / F.greatest(back + ahead, F.lit(1))
        new = between if limit is None else F.when((back <= limit) & (ahead <= limit), between)
    else:
        raise ValueError("method must be last, next, nearest or linear")
    return filled.withColumn(value, F.coalesce(value, new))


# -- episodes -----------------------------------------------------------------------

def day_islands(readings: DataFrame, keys: Sequence[str], time: str, value: str, limit) -> DataFrame:
    """Runs of consecutive hours of one day whose value is at least ``limit``: the stored state of
    episodes. A changed day changes its own rows only.

    Columns: ``keys``, ``measurement_date``, ``first_hour`` and ``last_hour`` (since 1970),
    ``hours``, ``peak`` and ``total``. Several readings of an hour count as the greatest; a missing
    reading ends a run.
    """
    hourly = (readings.where(F.col(time).isNotNull()).groupBy(*keys, _hour_number(time).alias("__hour")).agg(F.max(value).alias("__v"))
              .where(F.col("__v") >= limit).withColumn("__day", _day(F.col("__hour"))))
    place = F.row_number().over(Window.partitionBy(*keys, "__day").orderBy("__hour"))
    return (hourly.withColumn("__island", F.col("__hour") - place)
            .groupBy(*keys, "__day", "__island")
            .agg(F.min("__hour").alias("first_hour"), F.max("__hour").alias("last_hour"), F.count(F.lit(1)).alias("hours"),
                 F.max("__v").alias("peak"), F.sum("__v").alias("total"))
            .select(*keys, F.expr("date_add(DATE'1970-01-01', CAST(__day AS INT))").alias("measurement_date"), "first_hour", "last_hour", "hours", "peak", "total"))


def episodes(islands: DataFrame, keys: Sequence[str], least_hours: int = 1) -> DataFrame:
    """Whole episodes from the islands of days: one that ends with its day and one that begins the
    next day are one. An island is open to the left if it starts with its day, to the right if it
    ends with it; an episode starts at an island that no open one ends before, and that start is
    carried on to the islands that follow (by day, in months of summaries).

    Columns: ``keys``, ``start`` and ``end`` (of the first and last hour), ``hours``, ``peak``,
    ``mean``. Shorter episodes than ``least_hours`` are left out.
    """
    day = F.floor(F.col("first_hour") / 24)
    key = F.struct(*keys).alias("__k")
    opened = islands.where("last_hour % 24 = 23").select(key, (F.col("last_hour") + 1).alias("first_hour"), F.lit(True).alias("__goes_on"))
    marked = islands.select(key, "first_hour", "last_hour", "hours", "peak", "total").join(opened, ["__k", "first_hour"], "left")
    start = F.when(F.col("__goes_on").isNull(), F.col("first_hour"))
    chained = carried(marked, ["__k"], F.col("first_hour"), F.floor(day / 32), last={"__start": start})
    whole = chained.groupBy("__k", "__start").agg(F.max("last_hour").alias("__end"), F.sum("hours").alias("hours"), F.max("peak").alias("peak"), F.sum("total").alias("total"))
    return whole.where(F.col("hours") >= least_hours).select(
        *[F.col(f"__k.{k}").alias(k) for k in keys], _hour_time("__start").alias("start"), _hour_time("__end").alias("end"), "hours", "peak",
        (F.col("total") / F.col("hours")).alias("mean"))
