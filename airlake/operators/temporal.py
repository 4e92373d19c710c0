"""Joins in time: as-of (the nearest earlier row) and by validity interval.

Neither compares every pair of a key: the as-of join is one ordered scan over both sides, the
interval join an equi-join on key and time bucket with an exact check of the borders.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airlake.operators.scan import carried

_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _micros(time: str) -> Column:
    return F.expr(f"timestampdiff(MICROSECOND, {_EPOCH}, CAST(`{time}` AS TIMESTAMP_NTZ))")


def asof_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_time: str, right_time: str, columns: Sequence[str],
              bucket_hours: int = 24, tolerance_hours: float | None = None, as_time: str | None = None) -> DataFrame:
    """Every row of ``left`` with ``columns`` of the latest row of ``right`` of the same ``keys``
    whose time is not after its own; nulls if there is none (or none within ``tolerance_hours``).

    ``as_time`` also returns the matched row's time under that name. Of right rows of one time the
    one with the greatest ``columns`` counts. Null keys and null times match nothing. Left rows are
    kept as they are, repeated ones too. A key of any size is dealt out by time buckets.
    """
    whole = F.struct(*[F.col(c) for c in left.columns])
    matchable = F.col(left_time).isNotNull()
    for k in keys:
        matchable = matchable & F.col(k).isNotNull()
    value = F.struct(F.col(right_time).alias("__time"), *columns)
    cols = lambda df: [F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]
    key_names = [f"__k{i}" for i in range(len(keys))]
    asked = left.where(matchable).select(*cols(left), _micros(left_time).alias("__at"), F.lit(1).alias("__side"), whole.alias("__row"))
    known = right.where(F.col(right_time).isNotNull()).select(*cols(right), _micros(right_time).alias("__at"), F.lit(0).alias("__side"), value.alias("__value"))
    both = asked.unionByName(known, allowMissingColumns=True)
    place = F.struct("__at", "__side", "__value")               # a right row of the same time comes first
    found = carried(both, key_names, place, F.floor(F.col("__at") / F.lit(bucket_hours * 3_600_000_000)), last={"__match": F.col("__value")})
    found = found.where("__side = 1").select("__row", "__at", "__match")
    rest = left.where(~F.coalesce(matchable, F.lit(False))).select(whole.alias("__row"), F.lit(None).cast("bigint").alias("__at"))
    out = found.unionByName(rest, allowMissingColumns=True)
    if tolerance_hours is not None:
        near = F.col("__at") - F.expr(f"timestampdiff(MICROSECOND, {_EPOCH}, CAST(__match.__time AS TIMESTAMP_NTZ))") <= int(tolerance_hours * 3_600_000_000)
        out = out.withColumn("__match", F.when(near, F.col("__match")))
    extra = [F.col("__match.__time").alias(as_time)] if as_time else []
    return out.select("__row.*", *[F.col(f"__match.`{c}`").alias(c) for c in columns], *extra)


def validity(seen: DataFrame, key: str, day: str, columns: Sequence[str]) -> DataFrame:
    """Versions of each key's description from the days it was seen on: (``key``, ``columns``,
    ``valid_from``, ``valid_to``), half-open days, the last version open (null).

    Of several descriptions of a key on one day the least counts, so versions never overlap and a
    join by them never multiplies rows. A description that returns after another is a new version.
    """
    described = F.struct(*columns)
    daily = seen.where(F.col(day).isNotNull()).groupBy(key, day).agg(F.min(described).alias("__d"))
    by_day = Window.partitionBy(key).orderBy(day)                # a row a day
    changes = daily.withColumn("__before", F.lag("__d").over(by_day)).where(F.col("__before").isNull() | ~F.col("__d").eqNullSafe(F.col("__before")))
    return changes.select(key, "__d.*", F.col(day).alias("valid_from"), F.lead(day).over(by_day).alias("valid_to"))


def interval_join(events: DataFrame, intervals: DataFrame, key: str, time: str, columns: Sequence[str], interval_key: str | None = None,
                  start: str = "valid_from", end: str = "valid_to", bucket_days: int = 31, how: str = "left") -> DataFrame:
    """``events`` with ``columns`` of the intervals of the same key that hold its time: from
    ``start`` to before ``end`` (null: open).

    An interval is dealt to each bucket of days it touches, an open one up to the latest event; an
    event is in one bucket. So the join is an equi-join on (key, bucket), which splits a hot key by
    time, and the borders are checked exactly. Overlapping intervals give a row each.
    """
    bucket = lambda c: F.floor(F.datediff(c.cast("date"), F.lit("1970-01-01").cast("date")) / bucket_days).cast("int")
    latest = events.agg(F.max(bucket(F.col(time)))).scalar()
    first, last = bucket(F.col(start)), F.coalesce(F.least(bucket(F.col(end)), latest), latest)
    # from after the latest event on an interval is of no use
    dealt = intervals.where(first <= latest).select(F.col(interval_key or key).alias("__key"), F.col(start).alias("__start"), F.col(end).alias("__end"),
                                                    F.explode(F.sequence(first, last)).alias("__bucket"), *[F.col(c).alias(f"__c_{c}") for c in columns])
    left = events.withColumn("__at", bucket(F.col(time)))
    t = F.col(time)
    holds = (F.col(key) == F.col("__key")) & (F.col("__at") == F.col("__bucket")) & (t >= F.col("__start")) & (F.col("__end").isNull() | (t < F.col("__end")))
    return left.join(dealt, holds, how).select(*events.columns, *[F.col(f"__c_{c}").alias(c) for c in columns])
