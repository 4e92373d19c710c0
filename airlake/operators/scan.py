"""Ordered scans over a key without ever ordering a whole key in one task.

A key's rows are cut into buckets of consecutive places. Inside a bucket a window finds the last
(or next) value; between buckets only one summary row per bucket travels, and these are scanned
the same way in groups of ``FAN``, level by level. A window thus holds the rows of one bucket, or
``FAN`` summaries; ten years of hours in day buckets leave one row for the topmost window.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Summaries of one window between buckets, and levels of such groups below the topmost window.
FAN, LEVELS = 64, 2


def _order(c: str, ahead: bool) -> Column:
    return F.col(c).desc() if ahead else F.col(c).asc()


def _nearest(names: Mapping[str, bool], window, place: str, to: int) -> list[Column]:
    """For each name the nearest value that is not null, from the start of the window's order."""
    return [F.last(n, True).over(window.orderBy(_order(place, ahead)).rowsBetween(Window.unboundedPreceding, to)).alias(n)
            for n, ahead in names.items()]


def _summaries(df: DataFrame, by: Sequence[str], names: Mapping[str, bool], place: str) -> DataFrame:
    """The value of each group that the next group would see; null if it has none."""
    pick = {True: "min_by", False: "max_by"}
    return df.groupBy(*by).agg(*[F.expr(f"{pick[ahead]}(`{n}`, `{place}`) FILTER (WHERE `{n}` IS NOT NULL)").alias(n) for n, ahead in names.items()])


def _outside(parts: DataFrame, names: Mapping[str, bool], levels: int) -> DataFrame:
    """(__key, __bucket, names): the nearest value outside of each bucket, on its side."""
    if levels == 0:
        return parts.select("__key", "__bucket", *_nearest(names, Window.partitionBy("__key"), "__bucket", -1))
    grouped = parts.withColumn("__group", F.floor(F.col("__bucket") / FAN).cast("bigint"))
    inside = grouped.select("__key", "__bucket", "__group", *_nearest(names, Window.partitionBy("__key", "__group"), "__bucket", -1))
    above = _outside(_summaries(grouped, ["__key", "__group"], names, "__bucket").withColumnRenamed("__group", "__bucket"), names, levels - 1)
    above = above.select("__key", F.col("__bucket").alias("__group"), *[F.col(n).alias(f"__above_{n}") for n in names])
    return inside.join(above, ["__key", "__group"]).select("__key", "__bucket", *[F.coalesce(n, f"__above_{n}").alias(n) for n in names])


def carried(df: DataFrame, keys: Sequence[str], place: Column, bucket: Column, last: Mapping[str, Column] | None = None,
            next: Mapping[str, Column] | None = None, levels: int = LEVELS) -> DataFrame:
    """``df`` with, for each name of ``last`` (``next``), the last (next) value that is not null
    at or before (after) the row, among the rows of its key.

    ``place`` orders the rows of a key and must tell those apart that differ in the values;
    ``bucket``, a whole number that does not fall as the place grows, bounds the rows of a window.
    Null keys are one key. Columns named like an output are replaced.
    """
    values = {**(last or {}), **(next or {})}
    names = {n: n in (next or {}) for n in values}
    kept = [c for c in df.columns if c not in values]
    cut = df.select(*kept, F.struct(*[F.col(k) for k in keys]).alias("__key"), place.alias("__place"), bucket.cast("bigint").alias("__bucket"),
                    *[v.alias(n) for n, v in values.items()])
    outside = _outside(_summaries(cut, ["__key", "__bucket"], names, "__place"), names, levels)
    outside = outside.select("__key", "__bucket", *[F.col(n).alias(f"__out_{n}") for n in names])
    inside = cut.select(*kept, "__key", "__bucket", *_nearest(names, Window.partitionBy("__key", "__bucket"), "__place", 0))
    return inside.join(outside, ["__key", "__bucket"]).select(*kept, *[F.coalesce(n, f"__out_{n}").alias(n) for n in names])
