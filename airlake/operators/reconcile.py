"""Reconciliation of two tables stored by day.

The rows of a day are condensed into an order-free digest: their number and the sums of two
independent 64-bit hashes of every row (128 bits, added up as decimals, so nothing wraps). Equal
multisets have equal digests, whatever the order, the files or the tasks. Digests are partial
aggregates: a day of any size is condensed in every task before the shuffle. Only days whose
digests differ are compared row by row, with ``EXCEPT ALL`` in both directions, and only they
are read for it.

Nulls: a row's hash covers which of its columns are null, as hashing alone skips them. A null day is a
day like any other. Repeated rows count as often as they occur. Different multisets of a
day have equal digests with a chance of about 2^-128. Both tables must have the same columns (in any
order); columns that cannot be hashed (maps, variants) are an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _row_hashes(columns: list[str]) -> tuple[Column, Column]:
    cols = [F.col(f"`{c}`") for c in columns]
    nulls = F.concat(*[F.when(c.isNull(), "1").otherwise("0") for c in cols])
    return F.xxhash64(nulls, *cols), F.xxhash64(F.lit("second"), nulls, *reversed(cols))


def day_digests(df: DataFrame, day: str) -> DataFrame:
    """One row for each day: ``rows``, ``first`` and ``second`` (sums of hashes)."""
    one, two = _row_hashes(sorted(df.columns))
    wide = lambda c: F.sum(c.cast("decimal(20,0)"))
    return df.groupBy(F.col(day).alias("day")).agg(F.count("*").alias("rows"), wide(one).alias("first"), wide(two).alias("second"))


def differing_days(left: DataFrame, right: DataFrame, day: str) -> DataFrame:
    """Days whose rows differ: day, left_rows, right_rows (0 where a table lacks the day)."""
    # side by side in one aggregate, so a null day meets a null day
    both = day_digests(left, day).withColumn("side", F.lit(0)).unionByName(day_digests(right, day).withColumn("side", F.lit(1)))
    of = lambda side, c: F.max(F.when(F.col("side") == side, F.col(c)))
    both = both.groupBy("day").agg(*[of(s, c).alias(f"{c}{s}") for s in (0, 1) for c in ("rows", "first", "second")])
    same = F.expr(" AND ".join(f"{c}0 <=> {c}1" for c in ("rows", "first", "second")))
    return both.filter(~same).select("day", F.coalesce("rows0", F.lit(0)).cast("long").alias("left_rows"), F.coalesce("rows1", F.lit(0)).cast("long").alias("right_rows"))


def reconcile(left: DataFrame, right: DataFrame, day: str) -> DataFrame:
    """The rows that one table has more often than the other: ``side`` ("left" or "right": where the
    surplus is) and all columns, a row for each surplus occurrence.

    Runs the digests at once; the days that differ come to the driver (one date each, never
    more than there are days) and become the partition filter of the comparison.
    """
    if sorted(left.columns) != sorted(right.columns):
        raise ValueError(f"the tables have different columns: {sorted(set(left.columns) ^ set(right.columns))}")
    right = right.select(*[F.col(f"`{c}`") for c in left.columns])
    days = [r[0] for r in differing_days(left, right, day).select("day").collect()]
    known, wanted = [d for d in days if d is not None], F.lit(False)
    if known:
        wanted = F.col(day).isin(known)
    if None in days:
        wanted = wanted | F.col(day).isNull()
    a, b = left.filter(wanted), right.filter(wanted)
    return a.exceptAll(b).select(F.lit("left").alias("side"), "*").unionByName(b.exceptAll(a).select(F.lit("right").alias("side"), "*"))
