"""Picker, top-k and latest-slice operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distinct_sorted(df: DataFrame, col: Column | str, name: str | None = None,
                    descending: bool = False) -> DataFrame:
    """Distinct values of one column, sorted (a picker list). Partial aggregation per task.

    NULL sorts last ascending and first descending, as in the original ``ORDER BY``
    (Spark's own default is the reverse).
    """
    c = F.col(col) if isinstance(col, str) else col
    name = name or (col if isinstance(col, str) else "value")
    out = df.select(c.alias(name)).distinct()
    return out.orderBy(F.col(name).desc_nulls_first() if descending else F.col(name).asc_nulls_last())


def rows_at_max(df: DataFrame, col: str) -> DataFrame:
    """Rows whose ``col`` equals the global maximum of ``col``.

    The maximum is an uncorrelated scalar subquery (a partial aggregate per task, run
    once before the scan); on a partition column it prunes the scan to one partition.
    """
    return df.filter(F.col(col) == df.agg(F.max(col)).scalar())


def top_n_on_latest(df: DataFrame, date_col: str, n: int, order: Sequence[Column]) -> DataFrame:
    """Top ``n`` rows by ``order`` within the latest ``date_col`` (TakeOrderedAndProject)."""
    return rows_at_max(df, date_col).orderBy(*order).limit(n)


def latest_key(dim: DataFrame, key_col: str, time_col: str) -> DataFrame:
    """One-row frame with the key of the latest ``time_col`` (ties: larger key)."""
    return dim.agg(F.max_by(F.col(key_col), F.struct(F.col(time_col), F.col(key_col))).alias(key_col))


def preview(df: DataFrame, n: int = 10, order: Sequence[Column | str] | None = None) -> DataFrame:
    """First ``n`` rows, in ``order`` if given (a sampling report; the limit is the feature)."""
    return (df.orderBy(*order) if order else df).limit(n)
