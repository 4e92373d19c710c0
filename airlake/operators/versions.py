"""Version ranking: newest delivery per key (row_number), and the duplicate report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _order(cols: Sequence[Column | str]) -> list[Column]:
    return [F.col(c).desc() if isinstance(c, str) else c for c in cols]


def rank_versions(df: DataFrame, partition_by: Sequence[str], newest_first: Sequence[Column | str],
                  rank_col: str = "latest_file_rank") -> DataFrame:
    """``row_number() over (partition by keys order by newest_first)``.

    String entries of ``newest_first`` sort descending; pass Columns for other orders.
    Add tie-break columns so equal load times still rank deterministically.
    """
    w = Window.partitionBy(*partition_by).orderBy(*_order(newest_first))
    return df.withColumn(rank_col, F.row_number().over(w))


def latest_per_key(df: DataFrame, partition_by: Sequence[str],
                   newest_first: Sequence[Column | str]) -> DataFrame:
    """Keep the newest row of every key.

    The rank = 1 filter lets Catalyst insert a WindowGroupLimit on both sides of the
    shuffle: every map task forwards at most one row per key, so a hot key that holds a
    large share of the rows does not land whole in one task.
    """
    rk = "__rank"
    return rank_versions(df, partition_by, newest_first, rk).filter(F.col(rk) == 1).drop(rk)


def duplicate_report(df: DataFrame, partition_by: Sequence[str], newest_first: Sequence[Column | str],
                     report_order: Sequence[Column | str], n: int = 10,
                     rank_col: str = "latest_file_rank") -> DataFrame:
    """All versions with their rank, newest keys first, top ``n`` (a top-k report)."""
    ranked = rank_versions(df, partition_by, newest_first, rank_col)
    return ranked.orderBy(*_order(report_order)).limit(n)
