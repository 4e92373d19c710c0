"""Reshaping operators: conditional-max pivot and array unnest."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pivot_max(df: DataFrame, keys: Sequence[str], pivot_col: str, value_col: str,
              columns: Mapping[str, str], hash_lead: bool = True) -> DataFrame:
    """One row per ``keys``; for every pivot value, ``max(value)`` of its rows.

    ``columns`` maps pivot value -> output column; values not listed are ignored and an
    absent value gives NULL. ``max`` follows the value type: on text it is the
    lexicographic maximum. The aggregation is partial (map side) before the shuffle.

    ``max`` of text has no fixed-width buffer, so Spark aggregates by sorting on the
    keys. ``hash_lead`` puts a 64-bit hash of the keys first: the groups are the same
    (the hash is a function of the keys) but the sort then runs on a long prefix and
    compares the text keys only between rows of the same group.
    """
    # one SQL expression per output column (a single call into the JVM each)
    p, v = _q(pivot_col), _q(value_col)
    aggs = [F.expr(f"max(CASE WHEN {p} = {_lit(val)} THEN {v} END)").alias(out)
            for val, out in columns.items()]
    if not hash_lead:
        return df.groupBy(*keys).agg(*aggs)
    lead = F.expr(f"xxhash64({', '.join(_q(k) for k in keys)})").alias("__key_hash")
    return df.groupBy(lead, *keys).agg(*aggs).drop("__key_hash")


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _lit(value: str) -> str:
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def explode_array(df: DataFrame, array: Column | str, keep: Sequence[str]) -> DataFrame:
    """Inner unnest of an array of structs: one row per element, element fields as columns.

    A NULL or empty array yields no row (lateral-flatten semantics). An array that is costly to
    make is given as a Column: over an array by name the optimizer puts a filter (not null, not
    empty), which makes the array twice, and below the joins, for rows that these leave out.
    """
    return df.select(*keep, F.inline(F.col(array) if isinstance(array, str) else array))
