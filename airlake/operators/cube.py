"""Rollups and cubes over stored partial states.

A partial state holds, for each value of a group, how many readings it has, their sum, their least
and their greatest. States are additive: those of a group are merged from those of its parts, so
coarse levels are never computed from readings, and an update touches the parts that changed.

Sums keep the type that Spark gives them (``bigint`` of whole numbers, which is exact in any order).
Null values count nowhere; a group without any value has the count 0 and no mean. An empty table
gives an empty result, without a total.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The parts of a state, and how each of them is merged.
PARTS = {"n": "sum", "sum": "sum", "min": "min", "max": "max"}


def state_columns(values: Sequence[str]) -> list[str]:
    return [f"{v}_{p}" for v in values for p in PARTS]


def partial_states(rows: DataFrame, keys: Sequence[str | Column], values: Sequence[str]) -> DataFrame:
    """One row per group of ``rows``: the keys and the state of every value."""
    how = {"n": F.count, "sum": F.sum, "min": F.min, "max": F.max}
    return rows.groupBy(*keys).agg(*[how[p](v).alias(f"{v}_{p}") for v in values for p in PARTS])


def _merging(values: Sequence[str]) -> list[Column]:
    how = {"sum": F.sum, "min": F.min, "max": F.max}
    return [how[m](f"{v}_{p}").alias(f"{v}_{p}") for v in values for p, m in PARTS.items()]


def merge_states(states: DataFrame, keys: Sequence[str | Column], values: Sequence[str]) -> DataFrame:
    """The states of coarser groups."""
    return states.groupBy(*keys).agg(*_merging(values))


def levels(hierarchies: Sequence[Sequence[str]]) -> list[list[str]]:
    """Every combination of a prefix of each hierarchy, the finest first."""
    prefixes = [[list(h[:k]) for k in range(len(h), -1, -1)] for h in hierarchies]
    return [sum(chosen, []) for chosen in product(*prefixes)]


def cube_states(states: DataFrame, hierarchies: Sequence[Sequence[str]], values: Sequence[str]) -> DataFrame:
    """States of all combinations of levels, in one pass over ``states``.

    A hierarchy is a list of columns from coarse to fine and gives a rollup; several give the cube of
    their rollups. Columns that a level leaves out are null; ``level`` has a bit for each of them (the
    last column has the lowest bit), so that a null key is not taken for a total. Each task merges
    its share of every level first: a total takes one row from each task, whatever holds the rows.
    """
    columns = [c for h in hierarchies for c in h]
    sets = [[F.col(c) for c in chosen] for chosen in levels(hierarchies)]
    made = states.groupingSets(sets, *[F.col(c) for c in columns]).agg(F.grouping_id().cast("int").alias("level"), *_merging(values))
    return made.select(*columns, "level", *state_columns(values))


def means(states: DataFrame, values: Sequence[str]) -> DataFrame:
    """Every state column set replaced by count, mean, least and greatest value."""
    kept = [c for c in states.columns if c not in set(state_columns(values))]
    shown = [[F.col(f"{v}_n"), (F.col(f"{v}_sum") / F.nullif(F.col(f"{v}_n"), F.lit(0))).cast("double").alias(f"{v}_mean"), F.col(f"{v}_min"), F.col(f"{v}_max")] for v in values]
    return states.select(*kept, *[c for part in shown for c in part])
