"""Ranks over a whole table without a window that holds it.

Equal values share their ranks, so only distinct values are ranked: they are counted (each task
first, so a value of very many rows is one row per task), cut into ranges between quantiles, and
numbered inside their range; what lies before a range is the sum of the ranges before it. Rows
then take the ranks of their value. The rows are read a few times, so rows that are costly to make are
better stored first. Values that hold more than 1 / ``HOT`` of all rows, fewer than
``HOT`` by that, go out by broadcast; all others by shuffle, where none can be hot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Ranges of values, and the share of all rows that makes a value hot.
RANGES, HOT = 256, 1024
RANKS = ["rank", "dense_rank", "percent_rank", "cume_dist"]


def value_ranks(rows: DataFrame, value: str, descending: bool = False, ranges: int = RANGES) -> DataFrame:
    """(value, n, total, rank, dense_rank, percent_rank, cume_dist) of every distinct value.

    ``value``: a number, date or timestamp. Nulls come last and tie with each other; a table of one
    row has the percent rank 0.
    """
    counts = rows.groupBy(F.col(value).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    steps = F.array(*[F.lit(k / ranges) for k in range(1, ranges)])
    cuts = counts.agg(F.array_distinct(F.percentile_approx("value", steps, 20 * ranges)).alias("cuts"))
    # the range of a value: how many cuts lie below it; nulls have the last one. It is never null (cuts
    # are missing where no value is): joined by a nullable one, the planner would find the range of
    # every row before the counting, to drop nulls
    place = F.coalesce(F.size(F.filter("cuts", lambda c: c < F.col("value"))), F.lit(0))
    if descending:
        place = -place
    placed = counts.withColumn("cuts", cuts.scalar()).withColumn("range", F.when(F.col("value").isNull(), F.lit(ranges)).otherwise(place)).drop("cuts")
    size = placed.groupBy("range").agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("values"))
    before = Window.partitionBy(F.lit(0)).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)      # at most ``ranges`` rows
    every = Window.partitionBy(F.lit(0))
    ahead = size.select("range", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows"), F.coalesce(F.sum("values").over(before), F.lit(0)).alias("values"),
                        F.sum("rows").over(every).alias("total"))
    order = F.col("value").desc_nulls_last() if descending else F.col("value").asc_nulls_last()
    inside = Window.partitionBy("range").orderBy(order)
    own = placed.withColumns({"upto": F.sum("n").over(inside.rowsBetween(Window.unboundedPreceding, 0)), "place": F.row_number().over(inside)})
    done = own.join(ahead, "range")
    rank = F.col("rows") + F.col("upto") - F.col("n") + 1
    return done.select("value", "n", "total", rank.alias("rank"), (F.col("values") + F.col("place")).alias("dense_rank"),
                       F.when(F.col("total") > 1, (rank - 1) / (F.col("total") - 1)).otherwise(F.lit(0.0)).alias("percent_rank"),
                       ((F.col("rows") + F.col("upto")) / F.col("total")).alias("cume_dist"))


def global_ranks(rows: DataFrame, value: str, descending: bool = False, ranges: int = RANGES) -> DataFrame:
    """``rows`` with ``rank``, ``dense_rank``, ``percent_rank`` and ``cume_dist`` of ``value`` over
    the whole table, as SQL's window functions over one order give them (columns of these names are
    replaced)."""
    ranked = value_ranks(rows, value, descending, ranges).select(F.col("value").alias("__value"), (F.col("n") * HOT > F.col("total")).alias("__hot"), *RANKS)
    kept = rows.drop(*RANKS)
    same = F.col(value).eqNullSafe(F.col("__value"))
    hot = ranked.where("__hot").select(F.col("__value").alias("__h"), F.struct(*RANKS).alias("__of_hot"))
    marked = kept.join(F.broadcast(hot), F.col(value).eqNullSafe(F.col("__h")), "left").drop("__h")
    found = marked.where("__of_hot IS NOT NULL").select(*kept.columns, *[F.col(f"__of_hot.{r}").alias(r) for r in RANKS])
    rest = marked.where("__of_hot IS NULL").join(ranked.where("NOT __hot"), same).select(*kept.columns, *RANKS)
    return found.unionByName(rest)
