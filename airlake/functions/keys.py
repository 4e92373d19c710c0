"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def surrogate_key(*cols: Column | str) -> Column:
    """64-bit hash key over the given columns.

    ``xxhash64`` skips NULL arguments, so ``(1, NULL)`` and ``(1,)`` would collide;
    each column is therefore rendered as text with an explicit NULL marker first.
    Both sides of a key join must pass the same column types.
    """
    if all(isinstance(c, str) for c in cols):
        parts = ", ".join("coalesce(CAST(`" + c.replace("`", "``") + "` AS STRING), char(0))" for c in cols)
        return F.expr(f"xxhash64({parts})")
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("\u0000"))
             for c in cols]
    return F.xxhash64(*parts)
