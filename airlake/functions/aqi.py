"""AQI expressions as plain Catalyst expressions (no Python UDF on the hot path).

Argument order everywhere: pm25, pm10, so2, no2, nh3, co, o3.

Every helper takes column names or Columns. With names, the rule is written once as SQL
text and handed to ``F.expr`` - one call into the JVM instead of dozens of small ones for
each ``when``/``lit``/``coalesce`` - and Catalyst resolves it to the same expression
tree. With Columns, the same rule is built with the Column API.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from airlake.schemas import MISSING, PROMINENT_LABELS, WIDE_COLUMNS

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _seven(cols: Sequence[ColumnOrName]) -> list:
    if len(cols) != 7:
        raise ValueError("expected the seven pollutants pm25, pm10, so2, no2, nh3, co, o3")
    return list(cols)


def _names(cols) -> bool:
    return all(isinstance(c, str) for c in cols)


def q(name: str) -> str:
    """A column name as a quoted SQL identifier."""
    return "`" + name.replace("`", "``") + "`"


# -- SQL text of the rules (over SQL expressions) ------------------------------------

def na_to_zero_sql(e: str) -> str:
    return (f"CAST(CASE WHEN {e} IS NULL OR {e} = '{MISSING}' THEN 0 "
            f"ELSE round(CAST({e} AS DECIMAL(38,9)), 0) END AS BIGINT)")


def na_to_int_sql(e: str) -> str:
    return (f"CAST(CASE WHEN {e} IS NULL OR {e} = '{MISSING}' THEN 0 "
            f"ELSE CAST({e} AS DECIMAL(38,0)) END AS BIGINT)")


def prominent_sql(es: Sequence[str]) -> str:
    vals = [f"coalesce({e}, 0)" for e in es]
    top = f"greatest({', '.join(vals)})"
    return "CASE " + " ".join(f"WHEN {v} = {top} THEN '{lab}'" for v, lab in zip(vals, PROMINENT_LABELS)) + " END"


def sub_index_sql(es: Sequence[str]) -> str:
    pm25, pm10, *gases = es
    counted = " + ".join(f"CASE WHEN {g} IS NOT NULL AND {g} <> 0 THEN 1 ELSE 0 END" for g in gases)
    return f"CAST((CASE WHEN {pm25} > 0 OR {pm10} > 0 THEN 1 ELSE 0 END) + least(2, {counted}) AS INT)"


def aqi_sql(es: Sequence[str], round_inputs: bool = False) -> str:
    args = [f"round({e}, 0)" for e in es] if round_inputs else list(es)
    return f"CASE WHEN {sub_index_sql(args)} > 2 THEN greatest({', '.join(es)}) ELSE 0 END"


# -- Column helpers ---------------------------------------------------------------------

def na_to_zero(c: ColumnOrName) -> Column:
    """Sentinel clean-up of a text reading: NULL -> 0, 'NA' -> 0, else rounded half up.

    Non-numeric text other than 'NA' raises (strict cast under ANSI mode). The CASE
    guards the cast, so 'NA' never reaches it.
    """
    if isinstance(c, str):
        return F.expr(na_to_zero_sql(q(c)))
    return (F.when(c.isNull() | (c == F.lit(MISSING)), F.lit(0))
            .otherwise(F.round(c.cast("decimal(38,9)"), 0))
            .cast("bigint"))


def na_to_int(c: ColumnOrName) -> Column:
    """NULL -> 0, 'NA' -> 0, else the text as a whole number (the text must be integral)."""
    if isinstance(c, str):
        return F.expr(na_to_int_sql(q(c)))
    return (F.when(c.isNull() | (c == F.lit(MISSING)), F.lit(0))
            .otherwise(c.cast("decimal(38,0)"))
            .cast("bigint"))


def prominent(*cols: ColumnOrName) -> Column:
    """Label of the largest of the seven readings; NULL counts as 0; ties -> earlier label."""
    cols = _seven(cols)
    if _names(cols):
        return F.expr(prominent_sql([q(c) for c in cols]))
    vals = [F.coalesce(_col(c), F.lit(0)) for c in cols]
    top = F.greatest(*vals)
    expr = None
    for label, v in zip(PROMINENT_LABELS, vals):
        expr = F.when(v == top, F.lit(label)) if expr is None else expr.when(v == top, F.lit(label))
    return expr


def sub_index_count(*cols: ColumnOrName) -> Column:
    """1 if PM2.5 > 0 or PM10 > 0, plus min(2, number of the five gases that are set and != 0)."""
    cols = _seven(cols)
    if _names(cols):
        return F.expr(sub_index_sql([q(c) for c in cols]))
    pm25, pm10, *gases = [_col(c) for c in cols]
    pm = F.when((pm25 > 0) | (pm10 > 0), F.lit(1)).otherwise(F.lit(0))
    counted = [F.when(g.isNotNull() & (g != 0), F.lit(1)).otherwise(F.lit(0)) for g in gases]
    non_pm = F.least(F.lit(2), sum(counted[1:], counted[0]))
    return (pm + non_pm).cast("int")


def aqi(*cols: ColumnOrName, round_inputs: bool = False) -> Column:
    """greatest(seven) when at least three sub-indices count, else 0.

    ``round_inputs`` makes the sub-index rule see whole numbers (as the original
    whole-number UDF arguments did) while ``greatest`` keeps the fractions.
    """
    cols = _seven(cols)
    if _names(cols):
        return F.expr(aqi_sql([q(c) for c in cols], round_inputs))
    vals = [_col(c) for c in cols]
    args = [F.round(c, 0) for c in vals] if round_inputs else vals
    return F.when(sub_index_count(*args) > 2, F.greatest(*vals)).otherwise(F.lit(0))


def prominent_pollutant(*cols: ColumnOrName, round_inputs: bool = False) -> Column:
    cols = _seven(cols)
    if _names(cols):
        es = [q(c) for c in cols]
        return F.expr(prominent_sql([f"round({e}, 0)" for e in es] if round_inputs else es))
    vals = [_col(c) for c in cols]
    return prominent(*([F.round(c, 0) for c in vals] if round_inputs else vals))


def with_aqi(df, cols: Sequence[str] | None = None, round_inputs: bool = False):
    """Append ``prominent_pollutant`` and ``aqi`` computed from the seven wide columns."""
    cols = list(cols or WIDE_COLUMNS)
    return df.withColumns({
        "prominent_pollutant": prominent_pollutant(*cols, round_inputs=round_inputs),
        "aqi": aqi(*cols, round_inputs=round_inputs),
    })
