"""Timestamp helpers. Everything is ``timestamp_ntz`` (wall clock, no zone)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from airlake.schemas import FEED_TS_FORMAT, LANDING_FILE_TS_FORMAT, LANDING_ZONE


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def feed_ts(c: Column | str, fmt: str = FEED_TS_FORMAT) -> Column:
    """Parse a feed timestamp text to ``timestamp_ntz``; malformed text gives NULL.

    ``try_to_timestamp`` validates the text; the NTZ parse then runs only on valid
    text, so the wall clock is kept whatever the session time zone is.
    """
    c = _col(c)
    valid = F.try_to_timestamp(c, F.lit(fmt)).isNotNull()
    return F.to_timestamp_ntz(F.when(valid, c), F.lit(fmt))


def calendar(ts: Column | str, hour_offset: int = 0) -> dict[str, Column]:
    """aqi_year, aqi_month, aqi_quarter, aqi_day, aqi_hour (hour + ``hour_offset``) as int."""
    if isinstance(ts, str):
        t = "`" + ts.replace("`", "``") + "`"
        return {
            "aqi_year": F.expr(f"CAST(year({t}) AS INT)"),
            "aqi_month": F.expr(f"CAST(month({t}) AS INT)"),
            "aqi_quarter": F.expr(f"CAST(quarter({t}) AS INT)"),
            "aqi_day": F.expr(f"CAST(dayofmonth({t}) AS INT)"),
            "aqi_hour": F.expr(f"CAST(hour({t}) + {int(hour_offset)} AS INT)"),
        }
    ts = _col(ts)
    return {
        "aqi_year": F.year(ts).cast("int"),
        "aqi_month": F.month(ts).cast("int"),
        "aqi_quarter": F.quarter(ts).cast("int"),
        "aqi_day": F.dayofmonth(ts).cast("int"),
        "aqi_hour": (F.hour(ts) + F.lit(hour_offset)).cast("int"),
    }


def to_ntz(c: Column | str) -> Column:
    """Zoned timestamp -> wall clock of the session zone, as ``timestamp_ntz``."""
    return _col(c).cast("timestamp_ntz")


def landing_stamp(ts: Column | str, zone: str = LANDING_ZONE,
                  fmt: str = LANDING_FILE_TS_FORMAT) -> Column:
    """Render an instant (zoned ``timestamp``) on the feed's clock (IST), e.g. for file names
    and dated folders; independent of the session time zone."""
    wall = _col(ts).cast("timestamp").cast("timestamp_ntz")        # wall clock of the session zone
    local = F.convert_timezone(F.current_timezone(), F.lit(zone), wall)
    return F.date_format(local, fmt)
