"""Parameterised dashboard queries over the star schema and the rollups.

Parameters are bound as literals (``col == lit(value)``), never spliced into SQL text.
Each function returns a lazy DataFrame; the caller collects the (small) result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airlake.operators import distinct_sorted, latest_key, top_n_on_latest
from airlake.schemas import WIDE_COLUMNS


def _eq(**kv):
    cond = None
    for k, v in kv.items():
        c = F.col(k) == F.lit(v)
        cond = c if cond is None else cond & c
    return cond


def _bind(df: DataFrame, selection, on: dict[str, F.Column] | None = None) -> DataFrame:
    """Keep the rows of ``df`` that match ``selection``.

    ``selection`` is either a dict of literal values or a one-row DataFrame (e.g. the
    default selection computed on the cluster). The frame's values are scalar subqueries, so
    none travels through the driver, and a frame of several rows is an error rather than a
    join that multiplies rows. ``on`` maps a selection column to the expression of ``df`` it is
    compared with (default: the same column).
    """
    on = on or {}
    names = list(selection) if isinstance(selection, dict) else selection.columns
    cond = F.lit(True)
    for k in names:
        value = F.lit(selection[k]) if isinstance(selection, dict) else selection.select(k).scalar()
        cond &= (on[k] if k in on else df[k]) == value
    return df.filter(cond)


# -- default selections (the first item of every picker), as one-row frames ---

def default_station(locations: DataFrame) -> DataFrame:
    """state (first ascending), then city and station (first descending) - one aggregate."""
    per_state = locations.groupBy("state").agg(F.max(F.struct("city", "station")).alias("cs"))
    return (per_state.agg(F.min("state").alias("state"), F.min_by("cs", "state").alias("cs"))
            .select("state", "cs.city", "cs.station"))


def default_day(table: DataFrame, time_col: str = "measurement_time") -> DataFrame:
    """The latest day (first of the descending date picker)."""
    return table.agg(F.max(F.to_date(time_col)).alias("measurement_date"))


def default_city_day(hour_level: DataFrame, locations: DataFrame | None = None) -> DataFrame:
    """state, city, then day - each the first of its descending picker. With ``locations`` the
    place comes from that small table, and only its rows of the hour level are looked at."""
    if locations is None:
        top = hour_level.agg(F.max(F.struct("state", "city", F.to_date("measurement_time").alias("d"))).alias("s"))
        return top.select("s.state", "s.city", F.col("s.d").alias("measurement_date"))
    place = locations.agg(F.max(F.struct("state", "city")).alias("s"))
    mine = _bind(hour_level, place.select("s.state", "s.city"))
    return mine.agg(F.max("state").alias("state"), F.max("city").alias("city"),
                    F.max(F.to_date("measurement_time")).alias("measurement_date"))


# -- pickers -----------------------------------------------------------------

def picker_states(locations: DataFrame, descending: bool = False) -> DataFrame:
    return distinct_sorted(locations, "state", descending=descending)


def picker_cities(locations: DataFrame, state) -> DataFrame:
    """Cities of a state; ``state`` is a value or a one-row frame with a ``state`` column."""
    sel = {"state": state} if isinstance(state, str) else state.select("state")
    return distinct_sorted(_bind(locations, sel), "city", descending=True)


def picker_stations(locations: DataFrame, state, city=None) -> DataFrame:
    """Stations of a city; pass values, or one frame with ``state`` and ``city`` columns."""
    sel = {"state": state, "city": city} if isinstance(state, str) else state.select("state", "city")
    return distinct_sorted(_bind(locations, sel), "station", descending=True)


def picker_dates(table: DataFrame, time_col: str = "measurement_time", selection: DataFrame | None = None,
                 **where) -> DataFrame:
    """Distinct days, latest first; restricted by literal ``where`` values or a one-row
    ``selection`` frame (e.g. state and city)."""
    t = _bind(table, selection) if selection is not None else (_bind(table, where) if where else table)
    return distinct_sorted(t, F.to_date(time_col), name="measurement_date", descending=True)


# -- trends ------------------------------------------------------------------

def station_trend(fact: DataFrame, dates: DataFrame, locations: DataFrame,
                  state, city=None, station=None, day=None) -> DataFrame:
    """Hourly readings of one station on one day (15 columns), in time order.

    Pass the four values, or ``state`` as a one-row frame (state, city, station) and
    ``day`` as a one-row frame (measurement_date), e.g. the default selections.
    """
    on_day = {"measurement_date": F.to_date("measurement_time")}
    if isinstance(day, DataFrame):
        d = _bind(dates, day.select("measurement_date"), on_day)
    else:
        d = _bind(dates, {"measurement_date": F.lit(day).cast("date")}, on_day)
    loc_sel = state.select("state", "city", "station") if isinstance(state, DataFrame) else \
        {"state": state, "city": city, "station": station}
    loc = _bind(locations, loc_sel)
    f = fact
    if "measurement_date" in fact.columns:
        # prune the stored fact to the day's partition: a literal, or the one-row frame
        # as a scalar subquery, becomes a partition filter (evaluated before the listing)
        d_val = day.select("measurement_date").scalar() if isinstance(day, DataFrame) else \
            F.lit(day).cast("date")
        f = fact.filter(F.col("measurement_date") == d_val).drop("measurement_date")
    j = (f.join(d, d["date_pk"] == f["date_fk"], "inner")
          .join(loc, loc["location_pk"] == f["location_fk"], "inner"))
    return (j.orderBy("measurement_time")
             .select(F.hour("measurement_time").cast("int").alias("hour"), "state", "city", "station",
                     F.col("latitude").cast("decimal(10,7)").alias("latitude"),
                     F.col("longitude").cast("decimal(10,7)").alias("longitude"),
                     *WIDE_COLUMNS, "prominent_pollutant", "aqi"))


def city_trend(hour_level: DataFrame, state, city=None, day=None) -> DataFrame:
    """Hourly city averages of one day, in time order.

    Pass the values, or one frame with ``state``, ``city`` and ``measurement_date``.
    """
    on_day = {"measurement_date": F.to_date("measurement_time")}
    if "measurement_date" in hour_level.columns:
        # stored hour level: prune to the day's partition (literal or scalar subquery)
        d_val = state.select("measurement_date").scalar() if isinstance(state, DataFrame) else \
            F.lit(day).cast("date")
        hour_level = hour_level.filter(F.col("measurement_date") == d_val).drop("measurement_date")
    if isinstance(state, DataFrame):
        t = _bind(hour_level, state.select("state", "city", "measurement_date"), on_day)
    else:
        t = _bind(hour_level, {"state": state, "city": city,
                               "measurement_date": F.lit(day).cast("date")}, on_day)
    return (t.orderBy("measurement_time")
             .select(F.hour("measurement_time").cast("int").alias("hour"), *WIDE_COLUMNS))


# -- latest slices -----------------------------------------------------------

def top_cities_latest_day(day_level: DataFrame, n: int = 10, dates: DataFrame | None = None) -> DataFrame:
    """The ``n`` worst cities (by AQI) of the latest day; ties broken by state, city.

    With ``dates`` the latest day comes from the date dimension, so a day level that is not
    stored is computed for that day only.
    """
    order = [F.col("aqi").desc(), F.col("state").asc(), F.col("city").asc()]
    if dates is None:
        top = top_n_on_latest(day_level, "measurement_date", n, order)
    else:
        top = day_level.filter(F.col("measurement_date") == default_day(dates).scalar()).orderBy(*order).limit(n)
    return top.select("state", "city", *WIDE_COLUMNS, "prominent_pollutant", "aqi")


def latest_map(fact: DataFrame, dates: DataFrame, locations: DataFrame) -> DataFrame:
    """(latitude, longitude, aqi) of every station in the latest hour.

    The latest key is an uncorrelated scalar subquery over the date dimension.
    """
    if "measurement_date" in fact.columns:
        # stored fact: read only the latest day's partition (scalar-subquery partition filter)
        fact = fact.filter(F.col("measurement_date") == default_day(dates).scalar()).drop("measurement_date")
    f = fact.filter(F.col("date_fk") == latest_key(dates, "date_pk", "measurement_time").scalar())
    j = f.join(locations, locations["location_pk"] == f["location_fk"], "inner")
    return j.select(F.col("latitude").cast("double").alias("lat"),
                    F.col("longitude").cast("double").alias("lon"), "aqi")


def series_between(day_weather: DataFrame, start, end, **where) -> DataFrame:
    """(measurement_date, aqi, temperature_in_f) for a closed date range, in date order."""
    cond = F.col("measurement_date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    if where:
        cond &= _eq(**where)
    return (day_weather.filter(cond).orderBy("measurement_date")
            .select("measurement_date", "aqi", "temperature_in_f"))


# -- data quality ------------------------------------------------------------

def location_key_duplicates(locations: DataFrame) -> DataFrame:
    """Location keys shared by more than one station description (they fan out the star
    join): coordinates, number of descriptions and the first / last station name. One
    partial aggregate by key; no group is collected."""
    return (locations.groupBy("location_pk")
            .agg(F.min("latitude").alias("latitude"), F.min("longitude").alias("longitude"),
                 F.count(F.lit(1)).alias("descriptions"),
                 F.min("station").alias("first_station"), F.max("station").alias("last_station"))
            .filter(F.col("descriptions") > 1)
            .drop("location_pk"))


# -- chart frames ------------------------------------------------------------

def chart_frames(trend: DataFrame) -> dict[str, DataFrame]:
    """The three frames a station trend is drawn from: AQI line, pollutant bars, map."""
    return {
        "aqi": trend.select("hour", "aqi"),
        "pollutants": trend.select("hour", *WIDE_COLUMNS),
        "map": trend.select(F.col("latitude").cast("double").alias("lat"),
                            F.col("longitude").cast("double").alias("lon")),
    }
