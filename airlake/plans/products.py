"""The table products of the pipeline, each a pure function ``inputs -> DataFrame``.

raw -> clean (dedupe + unnest) -> flatten (pivot + clean-up) -> {wide, date_dim,
location_dim, fact} -> city_hour -> city_day -> (+ weather) city_day_weather.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airlake.functions import calendar, na_to_zero, surrogate_key, with_aqi
from airlake.operators import pivot_max
from airlake.schemas import MISSING, POLLUTANT_COLUMNS, STATION_KEYS, STORED_COLUMNS, WIDE_COLUMNS


def pivot_pollutants(clean: DataFrame, numeric: bool = False) -> DataFrame:
    """Long readings -> one row per station-hour, the seven readings as text (text max).

    ``numeric=True`` (opt-in, not the original semantics): 'NA' counts as missing and the
    largest *number* wins ('10' over '9', a number over 'NA'). The values are then
    fixed-width decimals and Spark aggregates by hashing instead of sorting.
    """
    if not numeric:
        return pivot_max(clean, STATION_KEYS, "pollutant_id", "pollutant_avg", POLLUTANT_COLUMNS)
    v = F.col("pollutant_avg")
    num = clean.withColumn("__v", F.when(v.isNull() | (v == F.lit(MISSING)), F.lit(None))
                           .otherwise(v.cast("decimal(38,9)")))
    return pivot_max(num, STATION_KEYS, "pollutant_id", "__v", POLLUTANT_COLUMNS, hash_lead=False)


def clean_flatten(clean: DataFrame, numeric: bool = False) -> DataFrame:
    """Pivot, then NULL/'NA' -> 0 and half-up rounding; '_' in state becomes a space."""
    p = pivot_pollutants(clean, numeric)
    return p.select(
        "index_record_ts", "country", F.replace("state", F.lit("_"), F.lit(" ")).alias("state"),
        "city", "station", "latitude", "longitude",
        *[(_numeric_to_whole(c) if numeric else na_to_zero(c)).alias(c) for c in WIDE_COLUMNS],
    )


def _numeric_to_whole(c: str) -> F.Column:
    return F.coalesce(F.round(F.col(c), 0), F.lit(0)).cast("bigint")


def aqi_wide(flat: DataFrame) -> DataFrame:
    """Denormalised station-hour table with calendar parts, prominent pollutant and AQI."""
    cal = calendar("index_record_ts")
    out = flat.select(
        "index_record_ts", *[v.alias(k) for k, v in cal.items()],
        "country", "state", "city", "station", "latitude", "longitude", *STORED_COLUMNS,
    )
    return with_aqi(out)


def date_dim(flat: DataFrame) -> DataFrame:
    """Distinct hours with calendar parts (hour is 1..24) and a hash key."""
    cal = calendar("measurement_time", hour_offset=1)
    hours = flat.select(F.col("index_record_ts").alias("measurement_time")).distinct()
    return hours.select(surrogate_key("measurement_time").alias("date_pk"), "measurement_time",
                        *[v.alias(k) for k, v in cal.items()])


LOCATION_COLUMNS = ["latitude", "longitude", "country", "state", "city", "station"]


def location_dim(flat: DataFrame) -> DataFrame:
    """Distinct station descriptions; the key hashes the coordinates only."""
    return (flat.select(*LOCATION_COLUMNS).distinct()
            .select(surrogate_key("latitude", "longitude").alias("location_pk"), *LOCATION_COLUMNS))


def location_days(flat: DataFrame) -> DataFrame:
    """Station descriptions of each day, keyed as in the location dimension."""
    return (flat.select(F.to_date("index_record_ts").alias("measurement_date"), *LOCATION_COLUMNS).distinct()
            .select("measurement_date", surrogate_key("latitude", "longitude").alias("location_pk"), *LOCATION_COLUMNS))


def air_quality_fact(flat: DataFrame, with_date: bool = True) -> DataFrame:
    """Station-hour facts keyed by hashes of (time, coordinates).

    ``measurement_date`` is carried as the partition column of the stored table (day
    pruning and touched-day refresh); it is not part of the fact's logical schema.
    """
    cols = [
        surrogate_key("index_record_ts", "latitude", "longitude").alias("aqi_pk"),
        surrogate_key("index_record_ts").alias("date_fk"),
        surrogate_key("latitude", "longitude").alias("location_fk"),
        *STORED_COLUMNS,
    ]
    if with_date:
        cols.append(F.to_date("index_record_ts").alias("measurement_date"))
    return with_aqi(flat.select(*cols))


def star(fact: DataFrame, dates: DataFrame, locations: DataFrame) -> DataFrame:
    """fact ⋈ date_dim ⋈ location_dim on the hash keys (inner; duplicate keys fan out).

    The planner picks the strategy: the dimensions grow with hours and stations, not
    with readings, so they normally fall under the size-checked broadcast threshold
    (AQE re-checks at run time); otherwise sort-merge with skew splitting.
    """
    f = fact.drop("measurement_date") if "measurement_date" in fact.columns else fact
    return (f.join(dates, f["date_fk"] == dates["date_pk"], "inner")
             .join(locations, f["location_fk"] == locations["location_pk"], "inner"))


def city_hour(fact: DataFrame, dates: DataFrame, locations: DataFrame,
              keys: Sequence[str] = ("country", "state", "city"), round_inputs: bool = True) -> DataFrame:
    """City averages per hour (unrounded), prominent pollutant and AQI.

    ``round_inputs``: the sub-index and prominent rules see whole numbers, ``greatest``
    the fractions (see README, "whole-number rule arguments").

    A location key that n descriptions share has n times the facts, and each of them joins all n.
    So the facts of an hour and key become one row before the star join (their means and numbers),
    and its descriptions in one city another (their number): the same averages without the n * n
    rows. A mean of whole numbers gives back their sum, which is whole, so no digit is lost.
    """
    whole = {f.name for f in fact.schema if isinstance(f.dataType, T.IntegralType)}
    at_key = fact.groupBy("date_fk", "location_fk").agg(
        *[F.avg(c).alias(c) for c in STORED_COLUMNS], *[F.count(c).alias(f"{c}_n") for c in STORED_COLUMNS])
    sums = at_key.withColumns({c: F.rint(F.col(c) * F.col(f"{c}_n")) if c in whole else F.col(c) * F.col(f"{c}_n") for c in STORED_COLUMNS})
    places = locations.groupBy("location_pk", *keys).agg(F.count(F.lit(1)).alias("__places"))
    s = star(sums, dates, places)
    total = lambda c: F.sum(F.col(c) * F.col("__places"))
    agg = s.groupBy("measurement_time", *keys).agg(
        *[(total(c) / F.nullif(total(f"{c}_n"), F.lit(0))).alias(c) for c in STORED_COLUMNS])
    return with_aqi(agg, round_inputs=round_inputs)


def round_avg(c: str) -> F.Column:
    """Half-up whole-number average, taken on a 6-place fixed-point value of the mean."""
    return F.round(F.avg(c).cast("decimal(38,6)"), 0).cast("bigint")


def city_day(hour_level: DataFrame) -> DataFrame:
    """Day averages of the hourly city averages, rounded; prominent pollutant and AQI."""
    agg = (hour_level.groupBy(F.to_date("measurement_time").alias("measurement_date"),
                              "country", "state", "city")
           .agg(*[round_avg(c).alias(c) for c in STORED_COLUMNS]))
    return with_aqi(agg)


def weather_data(source: DataFrame, country_code: str | None, start=None, end=None, *,
                 start_inclusive: bool = True, labels: tuple[str, str, str] | None = None,
                 place_cols: tuple[str, str, str] = ("country", "state", "city"),
                 agg_per_day: bool = False) -> DataFrame:
    """Daily temperature rows of one source country.

    The filter runs on the *source* columns (``country`` there is a code) before the
    projection; ``labels`` stamps constant (country, state, city) names as the original
    table did, otherwise the source's own place columns are kept, '_' in state -> ' '.
    ``country_code=None`` keeps every source country. ``end`` may be a Column (e.g.
    ``F.current_date()``). ``agg_per_day`` (with ``labels``): one row per day, the mean of
    the source rows, so a source with many places per country cannot fan out the join.
    """
    d = F.col("date_valid_std")
    cond = F.lit(True) if country_code is None else F.col("country") == F.lit(country_code)
    if start is not None:
        cond &= (d >= F.lit(start).cast("date")) if start_inclusive else (d > F.lit(start).cast("date"))
    if end is not None:
        cond &= d <= F.lit(end).cast("date")
    src = source.filter(cond)
    if labels is not None and agg_per_day:
        src = src.groupBy("date_valid_std").agg(
            F.avg("avg_temperature_air_2m_f").alias("avg_temperature_air_2m_f"))
    if labels is not None:
        place = [F.lit(v).alias(n) for v, n in zip(labels, ("country", "state", "city"))]
    else:
        c, s, t = place_cols
        place = [F.col(c).alias("country"), F.replace(F.col(s), F.lit("_"), F.lit(" ")).alias("state"),
                 F.col(t).alias("city")]
    return src.select(*place, d.alias("measurement_dt"),
                      F.col("avg_temperature_air_2m_f").alias("temperature_in_f"))


def city_day_weather(day_level: DataFrame, weather: DataFrame) -> DataFrame:
    """Day-level city rows enriched with the temperature of the same day and place."""
    a, t = day_level.alias("a"), weather.alias("t")
    cond = [F.col("a.measurement_date") == F.col("t.measurement_dt"),
            F.col("a.country") == F.col("t.country"), F.col("a.state") == F.col("t.state"),
            F.col("a.city") == F.col("t.city")]
    return a.join(t, cond, "inner").select(
        "a.measurement_date", "a.country", "a.state", "a.city",
        *[f"a.{c}" for c in STORED_COLUMNS],
        "t.temperature_in_f", "a.prominent_pollutant", "a.aqi")
