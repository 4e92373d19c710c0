"""The dashboards' parameterised selections as SQL table functions.

``register_dashboards(spark)`` creates session-scoped table functions over the layer tables'
views (``TableGraph.register_views``), for users who write SQL::

    SELECT * FROM station_day('Delhi', 'Delhi', 'ITO', DATE'2024-03-01') ORDER BY hour
    spark.sql("SELECT * FROM city_stations(:state, :city) ORDER BY station DESC", args={...})

The bodies are SQL: Catalyst inlines them, so a literal, a marker or a scalar subquery as argument
becomes an ordinary filter, and a day a partition filter of the stored table. A table function has
no order of its own (``top_cities`` has a limit, though); put ``ORDER BY`` behind it. An argument that is
null, or names nothing, gives no rows. A function sees the views as they are when it is called.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from airlake.schemas import WIDE_COLUMNS

_WIDE = ", ".join(WIDE_COLUMNS)
_DERIVED = "prominent_pollutant, aqi"
_LATEST = "(SELECT max(to_date(measurement_time)) FROM date_dim)"

#: Name and parameters of each function, and its body.
DASHBOARDS = {
    "feed_states()": "SELECT DISTINCT state FROM location_dim",
    "state_cities(of_state STRING)": "SELECT DISTINCT city FROM location_dim WHERE state = of_state",
    "city_stations(of_state STRING, of_city STRING)": "SELECT DISTINCT station FROM location_dim WHERE state = of_state AND city = of_city",
    "feed_days()": "SELECT DISTINCT to_date(measurement_time) AS measurement_date FROM date_dim",
    "city_days(of_state STRING, of_city STRING)":
        "SELECT DISTINCT to_date(measurement_time) AS measurement_date FROM agg_city_fact_hour_level WHERE state = of_state AND city = of_city",
    "station_day(of_state STRING, of_city STRING, of_station STRING, on_day DATE)":
        f"SELECT hour(d.measurement_time) AS hour, l.state, l.city, l.station, CAST(l.latitude AS DECIMAL(10,7)) AS latitude, "
        f"CAST(l.longitude AS DECIMAL(10,7)) AS longitude, {_WIDE}, {_DERIVED} "
        "FROM air_quality_fact f JOIN date_dim d ON d.date_pk = f.date_fk JOIN location_dim l ON l.location_pk = f.location_fk "
        "WHERE f.measurement_date = on_day AND to_date(d.measurement_time) = on_day AND l.state = of_state AND l.city = of_city AND l.station = of_station",
    "city_day_hours(of_state STRING, of_city STRING, on_day DATE)":
        f"SELECT hour(measurement_time) AS hour, {_WIDE} FROM agg_city_fact_hour_level "
        "WHERE measurement_date = on_day AND state = of_state AND city = of_city",
    "top_cities()":
        f"SELECT state, city, {_WIDE}, {_DERIVED} FROM agg_city_fact_day_level WHERE measurement_date = {_LATEST} "
        "ORDER BY aqi DESC, state, city LIMIT 10",
    "latest_hour_map()":
        "SELECT CAST(l.latitude AS DOUBLE) AS lat, CAST(l.longitude AS DOUBLE) AS lon, f.aqi "
        "FROM air_quality_fact f JOIN location_dim l ON l.location_pk = f.location_fk "
        f"WHERE f.measurement_date = {_LATEST} AND f.date_fk = (SELECT max_by(date_pk, measurement_time) FROM date_dim)",
    "aqi_and_temperature(first_day DATE, last_day DATE)":
        "SELECT measurement_date, aqi, temperature_in_f FROM agg_delhi_fact_day_level WHERE measurement_date BETWEEN first_day AND last_day",
}
#: The views that a function needs beyond the dimensions.
_NEEDS = ("air_quality_fact", "agg_city_fact_hour_level", "agg_city_fact_day_level", "agg_delhi_fact_day_level")


def register_dashboards(spark: SparkSession) -> list[str]:
    """Create the functions whose views are there; their names."""
    views = {t.name for t in spark.catalog.listTables() if t.isTemporary}
    done = []
    for head, body in DASHBOARDS.items():
        needed = {v for v in (*_NEEDS, "date_dim", "location_dim") if v in body}
        if needed <= views:
            spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURNS TABLE RETURN {body}")
            done.append(head.partition("(")[0])
    return done
