"""Weather snapshot (create-or-replace), daily append (idempotent) and the enriched day table."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from airlake.plans import graph as G
from airlake.plans import products as P
from airlake.sources import testbed as TB
from airlake.streaming.ingest import ingest
from conftest import SF_SMALL


def test_snapshot_and_daily_append(spark, tmp_path):
    src = TB.weather_source(spark, SF_SMALL)
    path = str(tmp_path / "weather")
    labels = ("India", "Delhi", "Delhi")
    G.snapshot_weather(P.weather_data(src, "ASIA", "1995-01-01", "1997-12-31", labels=labels), path)
    before = spark.read.parquet(path).count()
    day = P.weather_data(src, "ASIA", "1998-01-01", "1998-01-01", labels=labels)
    G.append_weather_day(day, path)
    G.append_weather_day(day, path)                      # re-run: the day is replaced, not doubled
    after = spark.read.parquet(path)
    assert after.count() == before + day.count()
    assert after.filter(F.col("measurement_dt") == F.lit("1998-01-01").cast("date")).count() == day.count()
    G.snapshot_weather(P.weather_data(src, "ASIA", "1995-01-01", "1995-12-31", labels=labels), path)
    assert spark.read.parquet(path).select(F.max("measurement_dt")).first()[0].year == 1995


def test_enriched_day_table_in_graph(spark, tmp_path):
    run = str(tmp_path)
    E._deliver(spark, TB.feed_records(spark, SF_SMALL), f"{run}/landing", "2024-03-01 10:45:00")
    ingest(spark, f"{run}/landing", f"{run}/raw", f"{run}/ck", framing="lines")
    G.snapshot_weather(P.weather_data(TB.weather_source(spark, SF_SMALL), None), f"{run}/weather")
    g = G.aqi_pipeline(spark, f"{run}/t", f"{run}/raw", weather_path=f"{run}/weather")
    done = g.refresh("city_day_weather")
    assert done[-1] == "city_day_weather" and "city_day" in done
    got = g.read("city_day_weather").drop("measurement_date").count()
    want = E.q_weather_join(spark, SF_SMALL).count()
    assert got == want > 0
    names = g.register_views()
    assert "agg_delhi_fact_day_level" in names
    assert spark.sql("SELECT count(*) FROM agg_city_fact_day_level").first()[0] > 0


def test_one_row_per_day_option(spark):
    src = TB.weather_source(spark, SF_SMALL)
    labels = ("India", "Delhi", "Delhi")
    many = P.weather_data(src, "ASIA", "1995-01-01", F.current_date(), labels=labels)
    one = P.weather_data(src, "ASIA", "1995-01-01", F.current_date(), labels=labels, agg_per_day=True)
    assert many.count() > one.count() == one.select("measurement_dt").distinct().count() > 0
    r = one.orderBy("measurement_dt").first()
    want = (src.filter((F.col("country") == "ASIA") & (F.col("date_valid_std") == r.measurement_dt))
            .agg(F.avg("avg_temperature_air_2m_f")).first()[0])
    assert abs(r.temperature_in_f - want) < 1e-9 and (r.country, r.state, r.city) == labels


def test_sql_over_registered_views_matches_views(spark, tmp_path):
    from airlake.functions.sql import register_functions
    from airlake.plans import views as V
    run = str(tmp_path)
    E._deliver(spark, TB.feed_records(spark, SF_SMALL), f"{run}/landing", "2024-03-01 10:45:00")
    ingest(spark, f"{run}/landing", f"{run}/raw", f"{run}/ck", framing="lines")
    g = G.aqi_pipeline(spark, f"{run}/t", f"{run}/raw")
    g.refresh()
    g.register_views()
    register_functions(spark)
    top = spark.sql("""
        SELECT state, city, aqi FROM agg_city_fact_day_level
        WHERE measurement_date = (SELECT max(measurement_date) FROM agg_city_fact_day_level)
        ORDER BY aqi DESC, state, city LIMIT 10""")
    want = V.top_cities_latest_day(g.read("city_day")).select("state", "city", "aqi")
    assert [tuple(r) for r in top.collect()] == [tuple(r) for r in want.collect()]
    # the whole-number rules as SQL functions over the stored station-hour table
    wide = spark.sql("""
        SELECT count(*) FROM aqi_final_wide_dt
        WHERE prominent_index(pm25_avg, pm10_avg, so2_avg, no2_avg, nh3_avg, co_avg, o3_avg)
              <> prominent_pollutant""").first()[0]
    assert wide == 0
