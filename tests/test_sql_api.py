"""SQL users: the rules as SQL functions, the stored tables under their SQL names."""

from airlake.functions.sql import register_functions


def test_sql_functions_match_rules(spark):
    register_functions(spark)
    r = spark.sql("SELECT prominent_index(89,70,12,4,17,47,3) AS p, "
                  "three_sub_index_criteria(89,70,12,4,17,47,3) AS n, "
                  "prominent_index(0,0,5,5,5,5,5) AS p2, three_sub_index_criteria(5,0,0,0,0,0,3) AS n2, "
                  "get_int('12') AS g, get_int('NA') AS g2, get_int(NULL) AS g3, "
                  "three_sub_index_criteria(0.4, 12.6, 0.4, 3, 0, 0, 0) AS n3").first()
    assert (r.p, int(r.n), r.p2, int(r.n2), int(r.g), int(r.g2), int(r.g3)) == ("PM25", 3, "SO2", 2, 12, 0, 0)
    assert int(r.n3) == 2          # 0.4 rounds to 0 on the way in
    plan = spark.sql("SELECT prominent_index(1,2,3,4,5,6,7)")._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan


def test_dashboards_as_table_functions(spark, tmp_path):
    import datetime

    from airlake.plans import views as V
    from airlake.plans.dashboards import DASHBOARDS, register_dashboards

    day, old = datetime.date(2024, 3, 2), datetime.date(2024, 3, 1)
    at = lambda d, h: datetime.datetime(d.year, d.month, d.day, h)
    wide = "pm25_avg long, pm10_avg long, so2_avg long, no2_avg long, nh3_avg long, co_avg long, o3_avg long, prominent_pollutant string, aqi long"
    values = lambda k: [k, k + 1, 0, 0, 0, 0, 2, "PM10", k]
    dates = spark.createDataFrame([(d.day * 100 + h, at(d, h)) for d in (old, day) for h in (1, 2)], "date_pk long, measurement_time timestamp_ntz")
    places = spark.createDataFrame([(7, "India", "K's", "A", "s1", 1.5, 2.5), (8, "India", "K's", "B", "s2", 3.5, 4.5), (9, "India", "L", "A", "s3", 5.0, 6.0)],
                                   "location_pk long, country string, state string, city string, station string, latitude double, longitude double")
    fact = spark.createDataFrame([(d.day * 100 + h, p, *values(d.day * 10 + h + p), d) for d in (old, day) for h in (1, 2) for p in (7, 8, 9)],
                                 f"date_fk long, location_fk long, {wide}, measurement_date date")
    fact.write.partitionBy("measurement_date").parquet(f"{tmp_path}/fact")
    fact = spark.read.parquet(f"{tmp_path}/fact")
    level = spark.createDataFrame([(at(d, h), "K's", "A", *values(d.day), d) for d in (old, day) for h in (1, 2)],
                                  f"measurement_time timestamp_ntz, state string, city string, {wide}, measurement_date date")
    by_day = spark.createDataFrame([(d, "K's", f"c{k:02d}", *values(k // 2)) for d in (old, day) for k in range(14)], f"measurement_date date, state string, city string, {wide}")
    for name, df in {"date_dim": dates, "location_dim": places, "air_quality_fact": fact, "agg_city_fact_hour_level": level, "agg_city_fact_day_level": by_day}.items():
        df.createOrReplaceTempView(name)
    spark.catalog.dropTempView("agg_delhi_fact_day_level")
    done = register_dashboards(spark)
    assert set(done) == {h.partition("(")[0] for h in DASHBOARDS} - {"aqi_and_temperature"}
    rows = lambda sql, **args: [tuple(r) for r in spark.sql(sql, args=args).collect()]
    got = lambda df: [tuple(r) for r in df.collect()]
    chosen = {"s": "K's", "c": "A", "st": "s1", "d": day}
    trend = V.station_trend(fact, dates, places, "K's", "A", "s1", day)
    assert rows("SELECT * FROM station_day(:s, :c, :st, :d) ORDER BY hour", **chosen) == got(trend) and trend.count() == 2
    assert rows("SELECT * FROM station_day(:s, NULL, :st, :d)", s="K's", st="s1", d=day) == [] == rows("SELECT * FROM state_cities('''; DROP')")
    assert rows("SELECT * FROM city_day_hours(:s, :c, :d) ORDER BY hour", s="K's", c="A", d=day) == got(V.city_trend(level, "K's", "A", day))
    assert rows("SELECT * FROM top_cities()") == got(V.top_cities_latest_day(by_day))
    assert sorted(rows("SELECT * FROM latest_hour_map()")) == sorted(got(V.latest_map(fact, dates, places)))
    assert rows("SELECT * FROM city_stations(:s, :c) ORDER BY 1 DESC", s="K's", c="A") == got(V.picker_stations(places, "K's", "A"))
    assert rows("SELECT * FROM city_days(:s, :c) ORDER BY 1 DESC", s="K's", c="A") == [(day,), (old,)]
    # joined with each row of a table, and a day as a filter on partitions
    assert sorted(rows("SELECT f.state, c.city FROM feed_states() f, LATERAL state_cities(f.state) c")) == [("K's", "A"), ("K's", "B"), ("L", "A")]
    plan = spark.sql("SELECT * FROM station_day('K''s', 'A', 's1', DATE'2024-03-02')")._jdf.queryExecution().executedPlan().toString()
    assert "measurement_date" in plan.split("PartitionFilters: [")[1].split("]")[0] and "2024-03-02" in plan or "19784" in plan
    # an unreadable file in another day does no harm
    for f in (tmp_path / "fact" / "measurement_date=2024-03-01").glob("*.parquet"):
        f.write_bytes(b"not a table")
    assert rows("SELECT * FROM station_day(:s, :c, :st, :d) ORDER BY hour", **chosen) == got(trend)
    day_weather = spark.createDataFrame([(d, k, 70.0) for d, k in ((old, 1), (day, 2))], "measurement_date date, aqi int, temperature_in_f double")
    day_weather.createOrReplaceTempView("agg_delhi_fact_day_level")
    assert "aqi_and_temperature" in register_dashboards(spark)
    assert rows("SELECT * FROM aqi_and_temperature(DATE'2024-03-02', DATE'2024-03-09')") == [(day, 2, 70.0)]
