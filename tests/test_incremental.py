"""An incremental refresh gives the tables that a full rebuild gives."""

import datetime

import pytest
from pyspark.sql import functions as F

from airlake.plans import graph as G
from airlake.sources.landing import documents_from_records, write_landing
from airlake.streaming.ingest import ingest

NAMES = ("t string, country string, state string, city string, station string, last_update string, latitude string, "
         "longitude string, pollutant_id string, pollutant_min string, pollutant_max string, pollutant_avg string")


def readings(spark, rows):
    """Records from (hour, city, station, latitude, value)."""
    full = [(t, "India", "K", city, station, datetime.datetime.fromisoformat(t).strftime("%d-%m-%Y %H:%M:%S"), lat, "2.0",
             p, "1", "99", str(int(value) + k)) for t, city, station, lat, value in rows for k, p in enumerate(("PM10", "PM2.5", "SO2", "NO2"))]
    return spark.createDataFrame(full, NAMES).withColumn("index_record_ts", F.col("t").cast("timestamp_ntz")).drop("t")


def snapshot(df):
    return sorted((tuple(map(str, r)) for r in df.select(sorted(df.columns)).collect()))


BASE = [("2024-03-01 10:00:00", "A", "s1", "1.0", 10), ("2024-03-01 10:00:00", "B", "s2", "2.0", 20),
        ("2024-03-02 10:00:00", "A", "s1", "1.0", 30), ("2024-03-02 10:00:00", "B", "s2", "2.0", 40), ("2024-03-03 11:00:00", "A", "s1", "1.0", 50)]
CHANGES = {
    "values": [("2024-03-01 10:00:00", "A", "s1", "1.0", 70), ("2024-03-01 10:00:00", "B", "s2", "2.0", 21)],
    "a station renamed into another city": [("2024-03-02 10:00:00", "C", "s1", "1.0", 31), ("2024-03-02 10:00:00", "B", "s2", "2.0", 40)],
    "a description that goes": [("2024-03-01 10:00:00", "A", "s1", "1.0", 10)],
    "coordinates that move": [("2024-03-03 11:00:00", "A", "s1", "7.5", 51)],
    "a day without weather": [("2024-03-03 11:00:00", "Z", "s1", "1.0", 50)],
    "a new day and station": [("2024-03-05 09:00:00", "N", "s9", "9.0", 5)],
}


@pytest.mark.parametrize("change", CHANGES)
def test_incremental_equals_full(spark, tmp_path, change):
    run = str(tmp_path)
    landing, raw, weather = f"{run}/landing", f"{run}/raw", f"{run}/weather"
    days = [("India", "K", c, datetime.date(2024, 3, d), 70.0 + d) for c in "AB" for d in (1, 2, 3)]
    G.snapshot_weather(spark.createDataFrame(days, "country string, state string, city string, measurement_dt date, temperature_in_f double"), weather)
    g = G.aqi_pipeline(spark, f"{run}/t", raw, weather_path=weather)

    def deliver(rows, at):
        write_landing(documents_from_records(readings(spark, rows), limit=3, delivered_at=F.lit(at).cast("timestamp")), landing)

    deliver(BASE, "2024-03-06 10:00:00")
    ingest(spark, landing, raw, f"{run}/ck", framing="lines", on_batch=G.incremental_refresh(g))
    deliver(CHANGES[change], "2024-03-06 11:00:00")
    ingest(spark, landing, raw, f"{run}/ck", framing="lines", on_batch=G.incremental_refresh(g))
    full = G.aqi_pipeline(spark, f"{run}/full", raw, weather_path=weather)
    assert full.refresh() == g.order()
    for name in g.order():
        assert snapshot(g.read(name)) == snapshot(full.read(name)), name
    assert g.read("city_day").count() > 0 and g.read("aqi_wide").count() > 0


def test_given_days_are_refreshed_in_runs(spark, tmp_path, monkeypatch):
    run = str(tmp_path)
    landing, raw = f"{run}/landing", f"{run}/raw"
    g = G.aqi_pipeline(spark, f"{run}/t", raw)
    write_landing(documents_from_records(readings(spark, BASE), limit=3, delivered_at=F.lit("2024-03-06 10:00:00").cast("timestamp")), landing)
    ingest(spark, landing, raw, f"{run}/ck", framing="lines")
    monkeypatch.setattr(G, "REFRESH_DAYS", 2)
    sizes, files = [], g._files
    monkeypatch.setattr(g, "_files", lambda t, days: (t.by_day_runs and sizes.append(len(days)), files(t, days))[1])
    g.refresh(days=[datetime.date(2024, 3, d) for d in (1, 2, 3)])
    assert 1 in sizes and max(sizes) == 2
    full = G.aqi_pipeline(spark, f"{run}/full", raw)
    full.refresh()
    for name in g.order():
        assert snapshot(g.read(name)) == snapshot(full.read(name)), name


def test_weather_side_refreshes_its_consumers(spark, tmp_path):
    run = str(tmp_path)
    g = G.aqi_pipeline(spark, f"{run}/t", f"{run}/raw", weather_path=f"{run}/weather")
    schema = "country string, state string, city string, measurement_dt date, temperature_in_f double"
    day = lambda d, f: spark.createDataFrame([("India", "K", "A", datetime.date(2024, 3, d), f)], schema)
    G.snapshot_weather(day(1, 71.0), f"{run}/weather", g)                   # nothing else is stored yet
    write_landing(documents_from_records(readings(spark, BASE), delivered_at=F.lit("2024-03-06 10:00:00").cast("timestamp")), f"{run}/landing")
    ingest(spark, f"{run}/landing", f"{run}/raw", f"{run}/ck", framing="lines", on_batch=G.incremental_refresh(g))
    got = lambda: {str(r.measurement_date): r.temperature_in_f for r in g.read("city_day_weather").collect()}
    assert got() == {"2024-03-01": 71.0}
    G.append_weather_day(day(2, 72.0), f"{run}/weather", g)
    G.append_weather_day(day(2, 72.5), f"{run}/weather", g)
    assert got() == {"2024-03-01": 71.0, "2024-03-02": 72.5}
    G.snapshot_weather(day(3, 73.0), f"{run}/weather", g)
    assert got() == {"2024-03-03": 73.0}


def test_refresh_reads_only_the_touched_days(spark, tmp_path):
    """Unreadable files in other days of the raw, clean and flattened tables are never met."""
    import glob
    import os

    run = str(tmp_path)
    g = G.aqi_pipeline(spark, f"{run}/t", f"{run}/raw")
    write_landing(documents_from_records(readings(spark, BASE), delivered_at=F.lit("2024-03-06 10:00:00").cast("timestamp")), f"{run}/landing")
    ingest(spark, f"{run}/landing", f"{run}/raw", f"{run}/ck", framing="lines", on_batch=G.incremental_refresh(g))
    for pattern in ("raw/record_day=2024-03-01/*/*", "t/clean/*/measurement_date=2024-03-01", "t/consumption/air_quality_fact/measurement_date=2024-03-01"):
        folders = glob.glob(f"{run}/{pattern}")
        assert folders, pattern
        for folder in folders:
            with open(os.path.join(folder, "part-zzzz.parquet"), "wb") as f:
                f.write(b"not a parquet file")
    g.refresh(days=[datetime.date(2024, 3, 2)])
    assert len(g._versions(g.tables["location_dim"])) == 2                  # the version before is still there for readers


def test_selection_of_several_rows_is_an_error(spark):
    from airlake.plans import views as V

    locations = spark.createDataFrame([("s", "c1", "a"), ("s", "c2", "b")], "state string, city string, station string")
    with pytest.raises(Exception, match="SCALAR_SUBQUERY_TOO_MANY_ROWS"):
        V.picker_cities(locations, locations.select("state")).collect()


def test_a_refresh_reads_no_days_of_untouched_months(spark, tmp_path):
    """Unreadable files in ``location_days`` of other months: new values never meet them, and a
    renamed station is looked up only in the months that hold it."""
    run = str(tmp_path)
    landing, raw = f"{run}/landing", f"{run}/raw"
    g = G.aqi_pipeline(spark, f"{run}/t", raw)
    at = iter(f"2024-06-01 1{k}:00:00" for k in range(9))

    def deliver(*rows):
        write_landing(documents_from_records(readings(spark, list(rows)), limit=3, delivered_at=F.lit(next(at)).cast("timestamp")), landing)
        ingest(spark, landing, raw, f"{run}/ck", framing="lines", on_batch=G.incremental_refresh(g))

    january = ("2024-01-10 10:00:00", "A", "s1", "1.0", 10)
    deliver(january, ("2024-02-10 10:00:00", "B", "s2", "2.0", 20), ("2024-03-10 10:00:00", "A", "s1", "1.0", 30), ("2024-04-10 10:00:00", "B", "s2", "2.0", 40))

    def spoil(day):
        (tmp_path / f"t/consumption/location_days/measurement_date={day}/part-00000-spoiled.parquet").write_bytes(b"not a table")

    spoil("2024-02-10")
    deliver(("2024-03-10 10:00:00", "A", "s1", "1.0", 33))
    assert g.read("city_day").where("measurement_date = DATE'2024-03-10'").first()["pm10_avg"] == 33
    deliver(("2024-03-10 10:00:00", "C", "s1", "1.0", 34))         # the place has two descriptions now
    assert {r.city for r in g.read("location_dim").collect()} == {"A", "B", "C"}
    # the days of that place, in January too, have both
    assert {(str(r.measurement_date), r.city) for r in g.read("city_day").collect()} == {
        ("2024-01-10", "A"), ("2024-01-10", "C"), ("2024-02-10", "B"), ("2024-03-10", "A"), ("2024-03-10", "C"), ("2024-04-10", "B")}
    spoil("2024-01-10")
    deliver(("2024-04-10 10:00:00", "B", "s2", "2.0", 44))
    assert g.read("city_day").where("measurement_date = DATE'2024-04-10'").first()["pm10_avg"] == 44


def test_a_lake_without_months_gets_all_of_them(spark, tmp_path):
    import shutil

    run = str(tmp_path)
    landing, raw = f"{run}/landing", f"{run}/raw"
    g = G.aqi_pipeline(spark, f"{run}/t", raw)
    write_landing(documents_from_records(readings(spark, BASE), limit=3, delivered_at=F.lit("2024-03-06 10:00:00").cast("timestamp")), landing)
    ingest(spark, landing, raw, f"{run}/ck", framing="lines", on_batch=G.incremental_refresh(g))
    before = snapshot(g.read("location_dim"))
    shutil.rmtree(f"{run}/t/consumption/location_months")
    g.refresh(days=[datetime.date(2024, 3, 3)])
    assert snapshot(g.read("location_dim")) == before
