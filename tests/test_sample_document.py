"""The feed's sample hour end to end: landing file -> raw -> ... -> day level (FIXTURES §1)."""

import json
import os

from airlake.plans import graph as G
from airlake.streaming.ingest import ingest

# The seven readings of the feed's sample document (one station, one hour).
STATION = ("India", "Karnataka", "Bengaluru", "Silk Board, Bengaluru - KSPCB", "12.917348", "77.622813")
READINGS = {"PM10": "75", "PM2.5": "40", "OZONE": "13", "SO2": "7", "CO": "8", "NO2": "20", "NH3": "4"}


def sample_document():
    country, state, city, station, lat, lon = STATION
    recs = [{"country": country, "state": state, "city": city, "station": station,
             "last_update": "30-12-2023 07:00:00", "latitude": lat, "longitude": lon,
             "pollutant_id": pid, "pollutant_min": "1", "pollutant_max": "200", "pollutant_avg": avg}
            for pid, avg in READINGS.items()]
    return {"created": 1697709635, "updated": 1703143837, "active": 1, "version": "2.2.0",
            "status": "ok", "total": 3330, "count": 3330, "limit": "4000", "offset": "0",
            "field": list(recs[0]), "records": recs}


def test_sample_hour_through_the_pipeline(spark, tmp_path):
    landing = tmp_path / "landing" / "2023_12_30"
    os.makedirs(landing)
    (landing / "air_quality_data_2023_12_30_07_45_00.json").write_text(json.dumps(sample_document(), indent=2))
    raw = str(tmp_path / "raw")
    ingest(spark, str(tmp_path / "landing"), raw, str(tmp_path / "ck"))
    r = spark.read.parquet(raw).first()
    assert (str(r.index_record_ts), r.record_count, r.json_version) == ("2023-12-30 07:00:00", 3330, "2.2.0")
    assert r._stg_file_name == "2023_12_30/air_quality_data_2023_12_30_07_45_00.json"

    g = G.aqi_pipeline(spark, str(tmp_path / "tables"), raw)
    assert "aqi_wide" not in g.order("city_day")            # not an ancestor of the day level
    g.refresh()                                             # every table
    w = g.read("aqi_wide").first()
    assert (w.pm10_avg, w.pm25_avg, w.o3_avg, w.so2_avg, w.co_avg, w.no2_avg, w.nh3_avg) == (75, 40, 13, 7, 8, 20, 4)
    assert (w.prominent_pollutant, w.aqi, w.aqi_hour, w.aqi_quarter) == ("PM10", 75, 7, 4)
    assert str(w.latitude) == "12.9173480"
    d = g.read("date_dim").first()
    assert d.aqi_hour == 8                                  # hour + 1 in the date dimension
    f = g.read("air_quality_fact").first()
    assert f.date_fk == d.date_pk and f.location_fk == g.read("location_dim").first().location_pk
    h = g.read("city_hour").first()
    assert (h.city, h.pm10_avg, h.prominent_pollutant, h.aqi) == ("Bengaluru", 75.0, "PM10", 75.0)
    day = g.read("city_day").first()
    assert (str(day.measurement_date), day.pm10_avg, day.aqi) == ("2023-12-30", 75, 75)


def test_job_entry_point(spark, tmp_path):
    from airlake import job
    landing = tmp_path / "landing" / "2023_12_30"
    os.makedirs(landing)
    (landing / "a.json").write_text(json.dumps(sample_document()))
    os.utime(landing / "a.json", (1_000_000, 1_000_000))    # an old delivery
    lake = str(tmp_path / "lake")
    assert job.main(["--landing", str(tmp_path / "landing"), "--lake", lake, "--full"], spark=spark) == 0
    g = G.aqi_pipeline(spark, lake, f"{lake}/stage/raw")
    assert g.read("city_day").first().aqi == 75
    assert g.read("aqi_wide").count() == 1                  # --full builds every table
    doc = sample_document()
    doc["records"] = [dict(r, pollutant_avg="90") if r["pollutant_id"] == "PM10" else r for r in doc["records"]]
    (landing / "b.json").write_text(json.dumps(doc))        # a corrected re-delivery of the hour
    assert job.main(["--landing", str(tmp_path / "landing"), "--lake", lake], spark=spark) == 0
    assert g.read("city_day").first().aqi == 90             # touched day refreshed


def test_job_on_empty_landing(spark, tmp_path):
    from airlake import job
    os.makedirs(tmp_path / "landing")
    assert job.main(["--landing", str(tmp_path / "landing"), "--lake", str(tmp_path / "lake"), "--full"],
                    spark=spark) == 0


def test_job_with_weather(spark, tmp_path):
    import datetime as dt

    from airlake import job
    from airlake.plans import products as P
    landing = tmp_path / "landing" / "2023_12_30"
    os.makedirs(landing)
    (landing / "a.json").write_text(json.dumps(sample_document()))
    source = spark.createDataFrame([("IN", dt.date(2023, 12, 30), 61.5), ("IN", dt.date(2023, 12, 31), 60.0)],
                                   "country string, date_valid_std date, avg_temperature_air_2m_f double")
    weather = str(tmp_path / "weather")
    G.snapshot_weather(P.weather_data(source, "IN", "2023-12-01", "2023-12-31",
                                      labels=("India", "Karnataka", "Bengaluru")), weather)
    lake = str(tmp_path / "lake")
    assert job.main(["--landing", str(tmp_path / "landing"), "--lake", lake, "--weather", weather], spark=spark) == 0
    g = G.aqi_pipeline(spark, lake, f"{lake}/stage/raw", weather_path=weather)
    r = g.read("city_day_weather").first()
    assert (str(r.measurement_date), r.temperature_in_f, r.aqi) == ("2023-12-30", 61.5, 75)
