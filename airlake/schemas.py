"""Schemas and fixed values of the air-quality feed."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the feed / the original pipeline for right results)
# ---------------------------------------------------------------------------
# Pollutant ids as the feed spells them, with the wide column each one pivots into.
POLLUTANT_COLUMNS = {
    "PM2.5": "pm25_avg",
    "PM10": "pm10_avg",
    "SO2": "so2_avg",
    "NO2": "no2_avg",
    "NH3": "nh3_avg",
    "CO": "co_avg",
    "OZONE": "o3_avg",
}
# Argument order of the prominent-pollutant / sub-index rules, with the label
# the prominent rule returns for each argument (ties go to the earlier one).
PROMINENT_LABELS = ["PM25", "PM10", "SO2", "NO2", "NH3", "CO", "O3"]
WIDE_COLUMNS = ["pm25_avg", "pm10_avg", "so2_avg", "no2_avg", "nh3_avg", "co_avg", "o3_avg"]
# Order of the averages in the wide table, the fact and the rollups.
STORED_COLUMNS = ["pm10_avg", "pm25_avg", "so2_avg", "no2_avg", "nh3_avg", "co_avg", "o3_avg"]
# Sentinel the feed uses for a missing reading.
MISSING = "NA"
# Timestamp pattern of record.last_update.
FEED_TS_FORMAT = "dd-MM-yyyy HH:mm:ss"
# Landing layout: dated folder and file name (IST clock).
LANDING_DIR_FORMAT = "yyyy_MM_dd"
LANDING_FILE_TS_FORMAT = "yyyy_MM_dd_HH_mm_ss"
LANDING_FILE_PREFIX = "air_quality_data_"
LANDING_ZONE = "Asia/Kolkata"
# Upper bound of records per landed document (API page size).
PAGE_LIMIT = 4000
# ---------------------------------------------------------------------------

STATION_KEYS = ["index_record_ts", "country", "state", "city", "station", "latitude", "longitude"]
LAT_LON_TYPE = "decimal(12,7)"

RECORD_FIELDS = [
    "country", "state", "city", "station", "last_update", "latitude", "longitude",
    "pollutant_id", "pollutant_min", "pollutant_max", "pollutant_avg",
]
RECORD = T.StructType([T.StructField(f, T.StringType()) for f in RECORD_FIELDS])
RECORDS_DDL = "array<struct<" + ", ".join(f"{f}: string" for f in RECORD_FIELDS) + ">>"

DOCUMENT = T.StructType([
    T.StructField("created", T.LongType()),
    T.StructField("updated", T.LongType()),
    T.StructField("created_date", T.StringType()),
    T.StructField("updated_date", T.StringType()),
    T.StructField("active", T.IntegerType()),
    T.StructField("index_name", T.StringType()),
    T.StructField("message", T.StringType()),
    T.StructField("version", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("total", T.IntegerType()),
    T.StructField("count", T.IntegerType()),
    T.StructField("limit", T.StringType()),
    T.StructField("offset", T.StringType()),
    T.StructField("field", T.ArrayType(T.StringType())),
    T.StructField("records", T.ArrayType(RECORD)),
])
