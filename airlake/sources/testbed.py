"""Adapters that shape the driver's TPC-H-like tables into the feed's data model.

The test tables carry no air-quality data, so each adapter is a deterministic
DataFrame derived from them (its size grows with the tables):

* ``readings``   lineitem ⋈ supplier ⋈ nation ⋈ region -> long-form pollutant readings
                 (the clean layer): year -> date, month -> hour 0..11, line number ->
                 pollutant, quantity -> reading, some readings 'NA'.
* ``weather_source``  orders ⋈ customer ⋈ nation ⋈ region -> a daily weather table with the
                 columns of the shared weather source.
* ``event_deliveries`` events -> landed-file metadata (hour, file, load time, md5).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airlake.schemas import FEED_TS_FORMAT, LAT_LON_TYPE


_READS: dict[str, tuple[object, DataFrame]] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's (read-only) tables. The reader - a plan, no data - is kept per
    session and path, so repeated queries do not list and read the footers again."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    owner = getattr(spark, "_jsparkSession", spark)             # the session the reader belongs to
    hit = _READS.get(path)
    if hit is None or hit[0] is not owner:                      # another (or a new) session
        hit = _READS[path] = (owner, spark.read.parquet(path))
    return hit[1]


def hour_floor(ts: Column | str) -> Column:
    """Start of the hour as ``timestamp_ntz`` (zone-free, unlike ``date_trunc``)."""
    t = F.col(ts) if isinstance(ts, str) else ts
    return F.make_timestamp_ntz(F.year(t), F.month(t), F.dayofmonth(t), F.hour(t), F.lit(0), F.lit(0))


def _pollutant_of_line(n: Column) -> Column:
    return (F.when(n == 1, "PM2.5").when(n == 2, "PM10").when(n == 3, "SO2").when(n == 4, "NO2")
            .when(n == 5, "NH3").when(n == 6, "CO").otherwise("OZONE"))


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount",
        "l_returnflag", "l_shipdate")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    j = (li.join(s, li["l_suppkey"] == s["s_suppkey"])
           .join(n, s["s_nationkey"] == n["n_nationkey"])
           .join(r, n["n_regionkey"] == r["r_regionkey"]))
    ts = F.make_timestamp_ntz(F.year("l_shipdate"), F.lit(1), F.lit(1),
                              F.month("l_shipdate") - 1, F.lit(0), F.lit(0))
    avg_text = (F.when((F.col("l_returnflag") == "N") & (F.col("l_discount") < 0.02), F.lit("NA"))
                .otherwise(F.col("l_quantity").cast("int").cast("string")))
    return j.select(
        ts.alias("index_record_ts"),
        F.col("r_name").alias("country"),
        F.col("n_name").alias("state"),
        F.concat(F.col("n_name"), F.lit("-C"), (F.col("s_suppkey") % 3).cast("string")).alias("city"),
        F.col("s_name").alias("station"),
        (F.col("s_suppkey") % 90).cast(LAT_LON_TYPE).alias("latitude"),
        F.col("s_nationkey").cast(LAT_LON_TYPE).alias("longitude"),
        _pollutant_of_line(F.col("l_linenumber")).alias("pollutant_id"),
        (F.col("l_orderkey") % 500).cast("string").alias("pollutant_max"),
        (F.col("l_partkey") % 100).cast("string").alias("pollutant_min"),
        avg_text.alias("pollutant_avg"),
    )


def feed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``readings`` as the feed's record structs (all text, with ``last_update``)."""
    r = readings(spark, sf_dir)
    return r.select(
        "index_record_ts", "country", "state", "city", "station",
        F.date_format("index_record_ts", FEED_TS_FORMAT).alias("last_update"),
        F.col("latitude").cast("string").alias("latitude"),
        F.col("longitude").cast("string").alias("longitude"),
        "pollutant_id", "pollutant_min", "pollutant_max", "pollutant_avg",
    )


def weather_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """country (code = region name), state, city, date_valid_std, avg_temperature_air_2m_f."""
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_totalprice", "o_orderdate")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    j = (o.join(c, o["o_custkey"] == c["c_custkey"])
          .join(n, c["c_nationkey"] == n["n_nationkey"])
          .join(r, n["n_regionkey"] == r["r_regionkey"]))
    return (j.groupBy(
                F.col("r_name").alias("country"), F.col("n_name").alias("state"),
                F.concat(F.col("n_name"), F.lit("-C"), (F.col("c_custkey") % 3).cast("string")).alias("city"),
                F.make_date(F.year("o_orderdate"), F.lit(1), F.lit(1)).alias("date_valid_std"))
             .agg((F.max("o_totalprice") / F.lit(1000.0)).alias("avg_temperature_air_2m_f")))


def event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as feed records: hour of the event, one station per event."""
    e = table(spark, sf_dir, "events")
    hour = hour_floor("ts")
    return e.select(
        hour.alias("index_record_ts"), F.lit("India").alias("country"), F.col("event_type").alias("state"),
        F.concat(F.lit("user-"), (F.col("user_id") % 10).cast("string")).alias("city"),
        F.col("event_id").cast("string").alias("station"), F.date_format(hour, FEED_TS_FORMAT).alias("last_update"),
        F.lit("1.0").alias("latitude"), F.lit("2.0").alias("longitude"), F.lit("PM10").alias("pollutant_id"),
        F.lit("0").alias("pollutant_min"), F.lit("100").alias("pollutant_max"),
        F.col("value").cast("int").cast("string").alias("pollutant_avg"))


def hourly_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as hourly series of (state, city): the greatest reading of the hour; readings below 5
    count as missing, so an hour has a null reading or, with no event, no row."""
    value = F.col("pollutant_avg").cast("int")
    return (event_records(spark, sf_dir).groupBy("state", "city", "index_record_ts")
            .agg(F.max(F.when(value >= 5, value)).alias("reading")))


def event_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events seen as landed files: hour of the event = hour of the document."""
    e = table(spark, sf_dir, "events")
    return e.select(
        hour_floor("ts").alias("index_record_ts"),
        F.col("value").cast("int").alias("record_count"),
        F.col("event_type").alias("json_version"),
        F.format_string("air_quality_data_%d.json", F.col("event_id")).alias("_stg_file_name"),
        F.col("ts").alias("_stg_file_load_ts"),
        F.md5(F.col("props")).alias("_stg_file_md5"),
    )
