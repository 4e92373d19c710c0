"""Landing cases (FIXTURES §1): files in a temp dir -> raw -> clean."""

import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from airlake.plans.layers import clean, doc_field_sample
from airlake.schemas import RECORD_FIELDS
from airlake.sources import landing as LD
from airlake.sources.landing import list_landing, raw_documents, read_landing
from airlake.streaming.ingest import ingest, load_batch


def record(station, pollutant, avg, ts="01-03-2024 11:00:00", lat="12.917348", lon="77.622813"):
    return {"country": "India", "state": "Karnataka", "city": "Bengaluru", "station": station,
            "last_update": ts, "latitude": lat, "longitude": lon, "pollutant_id": pollutant,
            "pollutant_min": "1", "pollutant_max": "99", "pollutant_avg": avg}


def document(records, total=None, version="2.2.0"):
    d = {"version": version, "total": len(records) if total is None else total, "count": len(records),
         "limit": "4000", "offset": "0", "records": records}
    return d


def put(root, day, name, doc, mtime=None, gz=False, raw_text=None):
    os.makedirs(f"{root}/{day}", exist_ok=True)
    text = raw_text if raw_text is not None else json.dumps(doc, indent=2)
    path = f"{root}/{day}/{name}" + (".gz" if gz else "")
    if gz:
        with gzip.open(path, "wt") as f:
            f.write(text)
    else:
        with open(path, "w") as f:
            f.write(text)
    if mtime is not None:
        os.utime(path, (mtime, mtime))
    return path


def raw_of(spark, root, on_error="abort"):
    return raw_documents(read_landing(spark, root), on_error=on_error, copy_ts=F.lit("2024-03-01 12:00:00"))


def test_plain_and_gz_same_rows_same_md5(spark, tmp_path):
    root = str(tmp_path / "landing")
    doc = document([record("A", "PM10", "75"), record("A", "PM2.5", "40")])
    put(root, "2024_03_01", "air_quality_data_2024_03_01_11_45_00.json", doc, mtime=1_000_000)
    put(root, "2024_03_01", "air_quality_data_2024_03_01_11_45_00.json", doc, mtime=1_000_000, gz=True)
    raw = raw_of(spark, root).withColumn("id", F.monotonically_increasing_id())
    rows = raw.collect()
    assert len(rows) == 2 and rows[0]._stg_file_md5 == rows[1]._stg_file_md5
    assert {r.landing_date.isoformat() for r in rows} == {"2024-03-01"}
    c = clean(raw).collect()
    assert len(c) == 2                            # one of the two copies survives
    assert list_landing(spark, root).count() == 2


def test_newer_file_wins_and_name_breaks_ties(spark, tmp_path):
    root = str(tmp_path / "landing")
    old = document([record("A", "PM10", "10")])
    new = document([record("A", "PM10", "20")])
    put(root, "2024_03_01", "a.json", old, mtime=1_000_000)
    put(root, "2024_03_02", "b.json", new, mtime=2_000_000)
    raw = raw_of(spark, root).withColumn("id", F.monotonically_increasing_id())
    assert [r.pollutant_avg for r in clean(raw).collect()] == ["20"]
    root2 = str(tmp_path / "landing2")
    put(root2, "2024_03_01", "a.json", old, mtime=1_000_000)
    put(root2, "2024_03_01", "z.json", new, mtime=1_000_000)
    raw2 = raw_of(spark, root2).withColumn("id", F.monotonically_increasing_id())
    assert [r.pollutant_avg for r in clean(raw2).collect()] == ["20"]


def test_bad_first_timestamp(spark, tmp_path):
    root = str(tmp_path / "landing")
    put(root, "2024_03_01", "good.json", document([record("A", "PM10", "1")]))
    put(root, "2024_03_01", "bad.json", document([record("B", "PM10", "1", ts="2024-03-01 11:00")]))
    with pytest.raises(Exception):
        raw_of(spark, root).collect()
    assert raw_of(spark, root, on_error="skip").count() == 1


def test_malformed_json(spark, tmp_path):
    root = str(tmp_path / "landing")
    put(root, "2024_03_01", "good.json", document([record("A", "PM10", "1")]))
    put(root, "2024_03_01", "broken.json", None, raw_text='{"records": [')
    with pytest.raises(Exception):
        raw_of(spark, root).collect()
    assert raw_of(spark, root, on_error="skip").count() == 1


def test_file_stamp_wins_and_empty_records(spark, tmp_path):
    root = str(tmp_path / "landing")
    doc = document([record("A", "PM10", "1", ts="01-03-2024 11:00:00"),
                    record("B", "PM10", "2", ts="01-03-2024 09:00:00")])
    put(root, "2024_03_01", "a.json", doc)
    put(root, "2024_03_01", "b.json", document([], total=0) | {"records": []}
        | {"version": "2.2.0"}, raw_text=None)
    put(root, "2024_03_01", "c.json", None, raw_text=json.dumps(
        {"version": "2.2.0", "total": 0, "records": [record("C", "PM10", "3", ts="01-03-2024 12:00:00")][:0]}))
    raw = raw_of(spark, root, on_error="skip").withColumn("id", F.monotonically_increasing_id())
    c = clean(raw).collect()
    assert {str(r.index_record_ts) for r in c} == {"2024-03-01 11:00:00"}
    assert len(c) == 2


def test_latitude_na(spark, tmp_path):
    root = str(tmp_path / "landing")
    put(root, "2024_03_01", "a.json", document([record("A", "PM10", "1", lat="NA")]))
    raw = raw_of(spark, root).withColumn("id", F.monotonically_increasing_id())
    with pytest.raises(Exception):
        clean(raw).collect()
    assert clean(raw, strict=False).first().latitude is None


def test_field_sampler(spark, tmp_path):
    root = str(tmp_path / "landing")
    put(root, "2024_03_01", "a.json", document([record("A", "PM10", "1"), record("B", "NO2", "5")]))
    raw = raw_of(spark, root).withColumn("id", F.monotonically_increasing_id())
    r = doc_field_sample(raw, 1).first()
    assert (r.station, r.pollutant_id, r.pollutant_avg, r.record_count) == ("B", "NO2", "5", 2)
    assert str(r.latitude) == "12.9173480"


def test_streaming_ingest_once_and_redelivery(spark, tmp_path):
    root, raw_path, ck = str(tmp_path / "landing"), str(tmp_path / "raw"), str(tmp_path / "ck")
    h11 = document([record("A", "PM10", "10"), record("A", "SO2", "3")])
    h12 = document([record("A", "PM10", "30", ts="01-03-2024 12:00:00")])
    put(root, "2024_03_01", "h11.json", h11, mtime=1_000_000)
    put(root, "2024_03_01", "h12.json", h12, mtime=1_000_000, gz=True)
    assert ingest(spark, root, raw_path, ck) == 1
    assert spark.read.parquet(raw_path).count() == 2
    assert ingest(spark, root, raw_path, ck) == 0           # nothing new, nothing loaded
    assert spark.read.parquet(raw_path).count() == 2
    touched = []
    put(root, "2024_03_02", "h11b.json", document([record("A", "PM10", "11"), record("A", "SO2", "4")]),
        mtime=2_000_000)
    ingest(spark, root, raw_path, ck, on_batch=lambda b, days: touched.extend(days))
    raw = spark.read.parquet(raw_path)
    ids = [(r.ingest_load, r.ingest_batch, r.id) for r in raw.collect()]
    assert len(ids) == len(set(ids)) == 3
    got = {(str(r.index_record_ts), r.pollutant_id, r.pollutant_avg) for r in clean(raw).collect()}
    assert got == {("2024-03-01 11:00:00", "PM10", "11"), ("2024-03-01 11:00:00", "SO2", "4"),
                   ("2024-03-01 12:00:00", "PM10", "30")}
    assert [d.isoformat() for d in touched] == ["2024-03-01"]


def test_batch_load_is_idempotent(spark, tmp_path):
    root, raw_path = str(tmp_path / "landing"), str(tmp_path / "raw")
    put(root, "2024_03_01", "a.json", document([record("A", "PM10", "1")]))
    load_batch(spark, root, raw_path, batch=0)
    load_batch(spark, root, raw_path, batch=0)      # retried batch replaces itself
    assert spark.read.parquet(raw_path).count() == 1


def test_day_folder_pruning_and_duplicate_report(spark, tmp_path):
    from airlake.plans.layers import raw_duplicate_report
    root = str(tmp_path / "landing")
    put(root, "2024_03_01", "a.json", document([record("A", "PM10", "1")]), mtime=1_000_000)
    put(root, "2024_03_02", "b.json", document([record("A", "PM10", "2")]), mtime=2_000_000)
    put(root, "2024_03_03", "c.json", document([record("A", "PM10", "3", ts="02-03-2024 11:00:00")]))
    docs = read_landing(spark, root, days=["2024_03_02", "2024_03_03"])
    assert sorted(r._stg_file_name for r in docs.collect()) == ["2024_03_02/b.json", "2024_03_03/c.json"]
    raw = raw_of(spark, root).withColumn("id", F.monotonically_increasing_id())
    rep = raw_duplicate_report(raw).collect()
    assert [(str(r.index_record_ts), r.latest_file_rank, r._stg_file_name) for r in rep] == [
        ("2024-03-02 11:00:00", 1, "2024_03_03/c.json"),
        ("2024-03-01 11:00:00", 1, "2024_03_02/b.json"),
        ("2024-03-01 11:00:00", 2, "2024_03_01/a.json")]


def test_scheduled_trigger(spark, tmp_path):
    root, raw_path, ck = str(tmp_path / "landing"), str(tmp_path / "raw"), str(tmp_path / "ck")
    put(root, "2024_03_01", "a.json", document([record("A", "PM10", "1")]))
    q = ingest(spark, root, raw_path, ck, every="1 second")
    try:
        q.processAllAvailable()
        put(root, "2024_03_01", "b.json", document([record("B", "PM10", "2", ts="01-03-2024 12:00:00")]))
        q.processAllAvailable()
    finally:
        q.stop()
    assert spark.read.parquet(raw_path).count() == 2


def test_failed_batch_rerun_does_not_duplicate(spark, tmp_path):
    root, raw_path, ck = str(tmp_path / "landing"), str(tmp_path / "raw"), str(tmp_path / "ck")
    put(root, "2024_03_01", "a.json", document([record("A", "PM10", "1")]))
    put(root, "2024_03_01", "b.json", document([record("B", "PM10", "2", ts="01-03-2024 12:00:00")]))

    def crash(batch_id, days):
        raise RuntimeError("driver lost after the batch was written")

    with pytest.raises(Exception):
        ingest(spark, root, raw_path, ck, on_batch=crash)
    assert spark.read.parquet(raw_path).count() == 2        # written, but the batch never committed
    ingest(spark, root, raw_path, ck)                       # restart: the same batch runs again
    raw = spark.read.parquet(raw_path)
    assert raw.count() == 2 and raw.select("ingest_load", "ingest_batch", "id").distinct().count() == 2
    assert ingest(spark, root, raw_path, ck) == 0


def test_shrinking_redelivery_drops_stale_pages(spark, tmp_path):
    root = str(tmp_path / "landing")

    def page(recs, offset, total, limit):
        return document(recs, total=total) | {"offset": str(offset), "count": len(recs), "limit": str(limit)}

    a, b = record("A", "PM10", "1"), record("B", "PM10", "2")
    put(root, "2024_03_01", "p0.json", page([a], 0, 2, 1), mtime=1_000_000)        # 2 records, pages of 1
    put(root, "2024_03_01", "p1.json", page([b], 1, 2, 1), mtime=1_000_000)
    # re-delivered with a page size of 2: one page; the old second page must not survive
    put(root, "2024_03_02", "q0.json", page([record("A", "PM10", "5"), record("B", "PM10", "6")], 0, 2, 2),
        mtime=2_000_000)
    raw = raw_of(spark, root).withColumn("id", F.monotonically_increasing_id())
    assert sorted((r.station, r.pollutant_avg) for r in clean(raw).collect()) == [("A", "5"), ("B", "6")]
    # same page size, fewer records: the page beyond the new total is dropped
    root2 = str(tmp_path / "landing2")
    put(root2, "2024_03_01", "p0.json", page([a], 0, 2, 1), mtime=1_000_000)
    put(root2, "2024_03_01", "p1.json", page([b], 1, 2, 1), mtime=1_000_000)
    put(root2, "2024_03_02", "q0.json", page([record("A", "PM10", "7")], 0, 1, 1), mtime=2_000_000)
    raw2 = raw_of(spark, root2).withColumn("id", F.monotonically_increasing_id())
    assert [(r.station, r.pollutant_avg) for r in clean(raw2).collect()] == [("A", "7")]
    # a later delivery of one page alone replaces the hour, as one newer file does
    root3 = str(tmp_path / "landing3")
    put(root3, "2024_03_01", "p0.json", page([a], 0, 2, 1), mtime=1_000_000)
    put(root3, "2024_03_01", "p1.json", page([b], 1, 2, 1), mtime=1_000_000)
    put(root3, "2024_03_02", "q1.json", page([record("B", "PM10", "9")], 1, 2, 1), mtime=2_000_000)
    raw3 = raw_of(spark, root3).withColumn("id", F.monotonically_increasing_id())
    assert sorted((r.station, r.pollutant_avg) for r in clean(raw3).collect()) == [("B", "9")]


def test_keys_are_unique_over_loads_and_batches(spark):
    from airlake.plans.layers import RAW_KEY, with_ids
    rows = spark.range(0, 1000, numPartitions=7).withColumnRenamed("id", "n")
    every = with_ids(rows, "a", 3).unionByName(with_ids(rows, "a", 4)).unionByName(with_ids(rows, "b", 3))
    assert every.select(*RAW_KEY).distinct().count() == 3000


def test_files_of_any_age_are_loaded(spark, tmp_path):
    root, raw_path, ck = str(tmp_path / "landing"), str(tmp_path / "raw"), str(tmp_path / "ck")
    now = 1_700_000_000
    put(root, "2024_03_01", "new.json", document([record("A", "PM10", "1")]), mtime=now)
    ingest(spark, root, raw_path, ck)
    put(root, "2024_02_01", "old.json", document([record("A", "PM10", "2", ts="01-02-2024 11:00:00")]), mtime=now - 30 * 86400)
    put(root, "2024_03_01", "next.json", document([record("A", "PM10", "3", ts="01-03-2024 12:00:00")]), mtime=now + 60)
    ingest(spark, root, raw_path, ck)
    assert spark.read.parquet(raw_path).count() == 3


def test_loads_never_overwrite_each_other(spark, tmp_path):
    raw_path = str(tmp_path / "raw")
    put(str(tmp_path / "a"), "2024_03_01", "a.json", document([record("A", "PM10", "1")]))
    put(str(tmp_path / "b"), "2024_03_01", "b.json", document([record("B", "PM10", "2", ts="01-03-2024 12:00:00")]))
    load_batch(spark, str(tmp_path / "a"), raw_path)
    ingest(spark, str(tmp_path / "b"), raw_path, str(tmp_path / "ck1"))
    ingest(spark, str(tmp_path / "b"), raw_path, str(tmp_path / "ck2"))     # the checkpoint was lost
    load_batch(spark, str(tmp_path / "a"), raw_path)
    raw = spark.read.parquet(raw_path)
    assert raw.count() == 3 and raw.select("ingest_load").distinct().count() == 3
    assert sorted((r.station, r.pollutant_avg) for r in clean(raw).collect()) == [("A", "1"), ("B", "2")]


def test_redelivery_with_other_pages_replaces_the_hour(spark, tmp_path):
    from airlake.sources.landing import documents_from_records, write_landing

    def hour(stations, value):
        rows = [("2024-03-01 11:00:00", "India", "K", "B", s, "01-03-2024 11:00:00", "1.0", "2.0", "PM10", "1", "9", value) for s in stations]
        names = "t string, country string, state string, city string, station string, last_update string, latitude string, longitude string, pollutant_id string, pollutant_min string, pollutant_max string, pollutant_avg string"
        return spark.createDataFrame(rows, names).withColumn("index_record_ts", F.col("t").cast("timestamp_ntz")).drop("t")

    landing, raw_path, ck = str(tmp_path / "landing"), str(tmp_path / "raw"), str(tmp_path / "ck")
    for names, value, at in (("S0 S1 S2 S3 S4 S5", "1", "2024-03-01 10:45:00"), ("S0 S1 S2 S3 S4", "2", "2024-03-01 11:45:00")):
        docs = documents_from_records(hour(names.split(), value), limit=1, delivered_at=F.lit(at).cast("timestamp"))
        assert docs.agg(F.max("count")).first()[0] == 1
        write_landing(docs, landing)
        write_landing(docs, landing)                                       # a repeated job lands nothing twice
        ingest(spark, landing, raw_path, ck, framing="lines")
    raw = spark.read.parquet(raw_path)
    assert raw.count() == 11
    want = [(f"S{i}", "2") for i in range(5)]
    assert sorted((r.station, r.pollutant_avg) for r in clean(raw).collect()) == want
    import datetime
    assert sorted((r.station, r.pollutant_avg) for r in clean(raw, [datetime.date(2024, 3, 1)]).collect()) == want


def test_a_page_beyond_the_total_is_kept(spark, tmp_path):
    root = str(tmp_path / "landing")
    put(root, "2024_03_01", "p.json", document([record("A", "PM10", "1")], total=1) | {"offset": "1"})
    raw = raw_of(spark, root).withColumn("id", F.monotonically_increasing_id())
    assert clean(raw).count() == 1


def test_errors_while_storing_are_raised(spark, tmp_path):
    root = str(tmp_path / "landing")
    put(root, "2024_03_01", "a.json", document([record("A", "PM10", "1")]))
    blocked = tmp_path / "raw"
    blocked.write_text("a file where the table should be")
    with pytest.raises(Exception):
        ingest(spark, root, str(blocked), str(tmp_path / "ck"))


def test_typed_document_reader(spark, tmp_path):
    from airlake.sources.landing import read_documents_typed
    root = str(tmp_path / "landing")
    put(root, "2024_03_01", "a.json", document([record("A", "PM10", "1"), record("B", "NO2", "5")]))
    put(root, "2024_03_01", "b.json", document([record("C", "SO2", "7")]), gz=True)
    docs = read_documents_typed(spark, root)
    rows = docs.select("_stg_file_name", "total", F.expr("records.pollutant_avg").alias("avgs")).collect()
    assert sorted((r._stg_file_name, r.total, list(r.avgs)) for r in rows) == [
        ("2024_03_01/a.json", 2, ["1", "5"]), ("2024_03_01/b.json.gz", 1, ["7"])]


def test_numbers_as_json_numbers(spark, tmp_path):
    root = str(tmp_path / "landing")
    rec = record("A", "PM10", "75") | {"latitude": 12.917348, "longitude": 77.622813, "pollutant_avg": 75}
    put(root, "2024_03_01", "a.json", document([rec]))
    raw = raw_of(spark, root).withColumn("id", F.monotonically_increasing_id())
    r = clean(raw).first()
    assert (str(r.latitude), str(r.longitude), r.pollutant_avg) == ("12.9173480", "77.6228130", "75")


def test_empty_landing_zone(spark, tmp_path):
    import os as _os
    root = tmp_path / "landing"
    _os.makedirs(root)
    assert ingest(spark, str(root), str(tmp_path / "raw"), str(tmp_path / "ck")) == 0


def test_all_skipped_first_batch(spark, tmp_path):
    root = str(tmp_path / "landing")
    put(root, "2024_03_01", "bad.json", None, raw_text='{"records": [')
    seen = []
    n = ingest(spark, root, str(tmp_path / "raw"), str(tmp_path / "ck"), on_error="skip",
               on_batch=lambda b, days: seen.append(days))
    assert n == 1 and seen == [[]]


BAD = {"bad_json.json": ('{"records": [', "malformed"), "bad_time.json": (json.dumps(document([record("A", "PM10", "1", ts="2024-03-01")])), "time"),
       "no_records.json": (json.dumps(document([])), "time"), "blank.json": (" \n", "malformed"),
       "no_total.json": (json.dumps({k: v for k, v in document([record("A", "PM10", "1")]).items() if k != "total"}), "total"),
       "no_version.json": (json.dumps({k: v for k, v in document([record("A", "PM10", "1")]).items() if k != "version"}), "version")}


def put_good_and_bad(root):
    for k in range(5):
        put(root, "2024_03_01", f"good{k}.json", document([record("A", "PM10", "1", ts=f"0{k + 1}-03-2024 12:00:00"), record("B", "PM10", "2")]))
    for name, (text, _) in BAD.items():
        put(root, "2024_03_02", name, None, raw_text=text)


def test_quarantine_keeps_bad_documents_and_counts(spark, tmp_path):
    root, raw_path, aside = str(tmp_path / "landing"), str(tmp_path / "raw"), str(tmp_path / "aside")
    put_good_and_bad(root)
    n = ingest(spark, root, raw_path, str(tmp_path / "ck"), on_error="quarantine", quarantine=aside, max_files_per_trigger=3)
    assert n > 1
    kept = {r["_stg_file_name"].split("/")[1]: (r["doc"], r["problem"]) for r in spark.read.parquet(f"{aside}/documents").collect()}
    assert kept == {name: (text, why) for name, (text, why) in BAD.items()}
    report = spark.read.parquet(f"{aside}/report").collect()
    assert len(report) == n and len({(r["ingest_load"], r["ingest_batch"]) for r in report}) == n
    total = {c: sum(r[c] for r in report) for c in ("documents", "records", "rejected", "malformed", "no_time", "no_total", "no_version")}
    assert total == {"documents": 5, "records": 10, "rejected": 6, "malformed": 2, "no_time": 2, "no_total": 1, "no_version": 1}
    # the raw rows are those of a load that skips; one that aborts loads nothing of them
    skipped = str(tmp_path / "skipped")
    ingest(spark, root, skipped, str(tmp_path / "ck2"), on_error="skip")
    names = lambda p: sorted(r[0] for r in spark.read.parquet(p).select("_stg_file_md5").collect())
    assert names(raw_path) == names(skipped)
    with pytest.raises(Exception, match="bad document|MALFORMED"):
        ingest(spark, root, str(tmp_path / "aborted"), str(tmp_path / "ck3"))


def test_quarantine_of_a_batch_run_again(spark, tmp_path):
    root, raw_path, aside, ck = (str(tmp_path / x) for x in ("landing", "raw", "aside", "ck"))
    put_good_and_bad(root)

    def crash(batch_id, days):
        raise RuntimeError("driver lost after the batch was written")

    options = {"on_error": "quarantine", "quarantine": aside}
    with pytest.raises(Exception):
        ingest(spark, root, raw_path, ck, on_batch=crash, **options)
    assert ingest(spark, root, raw_path, ck, **options) == 1
    assert spark.read.parquet(raw_path).count() == 5 and spark.read.parquet(f"{aside}/documents").count() == 6
    assert [(r["documents"], r["rejected"]) for r in spark.read.parquet(f"{aside}/report").collect()] == [(5, 6)]


def test_quarantine_of_one_kind_only(spark, tmp_path):
    """Batches of good documents only, of bad ones only, and no batch at all."""
    for name, texts in (("good", []), ("bad", ["{"])):
        root, raw_path, aside = (str(tmp_path / f"{name}-{x}") for x in ("landing", "raw", "aside"))
        put(root, "2024_03_01", "a.json", document([record("A", "PM10", "1")]), raw_text=texts[0] if texts else None)
        assert ingest(spark, root, raw_path, str(tmp_path / f"{name}-ck"), on_error="quarantine", quarantine=aside) == 1
        assert [(r["documents"], r["rejected"]) for r in spark.read.parquet(f"{aside}/report").collect()] == [(0, 1) if texts else (1, 0)]
        assert ingest(spark, root, raw_path, str(tmp_path / f"{name}-ck"), on_error="quarantine", quarantine=aside) == 0
    with pytest.raises(ValueError):
        ingest(spark, root, raw_path, on_error="quarantine")
    with pytest.raises(ValueError):
        ingest(spark, root, raw_path, on_error="skip", quarantine=aside)


def test_pages_are_collected_one_at_a_time(spark):
    """Writing a delivery plans the pages' assembly over sorted records, which spill; the hash aggregate
    holds many pages of thousands of records in memory that nothing manages."""
    key = "spark.sql.execution.useObjectHashAggregateExec"
    rows = spark.sql("select timestamp_ntz'2024-03-04 00:00:00' as index_record_ts, " + ", ".join(f"cast(id as string) as {f}" for f in RECORD_FIELDS) + " from range(10)")
    documents = LD.documents_from_records(rows, 4)
    seen = []

    class Writer:
        """Stands for the frame and its writer: plans the documents where they would be written."""
        sparkSession = spark

        def __getattr__(self, name):
            return self if name == "write" else lambda *a: self

        def json(self, path):
            plan = documents.select("*")._jdf.queryExecution().executedPlan().toString()
            seen.append(("SortAggregate" in plan, "ObjectHashAggregate" in plan))
            if path == "fails":
                raise OSError

    before = spark.conf.get(key)
    LD.write_landing(Writer(), "there")
    with pytest.raises(OSError):
        LD.write_landing(Writer(), "fails")
    assert seen == [(True, False)] * 2 and spark.conf.get(key) == before
