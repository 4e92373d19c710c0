"""Folding of old raw days: same table before and after, also with a batch run again."""

import datetime
import os

import pytest
from pyspark.sql import functions as F

from airlake.plans import compaction as C
from airlake.plans import graph as G
from airlake.plans import layers as L
from airlake.schemas import RECORD_FIELDS
from airlake.sources import landing as LD
from airlake.streaming.ingest import load_batch

DAYS = [datetime.date(2024, 3, d) for d in (1, 2, 3)]
LATER = datetime.date(2024, 3, 3)


def records(spark, reading, hours=range(4), days=DAYS):
    rows = []
    for day in days:
        for h in hours:
            at = datetime.datetime(day.year, day.month, day.day, h)
            for s in range(3):
                for p, v in (("PM10", reading + h), ("CO", reading + s)):
                    rows.append((at, "India", "K", f"c{s % 2}", f"s{s}", at.strftime("%d-%m-%Y %H:%M:%S"), "1.5", str(s), p, "1", "9", str(v)))
    names = ["country", "state", "city", "station", "last_update", "latitude", "longitude", "pollutant_id", "pollutant_min", "pollutant_max", "pollutant_avg"]
    assert sorted(names) == sorted(RECORD_FIELDS)
    return spark.createDataFrame(rows, "index_record_ts timestamp_ntz, " + ", ".join(f"{n} string" for n in names))


def load(spark, base, rows, batch, at, name="feed"):
    landing = f"{base}/landing-{name}-{batch}"
    if not os.path.exists(landing):
        LD.write_landing(LD.documents_from_records(rows, 5, F.lit(at).cast("timestamp")), landing)
    return load_batch(spark, landing, f"{base}/raw", batch, "lines", load=name, copy_ts="2024-03-09 00:00:00")


def loaded(spark, base):
    load(spark, base, records(spark, 10), 0, "2024-03-04 01:00:00")
    load(spark, base, records(spark, 20, range(2)), 1, "2024-03-04 02:00:00")
    load(spark, base, records(spark, 30, [3], DAYS[:1]), 0, "2024-03-04 03:00:00", name="other")


def table(df):
    cols = sorted(c for c in df.columns if c != "json_data")
    return sorted((tuple(str(v) for v in r) for r in df.select(*cols, F.to_json("json_data") if "json_data" in df.columns else F.lit(0)).collect()))


def test_same_rows_and_same_clean_layer(spark, tmp_path):
    base = str(tmp_path)
    loaded(spark, base)
    raw = f"{base}/raw"
    assert C.compacted_days(spark, raw) == {}
    before = table(spark.read.parquet(raw)), table(L.clean(spark.read.parquet(raw)))
    folders = len(C._folders(spark, raw))
    assert C.compact_raw(spark, raw, LATER, days_at_once=1) == DAYS[:2]
    assert set(C.compacted_days(spark, raw)) == set(DAYS[:2]) and len(C._folders(spark, raw)) == folders - 5
    assert (table(C.read_raw(spark, raw)), table(L.clean(C.read_raw(spark, raw)))) == before
    assert C.raw_days(spark, raw) == DAYS
    assert {r[0] for r in C.read_raw(spark, raw, ["2024-03-02"]).select(L.RAW_DAY).distinct().collect()} == {DAYS[1]}
    assert C.compact_raw(spark, raw, LATER) == []                       # nothing new to fold
    # everything folded: the raw folder itself holds no file
    C.compact_raw(spark, raw, datetime.date(2024, 3, 9))
    assert not C._folders(spark, raw)
    assert (table(C.read_raw(spark, raw)), table(L.clean(C.read_raw(spark, raw)))) == before


def test_a_batch_run_again_replaces_its_folded_rows(spark, tmp_path):
    base = str(tmp_path)
    loaded(spark, base)
    raw = f"{base}/raw"
    before = table(L.clean(spark.read.parquet(raw)))
    n = spark.read.parquet(raw).count()
    C.compact_raw(spark, raw, LATER)
    load(spark, base, None, 1, None)
    assert C.read_raw(spark, raw).count() == n and table(L.clean(C.read_raw(spark, raw))) == before
    # folded once more, the days are held by a newer run and their rows are the same
    assert C.compact_raw(spark, raw, LATER) == DAYS[:2]
    assert C.read_raw(spark, raw).count() == n and table(L.clean(C.read_raw(spark, raw))) == before
    assert len({*C.compacted_days(spark, raw).values()}) == 1


@pytest.mark.parametrize("at", ["write", "delete"])
def test_a_failure_half_way_loses_and_repeats_nothing(spark, tmp_path, monkeypatch, at):
    base = str(tmp_path)
    loaded(spark, base)
    raw = f"{base}/raw"
    before = table(spark.read.parquet(raw))
    if at == "write":                                                   # a run that never completed
        os.makedirs(f"{raw}_compacted/run=0/{L.RAW_DAY}=2024-03-01")
        with open(f"{raw}_compacted/run=0/{L.RAW_DAY}=2024-03-01/part-0.parquet", "wb") as f:
            f.write(b"half a file")
    else:
        def fail(*_):
            raise OSError("lost")
        with monkeypatch.context() as m:
            m.setattr(C, "delete", fail)
            with pytest.raises(OSError):
                C.compact_raw(spark, raw, LATER)
    assert table(C.read_raw(spark, raw)) == before
    assert C.compact_raw(spark, raw, LATER) == DAYS[:2]
    assert table(C.read_raw(spark, raw)) == before


def test_refreshes_over_folded_days(spark, tmp_path):
    base = str(tmp_path)
    loaded(spark, base)
    raw = f"{base}/raw"
    g = G.aqi_pipeline(spark, f"{base}/tables", raw)
    g.refresh("city_day")
    before = table(g.read("city_day"))
    C.compact_raw(spark, raw, datetime.date(2024, 3, 9))
    assert g.stored("raw")
    g.refresh("city_day", days=DAYS[:2])
    assert table(g.read("city_day")) == before
    g.refresh("city_day")
    assert table(g.read("city_day")) == before
    # a later delivery of a folded hour
    days = load(spark, base, records(spark, 40, [1], DAYS[1:2]), 2, "2024-03-05 01:00:00")
    g.refresh("city_day", days=days)
    after = table(g.read("city_day"))
    assert after != before and len(after) == len(before)
    g.refresh("city_day")
    assert table(g.read("city_day")) == after


def test_nothing_loaded(spark, tmp_path):
    assert C.read_raw(spark, f"{tmp_path}/raw") is None
    assert C.compact_raw(spark, f"{tmp_path}/raw", LATER) == [] and C.raw_days(spark, f"{tmp_path}/raw") == []


def test_a_batch_of_raw_documents_is_bounded(spark, tmp_path):
    """A day of many documents is stored in row groups of few, before and after folding, as a reading
    task holds a batch of documents with all their records."""
    import glob

    import pyarrow.parquet as pq

    base = str(tmp_path)
    rows = records(spark, 10, range(24), DAYS[:1])                            # 6 records an hour, 5 to a document
    for batch in range(2):
        load(spark, base, rows, batch, f"2024-03-04 0{batch + 1}:00:00")

    def groups(path):
        files = [pq.ParquetFile(f).metadata for f in glob.glob(f"{path}/**/*.parquet", recursive=True)]
        return [m.row_group(k).num_rows for m in files for k in range(m.num_row_groups)]

    most = 16
    loose = groups(f"{base}/raw")
    assert sum(loose) == 96 and max(loose) <= most
    before = table(L.clean(spark.read.parquet(f"{base}/raw")))
    assert C.compact_raw(spark, f"{base}/raw", LATER) == DAYS[:1]
    folded = groups(f"{base}/raw_compacted")
    assert sum(folded) == 96 and max(folded) <= most
    assert table(L.clean(C.read_raw(spark, f"{base}/raw"))) == before


def test_raw_documents_are_stored_whole(spark, tmp_path):
    """Neither the load nor the folding cuts variants into columns, for which a task gathers documents in
    memory that nothing manages; the session's own setting comes back."""
    import glob

    import pyarrow.parquet as pq

    base, key = str(tmp_path), "spark.sql.variant.inferShreddingSchema"
    before = spark.conf.get(key)
    rows = records(spark, 10, range(4), DAYS[:1])
    for batch in range(2):
        load(spark, base, rows, batch, f"2024-03-04 0{batch + 1}:00:00")

    def fields(path):
        files = glob.glob(f"{path}/**/*.parquet", recursive=True)
        assert files
        return {tuple(sorted(x.name for x in pq.ParquetFile(f).schema_arrow.field("json_data").type)) for f in files}

    assert fields(f"{base}/raw") == {("metadata", "value")}
    assert C.compact_raw(spark, f"{base}/raw", LATER) == DAYS[:1]
    assert fields(f"{base}/raw_compacted") == {("metadata", "value")}
    assert spark.conf.get(key) == before


def test_a_batch_run_again_leaves_the_documents_unshuffled(spark, tmp_path):
    base = str(tmp_path)
    loaded(spark, base)
    raw = f"{base}/raw"
    C.compact_raw(spark, raw, LATER)
    load(spark, base, records(spark, 20, range(2)), 1, "2024-03-04 02:00:00")
    df = C.read_raw(spark, raw)
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in p and "LeftAnti" in p and "Exchange hashpartitioning" not in p, p


def test_writes_leave_no_shuffle_files(spark, tmp_path):
    """Loading, folding and refreshing hold the shuffle files of the write at hand only."""
    import time

    def files():
        found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        names = [found.apply(i).getName() for i in range(found.size())]
        return {n for n in names if n.startswith("shuffle_")}

    base, before = str(tmp_path), files()
    loaded(spark, base)
    C.compact_raw(spark, f"{base}/raw", LATER)
    g = G.aqi_pipeline(spark, f"{base}/t", f"{base}/raw")
    g.refresh("city_day")
    until = time.time() + 20
    while files() - before and time.time() < until:               # they go a moment after the write
        time.sleep(0.2)
    assert not files() - before
