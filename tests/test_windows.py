import datetime as dt
import json
import random
import uuid

import pytest
from pyspark.sql import functions as F

from airlake.session import shared_dir
from airlake.streaming import windows as W

T0 = dt.datetime(2024, 3, 1)
SCHEMA = "id long, at timestamp, kind string, v int"
DELAY = 3600


def batches(seed):
    """Out-of-order deliveries: late rows, copies in and across deliveries, rows without a time."""
    rng = random.Random(seed)
    rows = [(i, T0 + dt.timedelta(minutes=7 * i + rng.randrange(-40, 40)), rng.choice(["a", "a", "b", None]), rng.randrange(100)) for i in range(400)]
    out = [[], [], [], []]
    for r in rows:
        b = r[0] // 100
        out[min(3, b + (rng.random() < 0.1))].append(r)
        if rng.random() < 0.2:
            out[min(3, b + rng.randrange(2))].append(r)
    out[1].append((999, None, "a", 1))
    for part in out:
        rng.shuffle(part)
    return out


def plain(deliveries):
    """Admitted and late rows by the rule, and the windows closed in the end."""
    mark, admitted, late = None, [], []
    for part in deliveries:
        for r in part:
            (late if r[1] is None or (mark is not None and r[1] <= mark) else admitted).append(r)
        times = [r[1] for r in part if r[1] is not None]
        new = max(times) - dt.timedelta(seconds=DELAY)
        mark = max(new, mark) if mark else new
    counts = {}
    for i, at, kind, v in {r[0]: r for r in admitted}.values():
        start = at.replace(minute=0) if at.hour % 2 == 0 else at.replace(minute=0) - dt.timedelta(hours=1)
        counts.setdefault((kind, start), []).append(v)
    closed = {(k, s, len(vs), max(vs)) for (k, s), vs in counts.items() if s + dt.timedelta(hours=2) <= mark}
    return admitted, late, closed


class Lake:
    def __init__(self, spark):
        self.spark, self.run = spark, shared_dir(spark, "test-windows", uuid.uuid4().hex)
        self.schema = spark.createDataFrame([], SCHEMA).schema

    def deliver(self, rows):
        self.spark.createDataFrame(rows, SCHEMA).write.mode("append").parquet(f"{self.run}/landing")

    def admit(self):
        stream = self.spark.readStream.schema(self.schema).parquet(f"{self.run}/landing")
        return W.admit(stream, "at", DELAY, f"{self.run}/split", f"{self.run}/cp-admit")

    def windows(self):
        rows = W.admitted_stream(self.spark, f"{self.run}/split", self.schema)
        counted = W.window_counts(rows, ["id"], ["kind"], "at", "v", "2 hours", DELAY)
        return W.write_windows(counted, f"{self.run}/windows", f"{self.run}/cp-windows")

    def rows(self, late):
        return sorted((tuple(r) for r in W.split_rows(self.spark, f"{self.run}/split", late, self.schema).collect()), key=repr)

    def closed(self):
        return sorted((tuple(r) for r in self.spark.read.parquet(f"{self.run}/windows").select("kind", "window_start", "events", "peak").collect()), key=repr)


@pytest.mark.parametrize("seed", range(2))
def test_late_copied_and_disordered_rows(spark, seed):
    lake, dropped = Lake(spark), 0
    deliveries = batches(seed)
    admitted, late, closed = plain(deliveries)
    assert late and len({r[0] for r in admitted}) < len(admitted)
    for k, part in enumerate(deliveries):
        lake.deliver(part)
        assert lake.admit() == 1
        if k != 1:                                         # two deliveries may be one batch of the second stream
            progress = lake.windows()
            dropped += sum(op["numRowsDroppedByWatermark"] for p in progress for op in json.loads(p.json)["stateOperators"])
    assert lake.admit() == 0                               # nothing new
    assert lake.rows(False) == sorted(admitted, key=repr)
    assert lake.rows(True) == sorted(late, key=repr)
    assert lake.closed() == sorted(closed, key=repr)
    assert dropped == 0
    # the table of admitted rows gives the same windows without state
    batch = W.window_counts(W.split_rows(spark, f"{lake.run}/split", False, lake.schema), ["id"], ["kind"], "at", "v", "2 hours", DELAY)
    ends = spark.read.parquet(f"{lake.run}/windows").agg(F.max("window_end")).first()[0]
    assert sorted((tuple(r) for r in batch.where(F.col("window_end") <= ends).select("kind", "window_start", "events", "peak").collect()), key=repr) == lake.closed()


def test_a_batch_that_fails_after_its_rows_is_replayed(spark, monkeypatch):
    lake = Lake(spark)
    first, second, *_ = batches(5)
    lake.deliver(first)
    lake.admit()
    lake.deliver(second)
    real = W._watermark
    calls = []

    def fail_after_rows(*args):
        calls.append(args)
        return real(*args)

    class Broken(W.Observation):
        @property
        def get(self):
            raise RuntimeError("lost after the rows were written")

    monkeypatch.setattr(W, "_watermark", fail_after_rows)
    monkeypatch.setattr(W, "Observation", Broken)
    with pytest.raises(Exception, match="lost after the rows"):
        lake.admit()
    monkeypatch.undo()
    assert lake.admit() == 1
    admitted, late, _ = plain([first, second])
    assert lake.rows(False) == sorted(admitted, key=repr)
    assert lake.rows(True) == sorted(late, key=repr)


def test_nothing_admitted_yet(spark):
    lake = Lake(spark)
    assert lake.rows(False) == [] and lake.rows(True) == []
    lake.deliver([(1, None, "a", 1)])
    assert lake.admit() == 1
    assert lake.rows(False) == [] and len(lake.rows(True)) == 1
