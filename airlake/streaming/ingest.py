"""Incremental load of landed files into the raw table (Structured Streaming).

Each run is ``trigger(availableNow=True)``: every file not yet seen (the checkpoint
remembers them, whatever their age) is loaded once, in micro-batches of at most
``max_files_per_trigger`` files, then the query stops; a run with no new file loads nothing.
Each micro-batch is written to its own (load, batch) partition with overwrite, so a batch
retried after a failure replaces its partial output instead of duplicating it. The load is
the identity of the checkpoint: a new or another checkpoint never overwrites what an earlier
one has loaded.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airlake.plans.layers import stored_days, with_ids, write_load_report, write_quarantine, write_raw_batch
from airlake.session import shared_dir
from airlake.sources.landing import raw_documents, read_landing, rejected_documents


def ingest(spark: SparkSession, landing: str, raw_path: str, checkpoint: str | None = None,
           framing: str = "file", on_error: str = "abort", max_files_per_trigger: int = 1000,
           on_batch: Callable[[int, list], None] | None = None, copy_ts=None,
           every: str | None = None, archive: str | None = None, quarantine: str | None = None):
    """Load new landed files into ``raw_path``.

    Default: one ``availableNow`` run; returns the number of micro-batches run.
    ``every="5 minutes"``: a long-running query on a processing-time trigger (the feed's
    scheduled cadence); returns the ``StreamingQuery`` handle, the caller stops it.
    ``on_batch(batch_id, days)`` runs after a batch is stored (e.g. the touched-day
    refresh). ``copy_ts`` fixes ``_copy_data_ts`` (tests); default: load time. ``archive``:
    a folder that loaded files are moved to, so that the list of seen files stays short.

    ``on_error="quarantine"``: bad documents go to ``<quarantine>/documents`` with what is wrong, the
    others are loaded, and ``<quarantine>/report`` tells the counts of every micro-batch. Both are
    kept by (load, batch) as the raw rows are, so a batch run again repeats neither.
    """
    if (on_error == "quarantine") != (quarantine is not None):
        raise ValueError("on_error='quarantine' and the folder quarantine= go together")
    checkpoint = checkpoint or shared_dir(spark, "ingest", raw_path.strip("/").replace("/", "_"))
    docs = read_landing(spark, landing, framing=framing, stream=True,
                        max_files_per_trigger=max_files_per_trigger, archive=archive)
    batches = []

    def load(batch_df: DataFrame, batch_id: int) -> None:
        # the id in the checkpoint: the same for every run from it, new for a new checkpoint
        identity = batch_df.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        if not identity:
            raise RuntimeError("the streaming query's id is not known; the batch cannot be stored safely")
        rows = raw_documents(batch_df, on_error="skip" if quarantine else on_error,
                             copy_ts=None if copy_ts is None else F.lit(copy_ts))
        write_raw_batch(with_ids(rows, identity, batch_id), raw_path)
        if quarantine:
            write_quarantine(rejected_documents(batch_df), quarantine, identity, batch_id)
            write_load_report(spark, raw_path, quarantine, identity, batch_id)
        batches.append(batch_id)
        if on_batch is not None:
            on_batch(batch_id, stored_days(spark, raw_path, identity, batch_id))

    w = docs.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    if every is not None:
        return w.trigger(processingTime=every).start()
    q = w.trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return len(batches)


def load_batch(spark: SparkSession, landing: str, raw_path: str, batch: int = 0, framing: str = "file",
               on_error: str = "abort", copy_ts=None, load: str | None = None) -> list:
    """One-off batch load of everything in ``landing`` (no file memory); the days it holds.

    The load's identity is ``load``, by default one of the landing path, so a repeated call
    replaces its own rows and no others.
    """
    load = load or "batch-" + hashlib.md5(landing.rstrip("/").encode()).hexdigest()
    rows = raw_documents(read_landing(spark, landing, framing=framing), on_error=on_error,
                         copy_ts=None if copy_ts is None else F.lit(copy_ts))
    write_raw_batch(with_ids(rows, load, batch), raw_path)
    return stored_days(spark, raw_path, load, batch)
