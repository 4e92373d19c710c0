"""Event-time windows over a stream, with late rows kept aside instead of lost.

``admit`` is a stream that splits each micro-batch by the watermark, the greatest time of the
batches before less a delay: rows at or before it, and rows without a time, are late. Both parts and
the new watermark are written in partitions of the (load, batch), so a retried batch replaces what
it has written and gets the same watermark as before.

``window_counts`` is a second stream over the admitted rows with Spark's own state: the same
watermark, each id once (``dropDuplicatesWithinWatermark``), window aggregates in append mode. What
``admit`` let in is after the watermark of every batch that stream can make of it (its batches are
unions of admitted ones), so its state store drops no admitted row. A window is written once, when
the watermark has passed its end.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airlake.session import read_if_there

_LAYOUT = ["late", "ingest_load", "ingest_batch"]


def _watermark(spark: SparkSession, folder: str, load: str, batch: int):
    """The watermark that the batches of ``load`` up to ``batch`` have reached, in microseconds."""
    if batch < 0:
        return None
    known = read_if_there(spark, f"{folder}/watermark/ingest_load={load}/ingest_batch={batch}")
    row = known.first() if known is not None else None
    return row["micros"] if row else None


def _micros(time: str) -> Column:
    return F.unix_micros(F.col(time).cast("timestamp"))


def admit(rows: DataFrame, time: str, delay_seconds: int, folder: str, checkpoint: str, every: str | None = None):
    """Split the stream ``rows`` into ``folder/rows/late=false`` and ``late=true``; returns the
    number of micro-batches of an ``availableNow`` run, or with ``every`` the running query."""
    spark = rows.sparkSession
    batches: list[int] = []

    def split(batch: DataFrame, number: int) -> None:
        load = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        if not load:
            raise RuntimeError("the streaming query's id is not known; the batch cannot be stored safely")
        mark = _watermark(spark, folder, load, number - 1)
        at = _micros(time)
        late = at.isNull() if mark is None else at.isNull() | (at <= F.lit(mark))
        seen = Observation()
        marked = batch.observe(seen, F.max(at).alias("latest")).withColumns(
            {"late": late, "ingest_load": F.lit(load), "ingest_batch": F.lit(number).cast("bigint")})
        (marked.hint("rebalance", "late").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*_LAYOUT).parquet(f"{folder}/rows"))
        latest = seen.get["latest"]
        # whole milliseconds, as Spark's own watermark
        new = None if latest is None else (latest - delay_seconds * 1_000_000) // 1000 * 1000
        reached = max((x for x in (mark, new) if x is not None), default=None)
        spark.createDataFrame([(reached,)], "micros long").coalesce(1).write.mode("overwrite").parquet(
            f"{folder}/watermark/ingest_load={load}/ingest_batch={number}")
        batches.append(number)

    w = rows.writeStream.foreachBatch(split).option("checkpointLocation", checkpoint)
    if every is not None:
        return w.trigger(processingTime=every).start()
    q = w.trigger(availableNow=True).start()
    q.awaitTermination()
    return len(batches)


def split_rows(spark: SparkSession, folder: str, late: bool, schema: T.StructType) -> DataFrame:
    """The admitted (or the late) rows written so far."""
    found = read_if_there(spark, f"{folder}/rows/late={str(late).lower()}")
    if found is None:
        return spark.createDataFrame([], schema)
    return found.select(*schema.names)


def admitted_stream(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """The admitted rows as a stream, all new ones in one batch."""
    return spark.readStream.schema(schema).option("maxFileAge", "36500d").parquet(f"{folder}/rows/late=false")


def once(rows: DataFrame, ids: Sequence[str], time: str, delay_seconds: int) -> DataFrame:
    """Each id once. Copies of a row have its time, so a copy that is admitted finds the first one
    still in the state, which is kept until the watermark has passed that time and the delay."""
    return rows.withWatermark(time, f"{delay_seconds} seconds").dropDuplicatesWithinWatermark(list(ids))


def window_counts(rows: DataFrame, ids: Sequence[str], keys: Sequence[str], time: str, value: str, width: str, delay_seconds: int) -> DataFrame:
    """(``keys``, ``window_start``, ``events``, ``peak``) of tumbling windows; works on a stream
    and, as its yardstick, on a table (there ids are told apart without state)."""
    single = once(rows, ids, time, delay_seconds) if rows.isStreaming else rows.dropDuplicates(list(ids))
    return (single.groupBy(F.window(time, width).alias("w"), *keys).agg(F.count(F.lit(1)).alias("events"), F.max(value).alias("peak"))
            .select(*keys, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "events", "peak"))


def write_windows(windows: DataFrame, path: str, checkpoint: str):
    """Append the windows that the watermark has closed; returns the run's progress reports."""
    q = (windows.writeStream.outputMode("append").format("parquet").option("path", path)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return q.recentProgress
