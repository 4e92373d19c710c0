"""Small helpers shared by the operators: reading, Arrow batch bounds, saved intermediates."""

from __future__ import annotations

import ctypes
import functools
import gc

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airlake.session import shared_dir

#: Bounds on one Arrow batch handed to Python: rows and bytes (the longest text can exceed it).
ARROW_ROWS, ARROW_BYTES = 2000, 4 << 20
#: Bytes of one batch, and of text worked on at a time, for operators that need no more at once: Python
#: holds many times a text's size while it is worked on, and the JVM twice a batch.
TEXT_BATCH, TEXT_SLICE = 1 << 20, 512 << 10
#: Bytes of batches after which a running task gives freed memory back.
GIVE_BACK = 4 << 20


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def bound_arrow(spark: SparkSession, size: int = ARROW_BYTES) -> None:
    """Bound Arrow batches, so that a task's Python memory does not follow text length."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


#: The one tool that a worker process keeps from task to task.
_resident: dict = {}


def resident(key, make):
    """The tool of ``key``, kept by the worker process until a task of another operator comes."""
    if key not in _resident:
        _resident.clear()
        _resident[key] = make()
    return _resident[key]


def give_back() -> None:
    """What this process has freed goes back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def _giving_back(batches):
    """``batches``; memory freed meanwhile is given back after every ``GIVE_BACK`` bytes of them."""
    seen = 0
    for batch in batches:
        seen += batch.nbytes
        yield batch
        if seen >= GIVE_BACK:
            seen = 0
            give_back()


def tidy(run, keep: bool = False):
    """``run`` for ``mapInArrow``; from time to time, and when a task ends, what its Python worker no
    longer needs goes back to the system, as the executor's other workers need it and the worker
    serves later tasks of other operators too. ``keep``: the tasks go on with the resident tool;
    others free it first."""
    @functools.wraps(run)
    def inner(batches):
        if not keep and _resident:
            _resident.clear()
            gc.collect()
            give_back()                               # before this task takes memory of its own
        yield from run(_giving_back(batches))
        gc.collect()
        give_back()
    return inner


def saved(df: DataFrame) -> DataFrame:
    """Cut the lineage: a reliable checkpoint in the shared folder ``spark.checkpoint.dir``."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def held_out() -> Column:
    """Rows whose labels are never learned from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.expr("crc32(cast(doc_id AS string)) % 4 = 2"), F.lit(False))


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select(*columns)


def with_fields(df: DataFrame, *fields: T.StructField) -> T.StructType:
    """The schema of ``df`` with further fields; columns named like one of them are replaced."""
    new = {f.name.lower() for f in fields}
    return T.StructType([f for f in df.schema.fields if f.name.lower() not in new] + list(fields))
