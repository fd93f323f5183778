"""Making this library importable in Spark's Python workers."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import SparkSession

import tallgrass


#: Bytes of a batch that goes to a Python worker, unless the session has set its own.
BATCH_BYTES = "16m"


def lean_batches(spark: SparkSession) -> None:
    """Hand Python workers smaller batches than Spark's default of 64 MB, for rows with texts; a session's own size stays."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key) in ("67108864b", "67108864", "64m", "64MB"):
        spark.conf.set(key, BATCH_BYTES)


def give_back() -> None:
    """Return this process's freed memory to the machine; a Python worker outlives its tasks and shares an executor's."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # not glibc
        pass


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for mapInArrow, giving memory back when a task ends."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return tidied


def share_code(spark: SparkSession) -> None:
    """Let Python workers on this machine's path import the library; a cluster gets it by --py-files or an install."""
    top = str(Path(tallgrass.__file__).resolve().parents[1])
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "").split(":")
    if top not in known:
        environment["PYTHONPATH"] = ":".join([top, *filter(None, known)])
