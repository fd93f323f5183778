"""Joins whose small side is sent to all executors only after its rows have been counted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of a few numbers that are sent to all executors at most (some 30 MB); more are joined by a shuffle.
BROADCAST_ROWS = 1_000_000


def small(df: DataFrame, rows_of: int = 1) -> DataFrame:
    """``df`` with the hint to send it to all executors if it is small enough; it should be cheap to compute twice.

    ``rows_of``: a row counts as so many rows of a few numbers.
    """
    return F.broadcast(df) if df.count() * rows_of <= BROADCAST_ROWS else df


def row_key() -> Column:
    """A 64-bit hash that tells rows apart by doc_id and text; rows that repeat both share it."""
    return F.xxhash64("doc_id", "text")


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id and text of every row, with its ``row_key`` as doc_id, so that rows are judged one by one."""
    return docs.select(row_key().alias("doc_id"), "text")


def without(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns kept, whose ``row_key`` isn't in the one column of ``keys``."""
    gone = small(keys.toDF("_gone_key"))
    return docs.withColumn("_row_key", row_key()).join(gone, F.col("_row_key") == F.col("_gone_key"), "left_anti").drop("_row_key")
