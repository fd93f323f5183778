"""The named Parquet tables of one data directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Table ``name`` below ``sf_dir``; only Spark touches the path, so any store that Spark reads will do."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
