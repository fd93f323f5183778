"""Relational queries over the order tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallgrass.sources.tables import table


def shipped_by_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per return flag and line status: line count and summed quantity, over every line item."""
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity")
    return lines.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("l_quantity").alias("sum_quantity")
    )


SHIPPED_BY_STATUS_SQL = """
SELECT l_returnflag, l_linestatus, count(*) AS n_lines, sum(l_quantity) AS sum_quantity
FROM lineitem GROUP BY l_returnflag, l_linestatus
"""
