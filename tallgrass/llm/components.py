"""Connected components by distributed union-find on DataFrames.

Each round hooks every root to its smallest linked root, flattens the forest by pointer jumping and contracts the
links to roots; links fall at least by the share of roots that were hooked, so rounds grow with the logarithm of the
graph. Every state is written to the shared folder, no link reaches the driver, and no vertex's links meet in one
task: minima are combined before the shuffle, and the joins are plain equi-joins that Spark may split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallgrass.plans.durable import discard, stash


def components(links: DataFrame) -> DataFrame:
    """node, root for every end of ``links`` (a, b: long, not null); root is the least node that can be reached.

    Repeated links, links of both directions and links of a node with itself are allowed; no links give no rows.
    """
    edges = stash(
        links.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).where("hi > lo").distinct(), "cc-links"
    )
    ends = edges.select(F.explode(F.array("hi", "lo")).alias("node")).distinct()
    labels = stash(ends.withColumn("root", F.col("node")), "cc-labels")
    while not edges.isEmpty():
        parents = stash(edges.groupBy("hi").agg(F.min("lo").alias("up")).select(F.col("hi").alias("child"), "up"), "cc-parents")
        while True:
            above = parents.select(F.col("child").alias("mid"), F.col("up").alias("top"))
            lifted = parents.join(above, F.col("up") == F.col("mid"), "left")
            jumped = stash(lifted.select("child", F.coalesce("top", "up").alias("up"), F.col("top").isNotNull().alias("moved")), "cc-jumped")
            discard(parents)
            parents = jumped
            if parents.where("moved").isEmpty():
                break
        to = lambda column: parents.select(F.col("child").alias(f"{column}_was"), F.col("up").alias(f"{column}_now"))
        moved = labels.join(to("root"), F.col("root") == F.col("root_was"), "left")
        new_labels = stash(moved.select("node", F.coalesce("root_now", "root").alias("root")), "cc-labels")
        mapped = edges.join(to("hi"), F.col("hi") == F.col("hi_was"), "left").join(to("lo"), F.col("lo") == F.col("lo_was"), "left")
        x, y = F.coalesce("hi_now", "hi"), F.coalesce("lo_now", "lo")
        new_edges = stash(mapped.select(F.greatest(x, y).alias("hi"), F.least(x, y).alias("lo")).where("hi > lo").distinct(), "cc-links")
        for old in (labels, edges, parents):
            discard(old)
        labels, edges = new_labels, new_edges
    return labels
