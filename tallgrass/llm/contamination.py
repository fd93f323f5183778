"""Benchmark decontamination by size-partitioned MinHash containment search, in DataFrame functions only.

A short item inside a long document has next to no Jaccard similarity with it, so signatures of both sides cannot
meet. Containment MinHash samples the small side alone: under each of ``coordinates`` hash orders an item is posted
under its least shingle, and a document collides there if it holds that shingle, which a document that contains the
share c of the item does with probability c. Items are partitioned by size, and a partition has its own sample and its
own collision threshold: items of up to ``coordinates`` shingles are posted whole, one partition for each size, and a
document must hold the threshold's share of them; larger ones are sampled, with a threshold so low that a pair at the
containment threshold is missed about once in a million. Candidates are verified by exact containment of the
shingles' words.

Defined cases: null text, empty text and fewer words than a shingle have no shingles and match nothing, as items and
as documents; rows that share a doc_id (or have none) are one document, rows that share an item_id one item;
empty tables give an empty result; only doc_id, text, item_id and text are read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallgrass.llm.joins import keyed, small, without
from tallgrass.plans.durable import passing, stash


def _words(df: DataFrame, key: str) -> DataFrame:
    """key and words (lower case, cut at ASCII white space) of every row that has text."""
    words = F.array_remove(F.split(F.lower("text"), r"[\x20\x09-\x0D]+"), "")
    return df.where(F.col("text").isNotNull()).select(F.col(key).alias("key"), words.alias("words"))


def _starts(words: Column, width: int) -> Column:
    n = F.size(words) - (width - 1)
    return F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))


def _hashed(df: DataFrame, key: str, width: int) -> DataFrame:
    """key and shingles (hashes) of every row."""
    hashed = _words(df, key).select("key", F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"))
    one = lambda i: F.xxhash64(*(F.element_at("hashes", i + j) for j in range(width)))
    return hashed.select("key", F.transform(_starts(F.col("hashes"), width), one).alias("shingles"))


def _spelled(df: DataFrame, key: str, width: int) -> DataFrame:
    """key and each distinct shingle as its words."""
    words = _words(df, key)
    one = lambda i: F.concat_ws(" ", *(F.element_at("words", i + j) for j in range(width)))
    spelled = words.select("key", F.explode_outer(F.transform(_starts(F.col("words"), width), one)).alias("shingle"))
    return spelled.where(F.col("shingle").isNotNull()).distinct()


def _threshold(coordinates: int, percent: int) -> int:
    mean = coordinates * percent / 100
    return max(1, math.floor(mean - 5 * math.sqrt(mean * (1 - percent / 100))))


def contained_items(docs: DataFrame, items: DataFrame, width: int = 5, percent: int = 80, coordinates: int = 16) -> DataFrame:
    """doc_id, item_id, n_shingles (of the item), n_shared, containment of every pair that reaches ``percent``."""
    docs, items = docs.select("doc_id", "text"), items.select("item_id", "text")
    item_shingles = _hashed(items, "item_id", width).select(F.col("key").alias("item"), F.explode_outer("shingles").alias("shingle"))
    item_shingles = item_shingles.where(F.col("shingle").isNotNull()).distinct()
    sizes = item_shingles.groupBy(F.col("item").alias("its")).agg(F.count(F.lit(1)).alias("n"))
    sized = item_shingles.join(sizes, F.col("item").eqNullSafe(F.col("its")))
    whole = sized.where(F.col("n") <= coordinates).select("item", "shingle", F.lit(1).cast("long").alias("weight"), F.ceil(F.col("n") * percent / 100).alias("needs"))
    orders = sized.where(F.col("n") > coordinates).withColumn("order", F.explode(F.sequence(F.lit(1), F.lit(coordinates))))
    least = orders.groupBy("item", "order").agg(F.min_by("shingle", F.xxhash64("shingle", "order")).alias("shingle"))
    sampled = least.groupBy("item", "shingle").agg(F.count(F.lit(1)).alias("weight")).withColumn("needs", F.lit(_threshold(coordinates, percent)).cast("long"))
    posted = stash(whole.unionByName(sampled), "bench-posted")

    probes = _hashed(docs, "doc_id", width).select(F.col("key").alias("doc"), F.explode_outer("shingles").alias("probe"))
    hits = probes.join(small(posted), F.col("probe") == F.col("shingle"))
    collisions = hits.groupBy("doc", "item", "shingle").agg(F.first("weight").alias("weight"), F.first("needs").alias("needs"))
    found = collisions.groupBy("doc", "item").agg(F.sum("weight").alias("met"), F.first("needs").alias("needs"))
    found = stash(found.where("met >= needs").select("doc", "item"), "bench-candidates")

    near = small(found.select("doc").distinct())
    doc_words = _spelled(docs.join(near, docs["doc_id"].eqNullSafe(F.col("doc")), "left_semi"), "doc_id", width)
    item_words = _spelled(items, "item_id", width).select(F.col("key").alias("its"), F.col("shingle").alias("its_shingle"))
    wanted = found.join(item_words, F.col("item").eqNullSafe(F.col("its"))).select("doc", "item", "its_shingle")
    same = (F.col("shingle") == F.col("its_shingle")) & F.col("key").eqNullSafe(F.col("doc"))
    shared = wanted.join(doc_words, same).groupBy("doc", "item").agg(F.count(F.lit(1)).alias("n_shared"))
    full = item_words.groupBy("its").agg(F.count(F.lit(1)).alias("n_shingles"))
    pairs = shared.join(full, F.col("item").eqNullSafe(F.col("its"))).where(F.col("n_shared") * 100 >= F.col("n_shingles") * percent)
    containment = (F.col("n_shared") / F.col("n_shingles")).alias("containment")
    return pairs.select(F.col("doc").alias("doc_id"), F.col("item").alias("item_id"), "n_shingles", "n_shared", containment)


def without_items(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that contain none of ``items``, all columns kept; a row is judged by its own text."""
    with passing(docs.sparkSession) as keep:
        dirty = stash(contained_items(keyed(docs), items, **options).select("doc_id").distinct(), "bench-dirty")
        keep(dirty)
    return without(docs, dirty)
