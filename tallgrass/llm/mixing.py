"""Mixing sources to target weights by capped water-filling.

A source's target is ``min(weight * level, epochs * size)``; the level is the one at which the targets add up to the
wanted total, so the excess of clamped sources flows to the others by weight. Documents then get whole repetitions
plus a seeded share of one more.

Defined cases: null text has size 0; null source is a source of its own, ranked last; null ids and repeated rows are
mixed row by row, rows without an id in an order that their texts give; an empty table gives an empty result; only doc_id, text and source are read, so other columns
cannot clash. Sources are a configured dimension: their table (one row each) is ordered in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallgrass.plans.durable import stash

#: Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def _name() -> Column:
    """What a row's draw depends on: its id, or its text if it has none, so that rows without an id do not fall together."""
    return F.coalesce(F.col("doc_id").cast("string"), F.md5("text")).alias("name")


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def seeded(name: Column, seed: str) -> Column:
    """A number below 2**32 that depends on the name and the seed alone."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(name, F.lit(""))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, epochs: float) -> DataFrame:
    """One row per source of ``sizes`` (source, size): source, source_size, target."""
    everything = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    filling = Window.orderBy("full_at", "rank").rowsBetween(Window.unboundedPreceding, -1)
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("rank", F.row_number().over(by_name) - 1)
        .withColumn("weight", weight)
        .withColumn("cap", F.col("source_size") * F.lit(float(epochs)))
        .withColumn("wanted", F.sum("source_size").over(everything) * F.lit(float(share)))
        .withColumn("full_at", F.col("cap") / F.col("weight"))
    )
    before = lambda c: F.coalesce(F.sum(c).over(filling), F.lit(0.0))
    level = (F.col("wanted") - before("cap")) / (F.sum("weight").over(everything) - before("weight"))
    clamped = ranked.withColumn("full", F.col("full_at") <= level)
    total = lambda c, full: F.coalesce(F.sum(F.when(F.col("full") == full, F.col(c))).over(everything), F.lit(0.0))
    final = (F.col("wanted") - total("cap", True)) / F.nullif(total("weight", False), F.lit(0.0))
    return clamped.select(
        "source", "source_size", F.when(F.col("full"), F.col("cap")).otherwise(F.col("weight") * final).alias("target")
    )


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    epochs: float = 2.0,
    seed: str = "mix",
) -> DataFrame:
    """Every row of ``docs`` as doc_id, source, size, source_size, target, copies, taken.

    ``copies`` is how often the mix repeats the document (0 and more), ``taken`` the words of those copies. Within a
    source all documents get the same whole repetitions; one more goes to the first documents in seeded order until
    the source's target is met, to within half a document. The seeded order is cut into 65,536 slots whose sums are
    added up first, so that only the documents of the one slot in which the target falls are put in order.
    """
    sizes = stash(docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), _name()), "mix-sizes")
    mixed = _placed(sizes, _goals(sizes, weights, share, epochs, seed), seed)
    return mixed.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))


def repeated(
    docs: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    epochs: float = 2.0,
    seed: str = "mix",
) -> DataFrame:
    """The rows of ``docs``, all columns kept, as often as ``mix`` repeats them; texts are not shuffled."""
    narrow = lambda *more: docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), _name(), *more)
    goals = _goals(stash(narrow(), "mix-sizes"), weights, share, epochs, seed)
    placed = _placed(narrow(F.struct(*(docs[c] for c in docs.columns)).alias("row")), goals, seed).where("copies > 0")
    return placed.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")


def _drawn(sizes: DataFrame, seed: str) -> DataFrame:
    return sizes.withColumn("draw", seeded(F.col("name"), seed)).withColumn("slot", F.shiftright("draw", 16))


def _cut(slots: DataFrame, goals: DataFrame) -> DataFrame:
    """cut_source, cut_slot, cut_from: the slot (of source, slot, slot_size) of each source in which its ``spare`` falls."""
    running = Window.partitionBy("source").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    slots = slots.withColumn("slot_from", F.coalesce(F.sum("slot_size").over(running), F.lit(0)))
    return (
        slots.join(goals, slots["source"].eqNullSafe(F.col("goal_source")))
        .where((F.col("slot_from") <= F.col("spare")) & (F.col("spare") < F.col("slot_from") + F.col("slot_size")))
        .groupBy(F.col("goal_source").alias("cut_source"))
        .agg(F.min(F.struct("slot", "slot_from")).alias("cut"))
        .select("cut_source", F.col("cut.slot").alias("cut_slot"), F.col("cut.slot_from").alias("cut_from"))
    )


def _goals(sizes: DataFrame, weights: Sequence[float], share: float, epochs: float, seed: str) -> DataFrame:
    """Per source: its target, whole repetitions, the words to spare for one more, and the slot in which these end.

    Slots are added up in two steps, of 256 each, so a source has no more than 256 rows in either however large it is.
    """
    goals = stash(
        source_targets(sizes, weights, share, epochs)
        .withColumn("whole", F.coalesce(F.floor(F.col("target") / F.nullif(F.col("source_size"), F.lit(0))), F.lit(0)))
        .withColumn("spare", F.col("target") - F.col("whole") * F.col("source_size"))
        .withColumnRenamed("source", "goal_source"),
        "mix-targets",
    )
    drawn = _drawn(sizes, seed)
    summed = lambda df, slot: df.groupBy("source", slot.alias("slot")).agg(F.sum("size").alias("slot_size"))
    coarse = _cut(summed(drawn, F.shiftright("slot", 8)), goals.select("goal_source", "spare"))
    coarse = coarse.withColumnsRenamed({"cut_source": "in_source", "cut_slot": "in_slot", "cut_from": "in_from"})
    coarse = stash(coarse, "mix-coarse")
    inside = drawn.join(coarse, drawn["source"].eqNullSafe(F.col("in_source")) & (F.shiftright("slot", 8) == F.col("in_slot")), "left_semi")
    left = goals.join(coarse, F.col("goal_source").eqNullSafe(F.col("in_source"))).select("goal_source", (F.col("spare") - F.col("in_from")).alias("spare"), "in_from")
    cut = _cut(summed(inside, F.col("slot")), left)
    cut = cut.join(left.select(F.col("goal_source").alias("of"), "in_from"), F.col("cut_source").eqNullSafe(F.col("of")))
    cut = cut.select("cut_source", "cut_slot", (F.col("cut_from") + F.col("in_from")).alias("cut_from"))
    return stash(goals.join(cut, F.col("goal_source").eqNullSafe(F.col("cut_source")), "left"), "mix-goals")


def _placed(rows: DataFrame, goals: DataFrame, seed: str) -> DataFrame:
    """``rows`` (doc_id, source, size, name and more) with their source's goal and their number of copies."""
    rows = _drawn(rows, seed)
    placed = rows.join(goals, rows["source"].eqNullSafe(F.col("goal_source")))
    at_cut = F.col("slot").eqNullSafe(F.col("cut_slot"))
    all_more = F.col("cut_slot").isNull() & (F.col("spare") > 0)
    clear = placed.where(~at_cut).withColumn("more", (all_more | F.coalesce(F.col("slot") < F.col("cut_slot"), F.lit(False))).cast("long"))
    ordered = Window.partitionBy("source").orderBy("draw", "doc_id", "name", "size").rowsBetween(Window.unboundedPreceding, -1)
    middle = F.col("cut_from") + F.coalesce(F.sum("size").over(ordered), F.lit(0)) + F.col("size") / 2
    near = placed.where(at_cut).withColumn("more", (middle <= F.col("spare")).cast("long"))
    return clear.unionByName(near).withColumn("copies", F.col("whole") + F.col("more"))
