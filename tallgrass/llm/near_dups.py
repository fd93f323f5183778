"""MinHash near-duplicates by an inverted join over signature coordinates.

Texts with one shingle set form a class, and classes are linked as follows. Every class is posted under each pair of
coordinate and value of its signature. A link needs ``matches`` collisions, so

* classes with fewer collisions than that in all drop out, and with them the lists that no longer have two entries;
* first, each list proposes its most shared class as the partner of all its others: one row per posting. Collisions
  of a pair are counted, pairs below the threshold fall, and the rest is confirmed on full sets;
* lists that still hold several components do the same once more, with the class that has the fewest shingles of its
  own as the partner;
* then what is left in lists of several components is joined by its rarest full shingles, as many as a partner at the
  threshold cannot miss all; a pair is emitted only if its components differ and if the two places in the order of
  rarity leave enough shingles for the threshold, an exact bound that copies with edits of their own do not pass. The
  collisions of such a pair are looked up in its signatures before it is confirmed.

Prefixes: ordered by how often entries occur, two signatures with ``matches`` collisions share one of their first
``coordinates - matches + 1``; the longer lists are skipped and only looked up.

Components of the confirmed links are found by distributed union-find.

Defined cases: null text and text without words have an empty set and link with nothing; fewer words than a shingle
make one shingle; null ids take part but never name a component that has another id; repeated rows share a class and
are kept or dropped by id, so rows that repeat the kept id all stay; an empty table gives an empty result; only
doc_id and text are read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallgrass.llm.components import components
from tallgrass.llm.joins import keyed, row_key, small, without
from tallgrass.llm.shingles import chunks, shingle_sets, signatures, utf8
from tallgrass.plans.durable import passing, stash
from tallgrass.plans.workers import tidy

_SET = "n long, set_a long, set_b long"


def enough(coordinates: int, percent: int) -> int:
    """Collisions that a pair at the threshold has but for about one time in 100,000."""
    mean = coordinates * percent / 100
    return max(1, math.floor(mean - 4.25 * math.sqrt(mean * (1 - percent / 100))))


def _sketch(width: int, coordinates: int | None):
    """Rows of doc_id, set size, two numbers that name the set, and its signature (or, for None, the set itself)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for a, b in chunks(offsets):
                sets, sizes = shingle_sets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], width)
                full = sizes > 0
                names = np.zeros((2, len(sizes)), np.uint64)
                if len(sets):
                    begin = (np.cumsum(sizes) - sizes)[full]
                    names[0, full] = np.add.reduceat(sets, begin)
                    names[1, full] = np.add.reduceat((sets >> np.uint64(29)) * sets, begin)
                if coordinates is None:
                    values, counts = sets, sizes
                else:
                    values, counts = signatures(sets, sizes, coordinates).ravel(), np.where(full, coordinates, 0)
                ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                columns = [pa.array(sizes), *(pa.array(x.view(np.int64)) for x in names)]
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(values.view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *columns, lists], names=["doc_id", "n", "set_a", "set_b", "marks"])

    return run


def _sketches(docs: DataFrame, width: int, coordinates: int | None) -> DataFrame:
    return docs.select("doc_id", "text").mapInArrow(tidy(_sketch(width, coordinates)), f"doc_id long, {_SET}, marks array<long>")


def _similar(a: Column, b: Column, both: Column, percent: int) -> Column:
    """If sets of sizes ``a`` and ``b`` reach the threshold when they share ``both``."""
    return both * (100 + percent) >= (a + b) * percent


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b) whose full sets reach the threshold."""
    side = lambda k: sets.select(F.col("node").alias(k), F.col("n").alias(f"n_{k}"), F.col("shingles").alias(f"set_{k}"))
    both = F.size(F.array_intersect("set_a", "set_b"))
    return pairs.join(side("a"), "a").join(side("b"), "b").where(_similar(F.col("n_a"), F.col("n_b"), both, percent)).select("a", "b")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, coordinates: int = 32) -> DataFrame:
    """doc_id, n_shingles, component_id (least id that links reach) and kept of every row of ``docs``."""
    docs = docs.select("doc_id", "text")
    matches = enough(coordinates, percent)
    with passing(docs.sparkSession) as keep:
        rows = stash(_sketches(docs, width, coordinates), "nd-sketches")
        key = ["n", "set_a", "set_b"]
        classes = stash(
            rows.where("n > 0")
            .groupBy(*key)
            .agg(F.min("doc_id").alias("low"), F.first("marks").alias("marks"))
            .withColumn("node", F.monotonically_increasing_id()),
            "nd-classes",
        )
        posted = classes.select("node", "n", F.posexplode("marks").alias("at", "mark")).select("node", "n", F.xxhash64("at", "mark").alias("entry"))
        lists = posted.groupBy("entry").agg(F.count(F.lit(1)).alias("long")).where("long > 1")
        shared = posted.join(lists, "entry")
        many = shared.groupBy("node").agg(F.count(F.lit(1)).alias("hits")).where(F.col("hits") >= matches)
        shared = stash(shared.join(many, "node"), "nd-shared")

        # Stars: the most shared class of a list is the partner of the others.
        centre = shared.groupBy("entry").agg(F.max(F.struct("hits", "long", (-F.col("node")).alias("minus"))).alias("top"), F.count(F.lit(1)).alias("left"))
        centre = centre.where("left > 1").select("entry", (-F.col("top.minus")).alias("centre"))
        marks = lambda k: classes.select(F.col("node").alias(k), F.col("n").alias(f"n_{k}"), F.col("marks").alias(f"marks_{k}"))
        collisions = F.aggregate(F.zip_with("marks_a", "marks_b", lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)

        def matched(pairs: DataFrame) -> DataFrame:
            return pairs.join(marks("a"), "a").join(marks("b"), "b").where(_sizes_fit(percent) & (collisions >= matches)).select("a", "b")

        stars = shared.join(centre, "entry").where("node != centre").select(F.col("node").alias("a"), F.col("centre").alias("b")).distinct()
        sets = stash(_full_sets(docs, classes.join(many.select("node"), "node"), width), "nd-sets")
        confirm = lambda pairs: _confirmed(matched(pairs), sets, percent)
        links = stash(confirm(stars), "nd-stars")
        sets_of = lambda nodes: sets.join(nodes, "node")
        roots = linked(_prefixes(shared, coordinates, matches), sets_of, links, confirm, percent, [lambda ready: _fewest_own(ready, sets_of)])
        keep(rows, classes, roots)

    named = classes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = named.groupBy("root").agg(F.min("low").alias("component_id"))
    of = named.join(least, "root").select(*(F.col(c).alias(f"c_{c}") for c in key), "component_id")
    whole = rows.join(of, [rows[c] == F.col(f"c_{c}") for c in key], "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return whole.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """One row of each group of near-duplicates, all columns kept: that with the least id (null ids come last).

    Rows with an empty set link with nothing and stay. Of rows that repeat id and text, the first by the rest of their
    columns stays.
    """
    with passing(docs.sparkSession) as keep:
        found = near_duplicates(keyed(docs), **options).where("n_shingles > 0")
        found = found.groupBy(F.col("doc_id").alias("key"), F.col("component_id").alias("component")).agg(F.count(F.lit(1)).alias("rows"))
        found = stash(found, "nd-keys")
        groups = found.groupBy(F.col("component").alias("of")).agg(F.sum("rows").alias("all")).where(F.col("all") > 1).select("of")
        grouped = stash(found.join(groups, F.col("component") == F.col("of"), "left_semi"), "nd-groups")
        wanted = small(grouped.select(F.col("key").alias("_wanted")))
        ids = docs.select(row_key().alias("own_key"), "doc_id").join(wanted, F.col("own_key") == F.col("_wanted"), "left_semi")
        ids = ids.groupBy("own_key").agg(F.min("doc_id").alias("doc_id"))
        known = grouped.join(ids, F.col("key") == F.col("own_key")).select("component", "key", "doc_id", "rows")
        first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "key")).alias("first")
        first = known.groupBy(F.col("component").alias("of")).agg(first).select("of", F.col("first.key").alias("stays"))
        known = stash(known.join(first, F.col("component") == F.col("of")), "nd-known")
        keep(known)
    left = without(docs, known.where("key != stays").select("key"))
    again = known.where("key = stays AND rows > 1").select("key")
    if again.isEmpty():
        return left
    rest = F.to_json(F.struct(*(c for c in docs.columns if c not in ("doc_id", "text"))))
    keyed_rows = left.withColumn("_again_key", row_key()).join(small(again.toDF("_again")), F.col("_again_key") == F.col("_again"), "left_semi")
    single = keyed_rows.groupBy("_again_key").agg(F.min_by(F.struct(*docs.columns), rest).alias("_row")).select("_row.*")
    return without(left, again).unionByName(single)


def _sizes_fit(percent: int) -> Column:
    return (F.col("n_a") * percent <= F.col("n_b") * 100) & (F.col("n_b") * percent <= F.col("n_a") * 100)


def _several(entries: DataFrame, roots: DataFrame) -> DataFrame:
    """``entries`` with their roots, of lists that hold more than one component."""
    apart = entries.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    lists = apart.groupBy("entry").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).where("r0 != r1").select("entry")
    return apart.join(lists, "entry")


def linked(
    entries: DataFrame,
    sets_of: Callable[[DataFrame], DataFrame] | None,
    links: DataFrame,
    confirm: Callable[[DataFrame], DataFrame],
    percent: int,
    partners: Sequence[Callable[[DataFrame], DataFrame]],
    candidates: Callable[[DataFrame], DataFrame] | None = None,
    rarest: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """node, root of every linked node: ``links`` (a, b) and all links between nodes that share an entry.

    ``entries`` holds entry and node; ``sets_of`` returns node, n and shingles of nodes (and their other columns);
    ``confirm`` returns the links among pairs (a, b). Lists that hold several components after ``links`` are handed to
    each of ``partners`` in turn, with the root of each node, which returns a few pairs for each row. What still holds
    several components then is joined by rarest shingles. With ``candidates`` all this is for the lists that ``entries``
    says are ``many``: of the others it returns the pairs (a, b, low and high root, met) of different components. One
    pair of every two components, that which has most in common, is confirmed before the rest. ``rarest`` may do for
    nodes (and their roots) what ``_rarest`` does for their sets.
    """
    with passing(entries.sparkSession) as keep:
        ready = stash(_several(entries, components(links)), "nd-open")
        for propose in partners:
            if candidates and ready.where("many").isEmpty():
                break
            links = stash(links.unionByName(confirm(propose(ready))), "nd-links")
            ready = stash(_several(ready.drop("root"), components(links)), "nd-apart")
        apart = ready.where("many") if candidates else ready
        apart = stash(apart.select("node", "root").distinct(), "nd-nodes")
        pairs = None
        if not candidates or not apart.isEmpty():
            rare = rarest(apart) if rarest else _rarest(sets_of(apart), percent)
            pairs = _rare_pairs(stash(rare, "nd-rarest"), percent)
        if candidates:
            short = candidates(ready.where("not many"))
            pairs = short if pairs is None else pairs.unionByName(short)
        pairs = pairs.groupBy("a", "b", "low", "high").agg(F.max("met").alias("met"))
        pairs = stash(pairs, "nd-pairs")
        best = pairs.groupBy("low", "high").agg(F.max(F.struct("met", "a", "b")).alias("best")).select("best.a", "best.b")
        links = stash(links.unionByName(confirm(best)), "nd-best")
        rest = pairs.join(best, ["a", "b"], "left_anti").select("a", "b")
        ends = components(links)
        now = ends.select(F.col("node").alias("was"), F.col("root").alias("now"))
        root = lambda k: F.coalesce("now", k)
        rest = rest.join(now, F.col("a") == F.col("was"), "left").select("a", "b", root("a").alias("root_a"))
        rest = rest.join(now, F.col("b") == F.col("was"), "left").select("a", "b", "root_a", root("b").alias("root_b"))
        more = stash(confirm(rest.where("root_a != root_b").select("a", "b")), "nd-more")
        roots = ends if more.isEmpty() else components(links.unionByName(more))
        keep(roots)
    return roots


def _rare_pairs(rare: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different roots that share rare shingles (of ``_rarest``) and may reach the threshold, with the
    roots and how many of these shingles they share."""
    x, y = (rare.select("shingle", *(F.col(c).alias(f"{c}_{k}") for c in ("node", "n", "root", "at"))) for k in "ab")
    reach = _similar(F.col("n_a"), F.col("n_b"), F.least(F.col("n_a") - F.col("at_a") + 1, F.col("n_b") - F.col("at_b") + 1), percent)
    others = (F.col("node_a") < F.col("node_b")) & (F.col("root_a") != F.col("root_b"))
    pairs = x.join(y, (x["shingle"] == y["shingle"]) & others & _sizes_fit(percent) & reach)
    both = (F.least("root_a", "root_b").alias("low"), F.greatest("root_a", "root_b").alias("high"))
    return pairs.groupBy(F.col("node_a").alias("a"), F.col("node_b").alias("b"), *both).agg(F.count(F.lit(1)).alias("met"))


def _fewest_own(ready: DataFrame, sets_of: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Each list's class with the fewest shingles of its own, as an original is of its copies, as partner of the others."""
    single = sets_of(ready.select("node").distinct()).select("node", F.explode("shingles").alias("shingle")).groupBy("shingle")
    single = single.agg(F.count(F.lit(1)).alias("in"), F.min("node").alias("node")).where("in = 1")
    own = single.groupBy("node").agg(F.count(F.lit(1)).alias("own"))
    ready = stash(ready.join(own, "node", "left").select("entry", "node", (-F.coalesce("own", F.lit(0))).alias("shared")), "nd-ready")
    partner = ready.groupBy("entry").agg(F.max(F.struct("shared", (-F.col("node")).alias("minus"))).alias("top"))
    partner = partner.select("entry", (-F.col("top.minus")).alias("centre"))
    return ready.join(partner, "entry").where("node != centre").select(F.col("node").alias("a"), F.col("centre").alias("b")).distinct()


def _prefixes(shared: DataFrame, coordinates: int, matches: int) -> DataFrame:
    """Of each node's entries the rarest ``coordinates - matches + 1``; entries that no other node has come first."""
    listed = shared.groupBy("node").agg(F.array_sort(F.collect_list(F.struct("long", "entry"))).alias("entries"), F.first("hits").alias("hits"))
    first = F.greatest(F.lit(0), F.col("hits").cast("int") - F.lit(matches - 1))
    return listed.withColumn("entries", F.slice("entries", F.lit(1), first)).select("node", F.explode("entries.entry").alias("entry"))


def _rarest(sets: DataFrame, percent: int) -> DataFrame:
    """Of each of ``sets`` (node, n, root, shingles) the rarest shingles, as many as cannot all be missing in a set that
    reaches the threshold with it, with their place ``at`` in the order of rarity; those that no other set has are left out.
    """
    each = sets.select("node", "n", "root", F.explode("shingles").alias("shingle"))
    often = each.groupBy("shingle").agg(F.count(F.lit(1)).alias("often")).where("often > 1")
    listed = each.join(often, "shingle").groupBy("node", "n", "root").agg(F.array_sort(F.collect_list(F.struct("often", "shingle"))).alias("shared"))
    own = (F.col("n") - F.size("shared")).cast("int")
    prefix = (F.col("n") - F.ceil(F.col("n") * percent / 100) + 1).cast("int")
    first = listed.withColumn("own", own).withColumn("shared", F.slice("shared", F.lit(1), F.greatest(F.lit(0), prefix - own)))
    return first.select("node", "n", "root", "own", F.posexplode("shared.shingle").alias("k", "shingle")).select(
        "node", "n", "root", "shingle", (F.col("own") + F.col("k") + 1).alias("at")
    )


def _full_sets(docs: DataFrame, classes: DataFrame, width: int) -> DataFrame:
    """node, n, shingles of ``classes``, computed anew from the text of each class's least document."""
    wanted = small(classes.select("low").distinct())
    found = _sketches(docs.join(wanted, docs["doc_id"].eqNullSafe(F.col("low")), "left_semi"), width, None)
    # One of each set: rows that repeat an id and a text would pair with one another's partners.
    found = found.groupBy(*(F.col(c).alias(f"f_{c}") for c in ("n", "set_a", "set_b"))).agg(F.first("marks").alias("shingles"))
    same = [F.col(c) == F.col(f"f_{c}") for c in ("n", "set_a", "set_b")]
    return classes.join(found, same).select("node", "n", "shingles")
