"""Approximate nearest neighbours by a robust-pruned directed graph in each shard.

Vectors are dealt to shards of bounded size by a hash of their ids. In a shard, greedy searches of the graph so far
propose neighbours for each batch of new vectors; of these, nearest first, a candidate is kept unless one that was
kept is closer to it by the factor ``ALPHA`` than the new vector is, so that edges of all directions stay; reverse
edges are added and pruned alike. A query runs a beam search in every shard, the narrower the more shards there are,
and the shards' best are merged.

Largest inner product is nearest distance after one more component, ``sqrt(M**2 - |x|**2)``, is added to each vector
(0 to queries). Equal vectors are one node with all their ids, so thousands of copies neither fill a beam nor hide
an id. Distances that steer a search are single precision; scores are inner products of the original components in
double precision.

Defined cases: vectors that are null, empty, zero, of another length than most, or hold null or non-finite components
take no part, as queries or as candidates, and neither do rows without an id; rows that repeat a query's id are not
its candidates; other repeated rows are candidates each; ties go to the smaller id; an empty table gives an empty
result; only vec_id and embedding are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallgrass.plans.durable import stash

#: Vectors of a shard, about; queries of a block.
SHARD = 16384
BLOCK = 16384
#: Edges of a node, candidates kept while building and while searching, expansions in a step.
DEGREE = 40
BUILD_BEAM = 96
SEARCH_BEAM = 224
LEAST_BEAM = 64
EXPAND = 4
ALPHA = 1.2
#: Vectors inserted, and queries searched, at once.
BATCH = 256
#: Distances between candidates that are held at once.
PRUNED = 1 << 23

_INDEX = "shard long, vec_id long, embedding array<double>, node int, edges array<int>, entry int"


def _distances(a: np.ndarray, rows: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of each row of ``b`` from the rows of ``a`` that ``rows`` names for it."""
    gap = a[rows]
    gap -= b[:, None, :]
    return np.einsum("qkd,qkd->qk", gap, gap)


def beam_search(points: np.ndarray, edges: np.ndarray, entry: int, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each query the best ``beam`` nodes met (-1: none), nearest first, and their squared distances less the query's
    own square."""
    q = len(queries)
    squares = np.einsum("nd,nd->n", points, points)

    def gaps(rows: np.ndarray, of: np.ndarray) -> np.ndarray:
        return squares[rows] - 2 * np.matmul(points[rows], queries[of][:, :, None])[:, :, 0]

    nodes = np.full((q, beam), -1, np.int64)
    nodes[:, 0] = entry
    far = np.full((q, beam), np.inf, np.float32)
    far[:, 0] = gaps(nodes[:, :1], np.arange(q))[:, 0]
    done = np.ones((q, beam), bool)
    done[:, 0] = False
    seen = np.zeros((q, len(points) + 1), bool)  # the last column stands for -1
    seen[:, [entry, -1]] = True
    active = np.arange(q)
    while len(active):
        some_done, some_nodes = done[active], nodes[active]
        order = np.argpartition(np.where(some_done, np.inf, far[active]), EXPAND, axis=1)[:, :EXPAND]
        chosen = np.where(np.take_along_axis(some_done, order, 1), -1, np.take_along_axis(some_nodes, order, 1))
        np.put_along_axis(some_done, order, True, 1)
        new = np.where(chosen[:, :, None] >= 0, edges[chosen], -1).reshape(len(active), -1)
        new = np.sort(new, axis=1)
        new[:, 1:][new[:, 1:] == new[:, :-1]] = -1
        new[seen[active[:, None], new]] = -1
        seen[active[:, None], new] = True
        all_far = np.concatenate([far[active], np.where(new >= 0, gaps(new, active), np.inf).astype(np.float32)], axis=1)
        order = np.argpartition(all_far, beam - 1, axis=1)[:, :beam]
        far[active] = np.take_along_axis(all_far, order, 1)
        nodes[active] = np.take_along_axis(np.concatenate([some_nodes, new], axis=1), order, 1)
        done[active] = np.take_along_axis(np.concatenate([some_done, new < 0], axis=1), order, 1)
        active = active[~done[active].all(axis=1)]
    order = np.argsort(far, axis=1, kind="stable")
    return np.take_along_axis(nodes, order, 1), np.take_along_axis(far, order, 1)


def robust_prune(points: np.ndarray, of: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Up to DEGREE edges (-1: none) of each node of ``of`` out of its candidates (-1: none)."""
    candidates = np.sort(candidates, axis=1)
    candidates[:, 1:][candidates[:, 1:] == candidates[:, :-1]] = -1
    candidates[candidates == of[:, None]] = -1
    gaps = np.where(candidates >= 0, _distances(points, candidates, points[of]), np.inf)
    order = np.argsort(gaps, axis=1, kind="stable")
    candidates, gaps = np.take_along_axis(candidates, order, 1), np.take_along_axis(gaps, order, 1)
    own = points[candidates]
    squares = np.einsum("qkd,qkd->qk", own, own)
    between = squares[:, :, None] + squares[:, None, :] - 2 * np.matmul(own, own.transpose(0, 2, 1))
    alive = candidates >= 0
    out = np.full((len(of), DEGREE), -1, np.int64)
    rows = np.arange(len(of))
    for k in range(DEGREE):
        if not alive.any():
            break
        first = alive.argmax(axis=1)
        some = alive[rows, first]
        out[some, k] = candidates[some, first[some]]
        alive &= ALPHA**2 * between[rows, first] > gaps
        alive[rows, first] = False
    return out


def build(points: np.ndarray) -> tuple[np.ndarray, int]:
    """Edges (node, DEGREE; -1: none) and the entry node of a graph over distinct points."""
    n = len(points)
    edges = np.full((n, DEGREE), -1, np.int64)
    entry = int(_distances(points, np.arange(n)[None, :], points.mean(axis=0, keepdims=True))[0].argmin())
    order = np.random.default_rng(5).permutation(n)
    order = order[order != entry]
    at = 0
    while at < len(order):
        new = order[at : at + min(BATCH, max(1, at))]
        at += len(new)
        found, _ = beam_search(points, edges, entry, points[new], BUILD_BEAM)
        edges[new] = robust_prune(points, new, np.concatenate([found, edges[new]], axis=1))
        source, place = np.nonzero(edges[new] >= 0)
        heads, tails = edges[new][source, place], new[source]
        by_head = np.argsort(heads, kind="stable")
        heads, tails = heads[by_head], tails[by_head]
        touched, begin, count = np.unique(heads, return_index=True, return_counts=True)
        for a in range(0, len(touched), 1024):
            some, c = touched[a : a + 1024], count[a : a + 1024]
            more = np.full((len(some), c.max()), -1, np.int64)
            first = begin[a]
            more[np.repeat(np.arange(len(some)), c), np.arange(c.sum()) - np.repeat(begin[a : a + 1024] - first, c)] = tails[first : first + c.sum()]
            both = np.concatenate([edges[some], more], axis=1)
            both.sort(axis=1)
            both = both[:, ::-1]
            fits = (both >= 0).sum(axis=1) <= DEGREE
            edges[some[fits]] = both[fits, :DEGREE] if both.shape[1] >= DEGREE else np.pad(both[fits], ((0, 0), (0, DEGREE - both.shape[1])), constant_values=-1)
            crowded, width = np.flatnonzero(~fits), both.shape[1]
            step = max(1, PRUNED // (width * width))  # all candidates are pruned at once, however many a node has
            for at_node in range(0, len(crowded), step):
                full = crowded[at_node : at_node + step]
                edges[some[full]] = robust_prune(points, some[full], both[full])
    return edges, entry


def matrix(column: pa.Array) -> np.ndarray:
    return column.values.to_numpy(zero_copy_only=False)[column.offsets[0].as_py() : column.offsets[-1].as_py()].reshape(len(column), -1)


def lifted(vectors: np.ndarray) -> np.ndarray:
    squares = np.einsum("nd,nd->n", vectors, vectors)
    return np.concatenate([vectors, np.sqrt(squares.max() - squares)[:, None]], axis=1).astype(np.float32)


def _by_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    batches = [b for b in batches if b.num_rows]  # the shards of a task, of bounded size
    rows = pa.Table.from_batches(batches).combine_chunks() if batches else None
    for shard in np.unique(rows["shard"].to_numpy()) if batches else []:
        own = rows.filter(pa.compute.equal(rows["shard"], shard)).combine_chunks()
        vectors = matrix(own["embedding"].chunk(0))
        distinct, node = np.unique(vectors, axis=0, return_inverse=True)
        edges, entry = build(lifted(distinct))
        node = node.ravel()
        lists = pa.array([[int(e) for e in edges[k] if e >= 0] for k in node], pa.list_(pa.int32()))
        columns = [own["shard"].chunk(0), own["vec_id"].chunk(0), own["embedding"].chunk(0), pa.array(node.astype(np.int32)), lists, pa.array(np.full(len(node), entry, np.int32))]
        yield pa.RecordBatch.from_arrays(columns, names=["shard", "vec_id", "embedding", "node", "edges", "entry"])


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding (double) of the rows that take part."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    embedding = F.col("embedding").cast("array<double>")
    good = vectors.select("vec_id", embedding.alias("embedding")).where(
        F.col("vec_id").isNotNull() & F.forall("embedding", finite) & F.exists("embedding", lambda x: x != 0)
    )
    most = good.groupBy(F.size("embedding").alias("length")).count().orderBy(F.desc("count"), "length").limit(1).select("length")
    return good.join(F.broadcast(most), F.size("embedding") == F.col("length"), "left_semi")


def build_index(vectors: DataFrame, shard: int = SHARD) -> DataFrame:
    """The graph of every shard: a row per vector that takes part, with its node's edges."""
    good = stash(usable(vectors), "ann-vectors")
    shards = -(-good.count() // shard) or 1
    dealt = good.select(F.pmod(F.xxhash64("vec_id"), F.lit(shards)).alias("shard"), "vec_id", "embedding")
    # One shard for each task.
    return stash(dealt.repartitionById(shards, F.col("shard").cast("int")).mapInArrow(_by_shard, _INDEX), "ann-index")


def _search(k: int, beam: int):
    def run(key, rows: pa.Table, asked: pa.Table) -> pa.Table:
        ids, scored, found = [], [], []
        if rows.num_rows and asked.num_rows:
            rows, asked = rows.combine_chunks(), asked.combine_chunks()
            vectors, node = matrix(rows["embedding"].chunk(0)), rows["node"].to_numpy()
            members = np.lexsort((rows["vec_id"].to_numpy(), node))  # by node, then by id
            vec_ids = rows["vec_id"].to_numpy()[members]
            begin = np.searchsorted(node[members], np.arange(node.max() + 2))
            distinct = vectors[members[begin[:-1]]]
            edges = np.full((len(distinct), DEGREE), -1, np.int64)
            for j, row in enumerate(members[begin[:-1]].tolist()):
                own = rows["edges"][row].values.to_numpy()
                edges[j, : len(own)] = own
            points, entry = lifted(distinct), rows["entry"][0].as_py()
            queries, query_ids = matrix(asked["embedding"].chunk(0)), asked["query_id"].to_numpy()
            flat = np.concatenate([queries, np.zeros((len(queries), 1))], axis=1).astype(np.float32)
            for at in range(0, len(queries), BATCH):
                near, _ = beam_search(points, edges, entry, flat[at : at + BATCH], beam)
                for q, nodes in zip(range(at, at + BATCH), near):
                    nodes = nodes[nodes >= 0]
                    scores = (distinct[nodes] * queries[q]).sum(axis=1)  # row by row: the same for equal vectors anywhere
                    # Of equal vectors no more than the k + 1 smallest ids can be among the k nearest others.
                    own = np.concatenate([np.arange(begin[j], min(begin[j + 1], begin[j] + k + 1)) for j in nodes])
                    score = np.repeat(scores, np.minimum(np.diff(begin)[nodes], k + 1))
                    other = vec_ids[own] != query_ids[q]
                    own, score = own[other], score[other]
                    best = np.lexsort((vec_ids[own], -score))[:k]
                    ids.append(np.full(len(best), query_ids[q]))
                    found.append(vec_ids[own[best]])
                    scored.append(score[best])
        flat = lambda x, t: pa.array(np.concatenate(x) if x else [], t)
        return pa.table({"query_id": flat(ids, pa.int64()), "vec_id": flat(found, pa.int64()), "score": flat(scored, pa.float64())})

    return run


def shard_beam(k: int, shards: int, beam: int) -> int:
    """What is left of ``beam`` in each shard: ids are dealt by hash, so that of the k nearest no shard holds more than
    its share and four standard deviations, but for about once in 10,000 times."""
    share = k / shards
    return max(min(LEAST_BEAM, beam), math.ceil(beam * min(k, share + 4 * math.sqrt(share)) / k))


def search(index: DataFrame, queries: DataFrame, k: int = 20, beam: int = SEARCH_BEAM) -> DataFrame:
    """query_id, rank, vec_id, score of the ``k`` nearest found of each of ``queries`` (vec_id, embedding)."""
    asked = usable(queries).select(F.col("vec_id").alias("query_id"), "embedding").dropDuplicates(["query_id"])
    asked = stash(asked, "ann-queries")
    blocks = -(-asked.count() // BLOCK) or 1
    n_shards = (index.agg(F.max("shard")).first()[0] or 0) + 1
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)).cast("array<long>"))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks))).withColumn("shard", upto(n_shards))
    placed = index.withColumn("block", upto(blocks))
    tasks = max(2 * n_shards * blocks, 1)
    left, right = (x.repartition(tasks, "shard", "block").groupBy("shard", "block") for x in (placed, asked))
    best = left.cogroup(right).applyInArrow(_search(k, shard_beam(k, n_shards, beam)), "query_id long, vec_id long, score double")
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
