import numpy as np
import pytest

from tallgrass.llm import graph_ann as G

SCHEMA = "vec_id long, embedding array<float>, node int, shard string"


def brute(vectors, query_ids, k):
    ids = np.array([i for i, _ in vectors])
    m = np.array([v for _, v in vectors], np.float32).astype(np.float64)
    out = {}
    for q in query_ids:
        scores = m @ m[np.flatnonzero(ids == q)[0]]
        order = [j for j in np.lexsort((ids, -scores)) if ids[j] != q][:k]
        out[q] = [(int(ids[j]), scores[j]) for j in order]
    return out


def searched(spark, vectors, query_ids, **options):
    shard = options.pop("shard", 300)
    frame = spark.createDataFrame([(i, v, 1, "x") for i, v in vectors], SCHEMA)
    found = G.search(G.build_index(frame, shard), frame.where(frame.vec_id.isin([int(q) for q in query_ids])), **options)
    out = {}
    for r in found.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


@pytest.mark.parametrize("normed", [True, False])
def test_recall_and_scores(spark, normed):
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(8, 24))
    m = centres[rng.integers(0, 8, 1500)] + rng.normal(size=(1500, 24)) * 0.7
    m = m / np.linalg.norm(m, axis=1, keepdims=True) if normed else m
    vectors = [(k, v.tolist()) for k, v in enumerate(m)]
    queries = list(range(0, 1500, 50))
    found, exact = searched(spark, vectors, queries, shard=600), brute(vectors, queries, 20)
    hits = [len({i for i, _ in found[q]} & {i for i, _ in exact[q]}) / 20 for q in queries]
    assert np.mean(hits) >= 0.95
    own = {k: np.array(v, np.float32).astype(float) for k, v in vectors}
    for q in queries:
        assert len(found[q]) == 20 and found[q] == sorted(found[q], key=lambda x: (-x[1], x[0]))
        np.testing.assert_allclose([s for _, s in found[q]], [own[i] @ own[q] for i, _ in found[q]], rtol=1e-12)


def test_copies_ties_and_odd_vectors(spark):
    rng = np.random.default_rng(1)
    vectors = [(k, rng.normal(size=6).tolist()) for k in range(40)]
    vectors += [(100 + k, vectors[0][1]) for k in range(400)]
    odd = [(900, None), (901, []), (902, [0.0] * 6), (903, [1.0] * 5), (904, [float("nan")] + [1.0] * 5), (905, [float("inf")] * 6), (906, [None] + [1.0] * 5), (None, [1.0] * 6)]
    queries = [0, 3, 100, 250]
    found = searched(spark, vectors + odd, [*queries, 900, 902, 904], k=20)
    exact = brute(vectors, queries, 20)
    assert set(found) == set(queries)
    for q in queries:
        assert [i for i, _ in found[q]] == [i for i, _ in exact[q]]


def test_few_and_none(spark):
    assert [i for i, _ in searched(spark, [(1, [1.0, 0.0]), (2, [0.5, 1.0]), (2, [0.5, 1.0])], [1])[1]] == [2, 2]
    assert searched(spark, [(1, [1.0, 0.0])], [1]) == {}
    assert searched(spark, [], []) == {}


def test_recall_over_many_shards(spark):
    """With the beam that is left to each of eight shards; some vectors have many neighbours at one distance."""
    rng = np.random.default_rng(3)
    m = np.concatenate([rng.normal(size=(3000, 32)), rng.normal(size=32) + rng.normal(size=(600, 32)) * 0.02, np.repeat(rng.normal(size=(1, 32)), 300, axis=0)])
    vectors = [(k, v.tolist()) for k, v in enumerate(m)]
    queries = list(range(0, 3900, 60))
    found, exact = searched(spark, vectors, queries, shard=500), brute(vectors, queries, 20)
    # Neighbours are right if they are no farther than the last of the exact ones.
    hits = [np.mean([s >= exact[q][-1][1] - 1e-9 for _, s in found[q]]) for q in queries]
    assert np.mean(hits) >= 0.95 and {len(found[q]) for q in queries} == {20}
    assert G.shard_beam(20, 1, 224) == 224 > G.shard_beam(20, 8, 224) > G.shard_beam(20, 1000, 224) == 64


def test_a_node_with_more_candidates_than_edges():
    """All points want the hub; what is pruned keeps every one of them within reach."""
    rng = np.random.default_rng(6)
    points = np.concatenate([np.zeros((1, 16)), rng.normal(size=(700, 16))]).astype(np.float32)
    edges, entry = G.build(points)
    near, _ = G.beam_search(points, edges, entry, points, 64)
    assert (near[:, 0] == np.arange(701)).mean() > 0.99
