import numpy as np

from tallgrass.llm import language as L
from tallgrass.llm.queries import op1_language_id

DATA = "/root/testdata/sf0.001"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "lang")
    rows = op1_language_id(spark, DATA).join(docs, "doc_id").where("held_out").collect()
    assert len(rows) > 20
    assert np.mean([r.lang == r.lang_pred for r in rows]) >= 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_defined_cases(spark, make_docs, prose):
    rows = [(k, f"alpha {prose(k, 40)}" if k % 2 else f"ωμέγα {prose(k, 40).replace('a', 'α')}", "la" if k % 2 else "el", "s") for k in range(60)]
    net = L.learn(make_docs(rows))
    odd = [(None, None), (1, None), (2, ""), (3, "12 %% 34"), (4, "a"), (5, "α" * 100_000), (5, "α" * 100_000), (6, rows[1][1])]
    found = [tuple(r) for r in L.identify(make_docs(odd), net).collect()]
    assert len(found) == len(odd)
    by_id = {}
    for doc_id, lang, score in found:
        by_id.setdefault(doc_id, []).append((lang, score))
    assert by_id[None] == by_id[1] == by_id[2] == by_id[3] == [("und", 0.0)]
    assert by_id[4][0][0] in ("la", "el")
    assert by_id[5][0] == by_id[5][1] and by_id[5][0][0] == "el"
    assert by_id[6][0][0] == "la"
    kept = L.accepted(make_docs(odd), net)
    assert kept.columns == make_docs(odd).columns
    assert {r.doc_id for r in kept.collect()} <= {4, 5, 6} and {5, 6} <= {r.doc_id for r in kept.collect()}


def test_nothing_to_learn_from(spark, make_docs):
    assert L.learn(make_docs([])) is None
    assert L.learn(make_docs([(1, "abc", None, "s")])) is None
    assert [tuple(r) for r in L.identify(make_docs([(1, "abc")]), None).collect()] == [(1, "und", 0.0)]


def test_pairs_give_the_plain_convolution():
    rng = np.random.default_rng(0)
    net = L.train(rng.integers(1, 256, (40, L.WINDOW), dtype=np.uint8), np.arange(40) % 3, ["a", "b", "c"], epochs=1)
    x = rng.integers(0, 256, (70, L.WINDOW), dtype=np.uint8)
    most = np.concatenate([c.max(axis=1) for c in L._convolved(net, x)], axis=1)
    plain = L.softmax(np.maximum(most + net.bias, 0) @ net.weights + net.offset)
    np.testing.assert_allclose(L.Applied(net).probabilities(x), plain, rtol=1e-3, atol=1e-5)


def test_windows_hold_all_bytes():
    texts = [b"", b"x" * 5, b"y" * L.WINDOW, b"z" * (2 * L.WINDOW + 1)]
    data = np.frombuffer(b"".join(texts), np.uint8)
    cut, counts, full = L.windows(data, np.cumsum([0, *map(len, texts)]))
    assert counts.tolist() == [0, 1, 1, 3] and full.sum() == len(data)
    assert b"".join(bytes(w[:n]) for w, n in zip(cut, full)) == bytes(data)


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(4)
    total = L.FILTERS * len(L.WIDTHS)
    net = L.Network(["a", "b", "c"], [rng.normal(0, 0.5, (w, 256, L.FILTERS)) for w in L.WIDTHS], rng.normal(0, 0.1, total), rng.normal(0, 0.5, (total, 3)), rng.normal(0, 0.1, 3))
    x, y = rng.integers(97, 101, (9, L.WINDOW), dtype=np.uint8), np.arange(9) % 3

    def loss():
        most = np.concatenate([c.max(axis=1) for c in L._convolved(net, x)], axis=1) + net.bias
        return -np.log(L.softmax(np.maximum(most, 0) @ net.weights + net.offset)[np.arange(9), y]).mean()

    parameters = [*net.filters, net.bias, net.weights, net.offset]
    for values, slopes in zip(parameters, L.gradients(net, x, y), strict=True):
        assert slopes.shape == values.shape
        at = [np.unravel_index(k, values.shape) for k in np.argsort(-np.abs(slopes).ravel())[: min(12, values.size)]]
        for k in at:
            was, step = values[k], 1e-6
            values[k] = was + step
            up = loss()
            values[k] = was - step
            down = loss()
            values[k] = was
            np.testing.assert_allclose((up - down) / (2 * step), slopes[k], rtol=1e-4, atol=1e-8)


def test_repeated_rows_ties_and_empty_tables(spark, make_docs, prose):
    rows = [(k, prose(k, 40), "la" if k % 2 else "el", "s") for k in range(40)]
    repeated = L.learn(make_docs(rows + [rows[4]] * 300 + [(None, "x", "la", "s")] * 50))
    assert all((a == b).all() for a, b in zip(L.learn(make_docs(rows)).filters, repeated.filters))
    net = L.Network(["a", "b"], [np.zeros((w, 256, L.FILTERS), np.float32) for w in L.WIDTHS], np.zeros(48, np.float32), np.zeros((48, 2), np.float32), np.zeros(2, np.float32))
    assert [tuple(r) for r in L.identify(make_docs([(1, "tie")]), net).collect()] == [(1, "a", 0.5)]
    assert L.identify(make_docs([]), net).collect() == []
