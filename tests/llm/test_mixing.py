from collections import defaultdict

import duckdb
import pandas as pd
import pytest

from tallgrass.llm.mixing import mix, repeated
from tallgrass.llm.queries import ORACLES, op10_mix_sources

DATA = "/root/testdata/sf0.001"


def filled(sizes, weights=(3, 1, 2), share=1.5, epochs=2.0):
    """Targets by repeated clamping and resharing."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    left, open_ = share * sum(sizes.values()), list(names)
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target = dict.fromkeys(names, 0.0)
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = [s for s in open_ if weight[s] * level > epochs * sizes[s]]
        if not full:
            target |= {s: weight[s] * level for s in open_}
            break
        for s in full:
            target[s] = epochs * sizes[s]
            left -= target[s]
            open_.remove(s)
    return target


def check(rows, docs):
    sizes, taken = defaultdict(int), defaultdict(int)
    for _, text, _, source in docs:
        sizes[source] += len((text or "").split())
    target = filled(dict(sizes))
    largest = defaultdict(int)
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source])
        assert r.taken == r.copies * r.size <= 2 * r.size
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    for s in sizes:
        assert abs(taken[s] - target[s]) <= largest[s] / 2 + 1e-6


def test_targets_are_met(spark, make_docs, prose):
    docs = [(k, prose(k, 1 + k * 37 % 90), "en", f"s{k % 7 if k % 3 else 0}") for k in range(400)]
    docs += [(500, None, "en", "s1"), (501, "", "en", "none"), (502, "a b", "en", None), (None, "a b c", "en", "s2"), (9, "x y", "en", "s3"), (9, "x y", "en", "s3"), (503, prose(1, 20_000), "en", "s4")]
    rows = mix(make_docs(docs)).collect()
    assert len(rows) == len(docs)
    check(rows, docs)
    assert sorted(map(str, rows)) == sorted(map(str, mix(make_docs(docs).repartition(5)).collect()))
    out = repeated(make_docs(docs))
    assert out.columns == make_docs(docs).columns
    assert out.count() == sum(r.copies for r in rows)


def test_other_shares_and_empty(spark, make_docs, prose):
    docs = [(k, prose(k, 20), "en", "ab"[k % 2]) for k in range(20)]
    assert sum(r.taken for r in mix(make_docs(docs), share=9.0).collect()) == 2 * 400
    assert mix(make_docs([])).collect() == []


def test_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{DATA}/documents.parquet'")
    expected = con.execute(ORACLES["op10_mix_sources"]).fetchdf().sort_values("doc_id").reset_index(drop=True)
    found = op10_mix_sources(spark, DATA).toPandas().sort_values("doc_id").reset_index(drop=True)
    pd.testing.assert_frame_equal(found, expected[found.columns], check_dtype=False)


def test_rows_without_an_id_are_taken_apart(spark, make_docs, prose):
    """They are drawn by their texts, so targets between whole repetitions are met among them as well."""
    docs = [(None, prose(k, 5 + k % 9), "en", "a") for k in range(200)] + [(k, prose(k, 20), "en", "b") for k in range(200)]
    rows = mix(make_docs(docs), share=1.2).collect()
    check_share = {s: (sum(r.taken for r in rows if r.source == s), next(r.target for r in rows if r.source == s)) for s in "ab"}
    assert all(abs(taken - target) <= 10 for taken, target in check_share.values())
    assert sorted(map(str, rows)) == sorted(map(str, mix(make_docs(docs).repartition(7), share=1.2).collect()))
