import struct
import zlib

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

from tallgrass.llm import joins, lines, queries, repeated

DATA = "/root/testdata/sf0.001"


def rows_of(frame):
    columns = sorted(frame.columns)
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=lambda r: tuple((x is None, x) for x in r))


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_registered_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    expected = con.execute(queries.ORACLES[name])
    columns = [x[0] for x in expected.description]
    at = [columns.index(c) for c in sorted(columns)]
    found = queries.QUERIES[name](spark, DATA)
    assert sorted(found.columns) == sorted(columns)
    assert rows_of(found) == sorted((tuple(r[k] for k in at) for r in expected.fetchall()), key=lambda r: tuple((x is None, x) for x in r))


@pytest.mark.parametrize("name", ["op2_warc_bundles", "op3_benchmark_containment", "op7_fuzzy_lines", "op8_suffix_array_dedup", "op9_minhash_near_dups"])
def test_the_same_rows_without_any_broadcast(spark, monkeypatch, name):
    sent = rows_of(queries.QUERIES[name](spark, DATA))
    monkeypatch.setattr(joins, "BROADCAST_ROWS", -1)
    monkeypatch.setattr(lines, "BROADCAST_BYTES", -1)
    monkeypatch.setattr(repeated, "BROADCAST_BYTES", -1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert rows_of(queries.QUERIES[name](spark, DATA)) == sent
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_registered_token_files(spark):
    tokenizer = Tokenizer.from_file(queries.tokenizer_file())
    at, expected = 0, []
    for r in spark.read.parquet(f"{DATA}/documents.parquet").orderBy("doc_id").collect():
        ids = [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 2]
        expected.append((r.doc_id, at, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        at += len(ids)
    found = queries.QUERIES["op4_token_files"](spark, DATA).select("doc_id", "start", "n_tokens", "ids_crc32")
    assert [tuple(r) for r in found.orderBy("doc_id").collect()] == expected


def test_registered_neighbours(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{DATA}/embeddings.parquet").collect()]
    ids, vectors = np.array([i for i, _ in rows]), np.array([v for _, v in rows], np.float64)
    expected = []
    for q in np.flatnonzero(ids % 20 == 0):
        scores = (vectors * vectors[q]).sum(axis=1)
        order = [k for k in np.lexsort((ids, -scores)) if k != q][:20]
        expected += [(int(ids[q]), n + 1, int(ids[k]), scores[k]) for n, k in enumerate(order)]
    found = queries.QUERIES["op6_graph_neighbours"](spark, DATA).orderBy("query_id", "rank").collect()
    right = sum(tuple(r) == x for r, x in zip(found, sorted(expected), strict=True))
    assert right >= 0.95 * len(expected)
