from collections import Counter
from pathlib import Path

from pyspark.sql import functions as F

import corpus_pipeline
from tallgrass.plans import durable
from tallgrass.plans.durable import stash
from test_contamination import brute as contained
from test_near_dups import brute as near

DATA = "/root/testdata/sf0.001"


def test_stages(spark):
    """Each stage on all that its predecessor kept, against brute force."""
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language ID", "MinHash near-dedup", "benchmark decontamination", "mixing sources to target weights", "token-ID / binary output",
    ]
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, stages = docs.columns, dict(corpus_pipeline.STAGES)
    known = stash(stages["language ID"](spark, docs, DATA), "t-known")
    assert known.columns == columns and known.count() == docs.where("text rlike '[[:alpha:]]|\\\\p{L}'").count()

    texts = sorted((r.doc_id, r.text) for r in known.select("doc_id", "text").collect())
    single = stash(stages["MinHash near-dedup"](spark, known, DATA), "t-single")
    kept = {doc_id for doc_id, _, _, k in near(texts, 5, 80) if k}
    assert single.columns == columns and {r.doc_id for r in single.collect()} == kept

    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    clean = stash(stages["benchmark decontamination"](spark, single, DATA), "t-clean")
    dirty = {d for d, *_ in contained([x for x in texts if x[0] in kept], items)}
    assert clean.columns == columns and {r.doc_id for r in clean.collect()} == kept - dirty

    mixed = stash(stages["mixing sources to target weights"](spark, clean, DATA), "t-mixed")
    words = {r.doc_id: len(r.text.split()) for r in clean.collect()}
    times = Counter(r.doc_id for r in mixed.collect())
    assert mixed.columns == columns and max(times.values()) <= 2
    assert abs(sum(words[d] * n for d, n in times.items()) / sum(words.values()) - 1.5) < 0.1

    tokens = stages["token-ID / binary output"](spark, mixed, DATA).orderBy("start").collect()
    assert Counter(r.doc_id for r in tokens) == times
    assert all(a.start + a.n_tokens == b.start for a, b in zip(tokens, tokens[1:]))


def test_stages_take_odd_and_empty_tables(spark, make_docs):
    odd = make_docs([(None, None, None, None), (1, "", "en", None), (2, "%%", None, "a"), (3, "abc", None, "a"), (3, "abc", None, "a")])
    for docs in (odd, make_docs([])):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, DATA)
            assert out.columns == (docs.columns if name != "token-ID / binary output" else ["doc_id", "start", "n_tokens", "ids"])
            assert out.count() <= 2 * docs.count()


def test_filters_decide_row_by_row(spark, make_docs, prose):
    """Rows without an id and rows that share one do not go with each other."""
    base, copied = prose(1, 80), prose(2, 80)
    item = spark.read.parquet(f"{DATA}/benchmark.parquet").where("length(text) > 60").first().text
    stages = dict(corpus_pipeline.STAGES)
    clean = [(None, prose(10 + k, 60), "en", "a") for k in range(4)] + [(7, prose(20, 60), "en", "a")]

    def left(stage, rows):
        return sorted(((r.doc_id, r.text) for r in stages[stage](spark, make_docs(rows), DATA).collect()), key=str)

    both = lambda rows: sorted(((r[0], r[1]) for r in rows), key=str)
    real = [tuple(r) for r in spark.read.parquet(f"{DATA}/documents.parquet").where("length(text) > 200").select("doc_id", "text", "lang", "source").collect()]
    real += [(None, *r[1:]) for r in real[:4]]
    assert left("language ID", [*real, (None, None, "en", "a"), (real[0][0], "%%", "en", "a")]) == both(real)
    assert left("benchmark decontamination", [*clean, (None, item, "en", "a"), (7, item, "en", "a")]) == both(clean)
    near = [(3, base, "en", "a"), (None, base + " end", "en", "a"), (7, base + " more", "en", "a"), (3, base, "en", "b")]
    near += [(None, copied, "en", "a")] * 3 + [(5, "", "en", "a"), (6, None, "en", "a")]
    assert left("MinHash near-dedup", [*clean, *near]) == both([*clean, near[0], near[4], *near[-2:]])


def test_the_whole_run_equals_its_stages(spark, tmp_path):
    """run() over a folder with rows without ids, shared ids and repeated rows; what it writes in between is deleted."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet").limit(60)
    odd = docs.unionByName(docs.limit(20)).unionByName(docs.orderBy("doc_id").limit(15).withColumn("doc_id", F.lit(None).cast("long")))
    odd.unionByName(docs.limit(5).withColumn("doc_id", F.lit(3).cast("long"))).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{DATA}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    folder = Path(durable.shared_dir(spark).removeprefix("file://")) / "tallgrass"
    before = {x.name for x in folder.iterdir()} if folder.exists() else set()
    found = corpus_pipeline.run(spark, str(tmp_path))
    assert len({x.name for x in folder.iterdir()} - before) == 1
    staged = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        staged = stash(stage(spark, staged, str(tmp_path)), "t-run")
    key = lambda r: (r.doc_id is not None, r.doc_id or 0, r.start)
    assert [tuple(r) for r in sorted(found.collect(), key=key)] == [tuple(r) for r in sorted(staged.collect(), key=key)]
    assert found.where("doc_id IS NULL").count() <= 2 * 15
