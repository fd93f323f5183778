import random

from tallgrass.llm.contamination import contained_items, without_items


def words(text):
    return (text or "").lower().split()


def shingles(text):
    w = words(text)
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)}


def brute(docs, items):
    sets, wanted = {}, {}
    for doc_id, text in docs:
        sets.setdefault(doc_id, set()).update(shingles(text))
    for item_id, text in items:
        wanted.setdefault(item_id, set()).update(shingles(text))
    out = set()
    for d, s in sets.items():
        for i, q in wanted.items():
            if q and 100 * len(s & q) >= 80 * len(q):
                out.add((d, i, len(q), len(s & q), len(s & q) / len(q)))
    return out


def cases(prose):
    rng = random.Random(4)
    items = [(k, prose(1000 + k, rng.randint(6, 60))) for k in range(12)]
    docs = []
    for k in range(60):
        w = prose(k, rng.randint(0, 400)).split()
        for item in rng.sample(items, rng.randint(0, 2)):
            own = item[1].split()
            for _ in range(rng.randint(0, 2)):
                own[rng.randrange(len(own))] = "other"
            at = rng.randint(0, len(w))
            w[at:at] = own
        docs.append((k, " ".join(w)))
    long = prose(77, 20_000)
    docs += [(100, None), (101, ""), (102, "one two"), (None, items[0][1]), (103, items[1][1].upper().replace(" ", "\n")), (104, long + " " + items[2][1]), (105, items[3][1]), (105, items[3][1])]
    items += [(50, None), (51, "too short to match"), (None, items[4][1]), (0, items[0][1])]
    return docs, items


def test_equals_brute_force(spark, make_docs, prose):
    docs, items = cases(prose)
    frame = spark.createDataFrame([(*i, "x", 1) for i in items], "item_id long, text string, doc string, n int")
    found = contained_items(make_docs(docs), frame)
    expected = brute(docs, items)
    assert len(expected) > 20
    assert {tuple(r) for r in found.collect()} == expected
    clean = without_items(make_docs(docs), frame)
    dirty = {d for d, *_ in expected}
    assert clean.columns == make_docs(docs).columns
    assert sorted((r.doc_id, r.text or "") for r in clean.collect()) == sorted((d, t or "") for d, t in docs if d not in dirty)


def test_empty_tables(spark, make_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert contained_items(make_docs([(1, "a b c d e f")]), none).collect() == []
    assert contained_items(make_docs([]), spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")).collect() == []


def test_main_path_is_native(spark, make_docs, prose):
    docs, items = cases(prose)
    frame = spark.createDataFrame(items, "item_id long, text string")
    plan = contained_items(make_docs(docs), frame)._jdf.queryExecution().toString()
    assert "Arrow" not in plan and "Python" not in plan
