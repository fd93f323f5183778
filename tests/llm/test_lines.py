import random
from collections import Counter, defaultdict

import pyarrow as pa

from tallgrass.llm import lines
from tallgrass.llm.lines import fuzzy_lines, without_fuzzy_lines


def brute(docs, width=7, percent=80):
    lines = [(d, k, line) for d, text in docs for k, line in enumerate((text or "").split("\n")) if line.strip()]
    sets = {line: {line[k : k + width] for k in range(max(1, len(line) - width + 1))} for _, _, line in lines}
    up = {x: x for x in sets}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    names = list(sets)
    for i, x in enumerate(names):
        for y in names[:i]:
            if 100 * len(sets[x] & sets[y]) >= percent * len(sets[x] | sets[y]):
                up[top(x)] = top(y)
    places = defaultdict(list)
    for d, k, line in lines:
        places[top(line)].append((d is None, d or 0, k))
    out = []
    for d, k, line in lines:
        last, low, at = min(places[top(line)])
        out.append((d, k, None if last else low, at, (d is None, d or 0, k) == (last, low, at)))
    return out


def cases(prose):
    rng = random.Random(2)
    base = prose(1, 30)
    docs = []
    for k in range(60):
        line = list(base)
        for _ in range(rng.randint(0, 3)):
            line[rng.randrange(len(line))] = rng.choice("xyz")
        docs.append((k, "\n".join([prose(100 + k, 12), "".join(line), "Read more", "", prose(200 + k // 2, 10), " "])))
    return docs + [(70, None), (71, ""), (72, "\n\n"), (73, "ok"), (74, "ok"), (75, prose(3, 20_000)), (76, prose(3, 20_000) + "!"), (None, base)]


def test_equals_brute_force(spark, make_docs, prose):
    docs = cases(prose)
    order = lambda r: tuple((x is None, x or 0) for x in r)
    found = fuzzy_lines(make_docs(docs))
    assert sorted(map(tuple, found.collect()), key=order) == sorted(brute(docs), key=order)


def test_texts_and_repeated_rows(spark, make_docs):
    docs = [(1, "same line here\nother"), (2, "same line here\n\nlast"), (2, "same line here\n\nlast"), (3, None)]
    found = without_fuzzy_lines(make_docs(docs)).collect()
    assert sorted(map(tuple, found), key=str) == sorted([(1, "same line here\nother"), (2, "\nlast"), (2, "\nlast"), (3, None)], key=str)
    assert fuzzy_lines(make_docs([])).collect() == []


def test_rarest_shingles_first():
    """Of the sets of some lines, each line's first shingles by rarity, with their places."""
    texts = ["abcdefghij klmnop", "abcdefghij klmnoq", "abcdefghij xxxxxxx", "other words than these"]
    batch = pa.RecordBatch.from_pydict({"node": pa.array(range(4), pa.int64()), "characters": texts})
    counted = lines._counted(1)(lines._occurrences(7, 1)([batch]))
    found = lines._rarest_first(80)([b for x in counted for b in x.column(1).to_pylist()]).to_pylist()
    sets = [{t[k : k + 7] for k in range(len(t) - 6)} for t in texts]
    often = Counter(x for s in sets for x in s)
    for node, own in enumerate(sets):
        alone = sum(often[x] == 1 for x in own)
        prefix = len(own) - -(-len(own) * 80 // 100) + 1
        rows = [r for r in found if r["node"] == node]
        assert len(rows) == max(0, min(prefix, len(own)) - alone) and all(r["n"] == len(own) for r in rows)
        assert sorted(r["at"] for r in rows) == list(range(alone + 1, alone + 1 + len(rows)))


def test_long_and_hot_lists(spark, make_docs, prose):
    """Lines of which a hundred and more share band values, in lists that are dealt out as well, lose no link."""
    rng = random.Random(9)
    base, docs = prose(5, 40), []
    for k in range(260):
        line = list(base)
        for _ in range(rng.randint(0, 6)):
            line[rng.randrange(len(line))] = rng.choice("xyz")
        docs.append((k, "".join(line) + "\n" + prose(1000 + k // 3, 8)))
    order = lambda r: tuple((x is None, x or 0) for x in r)
    for frame in (make_docs(docs).coalesce(1), make_docs(docs).repartition(7)):
        assert sorted(map(tuple, fuzzy_lines(frame).collect()), key=order) == sorted(brute(docs), key=order)
