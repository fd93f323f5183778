import random
from collections import defaultdict

import pytest

from tallgrass.llm.components import components
from tallgrass.llm.near_dups import enough, near_duplicates


def roots_of(nodes, links):
    up = {n: n for n in nodes}

    def top(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in links:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


@pytest.mark.parametrize("kind", ["none", "path", "star", "random"])
def test_components(spark, kind):
    rng = random.Random(1)
    links = {
        "none": [(3, 3)],
        "path": [(k, k + 1) for k in range(0, 60)] + [(61, 60)],
        "star": [(500, k) for k in range(100)],
        "random": [(rng.randrange(200), rng.randrange(200)) for _ in range(150)],
    }[kind]
    nodes = {x for a, b in links if a != b for x in (a, b)}
    found = components(spark.createDataFrame(links, "a long, b long"))
    assert {r.node: r.root for r in found.collect()} == roots_of(nodes, [x for x in links if x[0] != x[1]])


def shingles(text, width):
    w = [x for x in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (text or "")).replace("\n", " ").split(" ") if x]
    return frozenset(tuple(w[k : k + width]) for k in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)] if w else [])


def brute(docs, width, percent):
    sets = [shingles(t, width) for _, t in docs]
    links = []
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                links.append((j, i))
    root = roots_of(range(len(docs)), links)
    ids = defaultdict(list)
    for k, r in root.items():
        ids[r].append(docs[k][0])
    out = []
    for k, (doc_id, _) in enumerate(docs):
        named = [x for x in ids[root[k]] if x is not None]
        low = (min(named) if named else None) if sets[k] else doc_id
        out.append((doc_id, len(sets[k]), low, doc_id == low))
    return out


def edited(text, rng, n):
    w = text.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = f"w{rng.randrange(10**6)}"
    return " ".join(w)


@pytest.mark.parametrize("width", [4, 5])
def test_equals_brute_force(spark, make_docs, prose, width):
    """A hot group of near copies (some below the threshold), a passage in every third document, copies and odd texts."""
    rng = random.Random(width)
    base, passage = prose(1, 150), prose(2, 40)
    docs = [(10 + k, edited(base, rng, rng.randint(0, 8))) for k in range(120)]
    docs += [(200 + k, prose(300 + k, rng.randint(1, 60)) + (" " + passage if k % 3 == 0 else "")) for k in range(120)]
    docs += [(400 + k, passage + " " + prose(900 + k, 8)) for k in range(30)]
    docs += [(500 + k, edited(prose(5000 + k // 3, 90), rng, k % 3)) for k in range(60)]
    docs += [(600, None), (601, ""), (602, " \n"), (603, "One"), (604, "one"), (605, "one two"), (7, base.upper()), (None, base), (None, "q r s"), (12, "twelve again and more words here")]
    docs += [(700, docs[300][1]), (700, docs[300][1]), (701, prose(8, 30_000)), (702, prose(8, 30_000) + " end")]
    found = near_duplicates(make_docs(docs), width=width)
    order = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(map(tuple, found.collect()), key=order) == sorted(brute(docs, width, 80), key=order)


def test_empty_table(spark, make_docs):
    assert near_duplicates(make_docs([])).collect() == []


def test_threshold():
    assert 12 <= enough(32, 80) < 26
