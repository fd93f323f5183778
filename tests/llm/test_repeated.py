import hashlib
import random

import numpy as np
import pytest

from tallgrass.llm.repeated import remove_repeats
from tallgrass.llm.suffixes import anchors, ranks, repeats


def test_ranks_order_suffixes():
    rng = np.random.default_rng(0)
    for _ in range(150):
        text = rng.integers(1, rng.integers(2, 5), rng.integers(1, 150))
        cover = int(rng.choice([4, 20, 1000]))
        own = [tuple(text[k : k + cover]) for k in np.argsort(ranks(text, cover), kind="stable")]
        assert own == sorted(own)


def test_repeats():
    rng = np.random.default_rng(1)
    for _ in range(100):
        text = rng.integers(97, 99, 200).astype(np.uint8)
        length = int(rng.integers(3, 15))
        starts = np.sort(rng.choice(200 - length + 1, 60, replace=False))
        seen, expected = set(), []
        for k in starts:
            if (own := text[k : k + length].tobytes()) in seen:
                expected.append(k)
            seen.add(own)
        assert sorted(repeats(text, starts, length)) == expected


def test_anchors_cover_every_window_once():
    rng = np.random.default_rng(2)
    sizes = [0, 5, 19, 20, 21, 300, 0, 77]
    offsets = np.cumsum([0, *sizes])
    data = rng.integers(97, 100, offsets[-1]).astype(np.uint8)
    text, first, last, anchor, _, _ = anchors(data, offsets, 20, 8)
    windows = sorted((t, p) for t, a, b in zip(text, first, last) for p in range(a, b + 1))
    assert windows == [(t, p) for t, n in enumerate(sizes) for p in range(n - 19)]
    assert ((anchor >= last) & (anchor - first <= 12)).all()


def brute(docs, length):
    """In ascending order of id; ids are distinct."""
    seen, out = set(), {}
    for doc_id, text in sorted(docs, key=lambda r: (r[0] is not None, r[0] or 0)):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for k in range(len(raw) - length + 1):
            own = raw[k : k + length]
            if own in seen:
                gone[k : k + length] = b"\1" * length
            seen.add(own)
        kept = bytes(x for x, g in zip(raw, gone) if not g)
        out[doc_id] = (len(raw), sum(gone), len([x for x in bytes(gone).split(b"\0") if x]), hashlib.sha256(kept).hexdigest(), kept)
    return out


@pytest.mark.parametrize("length", [20, 100])
def test_equals_brute_force(spark, make_docs, prose, length):
    rng = random.Random(length)
    shared = [prose(900 + k, rng.randint(5, 40)) for k in range(6)]
    docs = []
    for k in range(80):
        parts = [prose(k, rng.randint(0, 30))] + rng.sample(shared, rng.randint(0, 3)) + [prose(k + 500, rng.randint(0, 30))]
        rng.shuffle(parts)
        docs.append((k, "é ".join(parts)))
    docs += [(100 + k, docs[3][1]) for k in range(20)] + [(130 + k, docs[5][1][k * 3 :]) for k in range(20)]
    docs += [(200, None), (201, ""), (202, "a" * 5000), (203, "a" * 5000), (204, "ab" * 700), (None, docs[7][1]), (205, prose(6, 20_000)), (206, prose(6, 20_000)[77:])]
    expected = brute(docs, length)
    found = remove_repeats(make_docs(docs), length).collect()
    assert len(found) == len(docs)
    for r in found:
        assert tuple(r)[1:] == expected[r.doc_id], r.doc_id


def test_repeated_rows_are_one_document(spark, make_docs, prose):
    text = prose(1, 60)
    found = remove_repeats(make_docs([(5, text), (5, text), (6, text)]), 50).collect()
    assert [r.n_removed for r in found if r.doc_id == 5] == [0, 0]
    assert [r.n_removed for r in found if r.doc_id == 6] == [len(text)]
    assert remove_repeats(make_docs([]), 50).collect() == []


def test_repeated_rows_with_open_runs(spark, make_docs, prose):
    """What a repeated row has in common with others in part is kept by all of its rows if it comes first."""
    shared = prose(1, 60)
    for first in (5, None):
        docs = [(first, shared + prose(2, 60)), (6, shared + prose(3, 60)), (7, prose(4, 20) + shared + prose(5, 60))]
        expected = brute(docs, 50)
        found = remove_repeats(make_docs([docs[0]] * 3 + docs[1:] + docs[-1:]), 50).collect()
        assert len(found) == 6 and expected[first][1] == 0 and expected[7][1] > 0
        for r in found:
            assert tuple(r)[1:] == expected[r.doc_id], r.doc_id


def test_other_numbers_give_the_same_windows():
    """Whatever numbers are drawn, equal windows of two texts have anchors at one distance and equal names."""
    rng = np.random.default_rng(8)
    data = rng.integers(97, 123, 900).astype(np.uint8)
    data[500:700] = data[100:300]
    for seed in (1, 2, 3):
        text, first, last, anchor, string, whole = anchors(data, np.array([0, 450, 900]), 100, 40, seed)
        inside = lambda t, a, b: {(x - a, y - a, s, w) for k, x, y, s, w in zip(text, first, last, string, whole) if k == t and x > a and y < b}
        assert inside(0, 100, 200) == inside(1, 50, 150) != set()


def test_a_copy_of_the_case_that_lost_bytes(spark, make_docs, prose):
    """Rows 5, 5 and 6, or 5, 6 and 6, with one passage in common: the first document keeps all its bytes."""
    shared = prose(11, 70)
    five, six = (5, prose(12, 30) + shared + prose(13, 30)), (6, prose(14, 30) + shared + prose(15, 30))
    alone = {r.doc_id: r.n_removed for r in remove_repeats(make_docs([five, six])).collect()}
    assert alone[5] == 0 < alone[6]
    for rows in ([five, five, six], [five, six, six]):
        assert all(r.n_removed == alone[r.doc_id] for r in remove_repeats(make_docs(rows)).collect())
