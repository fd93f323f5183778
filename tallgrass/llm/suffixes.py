"""Local part of the repeated-substring search: anchors of windows, and a difference-cover suffix array in numpy."""

from __future__ import annotations

import numpy as np

_STEP = np.uint64(0x9E3779B97F4A7C15)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    out[1:] = base
    return np.multiply.accumulate(out)


class Prefixes:
    """Hashes of any substring of ``data`` by its prefix sums; ``seed`` gives each byte's number and the base."""

    def __init__(self, data: np.ndarray, seed: int = 23):
        n = len(data)
        drawn = np.random.default_rng(seed).integers(0, 1 << 63, 257, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        numbers, base = drawn[:256], drawn[256]
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(numbers[data] * _powers(base, n), out=self.sums[1:])
        self.scale = _powers(np.uint64(pow(int(base), -1, 1 << 64)), n + 1)

    def of(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        x = (self.sums[end] - self.sums[begin]) * self.scale[begin]
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(29))


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of x[i : i + width] for every i that has as many."""
    n = len(x) - width + 1
    padded = np.full(-(-len(x) // width) * width, np.iinfo(x.dtype).max, x.dtype)
    padded[: len(x)] = x
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def anchors(data: np.ndarray, offsets: np.ndarray, length: int, size: int, seed: int = 23) -> tuple[np.ndarray, ...]:
    """The windows of ``length`` bytes of all texts, put together by anchor.

    The anchor of a window is that of its ``size``-byte strings with the least hash, the first of equal ones; it depends
    on the window's bytes alone, so equal windows have equal anchors at one distance. Neighbouring windows with one
    anchor make a run. Returns of each run: its text's number, its first window's and its last window's place in the
    text, the anchor's place, the hash of the anchor's string, and the hash of all bytes of the run.
    """
    none = tuple(np.zeros(0, t) for t in (np.int64,) * 4 + (np.uint64,) * 2)
    if len(data) < length:
        return none
    prefixes = Prefixes(data, seed)
    begin = np.arange(len(data) - size + 1)
    strings = prefixes.of(begin, begin + size)
    bits = np.uint64(max(1, int(len(data)).bit_length()))
    least = _sliding_min((strings >> bits << bits) | begin.astype(np.uint64), length - size + 1)
    ends = np.repeat(offsets[1:], np.diff(offsets))[: len(least)]
    valid = np.arange(len(least)) + length <= ends
    places = np.flatnonzero(valid)
    if not len(places):
        return none
    at = (least[places] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    new = np.append(True, (at[1:] != at[:-1]) | (places[1:] != places[:-1] + 1))
    first = places[new]
    last = places[np.append(np.flatnonzero(new)[1:] - 1, len(places) - 1)]
    anchor = at[new]
    text = np.searchsorted(offsets, first, "right") - 1
    whole = prefixes.of(first, last + length) + (anchor - first).astype(np.uint64) * _STEP + (last - first).astype(np.uint64)
    return text, first - offsets[text], last - offsets[text], anchor - offsets[text], strings[anchor], whole


def _named(keys: np.ndarray) -> tuple[int, np.ndarray]:
    """How many distinct keys there are, and each key's place among them."""
    if len(keys) and keys.max() < 4 * len(keys) + (1 << 18):
        there = np.zeros(int(keys.max()) + 1, np.int64)
        there[keys] = 1
        places = np.cumsum(there)
        return int(places[-1]), places[keys] - 1
    distinct, names = np.unique(keys, return_inverse=True)
    return len(distinct), names


def ranks(text: np.ndarray, cover: int) -> np.ndarray:
    """A rank for each suffix of ``text`` (numbers above 0), in order of at least its first ``cover`` numbers.

    The difference cover {1, 2} modulo 3: triples at places outside multiples of 3 are sorted and named; unless the
    names are distinct or already tell apart all that is asked for, the suffixes of the string of names are ranked
    the same way; then the suffixes at multiples of 3 are sorted by their first number and the rank that follows, and
    merged with the others.
    """
    n = len(text)
    padded = np.concatenate([text.astype(np.int64), np.zeros(3, np.int64)])
    top = int(padded.max()) + 1
    sample = np.concatenate([np.arange(1, n, 3), np.arange(2, n, 3)])
    if top < 1 << 21:
        keys = (padded[sample] * top + padded[sample + 1]) * top + padded[sample + 2]
    else:
        pairs = np.unique(padded[sample] * top + padded[sample + 1], return_inverse=True)[1]
        keys = pairs * top + padded[sample + 2]
    distinct, names = _named(keys)
    if distinct < len(sample) and cover > 3:
        ones = len(range(1, n, 3))
        line = np.concatenate([names[:ones] + 1, [0], names[ones:] + 1]) + 1  # a least number keeps the two halves apart
        names = np.delete(ranks(line, -(-cover // 3)), ones)
    rank = np.zeros(n + 3, np.int64)
    rank[sample] = names + 1
    high = int(rank.max()) + 1
    zero = np.arange(0, n, 3)
    one, two = np.arange(1, n, 3), np.arange(2, n, 3)
    after_one = lambda at: padded[at] * high + rank[at + 1]
    after_two = lambda at: (padded[at] * top + padded[at + 1]) * high + rank[at + 2]
    if top * top * high >= 1 << 62:  # too many numbers for one key
        pair = np.unique(padded[:-1] * top + padded[1:], return_inverse=True)[1]
        after_two = lambda at: pair[at] * high + rank[at + 2]
    own = after_one(zero)
    sorted_one, sorted_two = np.sort(after_one(one)), np.sort(after_two(two))
    sorted_own, sorted_long = np.sort(own), np.sort(after_two(zero))
    among = np.sort(rank[sample])
    out = np.empty(n, np.int64)
    out[zero] = np.searchsorted(sorted_own, own) + np.searchsorted(sorted_one, own) + np.searchsorted(sorted_two, after_two(zero))
    out[one] = np.searchsorted(among, rank[one]) + np.searchsorted(sorted_own, after_one(one))
    out[two] = np.searchsorted(among, rank[two]) + np.searchsorted(sorted_long, after_two(two))
    return out


def repeats(text: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Those of ``starts`` whose ``length`` bytes of ``text`` also begin at a smaller one of ``starts``."""
    if len(starts) < 2:
        return starts[:0]
    order = starts[np.argsort(ranks(_named(text.astype(np.int64))[1] + 1, length)[starts], kind="stable")]
    rows = np.lib.stride_tricks.sliding_window_view(text, length)
    same = np.zeros(len(order), bool)
    for a in range(0, len(order), 1 << 16):  # adjacent prefixes
        own = rows[order[max(0, a - 1) : a + (1 << 16)]]
        same[max(1, a) : a + (1 << 16)] = (own[1:] == own[:-1]).all(axis=1)
    begin = np.flatnonzero(~same)
    least = np.minimum.reduceat(order, begin)
    return np.setdiff1d(order, least, assume_unique=True)
