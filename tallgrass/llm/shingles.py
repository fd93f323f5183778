"""Word shingles of whole texts as 64-bit hashes, computed for many texts at once on their UTF-8 bytes.

Words are runs of bytes other than ASCII white space, with A-Z in lower case. A text's set holds the distinct
``width``-word shingles; with fewer words, the whole sequence as one; with none, nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once, about; a longer text is handled by itself.
CHUNK = 1 << 20

_RNG = np.random.default_rng(20240229)
_ODD = lambda n: _RNG.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE = _ODD(256)
_PLACE = _ODD(1 << 12)
_STEP = _ODD(1 << 12)
_JOIN = _ODD(64)
_BYTE[65:91] = _BYTE[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the n + 1 offsets into them; nulls are empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] and column.buffers()[2].size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]] if len(offsets) else data, offsets - offsets[0]


def chunks(offsets: np.ndarray, size: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of texts that hold about ``size`` bytes."""
    at, n = 0, len(offsets) - 1
    while at < n:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
        yield at, min(end, n)
        at = min(end, n)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word, in order, and how many words each text has."""
    word = ~_SPACE[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    begins = word.copy()
    begins[1:] &= ~word[:-1] | first[1:-1]
    starts = np.flatnonzero(begins)
    counts = np.diff(np.searchsorted(starts, offsets))
    if not len(starts):
        return np.zeros(0, np.uint64), counts
    at = np.flatnonzero(word)
    begin = np.flatnonzero(begins[at])
    place = np.arange(len(at)) - np.repeat(begin, np.diff(np.append(begin, len(at))))
    weight = _PLACE[place & 4095]
    if place.max() > 4095:
        weight = weight * _STEP[(place >> 12) & 4095] + (place >> 24).astype(np.uint64)
    return mixed(np.add.reduceat(_BYTE[data[at]] * weight, begin)), counts


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct shingle hashes, ascending, one text after another; and how many each has."""
    words, counts = word_hashes(data, offsets)
    ends = np.cumsum(counts)
    starts = ends - counts
    n = len(words)
    sums = np.zeros(max(0, n - width + 1), np.uint64)
    for j in range(width):
        sums += words[j : n - width + 1 + j] * _JOIN[j]
    sums = mixed(sums)
    sets, sizes = [], np.zeros(len(counts), np.int64)
    for k in np.flatnonzero(counts):
        a, b = starts[k], ends[k]
        if b - a < width:
            short = (words[a:b] * _JOIN[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
            own = mixed(np.array([short], np.uint64))
        else:
            own = np.sort(sums[a : b - width + 1])
            own = own[np.append(True, own[1:] != own[:-1])]
        sets.append(own)
        sizes[k] = len(own)
    return (np.concatenate(sets) if sets else np.zeros(0, np.uint64)), sizes


def signatures(sets: np.ndarray, sizes: np.ndarray, coordinates: int) -> np.ndarray:
    """MinHash of each set that isn't empty: a row of ``coordinates`` minima."""
    factors = np.random.default_rng(7).integers(0, 1 << 63, (2, coordinates), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    sizes = sizes[sizes > 0]
    out = np.empty((len(sizes), coordinates), np.uint64)
    if len(sizes):
        begin = np.cumsum(sizes) - sizes
        for c in range(coordinates):
            out[:, c] = np.minimum.reduceat((sets ^ factors[1, c]) * factors[0, c], begin)
    return out
