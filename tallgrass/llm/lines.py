"""Fuzzy line deduplication by MinHash over character shingles.

A line's set holds its distinct ``width``-character strings (the whole line, if it is shorter). Equal lines form a
class. Signatures of classes are cut into bands of ``ROWS`` minima, and each class is posted under the value of every
band, once a task, together with ``BITS`` bits of each of its minima. Lines that agree in a band and in at least
``AGREE`` of these bit groups are candidates. Postings travel as packed blocks; where they meet, lists without
candidates drop out, and every other list proposes the line that is closest to the rest as the partner of the others.
Candidates are verified by the exact Jaccard similarity of their sets. In lists that still hold several components,
candidates of different components are verified too, the likeliest of every two components first; in lists of more than
``PAIRS`` lines each line proposes the closest one of another component, and what is still apart is joined by rarest
shingles, with an exact bound on what a pair can share, so that no long list is expanded into its pairs. Components of verified links are found by distributed union-find; the first line of a
component, by document and then by place, is kept.

With the default 12 bands of 4 rows a pair at similarity 0.8 becomes a candidate with probability 0.998, one at 0.9
always but for once in 180,000; more links of a component make up for a missed one. The bit groups miss such a pair
about once in 100,000 times. A band value that ``HOT`` lines of one task share is dealt to all tasks by line, so that no
task holds a list of a large part of all lines; each part of it proposes a partner, and these are partners of the least.

Defined cases: null text has no lines; lines that are empty or blank are never duplicates and all stay; lines end at
\\n alone; null ids come last; repeated rows are documents of their own with equal lines, and equal lines of one id and
place are kept or dropped together; an empty table gives an empty result; only doc_id and text are read. Lines are told
apart by 128-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallgrass.llm.joins import row_key
from tallgrass.llm.near_dups import linked
from tallgrass.llm.shingles import chunks, mixed, utf8
from tallgrass.plans.durable import passing, stash
from tallgrass.plans.workers import tidy

BANDS = 12
ROWS = 4
#: Bits of each minimum that a posting carries; of these groups a pair at 0.8 that shares a band agrees in AGREE or more.
BITS = 2
_GROUPS = BANDS * ROWS
_LIKELY = 0.8 + 0.2 / 2**BITS
AGREE = ROWS + math.floor((_GROUPS - ROWS) * _LIKELY - 4.25 * math.sqrt((_GROUPS - ROWS) * _LIKELY * (1 - _LIKELY)))
#: Lines of one task that share a band value (or the low bits of it) from which on its list is dealt to all tasks.
HOT = 64
#: Lines up to which a list's candidates are counted pair by pair, to leave out lines that have none; and, without these,
#: lines up to which candidates of different components are confirmed one by one. Longer lists are joined by rarest shingles.
PAIRWISE = 256
PAIRS = 64
#: Times that lines of long lists are paired with the closest of their neighbours, dealt anew each time, before that join.
TURNS = 1
#: Bytes of text and characters of hashes handled at once, and lines whose postings are sent at once, about.
CHUNK = 1 << 19
BLOCK = 1 << 14
FLUSH = 100_000
#: Parts of postings, handled one at a time, for each partition of a shuffle.
PARTS = 4
#: Bytes of wanted lines' places that are sent to all executors at most; more are joined by a shuffle.
BROADCAST_BYTES = 48 << 20

_ODD = np.random.default_rng(31).integers(0, 1 << 63, 8192, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BLANK = bytes(range(33))
_LISTS = "entry long, node long, centre long, near boolean, open boolean, many boolean, hot boolean, bits_a long, bits_b long"
_BLOCKS = "part int, block binary"
_LINES = "doc_id long, key long, line long, name_a long, name_b long"
#: A posting: 47 bits of the entry and one that says that its list is hot, the node, and twice 24 bit groups.
_POSTING = 26
_ENTRY = np.uint64((1 << 47) - 1)
_FIRST_BITS = np.uint64(sum(1 << (BITS * k) for k in range(_GROUPS // 2)))


def _names(lines: list[bytes]) -> np.ndarray:
    """Two numbers that name each line."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, lines)), np.int64).reshape(-1, 2)


def _shown(lines: list[bytes]) -> list[int]:
    """The places of those lines that aren't blank."""
    return [k for k, x in enumerate(lines) if x.strip(_BLANK)]


def _rolled(points: np.ndarray, width: int) -> np.ndarray:
    """A hash of ``width`` numbers from each place on that has as many, put together from those of parts of them."""
    value, n = points.astype(np.uint64), 1
    for bit in bin(width)[3:]:
        value = value[:-n] * _ODD[n] + value[n:]
        n *= 2
        if bit == "1":
            value = value[:-1] * _ODD[0]
            value += points[n : n + len(value)]
            n += 1
    return mixed(value)


def _shingle_hashes(lines: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each line's shingles, with repetitions, line after line; and how many each line has."""
    points = np.frombuffer((b"\n".join(lines) + b"\n" * width).decode().encode("utf-32-le"), np.uint32)
    n = len(points) - width + 1
    ends = np.flatnonzero(points[:n] == 10)
    starts = np.append(0, ends[:-1] + 1)
    sizes = ends - starts
    every = np.empty(n, np.uint64)
    for at in range(0, n, BLOCK):  # small enough to stay near the processor
        every[at : at + BLOCK] = _rolled(points[at : at + BLOCK + width - 1], width)
    own = np.ones(n, bool)
    for j in range(min(width, n)):
        own[ends[ends >= j] - j] = False
    short = np.flatnonzero(sizes < width)
    own[starts[short]] = True
    for k in short.tolist():
        line = points[starts[k] : starts[k] + sizes[k]].astype(np.uint64)
        every[starts[k]] = mixed((line * _ODD[1 : len(line) + 1]).sum(dtype=np.uint64, keepdims=True) + np.uint64(sizes[k]))[0]
    return every[own], np.maximum(sizes - width + 1, 1)


def _sketches(lines: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Each line's band values, and its bit groups in two numbers."""
    factors = np.random.default_rng(37).integers(0, 1 << 31, (2, _GROUPS), dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    hashes, n = _shingle_hashes(lines, width)
    low, first = (hashes >> np.uint64(32)).astype(np.uint32), np.cumsum(n) - n
    bands, bits, spare = np.empty((len(n), BANDS), np.uint64), np.zeros((len(n), 2), np.uint64), np.empty_like(low)
    for b in range(BANDS):
        value = np.full(len(n), b + 1, np.uint64)
        for r in range(b * ROWS, (b + 1) * ROWS):
            np.bitwise_xor(low, factors[1, r], out=spare)
            np.multiply(spare, factors[0, r], out=spare)
            least = np.minimum.reduceat(spare, first)
            value = mixed(value * _ODD[9] + least)
            half, place = divmod(r, _GROUPS // 2)
            bits[:, half] |= (mixed(least.astype(np.uint64)) & np.uint64((1 << BITS) - 1)) << np.uint64(BITS * place)
        bands[:, b] = value
    return bands, bits


def _equal_groups(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many bit groups in the last dimension of ``a`` and ``b`` are equal."""
    x = a ^ b
    for shift in range(1, BITS):
        x = x | ((a ^ b) >> np.uint64(shift))
    return _GROUPS - np.bitwise_count(x & _FIRST_BITS).sum(axis=-1, dtype=np.int64)


def _packed(entry: np.ndarray, hot: np.ndarray, node: np.ndarray, bits: np.ndarray) -> np.ndarray:
    rows = np.empty((len(entry), _POSTING), np.uint8)
    small = lambda x: np.ascontiguousarray(x).view(np.uint8).reshape(len(x), -1, 8)[:, :, :6]
    rows[:, :6] = small((entry & _ENTRY) | (hot.astype(np.uint64) << np.uint64(47)))[:, 0]
    rows[:, 6:14] = node.view(np.uint8).reshape(-1, 8)
    rows[:, 14:] = small(bits).reshape(-1, 12)
    return rows


def _unpacked(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    wide = np.zeros((len(rows), 3, 8), np.uint8)
    wide[:, 0, :6] = rows[:, :6]
    wide[:, 1:, :6] = rows[:, 14:].reshape(-1, 2, 6)
    wide = wide.view(np.uint64)[:, :, 0]
    entry = wide[:, 0] & _ENTRY
    return entry, wide[:, 0] > _ENTRY, np.ascontiguousarray(rows[:, 6:14]).view(np.int64)[:, 0], wide[:, 1:]


def _posted(nodes: np.ndarray, bands: np.ndarray, bits: np.ndarray, parts: int) -> pa.RecordBatch:
    """The postings of some lines, one block for each part that has any."""
    entry, of = bands.ravel() & _ENTRY, np.repeat(np.arange(len(nodes)), BANDS)
    crowd = entry & np.uint64((1 << 20) - 1)
    hot = np.bincount(crowd.astype(np.int64), minlength=1 << 20)[crowd.astype(np.int64)] >= HOT
    part = entry % np.uint64(parts)
    if hot.any():
        some = np.flatnonzero(hot)
        home = some[np.unique(entry[some], return_index=True)[1]]  # one line of each such list goes where others have it
        part[some] = mixed(entry[some] * _ODD[11] + nodes[of[some]].view(np.uint64)) % np.uint64(parts)
        entry, of, hot = (np.append(x, x[home]) for x in (entry, of, hot))
        part = np.append(part, entry[len(part) :] % np.uint64(parts))
    return _blocks(part, _packed(entry, hot, nodes[of], bits[of]))


def _blocks(part: np.ndarray, rows: np.ndarray) -> pa.RecordBatch:
    """Rows of bytes, one block for each part that has any."""
    part = part.astype(np.int32)
    order = np.argsort(part, kind="stable")
    part, rows = part[order], rows[order]
    first = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else np.zeros(0, np.int64)
    ends = (np.append(first, len(rows)) * rows.shape[1]).astype(np.int64)
    blocks = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(ends), pa.py_buffer(rows)])
    return pa.RecordBatch.from_arrays([pa.array(part[first]), blocks.cast(pa.binary())], names=["part", "block"])


def _cut(column: pa.Array) -> Iterator[tuple[int, list[list[bytes]]]]:
    """Some texts at a time: the number of the first, and the lines of each."""
    data, offsets = utf8(column)
    for a, b in chunks(offsets, CHUNK):
        raw = data[offsets[a] : offsets[b]].tobytes()
        begin = (offsets[a : b + 1] - offsets[a]).tolist()
        yield a, [raw[x:y].split(b"\n") for x, y in zip(begin[:-1], begin[1:])]


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Place and name of every line that isn't blank."""
    for batch in batches:
        for a, texts in _cut(batch.column(2)):
            shown = [_shown(x) for x in texts]
            names = _names([own[k] for own, some in zip(texts, shown) for k in some])
            of = pa.array(np.repeat(np.arange(a, a + len(texts)), [len(x) for x in shown]))
            place = pa.array([k for some in shown for k in some], pa.int64())
            columns = [batch.column(0).take(of), batch.column(1).take(of), place, *(pa.array(names[:, k]) for k in (0, 1))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "key", "line", "name_a", "name_b"])


def _postings(width: int, parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # lines that this task has posted
        held: list[tuple[np.ndarray, ...]] = []
        size = 0
        for batch in batches:
            for _, texts in _cut(batch.column(0)):
                lines = [own[k] for own in texts for k in _shown(own)]
                fresh: dict[int, bytes] = {}
                for name, line in zip(_names(lines)[:, 0].tolist(), lines):
                    if name not in seen:
                        fresh[name] = line
                if fresh:
                    seen.update(fresh)
                    held.append((np.array(list(fresh), np.int64), *_sketches(list(fresh.values()), width)))
                    size += len(fresh)
                if size >= FLUSH:
                    yield _posted(*map(np.concatenate, zip(*held)), parts)
                    held, size = [], 0
        if held:
            yield _posted(*map(np.concatenate, zip(*held)), parts)

    return run


def _closest(bits: np.ndarray) -> int:
    """The line whose bits are those of most lines most often."""
    shifts = np.arange(BITS * _GROUPS // 2, dtype=np.uint64)
    votes = sum(((bits[a : a + 4096, :, None] >> shifts) & np.uint64(1)).sum(axis=0) for a in range(0, len(bits), 4096))
    most = ((votes * 2 > len(bits)).astype(np.uint64) << shifts).sum(axis=1, dtype=np.uint64)
    return int(np.bitwise_count(bits ^ most).sum(axis=1).argmin())


def _lists(blocks: list[bytes]) -> pa.RecordBatch:
    """The lists of one part's postings that have candidates or are hot: a row for each line.

    A line's partner is the centre, if it is ``near`` it; a list is open if it has candidates besides.
    """
    entry, hot, node, bits = _unpacked(np.frombuffer(b"".join(blocks), np.uint8).reshape(-1, _POSTING))
    order = np.argsort(entry)
    same = entry[order[1:]] == entry[order[:-1]]
    many = np.append(False, same) | np.append(same, False) | hot[order]  # lists of one line drop out here
    order = order[many]
    entry, hot, node, bits = entry[order], hot[order], node[order], bits[order]
    order = np.lexsort((~hot, node, entry))
    order = order[np.append(True, (entry[order[1:]] != entry[order[:-1]]) | (node[order[1:]] != node[order[:-1]]))] if len(order) else order
    entry, hot, node, bits = entry[order], hot[order], node[order], bits[order]
    begin = np.flatnonzero(np.append(True, entry[1:] != entry[:-1])) if len(entry) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(begin, len(entry)))
    hot = np.logical_or.reduceat(hot, begin) if len(begin) else hot
    keep, near, open_ = np.zeros(len(entry), bool), np.zeros(len(entry), bool), np.ones(len(entry), bool)
    centre = np.zeros(len(entry), np.int64)
    for m in np.unique(sizes[~hot & (sizes > 1) & (sizes <= PAIRWISE)]).tolist():
        own = begin[~hot & (sizes == m)]
        for a in range(0, len(own), step := max(1, (1 << 20) // (m * m))):
            rows = own[a : a + step, None] + np.arange(m)
            agree = _equal_groups(bits[rows][:, :, None], bits[rows][:, None]) >= AGREE
            agree[:, np.arange(m), np.arange(m)] = False
            lists, best = np.arange(len(rows)), agree.sum(axis=2).argmax(axis=1)
            keep[rows] = agree.any(axis=2)
            centre[rows] = node[rows[lists, best]][:, None]
            near[rows] = agree[lists, best]
            agree[lists, best] = agree[lists, :, best] = False  # what is left hasn't the centre
            open_[rows] = agree.any(axis=(1, 2))[:, None]
    for k in np.flatnonzero(hot | (sizes > PAIRWISE)).tolist():
        rows = slice(begin[k], begin[k] + sizes[k])
        best = begin[k] + _closest(bits[rows])
        keep[rows], centre[rows], near[rows] = True, node[best], _equal_groups(bits[rows], bits[best]) >= AGREE
    near &= node != centre
    bits[~open_] = 0  # nobody asks for them
    many = np.repeat(hot | (np.add.reduceat(keep, begin, dtype=np.int64) > PAIRS), sizes) if len(begin) else keep
    columns = (entry.view(np.int64), node, centre, near, open_, many, np.repeat(hot, sizes), *bits.T.view(np.int64))
    return pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in columns], names=_LISTS.replace(",", "").split()[::2])


#: Rows of bytes that a task gathers before it deals them out, so that blocks are few.
GATHERED = 1 << 20


def _gathered(batches: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """Blocks of many rows of bytes (and the parts that these go to) at once."""
    held, size = [], 0
    for part, rows in batches:
        held.append((part, rows))
        size += len(rows)
        if size >= GATHERED:
            yield _blocks(*map(np.concatenate, zip(*held)))
            held, size = [], 0
    if size:
        yield _blocks(*map(np.concatenate, zip(*held)))


def _by_part(handle):
    """What ``handle`` makes of the blocks of each part, which come one after another."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, blocks = None, []
        for batch in batches:
            for own, block in zip(batch.column(0).to_pylist(), batch.column(1)):
                if own != part and blocks:
                    yield handle(blocks)
                    blocks = []
                part = own
                blocks.append(block.as_py())
        if blocks:
            yield handle(blocks)

    return run


def _in_parts(blocks: DataFrame, partitions: int) -> DataFrame:
    return blocks.repartitionById(partitions, F.col("part") % partitions).sortWithinPartitions("part")


_OCCURRENCE = np.dtype([("shingle", "<u8"), ("node", "<i8"), ("n", "<u4")])
_COUNTED = np.dtype([("node", "<i8"), ("n", "<u4"), ("often", "<u4"), ("shingle", "<u8")])


def _as_bytes(rows: np.ndarray) -> np.ndarray:
    return rows.view(np.uint8).reshape(len(rows), rows.dtype.itemsize)


def _occurrences(width: int, parts: int):
    """Each distinct shingle of each line, dealt out by shingle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for batch in batches:
            for a in range(0, batch.num_rows, 4000):
                some = batch.slice(a, 4000)
                hashes, counts = _shingle_hashes([x.encode() for x in some.column(1).to_pylist()], width)
                own = [np.sort(x) for x in np.split(hashes, np.cumsum(counts)[:-1])]
                own = [x[np.append(True, x[1:] != x[:-1])] for x in own]
                sizes = np.array([len(x) for x in own])
                rows = np.empty(sizes.sum(), _OCCURRENCE)
                rows["shingle"], rows["node"], rows["n"] = np.concatenate(own), np.repeat(some.column(0).to_numpy(), sizes), np.repeat(sizes, sizes)
                yield rows["shingle"] % np.uint64(parts), _as_bytes(rows)

    return lambda batches: _gathered(run(batches))


def _counted(parts: int):
    """How often each shingle occurs, for those that occur twice or more, dealt out by line."""

    def handle(blocks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        rows = np.frombuffer(b"".join(blocks), _OCCURRENCE)
        rows = rows[np.argsort(rows["shingle"])]
        new = np.append(True, rows["shingle"][1:] != rows["shingle"][:-1])
        begin = np.flatnonzero(new)
        often = np.diff(np.append(begin, len(rows)))
        many = np.repeat(often > 1, often)
        out = np.empty(int(many.sum()), _COUNTED)
        out["often"] = np.repeat(often, often)[many]
        for k in ("node", "n", "shingle"):
            out[k] = rows[k][many]
        return mixed(np.ascontiguousarray(out["node"]).view(np.uint64)) % np.uint64(parts), _as_bytes(out)

    return lambda batches: _gathered(_by_part(handle)(batches))


def _rarest_first(percent: int):
    """Each line's rarest shingles, as ``near_dups._rarest`` has them."""

    def handle(blocks: list[bytes]) -> pa.RecordBatch:
        rows = np.frombuffer(b"".join(blocks), _COUNTED)
        rows = rows[np.lexsort((rows["shingle"], rows["often"], rows["node"]))]
        begin = np.flatnonzero(np.append(True, rows["node"][1:] != rows["node"][:-1])) if len(rows) else np.zeros(0, np.int64)
        shared = np.diff(np.append(begin, len(rows)))
        n = rows["n"].astype(np.int64)
        at = n - np.repeat(shared, shared) + np.arange(len(rows)) - np.repeat(begin, shared) + 1
        first = at <= n + (-n * percent // 100) + 1
        columns = (rows["node"], n, np.ascontiguousarray(rows["shingle"]).view(np.int64), at)
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(x[first])) for x in columns], names=["node", "n", "shingle", "at"])

    return handle


def _candidates(rows: pa.Table, best: bool) -> pa.RecordBatch:
    """Of whole lists, in order, the candidates of different components, with their roots and how many groups agree.

    ``best``: only each line's closest one among ``PAIRWISE`` neighbours in its list.
    """
    entry, node, root = (rows[k].to_numpy() for k in ("entry", "node", "root"))
    bits = np.stack([rows[k].to_numpy().view(np.uint64) for k in ("bits_a", "bits_b")], axis=1)
    begin = np.flatnonzero(np.append(True, entry[1:] != entry[:-1]))
    if best:
        place = np.arange(len(entry)) - np.repeat(begin, np.diff(np.append(begin, len(entry))))
        begin = np.flatnonzero(place % PAIRWISE == 0)
    sizes = np.diff(np.append(begin, len(entry)))
    found = [np.zeros((5, 0), np.int64)]
    for m in np.unique(sizes[sizes > 1]).tolist():
        own = begin[sizes == m]
        for a in range(0, len(own), step := max(1, (1 << 20) // (m * m))):
            at = own[a : a + step, None] + np.arange(m)
            equal = _equal_groups(bits[at][:, :, None], bits[at][:, None])
            equal[root[at][:, :, None] == root[at][:, None]] = 0
            if best:
                k, x = np.nonzero(equal.max(axis=2) >= AGREE)
                y = equal[k, x].argmax(axis=1)
            else:
                k, x, y = np.nonzero(np.triu(equal) >= AGREE)
            i, j, its, other = node[at[k, x]], node[at[k, y]], root[at[k, x]], root[at[k, y]]
            found.append(np.stack([np.maximum(i, j), np.minimum(i, j), np.minimum(its, other), np.maximum(its, other), equal[k, x, y]]))
    pairs = np.concatenate(found, axis=1)
    pairs = pairs[:, np.lexsort(pairs[:2])]
    pairs = pairs[:, np.append(True, (pairs[:2, 1:] != pairs[:2, :-1]).any(axis=0))] if pairs.shape[1] else pairs
    return pa.RecordBatch.from_arrays([pa.array(x) for x in pairs], names=["a", "b", "low", "high", "met"])


def _across(best: bool):
    """Candidates of lists that come one after another, each as a whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            entry = batch.column(0).to_numpy()
            cut = int(np.searchsorted(entry, entry[-1])) if len(entry) else 0  # the last list may go on
            if cut:
                yield _candidates(pa.Table.from_batches([*held, batch.slice(0, cut)]).combine_chunks(), best)
                held = []
            held.append(batch.slice(cut))
            if best and sum(x.num_rows for x in held) >= 64 * PAIRWISE:  # a long list need not be held as a whole
                yield _candidates(pa.Table.from_batches(held).combine_chunks(), best)
                held = []
        if sum(x.num_rows for x in held):
            yield _candidates(pa.Table.from_batches(held).combine_chunks(), best)

    return run


def _wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """node, name_b and characters of the lines of each text that are wanted."""
    for batch in batches:
        lists = batch.column(1)
        for a, texts in _cut(batch.column(0)):
            found, nodes = [], []
            for own, wanted in zip(texts, lists.slice(a, len(texts)).to_pylist()):
                found += [own[x["line"]] for x in wanted]
                nodes += [(x["node"], x["name_b"]) for x in wanted]
            if found:
                right = pa.array((_names(found) == np.array(nodes, np.int64)).all(axis=1))
                columns = [*(pa.array(x, pa.int64()) for x in zip(*nodes)), pa.array([x.decode() for x in found], pa.string())]
                yield pa.RecordBatch.from_arrays([x.filter(right) for x in columns], names=["node", "name_b", "characters"])


def _set(line: str, width: int) -> set[str]:
    return {line[k : k + width] for k in range(max(1, len(line) - width + 1))}


def _likely(xs: list[str], ys: list[str], width: int, percent: int) -> np.ndarray:
    """Which pairs of lines have enough shingle hashes of 48 bits in common, give or take one."""
    lines = {x: k for k, x in enumerate(dict.fromkeys([*xs, *ys]))}
    hashes, counts = _shingle_hashes([x.encode() for x in lines], width)
    hashes >>= np.uint64(16)
    of = np.repeat(np.arange(len(lines), dtype=np.uint64), counts)
    own = np.sort(of << np.uint64(48) | hashes)
    own = own[np.append(True, own[1:] != own[:-1])]
    line = (own >> np.uint64(48)).astype(np.int64)
    sizes = np.bincount(line, minlength=len(lines))
    begin = np.cumsum(sizes) - sizes
    a, b = (np.array([lines[x] for x in side]) for side in (xs, ys))
    all_sizes = np.concatenate([sizes[a], sizes[b]])
    pair = np.repeat(np.tile(np.arange(len(xs)), 2), all_sizes)
    at = np.arange(all_sizes.sum()) + np.repeat(np.concatenate([begin[a], begin[b]]) - (np.cumsum(all_sizes) - all_sizes), all_sizes)
    keys = np.sort(pair.astype(np.uint64) << np.uint64(48) | own[at] & np.uint64((1 << 48) - 1))
    both = np.bincount((keys[1:][keys[1:] == keys[:-1]] >> np.uint64(48)).astype(np.int64), minlength=len(xs))
    return 100 * (both + 1) >= percent * (sizes[a] + sizes[b] - both - 1)


def _verified(width: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 1000):
                batch = whole.slice(start, 1000)
                xs, ys = batch.column(2).to_pylist(), batch.column(3).to_pylist()
                good = _likely(xs, ys, width, percent)
                for k in np.flatnonzero(good):
                    x, y = _set(xs[k], width), _set(ys[k], width)
                    both = len(x & y)
                    good[k] = 100 * both >= percent * (len(x) + len(y) - both)
                yield pa.RecordBatch.from_arrays([c.filter(pa.array(good, pa.bool_())) for c in batch.columns[:2]], names=["a", "b"])

    return run


def fuzzy_lines(docs: DataFrame, width: int = 7, percent: int = 80) -> DataFrame:
    """Every line of ``docs`` that isn't blank: doc_id, line (from 0), first_doc_id and first_line (the first of its
    component) and kept."""
    spark = docs.sparkSession
    keyed = docs.where(F.col("text").isNotNull()).select("doc_id", row_key().alias("key"), "text")
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = PARTS * partitions
    with passing(spark) as keep:
        rows = stash(keyed.mapInArrow(tidy(_listed), _LINES), "fl-lines")
        order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "line", "key")
        many = rows.groupBy(F.col("name_a").alias("node"), "name_b").agg(F.min(order).alias("low"), F.count(F.lit(1)).alias("rows"))
        classes = stash(many, "fl-classes")
        posted = keyed.select("text").mapInArrow(tidy(_postings(width, parts)), _BLOCKS)
        lists = stash(_in_parts(posted, partitions).mapInArrow(tidy(_by_part(_lists)), _LISTS), "fl-lists")

        nodes = lists.select("node").distinct()
        place = F.struct("low.line", "node", "name_b")
        wanted = classes.join(nodes, "node").groupBy(F.col("low.key").alias("w_key")).agg(F.collect_set(place).alias("wanted"))
        wanted = stash(wanted, "fl-wanted")
        if (wanted.agg(F.sum(F.size("wanted") * 24 + 64)).first()[0] or 0) <= BROADCAST_BYTES:
            wanted = F.broadcast(wanted)
        texts = keyed.join(wanted, F.col("key") == F.col("w_key"))
        texts = texts.select("text", "wanted").mapInArrow(tidy(_wanted), "node long, name_b long, characters string")
        texts = stash(texts.dropDuplicates(["node"]), "fl-texts")

        def confirm(pairs: DataFrame) -> DataFrame:
            side = lambda k: texts.select(F.col("node").alias(k), F.col("characters").alias(f"line_{k}"))
            both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "line_a", "line_b")
            return both.mapInArrow(tidy(_verified(width, percent)), "a long, b long")

        first = lists.where("hot").groupBy("entry").agg(F.min("centre").alias("b"))
        centres = lists.where("hot").select("entry", F.col("centre").alias("a")).distinct().join(first, "entry").where("a != b")
        stars = lists.where("near").select(F.greatest("node", "centre").alias("a"), F.least("node", "centre").alias("b"))
        links = stash(confirm(stars.unionByName(centres.select("a", "b")).distinct()), "fl-stars")

        def rarest(apart: DataFrame) -> DataFrame:
            lines = texts.join(apart.select("node"), "node").select("node", "characters")
            occurring = _in_parts(lines.mapInArrow(tidy(_occurrences(width, partitions)), _BLOCKS), partitions)
            counted = occurring.mapInArrow(tidy(_counted(partitions)), _BLOCKS)
            first = _in_parts(counted, partitions).mapInArrow(tidy(_by_part(_rarest_first(percent))), "node long, n long, shingle long, at long")
            return first.join(apart, "node")

        def dealt(ready: DataFrame, best: bool, turn: int = 0) -> DataFrame:
            salt = F.when(F.col("hot"), F.pmod(F.xxhash64("node", F.lit(turn)), F.lit(partitions))).otherwise(0)
            rows = ready.select("entry", "node", "root", "bits_a", "bits_b", salt.alias("salt"), F.xxhash64("node", F.lit(turn)).alias("turn"))
            rows = rows.repartition("entry", "salt").sortWithinPartitions("entry", "salt", "turn").select("entry", "node", "root", "bits_a", "bits_b")
            return rows.mapInArrow(tidy(_across(best)), "a long, b long, low long, high long, met long")

        def partners(turn: int):
            return lambda ready: dealt(ready.where("many"), True, turn).select("a", "b").distinct()

        entries = lists.where("open").select("entry", "node", "many", "hot", "bits_a", "bits_b").dropDuplicates(["entry", "node"])
        candidates = lambda ready: dealt(ready.where("not many"), False)
        roots = linked(entries, None, links, confirm, percent, [partners(k) for k in range(TURNS)], candidates, rarest)
        # A root goes to the line that was compared: another one with half of its name the same has none.
        roots = stash(roots.join(texts.select("node", "name_b"), "node"), "fl-roots")
        keep(rows, classes, roots)

    # Lines that are the only ones of their class and component are their own first ones.
    named = classes.join(roots, ["node", "name_b"], "left").where("rows > 1 OR root IS NOT NULL").withColumn("root", F.coalesce("root", "node"))
    least = named.groupBy("root").agg(F.min("low").alias("first"))
    of = named.join(least, "root").select(F.col("node").alias("a"), F.col("name_b").alias("b"), F.col("first.doc_id").alias("f_id"), F.col("first.line").alias("f_line"))
    whole = rows.join(of, (F.col("name_a") == F.col("a")) & (F.col("name_b") == F.col("b")), "left")
    first_id = F.when(F.col("a").isNull(), F.col("doc_id")).otherwise(F.col("f_id"))
    first_line = F.coalesce("f_line", "line")
    kept = F.col("doc_id").eqNullSafe(first_id) & (F.col("line") == first_line)
    return whole.select("doc_id", "line", first_id.alias("first_doc_id"), first_line.alias("first_line"), kept.alias("kept"))


def without_fuzzy_lines(docs: DataFrame, **options) -> DataFrame:
    """doc_id and text of every row of ``docs``, without the lines that aren't kept."""
    gone = fuzzy_lines(docs, **options).where("not kept").groupBy(F.col("doc_id").alias("g_id")).agg(F.array_sort(F.collect_set("line")).alias("gone"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, lines in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                drop = set(lines or ())
                out.append(text if text is None else "\n".join(x for k, x in enumerate(text.split("\n")) if k not in drop))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=["doc_id", "text"])

    whole = docs.select("doc_id", "text").join(gone, docs["doc_id"].eqNullSafe(F.col("g_id")), "left").select("doc_id", "text", "gone")
    return whole.mapInArrow(run, "doc_id long, text string")
