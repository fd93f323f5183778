"""Token ids in Parquet: delta-encoded keys, dictionary-encoded id lists, small row groups and pages with indexes.

Files are in ascending document order, so a reader of a few documents or of the counts alone touches only the pages
it needs (Parquet keeps a column and an offset index per page). A document's global start is its start within its
part plus the ids of all earlier parts, so nothing is numbered in one task.

Defined cases: null or empty text gives the end id alone; null ids come first; rows with one id are ordered by text;
an empty table gives an empty file set; only doc_id and text are read. A special token's string in a text gives that
token's id, as the library has it by default; an ``Encoder`` can take it as ordinary text instead.
"""

from __future__ import annotations

import os
import threading
import zlib
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallgrass.llm.shingles import chunks, utf8
from tallgrass.plans.workers import give_back

#: Pieces whose ids a worker remembers before it starts anew, and bytes of text that it encodes at once.
REMEMBERED = 600_000
CHUNK = 2 << 20
#: Characters of texts that split rows with one id between partitions; whole texts order them.
PREFIX = 64

SCHEMA = "doc_id long, part int, part_start long, n_tokens long, ids array<int>"
_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("part", pa.int32()), ("part_start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32()))]
)
_WRITER = {
    "compression": "zstd",
    "parquet.writer.version": "v2",
    "parquet.block.size": str(16 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.enable.dictionary": "true",
    "parquet.enable.dictionary#doc_id": "false",
    "parquet.enable.dictionary#part_start": "false",
    "parquet.enable.dictionary#n_tokens": "false",
}
_CLASS = np.zeros(256, np.uint8)  # 1: ASCII letters, 2: ASCII punctuation, 4: a space or newline, 8: other ASCII white space
_CLASS[[*range(65, 91), *range(97, 123)]] = 1
_CLASS[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = 2
_CLASS[[10, 32]] = 4
_CLASS[[0, 9, 11, 12, 13]] = 8
#: UTF-8 of white space beyond ASCII.
_WIDE_SPACE = [x.encode() for x in "\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"]


class Encoder:
    """Byte-level BPE that asks the tokenizer once for each piece of text and remembers its ids.

    Where white space stands alone, each space begins a pre-token that it shares with what follows and each newline is
    one, and punctuation after an ASCII letter begins another, so a text can be cut there and each piece encoded by
    itself. Pieces of many texts are cut and told apart by 64-bit hashes at once, and their bytes are compared with
    those of the piece that stands for them, so that Python handles the distinct ones only. Texts with other white space are encoded as they are, and unless ``literal``
    takes the strings of special tokens as ordinary text, so are texts with the string of an added token.
    """

    def __init__(self, path: str, end_id: int, literal: bool = True):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the threads
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = literal
        self.added = [] if literal else [x.content.encode() for x in self.tokenizer.get_added_tokens_decoder().values()]
        self.end_id = end_id
        vocabulary = self.tokenizer.get_vocab()
        self.lengths = np.zeros(max(vocabulary.values()) + 1, np.int64)  # bytes: a token's string has a character for each
        self.lengths[list(vocabulary.values())] = [len(x) for x in vocabulary]
        self.forget()

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}  # a piece's entry
        self.flat = np.empty(1 << 16, np.int32)
        self.ends = np.zeros(1 << 12, np.int64)  # of entry k: the end of its ids at k + 1
        self.n = 0
        self.add(np.array([self.end_id], np.int32), np.ones(1, np.int64))  # entry 0 ends a document

    def add(self, ids: np.ndarray, sizes: np.ndarray) -> int:
        """Store entries of such sizes; the number of the first."""
        first, used = self.n, int(self.ends[self.n])
        if first + len(sizes) + 1 > len(self.ends):
            self.ends = np.resize(self.ends, 2 * (first + len(sizes) + 1))
        if used + len(ids) > len(self.flat):
            self.flat = np.resize(self.flat, 2 * (used + len(ids)))
        self.ends[first + 1 : first + len(sizes) + 1] = used + np.cumsum(sizes)
        self.flat[used : used + len(ids)] = ids
        self.n += len(sizes)
        return first

    def encoded(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        got = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        sizes = np.fromiter(map(len, got), np.int64, len(got))
        return np.fromiter(chain.from_iterable(got), np.int32, int(sizes.sum())), sizes

    def words(self, spaced: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The same for pieces of a space and letters: one text of them all, cut by the byte lengths of its ids."""
        line = b"".join(spaced)
        ids = np.array(self.tokenizer.encode_batch_fast([line.decode()], add_special_tokens=False)[0].ids, np.int32)
        ends = np.append(np.flatnonzero(np.frombuffer(line, np.uint8) == 32)[1:], len(line))
        cuts = np.searchsorted(np.cumsum(self.lengths[ids]), ends, "left") + 1
        return ids, np.diff(cuts, prepend=0)

    def entries(self, pieces: list[bytes]) -> tuple[np.ndarray, int]:
        """The entries of distinct pieces, and how many entries are to be kept once these have been read.

        A full memory keeps what it has, for frequent pieces come early; it is emptied if it no longer knows half.
        """
        found = np.fromiter(map(self.known.get, pieces, repeat(-1)), np.int64, len(pieces))
        unknown = np.flatnonzero(found < 0).tolist()
        full = len(self.known) + len(unknown) > REMEMBERED
        if full and 2 * len(unknown) > len(pieces):
            self.forget()
            unknown, full = list(range(len(pieces))), False
        kept = self.n
        spaced, others = [], []
        for k in unknown:
            piece = pieces[k]
            (spaced if piece[:1] == b" " and len(piece) > 1 and piece[1:].decode().isalpha() else others).append(k)
        for at in range(0, len(spaced), 20_000):
            some = spaced[at : at + 20_000]
            first = self.add(*self.words([pieces[k] for k in some]))
            found[some] = np.arange(first, self.n)
        if others:
            first = self.add(*self.encoded([pieces[k].decode() for k in others]))
            found[others] = np.arange(first, self.n)
        if full:
            return found, kept
        self.known.update((pieces[k], e) for k, e in zip(unknown, found[unknown].tolist()))
        return found, self.n

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts (UTF-8, and where each begins and ends) one after another, each with the end id, and
        how many each has."""
        kind, n = _CLASS[data], len(offsets) - 1
        odd = _odd_texts(data, offsets, kind, self.added)
        first = np.zeros(len(data) + 1, bool)
        first[offsets] = True
        cut = first[:-1].copy()
        cut |= kind == 4
        cut[1:] |= (data[:-1] == 10) | (kind[1:] == 2) & (kind[:-1] == 1)
        if odd.any():  # one piece each, whatever is in it
            inside = np.repeat(odd, np.diff(offsets))
            cut &= ~inside | first[:-1]
        starts = np.flatnonzero(cut)
        entries = np.zeros(len(starts), np.int64)
        plain = np.ones(len(starts), bool)
        of = np.searchsorted(starts, offsets)
        plain[of[:-1][odd]] = False
        ends = np.append(starts[1:], len(data))
        kept = self.n
        if plain.any():
            codes, at = pd.factorize(_piece_hashes(data, starts)[plain])[0], np.flatnonzero(plain)
            some = np.empty(codes.max() + 1, np.int64)
            some[codes[::-1]] = at[::-1]
            raw = data.tobytes()
            piece = lambda k: raw[starts[k] : ends[k]]
            # Pieces with the hash of another one and other bytes stand for themselves.
            alone = _unlike(data, starts[at], starts[some][codes], (ends - starts)[at], (ends - starts)[some][codes])
            extra = {x: len(some) + k for k, x in enumerate(dict.fromkeys(piece(k) for k in at[alone].tolist()))}
            codes[alone] = [extra[piece(k)] for k in at[alone].tolist()]
            own, kept = self.entries([raw[a:b] for a, b in zip(starts[some].tolist(), ends[some].tolist())] + list(extra))
            entries[at] = own[codes]
        for k in np.flatnonzero(odd):
            entries[of[k]] = self.add(*self.encoded([data[offsets[k] : offsets[k + 1]].tobytes().decode()]))
        entries = np.insert(entries, of[1:], 0)
        begins = self.ends[entries]
        sizes = self.ends[entries + 1] - begins
        total = np.cumsum(sizes)
        ids = self.flat[np.arange(total[-1]) + np.repeat(begins - (total - sizes), sizes)]
        self.n = kept
        return ids, np.diff(total[of[1:] + np.arange(n)], prepend=0)


def _unlike(data: np.ndarray, begin: np.ndarray, other: np.ndarray, size: np.ndarray, its_size: np.ndarray) -> np.ndarray:
    """The numbers of the pieces whose bytes differ from those of the piece that stands for them."""
    unlike = size != its_size
    same = np.flatnonzero(~unlike & (begin != other))
    ends = np.cumsum(size[same])
    total = int(ends[-1]) if len(ends) else 0
    at = np.repeat(begin[same] - (ends - size[same]), size[same]) + np.arange(total)
    differ = np.flatnonzero(data[at] != data[at + np.repeat(other[same] - begin[same], size[same])])
    unlike[same[np.unique(np.searchsorted(ends, differ, "right"))]] = True
    return np.flatnonzero(unlike)


def _odd_texts(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray, strings: list[bytes]) -> np.ndarray:
    """Texts whose white space isn't all single spaces and newlines between other characters, or with one of ``strings``."""
    bad = kind == 8
    space = kind == 4
    bad[1:] |= space[1:] & space[:-1]
    full = offsets[:-1] < offsets[1:]
    bad[offsets[:-1][full]] |= space[offsets[:-1][full]]
    bad[offsets[1:][full] - 1] |= space[offsets[1:][full] - 1]
    raw, seen = data.tobytes(), np.bincount(data, minlength=256)
    for wide in [*_WIDE_SPACE, *strings]:
        at = raw.find(wide) if seen[wide[0]] else -1
        while at >= 0:
            bad[at] = True
            at = raw.find(wide, at + 1)
    return np.diff(np.searchsorted(np.flatnonzero(bad), offsets)) > 0


def _piece_hashes(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """By prefix sums: a piece's hash is the sum of its bytes' numbers times powers of a base, brought to one power."""
    global _POWERS, _INVERSES
    if len(data) >= len(_POWERS):
        _POWERS, _INVERSES = (_powers(x, len(data) + (1 << 16)) for x in (_BASE, _INVERSE))
    sums = _BYTE[data]
    sums *= _POWERS[: len(data)]
    np.cumsum(sums, out=sums)
    before = sums[starts - 1]
    before[0] = 0
    x = (sums[np.append(starts[1:] - 1, len(data) - 1)] - before) * _INVERSES[starts]
    return x ^ (x >> np.uint64(32))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_BYTE = np.random.default_rng(11).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS = _INVERSES = np.zeros(0, np.uint64)


def _parts(data: np.ndarray, size: int = CHUNK) -> list[int]:
    """Where to cut a long text before single spaces; its parts have the ids that they have in it."""
    cuts, at = [0], 0
    simple = (data < 128) & (_CLASS[data] < 4)
    good = np.flatnonzero((data[1:-1] == 32) & simple[:-2] & simple[2:]) + 1
    while len(data) - at > 2 * size:
        k = np.searchsorted(good, at + size)
        if k == len(good):
            break
        at = int(good[k])
        cuts.append(at)
    return [*cuts, len(data)]


#: Seconds after which a worker that no longer encodes frees its encoder.
IDLE = 6.0

_ENCODERS: dict[tuple[str, int], Encoder] = {}
_FREEING: list[threading.Timer] = []


def _free_when_idle() -> None:
    while _FREEING:
        _FREEING.pop().cancel()

    def free() -> None:
        _ENCODERS.clear()
        give_back()

    timer = threading.Timer(IDLE, free)
    timer.daemon = True
    timer.start()
    _FREEING.append(timer)


def encode_batches(batches: Iterator[pa.RecordBatch], path: str, end_id: int) -> Iterator[pa.RecordBatch]:
    """Batches of doc_id, text as batches of SCHEMA; a worker's encoder serves all its tasks."""
    encode = _ENCODERS.get((path, end_id)) or _ENCODERS.setdefault((path, end_id), Encoder(path, end_id, literal=False))
    part, at = TaskContext.get().partitionId(), 0
    while _FREEING:
        _FREEING.pop().cancel()

    def flush(docs: list, ids: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        nonlocal at
        ends = np.cumsum(counts)
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(ids))
        columns = [pa.array(docs, pa.int64()), pa.array(np.full(len(docs), part, np.int32)), pa.array(at + ends - counts), pa.array(counts), lists]
        at += int(ends[-1])
        return pa.RecordBatch.from_arrays(columns, schema=_ARROW)

    for batch in batches:
        docs = batch.column(0).to_pylist()
        data, offsets = utf8(batch.column(1))
        for a, b in chunks(offsets, CHUNK):
            own = data[offsets[a] : offsets[b]]
            if b == a + 1 and len(own) > 2 * CHUNK:
                cuts = _parts(own)
                got = [encode(own[x:y], np.array([0, y - x]))[0][:-1] for x, y in zip(cuts[:-1], cuts[1:])]
                ids = np.append(np.concatenate(got), np.int32(end_id))
                yield flush(docs[a:b], ids, np.array([len(ids)]))
            else:
                yield flush(docs[a:b], *encode(own, offsets[a : b + 1] - offsets[a]))
    _free_when_idle()


def _in_ranges(docs: DataFrame) -> DataFrame:
    """doc_id, text dealt to partitions by ranges of doc_id, in order.

    The beginning of the text splits ranges of rows with one id or without any.
    """
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return docs.select("doc_id", "text").repartitionByRange(n, "doc_id", F.substring("text", 1, PREFIX))


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 2) -> None:
    """Encode every whole text of ``docs`` and write the ids below ``path`` in ascending doc_id order."""
    ordered = _in_ranges(docs).sortWithinPartitions("doc_id", "text")
    # Named in the module, encode_batches is not pickled with a copy of the encoders it keeps.
    ordered.mapInArrow(lambda batches: encode_batches(batches, tokenizer_path, end_id), SCHEMA).write.options(**_WRITER).parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Every document of ``path`` as doc_id, start, n_tokens, ids; columns left out are not read."""
    stored = spark.read.schema(SCHEMA).parquet(path)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each part file
    parts = (
        stored.groupBy("part")
        .agg(F.sum("n_tokens").alias("n"))
        .select(F.col("part").alias("of"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    )
    start = (F.col("base") + F.col("part_start")).alias("start")
    # A row for each part file, however many documents these hold: small enough to send to all.
    return stored.join(F.broadcast(parts), F.col("part") == F.col("of")).select("doc_id", start, "n_tokens", "ids")


def with_crc(tokens: DataFrame) -> DataFrame:
    """``tokens`` with the CRC-32 of its ids as little-endian unsigned 32-bit integers in place of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            flat, offsets = lists.values.to_numpy(zero_copy_only=False).astype("<u4"), lists.offsets.to_numpy()
            crcs = [zlib.crc32(flat[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(crcs, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"]
            )

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    return tokens.select("doc_id", "start", "n_tokens", "ids").mapInArrow(run, schema)
