"""Exact removal of repeated substrings by distributed difference-cover suffix sorting.

A byte goes if it is covered by a string of ``length`` bytes that also starts earlier (in a document of smaller id,
or in the same document before). Sorting every suffix of the corpus would move each byte some twenty times over, so
windows of ``length`` bytes are first put together by anchors that depend on their bytes alone: equal windows have
equal anchor strings. Then

* runs of windows whose anchor string occurs once cannot repeat and drop out;
* runs are named by all their bytes; of runs with one name the first stands for all, and the others repeat it whole;
* where an anchor string has runs of several names, single windows may still be equal. The bytes of one run of each
  name are sorted as suffixes, anchor strings dealt to tasks: triples of the difference cover are sorted and named,
  names are ranked recursively (as deep as ``length`` bytes need), the remaining suffixes are merged, and adjacent
  prefixes of ``length`` bytes are compared byte by byte.

Whole copies of an earlier document are found first by their SHA-256; they repeat it entirely.

Defined cases: null text is empty; texts shorter than ``length`` keep all bytes; rows with one id and one text are
one document and all keep what the first keeps, rows with one id and different texts are ordered by a hash of the
text; a null id comes before all others; an empty table gives an empty result; only doc_id and text are read. Equal
names are equal 64-bit hashes of all bytes among runs whose anchor strings have equal 64-bit hashes, under numbers that
are drawn anew for every call, so that nobody can prepare texts that share a name.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallgrass.llm.shingles import chunks, utf8
from tallgrass.llm.suffixes import anchors, repeats
from tallgrass.plans.durable import passing, stash
from tallgrass.plans.workers import tidy

#: Bytes of runs that are sorted at once, about; the runs of one anchor string stay together.
SORT_BYTES = 1 << 20
#: Bytes of spans that are sent to all executors at most; more are joined by a shuffle.
BROADCAST_BYTES = 48 << 20

_RUNS = "doc_id long, sign long, place long, string long, whole long, again boolean"


def _again(doc: np.ndarray, sign: np.ndarray, place: np.ndarray, string: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Runs that come after an equal run of these, by document and place; rows of one place do not."""
    again = np.zeros(len(doc), bool)
    key = string * np.int64(-7046029254386353131) + whole
    _, of, count = np.unique(key, return_inverse=True, return_counts=True)
    some = np.flatnonzero(count[of] > 1)
    some = some[np.lexsort((place[some], sign[some], doc[some], whole[some], string[some]))]
    same = lambda *x: np.logical_and.reduce([y[some[1:]] == y[some[:-1]] for y in x])
    equal = np.append(False, same(string, whole))
    fresh = np.append(True, ~same(doc, sign, place))
    begin = np.flatnonzero(~equal)  # of each group of equal runs; a row is again if one before it in its group is of another place
    first = np.repeat(begin, np.diff(np.append(begin, len(some))))
    moved = np.cumsum(fresh)
    again[some] = moved > moved[first] if len(some) else False
    return again


def _runs(length: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(2))
            for a, b in chunks(offsets):
                text, first, last, anchor, string, whole = anchors(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], length, length * 2 // 5, seed)
                of = pa.array(text + a)
                place = first << 14 | (last - first)
                string, whole = string.view(np.int64), whole.view(np.int64)
                doc, sign = batch.column(0).take(of), batch.column(1).take(of)
                ids = doc.fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False)
                again = _again(ids, sign.to_numpy(zero_copy_only=False), place, string, whole)
                columns = [doc, sign, *(pa.array(x) for x in (place, string, whole, again))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "sign", "place", "string", "whole", "again"])

    return run


def _contexts(length: int):
    """Of each text the bytes of its open runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(2))
            for a in range(0, batch.num_rows, 200):
                some = batch.slice(a, 200)
                lists = some.column(3)
                of = np.repeat(np.arange(len(some)), np.diff(lists.offsets.to_numpy()))
                place, string = (lists.flatten().field(k).to_numpy() for k in (0, 1))
                begin = offsets[a + of] + (place >> 14)
                pieces = [data[x:y].tobytes() for x, y in zip(begin.tolist(), (begin + (place & 16383) + length).tolist())]
                ids = (some.column(k).take(pa.array(of)) for k in (0, 1))
                yield pa.RecordBatch.from_arrays([pa.array(string), *ids, pa.array(place), pa.array(pieces, pa.binary())], names=["string", "doc_id", "sign", "place", "bytes"])

    return run


def _once(batch: pa.RecordBatch, last: tuple | None) -> tuple[pa.RecordBatch, tuple | None]:
    """``batch``, in order, less rows that name the run of the row before them, as rows with one id and text do; its
    last run, and ``last`` is that of the batch before."""
    if not batch.num_rows:
        return batch, last
    doc = batch.column(1)
    columns = [batch.column(0).to_numpy(), doc.fill_null(0).to_numpy(), doc.is_null().to_numpy(zero_copy_only=False), batch.column(2).to_numpy(), batch.column(3).to_numpy()]
    new = np.append(tuple(x[0] for x in columns) != last, np.logical_or.reduce([x[1:] != x[:-1] for x in columns]))
    last = tuple(x[-1] for x in columns)
    return batch if new.all() else batch.filter(pa.array(new)), last


def _sorted(length: int):
    """Spans of windows that repeat an earlier one, of runs in order of anchor string, document and place."""

    def spans(rows: pa.Table) -> pa.RecordBatch:
        rows = rows.combine_chunks()
        place = rows["place"].to_numpy()
        text, offsets = utf8(rows["bytes"].chunk(0))
        owned = (place & 16383) + 1
        begin = np.cumsum(owned) - owned
        starts = np.arange(owned.sum()) - np.repeat(begin - offsets[:-1], owned)
        again = np.sort(repeats(text, starts, length))
        new = np.flatnonzero(np.append(True, (np.diff(again) > 1) | (np.diff(np.searchsorted(offsets, again, "right")) > 0))) if len(again) else again
        of = np.searchsorted(offsets, again[new], "right") - 1
        ends = again[np.append(new[1:] - 1, len(again) - 1)] if len(again) else again
        shift = (place >> 14)[of] - offsets[of]
        ids = (rows[k].chunk(0).take(pa.array(of)) for k in ("doc_id", "sign"))
        return pa.RecordBatch.from_arrays([*ids, pa.array(again[new] + shift), pa.array(ends + shift + length)], names=["doc_id", "sign", "begin", "end"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size, last = 0, None
        for batch in batches:
            batch, last = _once(batch, last)
            if not batch.num_rows:
                continue
            strings, sizes = batch.column(0).to_numpy(), np.diff(utf8(batch.column(4))[1])
            at = 0
            for cut in np.append(np.flatnonzero(np.diff(strings)) + 1, len(strings)).tolist():
                if held and size >= SORT_BYTES and held[-1].column(0)[-1].as_py() != strings[at]:
                    yield spans(pa.Table.from_batches(held))
                    held, size = [], 0
                held.append(batch.slice(at, cut - at))
                size += int(sizes[at:cut].sum())
                at = cut
        if held:
            yield spans(pa.Table.from_batches(held))

    return run


def _merged(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The maximal runs that spans cover."""
    order = np.argsort(begin, kind="stable")
    begin, reach = begin[order], np.maximum.accumulate(end[order])
    new = np.append(True, begin[1:] > reach[:-1])
    return begin[new], reach[np.append(np.flatnonzero(new)[1:] - 1, len(begin) - 1)]


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        begins, ends = [], []
        for spans in batch.column(2):
            begin, end = _merged(*(spans.values.field(k).to_numpy() for k in (0, 1)))
            begins.append(begin)
            ends.append(end)
        lists = (pa.array(x, pa.list_(pa.int64())) for x in (begins, ends))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *lists], names=["doc_id", "sign", "begins", "ends"])


def _signed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", F.xxhash64(text).alias("sign"), text.alias("text"))


def _sent(df: DataFrame, size) -> DataFrame:
    """``df`` (written already) with the hint to send it to all executors if its bytes, ``size`` a row, allow it."""
    return F.broadcast(df) if (df.agg(F.sum(size)).first()[0] or 0) <= BROADCAST_BYTES else df


def repeated_spans(docs: DataFrame, length: int = 100) -> DataFrame:
    """doc_id, sign (a hash of the text), begins and ends (lists) of the maximal runs of bytes to remove.

    Rows without a run are left out.
    """
    with passing(docs.sparkSession) as keep:
        signed = _signed(docs)
        key = [F.unhex(F.sha2("text", 256)).alias("more"), F.octet_length("text").alias("n")]
        same = stash(signed.select("doc_id", "sign", *key).where(F.col("n") >= length), "rs-signs")
        many = same.groupBy("more").agg(F.min("doc_id").alias("low"), F.max(F.col("doc_id").isNull().cast("int")).alias("unnamed"), F.max("doc_id").alias("high"))
        many = many.where((F.col("low") != F.col("high")) | (F.col("unnamed") == 1) & F.col("low").isNotNull())
        first = F.when(F.col("unnamed") == 1, F.lit(None).cast("long")).otherwise(F.col("low"))
        copies = same.join(many, "more").where(~F.col("doc_id").eqNullSafe(first))
        copies = stash(copies.select("doc_id", "sign", "n").distinct(), "rs-copies")
        # An id with a whole copy may have other texts too: these are told apart by their hash again.
        own = signed.join(_sent(copies.select(F.col("doc_id").alias("c_id"), F.col("sign").alias("c_sign")), F.lit(32)), F.col("doc_id").eqNullSafe(F.col("c_id")) & (F.col("sign") == F.col("c_sign")), "left_anti")

        # Runs known to repeat another of their own batch need no comparison and are dealt out by their place, so that a
        # string of a third of all documents sends few rows to its task.
        dealt = F.when(F.col("again"), F.xxhash64("doc_id", "sign", "place")).otherwise(F.col("string"))
        by_string = Window.partitionBy("dealt", "again")
        by_name = Window.partitionBy("dealt", "again", "whole").orderBy("doc_id", "sign", "place")
        runs = own.mapInArrow(tidy(_runs(length, int.from_bytes(os.urandom(7)))), _RUNS).withColumn("dealt", dealt).repartition("dealt")
        found = (
            runs.withColumns({"rows": F.count(F.lit(1)).over(by_string), "w0": F.min("whole").over(by_string), "w1": F.max("whole").over(by_string)})
            .where("rows > 1 OR again")
            .withColumn("nth", F.dense_rank().over(by_name))
            .where("w0 != w1 OR nth > 1 OR again")
            .select("doc_id", "sign", "place", F.when((F.col("nth") == 1) & ~F.col("again"), F.col("string")).alias("string"))
        )
        found = stash(found, "rs-runs")
        opened = found.where("string IS NOT NULL").groupBy("doc_id", "sign").agg(F.collect_set(F.struct("place", "string")).alias("open"))
        opened = stash(opened.withColumnsRenamed({"doc_id": "o_id", "sign": "o_sign"}), "rs-open")
        texts = own.join(_sent(opened, F.size("open") * 16 + 64), F.col("doc_id").eqNullSafe(F.col("o_id")) & (F.col("sign") == F.col("o_sign")))
        contexts = texts.select("doc_id", "sign", "text", "open").mapInArrow(tidy(_contexts(length)), "string long, doc_id long, sign long, place long, bytes binary")
        ordered = contexts.repartition("string").sortWithinPartitions("string", "doc_id", "sign", "place")
        span = "doc_id long, sign long, begin long, end long"
        windows = ordered.mapInArrow(tidy(_sorted(length)), span)
        start = F.shiftright("place", 14)
        whole = found.where("string IS NULL").select("doc_id", "sign", start.alias("begin"), (start + F.col("place").bitwiseAND(F.lit(16383)) + length).alias("end"))
        copied = copies.select("doc_id", "sign", F.lit(0).cast("long").alias("begin"), F.col("n").cast("long").alias("end"))
        spans = windows.unionByName(whole).unionByName(copied).groupBy("doc_id", "sign").agg(F.collect_list(F.struct("begin", "end")).alias("spans"))
        merged = stash(spans.mapInArrow(_merge, "doc_id long, sign long, begins array<long>, ends array<long>"), "rs-spans")
        keep(merged)
    return merged


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = utf8(batch.column(1))
        raw, rows = data.tobytes(), []
        for k, (begins, ends) in enumerate(zip(batch.column(2), batch.column(3))):
            a, b = offsets[k], offsets[k + 1]
            begins, ends = begins.as_py() or [], ends.as_py() or []
            kept = b"".join(raw[a + x : a + y] for x, y in zip([0, *ends], [*begins, b - a]))
            rows.append((b - a, b - a - len(kept), len(begins), hashlib.sha256(kept).hexdigest(), kept))
        columns = [pa.array(x, t) for x, t in zip(zip(*rows) if rows else [[]] * 5, (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()))]
        yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def remove_repeats(docs: DataFrame, length: int = 100) -> DataFrame:
    """Every row of ``docs`` as doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept (the remaining bytes)."""
    spans = repeated_spans(docs, length).withColumnsRenamed({"doc_id": "s_id", "sign": "s_sign"})
    spans = _sent(spans, F.size("begins") * 16 + 96)
    whole = _signed(docs).join(spans, F.col("doc_id").eqNullSafe(F.col("s_id")) & (F.col("sign") == F.col("s_sign")), "left")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    return whole.select("doc_id", "text", "begins", "ends").mapInArrow(tidy(_cut), schema)
