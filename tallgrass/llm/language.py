"""Language identification by a byte convolutional network.

Texts are cut into windows of ``WINDOW`` bytes, the last one padded. Filters of several widths slide over a window's
bytes (a filter is a table of weights for each byte at each place, as if bytes were one-hot), the maximum of each
filter over the window goes through a rectifier, and a softmax layer gives the languages' probabilities. A document
has the mean of its windows' probabilities, weighted by their bytes, so whole texts count. The network is trained in
numpy on windows of a bounded sample of labelled texts; it is applied to batches of windows with filters laid out by
byte pairs, which halves the look-ups.

Defined cases: null text and text without a letter are ``und`` with score 0, and so is every text if there is nothing
to learn from; ties go to the first language by name; null ids are predicted, not learned from, and not held out;
repeated rows are predicted alike; an empty table gives an empty result; only doc_id, text and lang are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallgrass.llm.joins import keyed as by_row, small, without
from tallgrass.llm.shingles import chunks, utf8
from tallgrass.plans.durable import stash
from tallgrass.plans.workers import tidy

#: Bytes of a window.
WINDOW = 256
#: Widths of filters, and filters of each.
WIDTHS = (2, 3, 4)
FILTERS = 16
#: Labelled documents that are learned from at most, over all languages, and windows of each.
SAMPLE_DOCS = 4000
SAMPLE_WINDOWS = 4

UNKNOWN = "und"


@dataclass
class Network:
    languages: list[str]
    filters: list[np.ndarray]  # of each width: place, byte, filter
    bias: np.ndarray  # of each filter
    weights: np.ndarray  # filter, language
    offset: np.ndarray  # of each language


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Padded windows of texts, how many each text has, and how many bytes each window has."""
    sizes = np.diff(offsets)
    counts = -(-sizes // WINDOW)
    ends = np.cumsum(counts)
    out = np.zeros(int(ends[-1]) * WINDOW if len(ends) else 0, np.uint8)
    out[np.arange(len(data)) + np.repeat((ends - counts) * WINDOW - offsets[:-1], sizes)] = data
    full = np.full(int(ends[-1]) if len(ends) else 0, WINDOW)
    some = counts > 0
    full[ends[some] - 1] = sizes[some] - (counts[some] - 1) * WINDOW
    return out.reshape(-1, WINDOW), counts, full


def softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


def _convolved(net: Network, batch: np.ndarray) -> list[np.ndarray]:
    """Each width's filters at each place of each window."""
    out = []
    for width, tables in zip(WIDTHS, net.filters):
        n = WINDOW - width + 1
        total = tables[0][batch[:, :n]]
        for j in range(1, width):
            total += tables[j][batch[:, j : n + j]]
        out.append(total)
    return out


def gradients(net: Network, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    """Of the mean cross-entropy of windows ``x`` with labels ``y``, by filters of each width, bias, weights and offset."""
    conv = _convolved(net, x)
    places = [c.argmax(axis=1) for c in conv]
    most = np.concatenate([np.take_along_axis(c, p[:, None], 1)[:, 0] for c, p in zip(conv, places)], axis=1) + net.bias
    hidden = np.maximum(most, 0)
    error = softmax(hidden @ net.weights + net.offset)
    error[np.arange(len(y)), y] -= 1
    error /= len(y)
    back = (error @ net.weights.T) * (most > 0)
    slopes = []
    for j, (width, place) in enumerate(zip(WIDTHS, places)):
        slope = np.zeros_like(net.filters[j])
        own = back[:, j * FILTERS : (j + 1) * FILTERS]
        rows, columns = np.arange(len(x))[:, None], np.arange(FILTERS)[None, :]
        for i in range(width):
            np.add.at(slope[i], (x[rows, place + i], np.broadcast_to(columns, place.shape)), own)
        slopes.append(slope)
    return [*slopes, back.sum(axis=0), hidden.T @ error, error.sum(axis=0)]


def train(batches: np.ndarray, labels: np.ndarray, languages: list[str], epochs: int = 6, size: int = 64, rate: float = 0.01) -> Network:
    """Adam on cross-entropy; some windows are cut short, so that short texts are known too."""
    rng = np.random.default_rng(3)
    k = len(languages)
    net = Network(
        languages,
        [rng.normal(0, 0.1, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS],
        np.zeros(FILTERS * len(WIDTHS), np.float32),
        rng.normal(0, 0.1, (FILTERS * len(WIDTHS), k)).astype(np.float32),
        np.zeros(k, np.float32),
    )
    parameters = [*net.filters, net.bias, net.weights, net.offset]
    first, second = ([np.zeros_like(p) for p in parameters] for _ in range(2))
    steps = 0
    for _ in range(max(epochs, -(-300 * size // max(1, len(batches))))):
        order = rng.permutation(len(batches))
        for at in range(0, len(order), size):
            some = order[at : at + size]
            x, y = batches[some].copy(), labels[some]
            short = rng.random(len(x)) < 0.3
            for row, cut in zip(np.flatnonzero(short), rng.integers(12, WINDOW, short.sum())):
                x[row, cut:] = 0
            slopes = gradients(net, x, y)
            steps += 1
            scale = rate * np.sqrt(1 - 0.999**steps) / (1 - 0.9**steps)
            for p, g, m, v in zip(parameters, slopes, first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= scale * m / (np.sqrt(v) + 1e-8)
    return net


class Applied:
    """A network laid out by byte pairs."""

    BATCH = 32

    def __init__(self, net: Network):
        two, three, four = net.filters
        pair = lambda a, b: (a[:, None, :] + b[None, :, :]).reshape(1 << 16, FILTERS)
        self.net = net
        self.first = np.concatenate([pair(two[0], two[1]), pair(three[0], three[1]), pair(four[0], four[1])], axis=1)
        self.third = three[2]
        self.last = pair(four[2], four[3])

    def probabilities(self, batch: np.ndarray) -> np.ndarray:
        most = np.empty((len(batch), self.first.shape[1]), np.float32)
        f = FILTERS
        for at in range(0, len(batch), self.BATCH):
            x = batch[at : at + self.BATCH]
            pairs = x[:, :-1].astype(np.uint16) * np.uint16(256) + x[:, 1:]
            sums = self.first[pairs]
            sums[:, :-1, f : 2 * f] += self.third[x[:, 2:]]
            sums[:, :-2, 2 * f :] += self.last[pairs[:, 2:]]
            sums[:, -1, f : 2 * f] = -np.inf  # the filter would stand out of the window
            sums[:, -2:, 2 * f :] = -np.inf
            most[at : at + self.BATCH] = sums.max(axis=1)
        return softmax(np.maximum(most + self.net.bias, 0) @ self.net.weights + self.net.offset)


def _sampled_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = utf8(batch.column(1))
        for a, b in chunks(offsets):
            cut, counts, _ = windows(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            begins = np.cumsum(counts) - counts
            rows = [(k, begins[k - a] + w) for k in range(a, b) for w in sorted({*np.linspace(0, counts[k - a] - 1, SAMPLE_WINDOWS).astype(int)}) if counts[k - a]]
            of = pa.array([k for k, _ in rows], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(of), batch.column(2).take(of), pa.array([cut[w].tobytes() for _, w in rows], pa.binary())], names=["draw", "lang", "bytes"]
            )


def learn(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Network | None:
    """The network learned from a sample of the labelled rows of ``docs`` that aren't held out."""
    draw = F.xxhash64("doc_id")
    labelled = docs.select("doc_id", "text", "lang").where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    counts = labelled.groupBy("lang").count()
    each = F.floor(F.lit(sample_docs) / F.greatest(F.lit(1), F.count(F.lit(1)).over(Window.partitionBy())))
    share = counts.withColumn("each", F.greatest(F.lit(1), each)).select(F.col("lang").alias("its_lang"), "each", (F.col("each") * 2 + 50).alias("some"), "count")
    # Twice as many as are wanted pass by their hash; of these the first by hash are taken. Rows that repeat id, text and
    # language are one, before any of them meet, so that no more texts than were asked for reach the driver.
    keyed = labelled.select(F.xxhash64("doc_id", "text", "lang").alias("key"), draw.alias("draw"), "lang", "text")
    thin = keyed.select("key", "draw", "lang").join(small(share), F.col("lang") == F.col("its_lang"))
    thin = thin.where(F.pmod("draw", F.lit(1 << 20)) * F.col("count") < F.col("some") * (1 << 20)).select("key", "draw", "lang", "each").distinct()
    by_draw = Window.partitionBy("lang").orderBy("draw", "key")
    taken = thin.withColumn("rank", F.row_number().over(by_draw)).where("rank <= each").select("key").distinct()
    # A row per language is at least one, so languages beyond sample_docs are the bound then.
    rows = keyed.join(F.broadcast(taken), "key", "left_semi").groupBy("key").agg(F.first("draw").alias("draw"), F.first("text").alias("text"), F.first("lang").alias("lang"))
    rows = rows.select("draw", "text", "lang").mapInArrow(tidy(_sampled_windows), "draw long, lang string, bytes binary").toArrow()
    if not rows.num_rows:
        return None
    rows = rows.sort_by([("lang", "ascending"), ("draw", "ascending"), ("bytes", "ascending")])
    languages = sorted(set(rows["lang"].to_pylist()))
    labels = np.array([languages.index(x) for x in rows["lang"].to_pylist()])
    return train(np.frombuffer(b"".join(rows["bytes"].to_pylist()), np.uint8).reshape(-1, WINDOW), labels, languages)


def _predict(net: Network):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        applied, names = Applied(net), np.array(net.languages, object)
        for batch in batches:
            data, offsets = utf8(batch.column(2))
            for a, b in chunks(offsets, 1 << 20):
                cut, counts, full = windows(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                known, scores = np.full(b - a, UNKNOWN, object), np.zeros(b - a)
                some = np.flatnonzero(counts)
                if len(some):
                    begins = (np.cumsum(counts) - counts)[some]
                    mean = np.add.reduceat(applied.probabilities(cut) * full[:, None].astype(np.float64), begins) / np.add.reduceat(full, begins)[:, None]
                    known[some], scores[some] = names[mean.argmax(axis=1)], mean.max(axis=1).clip(0, 1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(known, pa.string()), pa.array(scores)],
                    names=["doc_id", "letters", "lang_pred", "score"],
                )

    return run


def identify(docs: DataFrame, net: Network | None) -> DataFrame:
    """doc_id, lang_pred and score of every row of ``docs``."""
    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters")
    if net is None:
        return docs.select("doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    found = docs.select("doc_id", letters, "text").mapInArrow(tidy(_predict(net)), "doc_id long, letters boolean, lang_pred string, score double")
    return found.select(
        "doc_id",
        F.when(F.col("letters"), F.col("lang_pred")).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(F.col("letters"), F.col("score")).otherwise(0.0).alias("score"),
    )


def accepted(docs: DataFrame, net: Network | None, least: float = 0.35) -> DataFrame:
    """The rows of ``docs``, all columns kept, whose language is known with a score of at least ``least``.

    Rows are judged by their own text, whatever others have their id.
    """
    bad = identify(by_row(docs), net).where((F.col("lang_pred") == UNKNOWN) | (F.col("score") < least)).select("doc_id").distinct()
    return without(docs, stash(bad, "lang-rejected"))
