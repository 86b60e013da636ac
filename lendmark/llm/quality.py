"""Quality classifier: random-indexing word vectors, pooled per document, and a two-layer network.

Every word falls into two buckets: one by its lower-cased whole text, one by its
shape. What has more than 64 bytes without a blank counts as several words, so
texts without blanks take part whole. A bucket's index vector is sparse and random, but fixed. Its word vector is
the sum of the index vectors of its neighbours of the same kind in the learning
rows, all of them. A document is the mean vector of its words, that of its shapes,
and a few figures of repetition. A small network trained in numpy gives a
logit, and a temperature fitted on rows kept aside makes it a probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendmark.llm.samples import smallest_hashes
from lendmark.llm.text import LOWER, Parts, chunks, encoded, raw, words

WORDS = 1 << 16
SHAPES = 2048
BUCKETS = WORDS + SHAPES  # those of the words come first
DIMENSIONS = 32
NONZEROS = 4
WINDOW = 2
REJECT_BELOW = 0.7

# The kind of a byte of a word: small letters and all beyond ASCII, capitals, digits; a mark is its own kind.
KIND = np.arange(256, dtype=np.uint8)
KIND[[*range(97, 123), *range(128, 256)]] = ord("a")
KIND[65:91] = ord("A")
KIND[48:58] = ord("9")
MARK = KIND == np.arange(256)
MARK[[ord(c) for c in "aA9"]] = False
LONGEST_REPEAT = 3  # of a mark


def held_out(id_column: Column) -> Column:
    """Rows that are kept from learning: crc32 of the id as text, modulo 4, is 2; a null id is not held out."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 4 == 2, F.lit(False))


@lru_cache(maxsize=1)
def nonzeros() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the nonzeros of each bucket's index vector."""
    rng = np.random.default_rng(1)
    places = rng.random((BUCKETS, DIMENSIONS), dtype=np.float32).argsort(axis=1)[:, :NONZEROS]
    return np.ascontiguousarray(places), rng.choice([-1.0, 1.0], (BUCKETS, NONZEROS))


def index_vectors() -> np.ndarray:
    """Sparse ternary vectors, fixed by the number of the bucket."""
    places, signs = nonzeros()
    vectors = np.zeros((BUCKETS, DIMENSIONS), dtype=np.float32)
    np.put_along_axis(vectors, places, signs.astype(np.float32), 1)
    return vectors


def shapes(words_of: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Of each word the kinds of its runs, as codes into distinct shapes; a repeated mark stays up to three times."""
    data, offsets = raw(words_of)
    kind = KIND[data]
    opens = np.ones(len(data), dtype=bool)
    opens[1:] = kind[1:] != kind[:-1]
    opens[offsets[:-1]] = True
    at = np.arange(len(data))
    stays = opens | (MARK[data] & (at - np.maximum.accumulate(np.where(opens, at, 0)) < LONGEST_REPEAT))
    ends = np.concatenate([[0], np.cumsum(stays)])[offsets]
    return encoded(kind[stays], ends[:-1])


def _hashed(values: list[bytes], modulo: int) -> np.ndarray:
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, values), np.uint64, len(values))
    return (hashes % np.uint64(modulo)).astype(np.int64)


def _value_buckets(parts: Parts) -> np.ndarray:
    """Buckets of each distinct word: of its lower-cased text, and of its shape."""
    out = np.empty((len(parts.values), 2), dtype=np.int64)
    if not len(out):
        return out
    data, offsets = raw(parts.values)
    lower = pa.Array.from_buffers(
        pa.large_binary(), len(out), [None, pa.py_buffer(np.ascontiguousarray(offsets)), pa.py_buffer(LOWER[data])]
    )
    out[:, 0] = _hashed(lower.to_pylist(), WORDS)
    beyond = np.flatnonzero(np.logical_or.reduceat(data >= 128, offsets[:-1]))
    texts = (word.decode("utf-8", "replace").lower() for word in parts.values.take(pa.array(beyond)).to_pylist())
    out[beyond, 0] = _hashed([text.encode("utf-8", "replace") for text in texts], WORDS)
    codes, distinct = shapes(parts.values)
    out[:, 1] = WORDS + _hashed([b"s" + shape for shape in distinct.to_pylist()], SHAPES)[codes]
    return out


def _buckets(parts: Parts) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words and of the shapes of all parts."""
    per_value = _value_buckets(parts)
    return per_value[parts.codes, 0], per_value[parts.codes, 1]


# --------------------------------------------------------------- word vectors


def _add_neighbours(
    sums: np.ndarray, used: np.ndarray, rows: np.ndarray, codes: np.ndarray, places: np.ndarray, signs: np.ndarray
) -> None:
    """Add the index vectors of the neighbours of each bucket; a chunk counts in its own buckets first."""
    here = np.zeros(BUCKETS, dtype=bool)
    here[codes] = True
    some = np.flatnonzero(here)
    slots = np.empty(BUCKETS, dtype=np.int64)
    slots[some] = np.arange(len(some)) * DIMENSIONS
    own_sums = np.zeros(len(some) * DIMENSIONS)
    for step in range(1, WINDOW + 1):
        same = rows[step:] == rows[:-step]
        left, right = codes[:-step][same], codes[step:][same]
        for own, other in ((left, right), (right, left)):
            used[own] = True
            slot = slots[own]
            for j in range(NONZEROS):
                own_sums += np.bincount(slot + places[other, j], signs[other, j], minlength=len(own_sums))
    sums[some] += own_sums.reshape(-1, DIMENSIONS)


def neighbour_sums(texts: DataFrame) -> DataFrame:
    """``bucket, vector`` per task: sums of neighbours' index vectors over its rows (column ``text``).

    A task sends at most ``BUCKETS`` short vectors, whatever it reads. Sums are
    of whole numbers, so their order doesn't matter.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, signs = nonzeros()
        sums = np.zeros((BUCKETS, DIMENSIONS))
        used = np.zeros(BUCKETS, dtype=bool)
        for batch in batches:
            for part in chunks(batch):
                found = words(part.column("text"), cut=True)
                rows = found.rows
                for codes in _buckets(found):
                    _add_neighbours(sums, used, rows, codes, places, signs)
        some = np.flatnonzero(used)
        for start in range(0, len(some), 8192):
            own = some[start : start + 8192]
            flat = sums[own].ravel()
            lists = pa.FixedSizeListArray.from_arrays(pa.array(flat), DIMENSIONS).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.int32()), lists], ["bucket", "vector"])

    return texts.mapInArrow(count, "bucket int, vector array<double>")


def word_vectors(texts: DataFrame) -> np.ndarray:
    """Unit word vectors of all buckets; a bucket without neighbours keeps its index vector."""
    sums = [F.sum(F.col("vector")[k]).alias(f"v{k}") for k in range(DIMENSIONS)]
    rows = neighbour_sums(texts).groupBy("bucket").agg(*sums).toArrow()  # at most BUCKETS rows
    vectors = index_vectors().astype(np.float64)
    found = np.column_stack([rows[f"v{k}"].to_numpy() for k in range(DIMENSIONS)])
    some = found.any(axis=1)
    vectors[rows["bucket"].to_numpy()[some]] = found[some]
    return (vectors / np.linalg.norm(vectors, axis=1, keepdims=True)).astype(np.float32)


# ------------------------------------------------------------------ documents

FIGURES = 10
INPUTS = 2 * DIMENSIONS + FIGURES


def pooled(column: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """Mean vectors of words and shapes of each row and figures of repetition; zeros for a row without words."""
    found = words(column, cut=True)
    n_rows, rows, n = len(found.bounds) - 1, found.rows, found.counts
    out = np.zeros((n_rows, INPUTS), dtype=np.float32)
    if not len(rows):
        return out
    some = np.flatnonzero(n)
    figures = out[:, 2 * DIMENSIONS :]
    # one sort of all words; the buckets are merged on the distinct words of each row
    size = len(found.values)
    pairs, often = np.unique(rows.astype(np.int64) * size + found.codes, return_counts=True)
    pair_row, pair_value = pairs // size, pairs % size
    for k, codes in enumerate(_value_buckets(found).T):
        keys, place = np.unique(pair_row * BUCKETS + codes[pair_value], return_inverse=True)
        times = np.bincount(place, often)
        row_of, share = keys // BUCKETS, times / n[keys // BUCKETS]
        starts = np.searchsorted(row_of, some)
        weighed = vectors[keys % BUCKETS]
        weighed *= share[:, None].astype(np.float32)
        means = np.add.reduceat(weighed, starts, axis=0)
        out[some, k * DIMENSIONS : (k + 1) * DIMENSIONS] = means
        figures[some, 4 + 3 * k] = np.linalg.norm(means, axis=1)
        figures[some, 5 + 3 * k] = np.maximum.reduceat(share, starts)
        figures[some, 6 + 3 * k] = np.add.reduceat(share * share, starts)
    distinct = np.bincount(pair_row, minlength=n_rows)
    same_row = rows[1:] == rows[:-1]
    again = np.bincount(rows[1:][same_row & (found.codes[1:] == found.codes[:-1])], minlength=n_rows)
    sizes = np.fromiter(map(len, found.values.to_pylist()), np.int64, len(found.values))
    size = found.sums(sizes)
    n1 = np.maximum(n, 1)
    figures[:, 0] = np.log1p(n)
    figures[:, 1] = distinct / n1
    figures[:, 2] = again / n1
    figures[:, 3] = size / n1
    return out


@dataclass
class Network:
    """Two layers over standardised inputs, and the temperature of its logit."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.maximum((x - self.mean) / self.scale @ self.w1 + self.b1, 0) @ self.w2 + self.b2

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.logits(x.astype(np.float64)) / self.temperature, -40, 40)))


def train(x: np.ndarray, y: np.ndarray, hidden: int = 24, rounds: int = 40, rate: float = 0.01) -> Network:
    """Mini-batch Adam on nine tenths of the rows; the temperature is fitted on the last tenth.

    With no rows, or one class only, the network answers the smoothed share of class 1.
    """
    share = (y.sum() + 0.5) / (len(y) + 1.0)
    size = x.shape[1]
    rng = np.random.default_rng(7)
    mean = x.mean(axis=0) if len(x) else np.zeros(size)
    scale = x.std(axis=0) + 1e-3 if len(x) else np.ones(size)
    net = Network(mean, scale, np.zeros((size, hidden)), np.zeros(hidden), np.zeros(hidden), np.log(share / (1 - share)))
    if len(np.unique(y)) < 2:
        return net
    order = rng.permutation(len(y))
    kept = order[: len(y) // 10] if len(y) >= 200 else order
    fit = order[len(y) // 10 :] if len(y) >= 200 else order
    net.w1 = rng.normal(0, (2 / size) ** 0.5, (size, hidden))
    net.w2 = rng.normal(0, (1 / hidden) ** 0.5, hidden)
    z = (x - mean) / scale
    values = [net.w1, net.b1, net.w2, np.array([net.b2])]
    first, second = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
    step = 0
    for _ in range(rounds):
        rng.shuffle(fit)
        for at in range(0, len(fit), 256):
            rows = fit[at : at + 256]
            a = z[rows] @ values[0] + values[1]
            h = np.maximum(a, 0)
            p = 1 / (1 + np.exp(-np.clip(h @ values[2] + values[3], -40, 40)))
            d = (p - y[rows]) / len(rows)
            back = np.outer(d, values[2]) * (a > 0)
            slopes = [z[rows].T @ back + 1e-4 * values[0], back.sum(0), h.T @ d + 1e-4 * values[2], np.array([d.sum()])]
            step += 1
            for v, s, f1, f2 in zip(values, slopes, first, second):
                f1 += 0.1 * (s - f1)
                f2 += 0.001 * (s * s - f2)
                v -= rate * (f1 / (1 - 0.9**step)) / (np.sqrt(f2 / (1 - 0.999**step)) + 1e-8)
    net.w1, net.b1, net.w2, net.b2 = values[0], values[1], values[2], float(values[3][0])
    logits, truth = net.logits(x[kept]), y[kept]
    grid = np.exp(np.linspace(np.log(0.25), np.log(8.0), 80))
    losses = [np.mean(np.logaddexp(0, np.where(truth == 1, -logits, logits) / t)) for t in grid]
    net.temperature = float(grid[int(np.argmin(losses))])
    return net


@dataclass
class QualityModel:
    vectors: np.ndarray
    network: Network

    def scores(self, column: pa.Array) -> np.ndarray:
        return self.network.probabilities(pooled(column, self.vectors))


def fit(
    documents: DataFrame,
    labels: DataFrame,
    max_labelled: int = 20_000,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "quality",
) -> QualityModel:
    """Learn from rows that are not held out.

    Word vectors use all of them. The network uses ``max_labelled`` labels at most,
    those whose ids hash lowest, and twice as many rows at most, as repeated rows
    of an id count each; a null label is no label, and an id with both labels
    counts as both. Labels, ids and other columns are never
    inputs of a score.
    """
    source = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    learning = source.filter(~held_out(F.col("doc_id")) & F.col("text").isNotNull())
    vectors = word_vectors(learning.select("text"))
    known = labels.select(F.col(id_column).cast("long").alias("doc_id"), F.col(label_column).cast("int").alias("y"))
    known = known.filter(F.col("y").isin(0, 1) & ~held_out(F.col("doc_id"))).distinct()
    chosen = smallest_hashes(known, max_labelled, "doc_id", "y")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                x = pooled(part.column("text"), vectors).astype(np.float64)
                lists = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("y"), part.column("h"), lists], ["doc_id", "y", "h", "x"]
                )

    joined = source.join(F.broadcast(chosen), "doc_id")  # max_labelled short rows at most
    hashed = joined.select("doc_id", "y", F.xxhash64("doc_id", "text").alias("h"), "text")
    measured = hashed.mapInArrow(measure, "doc_id long, y int, h long, x array<double>")
    # a labelled id may have any number of rows
    rows = measured.orderBy("h", "doc_id", "y").limit(2 * max_labelled).toArrow()
    rows = rows.sort_by([("doc_id", "ascending"), ("y", "ascending"), ("h", "ascending")])
    x = rows["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, INPUTS)
    return QualityModel(vectors, train(x, rows["y"].to_numpy().astype(np.float64)))


def score(
    documents: DataFrame, model: QualityModel, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` per row, from whole texts.

    Null and empty texts are scored like a text without words. Repeated rows and
    null ids are kept (a null id is not held out); other columns are not read.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)  # of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                values = shared.value.scores(part.column("text"))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(values)], ["doc_id", "score"])

    source = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return source.mapInArrow(run, "doc_id long, score double").select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= REJECT_BELOW).cast("int").alias("predicted"),
    )


def accepted(documents: DataFrame, model: QualityModel, text_column: str = "text") -> DataFrame:
    """The rows, with all their columns, whose score is at least ``REJECT_BELOW``."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, text_column):
                yield part.filter(pa.array(shared.value.scores(part.column(text_column)) >= REJECT_BELOW))

    return documents.mapInArrow(run, documents.schema)
