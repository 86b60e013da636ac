"""Ranked lexical search with hashed max-sketches as upper bounds.

A document's impact of a term depends on how often it holds the term and on its
length. Its sketch has ``COORDINATES`` numbers: each is the largest impact of the
terms that hash to it. A query's terms, looked up in the sketch and weighted,
bound its score from above.

One pass counts documents, terms, and the documents that hold each query term.
In a second pass each task reads its documents in chunks, folds them into
sketches, bounds all queries at once, and scores exactly in descending order of
the bounds until they fall below the k-th score the task has found so far. The
tasks' best meet per query. Queries come in blocks of about ``BLOCK_BYTES``, so
what is sent to the tasks is bounded however many there are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lendmark.llm.text import LOWER, Parts, chunks, encoded, raw

COORDINATES = 1024
BLOCK_BYTES = 4 << 20
FIRST_LOOK = 32  # documents per query that are scored before any threshold is known
BATCH = 1 << 15  # pairs of documents and queries scored between two looks at the thresholds

TERM = np.zeros(256, dtype=bool)
TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

FOUND = "query int, query_id long, doc_id long, score long"


def terms(column: pa.Array) -> Parts:
    """Terms of each row: runs of ASCII letters and digits and of all characters beyond ASCII, A-Z lower-cased."""
    data, offsets = raw(column)
    data = LOWER[data]
    inside = TERM[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    begins = offsets[:-1][np.diff(offsets) > 0]
    first[begins] = inside[begins]
    starts = np.flatnonzero(first)
    codes, values = encoded(data[inside], np.cumsum(inside, dtype=np.int64)[starts] - 1)
    return Parts(codes, values, np.searchsorted(starts, offsets))


@dataclass
class Queries:
    """Terms of a block of queries: query q has ``codes[bounds[q]:bounds[q + 1]]``, each ``times`` over."""

    ids: list[int | None]
    vocabulary: pa.Array
    codes: np.ndarray
    times: np.ndarray
    bounds: np.ndarray
    weights: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    documents: int = 0
    length: int = 0

    @staticmethod
    def of(ids: Sequence[int | None], texts: Sequence[str | None]) -> Queries:
        found = terms(pa.array(texts, pa.string()))
        size = max(1, len(found.values))
        keys, times = np.unique(found.rows * size + found.codes, return_counts=True)
        bounds = np.searchsorted(keys // size, np.arange(len(ids) + 1))
        return Queries(list(ids), found.values, keys % size, times, bounds)

    def weigh(self, documents: int, length: int, holding: np.ndarray) -> None:
        """Weight of each term from the numbers of documents that hold it."""
        self.documents, self.length = documents, length
        ratio = [(2 * documents + 2) / (2 * int(df) + 1) for df in holding]
        self.weights = np.array([math.floor(1000 * math.log(r)) for r in ratio], dtype=np.int64)


def _held(found: Parts, vocabulary: pa.Array) -> np.ndarray:
    """Number of each distinct term of a chunk in the vocabulary, -1 where it isn't there."""
    at = pc.index_in(found.values, value_set=vocabulary)
    return pc.fill_null(at, -1).to_numpy(zero_copy_only=False).astype(np.int64)


def _counted(found: Parts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``row, code, times`` of the distinct terms of each row."""
    size = max(1, len(found.values))
    keys, times = np.unique(found.rows * size + found.codes, return_counts=True)
    return keys // size, keys % size, times


def statistics(documents: DataFrame, vocabulary: pa.Array) -> tuple[int, int, np.ndarray]:
    """Documents with a term, terms of all documents, and documents that hold each term of the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(vocabulary) + 2, dtype=np.int64)
        for batch in batches:
            for part in chunks(batch):
                found = terms(part.column("text"))
                counts[0] += (found.counts > 0).sum()
                counts[1] += len(found.codes)
                at = _held(found, vocabulary)[_counted(found)[1]] if len(found.codes) else np.empty(0, np.int64)
                counts[2:] += np.bincount(at[at >= 0], minlength=len(vocabulary))
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(counts[some])], ["slot", "n"])

    found = documents.mapInArrow(run, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    counts = np.zeros(len(vocabulary) + 2, dtype=np.int64)
    for slot, n in found.collect():  # at most two more than the block has terms
        counts[slot] = n
    return int(counts[0]), int(counts[1]), counts[2:]


def impacts(times: np.ndarray, sizes: np.ndarray, documents: int, length: int) -> np.ndarray:
    """Saturating term frequency, in millionths, for terms of documents of the given sizes."""
    largest = int(sizes.max()) if len(sizes) else 0
    if 25 * largest * documents < 1 << 62:
        m = 75 + (25 * documents * sizes) // max(1, length)
    else:
        m = np.array([75 + 25 * documents * int(n) // length for n in sizes], dtype=np.int64)
    return (1_000_000_000 * times) // (1000 * times + 12 * m)


class _Index:
    """The documents of one chunk: their sketches, and the exact impacts of the block's terms."""

    def __init__(self, found: Parts, queries: Queries, coordinates: int):
        row, code, times = _counted(found)
        impact = impacts(times, found.counts[row], queries.documents, queries.length)
        spots = np.fromiter((xxhash.xxh3_64_intdigest(v, 13) % coordinates for v in found.values.to_pylist()), np.int64)
        self.sketches = np.zeros((len(found.counts), coordinates))
        if len(row):
            np.maximum.at(self.sketches.reshape(-1), row * coordinates + spots[code], impact)
        self.size = max(1, len(queries.vocabulary))
        at = _held(found, queries.vocabulary)[code] if len(code) else np.empty(0, np.int64)
        keys, self.impacts = row[at >= 0] * self.size + at[at >= 0], impact[at >= 0]
        order = np.argsort(keys)
        self.keys, self.impacts = keys[order], self.impacts[order]

    def scores(self, rows: np.ndarray, asked: np.ndarray, queries: Queries) -> np.ndarray:
        """Exact scores of pairs of a row and a query; each query has terms."""
        sizes = (queries.bounds[1:] - queries.bounds[:-1])[asked]
        ends = np.cumsum(sizes)
        place = np.arange(ends[-1]) - np.repeat(ends - sizes - queries.bounds[asked], sizes)
        code = queries.codes[place]
        key = np.repeat(rows, sizes) * self.size + code
        at = np.minimum(np.searchsorted(self.keys, key), max(len(self.keys) - 1, 0))
        impact = np.where(self.keys[at] == key, self.impacts[at], 0) if len(self.keys) else np.zeros(len(key), np.int64)
        return np.add.reduceat(queries.weights[code] * queries.times[place] * impact, ends - sizes)


class Top:
    """The k best documents of each query so far: highest score first, ties to the smaller id, missing ids last."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.held = tuple(np.empty(0, np.int64) for _ in range(4))  # query, score, whether the id is missing, id
        self.limit = np.ones(queries, dtype=np.int64)

    def take(self, query: np.ndarray, score: np.ndarray, missing: np.ndarray, doc: np.ndarray) -> None:
        hit = score >= self.limit[query]
        if not hit.any():
            return
        columns = [np.concatenate([a, b[hit]]) for a, b in zip(self.held, (query, score, missing, doc))]
        query, score, missing, doc = columns
        order = np.lexsort((doc, missing, -score, query))
        query = query[order]
        place = np.arange(len(query)) - np.searchsorted(query, query)
        kept = order[place < self.k]
        self.held = tuple(c[kept] for c in columns)
        full = order[place == self.k - 1]
        self.limit[columns[0][full]] = columns[1][full]


def _search(queries: Queries, k: int, coordinates: int):
    asked = np.flatnonzero(np.diff(queries.bounds))
    spots = np.fromiter((xxhash.xxh3_64_intdigest(v, 13) % coordinates for v in queries.vocabulary.to_pylist()), np.int64)
    weighted = np.zeros((coordinates, len(asked)))
    for column, q in enumerate(asked):
        own = slice(queries.bounds[q], queries.bounds[q + 1])
        np.add.at(weighted[:, column], spots[queries.codes[own]], queries.weights[queries.codes[own]] * queries.times[own])

    def offer(top: Top, index: _Index, rows: np.ndarray, columns: np.ndarray, docs: np.ndarray, missing: np.ndarray) -> None:
        if len(rows):
            top.take(asked[columns], index.scores(rows, asked[columns], queries), missing[rows], docs[rows])

    def rank(part: pa.RecordBatch, top: Top) -> None:
        index = _Index(terms(part.column("text")), queries, coordinates)
        ids = part.column("doc_id")
        missing = ids.is_null().to_numpy(zero_copy_only=False).astype(np.int64)
        docs = pc.fill_null(ids, 0).to_numpy(zero_copy_only=False)
        bounds = np.ceil((index.sketches @ weighted) * (1 + 1e-12))
        if len(bounds) > FIRST_LOOK:
            rows = np.argpartition(-bounds, FIRST_LOOK, axis=0)[:FIRST_LOOK].ravel()
            columns = np.tile(np.arange(len(asked)), FIRST_LOOK)
            good = bounds[rows, columns] >= top.limit[asked[columns]]
            offer(top, index, rows[good], columns[good], docs, missing)
            bounds[rows, columns] = 0
        rows, columns = np.nonzero(bounds >= top.limit[asked])
        bound = bounds[rows, columns]
        order = np.argsort(-bound, kind="stable")
        for start in range(0, len(order), BATCH):
            some = order[start : start + BATCH]
            some = some[bound[some] >= top.limit[asked[columns[some]]]]
            offer(top, index, rows[some], columns[some], docs, missing)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = Top(len(queries.ids), k)
        for batch in batches:
            for part in chunks(batch):
                if len(asked):
                    rank(part, top)
        query, score, missing, doc = top.held
        names = pa.array(queries.ids, pa.int64())
        columns = [pa.array(query, pa.int32()), names.take(pa.array(query)), pa.array(doc, mask=missing == 1), pa.array(score)]
        yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in FOUND.split(", ")])

    return run


def search(
    documents: DataFrame,
    queries: DataFrame,
    k: int = 20,
    coordinates: int = COORDINATES,
    id_column: str = "doc_id",
    text_column: str = "text",
    query_id_column: str = "item_id",
    query_text_column: str = "text",
) -> DataFrame:
    """``query_id, rank, doc_id, score`` of each query's ``k`` best documents with a score above 0.

    A term's weight is ``floor(1000 ln((2N + 2) / (2 df + 1)))``, and repeated terms
    of a query count as often. Equal scores rank by ascending id, rows without an id
    last. Null and empty texts have no terms: such documents are never found and
    such queries find nothing. Rows of one id are documents of their own; equal
    query rows are one query, and rows of one query id with different texts are
    ranked apart. Other columns are not read.
    """
    spark = documents.sparkSession
    docs = documents.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), F.col(f"`{text_column}`").alias("text"))
    asked = queries.select(
        F.col(f"`{query_id_column}`").cast("long").alias("query_id"), F.coalesce(F.col(f"`{query_text_column}`"), F.lit("")).alias("text")
    ).distinct()
    size = asked.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    blocks = -(-size // BLOCK_BYTES)
    ranked = None
    for block in range(blocks):
        rows = asked.filter(F.pmod(F.xxhash64("query_id", "text"), F.lit(blocks)) == block).sort("query_id", "text").collect()
        found = Queries.of([r["query_id"] for r in rows], [r["text"] for r in rows])
        found.weigh(*statistics(docs, found.vocabulary))
        best = W.partitionBy("query", "query_id").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
        part = docs.mapInArrow(_search(found, k, coordinates), FOUND).withColumn("rank", F.row_number().over(best))
        part = part.filter(F.col("rank") <= k).select("query_id", "rank", "doc_id", "score")
        ranked = part if ranked is None else ranked.unionByName(part)
    return ranked if ranked is not None else spark.createDataFrame([], "query_id long, rank int, doc_id long, score long")
