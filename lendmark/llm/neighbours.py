"""Approximate nearest neighbours by multi-index hashing.

Rotations learned on a bounded sample (iterative quantization from two starts)
turn a vector into a binary code of twice its length. A code is split into
substrings of eight bits, and every shard indexes its codes by each substring.
If two codes differ in at most ``r`` bits, some substring differs in few: with
r = m a + b for m substrings, one of the first b + 1 in at most a bits or one of
the others in at most a - 1. Probing all such buckets finds every code within
``r``; codes within ``r`` are ranked by their exact distance. ``r`` is the
Hamming distance that covers nearly all near pairs of the sample.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendmark.llm import vectors
from lendmark.llm.samples import smallest_hashes
from lendmark.llm.scratch import kept

SUBSTRING = 8
COVERED = 0.985

ONES = np.array([bin(v).count("1") for v in range(256)], dtype=np.uint8)
BY_DISTANCE = np.argsort(ONES, kind="stable")  # masks of eight bits, those with few ones first
UP_TO = np.cumsum(np.bincount(ONES, minlength=9))  # how many masks have at most so many ones


class Coder:
    """Learned rotations, the mean they start from, and the radius to search."""

    def __init__(self, sample: np.ndarray, covered: float = COVERED, k: int = 10, rounds: int = 20):
        d = sample.shape[1]
        self.mean = sample.mean(axis=0)
        centred = sample - self.mean
        self.rotations = []
        for seed in (1, 2):
            rotation, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(d, d)))
            for _ in range(rounds):
                signs = np.where(centred @ rotation >= 0, 1.0, -1.0)
                left, _, right = np.linalg.svd(centred.T @ signs)
                rotation = left @ right
            self.rotations.append(rotation)
        self.radius = self._fitted(sample, covered, k)

    def codes(self, x: np.ndarray) -> np.ndarray:
        """Bytes of the codes, a substring each."""
        bits = np.concatenate([(x - self.mean) @ r >= 0 for r in self.rotations], axis=1)
        return np.packbits(bits, axis=1)

    def _fitted(self, sample: np.ndarray, covered: float, k: int) -> int:
        """Hamming distance that covers the given share of the k nearest of up to 400 rows of the sample."""
        asked = sample[:: max(1, len(sample) // 400)][:400]
        codes, own = self.codes(sample), self.codes(asked)
        distances = []
        for x, code in zip(asked, own):
            gaps = ((sample - x) ** 2).sum(axis=1)
            near = np.argsort(gaps, kind="stable")[1 : k + 1]
            distances.append(ONES[codes[near] ^ code].sum(axis=1))
        flat = np.concatenate(distances) if distances else np.zeros(0)
        return int(np.ceil(np.quantile(flat, covered))) if len(flat) else codes.shape[1] * 8

    def reach(self, radius: int, substrings: int) -> list[int]:
        """Bits by which each substring may differ (-1: it needs no probe)."""
        a, b = divmod(radius, substrings)
        return [min(SUBSTRING, a if j <= b else a - 1) for j in range(substrings)]


def _index(coder: Coder):
    def build(ids: np.ndarray, x: np.ndarray) -> dict[str, bytes]:
        codes = coder.codes(x)
        orders = np.argsort(codes, axis=0, kind="stable").T.astype(np.int32)
        edges = [np.searchsorted(codes[o, j], np.arange(257)).astype(np.int32) for j, o in enumerate(orders)]
        return {
            "codes": codes.tobytes(),
            "orders": np.ascontiguousarray(orders).tobytes(),
            "edges": np.array(edges, dtype=np.int32).tobytes(),
        }

    return build


def distances(rows: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Euclidean distances, squares added in the order of the components."""
    total = np.zeros(len(rows))
    for j in range(rows.shape[1]):
        gap = rows[:, j] - x[j]
        total += gap * gap
    return np.sqrt(total)


def _search(coder: Coder, radius: int):
    def search(row: dict, best: vectors.Best) -> None:
        ids = np.frombuffer(row["ids"], np.int64)
        x = np.frombuffer(row["vectors"]).reshape(len(ids), -1)
        codes = np.frombuffer(row["codes"], np.uint8).reshape(len(ids), -1)
        orders = np.frombuffer(row["orders"], np.int32).reshape(codes.shape[1], len(ids))
        edges = np.frombuffer(row["edges"], np.int32).reshape(codes.shape[1], 257)
        asked = np.frombuffer(row["q_vectors"]).reshape(len(best.queries), -1)
        reach = coder.reach(radius, codes.shape[1])
        for q, code in enumerate(coder.codes(asked)):
            marked = np.zeros(len(ids), dtype=bool)
            for j, bits in enumerate(reach):
                if bits >= 0:
                    for value in (BY_DISTANCE[: UP_TO[bits]] ^ code[j]).tolist():
                        marked[orders[j, edges[j, value] : edges[j, value + 1]]] = True
            at = np.flatnonzero(marked)
            at = at[ONES[codes[at] ^ code].sum(axis=1, dtype=np.int64) <= radius]
            if len(at):
                best.take(np.array([q]), distances(x[at], asked[q])[None, :], ids[at][None, :])

    return search


def nearest(
    embeddings: DataFrame,
    k: int = 10,
    every: int = 100,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    max_sample: int = 10_000,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for rows whose id is divisible by ``every``, the ``k`` nearest found.

    The coder is fitted on the ``max_sample`` rows whose hashes are smallest; every row is indexed. A query with fewer than ``k`` codes within
    the radius is searched again without a radius, so it lacks rows only if the
    table does.

    Null ids, null or zero vectors, and vectors with null or non-finite
    components or an unusual length take no part. Equal rows count once; an id
    with several vectors is found by the nearest of them and asked with each.
    Other columns are not read. An empty table gives no rows.
    """
    spark = embeddings.sparkSession
    rows = vectors.usable(embeddings, id_column, vector_column, lambda v: F.exists(v, lambda x: x != 0))
    total = rows.count()
    sample = smallest_hashes(rows, max_sample, "id", "vector", seed=3, total=total).toArrow().sort_by("id") if total else None
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if sample is None:
        return empty
    coder = Coder(vectors.matrix(sample["vector"]), k=k)
    shards = vectors.packed(rows, vectors.SHARD_ROWS, _index(coder), ", codes binary, orders binary, edges binary")
    index = kept(shards, "index", vectors.FILE_SHARDS)
    queries = rows.filter(F.col("id") % every == 0)
    blocks = kept(vectors.packed(queries, vectors.BLOCK_ROWS), "queries", vectors.FILE_BLOCKS)
    if blocks.isEmpty():
        return empty
    first = kept(vectors.searched(vectors.meeting(index, blocks), k, _search(coder, coder.radius)), "found")
    counts = first.groupBy("query_id").agg(F.count_distinct("vec_id").alias("n"))
    short = queries.join(counts, queries["id"] == counts["query_id"], "left").filter(F.coalesce("n", F.lit(0)) < min(k, total - 1))
    short = kept(vectors.packed(short.select("id", "vector"), vectors.BLOCK_ROWS), "short", vectors.FILE_BLOCKS)
    if not short.isEmpty():
        whole = 2 * SUBSTRING * len(coder.mean)
        first = first.unionByName(vectors.searched(vectors.meeting(index, short), k, _search(coder, whole)))
    return vectors.ranked(first, k).select("query_id", "rank", "vec_id", F.col("value").alias("score"))
