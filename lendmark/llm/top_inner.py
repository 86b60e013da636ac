"""Exact top-k by inner product: a ball tree per shard, branch and bound.

Vectors are turned to integers first. A shard's tree has leaves of few vectors
with their centre and radius; q.c + |q| r is an upper bound for a leaf, and a
leaf's bound is no more than those of the balls around it. Each query visits
the leaves in the order of their bounds and stops where none can beat its
current k-th score. Rounds of 1, 2, 4 ... leaves let queries share a leaf's
product. The k-th score is shared too: it starts from a bounded sample of the
rows and is carried from shard to shard within a task.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendmark.llm import vectors
from lendmark.llm.scratch import kept

LEAF = 128
SAMPLE = 4_096
SCORES = 1 << 18  # in one product, but for those of one query
EXACT = float(1 << 53)
LONG = (1 << 63) - 1


def tree(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Order of the rows by leaf, first row of each leaf, and the balls around each leaf, innermost first.

    A ball is halved across its widest axis between two far points. Balls come
    as centres (leaves, levels, d) and radii (leaves, levels).
    """
    order, edges, balls = [], [], []

    def ball(at: np.ndarray) -> tuple[np.ndarray, float]:
        centre = x[at].mean(axis=0)
        return centre, float(np.sqrt(((x[at] - centre) ** 2).sum(axis=1).max()))

    todo = [(np.arange(len(x)), [])]
    while todo:
        at, around = todo.pop()
        own = ball(at)
        around = [own, *around]
        if len(at) <= LEAF or own[1] == 0.0:
            edges.append(sum(map(len, order)))
            order.append(at)
            balls.append(around[:3])
            continue
        a = x[at[((x[at] - own[0]) ** 2).sum(axis=1).argmax()]]
        b = x[at[((x[at] - a) ** 2).sum(axis=1).argmax()]]
        rank = np.argsort(x[at] @ (b - a), kind="stable")
        half = len(at) // 2
        todo += [(at[rank[:half]], around), (at[rank[half:]], around)]
    levels = max(map(len, balls))
    padded = [b + [b[-1]] * (levels - len(b)) for b in balls]
    centres = np.array([[c for c, _ in b] for b in padded])
    radii = np.array([[r for _, r in b] for b in padded])
    return np.concatenate(order), np.array(edges, dtype=np.int64), centres, radii


def _integers(x: np.ndarray) -> np.ndarray:
    return np.floor(256.0 * x)


def _build(ids: np.ndarray, x: np.ndarray) -> dict[str, bytes]:
    z = _integers(x)
    order, edges, centres, radii = tree(z)
    return {
        "ids": ids[order].tobytes(),
        "vectors": np.ascontiguousarray(z[order]).tobytes(),
        "edges": edges.tobytes(),
        "centres": centres.tobytes(),
        "radii": radii.tobytes(),
    }


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of integer vectors, exact; beyond 53 bits by Python's integers, held within a long."""
    largest = (np.abs(a).max(initial=0.0)) * (np.abs(b).max(initial=0.0)) * max(1, a.shape[1])
    if largest < EXACT:
        return a @ b.T
    left = np.array([[int(v) for v in r] for r in a.tolist()], dtype=object)
    right = np.array([[int(v) for v in r] for r in b.tolist()], dtype=object)
    return np.clip(left @ right.T, -LONG, LONG)


def _search(k: int):
    def search(row: dict, best: vectors.Best) -> None:
        ids = np.frombuffer(row["ids"], np.int64)
        x = np.frombuffer(row["vectors"]).reshape(len(ids), -1)
        edges = np.append(np.frombuffer(row["edges"], np.int64), len(ids))
        n_leaves = len(edges) - 1
        centres = np.frombuffer(row["centres"]).reshape(n_leaves, -1, x.shape[1])
        radii = np.frombuffer(row["radii"]).reshape(n_leaves, -1)
        asked = _integers(np.frombuffer(row["q_vectors"]).reshape(len(best.queries), -1))
        floor = np.frombuffer(row["q_floors"])
        length = np.sqrt((asked**2).sum(axis=1))
        bounds = np.full((len(asked), n_leaves), np.inf)
        for level in range(centres.shape[1]):
            bound = asked @ centres[:, level].T + length[:, None] * radii[:, level]
            bounds = np.minimum(bounds, bound + 1e-9 * np.abs(bound) + 1.0)  # rounding can't hide a score
        visits = np.argsort(-bounds, axis=1, kind="stable")
        turn, width = 0, 1
        while turn < n_leaves:
            leaf = visits[:, turn : turn + width]
            needed = np.maximum(floor, -best.limit)
            row, column = np.nonzero(np.take_along_axis(bounds, leaf, 1) >= needed[:, None])
            if not len(row):
                break
            leaf = leaf[row, column]
            order = np.argsort(leaf, kind="stable")
            starts = np.flatnonzero(np.diff(leaf[order], prepend=-1))
            for some in np.split(order, starts[1:]):
                at = leaf[some[0]]
                a, b = edges[at], edges[at + 1]
                some = row[some]
                some = some[bounds[some, at] >= np.maximum(floor[some], -best.limit[some])]
                step = max(1, SCORES // int(b - a))
                for first in range(0, len(some), step):
                    few = some[first : first + step]
                    scores = _products(asked[few], x[a:b])
                    best.take(few, -scores.astype(np.float64), ids[a:b][None, :])
            turn, width = turn + width, 2 * width

    return search


def top_products(
    embeddings: DataFrame, k: int = 5, every: int = 50, id_column: str = "vec_id", vector_column: str = "embedding"
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for rows whose id is divisible by ``every``, the ``k`` largest inner
    products with all other rows, over components floor(256 x).

    Null ids and vectors, and vectors with null or non-finite components or an
    unusual length take no part, nor do those whose components leave the range
    of doubles when multiplied. Equal rows count once; an id with several
    vectors counts by its best and is asked with each. Scores beyond 53 bits
    compare as doubles. Other columns are not read. An empty table gives no rows.
    """
    spark = embeddings.sparkSession
    rows = vectors.usable(
        embeddings, id_column, vector_column, lambda v: ~F.exists(v, lambda x: F.abs(x * 256.0) == float("inf"))
    )
    total = rows.count()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    queries = rows.filter(F.col("id") % every == 0)
    if not total or queries.isEmpty():
        return empty
    share = min(1.0, SAMPLE / total)
    sample = rows.filter(F.pmod(F.xxhash64(F.lit(6), "id"), F.lit(1_000_000)) < int(1_000_000 * share)).limit(SAMPLE).toArrow()
    shared = spark.sparkContext.broadcast(
        (sample["id"].to_numpy(), _integers(vectors.matrix(sample["vector"])) if sample.num_rows else None)
    )  # SAMPLE rows at most

    def floors(ids: np.ndarray, x: np.ndarray) -> dict[str, bytes]:
        """A score that the k-th of each query can't be below: the k-th within the sample."""
        known, z = shared.value
        low = np.full(len(ids), -np.inf)
        if z is not None and len(np.unique(known)) > k:
            scores = _products(_integers(x), z).astype(np.float64)
            scores[ids[:, None] == known[None, :]] = -np.inf
            if len(np.unique(known)) == len(known):
                low = np.partition(scores, len(known) - k, axis=1)[:, len(known) - k]
        return {"floors": low.tobytes()}

    trees = vectors.packed(rows, vectors.SHARD_ROWS, _build, ", edges binary, centres binary, radii binary")
    index = kept(trees, "trees", vectors.FILE_SHARDS)
    blocks = kept(vectors.packed(queries, vectors.BLOCK_ROWS, floors, ", floors binary"), "queries", vectors.FILE_BLOCKS)
    found = vectors.searched(vectors.meeting(index, blocks), k, _search(k))
    return vectors.ranked(found, k).select("query_id", "rank", "vec_id", (-F.col("value")).cast("long").alias("score"))
