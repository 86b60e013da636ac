"""Connected components of a distributed graph, by alternating large and small stars."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendmark.llm.scratch import kept

MAX_ROUNDS = 60
FEW_EDGES = 100_000  # so many are joined at once in a task, a few MB


def _oriented(edges: DataFrame) -> DataFrame:
    """Each edge once, from the larger node ``u`` to the smaller ``v``."""
    return edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return _oriented(both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return _oriented(moved.unionByName(least.select("u", F.col("m").alias("v"))))


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``node, root`` of few edges ``u, v``."""
    above: dict[int, int] = {}

    def top(x: int) -> int:
        while above.setdefault(x, x) != x:
            above[x] = above[above[x]]
            x = above[x]
        return x

    for batch in batches:
        for u, v in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist()):
            x, y = top(u), top(v)
            above[max(x, y)] = min(x, y)
    roots = [top(x) for x in above]
    yield pa.RecordBatch.from_arrays([pa.array([*above], pa.int64()), pa.array(roots, pa.int64())], ["node", "root"])


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``a, b`` links: root is the smallest node it is connected with.

    At most ``FEW_EDGES`` edges are joined in one task; a round costs about eight stages
    whatever their number. More edges take rounds. Every round is written to the shared folder;
    rounds grow with the logarithm of the longest chain. Stars need only minima per node, which are combined
    before the shuffle. Rows with a null end are ignored; no links give no rows.
    """
    edges = kept(
        _oriented(links.filter("a is not null and b is not null").select(F.col("a").alias("u"), F.col("b").alias("v"))),
        "edges",
    )

    def mark(df: DataFrame):
        return df.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u") % 65536)).first()

    before = mark(edges)
    if before[0] <= FEW_EDGES:
        return kept(edges.coalesce(1).mapInArrow(_joined, "node long, root long"), "roots")
    for _ in range(MAX_ROUNDS):
        edges = kept(_small_star(_large_star(edges)), "edges")
        after = mark(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
