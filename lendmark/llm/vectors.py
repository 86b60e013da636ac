"""Vectors dealt into shards of bounded size, and queries into blocks, each packed into one row.

A search meets every block with every shard: the stated query set against all
rows, in blocks. A task keeps the best of each query over its shards, so what
leaves it doesn't grow with them. Blocks are copied once for each task, not for
each shard, and shards once for every ``HELD_BLOCKS`` blocks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHARD_ROWS = 16_384
BLOCK_ROWS = 1_024
HELD_BLOCKS = 64
TASK_SHARDS = 16
FILE_SHARDS, FILE_BLOCKS = 1, 16

PACKED = "part int, ids binary, vectors binary"


def usable(embeddings: DataFrame, id_column: str, vector_column: str, keep: Callable[[Column], Column]) -> DataFrame:
    """``id, vector`` (doubles) of rows that take part.

    Left out are null ids and vectors, null or non-finite components, what
    ``keep`` excludes, and vectors of another length than most (of equally
    frequent lengths the larger one counts).
    """
    rows = embeddings.select(
        F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{vector_column}`").cast("array<double>").alias("vector")
    )
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.filter(F.col("id").isNotNull() & F.col("vector").isNotNull() & ~bad & keep(F.col("vector")))
    sizes = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.filter(F.size("vector") == (sizes["d"] if sizes else 0))


def matrix(column: pa.Array) -> np.ndarray:
    """Vectors of a batch as rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 0))


def packed(rows: DataFrame, size: int, finish: Callable[[np.ndarray, np.ndarray], dict[str, bytes]] | None = None,
           extra: str = "") -> DataFrame:
    """``part, ids, vectors`` and what ``finish`` adds: about ``size`` rows in each part, dealt by a hash of id and vector.

    Equal rows count once, and before they are dealt; an id with many vectors is
    spread over the parts. Rows of a part are in order of their ids.
    """
    parts = max(1, -(-rows.count() // size))

    def pack(table: pa.Table) -> pa.Table:
        ids, vectors = table["id"].to_numpy(), matrix(table["vector"])
        keys = np.ascontiguousarray(np.column_stack([ids.view(np.float64), vectors]))
        _, first = np.unique(keys.view(f"V{keys.shape[1] * 8}").ravel(), return_index=True)
        first = first[np.argsort(ids[first], kind="stable")]
        ids, vectors = np.ascontiguousarray(ids[first]), np.ascontiguousarray(vectors[first])
        columns = {"part": pa.array([table["part"][0].as_py()], pa.int32())}
        values = {"ids": ids.tobytes(), "vectors": vectors.tobytes()} | (finish(ids, vectors) if finish else {})
        return pa.table(columns | {k: pa.array([v], pa.binary()) for k, v in values.items()})

    dealt = rows.distinct().withColumn("part", F.pmod(F.xxhash64("id", "vector"), F.lit(parts)).cast("int"))
    return dealt.groupBy("part").applyInArrow(pack, PACKED + extra)


def _parts(packed_rows: DataFrame) -> int:
    last = packed_rows.agg(F.max("part")).first()[0]
    return 0 if last is None else last + 1


def meeting(shards: DataFrame, blocks: DataFrame) -> DataFrame:
    """Rows of both for tasks in which every query block meets every shard; columns of blocks get the prefix ``q_``.

    A partition is one task: up to ``HELD_BLOCKS`` blocks come first, then up to ``TASK_SHARDS`` shards, fewer
    if there are cores for more tasks. There is no join: copies of the blocks are many times what the planner
    takes them for, so it would gather them on the driver for a broadcast.
    """
    n_shards, n_blocks = _parts(shards), _parts(blocks)
    rounds = max(1, -(-n_blocks // HELD_BLOCKS))
    wanted = -(-3 * shards.sparkSession.sparkContext.defaultParallelism // rounds)
    runs = max(1, min(n_shards, max(wanted, -(-n_shards // TASK_SHARDS))))
    asked = blocks.select(
        *(F.col(c).alias(f"q_{c}") for c in blocks.columns),
        F.explode(F.sequence(F.lit(0), F.lit(runs - 1))).alias("run"),
        (F.col("part") % rounds).alias("round"),
    )
    held = shards.select(
        "*", (F.col("part") % runs).alias("run"), F.explode(F.sequence(F.lit(0), F.lit(rounds - 1))).alias("round")
    )
    dealt = asked.unionByName(held, allowMissingColumns=True).withColumn("task", F.col("round") * runs + F.col("run"))
    dealt = dealt.drop("round", "run").repartitionById(rounds * runs, "task")
    return dealt.drop("task").sortWithinPartitions(F.asc_nulls_last("q_part"), "part")


def _sorted_best(values: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """In order of the ids of each row; of an id all but the smallest value become infinite."""
    order = np.lexsort((values, ids), axis=1)
    values, ids = np.take_along_axis(values, order, 1), np.take_along_axis(ids, order, 1)
    again = np.zeros(ids.shape, dtype=bool)
    again[:, 1:] = ids[:, 1:] == ids[:, :-1]
    return np.where(again, np.inf, values), ids


def _best_of_each(values: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each id by its smallest value only. ``ids`` are shared by the rows (one row of them), or per row."""
    if len(ids) > 1:
        return _sorted_best(values, ids)
    distinct = np.unique(ids[0])
    if len(distinct) < ids.shape[1]:
        order = np.argsort(ids[0], kind="stable")
        values = np.minimum.reduceat(values[:, order], np.searchsorted(ids[0][order], distinct), axis=1)
        ids = distinct[None, :]
    return values, np.broadcast_to(ids, values.shape)


class Best:
    """The k best ids of each query of a block so far: smallest value first, ties to the smaller id."""

    def __init__(self, queries: np.ndarray, k: int):
        self.queries = queries
        self.values = np.full((len(queries), k), np.inf)
        self.ids = np.full((len(queries), k), np.iinfo(np.int64).max)

    @property
    def limit(self) -> np.ndarray:
        return self.values[:, -1]

    def take(self, rows: np.ndarray, values: np.ndarray, ids: np.ndarray) -> None:
        """Offer candidates ``ids`` (shared or per row) with their values to some queries; own rows are left out."""
        values, ids = _best_of_each(values, ids)
        values = np.where(ids == self.queries[rows][:, None], np.inf, values)
        better = (values <= self.limit[rows][:, None]) & (values < np.inf)
        hit = np.flatnonzero(better.any(axis=1))
        if not len(hit):
            return
        k = self.values.shape[1]
        some = rows[hit]
        if values.shape[1] > 4 * k:
            # those that can't be among the k best by value go first; all ties of the k-th stay
            kth = np.partition(values[hit], k - 1, axis=1)[:, k - 1]
            width = int((values[hit] <= kth[:, None]).sum(axis=1).max())
            near = np.argsort(values[hit], axis=1, kind="stable")[:, :width]
            v, i = np.take_along_axis(values[hit], near, 1), np.take_along_axis(ids[hit], near, 1)
        else:
            v, i = values[hit], ids[hit]
        v, i = np.concatenate([self.values[some], v], axis=1), np.concatenate([self.ids[some], i], axis=1)
        v, i = _sorted_best(v, i)
        order = np.lexsort((i, v), axis=1)[:, :k]
        v, i = np.take_along_axis(v, order, 1), np.take_along_axis(i, order, 1)
        self.values[some], self.ids[some] = v, i

    def found(self) -> pa.RecordBatch:
        row, place = np.nonzero(self.values < np.inf)
        return pa.RecordBatch.from_arrays(
            [pa.array(self.queries[row]), pa.array(self.ids[row, place]), pa.array(self.values[row, place])],
            ["query_id", "vec_id", "value"],
        )


FOUND = "query_id long, vec_id long, value double"


def searched(dealt: DataFrame, k: int, search: Callable[[dict, Best], None]) -> DataFrame:
    """``query_id, vec_id, value`` of each task's best for the shards and blocks that ``meeting`` dealt it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[dict, Best]] = []
        for batch in batches:
            for k_row in range(batch.num_rows):
                row = {name: batch.column(name)[k_row].as_py() for name in batch.schema.names}
                block = {name: value for name, value in row.items() if name.startswith("q_")}
                if row["q_part"] is not None:
                    held.append((block, Best(np.frombuffer(row["q_ids"], np.int64), k)))
                    continue
                for block, best in held:
                    search(row | block, best)
        for _, best in held:
            yield best.found()

    return dealt.mapInArrow(run, FOUND)


def ranked(found: DataFrame, k: int) -> DataFrame:
    """``query_id, rank, vec_id, value``: the k smallest values of each query, ties to the smaller id."""
    best = found.groupBy("query_id", "vec_id").agg(F.min("value").alias("value"))
    order = Window.partitionBy("query_id").orderBy("value", "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
