"""The incremental load as a Structured Streaming job over a landing folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lendmark.sources import folded


def fold_batch(name: str, key: str, ts: str, buckets: int = folded.BUCKETS) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: fold a batch into the layer ``name``.

    A batch that is repeated after a failure gives the same layer, and a swap
    that the failure interrupted is finished first.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        folded.fold(batch, name, key, [ts], buckets)

    return run


def load_stream(
    spark: SparkSession,
    landing: str,
    name: str,
    checkpoint: str,
    schema: T.StructType,
    key: str,
    ts: str,
    files_per_batch: int = 1000,
    buckets: int = folded.BUCKETS,
) -> None:
    """Fold all landing files not seen yet into the layer ``name``, then stop.

    The checkpoint remembers the files, so a run without new files is a no-op. A
    layer keeps the number of buckets it began with.
    """
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(landing)
    query = (
        stream.writeStream.foreachBatch(fold_batch(name, key, ts, buckets))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
