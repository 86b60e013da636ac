"""Named layers that batches are folded into, the newest row per key winning.

The layer is a table partitioned by a bucket of its key. A batch rewrites the
buckets it touches and no others: their next state is written as a table of its
own first, which the catalog knows only once it is complete, and then replaces
these partitions by a dynamic partition overwrite. The layer is never dropped. A
load that fails before its state is complete changes nothing; one that fails
later leaves the complete state, and the next load or ``recover`` finishes it.
Folding a batch again changes nothing. A layer takes one load at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lendmark.operators.history import latest

BUCKETS = 64  # about as many as a load should rewrite at most tasks; fixed when a layer is made
BUCKET = "__bucket"
SETTING = "lendmark.buckets"
STAGED = "__staged_"


@contextmanager
def _touched_partitions_only(spark: SparkSession) -> Iterator[None]:
    """Overwrites replace the partitions they write; a table insert takes this from the session alone."""
    name = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(name)
    spark.conf.set(name, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.hash(F.col(key)), F.lit(buckets)).alias(BUCKET)


def _write(df: DataFrame, name: str) -> None:
    """A table in buckets; a bucket's files come from as many tasks as its size asks for."""
    df.hint("rebalance", BUCKET).write.format("parquet").partitionBy(BUCKET).saveAsTable(name)


def _staged(spark: SparkSession, name: str) -> list[str]:
    """Complete states that a load has left. The catalog lists a table only once its rows are written."""
    prefix = name.rsplit(".", 1)
    found = spark.catalog.listTables(*prefix[:-1], pattern=f"{prefix[-1]}{STAGED}*")
    return [".".join([*prefix[:-1], t.name]) for t in found]


def _swap(spark: SparkSession, staged: str, name: str) -> None:
    """Replace the buckets of the layer that the staged state holds. Doing it twice gives the same."""
    with _touched_partitions_only(spark):
        spark.table(staged).select(*spark.table(name).columns).write.mode("overwrite").insertInto(name)
    spark.sql(f"DROP TABLE {staged}")


def recover(spark: SparkSession, name: str) -> int:
    """Finish loads that were interrupted while their state took its place; returns how many."""
    left = _staged(spark, name)
    for staged in left:
        _swap(spark, staged, name)
    return len(left)


def _widen(spark: SparkSession, name: str, batch: DataFrame) -> None:
    """Columns of the batch that the layer lacks are added to it; its older rows hold null there."""
    held = set(spark.table(name).columns)
    new = [f"`{f.name}` {f.dataType.simpleString()}" for f in batch.schema if f.name not in held]
    if new:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(new)})")


def fold(batch: DataFrame, name: str, key: str, order: Sequence[str], buckets: int = BUCKETS) -> None:
    """Fold ``batch`` into the layer ``name``, which is made if there is none.

    Of rows with equal keys the newest by ``order`` stays, the rest of the row
    being the tie-break, so neither the order nor the size of batches matters.
    Rows without a key are one key. A batch may lack columns of the layer (null)
    or bring new ones. ``buckets`` counts for a layer that is made now.
    """
    spark = batch.sparkSession
    if not spark.catalog.tableExists(name):
        _write(latest(batch, key, order).withColumn(BUCKET, _bucket(key, buckets)), name)
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES('{SETTING}'='{buckets}')")
        return
    recover(spark, name)
    spark.catalog.refreshTable(name)  # another session, such as a stream's, may have written it
    _widen(spark, name, batch)
    properties = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    bucket = _bucket(key, int(properties[SETTING]))
    fresh = latest(batch, key, order).withColumn(BUCKET, bucket).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        touched = [r[0] for r in fresh.select(BUCKET).distinct().collect()]  # at most as many as there are buckets
        if not touched:
            return
        before = spark.table(name).filter(F.col(BUCKET).isin(touched))  # reads the folders of these buckets
        both = before.unionByName(fresh, allowMissingColumns=True)
        staged = f"{name}{STAGED}{uuid.uuid4().hex[:12]}"
        _write(latest(both.drop(BUCKET), key, order).withColumn(BUCKET, bucket), staged)
    finally:
        fresh.unpersist()
    _swap(spark, staged, name)


def layer(spark: SparkSession, name: str) -> DataFrame:
    """The rows of a layer without the bucket, as they are now, whichever session has written them."""
    spark.catalog.refreshTable(name)
    return spark.table(name).drop(BUCKET)
