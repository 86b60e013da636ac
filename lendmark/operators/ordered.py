"""Previous and next values along a key's timeline, safe for hot keys."""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lendmark.functions.state import settle
from lendmark.session import scratch_dir

SLICE = "__slice"
HOT_ROWS = 1_000_000


def slice_timelines(
    df: DataFrame, key: str, order: Sequence[str], hot_rows: int = HOT_ROWS
) -> tuple[DataFrame, bool]:
    """Add ``__slice``: 0 for ordinary keys, a slice of the timeline for keys with more than ``hot_rows`` rows.

    A window by key alone would sort all rows of a dominant key in one task.
    The rows of hot keys, null among them, are range-partitioned on the key and
    the whole order tuple, whatever its types; slices hold about ``hot_rows``
    rows and are numbered in order. They are written once, so every later use
    sees the same slices. Also returns whether any key was hot.
    """
    hot = settle(
        df.groupBy(key).agg(F.count("*").alias("__n")).filter(F.col("__n") > hot_rows)
    )  # at most rows / hot_rows keys
    total = hot.agg(F.sum("__n")).first()[0]
    if total is None:
        return df.withColumn(SLICE, F.lit(0)), False
    names = hot.select(F.col(key).alias("__key"))
    same = F.col(key).eqNullSafe(F.col("__key"))
    ranged = df.join(names, same, "left_semi").repartitionByRange(math.ceil(total / hot_rows), key, *order)
    path = f"{scratch_dir(df.sparkSession)}/slices-{uuid.uuid4().hex[:12]}"
    ranged.withColumn(SLICE, F.spark_partition_id() + 1).write.parquet(path)
    sliced = df.sparkSession.read.parquet(path).select(*df.columns, SLICE)
    ordinary = df.join(names, same, "left_anti").withColumn(SLICE, F.lit(0))
    return ordinary.unionByName(sliced), True


def neighbour(
    df: DataFrame, key: str, order: Sequence[str], value: Column, name: str, sliced: bool, following: bool = False
) -> DataFrame:
    """Add ``name``: ``value`` of the key's previous (or next) row as a struct ``(v)``, null at the ends.

    Expects the ``__slice`` column. The value at a slice border comes from a
    table with one row per (hot key, slice).
    """
    sort = [F.col(c).desc() if following else F.col(c).asc() for c in order]
    boxed = F.struct(value.alias("v"))
    within = W.partitionBy(key, SLICE).orderBy(*sort)
    if not sliced:
        return df.withColumn(name, F.lag(boxed).over(within))
    pick = F.min_by if following else F.max_by
    across = W.partitionBy(key).orderBy(F.col(SLICE).desc() if following else F.col(SLICE).asc())
    borders = (
        df.filter(F.col(SLICE) > 0)
        .groupBy(key, SLICE)
        .agg(pick(boxed, F.struct(*order)).alias("__edge"))
        .select(key, SLICE, F.lag("__edge").over(across).alias("__carried"))
    )
    borders = borders.select(F.col(key).alias("__key"), F.col(SLICE).alias("__at"), "__carried")
    return (
        df.withColumn("__near", F.lag(boxed).over(within))
        .join(borders, F.col(key).eqNullSafe(F.col("__key")) & (F.col(SLICE) == F.col("__at")), "left")
        .withColumn(name, F.coalesce("__near", "__carried"))
        .drop("__near", "__carried", "__key", "__at")
    )
