"""Reproducible samples by hash order. No shuffle of the sampled rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lendmark.functions.state import settle

RANGE_ROWS = 20_000  # rows of a hash range, of which one per stratum is sorted


def hash_order(key: str, seed: int = 42) -> Column:
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(f"#{seed}")))


def stratified_sample(df: DataFrame, strata: Sequence[str], fraction: float, key: str, seed: int = 42) -> DataFrame:
    """``round(fraction * n)`` rows of every stratum, without replacement.

    The rows with the smallest hash are taken. Hash ranges are counted per
    stratum first; only the range in which the quota runs out is sorted, and
    its last taken hash is the stratum's limit. Sampling itself is then a
    filter against one limit per stratum. ``key`` must be unique; rows with a
    null stratum belong to no stratum.
    """
    hashed = df.withColumn("__hash", hash_order(key, seed))
    df_rows = df.count()
    digits = 2  # of the hash; ranges grow finer with the table
    while df_rows > RANGE_ROWS * 16**digits:
        digits += 1
    spans = hashed.groupBy(*strata, F.substring("__hash", 1, digits).alias("__span")).agg(F.count("*").alias("__n"))
    by_stratum = W.partitionBy(*strata)
    upto = F.sum("__n").over(by_stratum.orderBy("__span"))
    quota = F.rint(F.lit(fraction) * F.sum("__n").over(by_stratum)).cast("long")
    last = settle(
        spans.select(*strata, "__span", "__n", upto.alias("__upto"), quota.alias("__quota"))
        .filter((F.col("__upto") >= F.col("__quota")) & (F.col("__upto") - F.col("__n") < F.col("__quota")))
        .select(*strata, "__span", (F.col("__quota") - F.col("__upto") + F.col("__n")).alias("__left"))
    )
    within = W.partitionBy(*strata).orderBy("__hash", key)
    limits = settle(
        hashed.select(*strata, "__hash", key)
        .withColumn("__span", F.substring("__hash", 1, digits))
        .join(last, [*strata, "__span"])
        .withColumn("__rank", F.row_number().over(within))
        .filter(F.col("__rank") == F.col("__left"))
        .select(*strata, F.struct(F.col("__hash"), F.col(key)).alias("__limit"))
    )
    return (
        hashed.join(limits, list(strata))
        .filter(F.struct(F.col("__hash"), F.col(key)) <= F.col("__limit"))
        .select(*df.columns)
    )


def bounded_sample(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """The ``n`` rows with the smallest hash: a per-task top-n, merged."""
    return df.orderBy(hash_order(key, seed), key).limit(n)

