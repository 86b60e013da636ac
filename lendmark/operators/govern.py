"""Retraining trigger, promotion gate and the run log."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lendmark.functions.state import local_frame

RUN_SCHEMA = "run_name string, kind string, key string, value string"


def retrain_decision(totals: DataFrame, threshold: float = 0.25, force: bool = False) -> DataFrame:
    """(epoch, psi, ...) rows with ``retrain``: drift reached the threshold, or it is forced."""
    return totals.withColumn("retrain", F.coalesce(F.col("psi") >= threshold, F.lit(False)) | F.lit(force))


def oot_decision(ks_table: DataFrame, threshold: float = 0.20) -> DataFrame:
    """Out-of-time gate: (ks, threshold, decision)."""
    passed = F.coalesce(F.col("ks") >= threshold, F.lit(False))
    return ks_table.select(
        "ks", F.lit(threshold).alias("threshold"), F.when(passed, "PROMOTE").otherwise("REJECT").alias("decision")
    )


def run_rows(
    spark: SparkSession,
    run: str,
    params: Mapping[str, object] = {},
    metrics: Mapping[str, float] = {},
    tags: Mapping[str, str] = {},
) -> DataFrame:
    rows = [
        (run, kind, key, str(value))
        for kind, group in (("param", params), ("metric", metrics), ("tag", tags))
        for key, value in group.items()
    ]
    return local_frame(spark, rows, RUN_SCHEMA).withColumn("logged_at", F.current_timestamp())


def log_run(
    spark: SparkSession,
    path: str,
    run: str,
    params: Mapping[str, object] = {},
    metrics: Mapping[str, float] = {},
    tags: Mapping[str, str] = {},
) -> None:
    """Append one run to the log dataset."""
    run_rows(spark, run, params, metrics, tags).coalesce(1).write.mode("append").parquet(path)


def logged_write(
    df: DataFrame,
    write: Callable[[DataFrame], None],
    path: str,
    run: str,
    observed: Mapping[str, Column] = {},
    params: Mapping[str, object] = {},
    tags: Mapping[str, str] = {},
) -> dict[str, object]:
    """Write ``df`` by ``write`` and append a run to the log at ``path``: its rows, its seconds and ``observed``.

    The aggregates are collected while the rows pass through the write, which
    costs no further job. ``write`` is to run exactly one job over the rows it is
    given. A write that fails logs nothing. Returns what was observed.
    """
    seen = Observation()
    counts = [F.count(F.lit(1)).alias("rows"), *(c.alias(name) for name, c in observed.items())]
    start = time.monotonic()
    write(df.observe(seen, *counts))
    seconds = time.monotonic() - start
    found = dict(seen.get)
    log_run(df.sparkSession, path, run, params, found | {"seconds": round(seconds, 3)}, tags)
    return found


def runs(spark: SparkSession, path: str) -> DataFrame:
    """The log, one row per logged value."""
    return spark.read.schema(f"{RUN_SCHEMA}, logged_at timestamp").parquet(path)
