"""Readers and writers of the loan files."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendmark.sources import folded


def scan_epochs(spark: SparkSession, path: str, epoch: str | Iterable[str] | None = None) -> DataFrame:
    """Read the epoch-partitioned loan dataset; the epoch filter prunes folders."""
    df = spark.read.parquet(path)
    if epoch is None:
        return df
    names = [epoch] if isinstance(epoch, str) else list(epoch)
    return df.filter(F.col("epoch").isin(*names))


def scan_csv(
    spark: SparkSession,
    path: str,
    file_schema: T.StructType,
    columns: Iterable[str] | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Read CSV or CSV.GZ with an explicit schema, keep ``columns``, name the key ``loan_id``.

    Header names decide the column positions only if they agree with the
    schema. A gzip file is one partition whatever its size: pass ``partitions``
    to spread its rows over the cluster right after the read.
    """
    df = spark.read.schema(file_schema).csv(path, header=True, enforceSchema=False)
    if columns is not None:
        keep = set(columns)
        df = df.select(*(c for c in df.columns if c in keep))
    if "id" in df.columns and "loan_id" not in df.columns:
        df = df.withColumnRenamed("id", "loan_id")
    return df.repartition(partitions) if partitions else df


def write_epochs(df: DataFrame, path: str, max_records_per_file: int = 5_000_000) -> None:
    """One dataset with a folder per epoch. Tasks write their own rows per
    epoch (no shuffle), and large epochs are split by row count, so a dominant
    epoch never becomes one task or one file. Rows outside all epochs are not
    written; ``outside_epochs`` counts them."""
    (
        df.filter(F.col("epoch").isNotNull())
        .write.mode("overwrite")
        .option("maxRecordsPerFile", max_records_per_file)
        .partitionBy("epoch")
        .parquet(path)
    )


def outside_epochs(df: DataFrame) -> int:
    """Rows that ``write_epochs`` leaves out."""
    return df.filter(F.col("epoch").isNull()).count()


def write_points(points: DataFrame, path: str) -> None:
    """The points table as CSV (at most features x bins rows, hence one file)."""
    points.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_notices(notices: DataFrame, path: str) -> None:
    """All notices as JSON lines."""
    notices.write.mode("overwrite").json(path)


def materialize(
    df: DataFrame, name: str, mode: str = "view", key: str | None = None, order: Sequence[str] = ()
) -> DataFrame:
    """A named layer.

    ``view``: temp view, inlined by Catalyst. ``table``: managed table,
    replaced. ``incremental``: rows are folded into the table on ``key``, the
    newest by ``order`` winning; see ``sources.folded``.
    """
    if mode == "view":
        df.createOrReplaceTempView(name)
    elif mode == "table":
        df.write.mode("overwrite").format("parquet").saveAsTable(name)
    elif mode == "incremental":
        if key is None:
            raise ValueError("an incremental layer needs a key")
        folded.fold(df, name, key, order)
        return folded.layer(df.sparkSession, name)
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return df.sparkSession.table(name)
