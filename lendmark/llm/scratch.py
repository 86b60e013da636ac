"""Intermediates written to the shared folder, so that a lost executor never loses them."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from lendmark.session import scratch_dir


def kept(df: DataFrame, label: str, rows_per_file: int = 0) -> DataFrame:
    """Write ``df`` as Parquet under ``spark.checkpoint.dir`` and read it back: evaluated once, lineage cut.

    A Parquet page has 100 rows at least, if the file has; rows of megabytes need files of few rows.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"
    writer = df.write.option("maxRecordsPerFile", rows_per_file) if rows_per_file else df.write
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
