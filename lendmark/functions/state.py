"""Small fitted state: moved to the driver only once its size is proven."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lendmark.session import scratch_dir

SETTLE_ROWS = 100_000


def kept(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: evaluated once, safe from lost executors."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def settled(df: DataFrame, max_rows: int | None = None) -> tuple[DataFrame, bool]:
    """Evaluate ``df``: as a local relation if it has at most ``max_rows`` rows, also returns whether it has.

    A local relation carries its exact size, so Catalyst broadcasts it by
    itself. No more than ``max_rows`` + 1 rows are asked for, so what moves is
    bounded. A larger result stays distributed: it is evaluated once more, into
    the scratch folder, from which all later uses read it.
    """
    max_rows = SETTLE_ROWS if max_rows is None else max_rows
    table = df.limit(max_rows + 1).toArrow()
    if table.num_rows > max_rows:
        return kept(df, "settled"), False
    return df.sparkSession.createDataFrame(table, schema=df.schema), True


def settle(df: DataFrame, max_rows: int | None = None) -> DataFrame:
    """The frame of ``settled``."""
    return settled(df, max_rows)[0]


def local_frame(spark: SparkSession, rows: list[tuple], schema: T.StructType | str) -> DataFrame:
    """A local relation from driver-side fitted state."""
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    columns = list(zip(*rows)) if rows else [() for _ in schema]
    table = pa.Table.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, arrow)], schema=arrow)
    return spark.createDataFrame(table, schema=schema)
