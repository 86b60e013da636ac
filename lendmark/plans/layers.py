"""Bronze, staging, silver and gold layers of the loan table, as plan functions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendmark.functions.expr import (
    bad_flag,
    clip,
    epoch_label,
    event_flag,
    fico_midpoint,
    installment_to_income,
    is_resolved,
    issue_year,
    pct_to_double,
    to_number,
)
from lendmark.operators.history import latest
from lendmark.sources.schema import LOAN_COLUMNS, LOAN_SCHEMA, PERCENT_COLUMNS

# Replacements for missing values in the staging and gold layers.
STAGING_DEFAULTS = {
    "emp_length": "Unknown",
    "home_ownership": "OTHER",
    "delinq_2yrs": 0.0,
    "inq_last_6mths": 0.0,
    "open_acc": 0.0,
    "pub_rec": 0.0,
    "revol_bal": 0.0,
    "revol_util": 0.0,
    "total_acc": 0.0,
    "mort_acc": 0.0,
    "pub_rec_bankruptcies": 0.0,
}
# Attributes whose change opens a new version of a borrower.
SCD2_CHECK = ("grade", "sub_grade", "home_ownership", "annual_inc", "verification_status")

INGEST_TIME = "bronze_ingest_time"

# Year ranges of the published batches.
EPOCH_RANGES = {"baseline": (2013, 2015), "inference": (2016, 2016), "drift": (2017, 2018)}


def require(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.dropna(subset=list(columns))


def bronze(df: DataFrame, batch: str) -> DataFrame:
    """Raw rows with their ingest time and batch label."""
    return df.withColumns({INGEST_TIME: F.current_timestamp(), "source_batch": F.lit(batch)})


def write_bronze(df: DataFrame, path: str) -> None:
    """Replace the bronze dataset, a folder per issue year (no shuffle before the write)."""
    df.write.mode("overwrite").partitionBy("issue_year").parquet(path)


def append_bronze(df: DataFrame, path: str) -> None:
    """Ingest one batch into a bronze dataset with a folder per batch and issue year.

    Batches may have different columns, see ``read_bronze``. A batch that is
    ingested again replaces its own folders and no others.
    """
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("source_batch", "issue_year").parquet(path)


def read_bronze(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """All batches of a bronze dataset with the columns of any of them; null where a batch lacks one.

    The columns come from the footers of all files, which a distributed job reads;
    pass ``schema`` to skip that. A column that has two types that don't widen
    into each other is an error.
    """
    return spark.read.schema(schema).parquet(path) if schema else spark.read.option("mergeSchema", True).parquet(path)


def typed(df: DataFrame) -> DataFrame:
    """The 27 columns in their types, and the ingest time of a bronze row; ``id`` is accepted as key.

    Malformed text becomes null.
    """
    key = "loan_id" if "loan_id" in df.columns else "id"
    columns = []
    for f in LOAN_SCHEMA:
        source = F.col(key if f.name == "loan_id" else f.name)
        kind = f.dataType.simpleString()
        if f.name in PERCENT_COLUMNS:
            value = pct_to_double(source)
        elif kind == "string":
            value = source.cast("string")
        else:
            value = to_number(source, kind)
        columns.append(value.alias(f.name))
    return df.select(*columns, *(F.col(c) for c in df.columns if c == INGEST_TIME))


def with_defaults(df: DataFrame, defaults: Mapping[str, object] = STAGING_DEFAULTS) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items() if c in df.columns})


def resolved(df: DataFrame, policy: str = "package") -> DataFrame:
    return df.filter(is_resolved(F.col("loan_status"), policy))


def with_target(df: DataFrame, policy: str = "package") -> DataFrame:
    return df.withColumn("target", bad_flag(F.col("loan_status"), policy))


def with_issue_year(df: DataFrame) -> DataFrame:
    return df.withColumn("issue_year", issue_year(F.col("issue_d")))


def staging(raw: DataFrame, policy: str = "curated") -> DataFrame:
    """Typed, resolved loans with defaults, year and target. A view: Catalyst inlines it."""
    rows = require(typed(raw), ("loan_id", "loan_status", "issue_d"))
    return with_target(with_issue_year(with_defaults(resolved(rows, policy))), policy)


def silver(staged: DataFrame, ingest_time: str | None = None) -> DataFrame:
    """One row per loan: the newest by ingest time, all columns breaking ties.

    The ingest time is that of the bronze layer unless another column is named.
    Rows that never had one are ordered by their year.
    """
    known = ingest_time or (INGEST_TIME if INGEST_TIME in staged.columns else "issue_year")
    return latest(staged, "loan_id", [known])


def gold_domain(df: DataFrame) -> DataFrame:
    return df.filter(
        (F.col("annual_inc") > 0)
        & (F.col("dti") >= 0)
        & F.col("fico_range_low").isNotNull()
        & F.col("fico_range_high").isNotNull()
    )


def gold(silver_loans: DataFrame) -> DataFrame:
    """Modelling features of the loans inside the valid domain, one projection."""
    # Names and order of the output columns.
    return gold_domain(silver_loans).select(
        "loan_id",
        "target",
        "issue_year",
        "issue_d",
        fico_midpoint(F.col("fico_range_low"), F.col("fico_range_high")).alias("fico_mid"),
        clip(F.col("dti"), high=100.0).alias("dti"),
        "loan_amnt",
        "annual_inc",
        installment_to_income(F.col("installment"), F.col("annual_inc"), "fraction").alias("installment_to_inc"),
        "revol_bal",
        clip(F.col("revol_util"), 0.0, 100.0).alias("revol_util"),
        *(F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in ("inq_last_6mths", "open_acc", "total_acc", "mort_acc")),
        event_flag(F.col("delinq_2yrs")).alias("has_delinq"),
        event_flag(F.col("pub_rec")).alias("has_pub_rec"),
        event_flag(F.col("pub_rec_bankruptcies")).alias("has_bankruptcy"),
        "home_ownership",
        "purpose",
        "emp_length",
        "verification_status",
    )


def stamped(df: DataFrame, column: str) -> DataFrame:
    """Add the audit time of a layer."""
    return df.withColumn(column, F.current_timestamp())


def preprocess(loans: DataFrame, policy: str = "package", first_year: int = 2013) -> DataFrame:
    """Resolved loans with target and year, from ``first_year`` on."""
    rows = require(loans, ("loan_status", "issue_d"))
    return with_issue_year(with_target(resolved(rows, policy), policy)).filter(F.col("issue_year") >= first_year)


def with_epoch(df: DataFrame, ranges: Mapping[str, tuple[int, int]] = EPOCH_RANGES) -> DataFrame:
    return df.withColumn("epoch", epoch_label(F.col("issue_year"), ranges))


def window_of(df: DataFrame, first_year: int, last_year: int) -> DataFrame:
    """Rolling training window: one scan with a year range, not a union of batches."""
    return df.filter(F.col("issue_year").between(first_year, last_year))


def derive(df: DataFrame) -> DataFrame:
    """Modelling ratios of imputed loans; each one only where its inputs exist."""
    have = set(df.columns)
    added = {}
    if "fico_range_low" in have:
        high = F.col("fico_range_high") if "fico_range_high" in have else None
        added["fico_mid"] = fico_midpoint(F.col("fico_range_low"), high)
    if {"installment", "annual_inc"} <= have:
        added["installment_to_inc"] = installment_to_income(F.col("installment"), F.col("annual_inc"))
    if "revol_util" in have:
        added["revol_util"] = clip(F.col("revol_util"), 0.0, 100.0)
    if "delinq_2yrs" in have:
        added["has_delinq"] = event_flag(F.col("delinq_2yrs"))
    return df.withColumns(added) if added else df


__all__ = [
    "EPOCH_RANGES", "LOAN_COLUMNS", "SCD2_CHECK", "STAGING_DEFAULTS", "bronze", "derive", "gold", "gold_domain",
    "preprocess", "require", "resolved", "silver", "staging", "stamped", "typed", "window_of", "with_defaults",
    "with_epoch", "with_issue_year", "with_target", "write_bronze",
]
