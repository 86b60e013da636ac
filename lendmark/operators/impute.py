"""Median and mode imputation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendmark.operators.quantiles import exact_quantiles, present


@dataclass(frozen=True)
class Imputers:
    medians: dict[str, float | None] = field(default_factory=dict)
    modes: dict[str, str] = field(default_factory=dict)


def fit_medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """Exact medians (mean of the middle two), nulls skipped; absent columns ignored."""
    cols = [c for c in columns if c in df.columns]
    raw = exact_quantiles(df, {c: [0.5] for c in cols}) if cols else {}
    return {c: (q[0] if q else None) for c, q in raw.items()}


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, value, n) of several text columns, nulls skipped, in one pass."""
    pairs = F.array(*(F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in columns))
    return (
        df.select(F.inline(pairs)).filter("value IS NOT NULL").groupBy("feature", "value").agg(F.count("*").alias("n"))
    )


def fit_modes(df: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    """Most frequent value; the smallest on ties; ``MISSING`` for an all-null column.

    Counts per value are combined before the shuffle, and the winner is a
    minimum over (-count, value): no task holds a column's value table.
    """
    cols = [c for c in columns if c in df.columns]
    if not cols:
        return {}
    best = (
        value_counts(df, cols)
        .groupBy("feature")
        .agg(F.min(F.struct((-F.col("n")).alias("rank"), F.col("value"))).alias("best"))
        .select("feature", "best.value")
        .collect()
    )
    winners = {row["feature"]: row["value"] for row in best}
    return {c: winners.get(c, "MISSING") for c in cols}


def fit_imputers(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> Imputers:
    return Imputers(fit_medians(df, numeric), fit_modes(df, categorical))


def impute(df: DataFrame, state: Imputers) -> DataFrame:
    """Fill missing values (null, and NaN in numeric columns); absent columns are ignored."""
    filled = {
        c: F.coalesce(present(F.col(c)), F.lit(m)) for c, m in state.medians.items() if c in df.columns and m is not None
    }
    filled |= {c: F.coalesce(F.col(c), F.lit(m)) for c, m in state.modes.items() if c in df.columns}
    return df.withColumns(filled) if filled else df
