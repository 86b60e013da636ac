"""Variance inflation from one distributed pass over the data.

The correlation matrix is a sufficient statistic: every auxiliary regression
and every elimination round is linear algebra on a features x features matrix.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.errors import IllegalArgumentException
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendmark.functions.scale import condition_band
from lendmark.functions.state import local_frame
from lendmark.operators.quantiles import present


@dataclass(frozen=True)
class Correlations:
    features: list[str]
    matrix: np.ndarray

    def without(self, feature: str) -> Correlations:
        keep = [i for i, f in enumerate(self.features) if f != feature]
        return Correlations([self.features[i] for i in keep], self.matrix[np.ix_(keep, keep)])


def correlations(df: DataFrame, features: Sequence[str]) -> Correlations:
    """Pairwise correlations over the rows that have all features.

    Spark ML sums features x features blocks per task and combines them in a
    tree, so only one small matrix reaches the driver.
    """
    features = list(features)
    complete = df.select(*(present(F.col(f)).alias(f) for f in features)).dropna()
    vectors = VectorAssembler(inputCols=features, outputCol="__x").transform(complete).select("__x")
    try:
        matrix = Correlation.corr(vectors, "__x").first()[0].toArray()
    except IllegalArgumentException:  # fewer than two complete rows
        matrix = np.full((len(features), len(features)), math.nan)
    return Correlations(features, matrix)


def inflation(corr: Correlations) -> dict[str, float]:
    """1 / (1 - R^2) of each feature on the others; ``inf`` when it is an exact
    combination of them, NaN when it (or the data) has no variance."""
    out = {}
    for j, feature in enumerate(corr.features):
        rest = [i for i in range(len(corr.features)) if i != j and not np.isnan(corr.matrix[i, j])]
        if len(corr.features) > 1 and not rest:
            out[feature] = math.nan
            continue
        r = corr.matrix[rest, j]
        left = 1.0 - float(r @ np.linalg.lstsq(corr.matrix[np.ix_(rest, rest)], r, rcond=1e-12)[0]) if rest else 1.0
        out[feature] = 1.0 / left if left > 1e-12 else math.inf
    return out


def _vif_frame(spark: SparkSession, vifs: dict[str, float]) -> DataFrame:
    rows = [(f, None if math.isnan(v) else round(v, 2)) for f, v in vifs.items()]
    return local_frame(spark, rows, "feature string, vif double").orderBy(F.desc("vif"), "feature")


def vif(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, vif rounded to 2), largest first."""
    return _vif_frame(df.sparkSession, inflation(correlations(df, features)))


@dataclass(frozen=True)
class Screen:
    kept: list[str]
    dropped: list[tuple[str, float]]
    final: dict[str, float]

    def frame(self, spark: SparkSession) -> DataFrame:
        """(feature, vif, decision, step): dropped features carry the VIF they had when dropped."""
        rows = [(f, v, "dropped", step) for step, (f, v) in enumerate(self.dropped, 1)]
        rows += [(f, round(self.final[f], 2), "kept", 0) for f in self.kept]
        return local_frame(spark, rows, "feature string, vif double, decision string, step int")


def vif_filter(df: DataFrame, features: Sequence[str], threshold: float = 10.0) -> Screen:
    """Drop the worst feature while its rounded VIF reaches ``threshold`` and more than two remain.

    Rounds work on sub-matrices. The data is read again only after a feature
    with nulls was dropped, since the set of complete rows then changes.
    """
    corr = correlations(df, features)
    dropped = []
    while True:
        vifs = inflation(corr)
        rated = [(round(v, 2), f) for f, v in vifs.items() if not math.isnan(v)]
        worst = max((v for v, _ in rated), default=0.0)
        if worst < threshold or len(corr.features) <= 2:
            return Screen(list(corr.features), dropped, vifs)
        feature = next(f for v, f in rated if v == worst)
        dropped.append((feature, worst))
        rest = [f for f in corr.features if f != feature]
        no_gaps = df.filter(present(F.col(feature)).isNull()).isEmpty()
        corr = corr.without(feature) if no_gaps else correlations(df, rest)


def vif_oneshot(df: DataFrame, features: Sequence[str], threshold: float = 10.0) -> DataFrame:
    """Features below the threshold in a single table."""
    return vif(df, features).filter(F.col("vif") < threshold)


def condition_number(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Ratio of the extreme eigenvalues of the correlation matrix, with its band."""
    values = np.linalg.eigvalsh(correlations(df, features).matrix)
    kappa = float(values[-1] / values[0]) if values[0] > 1e-12 else math.inf
    frame = local_frame(df.sparkSession, [(len(features), kappa)], "features int, kappa double")
    return frame.withColumn("band", condition_band(F.col("kappa")))
