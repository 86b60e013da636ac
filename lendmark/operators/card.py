"""The logistic scorecard: fit, probabilities, scores and points."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lendmark.functions.scale import Pdo, pd_from_logit, score_from_logit
from lendmark.functions.state import local_frame
from lendmark.operators.tally import Tally
from lendmark.operators.woe import WoeModel, map_bins


@dataclass(frozen=True)
class Card:
    """Intercept and one coefficient per ``<feature>_woe`` column, and the training
    means of those columns when the card was fitted."""

    intercept: float
    coefs: dict[str, float]
    pdo: Pdo = field(default_factory=Pdo)
    means: dict[str, float] = field(default_factory=dict)

    @property
    def features(self) -> list[str]:
        return [c.removesuffix("_woe") for c in self.coefs]

    def logit(self) -> Column:
        return F.expr(" + ".join([f"{self.intercept!r}D", *(f"({b!r}D * `{c}`)" for c, b in self.coefs.items())]))


def class_sizes(df: DataFrame, target: str = "target") -> dict[int, int]:
    return {row[0]: row[1] for row in df.groupBy(target).count().collect() if row[0] is not None}


def with_weights(df: DataFrame, target: str = "target", sizes: Mapping[int, int] | None = None) -> DataFrame:
    """Add ``class_weight`` = n / (2 * size of the row's class)."""
    sizes = sizes or class_sizes(df, target)
    n = sum(sizes.values())
    weight = F.lit(None).cast("double")
    for label, size in sizes.items():
        weight = F.when(F.col(target) == label, n / (2.0 * size)).otherwise(weight)
    return df.withColumn("class_weight", weight)


def fit_card(
    df: DataFrame, columns: Sequence[str], target: str = "target", c: float = 1.0, pdo: Pdo = Pdo(), max_iter: int = 1000
) -> Card:
    """L2-regularised logistic fit with balanced classes and a free intercept.

    Rows with equal (WoE, target) values are merged into one weighted row
    first. WoE columns take few distinct values, so these cells are usually few
    (at most ``SETTLE_ROWS``) and the minimum is found on them by Newton steps.
    More cells stay distributed, and Spark ML iterates over them.
    """
    cells = Tally.of(df.groupBy(*columns, target).agg(F.count("*").alias("__n")))
    if cells.small:
        table = cells.rows.toArrow()
        n = table["__n"].to_numpy()
        y = np.array([math.nan if v is None else v for v in table[target].to_pylist()], dtype=float)
        x = np.column_stack([np.ones(len(n)), *(table[c].to_numpy() for c in columns)])
        means = dict(zip(columns, map(float, n @ x[:, 1:] / max(n.sum(), 1))))
        if set(y[~np.isnan(y)]) == {0.0, 1.0}:
            beta = _newton(x[~np.isnan(y)], y[~np.isnan(y)], n[~np.isnan(y)], c, max_iter)
            return Card(float(beta[0]), dict(zip(columns, map(float, beta[1:]))), pdo, means)
    else:
        sums = cells.rows.agg(F.sum("__n"), *(F.sum(F.col("__n") * F.col(x)) for x in columns)).first()
        means = {x: s / sums[0] for x, s in zip(columns, sums[1:])}
    sizes = {r[0]: r[1] for r in cells.rows.groupBy(target).agg(F.sum("__n")).collect() if r[0] is not None}
    weighted = with_weights(cells.rows, target, sizes).filter(F.col(target).isNotNull())
    vectors = VectorAssembler(inputCols=list(columns), outputCol="__x").transform(
        weighted.withColumn("__w", F.col("class_weight") * F.col("__n"))
    )
    model = LogisticRegression(
        featuresCol="__x",
        labelCol=target,
        weightCol="__w",
        regParam=1.0 / (c * sum(sizes.values())),  # the balanced weights add up to the number of rows
        elasticNetParam=0.0,
        standardization=False,
        maxIter=max_iter,
        tol=1e-10,
    ).fit(vectors.select("__x", F.col(target).cast("double").alias(target), "__w"))
    return Card(float(model.intercept), dict(zip(columns, map(float, model.coefficients.toArray()))), pdo, means)


def _newton(x: np.ndarray, y: np.ndarray, n: np.ndarray, c: float, max_iter: int) -> np.ndarray:
    """Minimum of the balanced log-loss plus |coefficients|^2 / 2c; ``x`` begins with ones, rows count ``n`` times.

    The function is convex, and a step that doesn't lower it is halved.
    """
    w = n * n.sum() / (2.0 * np.where(y == 1, n[y == 1].sum(), n[y == 0].sum()))
    penalty = np.r_[0.0, np.full(x.shape[1] - 1, 1.0 / c)]

    def loss(b: np.ndarray) -> float:
        z = x @ b
        return float(w @ (np.logaddexp(0.0, z) - y * z) + 0.5 * penalty @ (b * b))

    beta = np.zeros(x.shape[1])
    for _ in range(max_iter):
        p = 1.0 / (1.0 + np.exp(-(x @ beta)))
        gradient = x.T @ (w * (p - y)) + penalty * beta
        hessian = (x * (w * p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(hessian, gradient)
        now = loss(beta)
        while loss(beta - step) > now and np.abs(step).max() > 1e-14:
            step = step / 2
        beta = beta - step
        if np.abs(step).max() < 1e-12 * max(1.0, np.abs(beta).max()):
            break
    return beta


def coefficients(spark: SparkSession, card: Card) -> DataFrame:
    """(position, feature, coefficient, odds_ratio), intercept first."""
    rows = [(0, "Intercept", card.intercept, math.exp(card.intercept))]
    rows += [(i, f, b, math.exp(b)) for i, (f, b) in enumerate(card.coefs.items(), 1)]
    return local_frame(spark, rows, "position int, feature string, coefficient double, odds_ratio double")


def with_pd(df: DataFrame, card: Card) -> DataFrame:
    """Add ``pd``, the probability of a bad outcome."""
    return df.withColumn("pd", pd_from_logit(card.logit()))


def with_score(df: DataFrame, card: Card) -> DataFrame:
    """Add ``score``, an integer in 300..850."""
    return df.withColumn("score", score_from_logit(card.logit(), card.pdo))


def scored(df: DataFrame, card: Card) -> DataFrame:
    return with_score(with_pd(df, card), card)


def points(bins: DataFrame, card: Card) -> DataFrame:
    """Bin table with ``scorecard_points``; counts shown as counted, not as smoothed."""
    base = (card.pdo.offset - card.pdo.factor * card.intercept) / len(card.coefs)
    betas = local_frame(
        bins.sparkSession,
        [(c.removesuffix("_woe"), b) for c, b in card.coefs.items()],
        "feature string, coefficient double",
    )
    raw = F.lit(base) - F.lit(card.pdo.factor) * F.col("coefficient") * F.col("woe")
    return bins.join(betas, "feature").select(
        "feature",
        "kind",
        "bin_id",
        "category",
        F.col("label").alias("bin"),
        "goods",
        "bads",
        F.round("woe", 4).alias("woe"),
        F.rint(raw).cast("int").alias("scorecard_points"),
    )


def score_by_points(df: DataFrame, model: WoeModel, points_table: DataFrame, card: Card) -> DataFrame:
    """Add ``<feature>_points`` and ``points_score``, their unbounded sum.

    A value without a bin gets the points of a neutral (zero) weight.
    """
    numeric: dict[str, list[float]] = {f: [0.0] * (len(e) - 1) for f, e in model.edges.items()}
    for row in points_table.filter("kind = 'numeric'").select("feature", "bin_id", "scorecard_points").collect():
        numeric[row[0]][row[1]] = float(row[2])
    named = points_table.filter("kind = 'categorical'").select(
        "feature", "category", F.col("scorecard_points").cast("double").alias("value")
    )
    few: dict[str, dict[str, float]] = {}
    if model.category_woe:
        for row in named.filter(F.col("feature").isin(*model.category_woe)).collect():
            few.setdefault(row[0], {})[row[1]] = row[2]
    neutral = float(round((card.pdo.offset - card.pdo.factor * card.intercept) / len(card.coefs)))
    out = map_bins(df, model, numeric, few, named, "_points", missing=neutral)
    total = sum((F.col(f + "_points") for f in card.features), F.lit(0.0))
    return out.withColumn("points_score", total.cast("int"))
