import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lendmark.functions.scale import Pdo, score_from_logit, score_from_pd
from lendmark.operators import card as cards
from lendmark.operators import woe


def test_scale_algebra(spark):
    pdo = Pdo()
    assert pdo.offset + pdo.factor * math.log(50) == pytest.approx(600)
    assert pdo.offset + pdo.factor * math.log(100) == pytest.approx(620)
    assert round(pdo.factor, 4) == 28.8539 and round(pdo.offset, 4) == 487.1229


def test_scores_are_rounded_and_bounded(spark):
    rows = spark.createDataFrame([(-math.log(50.0),), (-math.log(100.0),), (99.0,), (-99.0,)], "z double")
    got = [r[0] for r in rows.select(score_from_logit(F.col("z"))).collect()]
    assert got == [600, 620, 300, 850]
    ends = spark.createDataFrame([(0.0,), (1.0,), (1 / 51,)], "p double")
    assert [r[0] for r in ends.select(score_from_pd(F.col("p"))).collect()] == [850, 300, 600]


def newton(x, y, c=1.0):
    n, d = x.shape
    w = np.where(y == 1, n / (2 * (y == 1).sum()), n / (2 * (y == 0).sum()))
    design = np.column_stack([np.ones(n), x])
    penalty = np.diag([0.0] + [1.0] * d)
    beta = np.zeros(d + 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-design @ beta))
        gradient = c * design.T @ (w * (p - y)) + penalty @ beta
        hessian = c * (design * (w * p * (1 - p))[:, None]).T @ design + penalty
        beta -= np.linalg.solve(hessian, gradient)
    return beta


def test_fit_matches_newton(spark):
    rng = np.random.default_rng(5)
    x = np.column_stack([rng.choice([-0.8, -0.1, 0.4, 0.9], 3000), rng.choice([-0.5, 0.3], 3000), rng.normal(size=3000)])
    y = rng.binomial(1, 1 / (1 + np.exp(1.2 + 0.9 * x[:, 0] + 0.4 * x[:, 1] - 0.2 * x[:, 2])))
    df = spark.createDataFrame(pd.DataFrame({"a_woe": x[:, 0], "b_woe": x[:, 1], "c_woe": x[:, 2], "target": y}))
    card = cards.fit_card(df, ["a_woe", "b_woe", "c_woe"])
    assert [card.intercept, *card.coefs.values()] == pytest.approx(list(newton(x, y)), abs=1e-6)
    table = cards.coefficients(spark, card).orderBy("position").collect()
    assert table[0]["feature"] == "Intercept" and table[1]["odds_ratio"] == pytest.approx(math.exp(card.coefs["a_woe"]))


def test_points_add_up_to_the_score_within_rounding(spark):
    rng = np.random.default_rng(9)
    pdf = pd.DataFrame({"x": rng.normal(size=2000), "c": rng.choice(list("abc"), 2000)})
    pdf["target"] = rng.binomial(1, 1 / (1 + np.exp(1 - pdf.x)))
    df = spark.createDataFrame(pdf)
    model = woe.fit_woe(df, ["x", "c"])
    rows = woe.apply_woe(df, model)
    card = cards.fit_card(rows, woe.woe_columns(model))
    table = cards.points(model.bins, card)
    both = cards.score_by_points(cards.scored(rows, card), model, table, card)
    gap = both.filter("score > 300 AND score < 850").agg(F.max(F.abs(F.col("score") - F.col("points_score")))).first()[0]
    assert gap <= len(card.coefs) / 2 + 0.5


def test_weights_balance_the_classes(spark):
    df = spark.createDataFrame([(0,)] * 90 + [(1,)] * 10, "target int")
    sums = cards.with_weights(df).groupBy("target").agg(F.sum("class_weight").alias("w")).collect()
    assert [r["w"] for r in sums] == pytest.approx([50.0, 50.0])
