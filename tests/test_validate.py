import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lendmark.operators import validate


def pairs_auc(y, p):
    bad, good = p[y == 1], p[y == 0]
    greater = (bad[:, None] > good[None, :]).sum() + 0.5 * (bad[:, None] == good[None, :]).sum()
    return greater / (len(bad) * len(good))


def scored(spark, n=800, seed=31):
    rng = np.random.default_rng(seed)
    p = np.round(rng.beta(2, 5, n), 2).clip(0.02, 0.98)
    y = (rng.random(n) < p).astype(int)
    pdf = pd.DataFrame({"target": y, "pd": p, "score": np.round(610 - 40 * np.log(p / (1 - p))).astype("int32")})
    return pdf, spark.createDataFrame(pdf).withColumn("score", F.col("score").cast("int"))


def test_auc_and_gini_count_ties_half(spark):
    pdf, df = scored(spark)
    row = validate.auc(df).first()
    assert row["roc_auc"] == pytest.approx(pairs_auc(pdf.target.values, pdf.pd.values), abs=1e-12)
    assert row["gini"] == pytest.approx(2 * row["roc_auc"] - 1)


def test_brier_and_its_parts(spark):
    pdf, df = scored(spark, 450, 32)
    expected = ((pdf.pd - pdf.target) ** 2).mean()
    assert validate.brier(df).first()[0] == pytest.approx(expected)
    parts = validate.brier_parts(df).first()
    total = parts["reliability"] - parts["resolution"] + parts["uncertainty"] + parts["residual"]
    assert total == pytest.approx(expected) and parts["brier_score"] == pytest.approx(expected)


@pytest.mark.parametrize("kind", ["double", "int"])
def test_deciles_match_pandas_and_approximate_exact_separation(spark, kind):
    rng = np.random.default_rng(33)
    pdf = pd.DataFrame({"target": np.arange(900) % 6 == 0})
    pdf["score"] = 500 + rng.gamma(4, 25, 900) - 60 * pdf.target
    pdf["target"] = pdf.target.astype(int)
    if kind == "int":
        pdf["score"] = pdf.score.round().astype("int32")
    df = spark.createDataFrame(pdf).withColumn("score", F.col("score").cast(kind))
    table = validate.deciles(df).orderBy("decile").toPandas()
    cut = pd.qcut(pdf.score, 10, labels=False, duplicates="drop") + 1
    want = pdf.groupby(cut).target.agg(["count", "sum"])
    assert list(table.total) == list(want["count"]) and list(table.bads) == list(want["sum"])
    assert table.cum_pct_bads.iloc[-1] == pytest.approx(1) and table.cum_pct_goods.iloc[-1] == pytest.approx(1)
    exact = validate.ks_exact(df).first()["ks_exact"]
    grid = np.sort(pdf.score.unique())
    bad, good = pdf.score[pdf.target == 1], pdf.score[pdf.target == 0]
    best = max(abs((bad <= s).mean() - (good <= s).mean()) for s in grid)
    assert exact == pytest.approx(best)
    assert validate.ks(validate.deciles(df)).first()["ks"] == pytest.approx(exact, abs=0.08)


def test_bundle_agrees_with_the_single_metrics(spark):
    pdf, df = scored(spark)
    got = validate.evaluate(df).first()
    assert got["roc_auc"] == round(validate.auc(df).first()["roc_auc"], 4)
    assert got["ks_statistic"] == validate.ks(validate.deciles(df)).first()["ks_percent"]
    assert got["brier_score"] == pytest.approx(round(((pdf.pd - pdf.target) ** 2).mean(), 4), abs=1e-4)
    cells = validate.confusion(df).first()
    assert got["total_financial_loss"] == cells["total_loss"] and got["cost_optimal_tau"] == 0.0291


def test_pr_area_matches_trapezoids(spark):
    pdf, df = scored(spark)
    levels = np.sort(pdf.pd.unique())[::-1]
    y, p = pdf.target.values, pdf.pd.values
    recall = np.r_[0, [((p >= t) & (y == 1)).sum() / y.sum() for t in levels]]
    precision = np.r_[1, [y[p >= t].mean() for t in levels]]
    got = validate.pr_auc(df).first()
    assert got["pr_auc"] == pytest.approx(np.trapezoid(precision, recall)) and got["prior_rate"] == pytest.approx(y.mean())
    points = validate.curve_points(df).orderBy(F.desc("threshold")).toPandas()
    assert np.allclose(points.recall, recall[1:]) and np.allclose(points.precision, precision[1:])


def test_one_class_gives_nulls_not_errors(spark):
    df = spark.createDataFrame([(0, 0.1, 500), (0, 0.2, 480)], "target int, pd double, score int")
    assert validate.auc(df).first()["roc_auc"] is None
    assert validate.ks(validate.deciles(df)).first()["ks"] is None
    assert validate.ks_exact(df).first()["ks_exact"] is None
    got = validate.evaluate(df).first()
    assert got["roc_auc"] is None and got["ks_statistic"] is None and got["recall_at_tau"] == 0.0


def test_constant_score_is_one_bin(spark):
    df = spark.createDataFrame([(i % 2, 0.5, 600) for i in range(10)], "target int, pd double, score int")
    rows = validate.deciles(df).collect()
    assert len(rows) == 1 and rows[0]["total"] == 10 and rows[0]["ks_separation"] == pytest.approx(0)
