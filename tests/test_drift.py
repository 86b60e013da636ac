import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lendmark.operators import drift, govern


def frame(spark, values):
    return spark.createDataFrame(pd.DataFrame({"score": values}))


def reference_psi(actual, expected, n=10, eps=1e-4):
    edges = np.unique(np.percentile(expected, np.linspace(0, 100, n + 1)))
    edges[0], edges[-1] = -np.inf, np.inf
    shares = []
    for values in (expected, actual):
        share = np.maximum(np.histogram(-values, -edges[::-1])[0][::-1] / len(values), eps)
        shares.append(share / share.sum())
    e, a = shares
    return ((a - e) * np.log(a / e)).sum()


def total(cells):
    return drift.psi_totals(cells).first()


def test_two_draws_of_one_distribution_are_stable(spark):
    rng = np.random.default_rng(9)
    base, later = rng.gamma(9, 60, 4000), rng.gamma(9, 60, 3000)
    cells = drift.psi(frame(spark, later), frame(spark, base))
    got = total(cells)
    assert cells.count() == 10 and got["status"] == "STABLE"
    assert got["psi"] == pytest.approx(reference_psi(later, base), abs=1e-4)


def test_a_shift_of_the_lower_half_triggers_retraining(spark):
    rng = np.random.default_rng(10)
    base = rng.gamma(9, 60, 3000)
    later = np.where(base < np.median(base), base - 220, base)
    got = govern.retrain_decision(drift.psi_totals(drift.psi(frame(spark, later), frame(spark, base)))).first()
    assert got["status"] == "SIGNIFICANT_DRIFT" and got["retrain"]
    assert got["psi"] == pytest.approx(reference_psi(later, base), abs=1e-4)


def test_breakdown_adds_up(spark):
    base, later = np.arange(700) % 97, np.arange(500) % 61
    table = drift.breakdown(drift.psi(frame(spark, later * 1.0), frame(spark, base * 1.0))).toPandas()
    assert list(table.columns) == ["epoch", "bin_index", "expected_pct", "actual_pct", "psi_contribution"]
    assert table.expected_pct.sum() == pytest.approx(100, abs=0.1) and table.actual_pct.sum() == pytest.approx(100, abs=0.1)


def test_an_integer_score_of_many_values_needs_no_single_buffer(spark, monkeypatch):
    df = spark.range(3000).select((F.col("id") * 17 % 2999).cast("int").alias("score"))
    plain = drift.psi_edges(df)
    monkeypatch.setattr("lendmark.functions.state.SETTLE_ROWS", 100)
    monkeypatch.setattr("lendmark.operators.tally.RANGE_ROWS", 200)
    assert drift.psi_edges(df) == plain
    assert drift.psi_edges(df.withColumn("score", F.col("score").cast("double"))) == plain


def test_identical_and_constant_samples_have_no_drift(spark):
    values = np.arange(100.0)
    assert total(drift.psi(frame(spark, values), frame(spark, values)))["psi"] == 0.0
    assert total(drift.psi(frame(spark, np.full(9, 5.0)), frame(spark, np.full(9, 5.0))))["psi"] == 0.0


def test_empty_bins_are_kept_and_floored(spark):
    cells = drift.psi(frame(spark, np.full(50, 99.0)), frame(spark, np.arange(100.0)), eps=1e-4).toPandas()
    assert len(cells) == 10
    assert cells.actual_share.min() == pytest.approx(1e-4 / (1 + 9e-4))


def test_histogram_form_drops_outliers(spark):
    base = np.arange(101.0)
    cells = drift.psi(frame(spark, np.r_[base, 1e6, -1e6]), frame(spark, base), mode="hist", eps=1e-6).toPandas()
    assert len(cells) == 10 and cells.psi_contribution.sum() == pytest.approx(0)
    assert cells.expected_share.iloc[-1] == pytest.approx(11 / 101)


def test_equal_shares_are_expected_without_a_baseline(spark):
    edges = [-np.inf, 1.0, 2.0, 3.0, np.inf]
    cells = drift.psi(frame(spark, np.array([0.5, 1.5, 2.5, 3.5])), None, edges=edges)
    assert {r["expected_share"] for r in cells.collect()} == {0.25} and total(cells)["psi"] == 0.0


def test_gate_compares_with_the_threshold(spark):
    rows = spark.createDataFrame([(0.2286,), (0.19,), (None,)], "ks double")
    assert [r["decision"] for r in govern.oot_decision(rows).collect()] == ["PROMOTE", "REJECT", "REJECT"]


def test_run_log_appends(spark, tmp_path):
    path = str(tmp_path / "runs")
    govern.log_run(spark, path, "a", {"pdo": 20.0}, {"ks": 21.65})
    govern.log_run(spark, path, "b", tags={"status": "STABLE"})
    got = {(r["run_name"], r["kind"], r["key"], r["value"]) for r in spark.read.parquet(path).collect()}
    assert got == {("a", "param", "pdo", "20.0"), ("a", "metric", "ks", "21.65"), ("b", "tag", "status", "STABLE")}
