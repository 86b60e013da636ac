import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lendmark.operators.quantiles import even_probs, exact_quantiles, open_edges, quantile_edges


def frame(spark, **columns):
    return spark.createDataFrame(pd.DataFrame(columns))


@pytest.mark.parametrize("settle_rows", [0, 3, 20_000])
def test_matches_numpy_on_mixed_columns(spark, settle_rows):
    rng = np.random.default_rng(7)
    n = 4000
    columns = {
        "smooth": rng.normal(0, 1, n),
        "negative": -rng.lognormal(3, 2, n),
        "hot": np.where(rng.random(n) < 0.4, 5.0, rng.normal(5, 1, n)),
        "few": rng.integers(0, 3, n).astype(float),
    }
    got = exact_quantiles(frame(spark, **columns), {c: even_probs(10) for c in columns}, settle_rows)
    for c, values in columns.items():
        assert np.allclose(got[c], np.percentile(values, np.array(even_probs(10)) * 100), atol=1e-12, rtol=1e-12)


def test_skips_missing_values_and_reports_empty_columns(spark):
    df = spark.createDataFrame([(1.0, None), (float("nan"), None), (None, None), (4.0, None)], "a double, b double")
    got = exact_quantiles(df, {"a": [0.0, 0.5, 1.0], "b": [0.5]})
    assert got == {"a": [1.0, 2.5, 4.0], "b": None}


def test_infinite_values_take_part(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (float("inf"),)], "a double")
    assert exact_quantiles(df, {"a": [0.5, 1.0]})["a"] == [2.0, float("inf")]


def test_edges_collapse_on_ties(spark):
    df = frame(spark, a=[1.0] * 95 + [2.0] * 5, b=np.arange(100.0))
    edges = quantile_edges(df, ["a", "b"], 5)
    assert edges["a"] == [-np.inf, np.inf]
    assert len(edges["b"]) == 6
    assert open_edges([3.0, 3.0, 3.0]) == [-np.inf, np.inf]


@pytest.mark.parametrize("settle_rows", [0, 20_000])
@pytest.mark.parametrize("values", ["above", "below", "equal"])
def test_many_infinite_or_equal_values_settle(spark, settle_rows, values):
    rng = np.random.default_rng(5)
    x = rng.gamma(2.0, 3.0, 900)
    x[:360] = {"above": np.inf, "below": -np.inf, "equal": 4.25}[values]
    if values == "equal":
        x[:] = 4.25
    got = exact_quantiles(frame(spark, x=x), {"x": [0.0, 0.2, 0.5, 0.8, 1.0]}, settle_rows)["x"]
    ordered = np.sort(x)
    for p, value in zip([0.0, 0.2, 0.5, 0.8, 1.0], got):
        at = p * (len(x) - 1)
        low, high = ordered[int(np.floor(at))], ordered[int(np.ceil(at))]
        assert value == (low if low == high else pytest.approx(low + (high - low) * (at % 1)))


def test_two_hundred_columns_share_what_reaches_the_driver(spark):
    rng = np.random.default_rng(6)
    columns = {f"c{i}": rng.normal(i, 1, 60) for i in range(200)}
    got = exact_quantiles(frame(spark, **columns), {c: [0.25, 0.5] for c in columns})
    assert all(np.allclose(got[c], np.percentile(v, [25, 50])) for c, v in columns.items())
