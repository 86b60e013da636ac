"""Running totals and quantiles of value counts, small and in ranges."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lendmark.functions import state
from lendmark.operators import drift, validate
from lendmark.operators.tally import Tally, running_totals, weighted_quantiles

PROBS = [0.0, 0.1, 0.25, 0.5, 0.9, 0.999, 1.0]


def jobs(spark):
    return spark.sparkContext._jsc.sc().dagScheduler().numTotalJobs()


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("small", [False, True])
def test_running_totals_equal_a_plain_cumulative_sum(spark, descending, small):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"x": np.unique(rng.normal(size=3000))})
    pdf["n"], pdf["m"] = rng.integers(1, 9, len(pdf)), 1
    tally = Tally(spark.createDataFrame(pdf), small)
    got = running_totals(tally, "x", {"upto": "n", "rank": "m"}, descending, range_rows=200).toPandas()
    want = pdf.sort_values("x", ascending=not descending)
    merged = got.merge(want.assign(want=want.n.cumsum(), place=want.m.cumsum())[["x", "want", "place"]], on="x")
    assert len(merged) == len(pdf) and (merged.upto == merged.want).all() and (merged["rank"] == merged.place).all()
    assert (merged.all_upto == pdf.n.sum()).all() and (merged.all_rank == len(pdf)).all()


@pytest.mark.parametrize("small", [False, True])
def test_running_totals_of_few_and_no_values(spark, small):
    df = spark.createDataFrame([(1, 10), (2, 20)], "x int, n bigint")
    rows = running_totals(Tally(df, small), "x", {"t": "n"}).orderBy("x").collect()
    assert [(r["t"], r["all_t"]) for r in rows] == [(10, 30), (30, 30)]
    assert running_totals(Tally(df.filter("x > 5"), small), "x", {"t": "n"}).count() == 0


@pytest.mark.parametrize("limit", [10, 100_000])
@pytest.mark.parametrize("kind", ["double", "int"])
def test_quantiles_equal_numpy_for_any_type_and_size(spark, monkeypatch, limit, kind):
    monkeypatch.setattr(state, "SETTLE_ROWS", limit)
    monkeypatch.setattr("lendmark.operators.tally.RANGE_ROWS", 60)
    values = np.random.default_rng(5).gamma(2, 90, 1500).round()
    values[:500] = 77  # one value holds a third of the rows
    df = spark.createDataFrame(pd.DataFrame({"x": values})).withColumn("x", F.col("x").cast(kind))
    tally = Tally.of(df.unionByName(spark.sql(f"SELECT CAST(NULL AS {kind}) AS x")).groupBy("x").agg(F.count("*").alias("n")))
    assert tally.small == (limit > 10)
    got = weighted_quantiles(tally, "x", "n", PROBS)
    assert np.allclose(got, np.percentile(values, np.array(PROBS) * 100), rtol=1e-13)
    assert weighted_quantiles(tally.where("n < 0"), "x", "n", PROBS) == []


def test_large_results_lie_in_the_scratch_folder_and_are_read_from_there(spark, monkeypatch):
    monkeypatch.setattr(state, "SETTLE_ROWS", 5)
    frame, small = state.settled(spark.range(6))
    assert not small and sorted(r[0] for r in frame.collect()) == list(range(6)) and frame.inputFiles()
    frame, small = state.settled(spark.range(5))
    assert small and frame.count() == 5 and not frame.inputFiles()
    assert state.settled(spark.range(0))[1]


def scored(spark, n=3000):
    rng = np.random.default_rng(8)
    p = rng.beta(2, 5, n)
    pdf = pd.DataFrame({"target": (rng.random(n) < p).astype(int), "pd": p, "score": (700 - 300 * p).astype("int32")})
    pdf["epoch"] = np.where(rng.random(n) < 0.5, "baseline", "later")
    return spark.createDataFrame(pdf)


def test_metrics_do_not_depend_on_the_size_of_the_tally(spark, monkeypatch):
    df = scored(spark)

    def everything():
        curve = [sorted(map(tuple, f(df).collect())) for f in (validate.curve_points, validate.deciles)]
        single = [tuple(f(df).first()) for f in (validate.auc, validate.pr_auc, validate.ks_exact, validate.evaluate)]
        cells = sorted(map(tuple, drift.psi_cells(df, "epoch", "baseline").collect()))
        return curve, single, cells

    plain = everything()
    monkeypatch.setattr(state, "SETTLE_ROWS", 50)
    monkeypatch.setattr("lendmark.operators.tally.RANGE_ROWS", 100)
    ranged = everything()
    assert ranged[0] == plain[0]
    for a, b in zip([*plain[1], *plain[2]], [*ranged[1], *ranged[2]]):
        assert all(x == y or x == pytest.approx(y, rel=1e-12) for x, y in zip(a, b)) and len(a) == len(b)


def test_profiles_add_up(spark):
    df = scored(spark)
    seen = validate.profile(df, by=["epoch"])
    whole = validate.evaluate_profile(seen.fold(["pd", "score"], [F.sum(c).alias(c) for c in ("total", "bads", "goods")]))
    assert whole.first() == validate.evaluate(df).first()
    part = validate.evaluate_profile(seen.where("epoch = 'later'")).first()
    assert part == validate.evaluate(df.filter("epoch = 'later'")).first()
    totals = drift.psi_of_tally(seen, "total", "epoch", "baseline").collect()
    assert totals == drift.psi_by(df, "epoch", "baseline").collect()


@pytest.mark.parametrize("metric, limit", [
    (validate.auc, 6), (validate.ks_exact, 6), (validate.pr_auc, 6), (validate.curve_points, 6), (validate.deciles, 10),
    (validate.evaluate, 20),
])
def test_metrics_take_few_jobs(spark, metric, limit):
    df = scored(spark).persist()
    df.count()
    before = jobs(spark)
    metric(df).write.format("noop").mode("overwrite").save()
    assert jobs(spark) - before <= limit
    df.unpersist()


def test_scores_are_computed_once_and_null_ones_left_out(spark, monkeypatch):
    counted = []
    monkeypatch.setattr("lendmark.operators.tally.settled", lambda df: (counted.append(df), state.settled(df))[1])
    rows = [("a", 1.0, 1), ("a", None, 0), ("a", 3.0, 0), (None, 2.0, 1)]
    df = spark.createDataFrame(rows, "epoch string, x double, target int").repartition(2)
    df = df.withColumns({"pd": F.when(F.col("x") > 2, F.exp("x")).otherwise(F.col("x") / 4), "score": (F.col("x") * 2).cast("int")})
    seen = validate.profile(df, by=["epoch"])
    assert sorted((r["epoch"] or "", r["score"], r["total"]) for r in seen.rows.collect()) == [("", 4, 1), ("a", 2, 1), ("a", 6, 1)]
    assert [r["target"] for r in validate.curve(df).withColumnRenamed("bads", "target").orderBy("pd").collect()] == [1, 1, 0]
    assert drift.psi_edges(df, "score", 2) == [float("-inf"), 4.0, float("inf")]
    drift.psi_cells(df, "epoch", "a").collect()
    # a filter below the counts would hold a second copy of the whole expression
    plans = [c._jdf.queryExecution().optimizedPlan().toString() for c in counted]
    assert len(plans) == 4 and not any("Filter" in p for p in plans)
