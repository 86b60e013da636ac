import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lendmark.functions.state import local_frame
from lendmark.operators import woe


def by_hand(spark):
    rows = [("north", 0)] * 45 + [("north", 1)] * 5 + [("south", 0)] * 15 + [("south", 1)] * 25
    return spark.createDataFrame(rows, "bin string, target int")


NORTH, SOUTH = math.log((45 / 60) / (5 / 30)), math.log((15 / 60) / (25 / 30))


def test_hand_calculated_weights(spark):
    bins = woe.fit_woe(by_hand(spark), ["bin"]).bins
    got = {r["category"]: r["woe"] for r in bins.collect()}
    assert got == {"north": pytest.approx(NORTH), "south": pytest.approx(SOUTH)}
    value = (45 / 60 - 5 / 30) * NORTH + (15 / 60 - 25 / 30) * SOUTH
    assert woe.information_value(bins).first()["information_value"] == pytest.approx(value)


def test_published_counts_give_the_published_weights(spark):
    # first feature of the published points table: goods, bads, weight
    published = [(19782, 6306, -0.3067), (11698, 3253, -0.1701), (14912, 3557, -0.0167), (14009, 2751, 0.1778),
                 (14402, 1680, 0.6986)]
    rows = [("fico_mid", g, b, 74803, 17547) for g, b, _ in published]
    frame = local_frame(spark, rows, "feature string, goods bigint, bads bigint, all_goods bigint, all_bads bigint")
    got = woe.weigh(frame).orderBy("woe").collect()
    assert [r["woe"] for r in got] == pytest.approx([w for _, _, w in published], abs=5e-5)
    assert sum(r["iv_contrib"] for r in got) == pytest.approx(0.1071, abs=5e-5)


def test_a_rising_risk_gives_monotone_bins_that_map_every_row(spark):
    days = np.arange(1200) % 90
    late = (days * 7 + np.arange(1200) * 13) % 100 < days  # the share of late payers rises with the days
    df = spark.createDataFrame(pd.DataFrame({"days": days.astype(float), "target": late.astype(int)}))
    model = woe.fit_woe(df, ["days"])
    rates = [r["bads"] / r["total"] for r in model.bins.orderBy("bin_id").collect()]
    assert rates == sorted(rates) and len(rates) > 1
    assert sum(r["total"] for r in model.bins.collect()) == 1200
    assert woe.apply_woe(df, model).filter(F.col("days_woe").isNull()).count() == 0


def test_many_bins_end_monotone():
    rng = np.random.default_rng(8)
    counts = [(50, 50 - int(b), int(b)) for b in rng.integers(1, 49, 40)]
    edges = [-math.inf, *map(float, range(39)), math.inf]
    _, left = woe.merge_monotone(edges, counts)
    rates = [b / t for t, _, b in left]
    assert len(rates) <= 2 or rates in (sorted(rates), sorted(rates, reverse=True))


def test_merging_follows_the_smallest_step():
    edges = [-math.inf, 1.0, 2.0, 3.0, math.inf]
    counts = [(100, 90, 10), (100, 70, 30), (100, 75, 25), (100, 40, 60)]
    merged, left = woe.merge_monotone(edges, counts)
    assert merged == [-math.inf, 1.0, 3.0, math.inf]
    assert left == [(100, 90, 10), (200, 145, 55), (100, 40, 60)]


def test_empty_bins_join_their_left_neighbour_and_two_bins_stay():
    inf = math.inf
    merged, left = woe.merge_monotone([-inf, 1, 2, inf], [(10, 5, 5), (0, 0, 0), (10, 9, 1)])
    assert merged == [-inf, 2, inf] and left == [(10, 5, 5), (10, 9, 1)]
    merged, left = woe.merge_monotone([-inf, 1, 2, inf], [(0, 0, 0), (10, 5, 5), (10, 9, 1)])
    assert merged == [-inf, 2, inf] and left == [(10, 5, 5), (10, 9, 1)]
    already = [(10, 5, 5), (10, 5, 5)]
    assert woe.merge_monotone([-inf, 1, inf], already) == ([-inf, 1, inf], already)


def test_missing_numbers_are_left_out_but_count_in_the_class_totals(spark):
    rows = [(float(i), int(i % 4 == 0)) for i in range(100)] + [(None, 1)] * 10 + [(float("nan"), 0)] * 5
    df = spark.createDataFrame(rows, "x double, target int")
    model = woe.fit_woe(df, ["x"], monotone=False)
    bins = model.bins.collect()
    assert sum(r["total"] for r in bins) == 100
    first = bins[0]
    assert first["pct_bads"] == pytest.approx(first["bads"] / 35)
    assert woe.apply_woe(df, model).filter("x IS NULL OR isnan(x)").agg(F.max("x_woe")).first()[0] == 0.0


def test_zero_counts_are_floored_and_missing_text_is_a_category(spark):
    df = spark.createDataFrame([("a", 0)] * 10 + [("b", 1)] * 5 + [(None, 1)] * 5, "c string, target int")
    got = {r["category"]: r for r in woe.fit_woe(df, ["c"]).bins.collect()}
    assert set(got) == {"a", "b", "nan"}
    assert got["a"]["woe"] == pytest.approx(math.log((10 / 10) / (0.5 / 10)))
    assert got["a"]["bads"] == 0


@pytest.mark.parametrize("few", [0, 100])
def test_unseen_categories_are_neutral_on_both_lookup_paths(spark, monkeypatch, few):
    monkeypatch.setattr(woe, "FEW_CATEGORIES", few)
    model = woe.fit_woe(by_hand(spark), ["bin"])
    assert bool(model.category_woe) == (few > 0)
    later = spark.createDataFrame([("north",), ("other",), (None,)], "bin string")
    got = {r["bin"]: r["bin_woe"] for r in woe.apply_woe(later, model).collect()}
    assert got["north"] == pytest.approx(NORTH) and got["other"] == 0.0 and got[None] == 0.0


def test_large_category_tables_stay_distributed(spark, monkeypatch):
    monkeypatch.setattr("lendmark.functions.state.SETTLE_ROWS", 2)
    df = by_hand(spark).withColumn("x", F.rand(1))
    model = woe.fit_woe(df, ["bin", "x"])
    got = {r["category"]: r["woe"] for r in model.bins.filter("kind = 'categorical'").collect()}
    assert got["north"] == pytest.approx(NORTH)
    assert woe.apply_woe(df, model).agg(F.count("bin_woe")).first()[0] == 90


def test_frequent_categories_of_a_large_table_fill_no_task(spark, monkeypatch):
    monkeypatch.setattr("lendmark.functions.state.SETTLE_ROWS", 100)
    rng = np.random.default_rng(4)
    text = np.where(rng.random(16_000) < 0.5, "hot", rng.integers(0, 900, 16_000).astype(str)).astype(object)
    text[::7] = None
    df = spark.createDataFrame(pd.DataFrame({"c": text, "target": (rng.random(16_000) < 0.3).astype(int), "i": np.arange(16_000)}))
    model = woe.fit_woe(df, ["c"])
    assert model.distributed
    heavy = woe.frequent(df, "c")
    assert heavy[0] == "hot" and "nan" in heavy and len(heavy) == woe.FREQUENT
    keys = df.select(woe.spread_key(df, "c", heavy).alias("k")).repartition(8, "k")
    sizes = sorted(r["count"] for r in keys.groupBy(F.spark_partition_id()).count().collect())
    assert len(sizes) == 8 and sizes[-1] <= 2 * sizes[4]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = {r["i"]: r["c_woe"] for r in woe.apply_woe(df, model).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    known = {r["category"]: r["woe"] for r in model.bins.collect()}
    assert len(got) == 16_000 and all(got[i] == known["nan" if t is None else t] for i, t in enumerate(text))


def test_share_smoothing_uses_padded_edges(spark):
    df = spark.createDataFrame([(float(i), int(i >= 80)) for i in range(100)], "x double, target int")
    model = woe.fit_woe(df, ["x"], smoothing="share", monotone=False)
    assert model.edges["x"][0] == pytest.approx(-1e-5) and model.edges["x"][-1] == pytest.approx(99 + 1e-5)
    assert min(r["pct_bads"] for r in model.bins.collect()) == pytest.approx(1e-6)
    outside = spark.createDataFrame([(500.0,)], "x double")
    assert woe.apply_woe(outside, model).first()["x_woe"] == 0.0


@pytest.mark.parametrize("few", [0, 100])
def test_missing_text_gets_its_own_weight_on_both_lookup_paths(spark, monkeypatch, few):
    monkeypatch.setattr(woe, "FEW_CATEGORIES", few)
    rows = [("a", 0)] * 10 + [("b", 1)] * 5 + [(None, 1)] * 5 + [("nan", 0)]
    df = spark.createDataFrame(rows, "c string, target int")
    model = woe.fit_woe(df, ["c"])
    weight = {r["category"]: r["woe"] for r in model.bins.collect()}
    got = {r["c"]: r["c_woe"] for r in woe.apply_woe(df, model).distinct().collect()}
    assert got == {"a": weight["a"], "b": weight["b"], None: weight["nan"], "nan": weight["nan"]}
