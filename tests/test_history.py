import uuid

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lendmark.operators import history, sampling
from lendmark.operators.ordered import slice_timelines


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_latest_takes_the_newest_with_full_tie_break(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 7, "b"), (1, 7, "c"), (2, None, "x"), (2, 1, "y")], "k int, t int, v string")
    assert rows_of(history.latest(df, "k", ["t"])) == [(1, 7, "c"), (2, 1, "y")]


def test_upsert_replaces_inserts_and_is_idempotent(spark):
    target = spark.createDataFrame([(1, 1, "a"), (2, 1, "b")], "k int, t int, v string")
    source = spark.createDataFrame([(2, 2, "old"), (2, 3, "new"), (3, 3, "c")], "k int, t int, v string")
    once = history.upsert(target, source, "k", ["t"])
    assert rows_of(once) == [(1, 1, "a"), (2, 3, "new"), (3, 3, "c")]
    assert rows_of(history.upsert(once, source, "k", ["t"])) == rows_of(once)


@pytest.fixture
def bucketed(spark):
    name = f"bucketed_{uuid.uuid4().hex[:10]}"
    rows = [(k, k % 5, f"v{k}") for k in range(400)] + [(None, 1, "n")]
    history.write_bucketed(spark.createDataFrame(rows, "k int, t int, v string"), name, "k", 6)
    yield spark.table(name)
    spark.sql(f"DROP TABLE {name}")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_bucketed_target_is_not_shuffled(spark, bucketed):
    before = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold",)}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        source = spark.createDataFrame([(3, 9, "new"), (3, 8, "old"), (900, 1, "add"), (None, 2, "m")], "k int, t int, v string")
        merged = history.upsert_bucketed(bucketed, source, "k", ["t"], 6)
        plan = plan_of(merged)
        assert rows_of(merged) == rows_of(history.upsert(bucketed, source, "k", ["t"]))
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
    target = plan[: plan.index("Scan parquet")].rsplit("Join", 1)[1]  # from the join down to the scan of the target
    assert "Bucketed: true" in plan and "Exchange" not in target
    assert plan.count("Exchange hashpartitioning(k") <= 2  # those of the source
    assert "Exchange" not in plan_of(history.latest(bucketed, "k", ["t"]))


def test_only_strictly_newer_rows_are_loaded(spark):
    landing = spark.sql("SELECT * FROM VALUES (1, TIMESTAMP '2024-01-01'), (1, TIMESTAMP '2024-01-03') AS t(k, ts)")
    first = history.load_increment(landing.limit(1), None, "k", "ts")
    second = history.load_increment(landing, first, "k", "ts")
    assert history.newer_than(landing, "ts", second).count() == 0
    assert second.count() == 1
    assert history.newer_than(landing, "ts", None).count() == 2


def brute_force_versions(pdf):
    out = []
    for k, part in pdf.sort_values(["k", "t", "i"]).groupby("k"):
        starts = part[(part.v != part.v.shift()) | (np.arange(len(part)) == 0)]
        ends = list(starts.t[1:]) + [None]
        out += [(k, int(i), v, int(t), None if e is None else int(e)) for i, v, t, e in zip(starts.i, starts.v, starts.t, ends)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("hot_rows", [20, 100, 10**9])
def test_versions_of_a_skewed_log_match_brute_force(spark, hot_rows):
    rng = np.random.default_rng(1)
    n = 3000
    pdf = pd.DataFrame({
        "k": np.where(rng.random(n) < 0.4, 0, rng.integers(1, 40, n)), "t": rng.integers(0, 500, n),
        "i": np.arange(n), "v": rng.choice(list("ab"), n),
    })
    df = spark.createDataFrame(pdf)
    _, sliced = slice_timelines(df, "k", ["t", "i"], hot_rows)
    assert sliced == (hot_rows < 10**9)
    got = history.scd2_history(df, "k", ["t", "i"], ["v"], hot_rows=hot_rows)
    plain = [(r["k"], r["i"], r["v"], r["valid_from"], r["valid_to"]) for r in got.collect()]
    assert sorted(plain, key=repr) == brute_force_versions(pdf)
    assert got.filter("is_current").groupBy("k").count().filter("count <> 1").count() == 0


def test_hot_timelines_really_are_spread(spark):
    df = spark.range(10_000).select(F.lit(1).alias("k"), F.col("id").alias("t"))
    rows, _ = slice_timelines(df, "k", ["t"], hot_rows=500)
    sizes = [r["count"] for r in rows.groupBy("__slice").count().collect()]
    assert len(sizes) == 20 and max(sizes) < 1000


ORDERS = {
    "date": "date_add(DATE '2020-01-01', i)",
    "timestamp": "timestamp_micros(i * 1000000L)",
    "text": "format_string('%05d', i)",
    "tied": "7",
}


@pytest.mark.parametrize("kind", sorted(ORDERS))
def test_any_order_and_a_null_key_give_equal_versions_on_both_sides_of_the_threshold(spark, kind):
    rows = spark.range(90).select(F.col("id").cast("int").alias("i"))
    log = rows.select(
        F.when(F.col("i") % 3 > 0, F.lit(None)).otherwise(F.col("i") % 2).cast("int").alias("k"),
        F.expr(ORDERS[kind]).alias("t"), "i", (F.floor(F.col("i") / 4) % 2).cast("string").alias("v"),
    )
    plain = rows_of(history.scd2_history(log, "k", ["t", "i"], ["v"], hot_rows=10**9))
    assert rows_of(history.scd2_history(log, "k", ["t", "i"], ["v"], hot_rows=3)) == plain
    sliced, hot = slice_timelines(log, "k", ["t", "i"], hot_rows=10)
    assert hot and max(r["count"] for r in sliced.groupBy("__slice", "k").count().collect()) <= 30
    assert sliced.filter("k IS NULL").select("__slice").distinct().count() > 2


def test_snapshot_closes_opens_and_keeps(spark):
    dim = history.scd2_seed(
        spark.createDataFrame([(1, "A", "2013"), (2, "B", "2013"), (3, None, "2013")], "k int, g string, d string"),
        "k", ["g"], "d",
    )
    snap = spark.createDataFrame([(1, "A"), (2, "C"), (3, None), (4, "D")], "k int, g string")
    once = history.scd2_apply(dim, snap, "k", ["g"], F.lit("2016"))
    assert rows_of(once) == sorted([
        (1, "A", "2013", None, True), (2, "B", "2013", "2016", False), (2, "C", "2016", None, True),
        (3, None, "2013", None, True), (4, "D", "2016", None, True)], key=repr)
    assert rows_of(history.scd2_apply(once, snap, "k", ["g"], F.lit("2017"))) == rows_of(once)
    gone = history.scd2_apply(once, snap.filter("k = 1"), "k", ["g"], F.lit("2018"))
    assert gone.filter("is_current").count() == 4


def test_strata_get_their_exact_share(spark):
    pdf = pd.DataFrame({"id": np.arange(5000), "s": np.r_[np.zeros(4000), np.ones(990), np.full(10, 2)].astype(int)})
    df = spark.createDataFrame(pdf)
    got = sampling.stratified_sample(df, ["s"], 0.13, "id")
    sizes = {r["s"]: r["count"] for r in got.groupBy("s").count().collect()}
    assert sizes == {0: 520, 1: 129, 2: 1}
    again = sampling.stratified_sample(df.repartition(3), ["s"], 0.13, "id")
    assert rows_of(again) == rows_of(got)
    assert sampling.stratified_sample(df, ["s"], 1.0, "id").count() == 5000
    assert sampling.stratified_sample(df, ["s"], 0.0, "id").count() == 0
