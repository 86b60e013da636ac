"""Layers that batches are folded into: what they hold, what a load touches, and what failures leave."""

import uuid
from pathlib import Path

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lendmark.sources import files, folded
from lendmark.streaming import incremental

SCHEMA = "k int, ts int, v string"


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture
def name(spark, request):
    layer = f"layer_{uuid.uuid4().hex[:10]}"
    yield layer
    for table in [layer, *folded._staged(spark, layer)]:
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def batch(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def held(spark, name):
    return rows_of(folded.layer(spark, name))


def bucket_files(spark, name):
    """The files of each bucket, with the times they were written."""
    rows = spark.table(name).select(folded.BUCKET, F.input_file_name().alias("f")).distinct().collect()
    return {(r[0], Path(r[1].removeprefix("file:")).stat().st_mtime_ns) for r in rows}


def test_a_load_keeps_the_newest_row_and_rewrites_touched_buckets_only(spark, name):
    first = [(k, 1, f"old{k}") for k in range(200)] + [(None, 1, "n")]
    folded.fold(batch(spark, first), name, "k", ["ts"], buckets=16)
    before = bucket_files(spark, name)
    folded.fold(batch(spark, [(3, 2, "new"), (3, 1, "zz"), (999, 0, "added"), (4, 0, "late"), (None, 2, "m")]), name, "k", ["ts"])
    expected = {k: (k, t, v) for k, t, v in first} | {3: (3, 2, "new"), 999: (999, 0, "added"), None: (None, 2, "m")}
    assert held(spark, name) == sorted(expected.values(), key=repr)
    after = bucket_files(spark, name)
    touched = {r[0] for r in spark.table(name).filter("k IN (3, 4, 999) OR k IS NULL").select(folded.BUCKET).collect()}
    assert {b for b, _ in before - after} == touched and len(touched) < 6
    assert {b for b, _ in before} == set(range(16))


@pytest.mark.parametrize("seed", [1, 2])
def test_order_size_and_repetition_of_batches_do_not_matter(spark, name, seed):
    rng = np.random.default_rng(seed)
    log = [(int(k), int(t), f"v{t}") for k, t in zip(rng.integers(0, 30, 90), rng.integers(0, 60, 90))]
    cuts = sorted(rng.choice(90, 3, replace=False))
    parts = [log[a:b] for a, b in zip([0, *cuts], [*cuts, 90])]
    for part in [*parts, parts[1], parts[0]]:
        folded.fold(batch(spark, part), name, "k", ["ts"], buckets=4)
    newest = {}
    for k, t, v in sorted(log, key=lambda r: (r[1], r[2])):
        newest[k] = (k, t, v)
    assert held(spark, name) == sorted(newest.values(), key=repr)


def test_a_write_that_fails_half_way_loses_nothing(spark, name):
    folded.fold(batch(spark, [(k, 1, "a") for k in range(500)]), name, "k", ["ts"], buckets=8)
    before = held(spark, name)
    rows = spark.range(0, 500, 1, 8).select(
        F.col("id").cast("int").alias("k"), F.lit(2).alias("ts"),
        F.when(F.col("id") < 490, F.lit("b")).otherwise(F.raise_error(F.lit("lost"))).cast("string").alias("v"),
    )
    with pytest.raises(PySparkException):
        files.materialize(rows, name, "incremental", "k", ["ts"])
    assert held(spark, name) == before and not folded._staged(spark, name)
    files.materialize(batch(spark, [(7, 3, "c")]), name, "incremental", "k", ["ts"])
    assert held(spark, name) == sorted([r for r in before if r[0] != 7] + [(7, 3, "c")], key=repr)


@pytest.mark.parametrize("lost_bucket", [False, True])
def test_a_swap_that_is_interrupted_is_finished_by_the_next_load(spark, name, monkeypatch, lost_bucket):
    folded.fold(batch(spark, [(k, 1, "a") for k in range(100)]), name, "k", ["ts"], buckets=4)

    def interrupted(spark, staged, name):
        if lost_bucket:  # the moment between the removal of a partition and its replacement
            spark.sql(f"ALTER TABLE {name} DROP PARTITION ({folded.BUCKET}=1)")
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(folded, "_swap", interrupted)
        with pytest.raises(RuntimeError):
            folded.fold(batch(spark, [(k, 2, "b") for k in range(90)]), name, "k", ["ts"])
    assert len(folded._staged(spark, name)) == 1
    folded.fold(batch(spark, [(5, 3, "c")]), name, "k", ["ts"])
    expected = [(k, 2, "b") for k in range(90) if k != 5] + [(5, 3, "c")] + [(k, 1, "a") for k in range(90, 100)]
    assert held(spark, name) == sorted(expected, key=repr)
    assert folded.recover(spark, name) == 0


def test_the_overwrite_mode_of_the_session_is_left_as_it_was(spark, name):
    setting = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(setting)
    for t in (1, 2):
        folded.fold(batch(spark, [(1, t, "a"), (2, 1, "b")]), name, "k", ["ts"])
    assert spark.conf.get(setting) == before
    assert held(spark, name) == [(1, 2, "a"), (2, 1, "b")]


def test_batches_may_lack_columns_or_bring_new_ones(spark, name):
    folded.fold(batch(spark, [(1, 1, "a"), (2, 1, "b")]), name, "k", ["ts"])
    folded.fold(batch(spark, [(2, 2, 0.5), (3, 1, 0.7)], "k int, ts int, rate double"), name, "k", ["ts"])
    folded.fold(batch(spark, [(4, 1, "d")]), name, "k", ["ts"])
    found = {r["k"]: (r["ts"], r["v"], r["rate"]) for r in folded.layer(spark, name).collect()}
    assert found == {1: (1, "a", None), 2: (2, None, 0.5), 3: (1, None, 0.7), 4: (1, "d", None)}


def test_empty_batches_and_layers(spark, name):
    folded.fold(batch(spark, []), name, "k", ["ts"])
    assert held(spark, name) == []
    folded.fold(batch(spark, [(1, 1, "a")]), name, "k", ["ts"])
    folded.fold(batch(spark, []), name, "k", ["ts"])
    assert held(spark, name) == [(1, 1, "a")]


@pytest.mark.parametrize("files_per_batch", [1, 3, 1000])
def test_the_stream_loses_no_row_whatever_the_order_and_batches(spark, tmp_path, name, files_per_batch):
    landing, marks = str(tmp_path / "landing"), str(tmp_path / "marks")
    rng = np.random.default_rng(files_per_batch)
    log = [(int(k), int(t), f"v{t}") for k, t in zip(rng.integers(0, 40, 60), rng.permutation(60))]
    for at in range(0, 60, 12):
        batch(spark, log[at : at + 12]).coalesce(1).write.mode("append").parquet(landing)
    schema = spark.read.parquet(landing).schema
    incremental.load_stream(spark, landing, name, marks, schema, "k", "ts", files_per_batch, buckets=5)
    newest = {}
    for k, t, v in sorted(log, key=lambda r: r[1]):
        newest[k] = (k, t, v)
    assert held(spark, name) == sorted(newest.values(), key=repr)
    late = str(tmp_path / "late")
    newest.setdefault(1, (1, -5, "old"))
    batch(spark, [(1, -5, "old"), (99, -9, "late")]).write.parquet(late)
    for checkpoint in ("fresh", "again"):  # the second run repeats the batch of the first
        incremental.load_stream(spark, late, name, str(tmp_path / checkpoint), schema, "k", "ts", files_per_batch)
        assert held(spark, name) == sorted([*newest.values(), (99, -9, "late")], key=repr)


def test_the_stream_folds_new_files_only(spark, tmp_path, name):
    landing, marks = str(tmp_path / "landing"), str(tmp_path / "marks")

    def arrive(rows):
        batch(spark, rows).coalesce(1).write.mode("append").parquet(landing)

    def run():
        incremental.load_stream(spark, landing, name, marks, spark.read.parquet(landing).schema, "k", "ts")
        return held(spark, name)

    arrive([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")])
    assert run() == [(1, 2, "b"), (2, 1, "c")]
    assert run() == [(1, 2, "b"), (2, 1, "c")]
    arrive([(2, 5, "d"), (3, 5, "e")])
    assert run() == [(1, 2, "b"), (2, 5, "d"), (3, 5, "e")]


def test_a_stream_that_fails_between_state_and_swap_goes_on(spark, tmp_path, name, monkeypatch):
    landing, marks = str(tmp_path / "landing"), str(tmp_path / "marks")
    folded.fold(batch(spark, [(k, 1, "a") for k in range(20)]), name, "k", ["ts"], buckets=3)
    batch(spark, [(k, 2, "b") for k in range(5)]).write.parquet(landing)
    schema = spark.read.parquet(landing).schema

    def lost(spark, staged, name):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(folded, "_swap", lost)
        with pytest.raises(PySparkException):
            incremental.load_stream(spark, landing, name, marks, schema, "k", "ts")
    incremental.load_stream(spark, landing, name, marks, schema, "k", "ts")
    assert held(spark, name) == sorted([(k, 2, "b") for k in range(5)] + [(k, 1, "a") for k in range(5, 20)], key=repr)
