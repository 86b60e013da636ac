"""Nearest neighbours and exact top-k, against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lendmark.llm import neighbours, top_inner, vectors
from lendmark.llm.scratch import kept

SCHEMA = "vec_id long, embedding array<float>, part int, ids string"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 1, "x") for i, v in rows], SCHEMA)


def sample(n, d, seed):
    x = np.random.default_rng(seed).normal(size=(n, d)).astype(np.float32)
    x[n // 2 : n // 2 + n // 4] = x[0]  # a large group of equal vectors
    return x


@pytest.fixture
def small_parts(monkeypatch):
    monkeypatch.setattr(vectors, "SHARD_ROWS", 150)
    monkeypatch.setattr(vectors, "BLOCK_ROWS", 4)
    monkeypatch.setattr(vectors, "HELD_BLOCKS", 1)


def test_top_products_equal_brute_force(spark, small_parts):
    x = sample(600, 8, 1)
    z = np.floor(256 * x.astype(np.float64)).astype(np.int64)
    got = {}
    for r in top_inner.top_products(frame(spark, enumerate(x))).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    for q in range(0, 600, 50):
        scores = z @ z[q]
        best = [i for i in np.lexsort((np.arange(600), -scores)) if i != q][:5]
        assert sorted(got.pop(q)) == [(k + 1, i, scores[i]) for k, i in enumerate(best)]
    assert not got


def test_neighbours_reach_the_recall(spark, small_parts):
    x = sample(900, 16, 2).astype(np.float64)
    got = {}
    for r in neighbours.nearest(frame(spark, enumerate(x))).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    hits = 0
    for q in range(0, 900, 100):
        gaps = np.sqrt(((x.astype(np.float32).astype(np.float64) - x[q].astype(np.float32)) ** 2).sum(axis=1))
        found = sorted(got.pop(q))
        assert [k for k, _, _ in found] == list(range(1, 11)) and q not in [i for _, i, _ in found]
        assert all(s == pytest.approx(gaps[i]) for _, i, s in found)
        assert [(s, i) for _, i, s in found] == sorted((s, i) for _, i, s in found)
        best = [i for i in np.lexsort((np.arange(900), gaps)) if i != q][:10]
        hits += len(set(best) & {i for _, i, _ in found})
    assert not got and hits >= 0.9 * 90


def test_an_id_with_many_vectors_takes_one_place(spark, small_parts):
    x = sample(300, 8, 5).astype(np.float64)
    rng = np.random.default_rng(6)
    hot = np.concatenate([x[0] + rng.normal(size=(400, 8)) * 1e-3, 3 * x[0] + rng.normal(size=(400, 8)) * 1e-3])
    rows = [*enumerate(x), *((7, v) for v in hot.astype(np.float32).astype(np.float64))]
    ids, all_x = np.array([i for i, _ in rows]), np.array([v for _, v in rows])

    def best(values, k):
        least = {}
        for i, v in zip(ids.tolist(), values.tolist()):
            if i:
                least[i] = min(v, least.get(i, np.inf))
        return sorted(least, key=lambda i: (least[i], i))[:k]

    z = np.floor(256 * all_x.astype(np.float32).astype(np.float64))
    top = [r for r in top_inner.top_products(frame(spark, rows)).collect() if r["query_id"] == 0]
    assert [r["vec_id"] for r in sorted(top, key=lambda r: r["rank"])] == best(-(z @ z[0]), 5)
    near = [r for r in neighbours.nearest(frame(spark, rows)).collect() if r["query_id"] == 0]
    wanted = best(np.sqrt(((all_x - x[0]) ** 2).sum(axis=1)), 10)
    assert len(near) == 10 and len({r["vec_id"] for r in near} & set(wanted)) >= 9
    parts = vectors.packed(vectors.usable(frame(spark, rows), "vec_id", "embedding", lambda v: F.lit(True)), 150)
    assert max(len(r["ids"]) // 8 for r in parts.collect()) < 300


def test_blocks_meet_shards_without_a_join_or_broadcast(spark, monkeypatch):
    monkeypatch.setattr(vectors, "HELD_BLOCKS", 4)
    rows = vectors.usable(frame(spark, enumerate(sample(800, 8, 4))), "vec_id", "embedding", lambda v: F.lit(True))
    shards = kept(vectors.packed(rows, 5), "shards")
    blocks = kept(vectors.packed(rows.filter("id % 10 = 0"), 8), "blocks")
    dealt = vectors.meeting(shards, blocks).withColumn("task", F.spark_partition_id()).select("task", "q_part", "part")
    tasks = {}
    for r in dealt.collect():
        tasks.setdefault(r["task"], []).append((r["q_part"], r["part"]))
    met = []
    for met_rows in tasks.values():
        asked, held = [q for q, _ in met_rows if q is not None], [p for q, p in met_rows if q is None]
        assert [q for q, _ in met_rows] == asked + [None] * len(held)  # blocks come first
        assert len(asked) <= 4 and len(held) <= vectors.TASK_SHARDS
        met += [(q, p) for q in asked for p in held]
    numbers = [[r["part"] for r in x.select("part").collect()] for x in (blocks, shards)]
    assert sorted(met) == sorted((q, p) for q in numbers[0] for p in numbers[1])
    assert sum(map(len, tasks.values())) < len(met) / 2  # a block comes once for several shards
    found = vectors.searched(vectors.meeting(shards, blocks), 5, lambda row, best: None)
    assert not found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "Broadcast" not in plan and "Join" not in plan


def test_files_of_shards_hold_few_rows(spark):
    shards = spark.range(5).coalesce(1).selectExpr("cast(id as int) part", "cast(repeat('x', 1000) as binary) vectors")
    files = kept(shards, "shards", 2).groupBy(F.input_file_name()).count().collect()
    assert sorted(r["count"] for r in files) == [1, 2, 2]
    assert kept(shards, "shards").select(F.input_file_name()).distinct().count() == 1


def test_codes_within_the_radius_are_all_probed():
    x = sample(400, 16, 3).astype(np.float64)
    coder = neighbours.Coder(x)
    codes = coder.codes(x)
    for radius in (0, 3, 5, 9, 14):
        reach = coder.reach(radius, codes.shape[1])
        for q in codes[:20]:
            apart = neighbours.ONES[codes ^ q]
            within = apart.sum(axis=1, dtype=np.int64) <= radius
            probed = np.any([apart[:, j] <= bits for j, bits in enumerate(reach) if bits >= 0], axis=0)
            assert (probed | ~within).all()


def test_odd_vectors(spark):
    good = [(0, [1, 0]), (100, [0, 1]), (3, [1, 1]), (3, [1, 1]), (4, [2, 2])]
    bad = [(5, None), (None, [1, 1]), (200, [None, 1]), (300, [float("nan"), 1]), (6, [float("inf"), 0]), (400, [1, 2, 3])]
    near = neighbours.nearest(frame(spark, good + bad + [(500, [0, 0])])).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in near) == [
        (0, 1, 3), (0, 2, 100), (0, 3, 4), (100, 1, 3), (100, 2, 0), (100, 3, 4)]
    top = top_inner.top_products(frame(spark, good + bad + [(500, [0, 0])])).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in top if r["query_id"] == 0) == [
        (0, 1, 4), (0, 2, 3), (0, 3, 100), (0, 4, 500)]
    for search in (neighbours.nearest, top_inner.top_products):
        assert search(frame(spark, [])).count() == 0
        assert search(frame(spark, [(0, [1, 2])])).count() == 0
        assert search(frame(spark, [(1, [1, 2]), (2, [2, 1])])).count() == 0


def test_queries_share_the_products_of_a_leaf(monkeypatch):
    x = np.random.default_rng(8).normal(size=(4096, 16))
    x[:300] = x[0]  # a leaf of equal vectors
    row = top_inner._build(np.arange(4096), x)
    n_leaves, z = len(row["edges"]) // 8, top_inner._integers(x)
    row |= {"q_vectors": x[::8].tobytes(), "q_floors": np.full(512, -np.inf).tobytes()}
    shapes, products = [], top_inner._products
    monkeypatch.setattr(top_inner, "_products", lambda a, b: shapes.append((len(a), len(b))) or products(a, b))
    monkeypatch.setattr(top_inner, "SCORES", 1 << 15)
    best = vectors.Best(np.arange(0, 4096, 8), 5)
    top_inner._search(5)(row, best)
    scores = z[::8] @ z.T
    scores[np.arange(512), np.arange(0, 4096, 8)] = -np.inf
    assert (best.ids == np.argsort(-scores, axis=1, kind="stable")[:, :5]).all()
    assert (-best.values == -np.sort(-scores, axis=1)[:, :5]).all()
    assert sum(a * b for a, b in shapes) / (1 << 15) + n_leaves * 8 > len(shapes)
    assert all(a * b <= 1 << 15 for a, b in shapes)


def test_products_beyond_doubles_stay_exact():
    a = np.array([[2.0**40 + 1, 3.0]])
    b = np.array([[2.0**20 + 1, 5.0]])
    assert int(top_inner._products(a, b)[0, 0]) == (2**40 + 1) * (2**20 + 1) + 15
