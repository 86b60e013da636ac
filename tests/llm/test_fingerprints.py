"""Invertible sketches against plain sets, and the chain of edited texts against a plain loop."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lendmark.llm import fingerprints


def prose(rng, n):
    return "".join(rng.choice(["alpha ", "beta ", "gamma, ", "delta\n", "é", "中文字", "x1 ", f"w{rng.randrange(999)} "]) for _ in range(n))


def edited(text, following):
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def chain(rows):
    """Expected order of (id, text), and each one's edited text."""
    texts = [t or "" for _, t in rows]
    return [(i, t, edited(t, f)) for (i, _), t, f in zip(rows, texts, texts[1:] + texts[:1])]


def keys_of(text):
    return set(fingerprints.digests(pa.array([text], pa.string())).keys.tolist())


def likeness(a, b):
    a, b = keys_of(a), keys_of(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def test_differences_equal_those_of_sets(spark):
    rng = random.Random(5)
    pairs = []
    for k in range(80):
        a = prose(rng, rng.choice([0, 1, 3, 40, 900]))
        b = rng.choice([a, edited(a, prose(rng, 60)), prose(rng, 30), a + "tail", None])
        pairs.append((k, a, b))
    frame = spark.createDataFrame([(*p, "n") for p in pairs], "k int, old string, new string, cells string")
    rows = {r["k"]: r for r in fingerprints.differences(frame, "old", "new").collect()}
    assert len(rows) == 80
    for k, a, b in pairs:
        a, b = keys_of(a), keys_of(b)
        r = rows[k]
        assert {v % (1 << 64) for v in r["only_old"]} == a - b and {v % (1 << 64) for v in r["only_new"]} == b - a
        assert r["likeness"] == (len(a & b) / len(a | b) if a | b else 1.0)
        assert len(r["only_old"]) == len(a - b) and r["only_old"] == sorted(r["only_old"])
    assert len({r["cells"] for r in rows.values()}) > 2  # some needed larger sketches


def test_repeated_paragraphs_are_digests_of_their_own():
    column = pa.array(["a line\n" * 7, "a line\n" * 4, None, ""])
    found = fingerprints.digests(column)
    assert found.sizes.tolist()[2:] == [0, 0] and len(set(found.keys[found.rows == 0].tolist())) == found.sizes[0]
    diff = fingerprints.changes(found.of(np.array([0])), found.of(np.array([1])))
    assert 0 < diff.likeness[0] < 1 and (diff.sides == 1).all()


def test_cuts_depend_on_their_surroundings_only():
    rng = random.Random(6)
    text = prose(rng, 400)
    whole, behind = keys_of(text), keys_of("some other words before it, " + text)
    assert len(whole & behind) >= 0.9 * len(whole)
    for letters in ("abcdefgh0123", "中文字漢語日本"):  # texts without blanks are cut too
        assert len(keys_of("".join(rng.choices(letters, k=5000)))) > 30


def test_a_sketch_that_is_too_small_is_retried(monkeypatch):
    rng = random.Random(7)
    a, b = (fingerprints.digests(pa.array([prose(rng, 500), "x"])) for _ in range(2))
    for cells in (3, 12, 3000):
        diff = fingerprints.changes(a, b, cells)
        assert diff.cells[0] >= 300 and diff.cells[1] == cells
        own = set(a.keys[a.rows == 0].tolist()), set(b.keys[b.rows == 0].tolist())
        assert set(diff.keys[diff.sides == 1].tolist()) == own[0] - own[1]
        assert set(diff.keys[diff.sides == -1].tolist()) == own[1] - own[0]


@pytest.mark.parametrize("partitions", [1, 7])
def test_chain_equals_a_plain_loop(spark, docs, partitions):
    rng = random.Random(8)
    rows = [(k * 3 - 50, prose(rng, rng.choice([0, 1, 20, 200]))) for k in range(150)]
    rows[10], rows[140] = (rows[10][0], None), (rows[140][0], rows[20][1])
    shuffled = rng.sample(rows, len(rows))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = {r["doc_id"]: r for r in fingerprints.edit_fingerprints(docs(shuffled)).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(got) == 150
    expected = chain(rows)
    following = [t for _, t, _ in expected[1:]] + [expected[0][1]]
    for (i, text, new), after in zip(expected, following):
        r = got[i]
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(new.encode()).hexdigest()
        assert r["near_edited"] == likeness(text, new) and r["near_next"] == likeness(text, after)
    assert got[rows[140][0]]["fingerprint"] == got[rows[20][0]]["fingerprint"]
    assert len({bytes(r["fingerprint"]) for r in got.values()}) == len({t for _, t, _ in expected})
    plain = {r["doc_id"]: r for r in fingerprints.fingerprints(docs(shuffled)).collect()}
    assert all(plain[i]["fingerprint"] == got[i]["fingerprint"] for i in got)


def test_odd_rows(docs):
    one = fingerprints.edit_fingerprints(docs([(4, "ab")])).collect()
    assert [(r["doc_id"], r["n_chars"], r["near_next"]) for r in one] == [(4, 2, 1.0)]
    assert one[0]["edited_sha256"] == hashlib.sha256(b"aa").hexdigest()
    assert fingerprints.edit_fingerprints(docs([])).collect() == []
    long = "lorem ipsum " * 40_000 + "z" * 200_000 + "中" * 100_000
    rows = [(None, "q r s t"), (5, long), (5, long), (5, "other text"), (None, None), (7, ""), (9, "x")]
    got = fingerprints.edit_fingerprints(docs(rows)).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(i for i, _ in rows)
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    assert [r["n_chars"] for r in got].count(len(long)) == 2
    empty = [r for r in got if not r["n_chars"]]
    assert all(r["near_edited"] == 1.0 and r["edited_sha256"] == hashlib.sha256(b"").hexdigest() for r in empty)
    assert fingerprints.fingerprints(docs(rows)).filter(F.col("doc_id").isNull()).count() == 2


def test_a_hot_id_is_spread_over_partitions(spark, docs):
    rows = [(7, f"text number {k} of the same id") for k in range(3000)] + [(8, "the same text")] * 3000
    frame = docs(rows)
    sizes = Counter()
    out = fingerprints.edit_fingerprints(frame)
    assert out.count() == 6000
    order = [F.col("doc_id").isNull(), F.col("doc_id"), F.xxhash64("text")]
    ranged = frame.withColumn("nth", F.monotonically_increasing_id()).repartitionByRange(8, *order, F.col("nth"))
    for r in ranged.groupBy(F.spark_partition_id().alias("p")).count().collect():
        sizes[r["p"]] = r["count"]
    assert len(sizes) == 8 and max(sizes.values()) < 3 * 6000 / 8
