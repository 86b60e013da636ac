"""Samples by smallest hashes, and the buckets of words against a plain recomputation."""

import random
import re

import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from lendmark.llm import pii, quality, samples
from lendmark.llm.text import words

RUNS = re.compile(rb"[a-z\x80-\xff]+|[A-Z]+|[0-9]+|(.)\1*")


def test_the_smallest_hashes_are_taken_whatever_the_partitions_and_the_sieve(spark):
    rows = spark.range(5000).withColumn("x", F.col("id") % 50)
    got = [sorted(r["id"] for r in samples.smallest_hashes(rows.repartition(n), 100, "id", seed=2).collect()) for n in (1, 7)]
    plain = rows.orderBy(F.xxhash64(F.lit(2), "id")).limit(100).collect()
    assert got[0] == got[1] == sorted(r["id"] for r in plain)
    assert samples.smallest_hashes(rows, 9000, "id").count() == 5000
    assert samples.smallest_hashes(rows.filter("id < 0"), 5, "id").count() == 0
    # a claimed size far beyond the rows, as if most of them were copies: the sieve lets too few through
    assert samples.smallest_hashes(rows, 100, "id", total=10**12).count() == 100


def plain_buckets(word):
    lower = word.decode("utf-8", "replace").lower().encode("utf-8", "replace") if not word.isascii() else word.lower()
    kinds = []
    for m in RUNS.finditer(word):
        c = m[0][0]
        kinds.append(b"a" if 97 <= c <= 122 or c >= 128 else b"A" if 65 <= c <= 90 else b"9" if 48 <= c <= 57 else m[0][:3])
    return [xxhash.xxh3_64_intdigest(lower) % quality.WORDS, quality.WORDS + xxhash.xxh3_64_intdigest(b"s" + b"".join(kinds)) % quality.SHAPES]


def test_buckets_equal_a_plain_recomputation():
    rng = random.Random(3)
    texts = [" ".join("".join(rng.choices("abAB12.,---é中İ_", k=rng.randint(1, 90))) for _ in range(60)) for _ in range(20)]
    found = words(pa.array([*texts, "", None]), cut=True)
    expected = [plain_buckets(v) for v in found.values.to_pylist()]
    assert quality._value_buckets(found).tolist() == expected
    assert quality._value_buckets(words(pa.array(["", None]))).shape == (0, 2)


def test_features_read_whole_words():
    head = "ab12-" * 60
    text = f"call {head}555 or {head}AAA now"
    spans = [(m.start(), m.end()) for m in re.finditer(r"\S+", text)]
    a, b = pii.island_features(text, spans)[[1, 3]]
    assert len(head) > 200 and (a[1:4] != b[1:4]).any()  # they differ behind their first 200 characters
    assert pii.shape("x" * 5000) == ("a20", "a")


def test_copies_and_long_texts_do_not_fill_the_labelled_sample(spark):
    rows = [(f"reach me at user{k}@mail.example or 10.0.0.{k}",) for k in range(40)]
    rows += [("copied text with 12345 in it",)] * 5000 + [(" ".join(f"n{k} {k}," for k in range(4000)),)]
    frame = spark.createDataFrame(rows, "text string").repartition(5)
    taken = [sorted(r["text"] for r in pii.labelled_sample(frame, 30).collect()) for _ in range(2)]
    assert taken[0] == taken[1] and len(taken[0]) == len(set(taken[0])) == 30
    assert pii.labelled_sample(frame, 1000).count() == 42
