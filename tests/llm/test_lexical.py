"""Ranked search against a plain recomputation of every score."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from lendmark.llm import lexical

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}
QUERY = "item_id long, text string, query int, rank string"


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(rows, queries, k=20):
    held = [(i, Counter(terms(t)), len(terms(t))) for i, t in rows]
    held = [h for h in held if h[2]]
    n_docs, length = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in dict.fromkeys(queries):
        found = []
        for doc, counts, n in held:
            m = 100 - 25 + (25 * n * n_docs) // length
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * counts[t]) // (1000 * counts[t] + 12 * m))
                for t in terms(text)
                if counts[t]
            )
            if score > 0:
                found.append((-score, doc is None, doc or 0, doc))
        out += [(item, r + 1, d, -s) for r, (s, _, _, d) in enumerate(sorted(found, key=lambda f: f[:3])[:k])]
    return sorted(out, key=str)


def corpus(seed, n):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(300)] + ["ÜBER", "naïve", "中文", "İx", "a-b", "U.S.", "x_y"]
    weights = [1 / (k + 1) for k in range(len(vocabulary))]
    return [(k, " ".join(rng.choices(vocabulary, weights, k=rng.choice([1, 5, 60, 400])))) for k in range(n)]


def got(spark, docs, rows, queries, **options):
    frame = spark.createDataFrame([(i, t, 1, "x") for i, t in queries], QUERY)
    found = lexical.search(docs(rows), frame, **options)
    return sorted(((r["query_id"], r["rank"], r["doc_id"], r["score"]) for r in found.collect()), key=str)


@pytest.mark.parametrize("coordinates", [1024, 5, 1])
def test_scores_equal_brute_force_whatever_the_sketch(spark, docs, monkeypatch, coordinates):
    monkeypatch.setattr(lexical, "FIRST_LOOK", 3)
    monkeypatch.setattr(lexical, "BATCH", 50)
    rows = corpus(1, 240)
    rows += [(1000 + k, rows[k % 3][1]) for k in range(60)]  # copies: ties
    queries = [(k, t) for k, t in corpus(2, 14)] + [(20, "w1 w1 w1 W2"), (21, "absent terms only"), (22, "")]
    assert got(spark, docs, rows, queries, coordinates=coordinates) == brute(rows, queries)


def test_blocks_of_queries_give_the_same(spark, docs, monkeypatch):
    monkeypatch.setattr(lexical, "BLOCK_BYTES", 300)
    rows, queries = corpus(3, 80), corpus(4, 6)
    assert got(spark, docs, rows, queries, k=7) == brute(rows, queries, 7)


def test_bounds_are_never_below_the_score():
    rows = corpus(5, 60)
    column = pa.array([t for _, t in rows])
    queries = lexical.Queries.of([0, 1], ["w1 w2 w3 ÜBER", "w9 w9 w250"])
    queries.weigh(60, sum(len(terms(t)) for _, t in rows), np.full(len(queries.vocabulary), 3))
    for coordinates in (3, 64):
        index = lexical._Index(lexical.terms(column), queries, coordinates)
        spots = [lexical.xxhash.xxh3_64_intdigest(v, 13) % coordinates for v in queries.vocabulary.to_pylist()]
        for q in range(2):
            own = range(queries.bounds[q], queries.bounds[q + 1])
            bound = sum(index.sketches[:, spots[queries.codes[i]]] * queries.weights[queries.codes[i]] * queries.times[i] for i in own)
            exact = index.scores(np.arange(60), np.full(60, q), queries)
            assert (bound >= exact).all() and exact.max() > 0


def test_odd_rows(spark, docs):
    long = "w1 " * 150_000 + "z" * 300_000
    rows = [(None, "w1 w2"), (5, long), (5, "w1"), (5, "w1"), (6, None), (7, ""), (8, "--- ..."), (-3, "W1, w2; w3"), (None, "w2")]
    queries = [(1, "w1 w2"), (1, "w1 w2"), (1, "w3"), (None, "w2"), (2, None), (3, "z" * 300_000)]
    assert got(spark, docs, rows, queries) == brute(rows, queries)
    assert got(spark, docs, [], queries) == [] and got(spark, docs, rows, []) == []
    assert got(spark, docs, [(1, None), (2, "..")], queries) == []
