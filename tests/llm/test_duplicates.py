"""Near duplicates and repeated passages, against brute force."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from lendmark.llm import components, near_dups, substrings

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def texts(seed, n=120):
    """Groups of near copies, shared passages, and texts of their own."""
    rng = random.Random(seed)

    def own(k):
        return [f"{rng.choice('abcdefgh')}{rng.randint(0, 400)}" for _ in range(k)]

    passage, out = own(30), []
    for _ in range(n // 6):
        base = own(rng.choice([2, 5, 40, 120]))
        for _ in range(4):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 2, 5])):
                copy[rng.randrange(len(copy))] = own(1)[0]
            out.append(" ".join(copy))
        out.append(" ".join(own(20) + passage + own(rng.choice([1, 40]))))
        out.append("\n".join(own(50)).upper())
    rng.shuffle(out)
    return out


def brute_components(rows, size):
    sets = {}
    for i, t in rows:
        w = words((t or "").translate({c: c + 32 for c in range(65, 91)}))
        sets[i] = {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = top(a), top(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), top(i), top(i) == i) for i in sets}


@pytest.mark.parametrize("short_list", [128, 3])
def test_components_equal_brute_force_on_both_ways_of_comparing(docs, monkeypatch, short_list):
    monkeypatch.setattr(near_dups, "SHORT_LIST", short_list)
    rows = list(enumerate(texts(short_list)))
    rows += [(900, None), (901, ""), (902, " \n"), (903, "w " * 30_000), (904, "w " * 29_000)]
    found = {r[0]: tuple(r[1:]) for r in near_dups.find(docs(rows)).collect()}
    assert found == brute_components(rows, 4)


def test_block_comparison_finds_links_across_blocks(docs, monkeypatch):
    monkeypatch.setattr(near_dups, "SHORT_LIST", 1)
    monkeypatch.setattr(near_dups, "BLOCK_NODES", 4)
    rows = list(enumerate(texts(77, 60)))
    found = {r[0]: tuple(r[1:]) for r in near_dups.find(docs(rows)).collect()}
    assert found == brute_components(rows, 4)


def test_near_duplicates_of_odd_rows(docs):
    same = "one two three four five six seven"
    rows = [(4, same), (4, same), (2, same.upper()), (None, same), (None, "quite another text without an id"), (7, "short")]
    got = near_dups.find(docs(rows)).collect()
    assert sorted(((r["doc_id"], r["component_id"], r["kept"]) for r in got), key=repr) == sorted(
        [(4, 2, False), (4, 2, False), (2, 2, True), (None, 2, True), (None, None, True), (7, 7, True)], key=repr
    )
    assert near_dups.find(docs([])).count() == 0
    left = near_dups.representatives(docs(rows))
    assert left.columns == docs([]).columns
    assert sorted((r["doc_id"], r["text"]) for r in left.collect() if r["doc_id"]) == [(2, same.upper()), (7, "short")]


def test_different_texts_of_one_id_are_all_kept(docs):
    a, b, c = (" ".join(f"{x}{k}" for k in range(40)) for x in "abc")
    rows = [(0, a), (0, b), (0, c), (0, c), (5, a + " end"), (6, b + " end"), (None, None), (None, None), (0, ""), (None, c)]
    left = near_dups.representatives(docs(rows)).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in left), key=repr) == sorted(
        [(0, a), (0, b), (0, c), (None, None), (None, None), (0, "")], key=repr
    )
    apart = near_dups.representatives(docs([(9, a), (9, b), (5, a + " end"), (6, b + " end")])).collect()
    assert sorted(r["doc_id"] for r in apart) == [5, 6]


def test_any_long_is_an_id(docs):
    same, big = "one two three four five six seven", 1 << 62
    rows = [(big + 5, same), (big + 3, same), (2 * big - 1, "of its own and long enough"), (None, same), (-2 * big, "x")]
    got = near_dups.find(docs(rows)).collect()
    assert {(r["doc_id"], r["component_id"], r["kept"]) for r in got} == {
        (big + 5, big + 3, False), (big + 3, big + 3, True), (2 * big - 1, 2 * big - 1, True),
        (None, big + 3, True), (-2 * big, -2 * big, True)}


def test_components_of_a_chain_a_star_and_nothing(spark):
    chain = [(i, i + 1) for i in range(200)] + [(500, 500 + i) for i in range(1, 50)] + [(None, 3), (9, 9)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(201)} | {500 + i: 500 for i in range(50)}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_removal(rows, width):
    seen, out = set(), {}
    for i, t in sorted(rows):
        w = words(t)
        covered = [False] * len(w)
        for k in range(len(w) - width + 1):
            key = tuple(w[k : k + width])
            if key in seen:
                covered[k : k + width] = [True] * width
            seen.add(key)
        left = " ".join(x for x, c in zip(w, covered) if not c)
        out[i] = (len(w), sum(covered), hashlib.sha256(left.encode()).hexdigest())
    return out


@pytest.mark.parametrize("block", [600_000, 200])
def test_removal_equals_brute_force_with_one_block_and_many(docs, monkeypatch, block):
    monkeypatch.setattr(substrings, "BLOCK_WINDOWS", block)
    monkeypatch.setattr(substrings, "SHARD_BYTES", 4000)
    rows = list(enumerate(texts(5, 90)))
    rows += [(900, None), (901, ""), (902, "again and " * 700), (903, "again and " * 5), (904, "é à " * 40)]
    got = {r[0]: tuple(r[1:4]) for r in substrings.removal_digests(docs(rows).repartition(3)).collect()}
    assert got == brute_removal(rows, 20)


def test_texts_whose_short_hashes_agree_stay_apart(spark, docs):
    words_of = " ".join(f"w{k}x', id, 'y" for k in range(25))
    made = spark.range(150_000).selectExpr(f"concat('{words_of}') AS text")
    low = F.xxhash64("text").bitwiseAND(0xFFFFFFFF)
    pair = made.groupBy(low.alias("h")).agg(F.collect_list("text").alias("t")).filter(F.size("t") > 1).first()["t"][:2]
    rows = [(1, "a text of its own"), (7, pair[0]), (7, pair[1]), (None, pair[0]), (None, pair[1] + " more")]
    got = sorted(((r["doc_id"], r["n_words"], r["n_removed"]) for r in substrings.removal_digests(docs(rows)).collect()), key=repr)
    assert got == sorted([(1, 5, 0), (7, 25, 0), (7, 25, 0), (None, 25, 25), (None, 26, 25)], key=repr)
    left = sorted(r["text"] for r in substrings.without_duplicates(docs(rows)).collect())
    assert left == sorted(["a text of its own", *pair, "", "more"])


def test_the_largest_long_is_an_id(docs):
    long, last = " ".join(f"w{i}" for i in range(30)), (1 << 63) - 1
    rows = [(last, long), (None, long), (-last - 1, "z " + long[:-4])]
    got = {(r["doc_id"], r["n_removed"]) for r in substrings.removal_digests(docs(rows)).collect()}
    assert got == {(last, 29), (None, 30), (-last - 1, 0)}


def spans_of(frame):
    return sorted(tuple(r) for r in frame.collect())


@pytest.mark.parametrize("block", [600_000, 10])
def test_factors_are_extended_to_the_longest_match(docs, monkeypatch, block):
    monkeypatch.setattr(substrings, "BLOCK_WINDOWS", block)
    w = [f"w{i}" for i in range(60)]
    rows = [(1, " ".join(w[:30])), (2, " ".join(w)), (3, " ".join(w))]
    assert spans_of(substrings.duplicate_spans(docs(rows).coalesce(1))) == [(2, 0, 30, 1, 0), (3, 0, 60, 2, 0)]
    # the middle stands in document 1, all of it in document 2
    rows = [(1, "x " + " ".join(w[15:45])), (2, "y y " + " ".join(w)), (3, " ".join(w) + " z")]
    assert spans_of(substrings.duplicate_spans(docs(rows).coalesce(1))) == [(2, 17, 30, 1, 1), (3, 0, 60, 2, 2)]


def test_a_factor_behind_another_starts_where_that_one_ends(docs):
    w = [f"w{i}" for i in range(60)]
    rows = [(1, " ".join(w[:30])), (2, " ".join(w[15:45])), (3, " ".join(w))]
    assert spans_of(substrings.duplicate_spans(docs(rows))) == [(3, 0, 30, 1, 0), (3, 30, 15, 2, 15)]


def test_versions_of_a_text_are_one_factor_of_the_version_before(docs):
    versions, w = [], [f"w{i}" for i in range(200)]
    for k in range(5):
        w = list(w)
        w[30 + 30 * k] = f"new{k}"
        versions.append(w)
    rows = [(k, " ".join(v)) for k, v in enumerate(versions)] + [(9, " ".join(versions[-1]))]
    got = [s for s in spans_of(substrings.duplicate_spans(docs(rows))) if s[0] == 9]
    assert got == [(9, 0, 200, 4, 0)]


def test_matches_are_followed_over_many_borders(docs):
    w = [f"w{i}" for i in range(400)]
    rows = [(k, " ".join(w[20 * k : 20 * k + 40])) for k in range(9)]  # each overlaps the next one
    rows += [(50, " ".join(w[:200] + ["own"])), (60, "y " + " ".join(w[:200] + ["own"]) + " z")]
    got = [s for s in spans_of(substrings.duplicate_spans(docs(rows))) if s[0] == 60]
    assert sum(s[2] for s in got) == 201 and len(got) <= 3 and got[-1][3] == 50 and got[-1][2] >= 140


@pytest.mark.parametrize("block", [600_000, 60])
def test_factors_are_true_matches_and_cover_what_is_removed(docs, monkeypatch, block):
    monkeypatch.setattr(substrings, "BLOCK_WINDOWS", block)
    monkeypatch.setattr(substrings, "SHARD_BYTES", 2000)
    rows = list(enumerate(texts(11, 60))) + [(900, "again and " * 300), (901, "again and " * 40)]
    split = {i: words(t) for i, t in rows}
    removed = {r["doc_id"]: r["n_removed"] for r in substrings.removal_digests(docs(rows).repartition(3)).collect()}
    covered = {i: 0 for i in split}
    end = {}
    for doc, start, length, ref, ref_start in spans_of(substrings.duplicate_spans(docs(rows).repartition(3))):
        assert split[doc][start : start + length] == split[ref][ref_start : ref_start + length]
        assert (ref, ref_start) < (doc, start) and start >= end.get(doc, 0)
        end[doc] = start + length
        covered[doc] += length
    assert covered == removed


def test_removal_of_odd_rows(docs):
    long = " ".join(f"w{i}" for i in range(30))
    rows = [(3, long), (3, long), (None, long), (1, "x " + long), (5, "short text")]
    got = sorted(((r["doc_id"], r["n_removed"]) for r in substrings.removal_digests(docs(rows)).collect()), key=repr)
    assert got == sorted([(3, 30), (3, 30), (None, 30), (1, 0), (5, 0)], key=repr)
    assert substrings.removal_digests(docs([])).count() == 0
    spans = {tuple(r) for r in substrings.duplicate_spans(docs(rows)).collect()}
    assert (3, 0, 30, 1, 1) in spans and (None, 0, 30, 1, 1) in spans
    kept = substrings.without_duplicates(docs(rows + [(8, None), (9, "a\n b")]))
    assert kept.columns == docs([]).columns
    texts_of = {r["doc_id"]: (r["text"], r["tag"], r["places"], r["row"]) for r in kept.collect()}
    assert texts_of[3] == ("", None, "x", 1) and texts_of[8][0] is None and texts_of[9][0] == "a\n b"


@pytest.mark.parametrize("few", [components.FEW_EDGES, 3])
def test_components_of_few_edges_take_few_jobs(spark, monkeypatch, few):
    monkeypatch.setattr(components, "FEW_EDGES", few)
    rng = random.Random(5)
    edges = [(k, k + 1) for k in range(-40, -1)] + [(rng.randrange(200), rng.randrange(200)) for _ in range(90)]
    root = {x: x for e in edges for x in e if e[0] != e[1]}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = top(a), top(b)
            root[max(x, y)] = min(x, y)
    links = spark.createDataFrame([*edges, (7, None), (None, 8), (2**62, 2**62 + 1)], "a long, b long")
    spark.sparkContext.setJobGroup(f"components {few}", "")
    found = {r["node"]: r["root"] for r in components.components(links).collect()}
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert found == {x: top(x) for x in root} | {2**62: 2**62, 2**62 + 1: 2**62}
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"components {few}"))
    assert jobs <= 8 if few > 200 else jobs > 15
    assert components.components(links.filter("a > 2 and a < 2")).count() == 0
