"""Near duplicates by bottom-k sketches of one hash function.

1. A document's set of word shingles becomes 64-bit hashes. Documents with equal
   sets are one node, whatever their ids; nodes are numbered.
2. A node retains the ``K`` smallest hashes. Of two sets with a similarity of
   0.8, the ``K`` smallest of the union are shared with probability 0.8 each, so
   fewer than ``OVERLAP`` shared ones have a chance below 1e-7. Two sketches
   that share ``OVERLAP`` values also share one among the ``len - OVERLAP + 1``
   rarest of each. Only these are entered into inverted lists, so a passage that
   very many documents hold hardly ever makes a list.
3. Of each list, all nodes are first compared with the most typical one. Lists
   that these links don't join are compared further: short ones pair by pair
   (each pair in one list only), long ones in blocks inside tasks.
4. Sizes and the estimate from the sketch of the union filter pairs, and the
   intersection of the full sets decides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendmark.llm.components import components
from lendmark.llm.scratch import kept
from lendmark.llm.text import chunks, words

K = 40
OVERLAP = 17
SHORT_LIST = 128
BLOCK_NODES = 512
BLOCK_HASHES = 1_000_000
PERCENT = 80

ODD = np.random.default_rng(40).integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def shingle_sets(column: pa.Array, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each row; fewer words than ``size`` are one shingle."""
    found = words(column, lower=True)
    hashes, bounds = found.hashes, found.bounds.tolist()
    windows = np.zeros(max(len(hashes) - size + 1, 0), dtype=np.uint64)
    for k in range(size):
        windows += mixed(hashes[k : k + len(windows)] + ODD[k]) * ODD[k]
    windows = mixed(windows)
    sets = []
    for a, b in zip(bounds, bounds[1:]):
        if b - a >= size:
            own = windows[a : b - size + 1]
        elif b > a:
            part = mixed(hashes[a:b] + ODD[: b - a]) * ODD[: b - a]
            own = mixed(part.sum(keepdims=True) + ODD[32 + b - a])
        else:
            own = windows[:0]
        sets.append(np.unique(own.view(np.int64)))
    return sets


def _arrays(sets: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
    values = np.concatenate(sets) if sets else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int64()))


def sketches(documents: DataFrame, size: int) -> DataFrame:
    """``doc_id, key, n, set_key, sketch`` per row of ``doc_id, key, text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                sets = shingle_sets(part.column("text"), size)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("key"), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                     _arrays([s[:K] for s in sets])],
                    ["doc_id", "key", "n", "set_key", "sketch"],
                )

    return documents.mapInArrow(run, "doc_id long, key long, n long, set_key binary, sketch array<long>")


def full_sets(documents: DataFrame, size: int) -> DataFrame:
    """``id, hashes`` per row of ``id, set_key, text`` whose set has this key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                sets, wanted = shingle_sets(part.column("text"), size), part.column("set_key").to_pylist()
                right = np.array([xxhash.xxh3_128_digest(s.tobytes()) == w for s, w in zip(sets, wanted)], dtype=bool)
                rows = pa.RecordBatch.from_arrays([part.column("id"), _arrays(sets)], ["id", "hashes"])
                yield rows if right.all() else rows.filter(pa.array(right))

    return documents.mapInArrow(run, "id long, hashes array<long>")


def inverted_lists(nodes: DataFrame) -> DataFrame:
    """``value, id, typical``: the retained values of each node that can meet those of a similar one.

    Values that only one node retains count as its rarest, so most nodes enter no list.
    """
    slots = F.when(F.size("sketch") >= K, K - OVERLAP + 1).otherwise(
        F.size("sketch") - F.least(F.lit(OVERLAP), F.ceil(F.size("sketch") * PERCENT / 100)) + 1
    )
    flat = nodes.select("id", (slots - F.size("sketch")).cast("int").alias("short"), F.explode("sketch").alias("value"))
    often = flat.groupBy("value").count().filter("count > 1")
    own = Window.partitionBy("id")
    shared = flat.join(often, "value").select(
        "value", "id", "short",
        F.count("*").over(own).alias("n_shared"),
        F.sum("count").over(own).alias("typical"),
        F.row_number().over(own.orderBy("count", "value")).alias("place"),
    )
    # slots left after the values that are its own: slots - (len - n_shared)
    return shared.filter("place <= short + n_shared").select("value", "id", "typical")


def _similar(common: Column, a: Column, b: Column) -> Column:
    return 100 * common >= PERCENT * (a + b - common)


def _filtered(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs ``a, b`` whose sizes and union sketch allow a link."""

    def side(name: str) -> DataFrame:
        return nodes.select(F.col("id").alias(name), F.col("n").alias(f"n_{name}"), F.col("sketch").alias(f"s_{name}"))

    both = pairs.join(side("a"), "a").filter(F.col("n_a") > 0).join(side("b"), "b")
    both = both.filter((100 * F.least("n_a", "n_b") >= PERCENT * F.greatest("n_a", "n_b")))
    union = F.slice(F.array_sort(F.array_union("s_a", "s_b")), 1, K)
    common = F.size(F.array_intersect(F.array_intersect(union, F.col("s_a")), F.col("s_b")))
    needed = F.least(F.lit(OVERLAP), F.ceil(F.size(union) * PERCENT / 100))
    return both.filter(common >= needed).select("a", "b")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs whose full sets are similar."""
    both = pairs.join(sets.select(F.col("id").alias("a"), F.col("hashes").alias("h_a")), "a")
    both = both.join(sets.select(F.col("id").alias("b"), F.col("hashes").alias("h_b")), "b")
    common = F.size(F.array_intersect("h_a", "h_b"))
    return both.filter(_similar(common, F.size("h_a"), F.size("h_b"))).select("a", "b").distinct()


def _pair(x: str, y: str) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _star_pairs(lists: DataFrame) -> DataFrame:
    """Each node of a list with the list's most typical node."""
    top = lists.groupBy("value").agg(F.max(F.struct("typical", (-F.col("id")).alias("minus"))).alias("top"))
    joined = lists.join(top, "value").withColumn("leader", -F.col("top.minus"))
    return joined.filter("id <> leader").select(*_pair("id", "leader")).distinct()


def _short_list_pairs(entries: DataFrame) -> DataFrame:
    """Pairs of different components in short lists; a pair that shares several lists is taken in one."""
    own = entries.groupBy("id").agg(F.array_sort(F.collect_set("value")).alias("values"))  # at most K
    left = entries.join(own, "id").select("value", "id", "root", "n", "values")
    right = left.select(*(F.col(c).alias(f"{c}_2") for c in left.columns))
    near = 100 * F.least("n", "n_2") >= PERCENT * F.greatest("n", "n_2")
    once = F.array_min(F.array_intersect("values", "values_2")) == F.col("value")
    apart = (F.col("id") < F.col("id_2")) & (F.col("root") != F.col("root_2"))
    return left.join(right, (F.col("value") == F.col("value_2")) & apart & near & once).select(*_pair("id", "id_2"))


def _common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of two blocks of sets."""
    all_left, all_right = np.concatenate(left), np.concatenate(right)
    both = np.intersect1d(all_left, all_right)
    out = np.zeros((len(left), len(right)), dtype=np.float32)
    row_l = np.repeat(np.arange(len(left)), [len(s) for s in left])
    row_r = np.repeat(np.arange(len(right)), [len(s) for s in right])
    at_l, at_r = np.searchsorted(both, all_left), np.searchsorted(both, all_right)
    for start in range(0, len(both), 4096):
        stop = min(start + 4096, len(both))
        dense = []
        for values, at, rows, n in ((all_left, at_l, row_l, len(left)), (all_right, at_r, row_r, len(right))):
            use = (at >= start) & (at < stop)
            use[use] = both[at[use]] == values[use]
            matrix = np.zeros((n, stop - start), dtype=np.float32)
            matrix[rows[use], at[use] - start] = 1
            dense.append(matrix)
        out += dense[0] @ dense[1].T
    return out


def _joining(ids: np.ndarray, roots: np.ndarray, found: np.ndarray) -> list[tuple[int, int]]:
    """Of the found pairs (rows of two places) those that join components not joined before."""
    above: dict[int, int] = {}

    def top(x: int) -> int:
        while above.get(x, x) != x:
            above[x] = above.get(above[x], above[x])
            x = above[x]
        return x

    out = []
    for i, j in found.tolist():
        x, y = top(int(roots[i])), top(int(roots[j]))
        if x != y:
            above[max(x, y)] = min(x, y)
            out.append((int(ids[i]), int(ids[j])))
    return out


def _compare_blocks(table: pa.Table) -> pa.Table:
    """Links between two blocks (sides 0 and 1), or within one (side 0 only)."""
    ids, roots = table["id"].to_numpy(), table["root"].to_numpy()
    side = table["side"].to_numpy()
    data, offsets = table["hashes"].combine_chunks(), None
    if isinstance(data, pa.ChunkedArray):
        data = data.chunk(0)
    values, offsets = data.values.to_numpy(), data.offsets.to_numpy()
    sets = [values[a:b] for a, b in zip(offsets[:-1], offsets[1:])]
    left = np.flatnonzero(side == 0)
    right = np.flatnonzero(side == 1) if side.any() else left
    pairs: list[tuple[int, int]] = []
    if len(left) and len(right):
        sizes = np.array([len(s) for s in sets], dtype=np.float64)
        common = _common([sets[i] for i in left], [sets[i] for i in right]).astype(np.float64)
        union = sizes[left][:, None] + sizes[right][None, :] - common
        linked = (100 * common >= PERCENT * union) & (roots[left][:, None] != roots[right][None, :])
        i, j = np.nonzero(linked)
        pairs = _joining(ids, roots, np.stack([left[i], right[j]], axis=1))
    return pa.table({"a": pa.array([min(p) for p in pairs], pa.int64()), "b": pa.array([max(p) for p in pairs], pa.int64())})


def _block_links(entries: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between different components that share a long list, compared in blocks inside tasks.

    Nodes that long lists connect are a family. Its nodes are dealt into blocks
    by size class and hash, those of its largest component apart from the
    others. Two blocks of the same or the next size class meet in one task,
    unless both are of the largest component; a task returns no more links than
    it has nodes.
    """
    hubs = entries.groupBy("value").agg(F.min("id").alias("hub"))
    families = components(entries.join(hubs, "value").select(F.col("id").alias("a"), F.col("hub").alias("b")))
    families = families.select(F.col("node").alias("id"), F.col("root").alias("family"))
    members = entries.select("id", "root", "n").distinct().join(families, "id")
    totals = members.groupBy("family", "root").count().groupBy("family")
    largest = totals.agg(F.max_by("root", F.struct("count", "root")).alias("largest"))
    band = F.floor(F.log("n") / np.log(100 / PERCENT)).cast("int")
    members = members.join(largest, "family").select(
        "id", "root", "family", (F.col("root") == F.col("largest")).cast("int").alias("main"), band.alias("band"), "n"
    )
    blocks = members.groupBy("family", "main", "band").agg(
        F.greatest(F.ceil(F.count("*") / BLOCK_NODES), F.ceil(F.sum("n") / BLOCK_HASHES)).alias("n_blocks")
    )
    members = kept(
        members.join(blocks, ["family", "main", "band"]).withColumn(
            "block", F.xxhash64("family", "main", "band", F.pmod(F.xxhash64("id"), "n_blocks"))
        ),
        "members",
    )
    found = members.groupBy("block").agg(F.first("family").alias("family"), F.first("main").alias("main"), F.first("band").alias("band"))
    other = found.select(*(F.col(c).alias(f"{c}_2") for c in found.columns))
    pairs = found.join(
        other,
        (F.col("family") == F.col("family_2"))
        & (F.abs(F.col("band") - F.col("band_2")) <= 1)
        & (F.col("main") + F.col("main_2") < 2)
        & (F.col("block") <= F.col("block_2")),
    ).select(F.col("block").alias("left"), F.col("block_2").alias("right"))
    rows = members.select("id", "root", "block").join(sets, "id")
    left = rows.join(pairs, rows["block"] == pairs["left"]).select("left", "right", F.lit(0).alias("side"), "id", "root", "hashes")
    right = rows.join(pairs.filter("left <> right"), rows["block"] == F.col("right")).select(
        "left", "right", F.lit(1).alias("side"), "id", "root", "hashes"
    )
    return left.unionByName(right).groupBy("left", "right").applyInArrow(_compare_blocks, "a long, b long")


def _keyed(documents: DataFrame, id_column: str, text_column: str) -> list[Column]:
    """The id (or null), a hash of id and text, and the text."""
    doc_id, text = F.col(f"`{id_column}`").cast("long"), F.col(f"`{text_column}`")
    return [doc_id.alias("doc_id"), F.xxhash64(doc_id, text).alias("key"), text.alias("text")]


def _rooted(source: DataFrame, shingle_words: int) -> DataFrame:
    """``doc_id, key, n, root, least`` per row of ``doc_id, key, text``.

    ``root`` is the number of the component, null without words; ``least`` its smallest id.
    """
    rows = kept(sketches(source, shingle_words), "sketches")
    nodes = rows.filter("n > 0").groupBy("set_key").agg(
        F.min("doc_id").alias("least"), F.min("key").alias("key"), F.first("n").alias("n"), F.first("sketch").alias("sketch")
    )
    nodes = kept(nodes.withColumn("id", F.monotonically_increasing_id()), "nodes")  # the numbers are fixed once written
    named = nodes.select("id", "n", "sketch")
    lists = kept(inverted_lists(named), "lists")
    involved = nodes.join(lists.select("id").distinct(), "id").select("key", "id", "set_key")
    texts = source.select("key", "text").join(involved, "key").select("id", "set_key", "text")
    sets = kept(full_sets(texts, shingle_words).distinct(), "sets")

    links = kept(_verified(_filtered(_star_pairs(lists), named), sets), "links")
    roots = components(links)
    entries = lists.select("value", "id").join(roots.withColumnRenamed("node", "id"), "id", "left")
    entries = entries.withColumn("root", F.coalesce("root", "id")).join(named.select("id", "n"), "id")
    mixed = entries.groupBy("value").agg(F.count("*").alias("entries"), F.min("root").alias("lo"), F.max("root").alias("hi"))
    entries = kept(entries.join(mixed.filter("lo <> hi").select("value", "entries"), "value"), "entries")
    short = entries.filter(F.col("entries") <= SHORT_LIST).drop("entries")
    more = _verified(_filtered(_short_list_pairs(short), named), sets)
    long = entries.filter(F.col("entries") > SHORT_LIST).drop("entries")
    if not long.isEmpty():
        more = more.unionByName(_block_links(long, sets))
    final = components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more))

    of_set = nodes.select("set_key", "id", "least").join(final.withColumnRenamed("node", "id"), "id", "left")
    of_set = of_set.select("set_key", F.coalesce("root", "id").alias("root"), "least")
    least = of_set.groupBy("root").agg(F.min("least").alias("least"))
    of_set = of_set.select("set_key", "root").join(least, "root")
    return rows.select("doc_id", "key", "n", "set_key").join(of_set, "set_key", "left").drop("set_key")


def find(
    documents: DataFrame, shingle_words: int = 4, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` per row.

    A-Z are lower-cased; words are separated by ASCII blanks. Fewer words than
    ``shingle_words`` are one shingle; a text without words (or null) has none
    and is linked with nothing. Links need a similarity of 0.8 or more.
    ``component_id`` is the smallest id reachable, and a row is ``kept`` if it
    has this id.

    Repeated rows share their fate; different texts of one id are documents of
    their own, so an id alone links nothing. A row without an id takes part, but
    never names a component (null if nobody in it has an id) and is always kept.
    Any long is an id. Other columns are not read.
    """
    rooted = _rooted(documents.select(*_keyed(documents, id_column, text_column)), shingle_words)
    component = F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id"))
    return rooted.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        (F.col("doc_id").isNull() | (component == F.col("doc_id"))).alias("kept"),
    )


def representatives(
    documents: DataFrame, shingle_words: int = 5, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """The rows, with all their columns, of one document of each group: that of the smallest id.

    A document is an id with a text: different texts of one id are groups of
    their own unless they are similar. Of rows equal in both one stays; rows
    without an id stand behind all that have one. Rows without words are all kept.
    """
    doc_id, key, text = _keyed(documents, id_column, text_column)
    row = F.struct(*(F.col(f"`{c}`") for c in documents.columns)).alias("row")
    rooted = kept(_rooted(documents.select(doc_id, key, text), shingle_words), "rooted").filter("n > 0")
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "key")
    first = rooted.groupBy("root").agg(F.min(order).alias("first")).select("first.doc_id", "first.key")
    first = first.select(F.col("doc_id").alias("first_id"), F.col("key").alias("first_key"))
    wordy = F.coalesce(F.col(f"`{text_column}`").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    left = documents.filter(wordy).select(doc_id, key, row)
    left = left.join(first, (F.col("key") == F.col("first_key")) & F.col("doc_id").eqNullSafe(F.col("first_id")), "left_semi")
    if not rooted.groupBy("doc_id", "key").count().filter("count > 1").isEmpty():
        left = left.groupBy("doc_id", "key").agg(F.first("row").alias("row"))
    left = left.select("row").unionByName(documents.filter(~wordy).select(row))
    return left.select(*(F.col(f"row.`{c}`").alias(c) for c in documents.columns))
