"""Duplicate passages: windows with earlier occurrences, and relative Lempel-Ziv factors made of them.

A window of ``WINDOW`` words that occurs earlier has a reference: the earliest
start of the same words. Factors grow from there to the longest match.

1. Documents are read in blocks. A block indexes its windows; repeats within the
   block get their reference there, so a window leaves a block once at most.
2. The first occurrences go to the shard of the corpus index that their anchor
   names: the smallest hash among the half-windows inside a window, which equal
   windows share. A shard holds every block's entries and answers those that
   have an earlier one. What a block found itself then follows these answers, so that
   equal windows have equal references: two windows are compared by them.
3. A run of windows whose references run along with them is a match. Where the
   next window has its reference elsewhere, the text of the match may go on all the
   same, if its document took those words from there too: matches are extended over such
   borders on both sides. A border asks by hashes of its next 1, 2, 3, 4, 6, 8, 12, ... and of all
   adjoining runs whether the document it refers to has the same ones.
4. A document is parsed greedily: from a word on, the match that reaches furthest is the
   factor, and the parse goes on behind it. A factor has at least ``WINDOW`` words; behind
   another one it may be shorter, as windows across the border have their reference too.

References are texts that hold the first occurrence of at least one window of the
match; a text that only repeats others is not searched for longer matches. A match that
crosses more than four borders in a row, and ends among further adjoining runs, may be followed
for two thirds of them only, and a run that repeats the one before it, as in "a a a a", asks
nothing. What is removed depends on none of this, as every window of an extension has a reference:
``removal_digests`` and ``without_duplicates`` take the windows alone, ``duplicate_spans`` parses.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendmark.llm.near_dups import mixed
from lendmark.llm.scratch import kept
from lendmark.llm.text import Parts, chunks, words

WINDOW = 20
BLOCK_WINDOWS = 600_000
SHARD_BYTES = 8 << 20
CHECK_BYTES = 5  # of a window's hash, beside the 8 of its anchor
LONGEST_RUN = 255
LAST_ID = (1 << 63) - 1

ODD = np.random.default_rng(20).integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

PAYLOAD = "shard int, docs binary, tags binary, anchors binary, owners binary, starts binary, sizes binary, checks binary, " \
    "local_owners binary, local_places binary, ref_owners binary, ref_places binary"  # fmt: skip
ANSWER = "doc_id long, tag long, place int, size int, ref_doc long, ref_tag long, ref_place int"
RUNS = "runs"
SIDES = "sides"
RUN_FIELDS = ("place", "size", "ref_doc", "ref_tag", "ref_place")
RUN_TYPE = pa.list_(
    pa.struct([("place", pa.int32()), ("size", pa.int32()), ("ref_doc", pa.int64()), ("ref_tag", pa.int64()), ("ref_place", pa.int32())])
)
RUN_SCHEMA = "array<struct<place:int,size:int,ref_doc:bigint,ref_tag:bigint,ref_place:int>>"
BORDER = "key long, doc_id long, tag long, run int, far int"
ENDS = "key long, far_size int"
MULTIPLIER = ODD[60]
INVERSE = np.uint64(pow(int(ODD[60]), -1, 1 << 64))
SLICE = 256


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    out, reach = x, 1
    while reach < width:
        step = min(reach, width - reach)
        out = np.minimum(out[:-step], out[step:])
        reach += step
    return out


def windows(found: Parts, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all windows of the rows: hash, anchor, row and place."""
    half = width // 2
    hashes = found.hashes
    empty = np.empty(0, np.uint64)
    if len(hashes) < width:
        return empty, empty, np.empty(0, np.int32), np.empty(0, np.int32)
    part = np.zeros(len(hashes) - half + 1, dtype=np.uint64)
    for k in range(half):
        part += mixed(hashes[k : k + len(part)] + ODD[k]) * ODD[k]
    part = mixed(part)
    n = len(hashes) - width + 1
    whole = mixed(part[:n] * ODD[40] + part[width - half : width - half + n] * ODD[41])
    if width > 2 * half:
        whole = mixed(whole + hashes[half : half + n] * ODD[42])
    anchor = _sliding_min(part, width - half + 1)[:n]
    rows = found.rows
    valid = rows[:n] == rows[width - 1 :]
    places = np.arange(n) - found.bounds[:-1][rows[:n]]
    return whole[valid], anchor[valid], rows[:n][valid].astype(np.int32), places[valid].astype(np.int32)


def _flush(buffer: list[tuple[np.ndarray, ...]], docs: np.ndarray, tags: np.ndarray, shards: int) -> Iterator[pa.RecordBatch]:
    """Entries of a block for each shard, and the references found within the block."""
    whole, anchor, rows, places = (np.concatenate([b[k] for b in buffer]) for k in range(4))
    by_doc = np.lexsort((tags, docs))
    rank = np.empty(len(docs), dtype=np.int64)
    rank[by_doc] = np.arange(len(docs))
    # repeated rows are one document: their windows are judged against its first row
    same = np.zeros(len(docs), dtype=bool)
    same[1:] = (docs[by_doc][1:] == docs[by_doc][:-1]) & (tags[by_doc][1:] == tags[by_doc][:-1])
    use = ~same[rank[rows]]
    whole, anchor, rows, places = whole[use], anchor[use], rows[use], places[use]
    order = np.lexsort((places, rank[rows]))
    whole, anchor, rows, places = whole[order], anchor[order], rows[order], places[order]

    by_hash = np.argsort(whole, kind="stable")
    later = np.zeros(len(whole), dtype=bool)
    later[1:] = whole[by_hash][1:] == whole[by_hash][:-1]
    first = by_hash[np.maximum.accumulate(np.where(later, 0, np.arange(len(whole))))]
    local = np.sort(by_hash[later])
    reference = np.empty(len(whole), dtype=np.int64)
    reference[by_hash] = first

    sent = np.ones(len(whole), dtype=bool)
    sent[local] = False
    whole, anchor, s_rows, s_places = whole[sent], anchor[sent], rows[sent], places[sent]
    opens = np.ones(len(whole), dtype=bool)
    opens[1:] = (s_rows[1:] != s_rows[:-1]) | (s_places[1:] != s_places[:-1] + 1) | (anchor[1:] != anchor[:-1])
    starts = np.flatnonzero(opens)
    run_of = np.cumsum(opens) - 1
    within = np.arange(len(whole)) - starts[run_of] if len(whole) else np.empty(0, np.int64)
    opens |= within % LONGEST_RUN == 0
    starts = np.flatnonzero(opens)
    sizes = np.diff(np.append(starts, len(whole)))
    shard = ((mixed(anchor[starts]) >> np.uint64(33)) % np.uint64(shards)).astype(np.int64)

    run_order = np.argsort(shard, kind="stable")
    window_order = np.argsort(np.repeat(shard, sizes), kind="stable")
    checks = np.ascontiguousarray(whole[window_order].view(np.uint8).reshape(-1, 8)[:, :CHECK_BYTES])
    edges = np.searchsorted(shard[run_order], np.arange(shards + 1))
    window_edges = np.concatenate([[0], np.cumsum(sizes[run_order])])[edges]
    starts, sizes = starts[run_order], sizes[run_order]
    # local references leave with one entry each, spread over the shards
    l_shard = rows[local] % shards
    l_order = np.argsort(l_shard, kind="stable")
    local = local[l_order]
    l_edges = np.searchsorted(l_shard[l_order], np.arange(shards + 1))

    out: list[list] = [[] for _ in range(12)]
    for k in range(shards):
        runs = starts[edges[k] : edges[k + 1]]
        own = local[l_edges[k] : l_edges[k + 1]]
        refs = reference[own]
        if not len(runs) and not len(own):
            continue
        used, owner = np.unique(np.concatenate([s_rows[runs], rows[own], rows[refs]]), return_inverse=True)
        owner = owner.astype(np.uint32)
        cuts = np.cumsum([len(runs), len(own)])
        values = (
            docs[used], tags[used], anchor[runs], owner[: cuts[0]],
            s_places[runs].astype(np.uint32), sizes[edges[k] : edges[k + 1]].astype(np.uint8),
            checks[window_edges[k] : window_edges[k + 1]], owner[cuts[0] : cuts[1]],
            places[own].astype(np.uint32), owner[cuts[1] :], places[refs].astype(np.uint32),
        )
        out[0].append(k)
        for column, value in zip(out[1:], values):
            column.append(np.ascontiguousarray(value).tobytes())
    names = [f.split()[0] for f in PAYLOAD.split(", ")]
    yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int32()), *(pa.array(c, pa.binary()) for c in out[1:])], names)


def entries(documents: DataFrame, width: int, shards: int) -> DataFrame:
    """Index entries of all windows of ``doc_id, tag, text``, packed by block and shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buffer, docs, tags, held, n_rows = [], [], [], 0, 0
        for batch in batches:
            for part in chunks(batch):
                found = windows(words(part.column("text")), width)
                docs.append(part.column("doc_id").to_numpy(zero_copy_only=False))
                tags.append(part.column("tag").to_numpy(zero_copy_only=False))
                buffer.append((found[0], found[1], found[2] + np.int32(n_rows), found[3]))
                n_rows += part.num_rows
                held += len(found[0])
                if held >= BLOCK_WINDOWS:
                    yield from _flush(buffer, np.concatenate(docs), np.concatenate(tags), shards)
                    buffer, docs, tags, held, n_rows = [], [], [], 0, 0
        if buffer:
            yield from _flush(buffer, np.concatenate(docs), np.concatenate(tags), shards)

    return documents.mapInArrow(run, PAYLOAD)


def _grouped(owners: list[np.ndarray], place: np.ndarray, refs: list[np.ndarray], ref_place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and sizes of the runs of ordered windows whose references run along with them."""
    opens = np.ones(len(place), dtype=bool)
    opens[1:] = (place[1:] != place[:-1] + 1) | (ref_place[1:] != ref_place[:-1] + 1)
    for x in (*owners, *refs):
        opens[1:] |= x[1:] != x[:-1]
    starts = np.flatnonzero(opens)
    return starts, np.diff(np.append(starts, len(place)))


def _answers(
    doc: np.ndarray, tag: np.ndarray, place: np.ndarray, ref_doc: np.ndarray, ref_tag: np.ndarray, ref_place: np.ndarray
) -> pa.Table:
    """One row per run of windows whose references run along with them.

    How many there are follows from the texts, not from the number of shards.
    """
    order = np.lexsort((place, tag, doc))
    doc, tag, place, ref_doc, ref_tag, ref_place = (x[order] for x in (doc, tag, place, ref_doc, ref_tag, ref_place))
    starts, sizes = _grouped([doc, tag], place.astype(np.int64), [ref_doc, ref_tag], ref_place.astype(np.int64))
    columns = (doc[starts], tag[starts], place[starts], sizes, ref_doc[starts], ref_tag[starts], ref_place[starts])
    types = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32())
    return pa.table({f.split()[0]: pa.array(c.astype(t.to_pandas_dtype())) for f, c, t in zip(ANSWER.split(", "), columns, types)})


def _search(table: pa.Table) -> pa.Table:
    """Answers of one shard: entries of which an equal one starts earlier, and what the blocks found themselves."""
    docs, tags, places, keys, found = [], [], [], [], []
    for row in table.to_pylist():
        doc, tag = np.frombuffer(row["docs"], np.int64), np.frombuffer(row["tags"], np.int64)
        sizes = np.frombuffer(row["sizes"], np.uint8).astype(np.int64)
        owner = np.repeat(np.frombuffer(row["owners"], np.uint32), sizes)
        start = np.frombuffer(row["starts"], np.uint32).astype(np.int64)
        step = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        check = np.zeros((len(owner), 8), dtype=np.uint8)
        check[:, :CHECK_BYTES] = np.frombuffer(row["checks"], np.uint8).reshape(-1, CHECK_BYTES)
        anchor = np.repeat(np.frombuffer(row["anchors"], np.uint64), sizes)
        keys.append(mixed(anchor * ODD[50] + mixed(check.view(np.uint64).ravel()) * ODD[51]))
        docs.append(doc[owner])
        tags.append(tag[owner])
        places.append((np.repeat(start, sizes) + step).astype(np.int32))
        own, ref = np.frombuffer(row["local_owners"], np.uint32), np.frombuffer(row["ref_owners"], np.uint32)
        found.append((
            doc[own], tag[own], np.frombuffer(row["local_places"], np.uint32),
            doc[ref], tag[ref], np.frombuffer(row["ref_places"], np.uint32),
        ))
    key = np.concatenate(keys)
    order = np.argsort(key)
    ordered = key[order]
    repeated = np.zeros(len(key), dtype=bool)
    repeated[1:] |= ordered[1:] == ordered[:-1]
    repeated[:-1] |= ordered[1:] == ordered[:-1]
    at = order[repeated]
    doc, tag, place = (np.concatenate(x)[at] for x in (docs, tags, places))
    key = key[at]
    by = np.lexsort((place, tag, doc, key))
    doc, tag, place, key = doc[by], tag[by], place[by], key[by]
    later = np.zeros(len(key), dtype=bool)
    later[1:] = key[1:] == key[:-1]
    first = np.maximum.accumulate(np.where(later, 0, np.arange(len(key))))
    # the same row read by two blocks is one document
    later &= (doc != doc[first]) | (tag != tag[first]) | (place != place[first])
    found.append((doc[later], tag[later], place[later], doc[first][later], tag[first][later], place[first][later]))
    return _answers(*(np.concatenate([f[k] for f in found]) for k in range(6)))


def _matrices(column: pa.Array) -> Iterator[np.ndarray]:
    """Per row its runs as whole numbers, one line per run, in the order of ``RUN_FIELDS`` and further fields."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten()
    fields = [flat.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(flat.type.num_fields)]
    lines = np.stack(fields, axis=1) if fields else np.empty((0, 5), np.int64)
    ends = np.cumsum([0, *(n or 0 for n in pc.list_value_length(column).to_pylist())])
    for a, b in zip(ends, ends[1:]):
        yield lines[a:b]


def _column(matrices: list[np.ndarray]) -> pa.Array:
    lines = np.concatenate(matrices) if matrices else np.empty((0, 5), np.int64)
    offsets = np.cumsum([0, *(len(m) for m in matrices)]).astype(np.int32)
    fields = [pa.array(lines[:, k].astype(f.type.to_pandas_dtype())) for k, f in enumerate(RUN_TYPE.value_type)]
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(fields, fields=list(RUN_TYPE.value_type)))


def _maximal(runs: np.ndarray) -> np.ndarray:
    """Longest runs of the same windows; a window named twice follows its deepest reference, the last field."""
    place, size, ref_doc, ref_tag, ref_place, depth = runs[np.lexsort((runs[:, 0], -runs[:, 5]))].T
    step = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    at, once = np.unique(np.repeat(place, size) + step, return_index=True)
    docs, tags, places = np.repeat(ref_doc, size)[once], np.repeat(ref_tag, size)[once], (np.repeat(ref_place, size) + step)[once]
    starts, sizes = _grouped([], at, [docs, tags], places)
    return np.stack([at[starts], sizes, docs[starts], tags[starts], places[starts]], axis=1)


def _deepest(answers: DataFrame) -> DataFrame:
    """Of answers whose reference has an answer itself, the parts it answers: a join of ranges by slices of places."""

    def sliced(place: str, names: dict[str, str]) -> DataFrame:
        covered = F.sequence(F.expr(f"{place} div {SLICE}"), F.expr(f"({place} + size - 1) div {SLICE}"))
        columns = [F.col(c).alias(names.get(c, c)) for c in answers.columns]
        return answers.select(*columns, (F.col(place) + F.col("size")).alias(names["end"]), F.explode(covered).alias("slice"))

    own = sliced("ref_place", {"ref_doc": "at_doc", "ref_tag": "at_tag", "ref_place": "at_place", "end": "at_end"}).drop("size")
    their = sliced("place", {"doc_id": "at_doc", "tag": "at_tag", "place": "from_place", "end": "from_end"}).drop("size")
    start = F.greatest("at_place", "from_place", F.col("slice") * SLICE)
    stop = F.least("at_end", "from_end", (F.col("slice") + 1) * SLICE)
    met = own.join(their, ["at_doc", "at_tag", "slice"]).withColumn("start", start).withColumn("stop", stop).filter("start < stop")
    return met.selectExpr(
        "doc_id", "tag", "cast(place + start - at_place AS int) AS place", "cast(stop - start AS int) AS size",
        "ref_doc", "ref_tag", "cast(ref_place + start - from_place AS int) AS ref_place",
    )


def _combined(*fields: np.ndarray | int) -> np.ndarray:
    """A hash of several whole numbers per line."""
    total = np.uint64(0)
    for k, x in enumerate(fields):
        total = mixed(total + np.atleast_1d(np.asarray(x, dtype=np.int64)).view(np.uint64) * ODD[52 + k])
    return total


class _Chains:
    """Hashes of a document's runs, from borders outwards: all runs but the last with their sizes."""

    def __init__(self, runs: np.ndarray):
        self.runs = runs
        n = len(runs)
        apart = np.ones(n + 1, dtype=bool)
        apart[1:-1] = runs[1:, 0] != runs[:-1, 0] + runs[:-1, 1]
        cuts = np.flatnonzero(apart)
        self.first = np.repeat(cuts[:-1], np.diff(cuts))  # of the stretch of runs without a gap
        self.stop = np.repeat(cuts[1:], np.diff(cuts))
        _, size, doc, tag, ref = runs.T
        self.starts, self.ends = _combined(doc, tag, ref), _combined(doc, tag, ref + size)
        power, self.undo = (np.full(n + 1, x, dtype=np.uint64) for x in (MULTIPLIER, INVERSE))
        power[0] = self.undo[0] = 1
        power, self.undo = np.cumprod(power, dtype=np.uint64), np.cumprod(self.undo, dtype=np.uint64)
        whole = _combined(size, doc, tag, ref)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(whole * power[:-1], dtype=np.uint64)])

    def _between(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (self.sums[b] - self.sums[a]) * self.undo[a]

    def before(self, at: np.ndarray, far: np.ndarray, place: np.ndarray, doc, tag) -> np.ndarray:
        """Keys of runs ``far`` to ``at``, which end where the document ``doc, tag`` is at ``place``."""
        return mixed(self._between(far + 1, at) * ODD[61] + mixed(self.ends[far] + _combined(doc, tag, place, 0)))

    def behind(self, at: np.ndarray, far: np.ndarray, place: np.ndarray, doc, tag) -> np.ndarray:
        """Keys of runs ``at`` to ``far``, ``far`` included, which start where the document is at ``place``."""
        return mixed(self._between(at, far) * ODD[62] + mixed(self.starts[far] + _combined(doc, tag, place, 1)))


def _steps(longest: int) -> Iterator[int]:
    """1, 2, 3, 4, 6, 8, 12, 16, 24, ..."""
    k = 1
    while k <= longest:
        yield k
        if k > 1 and 3 * k // 2 <= longest:
            yield 3 * k // 2
        k *= 2


def _borders(found: DataFrame) -> DataFrame:
    """Keys of the runs before and behind each run that follows others; ``far`` is the last of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[list] = [[np.empty(0, np.int64)] for _ in range(5)]
            for doc, tag, m in zip(batch.column("doc_id").to_pylist(), batch.column("tag").to_pylist(), _matrices(batch.column(RUNS))):
                if len(m) < 2:
                    continue
                chains, every = _Chains(m), np.arange(len(m))
                asks = np.ones(len(m), dtype=bool)
                asks[1:] = chains.starts[1:] != chains.starts[:-1]
                ahead, behind = every - chains.first, chains.stop - 1 - every
                steps = list(_steps(int((chains.stop - chains.first).max()) - 1))
                rest = [np.where(np.isin(x, steps), 0, x) for x in (ahead, behind)]
                for back, on in [*((np.full(len(m), k), np.full(len(m), k)) for k in steps), rest]:
                    early, late = every[asks & (back > 0) & (back <= ahead)], every[asks & (on > 0) & (on <= behind)]
                    first, last = early - back[early], late + on[late]
                    keys = (
                        chains.before(early, first, m[early, 4], m[early, 2], m[early, 3]),
                        chains.behind(late + 1, last, m[late, 4] + m[late, 1], m[late, 2], m[late, 3]),
                    )
                    for key, at, far in zip(keys, (early, late), (first, last)):
                        for column, value in zip(rows, (key.view(np.int64), np.full(len(at), doc), np.full(len(at), tag), at, far)):
                            column.append(value)
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(c).astype(t.to_pandas_dtype())) for c, t in zip(rows, types)],
                [f.split()[0] for f in BORDER.split(", ")],
            )

    return found.mapInArrow(run, BORDER)


def _ends(found: DataFrame) -> DataFrame:
    """Keys of all runs of each stretch, counted from its end and from its start, with the size of the last run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sizes = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
            for doc, tag, m in zip(batch.column("doc_id").to_pylist(), batch.column("tag").to_pylist(), _matrices(batch.column(RUNS))):
                chains, every = _Chains(m), np.arange(len(m))
                last = m[chains.stop - 1]
                keys.append(chains.before(chains.stop, every, last[:, 0] + last[:, 1], doc, tag))
                keys.append(chains.behind(chains.first, every, m[chains.first, 0], doc, tag))
                sizes += [m[:, 1], m[:, 1]]
            key, size = np.concatenate(keys).view(np.int64), np.concatenate(sizes).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(size)], ["key", "far_size"])

    return found.mapInArrow(run, ENDS)


def factors(runs: np.ndarray, sides: np.ndarray, width: int) -> list[tuple[int, int, int, int, int]]:
    """Greedy factors ``(start, length, ref_doc, ref_tag, ref_start)`` in words; they don't overlap.

    ``runs`` are a document's longest runs of windows in order. A line ``run, far, size`` of ``sides``
    says that the match of a run goes on over all runs up to ``far``, of which it holds ``size`` windows at most.
    """
    spans: dict[tuple[int, int, int], list[tuple[int, int]]] = {}
    for place, size, doc, tag, ref in runs.tolist():
        spans.setdefault((doc, tag, ref - place), []).append((place, place + size))
    for at, far, held in sides.tolist():
        place, size, doc, tag, ref = runs[at].tolist()
        far_place, far_size = runs[far, :2].tolist()
        held = min(held, far_size)
        span = (far_place + far_size - held, place) if far < at else (place + size, far_place + held)
        spans[(doc, tag, ref - place)].append(span)
    matches = []
    for (doc, tag, shift), parts in spans.items():
        parts.sort()
        start, stop = parts[0]
        for a, b in parts[1:]:
            if a > stop:
                matches.append((start, stop, doc, tag, shift))
                start = a
            stop = max(stop, b)
        matches.append((start, stop, doc, tag, shift))
    matches.sort()
    out, word, best, k = [], 0, None, 0
    while True:
        while k < len(matches) and matches[k][0] <= word:
            if best is None or matches[k][1] > best[1]:
                best = matches[k]
            k += 1
        if best is not None and best[1] + width - 1 > word:
            _, stop, doc, tag, shift = best
            out.append((word, stop + width - 1 - word, doc, tag, word + shift))
            word = stop + width - 1
        elif k < len(matches):
            word = matches[k][0]
        else:
            return out


def _answered(source: DataFrame, width: int) -> DataFrame:
    """Runs of windows of ``doc_id, tag, text`` that also start earlier."""
    size = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-size // SHARD_BYTES))
    return entries(source, width, shards).groupBy("shard").applyInArrow(_search, ANSWER)


def repeated(source: DataFrame, width: int = WINDOW) -> DataFrame:
    """``doc_id, tag`` and the ``runs`` (place, size) of windows that also start earlier; documents without any have no row."""
    run = F.struct("place", "size")
    return _answered(source, width).groupBy("doc_id", "tag").agg(F.collect_list(run).alias(RUNS))  # no more than a document's own windows


def references(source: DataFrame, width: int = WINDOW) -> DataFrame:
    """``doc_id, tag``, the longest ``runs`` of windows that also start earlier, and the ``sides`` on which matches go on."""
    answers = kept(_answered(source, width), "window-answers")
    deep = answers.withColumn("depth", F.lit(0)).unionByName(_deepest(answers).withColumn("depth", F.lit(1)))
    run = F.struct(*RUN_FIELDS, "depth")

    def longest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs = [_maximal(m) for m in _matrices(batch.column("all_runs"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("tag"), _column(runs)], ["doc_id", "tag", RUNS])

    gathered = deep.groupBy("doc_id", "tag").agg(F.collect_list(run).alias("all_runs"))  # no more than a document's own windows
    found = kept(gathered.mapInArrow(longest, f"doc_id long, tag long, {RUNS} {RUN_SCHEMA}"), "factor-runs")
    met = _borders(found).join(_ends(found), "key")
    sides = met.groupBy("doc_id", "tag").agg(F.collect_list(F.struct("run", "far", F.col("far_size").alias("size"))).alias(SIDES))
    return found.join(sides, ["doc_id", "tag"], "left")


def keyed(documents: DataFrame, id_column: str, text_column: str) -> list:
    """Id and tag that tell documents apart: rows without an id come last, rows of one id by their tag.

    The tag is 63 bits of the text's hash beside a bit for a missing id, so any
    long is an id. Two texts of one id are mistaken for each other with a
    chance of about n^2 / 2^64 where n texts share the id.
    """
    text = F.coalesce(F.col(f"`{text_column}`"), F.lit(""))
    given = F.col(f"`{id_column}`").cast("long")
    hashed = F.shiftrightunsigned(F.xxhash64(text), 1)
    return [
        F.coalesce(given, F.lit(LAST_ID)).alias("doc_id"),
        F.when(given.isNull(), hashed).otherwise(hashed.bitwiseOR(F.lit(-(1 << 63)))).alias("tag"),
        text.alias("text"),
    ]


def _own_id() -> Column:
    """The id again; null where the tag says that there is none."""
    return F.when(F.col("tag") < 0, F.col("doc_id"))


def _factored(part: pa.RecordBatch, width: int) -> Iterator[list[tuple[int, int, int, int, int]]]:
    """Per row its factors."""
    for runs, sides in zip(_matrices(part.column(RUNS)), _matrices(part.column(SIDES))):
        yield factors(runs, sides, width) if len(runs) else []


def _covered(part: pa.RecordBatch, width: int) -> Iterator[tuple[list[bytes], np.ndarray]]:
    """Per row its words, and which of them lie in a window of its runs."""
    found = words(part.column("text"))
    values, codes, bounds = found.values.to_pylist(), found.codes.tolist(), found.bounds.tolist()
    for a, b, runs in zip(bounds, bounds[1:], _matrices(part.column(RUNS))):
        covered = np.zeros(b - a, dtype=bool)
        for place, size in runs.tolist():
            covered[place : place + size + width - 1] = True
        yield [values[c] for c in codes[a:b]], covered


def removal_digests(
    documents: DataFrame, width: int = WINDOW, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` per row.

    A word is removed if it lies in a window of ``width`` words whose words also
    start earlier: in a document with a smaller id, or further ahead in the same
    one. Windows are judged on the input.

    Null and empty texts have no words. Rows without an id come after all others
    and rows of one id are ordered by a hash of their text; equal rows are one
    document and get the same result. Other columns are not read.
    """
    source = documents.select(*keyed(documents, id_column, text_column))
    joined = source.join(repeated(source, width), ["doc_id", "tag"], "left").withColumn("doc_id", _own_id())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                n_words, n_removed, digests = [], [], []
                for own, covered in _covered(part, width):
                    n_words.append(len(own))
                    n_removed.append(int(covered.sum()))
                    left = [own[i] for i in np.flatnonzero(~covered)] if covered.any() else own
                    digests.append(hashlib.sha256(b" ".join(left)).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                     pa.array(digests, pa.string())],
                    ["doc_id", "n_words", "n_removed", "kept_sha256"],
                )

    return joined.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def duplicate_spans(
    documents: DataFrame, width: int = WINDOW, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``doc_id, start, length, ref_doc, ref_start`` per factor, in words; edge cases as in ``removal_digests``.

    ``ref_doc`` is null for a reference without an id.
    """
    found = references(documents.select(*keyed(documents, id_column, text_column)), width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            ids, tags = batch.column("doc_id").to_pylist(), batch.column("tag").to_pylist()
            for doc, tag, parsed in zip(ids, tags, _factored(batch, width)):
                for start, length, ref_doc, ref_tag, ref_start in parsed:
                    rows.append((doc if tag < 0 else None, start, length, ref_doc if ref_tag < 0 else None, ref_start))
            columns = list(zip(*rows)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], ["doc_id", "start", "length", "ref_doc", "ref_start"]
            )

    return found.mapInArrow(run, "doc_id long, start long, length long, ref_doc long, ref_start long")


def without_duplicates(
    documents: DataFrame, width: int = WINDOW, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """The same rows and columns; a text that loses words becomes its kept words joined by one space."""
    keys = keyed(documents, id_column, text_column)
    rest = F.struct(*(F.col(f"`{c}`") for c in documents.columns if c != text_column)).alias("rest")
    known = F.col(f"`{text_column}`").isNotNull().alias("known")
    rows = documents.select(*keys, rest, known)
    joined = rows.join(repeated(rows.select("doc_id", "tag", "text"), width), ["doc_id", "tag"], "left")
    wanted = joined.select("text", "rest", "known", RUNS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                texts = part.column("text").to_pylist()
                for k, (own, covered) in enumerate(_covered(part, width)):
                    if covered.any():
                        texts[k] = b" ".join([own[i] for i in np.flatnonzero(~covered)]).decode()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(texts, pa.string()), part.column("rest"), part.column("known")], ["text", "rest", "known"]
                )

    out = wanted.mapInArrow(run, wanted.select("text", "rest", "known").schema)
    text = F.when(F.col("known"), F.col("text")).alias(text_column)
    return out.select(*(text if c == text_column else F.col(f"rest.`{c}`").alias(c) for c in documents.columns))
