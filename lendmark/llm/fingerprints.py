"""Fingerprints of texts as invertible Bloom lookup sketches of their paragraphs.

A paragraph is a line, cut further before words whose neighbourhood says so, so
that short texts have several and an edit changes few. Each paragraph (with the
number of times it came before) is a 64-bit digest. A digest goes into one cell
of each third of a sketch; a cell keeps how many digests it holds, their sum and
the sum of their checks, modulo 2^64.

Two sketches subtract cell by cell, which leaves the digests that only one of
the texts holds. Peeling takes cells with a single digest and removes it from its
other cells until all are empty. Where that doesn't succeed, both texts are
sketched again with ``GROWTH`` times as many cells. With the number of digests
of each text, the differing ones give the likeness of the two.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendmark.llm.near_dups import mixed
from lendmark.llm.scratch import kept
from lendmark.llm.text import SPACE, chunks, encoded, raw

CELLS = 12
GROWTH = 4
ROOM = 8  # cells per digest beyond which a sketch only changes its hashes
AROUND = 4  # bytes before and after a place that decide on a cut
WORD_SHARE, LETTER_SHARE, RUN_SHARE = 4, 16, 64  # one in so many places is a cut
RUN = 64  # bytes of a word after which it may be cut inside

ODD = np.random.default_rng(12).integers(1, 1 << 63, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


@dataclass
class Digests:
    """Digests of the paragraphs of some texts; ``rows`` says whose, ``sizes`` how many each has."""

    rows: np.ndarray
    keys: np.ndarray
    sizes: np.ndarray

    def of(self, rows: np.ndarray) -> Digests:
        """Those of the given texts (ascending), which are numbered anew."""
        place = np.full(len(self.sizes), -1, dtype=np.int64)
        place[rows] = np.arange(len(rows))
        own = place[self.rows]
        return Digests(own[own >= 0], self.keys[own >= 0], self.sizes[rows])


def _cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where paragraphs begin: after line ends, and where the bytes around a place ask for it."""
    size = len(data)
    first = np.zeros(size, dtype=bool)
    first[1:] = data[:-1] == 0x0A
    blank = SPACE[data]
    opens = ~blank
    opens[1:] &= blank[:-1]
    begins = offsets[:-1][np.diff(offsets) > 0]
    first[begins] = True
    opens[begins] = ~blank[begins]
    at = np.arange(size)
    word = np.maximum.accumulate(np.where(opens | first, at, 0))
    places = np.flatnonzero(opens | (data >= 0xC0) | ((at - word >= RUN) & ((data & 0xC0) != 0x80)))
    row = np.searchsorted(offsets, places, side="right") - 1
    low, high = offsets[row], offsets[row + 1]
    around = np.zeros(len(places), dtype=np.uint64)
    for k in range(-AROUND, AROUND):
        i = places + k
        inside = (i >= low) & (i < high)
        around |= np.where(inside, data[np.where(inside, i, 0)], 0).astype(np.uint64) << np.uint64(8 * (k + AROUND))
    share = np.where(opens[places], WORD_SHARE, np.where(data[places] >= 0xC0, LETTER_SHARE, RUN_SHARE)).astype(np.uint64)
    first[places[mixed(around) % share == 0]] = True
    return np.flatnonzero(first)


def digests(column: pa.Array) -> Digests:
    """Digests of each text of a chunk; a null text has none."""
    data, offsets = raw(column)
    n = len(offsets) - 1
    if not len(data):
        return Digests(np.empty(0, np.int64), np.empty(0, np.uint64), np.zeros(n, np.int64))
    starts = _cuts(data, offsets)
    codes, values = encoded(data, starts)
    sizes = np.diff(np.searchsorted(starts, offsets))
    rows = np.repeat(np.arange(n), sizes)
    order = np.lexsort((codes, rows))
    again = np.zeros(len(codes), dtype=bool)
    again[1:] = (rows[order][1:] == rows[order][:-1]) & (codes[order][1:] == codes[order][:-1])
    at = np.arange(len(codes))
    nth = np.empty(len(codes), dtype=np.uint64)
    nth[order] = at - np.maximum.accumulate(np.where(again, 0, at))
    distinct = np.fromiter(map(xxhash.xxh3_64_intdigest, values.to_pylist()), np.uint64, len(values))
    return Digests(rows, mixed(distinct[codes] + nth * ODD[0]), sizes)


# ----------------------------------------------------------------- sketches


def _places(rows: np.ndarray, keys: np.ndarray, cells: int, salt: int) -> np.ndarray:
    """The cells of each digest, one in each third of its text's sketch."""
    third = cells // 3
    salted = np.uint64(salt * int(ODD[4]) % (1 << 64))
    spread = [(mixed(keys * ODD[1 + k] + salted) % np.uint64(third)).astype(np.int64) + k * third for k in range(3)]
    return np.stack(spread) + rows * cells


@dataclass
class Sketch:
    """The cells of some texts' sketches, one text after the other."""

    counts: np.ndarray
    sums: np.ndarray
    checks: np.ndarray
    cells: int
    salt: int

    @staticmethod
    def of(found: Digests, cells: int, salt: int = 0) -> Sketch:
        size = len(found.sizes) * cells
        sketch = Sketch(np.zeros(size, np.int64), np.zeros(size, np.uint64), np.zeros(size, np.uint64), cells, salt)
        sketch._put(found.rows, found.keys, np.ones(len(found.keys), np.int64))
        return sketch

    def _put(self, rows: np.ndarray, keys: np.ndarray, times: np.ndarray) -> np.ndarray:
        places = _places(rows, keys, self.cells, self.salt)
        factor, check = times.astype(np.uint64), mixed(keys ^ ODD[5])
        for at in places:
            np.add.at(self.counts, at, times)
            np.add.at(self.sums, at, keys * factor)
            np.add.at(self.checks, at, check * factor)
        return places

    def minus(self, other: Sketch) -> Sketch:
        return Sketch(
            self.counts - other.counts, self.sums - other.sums, self.checks - other.checks, self.cells, self.salt
        )

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Rows, digests and sides (1 or -1) that come out, and which texts are done; empties the cells on its way."""
        rows, keys, sides = [np.empty(0, np.int64)], [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
        look = np.flatnonzero(np.abs(self.counts) == 1)
        while len(look):
            side = self.counts[look]
            key, check = self.sums[look] * side.astype(np.uint64), self.checks[look] * side.astype(np.uint64)
            pure = mixed(key ^ ODD[5]) == check
            look, side, key = look[pure], side[pure], key[pure]
            row = look // self.cells
            order = np.lexsort((key, row))
            once = np.ones(len(order), dtype=bool)
            once[1:] = (row[order][1:] != row[order][:-1]) | (key[order][1:] != key[order][:-1])
            taken = order[once]
            row, key, side = row[taken], key[taken], side[taken]
            rows.append(row)
            keys.append(key)
            sides.append(side)
            touched = np.unique(self._put(row, key, -side))
            look = touched[np.abs(self.counts[touched]) == 1]
        left = (self.counts != 0) | (self.sums != 0) | (self.checks != 0)
        done = ~left.reshape(-1, self.cells).any(axis=1)
        return np.concatenate(rows), np.concatenate(keys), np.concatenate(sides), done

    def stored(self, sizes: np.ndarray) -> pa.Array:
        """Each text's sketch as bytes: number of digests, then the cells."""
        cell = np.dtype([("count", "<i4"), ("sum", "<u8"), ("check", "<u4")])
        flat = np.empty(len(self.counts), dtype=cell)
        flat["count"], flat["sum"], flat["check"] = self.counts, self.sums, self.checks >> np.uint64(32)
        body = flat.reshape(-1, self.cells)
        return pa.array([int(n).to_bytes(8, "little") + b.tobytes() for n, b in zip(sizes, body)], pa.binary())


@dataclass
class Changes:
    """Digests that only the old (side 1) or the new text (side -1) of a pair holds; ``cells`` it took to find them."""

    rows: np.ndarray
    keys: np.ndarray
    sides: np.ndarray
    cells: np.ndarray
    likeness: np.ndarray


def changes(old: Digests, new: Digests, cells: int = CELLS) -> Changes:
    """What differs between the texts of each pair, by subtracting and peeling, larger where that fails."""
    n = len(old.sizes)
    used = np.zeros(n, dtype=np.int64)
    found: list[list[np.ndarray]] = [[], [], []]
    pending, salt = np.arange(n), 0
    while len(pending):
        a, b = old.of(pending), new.of(pending)
        rows, keys, sides, done = Sketch.of(a, cells, salt).minus(Sketch.of(b, cells, salt)).peel()
        good = done[rows]
        for column, value in zip(found, (pending[rows[good]], keys[good], sides[good])):
            column.append(value)
        used[pending[done]] = cells
        pending, salt = pending[~done], salt + 1
        if len(pending) and cells < ROOM * int((old.sizes + new.sizes)[pending].max()):
            cells *= GROWTH
    rows, keys, sides = (np.concatenate(c) if c else np.empty(0, np.int64) for c in found)
    gone = np.bincount(rows[sides > 0], minlength=n)
    come = np.bincount(rows[sides < 0], minlength=n)
    union = old.sizes + come
    likeness = np.where(union > 0, (old.sizes - gone) / np.maximum(union, 1), 1.0)
    return Changes(rows, keys, sides, used, likeness)


def differences(pairs: DataFrame, old: str, new: str) -> DataFrame:
    """The rows of ``pairs`` (two versions of a text per row) with what changed between them.

    Adds ``only_old`` and ``only_new`` (ascending paragraph digests), ``cells``
    (of the sketch that gave them) and ``likeness`` (shared digests over all, 1
    where neither text has any). Null texts are empty. Columns of these names
    are replaced.
    """
    added = T.StructType([
        T.StructField("only_old", T.ArrayType(T.LongType())), T.StructField("only_new", T.ArrayType(T.LongType())),
        T.StructField("cells", T.LongType()), T.StructField("likeness", T.DoubleType()),
    ])
    names = added.fieldNames()
    wanted = pairs.select(
        F.struct(*(F.col(f"`{c}`") for c in pairs.columns if c not in names)).alias("rest"),
        F.col(f"`{old}`").alias("text"),
        F.col(f"`{new}`").alias("new"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                diff = changes(digests(part.column("text")), digests(part.column("new")))
                order = np.lexsort((diff.keys.view(np.int64), diff.rows))
                lists = []
                for side in (1, -1):
                    own = order[diff.sides[order] == side]
                    ends = np.searchsorted(diff.rows[own], np.arange(part.num_rows + 1))
                    lists.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(diff.keys[own].view(np.int64))))
                yield pa.RecordBatch.from_arrays(
                    [part.column("rest"), *lists, pa.array(diff.cells), pa.array(diff.likeness)], ["rest", *names]
                )

    schema = T.StructType([wanted.schema["rest"], *added])
    return wanted.mapInArrow(run, schema).select("rest.*", *names)


# -------------------------------------------------------- documents in order


RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, " \
    "near_edited double, near_next double, next_cells long"  # fmt: skip
RESULT_NAMES = [f.split()[0] for f in RESULT.split(", ")]
FIRST, LAST = 1, 2


def _edit(text: str, following: str) -> str:
    """The last half of a text replaced by as much of the beginning of another one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _compared(ids: list, texts: list[str], following: pa.Array, cells: int) -> list[pa.Array]:
    """Columns of ``RESULT`` for texts whose followers are given."""
    own = pa.array(texts, pa.string())
    edited = [_edit(a, b) for a, b in zip(texts, following.to_pylist())]
    digest, changed = digests(own), digests(pa.array(edited, pa.string()))
    after = digests(following)
    near, far = changes(digest, changed), changes(digest, after)
    return [
        pa.array(ids, pa.int64()),
        pa.array([len(t) for t in texts], pa.int64()),
        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
        Sketch.of(digest, cells).stored(digest.sizes),
        Sketch.of(changed, cells).stored(changed.sizes),
        pa.array(near.likeness),
        pa.array(far.likeness),
        pa.array(far.cells),
    ]


def _chained(cells: int):
    """Rows of a sorted partition with their followers; the ends of the partition leave with their texts."""

    def border(part: int, kind: int, doc: int | None, text: str) -> pa.RecordBatch:
        empty = [pa.nulls(1, pa.binary() if "finger" in n else pa.string() if n.endswith("256") else
                 pa.float64() if n.startswith("near") else pa.int64()) for n in RESULT_NAMES[1:]]
        tail = [pa.array([part], pa.int32()), pa.array([kind], pa.int32()), pa.array([text], pa.string())]
        return pa.RecordBatch.from_arrays([pa.array([doc], pa.int64()), *empty, *tail], [*RESULT_NAMES, "part", "kind", "text"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[int | None, str] | None = None
        number = 0
        for batch in batches:
            for piece in chunks(batch):
                ids, texts = piece.column("doc_id").to_pylist(), piece.column("text").to_pylist()
                if held is None:
                    number = piece.column("part")[0].as_py()
                    yield border(number, FIRST, ids[0], texts[0])
                else:
                    ids, texts = [held[0], *ids], [held[1], *texts]
                held = (ids[-1], texts[-1])
                n = len(ids) - 1
                if n:
                    columns = _compared(ids[:n], texts[:n], pa.array(texts[1:], pa.string()), cells)
                    tail = [pa.array([number] * n, pa.int32()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.string())]
                    yield pa.RecordBatch.from_arrays([*columns, *tail], [*RESULT_NAMES, "part", "kind", "text"])
        if held is not None:
            yield border(number, LAST, *held)

    return run


def _pairs(cells: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in chunks(batch):
                ids, texts = piece.column("doc_id").to_pylist(), piece.column("text").to_pylist()
                yield pa.RecordBatch.from_arrays(_compared(ids, texts, piece.column("following"), cells), RESULT_NAMES)

    return run


def edit_fingerprints(
    documents: DataFrame, cells: int = CELLS, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``RESULT`` per row: fingerprints of a text and of its edited text, and how alike they and the next text's are.

    The edited text is ``_edit`` of the text and the next document's; documents
    are in order of their ids, and the first follows the last. Rows without an id
    come last; rows of one id are ordered by a hash of their text, then the text;
    equal rows follow each other. A null text is empty; two texts without
    paragraphs are alike. A single document follows itself. An empty table gives
    no rows. Other columns are not read.

    The rows are range-partitioned once, on id, hash and row number, so that an id
    or a text that many rows share is spread. A task compares its rows in order
    and writes its first and last text beside the results; these meet by the
    number of their partition.
    """
    text = F.coalesce(F.col(f"`{text_column}`"), F.lit(""))
    source = documents.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), text.alias("text"))
    order: list[Column | str] = [F.col("doc_id").isNull(), F.col("doc_id"), F.xxhash64("text")]
    ranged = source.withColumn("nth", F.monotonically_increasing_id()).repartitionByRange(*order, F.col("nth"))
    ranged = ranged.sortWithinPartitions(*order, "text").select("doc_id", "text", F.spark_partition_id().alias("part"))
    out = kept(ranged.mapInArrow(_chained(cells), f"{RESULT}, part int, kind int, text string"), "fingerprints")

    firsts = out.filter(F.col("kind") == FIRST).select("part", F.col("text").alias("following"))
    every = W.partitionBy(F.lit(1))  # the numbers of the partitions
    numbers = firsts.select("part")
    turns = numbers.select(
        F.col("part").alias("before"), F.coalesce(F.lead("part").over(every.orderBy("part")), F.min("part").over(every)).alias("part")
    )
    lasts = out.filter(F.col("kind") == LAST).select("doc_id", "text", F.col("part").alias("before"))
    borders = lasts.join(turns, "before").join(firsts, "part").select("doc_id", "text", "following")
    return out.filter(F.col("kind").isNull()).select(*RESULT_NAMES).unionByName(borders.mapInArrow(_pairs(cells), RESULT))


def fingerprints(documents: DataFrame, cells: int = CELLS, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, n_paragraphs, fingerprint`` per row, in one pass; edge cases as in ``edit_fingerprints``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                found = digests(part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(found.sizes), Sketch.of(found, cells).stored(found.sizes)],
                    ["doc_id", "n_paragraphs", "fingerprint"],
                )

    source = documents.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), F.col(f"`{text_column}`").alias("text"))
    return source.mapInArrow(run, "doc_id long, n_paragraphs long, fingerprint binary")
