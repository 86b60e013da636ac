"""Whole texts as numpy arrays inside Arrow functions.

A batch of texts becomes one byte array with row offsets. Words and token units
are found on the bytes and dictionary-encoded by Arrow (exact, by value), so
per-word Python work is done once for each distinct word of a chunk.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

CHUNK_BYTES = 3 << 20

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
LETTER = np.zeros(256, dtype=bool)
LETTER[[*range(65, 91), *range(97, 123)]] = True


@dataclass
class Parts:
    """Parts of the rows of a chunk: ``codes`` point into ``values``; row i has ``bounds[i]:bounds[i + 1]``."""

    codes: np.ndarray
    values: pa.Array
    bounds: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    @cached_property
    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts)

    @cached_property
    def hashes(self) -> np.ndarray:
        """A 64-bit hash per part, computed once per distinct value."""
        distinct = np.fromiter(map(xxhash.xxh3_64_intdigest, self.values.to_pylist()), np.uint64, len(self.values))
        return distinct[self.codes] if len(distinct) else np.empty(0, np.uint64)

    def sums(self, per_value: np.ndarray) -> np.ndarray:
        """Sum of a number per distinct value over the parts of each row."""
        total = np.zeros(len(self.codes) + 1, dtype=per_value.dtype if len(per_value) else np.int64)
        if len(self.codes):
            np.cumsum(per_value[self.codes], out=total[1:])
        return total[self.bounds[1:]] - total[self.bounds[:-1]]


def chunks(batch: pa.RecordBatch, column: str = "text", size: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of about ``size`` bytes of text; a longer text is a slice of its own."""
    if not batch.num_rows:
        return
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(ends):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + size, side="right")))
        yield batch.slice(start, stop - start)
        start = stop
    pa.default_memory_pool().release_unused()  # workers live on; what a batch took goes back


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all rows, one after the other, and the offsets of the rows; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def encoded(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """Dictionary of the byte strings that tile ``data`` from ``starts`` on."""
    offsets = np.append(starts, len(data)).astype(np.int64)
    array = pa.Array.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))]
    )
    coded = array.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False), coded.dictionary


LONGEST = 64
RUN = 16
# What a byte is in a long word: a mark by itself, a letter, a digit, or of a character beyond ASCII.
KIND = np.arange(256, dtype=np.uint8)
KIND[LETTER] = 1
KIND[48:58] = 2
KIND[128:] = 3


def _cuts(data: np.ndarray, first: np.ndarray, starts: np.ndarray, inside: np.ndarray) -> None:
    """Mark in ``first`` where words of more than ``LONGEST`` bytes are cut.

    Cuts lie before characters beyond ASCII, between letters, digits and different
    marks, and after every ``RUN`` bytes of what is left.
    """
    sizes = np.add.reduceat(inside, starts, dtype=np.int64) if len(starts) else np.empty(0, np.int64)
    for k in np.flatnonzero(sizes > LONGEST):
        word = data[starts[k] : starts[k] + sizes[k]]
        kind, cut = KIND[word], (word & 0xC0) == 0xC0
        cut[0] = True
        cut[1:] |= kind[1:] != kind[:-1]
        runs = np.flatnonzero(cut)
        cut |= (np.arange(len(word)) - np.repeat(runs, np.diff(np.append(runs, len(word))))) % RUN == 0
        first[starts[k] : starts[k] + sizes[k]] = cut


def words(column: pa.Array, lower: bool = False, cut: bool = False) -> Parts:
    """Words ``[^\\x20\\x09-\\x0D]+`` of each row, optionally with A-Z lower-cased.

    With ``cut``, words of more than ``LONGEST`` bytes come as several parts.
    """
    data, offsets = raw(column)
    if lower:
        data = LOWER[data]
    inside = ~SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    begins = offsets[:-1][np.diff(offsets) > 0]
    first[begins] = inside[begins]
    starts = np.flatnonzero(first)
    if cut:
        _cuts(data, first, starts, inside)
        starts = np.flatnonzero(first)
    packed = np.cumsum(inside, dtype=np.int32)[starts] - 1
    codes, values = encoded(data[inside], packed)
    return Parts(codes, values, np.searchsorted(starts, offsets))


# White space beyond the ASCII blanks: a text holding it is cut only after printable ASCII.
RARE_SPACE = "[\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200f\u2028\u2029\u202f\u205f\u3000\ufeff]"

MARK = np.zeros(256, dtype=bool)
MARK[[b for b in range(0x21, 0x7F) if not LETTER[b] and not 0x30 <= b <= 0x39]] = True


def units(column: pa.Array, special: Sequence[str] = ()) -> Parts:
    """Pieces of each row that a byte-level tokenizer treats independently.

    A cut lies before a blank that follows a visible character, after a lone
    line end or tab between visible characters, and between an ASCII letter and
    an ASCII mark. The tokenizer's pattern never spans such a place, and what it
    finds after it doesn't depend on what comes before. Rows that hold one of
    the ``special`` strings are cut at blanks only, as those strings hold none.
    """
    data, offsets = raw(column)
    blank = SPACE[data]
    visible = ~blank
    filled = pc.fill_null(column, "")
    if (data >= 0x80).any() or (data < 0x20).any():
        strange = pc.match_substring_regex(filled, RARE_SPACE).to_numpy(zero_copy_only=False)
        if strange.any():
            visible &= ~np.repeat(strange, np.diff(offsets)) | ((data > 0x20) & (data < 0x7F))
    marked = LETTER[data]
    marked[:-1] &= MARK[data[1:]]
    for text in special:
        holds = pc.match_substring(filled, text).to_numpy(zero_copy_only=False)
        if holds.any():
            marked &= ~np.repeat(holds, np.diff(offsets))
    first = np.zeros(len(data), dtype=bool)
    first[1:] = (blank[1:] & visible[:-1]) | marked[:-1]
    if len(data) > 2:
        first[2:] |= visible[:-2] & blank[1:-1] & (data[1:-1] != 0x20) & visible[2:]
    first[offsets[:-1][np.diff(offsets) > 0]] = True
    starts = np.flatnonzero(first)
    codes, values = encoded(data, starts)
    return Parts(codes, values, np.searchsorted(starts, offsets))


def spread(codes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index that lays the runs ``offsets[c]:offsets[c + 1]`` of the codes end to end, and the ends of the runs."""
    sizes = np.diff(offsets)[codes]
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    index = np.repeat(offsets[codes] - ends[:-1], sizes) + np.arange(ends[-1])
    return index, ends
