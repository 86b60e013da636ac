"""Best-fit packing planned on the histogram of lengths.

Documents become pieces of at most ``capacity`` tokens. The plan works on
counts per length only (at most ``capacity`` numbers), so it costs the same for
any number of documents. It yields runs of slots per length; a piece takes the
slot of its rank among the pieces of its length.
"""

from __future__ import annotations

import math
import zlib
from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lendmark.functions.state import local_frame
from lendmark.llm.scratch import kept
from lendmark.llm.text import chunks, spread, units

CACHE_BYTES = 48 << 20  # of what a worker keeps
ENTRY_BYTES = 150  # of an entry beside its bytes
LONGEST_KEPT = 256

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class UnitIds:
    """Ids of distinct units in the vocabulary of a tokenizers file; bounded, and kept for the tasks of a worker.

    The merges run in tiktoken, several times faster than the tokenizers library
    on short texts and equal to it when ids follow the order of merges, which is
    checked; for other files the library itself encodes.
    """

    def __init__(self, path: str):
        import json

        import tiktoken

        from lendmark.llm.bpe import PATTERN, byte_symbols
        from lendmark.llm.token_counts import tokenizer

        with open(path, encoding="utf-8") as file:
            whole = json.load(file)
        model, symbols = whole["model"], byte_symbols()
        special = {t["content"]: t["id"] for t in whole.get("added_tokens", [])}
        self.special = list(special)
        merged = [model["vocab"]["".join(m) if isinstance(m, list) else m.replace(" ", "")] for m in model["merges"]]
        plain = (whole.get("pre_tokenizer") or {}).get("type") == "ByteLevel" and not whole.get("normalizer")
        if plain and merged == sorted(merged) and min(merged, default=256) >= 256:
            ranks = {bytes(symbols[c] for c in t): i for t, i in model["vocab"].items() if t not in special}
            coder = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
            self.encode = lambda texts: [coder.encode(t, allowed_special="all") for t in texts]
        else:
            library = tokenizer(path)
            self.encode = lambda texts: [c.ids for c in library.encode_batch_fast(texts, add_special_tokens=False)]
        self.forget()

    def forget(self) -> None:
        """Free the ids that are kept between chunks."""
        self.known: dict[bytes, bytes] = {}
        self.held = 0

    def rows(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows end to end, and the bounds of the rows."""
        pieces = units(texts, self.special)
        keys = pieces.values.to_pylist()
        if self.held > CACHE_BYTES:
            self.forget()
        fresh: dict[bytes, bytes] = {}
        missing = [k for k in keys if k not in self.known]
        for key, ids in zip(missing, self.encode([k.decode("utf-8", "replace") for k in missing])):
            fresh[key] = np.array(ids, dtype="<u4").tobytes()
        runs = [self.known[k] if k in self.known else fresh[k] for k in keys]
        short = {k: v for k, v in fresh.items() if len(k) <= LONGEST_KEPT}
        self.known.update(short)
        self.held += sum(ENTRY_BYTES + len(k) + len(v) for k, v in short.items())
        offsets = np.concatenate([[0], np.cumsum([len(r) // 4 for r in runs])]).astype(np.int64)
        index, ends = spread(pieces.codes, offsets)
        return np.frombuffer(b"".join(runs), "<u4")[index], ends[pieces.bounds]


@lru_cache(maxsize=2)
def unit_ids(path: str) -> UnitIds:
    return UnitIds(path)


def token_pieces(documents: DataFrame, tokenizer_path: str, capacity: int, end_id: int) -> DataFrame:
    """Pieces of each row (columns ``doc_id, text``): its ids and ``end_id``, cut where longer than ``capacity``.

    The first piece of a cut document takes the remainder, the others are full.
    """
    end = np.array([end_id], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = unit_ids(tokenizer_path)
        for batch in batches:
            for part in chunks(batch):
                ids, bounds = coder.rows(part.column("text"))
                totals = np.diff(bounds) + 1
                n_pieces = -(-totals // capacity)
                row = np.repeat(np.arange(len(totals)), n_pieces)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(n_pieces) - n_pieces, n_pieces)
                first = totals - (n_pieces - 1) * capacity
                start = np.where(piece == 0, 0, first[row] + (piece - 1) * capacity)
                length = np.where(piece == 0, first[row], capacity)
                data = memoryview(ids.astype("<u4", copy=False)).cast("B")
                sums = []
                for r, a, n in zip(row.tolist(), start.tolist(), length.tolist()):
                    at = 4 * (int(bounds[r]) + a)
                    if a + n == totals[r]:
                        sums.append(zlib.crc32(end, zlib.crc32(data[at : at + 4 * (n - 1)])))
                    else:
                        sums.append(zlib.crc32(data[at : at + 4 * n]))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                     pa.array(length, pa.int64()), pa.array(sums, pa.int64())],
                    ["doc_id", "piece", "start", "length", "ids_crc32"],
                )
        coder.forget()

    return documents.mapInArrow(cut, PIECES)


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Runs ``(length, from_rank, n, first_sequence, offset)``: rank from_rank + i goes to first_sequence + i at offset.

    Longest lengths first; each takes the open sequences with the least room
    that still hold it, all sequences of equal room at once. Sequences that
    were opened together are kept as ranges, so the work depends on the number
    of lengths, not on the counts.
    """
    room: list[deque[tuple[int, int]]] = [deque() for _ in range(capacity + 1)]  # by free tokens: (first, n)
    runs, opened = [], 0
    for length in sorted(counts, reverse=True):
        rank, left, free = 0, counts[length], length
        while left:
            while free <= capacity and not room[free]:
                free += 1
            if free > capacity:
                # at most the ranges that hold a whole number of pieces and one that holds the rest
                per_sequence = capacity // length
                n = max(1, left // per_sequence)
                room[capacity].append((opened, n))
                opened += n
                free = capacity
            first, n = room[free].popleft()
            if n > left:
                room[free].appendleft((first + left, n - left))
                n = left
            runs.append((length, rank, n, first, capacity - free))
            room[free - length].append((first, n))
            rank, left = rank + n, left - n
            if free - length >= length:
                free -= length
    return runs


def ranked(pieces: DataFrame, counts: dict[int, int]) -> DataFrame:
    """Adds ``rank``, from 0 within each length, without gathering a length in one task.

    A length of n pieces is dealt into about sqrt(n) / 4 hash buckets, so that
    both a bucket and the list of buckets grow with the root of n only; ranks are counted
    within a bucket and moved by the sizes of the buckets before it.
    """
    spark = pieces.sparkSession
    buckets = local_frame(
        spark, [(k, 1 + math.isqrt(n) // 4) for k, n in sorted(counts.items())], "length long, n_buckets long"
    )
    dealt = pieces.join(F.broadcast(buckets), "length").withColumn(
        "bucket", F.pmod(F.xxhash64("doc_id", "piece", "start", "ids_crc32"), "n_buckets")
    )
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = dealt.groupBy("length", "bucket").count()
    sizes = sizes.select("length", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "start", "ids_crc32")
    numbered = dealt.withColumn("place", F.row_number().over(within) - 1)
    return numbered.join(sizes, ["length", "bucket"]).withColumn("rank", F.col("base") + F.col("place"))


def placed(pieces: DataFrame, capacity: int) -> DataFrame:
    """Adds ``sequence_id, offset`` to written pieces with a ``length`` of 1 to ``capacity``."""
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most capacity rows
    runs = best_fit(counts, capacity)
    spark: SparkSession = pieces.sparkSession
    plan = local_frame(
        spark, runs, "length long, from_rank long, n_slots long, first_sequence long, offset long"
    ).withColumnRenamed("length", "slot_length")
    if not counts:
        return pieces.select("*", F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    numbered = ranked(pieces, counts)
    step = F.col("rank") - F.col("from_rank")
    taken = numbered.join(
        plan, (F.col("length") == F.col("slot_length")) & (step >= 0) & (step < F.col("n_slots"))
    )
    return taken.select(*pieces.columns, (F.col("first_sequence") + step).alias("sequence_id"), "offset")


def pack(
    documents: DataFrame,
    tokenizer_path: str,
    capacity: int = 1024,
    end_id: int = 2,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset``: every piece and its slot.

    Pieces are written once to the shared folder (about 40 bytes each), then
    counted and placed. Null and empty texts are one piece with the end id.
    Repeated rows are packed each; null ids are kept; other columns are not
    read. An empty table gives no rows.
    """
    source = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return placed(kept(token_pieces(source, tokenizer_path, capacity, end_id), "pieces"), capacity)
