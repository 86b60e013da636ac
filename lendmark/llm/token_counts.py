"""Token counts of whole texts: batch encoding in an Arrow function that returns lengths only."""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendmark.llm.text import chunks, units

CACHE_ENTRIES = 400_000


@lru_cache(maxsize=2)
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core
    from tokenizers import Tokenizer

    loaded = Tokenizer.from_file(path)
    loaded.no_truncation()
    loaded.no_padding()
    return loaded


class Lengths:
    """Number of tokens per distinct unit; bounded, and kept for the tasks of a worker."""

    def __init__(self, path: str):
        self.tokenizer, self.known = tokenizer(path), {}
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]

    def of(self, values: pa.Array) -> np.ndarray:
        keys = values.to_pylist()
        if len(self.known) > CACHE_ENTRIES:
            self.known = {}
        missing = [k for k in keys if k not in self.known]
        texts = [k.decode("utf-8", "replace") for k in missing]
        coded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        self.known.update(zip(missing, map(len, coded)))
        return np.fromiter((self.known[k] for k in keys), np.int64, len(keys))

    def per_row(self, texts: pa.Array) -> np.ndarray:
        pieces = units(texts, self.special)
        return pieces.sums(self.of(pieces.values))


@lru_cache(maxsize=2)
def lengths(path: str) -> Lengths:
    return Lengths(path)


def count_tokens(
    documents: DataFrame, tokenizer_path: str, limit: int = 512, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` per row.

    Counts are those of the tokenizers library without added special tokens,
    truncation or padding. The rows of an Arrow batch are dealt into chunks of
    equal bytes; every text is split at safe boundaries (before a blank that
    follows a visible character), and equal pieces of a chunk are encoded once.

    Null and empty texts have 0 bytes and 0 tokens. A text without a blank is
    one piece. Repeated rows and null ids are kept. Other columns are not read,
    so their names cannot clash.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = lengths(tokenizer_path)
        for batch in batches:
            for part in chunks(batch):
                tokens = known.per_row(part.column("text"))
                size = pc.fill_null(pc.binary_length(part.column("text")), 0).cast(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), size, pa.array(tokens, pa.int64()), pa.array(tokens > limit)],
                    ["doc_id", "n_bytes", "n_tokens", "over_limit"],
                )

    source = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return source.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
