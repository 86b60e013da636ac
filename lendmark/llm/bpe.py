"""Byte-pair encoding by backtracking over longest matches, and decoding by an offset table.

The encoder never simulates merges. An Aho-Corasick automaton over reversed
tokens, run over many pieces at once, gives the longest token that starts at
every position; a table of token prefixes gives the shorter ones.
Two neighbouring tokens are compatible when the merge rules would leave the
border between them; a sequence whose neighbours are all compatible is the one
that the merge rules produce. Every prefix has only one such sequence, so a
position from which no token fits is dead for good, and the search is linear.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendmark.llm.text import chunks, spread, units

NEVER = 1 << 60
COMPAT_ENTRIES = 1_000_000
CACHE_ENTRIES = 600_000

# Fixed value: the published pre-tokenizer pattern of the byte-level vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_symbols() -> dict[str, int]:
    """Characters that stand for bytes in a byte-level vocabulary file: visible
    Latin-1 characters stand for themselves, the others follow from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(0x100 + k): b for k, b in enumerate(hidden)}


def automaton(words: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Aho-Corasick as a full transition table, and per state the longest word that ends there (or -1)."""
    children: list[dict[int, int]] = [{}]
    own = [-1]
    for word, number in words.items():
        node = 0
        for byte in word:
            if byte not in children[node]:
                children[node][byte] = len(children)
                children.append({})
                own.append(-1)
            node = children[node][byte]
        own[node] = number
    step = np.zeros((len(children), 256), dtype=np.int32)
    found = np.array(own, dtype=np.int32)
    fallback = [0] * len(children)
    level = [0]
    while level:
        after = []
        for node in level:
            if node:
                step[node] = step[fallback[node]]
                if found[node] < 0:
                    found[node] = found[fallback[node]]
            for byte, child in children[node].items():
                fallback[child] = int(step[fallback[node], byte]) if node else 0
                after.append(child)
            for byte, child in children[node].items():
                step[node, byte] = child
        level = after
    return step, found


class Codec:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str, pattern: str = PATTERN):
        import regex

        model = json.loads(Path(path).read_text(encoding="utf-8"))
        symbols = byte_symbols()
        vocab = model["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in model.get("added_tokens", [])}
        self.size = {}
        texts = {}
        for token, number in vocab.items():
            if token not in self.special:
                texts[number] = bytes(symbols[c] for c in token)
        texts |= {number: content.encode() for content, number in self.special.items()}
        self.texts = texts

        self.rank, self.halves = {}, {}
        for k, pair in enumerate(model["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            a, b, whole = vocab[left], vocab[right], vocab[left + right]
            self.rank[a, b] = k
            self.halves.setdefault(whole, (a, b, k))

        for number, text in texts.items():
            if len(text) == 1 or number in self.halves:
                self.size[number] = len(text)
        number_of = {text: number for number, text in texts.items() if number in self.size}
        self.shorter = {}  # the longest other token that a token begins with, or -1
        for number in self.size:
            text = texts[number]
            prefixes = (number_of.get(text[:k]) for k in range(len(text) - 1, 0, -1))
            self.shorter[number] = next((p for p in prefixes if p is not None), -1)

        self.step, self.found = automaton({texts[n][::-1]: n for n in self.size})

        last = max(texts, default=-1)
        lengths = np.array([len(texts.get(i, b"")) for i in range(last + 1)], dtype=np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(lengths)])
        self.bytes = np.frombuffer(b"".join(texts.get(i, b"") for i in range(last + 1)), np.uint8)

        self.pattern = regex.compile(pattern)
        names = sorted(self.special, key=len, reverse=True)
        self.split = re.compile("(" + "|".join(map(re.escape, names)) + ")").split if names else lambda t: [t]
        self.compatible = {}

    def spine(self, token: int, side: int) -> list[tuple[int, int]]:
        """Parts of a token along one edge, each with the rank of the merge that takes it up."""
        found = [(token, NEVER)]
        while token in self.halves:
            taken_at = self.halves[token][2]
            token = self.halves[token][side]
            found.append((token, taken_at))
        return found

    def fits(self, a: int, b: int) -> bool:
        """Whether no merge crosses the border of neighbours a and b.

        A merge of the inner parts crosses it if it comes before both parts are
        taken up elsewhere; of equal merges the left one comes first.
        """
        known = self.compatible.get((a, b))
        if known is None:
            known = True
            right_edge = self.spine(a, 1)
            for y, y_taken in self.spine(b, 0):
                for x, x_taken in right_edge:
                    if (k := self.rank.get((x, y))) is not None and k < x_taken and k <= y_taken:
                        known = False
            if len(self.compatible) >= COMPAT_ENTRIES:
                self.compatible.clear()
            self.compatible[a, b] = known
        return known

    def longest(self, pieces: list[bytes]) -> np.ndarray:
        """For every byte of the pieces, laid end to end, the longest token that starts there within its piece."""
        data = np.frombuffer(b"".join(pieces), np.uint8)
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        order = np.argsort(-sizes, kind="stable")
        last = (np.cumsum(sizes) - 1)[order]
        longer = len(sizes) - np.searchsorted(np.sort(sizes), np.arange(sizes.max(initial=0)), side="right")
        state = np.zeros(len(pieces), dtype=np.int32)
        found = np.empty(len(data), dtype=np.int32)
        for back, n in enumerate(longer.tolist()):  # from the last byte of each piece to its first
            at = last[:n] - back
            state = self.step[state[:n], data[at]]
            found[at] = self.found[state]
        return found

    def backtrack(self, longest: list[int]) -> list[int]:
        """Ids of one piece from the longest token at each of its places."""
        n = len(longest)
        size, shorter, fits = self.size, self.shorter, self.fits
        dead = set()
        path: list[int] = []
        at, token = 0, longest[0]
        while at < n:
            if token < 0:
                if not path:
                    raise ValueError("the vocabulary lacks a byte of this text")
                dead.add(at)
                token = path.pop()
                at -= size[token]
                token = shorter[token]
                continue
            end = at + size[token]
            if end not in dead and (not path or fits(path[-1], token)):
                path.append(token)
                at = end
                if at < n:
                    token = longest[at]
            else:
                token = shorter[token]
        return path

    def pieces(self, text: str) -> list[str]:
        """What the merge rules may span: matches of the pattern between special strings."""
        plain = text[1:] if text[:1] == " " else text
        if plain.isalpha():
            return [text]
        found = []
        for part in self.split(text):
            found += [part] if part in self.special else self.pattern.findall(part)
        return found

    def encode_many(self, texts: list[str]) -> list[list[int]]:
        pieces = [self.pieces(t) for t in texts]
        flat = [p for found in pieces for p in found]
        coded = [b"" if p in self.special else p.encode() for p in flat]
        longest = self.longest(coded).tolist()
        ids, at = [], 0
        for piece, data in zip(flat, coded):
            ids.append(self.backtrack(longest[at : at + len(data)]) if data else [self.special[piece]])
            at += len(data)
        rows, at = [], 0
        for found in pieces:
            rows.append([i for part in ids[at : at + len(found)] for i in part])
            at += len(found)
        return rows

    def decode_bytes(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all ids end to end, and where each id ends."""
        index, ends = spread(ids, self.offsets)
        return self.bytes[index], ends


@lru_cache(maxsize=2)
def codec(path: str, pattern: str = PATTERN) -> Codec:
    return Codec(path, pattern)


class UnitCache:
    """Ids of distinct units, as bytes and as decimal text; bounded, and kept for the tasks of a worker."""

    def __init__(self, path: str):
        self.codec, self.known = codec(path), {}

    def runs(self, keys: list[bytes]) -> list[tuple[bytes, bytes]]:
        if len(self.known) > CACHE_ENTRIES:
            self.known.clear()
        known = self.known
        missing = [k for k in keys if k not in known]
        for key, ids in zip(missing, self.codec.encode_many([k.decode("utf-8", "replace") for k in missing])):
            known[key] = np.array(ids, dtype=np.uint32).tobytes(), b"".join([b"%d," % i for i in ids])
        return [known[k] for k in keys]


@lru_cache(maxsize=2)
def unit_cache(path: str) -> UnitCache:
    return UnitCache(path)


@dataclass
class Encoded:
    """Ids of the rows of a chunk end to end, with the bounds of the rows, and their decimal text."""

    ids: np.ndarray
    bounds: np.ndarray
    decimal: list[bytes]


def encoded_rows(texts: pa.Array, cache: UnitCache) -> Encoded:
    pieces = units(texts, list(cache.codec.special))
    runs = cache.runs(pieces.values.to_pylist())
    offsets = np.concatenate([[0], np.cumsum([len(ids) // 4 for ids, _ in runs])]).astype(np.int64)
    index, ends = spread(pieces.codes, offsets)
    ids = np.frombuffer(b"".join([ids for ids, _ in runs]), np.uint32)[index]
    decimal = [runs[c][1] for c in pieces.codes.tolist()]
    edges = pieces.bounds.tolist()
    return Encoded(ids, ends[pieces.bounds], [b"".join(decimal[a:b])[:-1] for a, b in zip(edges, edges[1:])])


def encode(
    documents: DataFrame, tokenizer_path: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``doc_id, ids`` per row: the ids that the merge rules give, without added special tokens.

    Special strings inside a text become their id. Null and empty texts give an
    empty list; null ids and repeated rows are kept; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = unit_cache(tokenizer_path)
        for batch in batches:
            for part in chunks(batch):
                found = encoded_rows(part.column("text"), cache)
                lists = pa.ListArray.from_arrays(
                    pa.array(found.bounds, pa.int32()), pa.array(found.ids.astype(np.int32))
                )
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), lists], ["doc_id", "ids"])

    source = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return source.mapInArrow(run, "doc_id long, ids array<int>")


def decoded_rows(ids: np.ndarray, bounds: np.ndarray, code: Codec) -> list[bytes]:
    """UTF-8 of the rows, rebuilt from their ids through the offset table."""
    data, ends = code.decode_bytes(ids)
    data, edges = data.tobytes(), ends[bounds].tolist()
    return [data[a:b].decode("utf-8", "replace").encode() for a, b in zip(edges, edges[1:])]


def sha256(texts: list[bytes]) -> pa.Array:
    return pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string())


def encode_digests(
    documents: DataFrame, tokenizer_path: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` per row, encoded and decoded in one pass.

    The decoded text is rebuilt from the ids alone. Edge cases as in ``encode``:
    null and empty texts have 0 tokens and the digest of the empty string.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = unit_cache(tokenizer_path)
        for batch in batches:
            for part in chunks(batch):
                found = encoded_rows(part.column("text"), cache)
                texts = decoded_rows(found.ids, found.bounds, cache.codec)
                counts = pa.array(np.diff(found.bounds), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), counts, sha256(found.decimal), sha256(texts)],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    source = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return source.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def decode(encoded: DataFrame, tokenizer_path: str, id_column: str = "doc_id", ids_column: str = "ids") -> DataFrame:
    """``doc_id, text`` from lists of ids; null lists and null or unknown ids give no bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = codec(tokenizer_path)
        for batch in batches:
            texts = []
            for ids in batch.column("ids").to_pylist():
                ids = np.array([i for i in ids or [] if i is not None and 0 <= i < len(code.offsets) - 1], np.int64)
                texts.append(code.decode_bytes(ids)[0].tobytes().decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    source = encoded.select(F.col(id_column).cast("long").alias("doc_id"), F.col(ids_column).alias("ids"))
    return source.mapInArrow(run, "doc_id long, text string")
