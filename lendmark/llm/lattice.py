"""Language-model scores from the lattice of subwords.

The pieces are those of an existing vocabulary; their probabilities are learned
from the learning rows (how often the tokenizer uses a piece there, plus one).
A text is its words, each with a blank before it, and an end. Its probability is
the sum over all ways to segment it, which factors at the blanks: a word's
marginal comes from a forward recursion in log space, run once per distinct word
of the corpus. Word counts, for the base score, come from the same pass.

Scores are sums over words, so documents never meet the whole word table:
frequent words (a bounded number) are looked up where the text is read, all
others go to the shard of their hash, and partial sums return to the documents.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendmark.llm.bpe import automaton, byte_symbols
from lendmark.llm.packing import unit_ids
from lendmark.llm.scratch import kept
from lendmark.llm.substrings import LAST_ID
from lendmark.llm.text import chunks, words

SHARD_BYTES = 48 << 20
FREQUENT = 20_000  # a word with at least this share (one in so many) of all tokens is frequent; there are no more of them


def held_out(id_column: Column) -> Column:
    """Rows kept from learning: crc32 of the id as text, modulo 7, is 2; a null id is not held out."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 7 == 2, F.lit(False))


# ------------------------------------------------------------------ word table


def word_counts(source: DataFrame) -> DataFrame:
    """``word, c, t``: occurrences in learning rows and in all rows of ``learn, text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                found = words(part.column("text"), lower=True)
                learn = part.column("learn").to_numpy(zero_copy_only=False)
                n = len(found.values)
                every = np.bincount(found.codes, minlength=n)
                learned = np.bincount(found.codes[learn[found.rows]], minlength=n)
                yield pa.RecordBatch.from_arrays(
                    [found.values.cast(pa.binary()).cast(pa.string()), pa.array(learned, pa.int64()), pa.array(every, pa.int64())],
                    ["word", "c", "t"],
                )

    flat = source.select("learn", "text").mapInArrow(run, "word string, c long, t long")
    return flat.groupBy("word").agg(F.sum("c").alias("c"), F.sum("t").alias("t"))


def piece_counts(table: DataFrame, tokenizer_path: str) -> dict[int, int]:
    """How often the tokenizer uses each piece for the learning words; at most one number per piece of the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, totals = unit_ids(tokenizer_path), np.zeros(0, np.int64)
        for batch in batches:
            ids = coder.encode([" " + w for w in batch.column("word").to_pylist()])
            flat = np.array([i for row in ids for i in row], dtype=np.int64)
            times = np.repeat(batch.column("c").to_numpy(), [len(row) for row in ids])
            own = np.bincount(flat, weights=times, minlength=len(totals)).astype(np.int64)
            own[: len(totals)] += totals
            totals = own
        used = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(totals[used])], ["piece", "n"])

    rows = table.filter("c > 0").select("word", "c").mapInArrow(run, "piece long, n long")
    return {r["piece"]: r["n"] for r in rows.groupBy("piece").agg(F.sum("n").alias("n")).collect()}


def vocabulary(path: str) -> dict[int, bytes]:
    """Bytes of the ordinary pieces of a byte-level vocabulary file."""
    with open(path, encoding="utf-8") as file:
        whole = json.load(file)
    symbols, special = byte_symbols(), {t["id"] for t in whole.get("added_tokens", [])}
    return {i: bytes(symbols[c] for c in t) for t, i in whole["model"]["vocab"].items() if i not in special}


def mass(texts: dict[int, bytes], counts: dict[int, int], n_ends: int) -> int:
    """What the probabilities are shares of: all counts plus one for every piece and for the end."""
    return sum(counts.get(i, 0) for i in texts) + n_ends + len(texts) + 1


def end_log(path: str, counts: dict[int, int], n_ends: int) -> float:
    return float(np.log10((n_ends + 1) / mass(vocabulary(path), counts, n_ends)))


class Lattice:
    """Log10 probabilities of the pieces of a vocabulary, and the marginals of words."""

    def __init__(self, path: str, counts: dict[int, int], n_ends: int):
        texts = vocabulary(path)
        total = mass(texts, counts, n_ends)
        last = max(texts) + 1
        self.logs, self.sizes = np.full(last, -np.inf), np.zeros(last, np.int64)
        self.suffix = np.full(last, -1, np.int64)  # the longest other piece that a piece ends with
        number = {t: i for i, t in texts.items()}
        for i, text in texts.items():
            self.logs[i] = np.log10((counts.get(i, 0) + 1) / total)
            self.sizes[i] = len(text)
            self.suffix[i] = next((number[text[k:]] for k in range(1, len(text)) if text[k:] in number), -1)
        self.step, self.found = automaton(number)

    def marginals(self, texts: list[bytes]) -> np.ndarray:
        """Log10 of the sum over all segmentations, per text."""
        out = np.zeros(len(texts))
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        order = np.argsort(-sizes, kind="stable")
        at = 0
        while at < len(order):
            longest = int(sizes[order[at]])
            part = order[at : at + max(1, 2_000_000 // (longest + 1))]
            at += len(part)
            out[part] = self._group([texts[i] for i in part.tolist()], sizes[part])
        return out

    def _group(self, texts: list[bytes], sizes: np.ndarray) -> np.ndarray:
        """Texts in order of falling length; one step of the recursion for all of them at once."""
        n, longest = len(texts), int(sizes[0]) if len(sizes) else 0
        forward = np.full((longest + 1, n), -np.inf)
        forward[0] = 0.0
        data = np.frombuffer(b"".join(texts), np.uint8)
        begins = np.cumsum(sizes) - sizes
        state = np.zeros(n, dtype=np.int32)
        for j in range(1, longest + 1):
            live = int(np.searchsorted(-sizes, -j, side="right"))
            state = self.step[state[:live], data[begins[:live] + j - 1]]
            who, piece = np.arange(live), self.found[state].astype(np.int64)
            while len(who):
                some = piece >= 0
                who, piece = who[some], piece[some]
                if not len(who):
                    break
                value = forward[j - self.sizes[piece], who] + self.logs[piece]
                have = forward[j, who]
                top = np.maximum(have, value)
                forward[j, who] = top + np.log1p(10.0 ** (np.minimum(have, value) - top)) / np.log(10)
                piece = self.suffix[piece]
        return forward[sizes, np.arange(n)]


@lru_cache(maxsize=1)
def _lattice(path: str, counts: tuple[tuple[int, int], ...], n_ends: int) -> Lattice:
    return Lattice(path, dict(counts), n_ends)


def _hashes(values: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, values), np.uint64, len(values))


def weighed(table: DataFrame, shared) -> DataFrame:
    """``word, c`` with ``marginal``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [b" " + w.encode() for w in batch.column("word").to_pylist()]
            values = _lattice(*shared.value).marginals(own)
            yield pa.RecordBatch.from_arrays(
                [batch.column("word"), batch.column("c"), pa.array(values)], ["word", "c", "marginal"]
            )

    return table.select("word", "c").mapInArrow(run, "word string, c long, marginal double")


def _packed_words(table: DataFrame, shared, shards: int) -> DataFrame:
    """The word table, packed for its shards: hash, log10(c + 1), marginal, whether c > 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [w.encode() for w in batch.column("word").to_pylist()]
            values = _lattice(*shared.value).marginals([b" " + t for t in texts])
            hashes, c = _hashes(texts), batch.column("c").to_numpy()
            shard = (hashes % np.uint64(shards)).astype(np.int64)
            order = np.argsort(shard, kind="stable")
            edges = np.searchsorted(shard[order], np.arange(shards + 1))
            parts = [(k, order[a:b]) for k, (a, b) in enumerate(zip(edges, edges[1:])) if b > a]
            columns = (hashes, np.log10(c + 1.0), values, (c > 0).astype(np.uint8))
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in parts], pa.int32()),
                 *(pa.array([v[i].tobytes() for _, i in parts], pa.binary()) for v in columns)],
                ["shard", "hashes", "bases", "marginals", "known"],
            )

    return table.select("word", "c").mapInArrow(
        run, "shard int, hashes binary, bases binary, marginals binary, known binary"
    )


# -------------------------------------------------------------------- documents

ENTRIES = "shard int, chunk long, docs binary, tokens binary, knowns binary, bases binary, scores binary, " \
    "hashes binary, owners binary, times binary"  # fmt: skip
PARTS = "shard int, chunk long, docs binary, tokens binary, knowns binary, bases binary, scores binary, " \
    "owners binary, known_sums binary, base_sums binary, score_sums binary"  # fmt: skip
SUMS = "doc_id long, n_tokens long, n_known long, base double, score double"
HOME = ("docs", "tokens", "knowns", "bases", "scores")


def _names(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(", ")]


def _entries(source: DataFrame, frequent, shards: int) -> DataFrame:
    """Per chunk of documents and shard: the words that the shard has to look up.

    One of the rows of a chunk also holds its documents and the sums that are
    known already. A chunk is named by its content.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_word = frequent.value
        for batch in batches:
            for part in chunks(batch):
                found = words(part.column("text"), lower=True)
                texts = found.values.to_pylist()
                n_values = max(len(texts), 1)
                known = [of_word.get(t) for t in texts]
                common = np.array([k is not None for k in known], dtype=bool)
                table = np.array([k or (0.0, 0.0, 0) for k in known], dtype=np.float64).reshape(-1, 3)
                base, marginal, n_known = (found.sums(np.ascontiguousarray(table[:, k])) for k in range(3))
                rare = ~common[found.codes] if len(texts) else np.empty(0, bool)
                pairs, times = np.unique(found.rows[rare] * n_values + found.codes[rare], return_counts=True)
                lookup = np.zeros(len(texts), np.uint64)
                lookup[~common] = _hashes([t for t, k in zip(texts, known) if k is None])
                hashes, owner = lookup[pairs % n_values], (pairs // n_values).astype(np.uint32)
                shard = (hashes % np.uint64(shards)).astype(np.int64)
                order = np.argsort(shard, kind="stable")
                edges = np.searchsorted(shard[order], np.arange(shards + 1))
                docs = part.column("doc_id").to_numpy()
                name = xxhash.xxh3_64_intdigest(docs.tobytes() + hashes.tobytes() + base.tobytes()) >> 1
                home = [v.tobytes() for v in (docs, found.counts, n_known.astype(np.int64), base, marginal)]
                out: list[list] = [[] for _ in range(10)]
                for k in range(shards):
                    mine = order[edges[k] : edges[k + 1]]
                    here = k == name % shards
                    if len(mine) or here:
                        own = (hashes[mine].tobytes(), owner[mine].tobytes(), times[mine].astype(np.uint32).tobytes())
                        for column, value in zip(out, (k, name, *(home if here else [b""] * 5), *own)):
                            column.append(value)
                kinds = [pa.int32(), pa.int64(), *[pa.binary()] * 8]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], _names(ENTRIES))

    return source.select("doc_id", "text").mapInArrow(run, ENTRIES)


def _looked_up(entries: pa.Table, table: pa.Table) -> pa.Table:
    """Sums of a shard's words per chunk and document; a row for each row of entries."""
    parts = table.to_pylist()
    hashes, bases, marginals, known = (
        np.concatenate([np.frombuffer(p[c], t) for p in parts] or [np.empty(0, t)])
        for c, t in (("hashes", np.uint64), ("bases", np.float64), ("marginals", np.float64), ("known", np.uint8))
    )
    order = np.argsort(hashes)
    hashes, bases, marginals, known = hashes[order], bases[order], marginals[order], known[order].astype(np.int64)
    sums: list[list[bytes]] = [[] for _ in range(4)]
    for row in entries.select(["hashes", "owners", "times"]).to_pylist():
        owner, place = np.unique(np.frombuffer(row["owners"], np.uint32), return_inverse=True)
        times = np.frombuffer(row["times"], np.uint32)
        at = np.searchsorted(hashes, np.frombuffer(row["hashes"], np.uint64))
        n = len(owner)
        values = (
            owner,
            np.bincount(place, times * known[at], n).astype(np.int64),
            np.bincount(place, times * bases[at], n),
            np.bincount(place, times * marginals[at], n),
        )
        for column, value in zip(sums, values):
            column.append(value.tobytes())
    kept_columns = {c: entries[c] for c in ("shard", "chunk", *HOME)}
    added = zip(("owners", "known_sums", "base_sums", "score_sums"), sums)
    return pa.table(kept_columns | {c: pa.array(v, pa.binary()) for c, v in added})


def _summed(table: pa.Table) -> pa.Table:
    """Results of the documents of one chunk, and of every further chunk that is equal to it."""
    rows = table.to_pylist()
    home = next(r for r in rows if r["docs"])
    copies = sum(r["shard"] == home["shard"] for r in rows)
    docs, tokens, known, base, score = (
        np.frombuffer(home[c], t) for c, t in zip(HOME, (np.int64, np.int64, np.int64, np.float64, np.float64))
    )
    more = [np.zeros(len(docs)) for _ in range(3)]
    for row in rows:
        owner = np.frombuffer(row["owners"], np.uint32)
        for total, (c, t) in zip(more, (("known_sums", np.int64), ("base_sums", np.float64), ("score_sums", np.float64))):
            total[owner] += np.frombuffer(row[c], t)
    known, base, score = (a + m / copies for a, m in zip((known, base, score), more))
    values = (docs, tokens, np.rint(known).astype(np.int64), base, score)
    return pa.table({n: np.tile(v, copies) for n, v in zip(_names(SUMS), values)})


def score(
    documents: DataFrame, tokenizer_path: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` per row.

    A-Z are lower-cased; tokens are words between ASCII blanks and one end per
    row. ``base_score`` is the unigram score with one added to counts,
    ``score`` the lattice's log10 probability. Null and empty texts are an end
    alone. Repeated rows and null ids are kept (a null id is learned from);
    other columns are not read. An empty table gives no rows.
    """
    key, text = F.col(f"`{id_column}`").cast("long"), F.col(f"`{text_column}`")
    source = documents.select(
        F.coalesce(key, F.lit(LAST_ID)).alias("doc_id"), (~held_out(key)).alias("learn"), F.coalesce(text, F.lit("")).alias("text")
    )
    table = kept(word_counts(source), "words")
    size, n_docs = source.agg(F.sum(F.octet_length("text")), F.count(F.when(F.col("learn"), 1))).first()
    c_all, t_all, distinct = table.agg(F.sum("c"), F.sum("t"), F.count(F.when(F.col("c") > 0, 1))).first()
    n_train = (c_all or 0) + n_docs
    n_kinds = distinct + (n_docs > 0)
    shards = max(1, -(-(size or 0) // SHARD_BYTES))
    context = documents.sparkSession.sparkContext
    pieces = tuple(sorted(piece_counts(table, tokenizer_path).items()))
    shared = context.broadcast((tokenizer_path, pieces, n_docs))
    often = F.col("t") * FREQUENT >= F.lit(t_all or 0)
    top = weighed(table.filter(often).repartition(8), shared).collect()  # at most FREQUENT words
    frequent = context.broadcast(
        {r["word"].encode(): (float(np.log10(r["c"] + 1.0)), r["marginal"], int(r["c"] > 0)) for r in top}
    )
    entries = _entries(source, frequent, shards)
    packed = _packed_words(table.filter(~often), shared, shards)
    parts = entries.groupBy("shard").cogroup(packed.groupBy("shard")).applyInArrow(_looked_up, PARTS)
    sums = parts.groupBy("chunk").applyInArrow(_summed, SUMS)
    end = end_log(tokenizer_path, dict(pieces), n_docs)
    doc_id = F.when(F.col("doc_id") < LAST_ID, F.col("doc_id"))
    tokens = F.col("n_tokens") + 1
    per_token = float(np.log10(n_train + n_kinds + 1))
    return sums.select(
        doc_id.alias("doc_id"),
        held_out(doc_id).alias("held_out"),
        tokens.alias("n_tokens"),
        (F.col("n_known") + int(n_docs > 0)).alias("n_known"),
        F.lit(n_train).cast("long").alias("train_tokens"),
        (F.col("base") + float(np.log10(n_docs + 1.0)) - tokens * per_token).alias("base_score"),
        (F.col("score") + end).alias("score"),
    )
