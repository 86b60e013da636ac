"""Token counts, the BPE codec and packing, against the tokenizers library."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from lendmark.llm import bpe, packing, token_counts
from lendmark.llm.text import units

PATH = public_tokenizers.path("byte_bpe_50k.json")
ALPHABET = "aaAb.\"'b cd\n\t .,éß<|endoftext|> 　 \x1c\x85Ωк中🎉12³½ǅ'll 's"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def odd_texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def test_pieces_and_backtracking_give_the_librarys_ids(library):
    codec = bpe.codec(PATH)
    for text in [*odd_texts(1500, 1), "a<|endoftext|><|endoftext|> b", "'s's don't", "\n\n \t x"]:
        want = library.encode(text, add_special_tokens=False).ids
        assert codec.encode_many([text])[0] == want
        cut = units(pa.array([text]), list(codec.special))
        parts = [cut.values[i].as_py().decode() for i in cut.codes]
        assert "".join(parts) == text
        assert [i for p in parts for i in codec.encode_many([p])[0]] == want
        assert [i for p in parts for i in packing.unit_ids(PATH).encode([p])[0]] == want


def test_long_pieces_stay_linear(library):
    codec = bpe.codec(PATH)
    text = "x" * 60_000 + " " * 500 + "ab" * 20_000
    assert codec.encode_many([text])[0] == library.encode(text, add_special_tokens=False).ids


ROWS = [(1, "It's one text."), (2, None), (3, ""), (1, "It's one text."), (None, "no id <|endoftext|>"), (5, "word " * 4000)]


def test_counts_of_odd_rows(docs, library):
    rows = ROWS + list(enumerate(odd_texts(80, 2), 100))
    got = sorted(map(tuple, token_counts.count_tokens(docs(rows), PATH).collect()), key=repr)
    want = []
    for i, t in rows:
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        want.append((i, len((t or "").encode()), n, n > 512))
    assert got == sorted(want, key=repr)
    assert token_counts.count_tokens(docs([]), PATH).count() == 0


def test_codec_digests_and_round_trip(docs, library):
    rows = ROWS + list(enumerate(odd_texts(80, 3), 100))
    got = sorted(map(tuple, bpe.encode_digests(docs(rows), PATH).collect()), key=repr)
    want = []
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), *(hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), text))))
    assert got == sorted(want, key=repr)
    back = bpe.decode(bpe.encode(docs(rows), PATH), PATH).collect()
    assert sorted(((r[0], r[1]) for r in back), key=repr) == sorted(((i, t or "") for i, t in rows), key=repr)
    assert bpe.encode(docs([]), PATH).count() == 0


def test_best_fit_fills_every_slot_once():
    rng = np.random.default_rng(4)
    for capacity in (1, 7, 64):
        counts = {int(k): int(n) for k, n in zip(range(1, capacity + 1), rng.integers(0, 50, capacity)) if n}
        used, slots = {}, {k: 0 for k in counts}
        for length, rank, n, first, offset in packing.best_fit(counts, capacity):
            assert rank == slots[length]
            slots[length] += n
            for s in range(first, first + n):
                used.setdefault(s, []).append((offset, length))
        assert slots == counts
        for places in used.values():
            at = 0
            for offset, length in sorted(places):
                assert offset == at
                at += length
            assert at <= capacity
        total = sum(k * n for k, n in counts.items())
        assert len(used) <= 1.25 * -(-total // capacity) + 1


def test_packing_holds_every_token_once(docs, library, monkeypatch):
    rows = ROWS + list(enumerate(odd_texts(60, 5), 100))
    found = packing.pack(docs(rows), PATH, capacity=16).collect()
    by_doc = {}
    for r in found:
        by_doc.setdefault(r["doc_id"], []).append(r)
    for i in {i for i, _ in rows}:
        texts = [t for k, t in rows if k == i]
        ids = [*library.encode(texts[0] or "", add_special_tokens=False).ids, 2]
        pieces = sorted(by_doc[i], key=lambda r: (r["piece"], r["sequence_id"]))[:: len(texts)]
        assert [r["piece"] for r in pieces] == list(range(len(pieces)))
        at = 0
        for r in pieces:
            part = np.array(ids[at : at + r["length"]], dtype="<u4").tobytes()
            assert r["start"] == at and r["ids_crc32"] == zlib.crc32(part)
            assert r["length"] == 16 or r["piece"] == 0
            at += r["length"]
        assert at == len(ids)
    sequences = {}
    for r in found:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 16
    assert packing.pack(docs([]), PATH).count() == 0
