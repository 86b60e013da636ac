"""Quality, personal data and language-model scores."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lendmark.llm import lattice, pii, quality
from lendmark.llm import text as text_parts

PATH = public_tokenizers.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.01"
RULES = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def brute_spans(text):
    out = []
    for k, kind in enumerate(pii.KINDS):
        for m in RULES[kind].finditer(text):
            digits = [int(c) for c in re.sub("[^0-9]", "", m[0])]
            doubled = [d if k % 2 == 0 else 2 * d - 9 * (d > 4) for k, d in enumerate(reversed(digits))]
            good = {
                "email": lambda: True,
                "ip": lambda: all(int(p) <= 255 for p in m[0].split(".")),
                "card": lambda: 12 <= len(digits) <= 19 and sum(doubled) % 10 == 0,
                "phone": lambda: 9 <= len(digits) <= 15,
            }[kind]()
            if good:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def test_base_rules_equal_plain_regular_expressions():
    rng = random.Random(1)
    for alphabet in ("ab@.-_ é1", "0123456789 -.", "+1(2) 3.4-5@", "a@b.c @d", "01.2.5"):
        for _ in range(3000):
            text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 45)))
            assert pii.base_spans(text) == brute_spans(text)
            flat = [w for island in pii.islands(text) for w in island]
            assert flat == sorted(set(flat))
            every = [(m.start(), m.end()) for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]
            assert set(flat) <= set(every)
            assert all(w in flat for w in every if re.search("[0-9@]", text[slice(*w)]))


def test_viterbi_finds_the_best_of_all_paths():
    rng = np.random.default_rng(2)
    field = pii.Field(rng.normal(size=(pii.BUCKETS, 9)), rng.normal(size=(9, 9)))
    rows = [rng.integers(0, pii.BUCKETS, (n, 3)).astype(np.int32) for n in (1, 2, 3, 3, 4)]
    for row, labels in zip(rows, field.decode(rows)):
        emit = field.weights[row].sum(axis=1)
        scores = {}
        for code in range(9 ** len(row)):
            path = [code // 9**k % 9 for k in range(len(row))]
            scores[tuple(path)] = sum(emit[k, y] for k, y in enumerate(path)) + sum(field.moves[a, b] for a, b in zip(path, path[1:]))
        assert tuple(labels) == max(scores, key=scores.get)


def test_the_field_learns_the_labels_it_is_shown():
    texts = [f"call +1 ({a}) 555-{b} now" for a, b in zip(range(200, 290), range(1000, 1090))] + [f"room {n} is free" for n in range(90)]
    rows, labels = [], []
    for text in texts:
        for island in pii.islands(text):
            rows.append(pii.island_features(text, island))
            labels.append(pii.island_labels(island, pii.base_spans(text)))
    field = pii.Field.fit(rows, labels)
    right = [list(a) == b for a, b in zip(field.decode(rows), labels)]
    assert np.mean(right) > 0.98
    (_, every), = pii.found_spans(["ask for 1 (333) 555-4444 please"], field)
    assert all(kind == 3 for _, kind, _ in every)


def test_personal_data_of_odd_rows(spark, docs):
    text = "mail a.b@c.example now, 10.0.0.1 or +1 (202) 555-0123 and 4111 1111 1111 1111."
    rows = [(1, text), (1, text), (2, None), (3, ""), (None, "x@y.z"), (4, "9" * 50_000 + " a@b.c")]
    field = pii.fit(pii.labelled_sample(docs(rows)))
    got = pii.find(docs(rows), field).collect()
    assert len(got) == len(rows)
    for r in got:
        own = next(t or "" for i, t in rows if i == r["doc_id"])
        base = brute_spans(own) if len(own) < 1000 else [(50_001, 0, 50_006)]
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [sum(s[1] == k for s in base) for k in range(4)]
        assert r["base_sha256"] == hashlib.sha256(pii.spans_text(base).encode()).hexdigest()
        assert set(base) <= set(pii.parse_spans(r["spans"]))
    clean = pii.redact(docs(rows), field)
    assert clean.columns == docs([]).columns
    by_id = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert by_id[1] == "mail [EMAIL] now, [IP] or [PHONE] and [CARD]." and by_id[2] is None and by_id[None] == "[EMAIL]"
    empty = pii.fit(pii.labelled_sample(docs([])))
    assert pii.find(docs([]), empty).count() == 0
    assert pii.fit(spark.createDataFrame([(None, None)], "text string, spans string")) is not None


def test_quality_is_learned_and_held_out_rows_are_told_apart(spark):
    documents, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.fit(documents, labels)
    scored = quality.score(documents, model).join(labels, "doc_id").toPandas()
    assert (scored.held_out == scored.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 4 == 2)).all()
    held = scored[scored.held_out]
    good, bad = held[held.quality == 1].score.values, held[held.quality == 0].score.values
    assert (good[:, None] > bad[None, :]).mean() > 0.95
    assert scored.score.between(0, 1).all() and ((scored.score >= 0.7) == (scored.predicted == 1)).all()
    other = documents.select("doc_id", "text", F.lit("x").alias("lang"), F.lit(0).alias("source"))
    again = quality.score(other, quality.fit(other, labels)).toPandas().set_index("doc_id").score
    assert np.allclose(again[scored.doc_id], scored.score)


def test_quality_of_odd_rows(spark, docs):
    rows = [(1, None), (2, ""), (None, "some words"), (3, "w " * 100_000), (3, "w " * 100_000), (4, "x" * 200_000)]
    labels = spark.createDataFrame([(1, 1), (2, None), (3, 0), (3, 1), (None, 1)], "doc_id long, quality int")
    model = quality.fit(docs(rows), labels)
    got = quality.score(docs(rows), model).collect()
    assert len(got) == 6 and all(0 <= r["score"] <= 1 for r in got) and not any(r["held_out"] for r in got if r["doc_id"] is None)
    empty = quality.fit(docs([]), labels.limit(0))
    assert {r["score"] for r in quality.score(docs(rows), empty).collect()} == {0.5}
    assert quality.score(docs([]), empty).count() == 0
    assert quality.accepted(docs(rows), model).columns == docs([]).columns


def sorted_by_words(spark, good, bad, per_text):
    """Mean scores of held-out good and bad texts, whose words differ and whose shapes don't."""
    rng = random.Random(3)
    rows = [(i, per_text(rng, good if i % 2 else bad)) for i in range(600)]
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, quality int")
    got = [r for r in quality.score(documents, quality.fit(documents, labels)).collect() if r["held_out"]]
    return [np.mean([r["score"] for r in got if r["doc_id"] % 2 == y]) for y in (1, 0)]


@pytest.mark.parametrize("alphabet", ["abcdefghijklm", "äöüßéèñåøçêîô"])
def test_long_and_other_words_keep_their_identity(spark, alphabet):
    rng = random.Random(2)
    made = ["".join(rng.choices(alphabet, k=8)) for _ in range(80)]
    good, bad = sorted_by_words(spark, made[:40], made[40:], lambda r, own: " ".join(r.choices(own, k=40)))
    assert good > 0.9 and bad < 0.1


def test_texts_without_blanks_are_judged_by_all_of_their_bytes(spark):
    rng = random.Random(4)
    made = [chr(0x4E00 + rng.randrange(20_000)) for _ in range(60)]
    shared = "".join(made[::2]) * 10  # more than 256 bytes that tell nothing

    def text(r, own):
        return shared + "".join(r.choices(own, k=300))

    good, bad = sorted_by_words(spark, made[:30], made[30:], text)
    assert good > 0.9 and bad < 0.1


def test_long_words_are_cut_without_loss():
    texts = ["short " + "x" * 70 + " é", None, "日本" * 40, "{\"a1\":[" + "1234567890" * 9 + "]}" * 20, "y" * 64]
    parts = text_parts.words(pa.array(texts), cut=True)
    values = [parts.values[c].as_py() for c in parts.codes.tolist()]
    own = [values[a:b] for a, b in zip(parts.bounds, parts.bounds[1:])]
    assert [b"".join(v).decode() for v in own] == [re.sub(r"\s", "", t or "") for t in texts]
    assert own[0] == [b"short", *[b"x" * 16] * 4, b"x" * 6, "é".encode()] and own[4] == [b"y" * 64]
    assert own[2] == ["日".encode(), "本".encode()] * 40 and max(map(len, own[3])) == 16


def brute_lattice(rows):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(PATH)
    texts = {i: [w.lower() for w in re.findall(r"[^\x20\x09-\x0D]+", t or "")] for i, t in rows}
    counts, ends = {}, 0
    for i, own in texts.items():
        if zlib.crc32(str(i).encode()) % 7 != 2:
            ends += 1
            for w in own:
                counts[w] = counts.get(w, 0) + 1
    pieces = {}
    for w, n in counts.items():
        for p in library.encode(" " + w, add_special_tokens=False).ids:
            pieces[p] = pieces.get(p, 0) + n
    vocabulary = lattice.vocabulary(PATH)
    total = sum(pieces.values()) + ends + len(vocabulary) + 1
    logs = {t: math.log10((pieces.get(i, 0) + 1) / total) for i, t in vocabulary.items()}
    n, v = sum(counts.values()) + ends, len(counts) + (ends > 0)

    def marginal(data):
        forward = [0.0]
        for j in range(1, len(data) + 1):
            parts = [forward[i] + logs[data[i:j]] for i in range(j) if data[i:j] in logs]
            top = max(parts)
            forward.append(top + math.log10(sum(10 ** (p - top) for p in parts)))
        return forward[-1]

    out = {}
    for i, own in texts.items():
        base = sum(math.log10((counts.get(w, 0) + 1) / (n + v + 1)) for w in own) + math.log10((ends + 1) / (n + v + 1))
        score = sum(marginal(b" " + w.encode()) for w in own) + math.log10((ends + 1) / total)
        out[i] = (len(own) + 1, sum(w in counts for w in own) + (ends > 0), n, base, score)
    return out


@pytest.mark.parametrize("frequent", [20_000, 3])
def test_lattice_scores_equal_brute_force(docs, monkeypatch, frequent):
    monkeypatch.setattr(lattice, "FREQUENT", frequent)
    monkeypatch.setattr(lattice, "SHARD_BYTES", 500)
    rng = random.Random(3)
    rows = [(i, " ".join("".join(rng.choice("abTé") for _ in range(rng.randint(1, 6))) for _ in range(rng.randint(0, 30)))) for i in range(60)]
    rows += [(70, None), (71, ""), (72, "the " * 3000), (73, "ab" * 150)]
    got = lattice.score(docs(rows), PATH).collect()
    want = brute_lattice(rows)
    assert len(got) == len(rows)
    for r in got:
        tokens, known, train, base, score = want[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (tokens, known, train)
        assert r["base_score"] == pytest.approx(base) and r["score"] == pytest.approx(score)
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2)


def test_lattice_scores_of_odd_rows(docs):
    rows = [(1, "a b"), (1, "a b"), (1, "other"), (None, "a"), (None, None)]
    got = sorted(((r["doc_id"], r["n_tokens"]) for r in lattice.score(docs(rows), PATH).collect()), key=repr)
    assert got == sorted([(1, 3), (1, 3), (1, 2), (None, 2), (None, 1)], key=repr)
    assert lattice.score(docs([]), PATH).count() == 0
