"""Personal data: fixed rules, and a linear-chain conditional random field that adds what looks alike.

The rules give the base spans. The field works on islands: words that hold a
digit or an at sign, with two words on either side. Its features are word
shapes, its labels mark begin and inside of each kind. It is trained in numpy on
a small labelled table and decoded by Viterbi over many islands at once.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendmark.llm.samples import smallest_hashes
from lendmark.llm.scratch import kept
from lendmark.llm.text import chunks

KINDS = ("email", "ip", "card", "phone")
LABELS = ["O", *(f"{p}-{k}" for k in KINDS for p in "BI")]
BUCKETS = 1 << 13
CONTEXT = 2
BLANKS = " \t\n\v\f\r"

Span = tuple[int, int, int]  # start, kind, end; in code points, end exclusive

DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A look-behind keeps long runs of digits linear: a match never begins inside such a run.
IP = re.compile(r"(?<![0-9])[0-9]++\.([0-9]++)\.([0-9]++)\.([0-9]+)")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
HOT = re.compile(r"[0-9@]")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from their at signs: linear also for long runs of letters."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
        done = found.end() if found else at + 1
        at = text.find("@", max(done, at + 1))


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def _luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        total += d if k % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """Spans by rule, by start and then kind."""
    found: list[Span] = []
    if "@" in text:
        found += [(a, 0, b) for a, b in _emails(text)]
    if DIGIT.search(text):
        for m in IP.finditer(text):
            if all(map(_small, m[0].split("."))):
                found.append((m.start(), 1, m.end()))
        for m in CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and _luhn(digits):
                found.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 9 <= sum(map(str.isdigit, m[0])) <= 15:
                    found.append((m.start(), 3, m.end()))
    return sorted(found)


def spans_text(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def parse_spans(text: str | None) -> list[Span]:
    parts = (p.split(":") for p in (text or "").split(",") if p)
    return sorted((int(a), KINDS.index(kind), int(b)) for kind, a, b in parts)


# ------------------------------------------------------------------ islands


def _word_start(text: str, at: int, low: int) -> int:
    while at > low and text[at - 1] not in BLANKS:
        at -= 1
    return at


def _word_end(text: str, at: int) -> int:
    n = len(text)
    while at < n and text[at] not in BLANKS:
        at += 1
    return at


def islands(text: str) -> list[list[tuple[int, int]]]:
    """Words (start, end) of each island; every character is looked at a bounded number of times."""
    carriers = []
    hot = HOT.search(text)
    end = 0
    while hot:
        start = _word_start(text, hot.start(), end)
        end = _word_end(text, hot.end())
        carriers.append((start, end))
        hot = HOT.search(text, end)
    found: list[list[tuple[int, int]]] = []
    for k, (start, end) in enumerate(carriers):
        low = carriers[k - 1][1] if k else 0
        high = carriers[k + 1][0] if k + 1 < len(carriers) else len(text)
        before, at = [], start
        while len(before) < 2 * CONTEXT and at > low:
            stop = at
            while stop > low and text[stop - 1] in BLANKS:
                stop -= 1
            if stop == low:
                at = low
                break
            at = _word_start(text, stop, low)
            before.append((at, stop))
        joined = bool(k) and at <= low and len(before) <= 2 * CONTEXT and not text[low:at].strip(BLANKS)
        if joined:
            shared = [w for w in reversed(before) if w[0] >= found[-1][-1][1]]
            found[-1] += [*shared, (start, end)]
        else:
            found.append([*reversed(before[:CONTEXT]), (start, end)])
        after, at = [], end
        while len(after) < CONTEXT and at < high:
            while at < high and text[at] in BLANKS:
                at += 1
            if at >= high:
                break
            stop = _word_end(text, at)
            after.append((at, stop))
            at = stop
        found[-1] += after
    return found


RUNS = re.compile(r"9+|A+|a+|[^9Aa]+")
CLASSES = {**{chr(c): "9" for c in range(48, 58)}, **{chr(c): "A" for c in range(65, 91)}}


SHORT = 64  # longest words whose features are kept by a worker


def shape(word: str) -> tuple[str, str]:
    """Shape with the lengths of runs, and without; letters beyond A-Z count as small ones."""
    plain = "".join([CLASSES.get(c) or ("a" if c.isalpha() else c) for c in word])
    runs = RUNS.findall(plain)
    return (
        "".join([f"{r[0]}{min(len(r), 20)}" if r[0] in "9Aa" else r for r in runs]),
        "".join([r[0] if r[0] in "9Aa" else r for r in runs]),
    )


@lru_cache(maxsize=50_000)
def _short_shape(word: str) -> tuple[str, str]:
    return shape(word)


def _shape(word: str) -> tuple[str, str]:
    return _short_shape(word) if len(word) <= SHORT else shape(word)


def _bucket(name: str) -> int:
    return zlib.crc32(name.encode()) % BUCKETS


def features(word: str, before: str, after: str) -> tuple[int, ...]:
    """Hashed features of a word (its shapes, digits and marks) and of its neighbours' shapes."""
    fine, coarse = _shape(word)
    digits = sum(map(str.isdigit, word))
    names = (
        "bias", f"f={fine}", f"c={coarse}", f"d={min(digits, 20)}", f"first={fine[:1]}", f"at={'@' in word}",
        f"dots={min(word.count('.'), 4)}", f"p={before}", f"n={after}", f"pc={before}|{coarse}", f"cn={coarse}|{after}",
    )
    return tuple(map(_bucket, names))


@lru_cache(maxsize=50_000)
def _short_features(word: str, before: str, after: str) -> tuple[int, ...]:
    return features(word, before, after)


def forget() -> None:
    """Free what a worker keeps between texts."""
    _short_shape.cache_clear()
    _short_features.cache_clear()


def island_features(text: str, words: list[tuple[int, int]]) -> np.ndarray:
    """Features of the words of an island; whole words, however long."""
    surfaces = [text[a:b] for a, b in words]
    shapes = ["^", *(_shape(w)[1] for w in surfaces), "$"]
    out = []
    for i, w in enumerate(surfaces):
        short = len(w) + len(shapes[i]) + len(shapes[i + 2]) <= 3 * SHORT
        out.append((_short_features if short else features)(w, shapes[i], shapes[i + 2]))
    return np.array(out, dtype=np.int32)


def island_labels(words: list[tuple[int, int]], spans: list[Span]) -> list[int]:
    labels, last = [], None
    for a, b in words:
        hit = next((s for s in spans if s[0] < b and a < s[2]), None)
        labels.append(0 if hit is None else 1 + 2 * hit[1] + (hit == last))
        last = hit
    return labels


def taught_spans(text: str) -> list[Span]:
    """Labels for training: the base spans, and runs of up to four words that pass a rule taken by
    themselves. The rules alone miss what stands right beside other digits."""
    spans = base_spans(text)
    for words in islands(text):
        at = 0
        while at < len(words):
            for n in range(min(4, len(words) - at), 0, -1):
                start, end = words[at][0], words[at + n - 1][1]
                while end > start and not text[end - 1].isalnum():
                    end -= 1
                own = base_spans(text[start:end]) if end - start <= 100 else []
                free = not any(start < b and a < end for a, _, b in spans)
                if free and any((a, b) == (0, end - start) for a, _, b in own):
                    kind = next(k for a, k, b in own if (a, b) == (0, end - start))
                    spans.append((start, kind, end))
                    at += n - 1
                    break
            at += 1
    return sorted(spans)


# ---------------------------------------------------------------- the field


def _padded(rows: list[np.ndarray], fill: int) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(r) for r in rows])
    out = np.full((len(rows), sizes.max(), *rows[0].shape[1:]), fill, dtype=rows[0].dtype)
    for k, r in enumerate(rows):
        out[k, : len(r)] = r
    return out, sizes


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)


@dataclass
class Field:
    """Weights per feature and label, and per pair of labels."""

    weights: np.ndarray
    moves: np.ndarray

    @staticmethod
    def fit(rows: list[np.ndarray], labels: list[list[int]], rounds: int = 60, rate: float = 0.3, l2: float = 1e-4):
        """Maximum likelihood by full-batch Adam; forward and backward over all islands at once."""
        n_labels = len(LABELS)
        weights, moves = np.zeros((BUCKETS, n_labels)), np.zeros((n_labels, n_labels))
        if not rows:
            weights[_bucket("bias"), 0] = 1.0
            return Field(weights, moves)
        x, sizes = _padded(rows, 0)
        y, _ = _padded([np.array(v) for v in labels], 0)
        n, longest = y.shape
        inside = np.arange(longest)[None, :] < sizes[:, None]
        gold = np.eye(n_labels)[y] * inside[:, :, None]
        pairs = inside[:, 1:]
        gold_moves = np.zeros_like(moves)
        np.add.at(gold_moves, (y[:, :-1][pairs], y[:, 1:][pairs]), 1.0)
        state = [np.zeros_like(weights), np.zeros_like(weights), np.zeros_like(moves), np.zeros_like(moves)]
        flat = x[inside]
        for step in range(1, rounds + 1):
            emit = weights[x].sum(axis=2)
            forward = np.empty((n, longest, n_labels))
            backward = np.zeros((n, longest, n_labels))
            forward[:, 0] = emit[:, 0]
            for t in range(1, longest):
                forward[:, t] = _lse(forward[:, t - 1][:, :, None] + moves, 1) + emit[:, t]
            for t in range(longest - 2, -1, -1):
                after = _lse(moves + (emit[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
                backward[:, t] = np.where(inside[:, t + 1, None], after, 0.0)
            total = _lse(forward[np.arange(n), sizes - 1], 1)
            marginal = np.exp(forward + backward - total[:, None, None]) * inside[:, :, None]
            slope = np.zeros_like(weights)
            error = (gold - marginal)[inside]
            for k in range(flat.shape[1]):
                np.add.at(slope, flat[:, k], error)
            expected = np.zeros_like(moves)
            for t in range(1, longest):
                use = inside[:, t]
                joint = forward[use, t - 1][:, :, None] + moves + (emit[use, t] + backward[use, t])[:, None, :]
                expected += np.exp(joint - total[use, None, None]).sum(axis=0)
            for k, (value, grad) in enumerate(((weights, slope / n), (moves, (gold_moves - expected) / n))):
                grad = grad - l2 * value
                first, second = state[2 * k], state[2 * k + 1]
                first += 0.1 * (grad - first)
                second += 0.001 * (grad * grad - second)
                value += rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        return Field(weights, moves)

    def decode(self, rows: list[np.ndarray]) -> list[np.ndarray]:
        """Best labels of each island: Viterbi over groups of islands of like length."""
        out: list[np.ndarray] = [None] * len(rows)  # type: ignore[list-item]
        groups = defaultdict(list)
        for k, r in enumerate(rows):
            groups[len(r).bit_length()].append(k)
        for members in groups.values():
            for at in range(0, len(members), 4096):
                part = members[at : at + 4096]
                x, sizes = _padded([rows[k] for k in part], 0)
                emit = self.weights[x].sum(axis=2)
                best = emit[:, 0]
                back = np.zeros(emit.shape, dtype=np.int8)
                for t in range(1, emit.shape[1]):
                    scores = best[:, :, None] + self.moves
                    back[:, t] = scores.argmax(axis=1)
                    best = np.where((t < sizes)[:, None], scores.max(axis=1) + emit[:, t], best)
                label = best.argmax(axis=1)
                path = np.zeros(emit.shape[:2], dtype=np.int8)
                for t in range(emit.shape[1] - 1, -1, -1):
                    path[:, t] = label
                    label = np.where(t < sizes, back[np.arange(len(part)), t, label], label)
                for k, p, size in zip(part, path, sizes):
                    out[k] = p[:size]
        return out


def _labelled_spans(text: str, words: list[tuple[int, int]], labels: np.ndarray) -> list[Span]:
    """Spans of a decoded island, without marks at their edges."""
    spans, open_kind = [], None
    for (a, b), label in zip(words, labels.tolist()):
        if label == 0:
            open_kind = None
        elif (label - 1) % 2 == 1 and open_kind == (label - 1) // 2:
            spans[-1][2] = b
        else:
            open_kind = (label - 1) // 2
            spans.append([a, open_kind, b])
    found = []
    for a, kind, b in spans:
        while a < b and not (text[a].isalnum() or text[a] in "+("):
            a += 1
        while a < b and not text[b - 1].isalnum():
            b -= 1
        if a < b and _plausible(kind, text[a:b]):
            found.append((a, kind, b))
    return found


def _plausible(kind: int, text: str) -> bool:
    """An added span has to pass the arithmetic of its kind, in whatever notation it is written."""
    numbers = re.findall("[0-9]+", text)
    digits = "".join(numbers)
    if kind == 0:
        return "@" in text
    if kind == 1:
        return len(numbers) == 4 and all(map(_small, numbers))
    if kind == 2:
        return 12 <= len(digits) <= 19 and _luhn(digits)
    return 9 <= len(digits) <= 15


def found_spans(texts: list[str], field: Field) -> list[tuple[list[Span], list[Span]]]:
    """Base spans, and all spans: those of the field are added where they touch no base span."""
    base = [base_spans(t) for t in texts]
    where, rows, places = [], [], []
    for k, text in enumerate(texts):
        for words in islands(text):
            where.append(k)
            places.append(words)
            rows.append(island_features(text, words))
    added = defaultdict(list)
    for k, words, labels in zip(where, places, field.decode(rows)):
        if labels.any():
            added[k] += _labelled_spans(texts[k], words, labels)
    out = []
    for k, own in enumerate(base):
        more = [s for s in added[k] if not any(s[0] < b and a < s[2] for a, _, b in own)]
        out.append((own, sorted([*own, *more])))
    return out


# ------------------------------------------------------------ as DataFrames

ISLANDS_OF_A_TEXT = 32
ISLAND = T.StructType(
    [T.StructField("h", T.LongType()), T.StructField("features", T.ArrayType(T.ArrayType(T.IntegerType()))), T.StructField("labels", T.ArrayType(T.IntegerType()))]
)


def labelled_sample(documents: DataFrame, rows: int = 2000, text_column: str = "text") -> DataFrame:
    """A small labelled table ``text, spans`` of ``rows`` distinct texts at most that hold a digit or an at sign,
    labelled by ``taught_spans``: those whose hashes are smallest, copies counting once."""
    source = documents.select(F.col(text_column).alias("text")).filter(F.col("text").rlike("[0-9@]"))
    # distinct texts by their hash, so that no text is shuffled; copies can only lie beside each other
    hashes = kept(source.select(F.xxhash64("text").alias("h")).distinct(), "hashes")
    chosen = smallest_hashes(hashes, rows, "h")
    chosen = source.join(F.broadcast(chosen), F.xxhash64("text") == F.col("h"), "left_semi").distinct()

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([spans_text(taught_spans(t)) for t in texts], pa.string())], ["text", "spans"]
            )

    return chosen.mapInArrow(label, "text string, spans string")


def fit(labelled: DataFrame, max_islands: int = 6000) -> Field:
    """Train on ``text, spans`` (spans as ``kind:start:end`` joined by commas; null is none).

    Only islands reach the driver: at most ``ISLANDS_OF_A_TEXT`` of each text, those
    that hash lowest, and of these the ``max_islands`` that hash lowest. Islands of
    over 64 words are left out. An empty table gives a field that adds nothing.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                known = parse_spans(spans)
                found = [w for w in islands(text or "") if len(w) <= 64]
                order = [(zlib.crc32(text[w[0][0] : w[-1][1]].encode("utf-8", "replace")), w) for w in found]
                for h, words in sorted(order)[:ISLANDS_OF_A_TEXT]:
                    rows.append((h, island_features(text, words).tolist(), island_labels(words, known)))
            lists = list(zip(*rows)) if rows else [[], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(lists[0], pa.int64()), pa.array(lists[1], pa.list_(pa.list_(pa.int32()))),
                 pa.array(lists[2], pa.list_(pa.int32()))], ["h", "features", "labels"],
            )

    found = labelled.select("text", "spans").mapInArrow(cut, ISLAND)
    rows = found.orderBy("h", "features", "labels").limit(max_islands).collect()
    rows.sort(key=lambda r: (r["features"], r["labels"]))
    return Field.fit([np.array(r["features"], dtype=np.int32) for r in rows], [r["labels"] for r in rows])


def _texts(batch: pa.RecordBatch) -> list[str]:
    return [t or "" for t in batch.column("text").to_pylist()]


def find(documents: DataFrame, field: Field, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans`` per row.

    Counts and digest are of the base spans; ``spans`` holds all. Null and empty
    texts have none. Repeated rows and null ids are kept; other columns are not
    read. Every text is read whole.
    """
    shared = documents.sparkSession.sparkContext.broadcast(field)  # 8192 x 9 weights, whatever the input

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for part in chunks(batch):
                counts, digests, spans = [], [], []
                for base, every in found_spans(_texts(part), model):
                    counts.append([sum(s[1] == k for s in base) for k in range(len(KINDS))])
                    digests.append(hashlib.sha256(spans_text(base).encode()).hexdigest())
                    spans.append(spans_text(every))
                table = np.array(counts, dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *(pa.array(table[:, k]) for k in range(len(KINDS))),
                     pa.array(digests, pa.string()), pa.array(spans, pa.string())],
                    ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
                )
        forget()

    source = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return source.mapInArrow(
        run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
    )


def redacted(text: str, spans: list[Span]) -> str:
    """Every span, or run of overlapping spans, becomes its kind in brackets."""
    out, done = [], 0
    for start, kind, end in spans:
        if start >= done:
            out += [text[done:start], f"[{KINDS[kind].upper()}]"]
        done = max(done, end)
    return "".join([*out, text[done:]])


def redact(documents: DataFrame, field: Field, text_column: str = "text") -> DataFrame:
    """The same rows and columns with all found spans replaced in the text; null texts stay null."""
    shared = documents.sparkSession.sparkContext.broadcast(field)
    others = [F.col(f"`{c}`") for c in documents.columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for part in chunks(batch, text_column):
                column = part.column(text_column)
                texts = [t or "" for t in column.to_pylist()]
                clean = [redacted(t, every) for t, (_, every) in zip(texts, found_spans(texts, model))]
                clean = [c if known else None for c, known in zip(clean, column.is_valid().to_pylist())]
                place = part.schema.get_field_index(text_column)
                yield part.set_column(place, part.schema.field(place), pa.array(clean, column.type))
        forget()

    return documents.select(*others).mapInArrow(run, documents.schema)
