"""Whitening of embeddings from the exact characteristic polynomial of their scatter.

Entries become integers, so the scatter ``M = n * sum(x x') - S S'`` of the fit
list (each distinct vector once) is an integer matrix, and so is its polynomial:

1. Tasks multiply blocks of the fit list exactly and return their sums as limbs,
   which Spark adds up per matrix cell.
2. The polynomial is found modulo primes, one prime per row of a Spark job, by
   reduction to Hessenberg form; Chinese remaindering gives its coefficients.
3. All roots are real, hence the sign changes of the polynomial shifted by ``a``
   are exactly the number of roots above ``a``. Halving brackets isolates the
   largest roots to ``ROOT_BITS`` relative bits.
4. Each root is a row of another job: inverse iteration in whole numbers of
   ``SOLVE_BITS`` bits solves for its null space. Roots that can't be told apart
   share an orthonormal basis.

What reaches the driver has the size of the matrix, whatever the number of rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendmark.llm.scratch import kept
from lendmark.llm.vectors import matrix

COMPONENTS = 16
SCALE = 64
SHIFT = 1_000_000  # of the entries; scatter and whitened values don't depend on it
LARGEST = float(1 << 62)
LIMB = 40
ROOT_BITS = 96
SOLVE_BITS = 320
STEPS = 3

OUT = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"


@dataclass
class Whitening:
    """Sums of the fit list and its components, largest variance first.

    ``totals`` are of the entries without ``SHIFT``; ``spreads`` are n times the
    standard deviations; row k of ``vectors`` is component k + 1.
    """

    n: int
    totals: list[int]
    vectors: np.ndarray
    spreads: np.ndarray
    explained: np.ndarray
    identity_error: float = 0.0


def usable(embeddings: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """``id, x`` of the rows that take part, ``x`` being ``floor(64 * c)`` per entry.

    Left out are null vectors, empty ones, those that hold null or non-finite
    entries or entries of 2^56 and more, and those of another length than most
    (of equally frequent lengths the larger one counts). Null ids stay.
    """
    rows = embeddings.select(
        F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{vector_column}`").cast("array<double>").alias("v")
    )
    bad = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) * SCALE >= F.lit(LARGEST)))
    rows = rows.filter(F.col("v").isNotNull() & (F.size("v") > 0) & ~bad)
    sizes = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    rows = rows.filter(F.size("v") == (sizes["d"] if sizes else 0))
    return rows.select("id", F.transform("v", lambda c: F.floor(c * SCALE).cast("long")).alias("x"))


# ----------------------------------------------------------------- scatter


def _product(x: np.ndarray) -> np.ndarray:
    """``x' x`` as Python integers; doubles where they are exact."""
    largest = int(max(abs(int(x.max())), abs(int(x.min())))) if x.size else 0
    rows = (1 << 53) // max(1, largest * largest)
    total = np.zeros((x.shape[1], x.shape[1]), dtype=object)
    if not rows:
        exact = x.astype(object)
        return exact.T.dot(exact)
    for k in range(0, len(x), rows):
        part = x[k : k + rows].astype(np.float64)
        total = total + (part.T @ part).astype(np.int64).astype(object)
    return total


def _limbs(value: int) -> tuple[int, int, int]:
    """``low + mid * 2^40 + high * 2^80``."""
    mask = (1 << LIMB) - 1
    return value & mask, (value >> LIMB) & mask, value >> (2 * LIMB)


def scatter(fit_list: DataFrame, d: int) -> tuple[int, list[int], list[list[int]]]:
    """``n``, the sums per dimension and ``n * sum(x x') - S S'`` of the column ``x``."""
    upper = [(i, j) for i in range(d) for j in range(i, d)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, squares = 0, np.zeros(d, dtype=object), np.zeros((d, d), dtype=object)
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch.column("x"))
                n += len(x)
                sums = sums + (x.sum(axis=0) if np.abs(x).max() < (1 << 62) // len(x) else x.astype(object).sum(axis=0))
                squares = squares + _product(x)
        if n:
            values = [n, *map(int, sums), *(int(squares[i, j]) for i, j in upper)]
            limbs = zip(*map(_limbs, values))
            columns = [pa.array(range(len(values)), pa.int32()), *(pa.array(c, pa.int64()) for c in limbs)]
            yield pa.RecordBatch.from_arrays(columns, ["cell", "low", "mid", "high"])

    cells = fit_list.select("x").mapInArrow(run, "cell int, low long, mid long, high long")
    adds = [F.sum(F.col(c).cast("decimal(20,0)")).alias(c) for c in ("low", "mid", "high")]
    found = cells.groupBy("cell").agg(*adds).collect()  # d * (d + 3) / 2 + 1 rows
    value = {r["cell"]: int(r["low"]) + (int(r["mid"]) << LIMB) + (int(r["high"]) << (2 * LIMB)) for r in found}
    n, sums = value.get(0, 0), [value.get(1 + i, 0) for i in range(d)]
    m = [[0] * d for _ in range(d)]
    for k, (i, j) in enumerate(upper):
        m[i][j] = m[j][i] = n * value.get(1 + d + k, 0) - sums[i] * sums[j]
    return n, sums, m


# -------------------------------------------------------------- polynomial


def _is_prime(n: int) -> bool:
    """Miller-Rabin, exact below 3.2e9 with the bases 2, 3, 5 and 7."""
    if n < 11 or any(n % b == 0 for b in (2, 3, 5, 7)):
        return n in (2, 3, 5, 7)
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7):
        x = pow(base, odd, n)
        if x not in (1, n - 1) and all((x := x * x % n) != n - 1 for _ in range(twos - 1)):
            return False
    return True


def primes_beyond(bound: int) -> list[int]:
    """The largest primes below 2^31 whose product exceeds ``bound``."""
    found, product, at = [], 1, (1 << 31) - 1
    while product <= bound:
        if _is_prime(at):
            found.append(at)
            product *= at
        at -= 2
    return found


def polynomial_mod(m: np.ndarray, p: int) -> list[int]:
    """``det(t - m)`` modulo ``p``, leading coefficient first, by way of a similar Hessenberg matrix."""
    a = m.copy()
    d = len(a)
    for k in range(d - 2):
        below = np.flatnonzero(a[k + 1 :, k])
        if not len(below):
            continue
        pivot = k + 1 + int(below[0])
        if pivot != k + 1:
            a[[k + 1, pivot]] = a[[pivot, k + 1]]
            a[:, [k + 1, pivot]] = a[:, [pivot, k + 1]]
        u = a[k + 2 :, k] * pow(int(a[k + 1, k]), -1, p) % p
        a[k + 2 :] = (a[k + 2 :] - u[:, None] * a[k + 1] % p) % p
        a[:, k + 1] = (a[:, k + 1] + (a[:, k + 2 :] * u % p).sum(axis=1)) % p
    # polynomials of the leading blocks; entry i of a row is the coefficient of t^i
    blocks = np.zeros((d + 1, d + 1), dtype=np.int64)
    blocks[0, 0] = 1
    for k in range(d):
        row = np.zeros(d + 1, dtype=np.int64)
        row[1:] = blocks[k, :-1]
        row = (row - int(a[k, k]) * blocks[k]) % p
        chain = 1
        for i in range(k - 1, -1, -1):
            chain = chain * int(a[i + 1, i]) % p
            if not chain:
                break
            row = (row - (int(a[i, k]) * chain % p) * blocks[i]) % p
        blocks[k + 1] = row
    return blocks[d, ::-1].tolist()


def symmetric_functions(spark: SparkSession, m: list[list[int]]) -> list[int]:
    """``e_0 .. e_d`` of the eigenvalues of a positive semidefinite integer matrix.

    They are the coefficients of its polynomial without their alternating signs,
    so they aren't negative, and bounded by equal eigenvalues of the same trace.
    """
    d = len(m)
    trace = sum(m[i][i] for i in range(d))
    primes = primes_beyond(max(-(-math.comb(d, k) * trace**k // d**k) for k in range(d + 1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ps = batch.column("p").to_pylist()
            rows = [polynomial_mod(np.array([[c % p for c in row] for row in m], dtype=np.int64), p) for p in ps]
            yield pa.RecordBatch.from_arrays([batch.column("p"), pa.array(rows, pa.list_(pa.int64()))], ["p", "c"])

    frame = spark.createDataFrame([(p,) for p in primes], "p long").repartition(len(primes) // 4 + 1)
    found = frame.mapInArrow(run, "p long, c array<bigint>").collect()  # primes x (d + 1) numbers
    values, product = [0] * (d + 1), 1
    for p, residues in sorted((r["p"], r["c"]) for r in found):
        inverse = pow(product, -1, p)
        for k, c in enumerate(residues):
            values[k] += product * ((((-c if k % 2 else c) - values[k]) * inverse) % p)
        product *= p
    return values


# ------------------------------------------------------------------- roots


def above(e: Sequence[int], a: int, scale: int) -> int:
    """Roots larger than ``a / 2^scale``, each as often as it occurs: sign changes after shifting by ``a``."""
    c = [(-v if k % 2 else v) << (scale * k) for k, v in enumerate(e)]
    d = len(c) - 1
    for i in range(d):
        for j in range(1, d + 1 - i):
            c[j] += a * c[j - 1]
    signs = [v > 0 for v in c if v]
    return sum(x != y for x, y in zip(signs, signs[1:]))


def _sign(e: Sequence[int], a: int, scale: int) -> int:
    value = 0
    for k, v in enumerate(e):
        value = value * a + ((-v if k % 2 else v) << (scale * k))
    return (value > 0) - (value < 0)


@dataclass
class Root:
    """``many`` roots that agree to ``ROOT_BITS`` bits, near ``middle / 2^scale``."""

    middle: int
    scale: int
    many: int

    @property
    def value(self) -> Fraction:
        return Fraction(self.middle, 1 << self.scale)


def largest_roots(e: Sequence[int], wanted: int) -> list[Root]:
    """The ``wanted`` largest positive roots (all, if fewer), largest first."""
    rank = max((k for k, v in enumerate(e) if v), default=0)
    e = e[: rank + 1]  # the other roots are zero
    if not rank:
        return []
    out: list[Root] = []
    # brackets (low, high], how many roots lie above each end; the highest bracket is on top
    stack = [(0, e[1], 0, rank, 0)]
    while stack:
        low, high, scale, over_low, over_high = stack.pop()
        many = over_low - over_high
        if not many or over_high >= wanted:
            continue
        if low and (high - low) << ROOT_BITS <= low:
            out.append(Root(low + high, scale + 1, many))
            continue
        if high - low == 1 or (low and low.bit_length() < ROOT_BITS):
            more = max(1, ROOT_BITS + 2 - high.bit_length())
            low, high, scale = low << more, high << more, scale + more
        middle = (low + high) // 2
        if many == 1:
            # one root in (low, high]: the sign above it tells the side
            at, end = _sign(e, middle, scale), (-1) ** over_high
            over = over_high if at in (0, end) else over_low
        else:
            over = above(e, middle, scale)
        stack.append((low, middle, scale, over_low, over))
        stack.append((middle, high, scale, over, over_high))
    return out


# ----------------------------------------------------------------- vectors


def _unit(v: np.ndarray) -> np.ndarray:
    """Scaled to length 2^SOLVE_BITS."""
    norm = math.isqrt(int((v * v).sum()))
    return np.array([(int(c) << SOLVE_BITS) // norm for c in v], dtype=object)


def null_space(m: list[list[int]], root: Root) -> np.ndarray:
    """Orthonormal rows that span what ``m`` maps to ``root`` times itself, as doubles.

    One elimination with row exchanges, then ``STEPS`` solutions per vector; a
    pivot of zero becomes the smallest step of the arithmetic.
    """
    d = len(m)
    a = np.array(m, dtype=object) * (1 << root.scale)
    a[np.arange(d), np.arange(d)] -= root.middle
    shift = SOLVE_BITS - max(int(abs(c)).bit_length() for c in a.ravel())
    a = np.array([int(c) << shift if shift >= 0 else int(c) >> -shift for c in a.ravel()], dtype=object).reshape(d, d)
    order, factors = [], []
    for k in range(d):
        pivot = k + max(range(d - k), key=lambda i: abs(a[k + i, k]))
        a[[k, pivot]] = a[[pivot, k]]
        if not a[k, k]:
            a[k, k] = 1
        f = np.array([(int(c) << SOLVE_BITS) // int(a[k, k]) for c in a[k + 1 :, k]], dtype=object)
        if len(f):
            a[k + 1 :, k:] -= (f[:, None] * a[k, k:]) >> SOLVE_BITS
        order.append(pivot)
        factors.append(f)

    def solved(b: np.ndarray) -> np.ndarray:
        b = b.copy()
        for k in range(d):
            b[[k, order[k]]] = b[[order[k], k]]
            if k + 1 < d:
                b[k + 1 :] -= (factors[k] * b[k]) >> SOLVE_BITS
        x = np.zeros(d, dtype=object)
        for k in range(d - 1, -1, -1):
            rest = int(b[k]) - (int((a[k, k + 1 :] * x[k + 1 :]).sum() if k + 1 < d else 0) >> SOLVE_BITS)
            x[k] = (rest << SOLVE_BITS) // int(a[k, k])
        return x

    draws = np.random.default_rng(11).integers(1, 1 << 30, (root.many, d))
    basis: list[np.ndarray] = []
    for row in draws:
        v = _unit(row.astype(object))
        for _ in range(STEPS):
            v = _unit(solved(v))
            for u in basis:
                v = v - ((u * (int((u * v).sum()) >> SOLVE_BITS)) >> SOLVE_BITS)
            v = _unit(v)
        if max(v, key=abs) < 0:
            v = -v
        basis.append(v)
    return np.array([[int(c) / (1 << SOLVE_BITS) for c in v] for v in basis])


def components(spark: SparkSession, m: list[list[int]], wanted: int) -> tuple[np.ndarray, list[Fraction]]:
    """The leading unit eigenvectors (rows) of ``m`` with their positive eigenvalues, at most ``wanted``."""
    roots = largest_roots(symmetric_functions(spark, m), wanted)
    if not roots:
        return np.empty((0, len(m))), []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ks = batch.column("k").to_pylist()
            rows = [null_space(m, roots[k]).ravel().tolist() for k in ks]
            yield pa.RecordBatch.from_arrays([batch.column("k"), pa.array(rows, pa.list_(pa.float64()))], ["k", "v"])

    frame = spark.createDataFrame([(k,) for k in range(len(roots))], "k int").repartition(len(roots), "k")
    found = dict(frame.mapInArrow(run, "k int, v array<double>").collect())  # ``wanted`` vectors
    vectors = np.concatenate([np.array(found[k]).reshape(-1, len(m)) for k in range(len(roots))])
    values = [r.value for r in roots for _ in range(r.many)]
    return vectors[:wanted], values[:wanted]


# ---------------------------------------------------------------- whitening


def _centred(x: np.ndarray, n: int, totals: Sequence[int]) -> np.ndarray:
    """``n * x - S``, in Python integers where 64 bits could overflow."""
    largest = max(abs(int(x.max())), abs(int(x.min())), *map(abs, totals)) if x.size else 0
    if (n + 1) * largest < 1 << 62:
        return x * n - np.array(totals, dtype=np.int64)
    return x.astype(object) * n - np.array(totals, dtype=object)


def _whitened(centred: np.ndarray, model: Whitening) -> np.ndarray:
    return (centred.astype(np.float64) @ model.vectors.T) / model.spreads


def _identity_error(fit_list: DataFrame, model: Whitening) -> float:
    """Largest entry of the covariance of the whitened fit list minus the identity, measured on its rows."""
    k = len(model.vectors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(k + k * k)
        for batch in batches:
            if batch.num_rows:
                w = _whitened(_centred(matrix(batch.column("x")), model.n, model.totals), model)
                sums += np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(range(len(sums)), pa.int32()), pa.array(sums)], ["cell", "value"])

    cells = fit_list.select("x").mapInArrow(run, "cell int, value double").groupBy("cell").agg(F.sum("value").alias("value"))
    found = dict(cells.collect())  # at most 16 * 17 rows
    values = np.array([found.get(i, 0.0) for i in range(k + k * k)]) / model.n
    mean, square = values[:k], values[k:].reshape(k, k)
    return float(np.abs(square - np.outer(mean, mean) - np.eye(k)).max())


def fit(rows: DataFrame, wanted: int = COMPONENTS) -> Whitening | None:
    """Whitening of the distinct vectors of ``usable`` rows; None if there is nothing to whiten.

    Only components of positive variance exist, so equal or no vectors give None.
    """
    first = rows.select(F.size("x")).first()
    if first is None:
        return None
    fit_list = kept(rows.select("x").distinct(), "fit-list")
    n, totals, m = scatter(fit_list, first[0])
    common = math.gcd(*(c for row in m for c in row))
    if not common:
        return None
    vectors, values = components(rows.sparkSession, [[c // common for c in row] for row in m], wanted)
    trace = sum(m[i][i] for i in range(len(m)))
    model = Whitening(
        n,
        totals,
        vectors,
        np.array([math.sqrt(v * common) for v in values]),
        np.array([float(v * common / trace) for v in values]),
    )
    model.identity_error = _identity_error(fit_list, model)
    return model


def transform(rows: DataFrame, model: Whitening) -> DataFrame:
    """``OUT`` per row of ``usable`` and component."""
    k = len(model.vectors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 4096):
                batch = whole.slice(start, 4096)
                centred = _centred(matrix(batch.column("x")), model.n, model.totals)
                small = centred.dtype != object and int(np.abs(centred).max()) ** 2 * centred.shape[1] < 1 << 62
                exact = centred if small else centred.astype(object)
                deviation = [int(v) for v in (exact * exact).sum(axis=1)]
                deviation = pa.array([v if v < 10**38 else None for v in deviation], pa.decimal128(38, 0))
                again = pa.array(np.repeat(np.arange(len(centred)), k))
                size = len(centred)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").take(again),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), size)),
                        pa.array(np.full(size * k, model.n)),
                        deviation.take(again),
                        pa.array(_whitened(centred, model).ravel()),
                        pa.array(np.tile(model.explained, size)),
                        pa.array(np.full(size * k, model.identity_error)),
                    ],
                    [f.split()[0] for f in OUT.split(", ")],
                )

    return rows.mapInArrow(run, OUT)


def whiten(
    embeddings: DataFrame, wanted: int = COMPONENTS, id_column: str = "vec_id", vector_column: str = "embedding"
) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` per row that takes part and component.

    Rows that ``usable`` leaves out have no result; null ids and repeated rows
    keep theirs. A table that is empty or whose vectors are all equal has no
    component of positive variance and gives no rows. ``deviation`` is null from
    1e38 on. Other columns are not read.
    """
    rows = usable(embeddings, id_column, vector_column)
    model = fit(rows, wanted)
    if model is None:
        return embeddings.sparkSession.createDataFrame([], OUT)
    return transform(rows, model)
