"""Exact quantiles without a single-task sort.

``percentile`` keeps every distinct value of a column in one buffer, which
doesn't hold on a large continuous column, so it is rebuilt here from mergeable
aggregates.
"""

from __future__ import annotations

import bisect
import itertools
import math
from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SKETCH_ACCURACY = 10_000
SLACK = 2 / SKETCH_ACCURACY  # a sketch may be off by half of this
EVEN_GRID = [i / 1000 for i in range(1001)]
LARGEST = 1.7976931348623157e308  # fixed value: the largest double
BELOW, ABOVE = -1, 2_147_483_647  # regions of the infinite values
MAX_PASSES = 100  # narrowing ends far earlier, as every pass cuts a stretch several hundred times
FETCH_ROWS = 200_000  # value counts that one pass may bring to the driver, over all columns


def sql_array(values: Sequence[float]) -> Column:
    """A literal array in one parse, rather than one call per element."""
    return F.expr("array(" + ",".join(f"{v!r}D" for v in values) + ")")


def present(c: Column) -> Column:
    """The value as double, or null where it is missing (null or NaN)."""
    value = c.cast("double")
    return F.when(~F.isnan(value), value)


def _if_region(i: int, regions: set[int]) -> str:
    """SQL text: the value of column ``i`` when it lies in one of the regions, else null."""
    if not regions:
        return "CAST(NULL AS DOUBLE)"
    return f"IF(r{i} IN ({','.join(map(str, sorted(regions)))}) AND abs(v{i}) < double('infinity'), v{i}, NULL)"


class _Search:
    """Where the wanted ranks of one column may lie; a few dozen numbers."""

    def __init__(self, probs: Sequence[float]):
        self.probs = probs
        self.size: int | None = None
        self.ranks: set[int] = set()
        self.found: dict[int, float] = {}
        # Regions are the left-closed stretches between neighbouring splits. Every
        # cut is followed by the next double, so that a cut is a region of its own.
        self.cuts: set[float] = set()
        self.splits: list[float] = [-math.inf, LARGEST, math.inf]
        self.fetch: set[int] = set()  # regions whose value counts the next pass returns
        self.sketch: set[int] = {0, 1}  # regions the next pass sketches

    @property
    def open(self) -> bool:
        return self.size is None or len(self.found) < len(self.ranks)

    def read(self, rows: Sequence, probs: Sequence[float], settle_rows: int) -> None:
        """Take the counts of one pass, settle ranks or propose narrower cuts."""
        rows = sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1]))
        infinite = {BELOW: -math.inf, ABOVE: math.inf}
        if self.size is None:
            self.size = sum(n for _, _, n, _ in rows)
            for p in self.probs if self.size else ():
                position = p * (self.size - 1)
                self.ranks |= {math.floor(position), math.ceil(position)}
        below = 0
        cuts = set(self.cuts)
        small, large = [], []
        for region, value, n, grid in rows:
            inside = [k for k in self.ranks - self.found.keys() if below <= k < below + n]
            at_cut = region not in infinite and self.splits[region] in self.cuts
            if region in infinite:
                self.found.update(dict.fromkeys(inside, infinite[region]))
            elif inside and (at_cut or value is not None):
                self.found.update(dict.fromkeys(inside, self.splits[region] if at_cut else value))
            elif inside and grid is None:
                # the sketch had pointed elsewhere: look at this stretch next
                (small if n <= settle_rows else large).append((self.splits[region], self.splits[region + 1]))
            elif inside:
                for k in inside:
                    first, last = (k - below) / n - SLACK, (k - below + 1) / n + SLACK
                    low = max(0, bisect.bisect_right(probs, first) - 1)
                    high = min(len(probs) - 1, bisect.bisect_left(probs, last))
                    bracket = (grid[low], grid[high])
                    cuts.update(bracket)
                    expected = n * (probs[high] - probs[low] + SLACK)
                    (small if expected <= settle_rows else large).append(bracket)
            below += n
        self.cuts = cuts
        inner = cuts | {math.nextafter(c, math.inf) for c in cuts}
        self.splits = sorted({-math.inf, math.inf} | (inner or {LARGEST}))
        self.sketch = self._regions_within(large)
        self.fetch = self._regions_within(small) - self.sketch

    def _regions_within(self, intervals: Sequence[tuple[float, float]]) -> set[int]:
        return {
            i
            for i, (low, high) in enumerate(itertools.pairwise(self.splits))
            if low not in self.cuts and any(a <= low and high <= b for a, b in intervals)
        }

    def quantiles(self) -> list[float] | None:
        if not self.size:
            return None
        out = []
        for p in self.probs:
            position = p * (self.size - 1)
            low, high = self.found[math.floor(position)], self.found[math.ceil(position)]
            out.append(low if low == high else low + (high - low) * (position - math.floor(position)))
        return out


def exact_quantiles(
    df: DataFrame, wanted: Mapping[str, Sequence[float]], settle_rows: int = 20_000
) -> dict[str, list[float] | None]:
    """Linear-interpolated quantiles of several columns, nulls skipped.

    Selection by narrowing. A pass counts the rows between the current cuts
    exactly and sketches the stretches that hold a wanted rank; the sketch
    proposes cuts several hundred times closer, the counts keep the ranks
    exact. A value shared by many rows becomes a cut and is settled by its
    count alone. Stretches expected to hold at most ``settle_rows`` rows are
    returned as value counts instead; all columns share ``FETCH_ROWS`` of them.
    Infinite values are counted by themselves. Two passes serve ten million rows, and
    every further pass several hundred times more. All groups are combined
    before the shuffle, and a sketch error costs a pass, never a wrong result.
    """
    searches = {c: _Search(probs) for c, probs in wanted.items()}
    # the first pass asks the sketch only around the wanted quantiles
    near = 3 / SKETCH_ACCURACY
    asked = {min(1.0, max(0.0, p + d)) for probs in wanted.values() for p in probs for d in (-near, near)}
    probs = sorted(asked | {0.0, 1.0})
    for _ in range(MAX_PASSES):
        if not any(s.open for s in searches.values()):
            break
        still = [c for c, s in searches.items() if s.open]
        values = df.select(*(present(F.col(c)).alias(f"v{i}") for i, c in enumerate(still)))
        regions = Bucketizer(
            splitsArray=[searches[c].splits for c in still],
            inputCols=[f"v{i}" for i in range(len(still))],
            outputCols=[f"r{i}" for i in range(len(still))],
            handleInvalid="keep",
        )
        parts = ", ".join(
            f"struct({i} AS feature, CASE WHEN v{i} = double('-infinity') THEN {BELOW} "
            f"WHEN v{i} = double('infinity') THEN {ABOVE} ELSE int(r{i}) END AS region, v{i} IS NOT NULL AS kept, "
            f"{_if_region(i, searches[c].fetch)} AS value, {_if_region(i, searches[c].sketch)} AS rough)"
            for i, c in enumerate(still)
        )
        sketching = any(searches[c].sketch for c in still)
        sketch = F.percentile_approx("rough", sql_array(probs), F.lit(SKETCH_ACCURACY))
        counted: dict[int, list] = {i: [] for i in range(len(still))}
        for feature, region, value, n, rough in (
            regions.transform(values).select(F.expr(f"inline(array({parts}))"))
            .filter("kept")
            .groupBy("feature", "region", "value")
            .agg(F.count("*").alias("n"), (sketch if sketching else F.lit(None)).alias("grid"))
            .collect()
        ):
            counted[feature].append((region, value, n, rough))
        n_open = sum(len(searches[c].probs) * 2 for c in still)
        share = min(settle_rows, FETCH_ROWS // max(n_open, 1))
        for i, c in enumerate(still):
            searches[c].read(counted[i], probs, share)
        probs = EVEN_GRID
    else:
        raise RuntimeError(f"quantiles of {[c for c, s in searches.items() if s.open]} did not settle")
    return {c: s.quantiles() for c, s in searches.items()}


def even_probs(n: int) -> list[float]:
    """``n + 1`` evenly spaced probabilities from 0 to 1."""
    return [i * (1.0 / n) for i in range(n)] + [1.0]


def open_edges(quantiles: Sequence[float] | None) -> list[float]:
    """Distinct sorted edges with infinite ends; fewer than three give one bin."""
    edges = sorted(set(quantiles or ()))
    if len(edges) < 3:
        return [-math.inf, math.inf]
    return [-math.inf, *edges[1:-1], math.inf]


def quantile_edges(df: DataFrame, features: Sequence[str], n: int = 5) -> dict[str, list[float]]:
    """Open bin edges at ``n`` quantiles for every feature."""
    raw = exact_quantiles(df, {f: even_probs(n) for f in features})
    return {f: open_edges(raw[f]) for f in features}
