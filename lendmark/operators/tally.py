"""Counts per distinct value, and what follows from their order: running totals and quantiles.

A tally has one row per value. A small one is a local relation; a large one lies
in the scratch folder, and its order is worked on in ranges.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lendmark.functions.state import kept, settle, settled

RANGE_ROWS = 50_000
RANGE = "__range"


@dataclass(frozen=True)
class Tally:
    """``rows`` with one row per value; ``small`` ones have at most ``SETTLE_ROWS``."""

    rows: DataFrame
    small: bool

    @staticmethod
    def of(counted: DataFrame) -> Tally:
        """Evaluate an aggregate once."""
        return Tally(*settled(counted))

    @staticmethod
    def of_values(counted: DataFrame, *values: str) -> Tally:
        """Evaluate an aggregate once, without its rows that have a null among ``values``.

        These are dropped from the counts: a filter on the rows would have Catalyst put a copy of
        the expression behind each value into its condition, and a score is a large one.
        """
        tally = Tally.of(counted)
        for value in values:
            tally = tally.where(F.col(value).isNotNull())
        return tally

    def where(self, condition: Column | str) -> Tally:
        return Tally(self.rows.filter(condition), self.small)

    def fold(self, keys: Sequence[str], totals: Sequence[Column]) -> Tally:
        """Coarser counts. Those of a small tally are small."""
        counted = self.rows.groupBy(*keys).agg(*totals)
        return Tally(counted, True) if self.small else Tally.of(counted)


def running_totals(
    tally: Tally, order: str, totals: Mapping[str, str], descending: bool = False, range_rows: int | None = None
) -> DataFrame:
    """The tally with inclusive running sums of ``totals`` (new name -> column) along ``order``, and the
    sums over all rows as ``all_<name>``.

    ``order`` holds a value once and no nulls. A small tally is summed up in one
    task. A large one is written in ranges of about ``range_rows`` (default
    ``RANGE_ROWS``) rows of the order; whole ranges are summed up over one row per range, and rows are sorted
    only within theirs.
    """
    direction = F.col(order).desc() if descending else F.col(order).asc()
    if tally.small:
        everything = W.partitionBy(F.lit(0))  # at most SETTLE_ROWS rows
        upto = everything.orderBy(direction).rowsBetween(W.unboundedPreceding, W.currentRow)
        sums = {name: F.sum(c).over(upto) for name, c in totals.items()}
        return tally.rows.withColumns(sums | {f"all_{name}": F.sum(c).over(everything) for name, c in totals.items()})
    ranges = max(1, math.ceil(tally.rows.count() / (range_rows or RANGE_ROWS)))
    ranged = kept(tally.rows.repartitionByRange(ranges, direction).withColumn(RANGE, F.spark_partition_id()), "ranges")
    every = W.partitionBy(F.lit(0))  # one row per range
    before = every.orderBy(RANGE).rowsBetween(W.unboundedPreceding, -1)
    whole = settle(ranged.groupBy(RANGE).agg(*(F.sum(c).alias(f"__sum_{name}") for name, c in totals.items())))
    offsets = whole.select(
        RANGE,
        *(F.coalesce(F.sum(f"__sum_{name}").over(before), F.lit(0)).alias(f"__off_{name}") for name in totals),
        *(F.sum(f"__sum_{name}").over(every).alias(f"all_{name}") for name in totals),
    )
    within = W.partitionBy(RANGE).orderBy(direction).rowsBetween(W.unboundedPreceding, W.currentRow)
    return ranged.join(offsets, RANGE).select(
        *tally.rows.columns,
        *((F.sum(c).over(within) + F.col(f"__off_{name}")).alias(name) for name, c in totals.items()),
        *(f"all_{name}" for name in totals),
    )


def weighted_quantiles(tally: Tally, value: str, weight: str, probs: Sequence[float]) -> list[float]:
    """Linear-interpolated quantiles of the values, each taken ``weight`` times; empty without any.

    A rank's value is the smallest one up to which more rows lie than the rank,
    so one selection over the running totals gives all of them. Null values are left out.
    """
    counted = running_totals(tally.where(F.col(value).isNotNull() & (F.col(weight) > 0)), value, {"__upto": weight})
    last = F.col("all___upto") - 1

    def at(rank: Column) -> Column:
        return F.min(F.when(F.col("__upto") > rank, F.col(value)))

    places = [F.lit(p) * last for p in probs]
    ends = [at(f(place)) for place in places for f in (F.floor, F.ceil)]
    size, *found = counted.agg(F.max("all___upto"), *ends).first()
    if size is None:
        return []
    out = []
    for p, low, high in zip(probs, found[::2], found[1::2]):
        low, high, place = float(low), float(high), p * (size - 1)
        out.append(low if low == high else low + (high - low) * (place - math.floor(place)))
    return out
