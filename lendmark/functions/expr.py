"""Row-level column expressions. All of them are Spark built-ins, so they
stay inside whole-stage code generation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


# ---------------------------------------------------------------- statuses


@dataclass(frozen=True)
class StatusPolicy:
    """Which loan statuses count as resolved, and which of them as bad."""

    good: tuple[str, ...]
    bad: tuple[str, ...]

    @property
    def resolved(self) -> tuple[str, ...]:
        return self.good + self.bad


# The three status policies in use.
POLICIES = {
    "package": StatusPolicy(
        good=("Fully Paid",),
        bad=("Charged Off", "Default", "Late (31-120 days)"),
    ),
    "curated": StatusPolicy(
        good=("Fully Paid", "Does not meet the credit policy. Status:Fully Paid"),
        bad=("Charged Off", "Default", "Does not meet the credit policy. Status:Charged Off"),
    ),
    "basic": StatusPolicy(good=("Fully Paid",), bad=("Charged Off", "Default")),
}


def is_resolved(status: Column, policy: str = "package") -> Column:
    return status.isin(*POLICIES[policy].resolved)


def bad_flag(status: Column, policy: str = "package") -> Column:
    """1 for a bad status, else 0 (also for null)."""
    return F.when(status.isin(*POLICIES[policy].bad), 1).otherwise(0)


# ---------------------------------------------------------------- parsing


def to_number(c: Column, kind: str = "double") -> Column:
    """Cast that yields null on malformed text, and null instead of NaN."""
    out = c.try_cast(kind)
    return F.when(F.isnan(out), None).otherwise(out) if kind == "double" else out


def pct_to_double(c: Column) -> Column:
    """``' 13.5%'`` -> 13.5; malformed text -> null."""
    return to_number(F.regexp_replace(c.cast("string"), "[% ]", ""))


def issue_year(c: Column) -> Column:
    """Year of a ``Mon-YYYY`` text: the part after the last dash, 0 if it is not a number."""
    return F.coalesce(F.element_at(F.split(c, "-"), -1).try_cast("int"), F.lit(0))


# ---------------------------------------------------------------- features


def clip(c: Column, low: float | None = None, high: float | None = None) -> Column:
    """Bound a column; nulls stay null (``greatest``/``least`` alone would skip them)."""
    out = c
    if low is not None:
        out = F.greatest(out, F.lit(float(low)))
    if high is not None:
        out = F.least(out, F.lit(float(high)))
    return F.when(c.isNotNull(), out)


def event_flag(c: Column) -> Column:
    return F.when(c > 0, 1).otherwise(0)


def fico_midpoint(low: Column, high: Column | None = None) -> Column:
    """Middle of the score range; with no upper column the range is 4 wide."""
    return low + F.lit(2.0) if high is None else (low + high) / F.lit(2.0)


def installment_to_income(installment: Column, annual_income: Column, form: str = "percent") -> Column:
    """``percent``: percent of monthly income (floored at 1), within 0..100.
    ``fraction``: yearly payment over yearly income, unbounded, null on income 0.
    """
    if form == "percent":
        monthly = F.when(annual_income.isNotNull(), F.greatest(annual_income / 12.0, F.lit(1.0)))
        return clip(installment / monthly * 100.0, 0.0, 100.0)
    if form == "fraction":
        return F.try_divide(installment * 12.0, annual_income)
    raise ValueError(f"unknown form {form!r}")


def annuity(principal: Column, monthly_rate: Column, months: Column) -> Column:
    """Level payment of a loan, in cents precision."""
    growth = F.pow(1 + monthly_rate, months.cast("double"))
    return F.round(F.try_divide(principal * (monthly_rate * growth), growth - 1), 2)


# ---------------------------------------------------------------- binning


def bin_index(column: str, edges: Sequence[float]) -> Column:
    """0-based index of the right-closed bin ``(edges[i], edges[i+1]]`` of a numeric column.

    Null (and NaN) has no bin, nor has a value outside finite outer edges. The
    comparisons are literals, so this needs no range join.
    """
    first, *inner, last = map(float, edges)
    cases = [f"WHEN `{column}` IS NULL OR isnan(`{column}`) THEN NULL"]
    if first != float("-inf"):
        cases.append(f"WHEN `{column}` <= {first!r}D THEN NULL")
    uppers = inner if last == float("inf") else [*inner, last]
    cases += [f"WHEN `{column}` <= {upper!r}D THEN {i}" for i, upper in enumerate(uppers)]
    rest = len(inner) if last == float("inf") else "NULL"
    return F.expr(f"CAST(CASE {' '.join(cases)} ELSE {rest} END AS INT)")


def epoch_label(year: Column, ranges: Mapping[str, tuple[int, int]]) -> Column:
    """Name of the first year range (inclusive) that holds the year, else null."""
    out = F.lit(None).cast("string")
    for name, (first, last) in reversed(list(ranges.items())):
        out = F.when(year.between(first, last), name).otherwise(out)
    return out
