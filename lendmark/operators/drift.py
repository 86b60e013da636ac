"""Population stability between a baseline and later batches."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lendmark.functions.expr import bin_index
from lendmark.functions.scale import psi_status
from lendmark.functions.state import local_frame, settle
from lendmark.operators.quantiles import even_probs, open_edges
from lendmark.operators.tally import Tally, weighted_quantiles


def _quantiles(df: DataFrame, score: str, n: int) -> list[float]:
    counts = Tally.of_values(df.groupBy(score).agg(F.count("*").alias("n")), score)
    return weighted_quantiles(counts, score, "n", even_probs(n))


def psi_edges(df: DataFrame, score: str = "score", n: int = 10) -> list[float]:
    """Distinct decile edges of the baseline with infinite ends; a constant score gives one bin."""
    return open_edges(_quantiles(df, score, n))


def hist_edges(df: DataFrame, score: str = "score", n: int = 10) -> list[float]:
    """Decile edges with finite ends moved out by 1e-5, duplicates kept."""
    return padded(_quantiles(df, score, n))


def padded(edges: Sequence[float]) -> list[float]:
    return [edges[0] - 1e-5, *edges[1:-1], edges[-1] + 1e-5]


def hist_index(column: str, edges: Sequence[float]) -> Column:
    """0-based left-closed bin ``[edges[i], edges[i+1])``, the last one closed; null outside."""
    c = F.col(column)
    out = F.when(c.isNull() | (c < F.lit(edges[0])) | (c > F.lit(edges[-1])), None)
    for i, upper in enumerate(edges[1:-1]):
        out = out.when(c < F.lit(upper), i)
    return out.otherwise(len(edges) - 2).cast("int")


def _shares(cells: DataFrame, side: str, eps: float, group: Column) -> DataFrame:
    """Shares per group floored at ``eps``, then made to add up to 1 again."""
    whole = W.partitionBy(group)  # at most one row per bin
    floored = F.greatest(F.try_divide(F.col(side), F.sum(side).over(whole)), F.lit(eps))
    cells = cells.withColumn("__f", F.when(F.sum(side).over(whole) > 0, floored))
    return cells.withColumn(f"{side}_share", F.col("__f") / F.sum("__f").over(whole)).drop("__f")


def psi_cells(
    df: DataFrame,
    epoch: str,
    baseline: str | None,
    score: str = "score",
    n: int = 10,
    eps: float = 1e-4,
    mode: str = "cut",
    edges: Sequence[float] | None = None,
) -> DataFrame:
    """(epoch, bin_index, expected_share, actual_share, psi_contribution), unrounded.

    All epochs are counted in one pass. ``edges`` default to those of the
    baseline epoch. Without a baseline, equal shares are expected.
    ``mode="hist"`` uses left-closed bins between finite ends.
    """
    counts = Tally.of_values(df.groupBy(epoch, score).agg(F.count("*").alias("n")), epoch, score)
    return tally_cells(counts, "n", epoch, baseline, score, n, eps, mode, edges)


def tally_cells(
    counts: Tally,
    weight: str,
    epoch: str,
    baseline: str | None,
    score: str = "score",
    n: int = 10,
    eps: float = 1e-4,
    mode: str = "cut",
    edges: Sequence[float] | None = None,
) -> DataFrame:
    """``psi_cells`` from a tally with a row per epoch and score, or more, that stands for ``weight`` rows each."""
    if edges is None:
        if baseline is None:
            raise ValueError("edges are needed when there is no baseline")
        base = counts.where(F.col(epoch) == baseline).fold([score], [F.sum(weight).alias(weight)])
        raw = weighted_quantiles(base, score, weight, even_probs(n))
        edges = open_edges(raw) if mode == "cut" else padded(raw)
    n_bins = len(edges) - 1
    # one wide row per epoch, then every bin in turn, so that empty bins stay
    place = (bin_index if mode == "cut" else hist_index)(score, edges)
    placed = counts.rows.select(epoch, place.alias("__bin"), F.col(weight).alias("n"))
    per_bin = [F.sum(F.when(F.col("__bin") == i, F.col("n")).otherwise(0)).alias(f"b{i}") for i in range(n_bins)]
    wide = settle(placed.groupBy(epoch).agg(*per_bin))  # epochs x bins
    expected = [1.0] * n_bins
    if baseline is not None:
        row = wide.filter(F.col(epoch) == baseline).first()
        expected = [float(row[f"b{i}"]) for i in range(n_bins)] if row else [0.0] * n_bins
        wide = wide.filter(F.col(epoch) != baseline)
    entries = F.array(
        *(
            F.struct(
                F.lit(i + 1).alias("bin_index"),
                F.lit(expected[i]).alias("expected"),
                F.col(f"b{i}").cast("double").alias("actual"),
            )
            for i in range(n_bins)
        )
    )
    cells = wide.select(F.col(epoch).alias("epoch"), F.inline(entries))
    for side in ("expected", "actual"):
        cells = _shares(cells, side, eps, F.col("epoch"))
    e, a = F.col("expected_share"), F.col("actual_share")
    contribution = ((a - e) * F.log(a / e)).alias("psi_contribution")
    return cells.select("epoch", "bin_index", "expected_share", "actual_share", contribution)


def breakdown(cells: DataFrame) -> DataFrame:
    """The published form: shares in percent (2 digits), contributions (4 digits)."""
    return cells.select(
        "epoch",
        "bin_index",
        F.round(F.col("expected_share") * 100.0, 2).alias("expected_pct"),
        F.round(F.col("actual_share") * 100.0, 2).alias("actual_pct"),
        F.round("psi_contribution", 4).alias("psi_contribution"),
    )


def psi_totals(cells: DataFrame) -> DataFrame:
    """(epoch, psi rounded to 4, status): the status is taken before rounding."""
    total = F.sum("psi_contribution")
    return cells.groupBy("epoch").agg(F.round(total, 4).alias("psi"), psi_status(total).alias("status"))


def psi_of_tally(counts: Tally, weight: str, epoch: str, baseline: str, score: str = "score", n: int = 10) -> DataFrame:
    """``psi_by`` from a tally, see ``tally_cells``."""
    return psi_totals(tally_cells(counts, weight, epoch, baseline, score, n))


def psi(
    actual: DataFrame,
    expected: DataFrame | None,
    score: str = "score",
    n: int = 10,
    eps: float = 1e-4,
    mode: str = "cut",
    edges: Sequence[float] | None = None,
) -> DataFrame:
    """``psi_cells`` of two tables (epoch ``actual``); equal expected shares when ``expected`` is None."""
    both = actual.select(score, F.lit("actual").alias("epoch"))
    if expected is not None:
        both = both.unionByName(expected.select(score, F.lit("expected").alias("epoch")))
    return psi_cells(both, "epoch", None if expected is None else "expected", score, n, eps, mode, edges)


def psi_by(df: DataFrame, epoch: str, baseline: str, score: str = "score", n: int = 10, **options) -> DataFrame:
    """PSI of every later epoch against the baseline, in one job."""
    return psi_totals(psi_cells(df, epoch, baseline, score, n, **options))


def edge_rows(df: DataFrame, edges: Sequence[float]) -> DataFrame:
    """(bin_index, lower, upper), null for an infinite end."""
    finite = [None if math.isinf(x) else float(x) for x in edges]
    rows = [(i + 1, finite[i], finite[i + 1]) for i in range(len(finite) - 1)]
    return local_frame(df.sparkSession, rows, "bin_index int, lower double, upper double")


__all__ = ["breakdown", "edge_rows", "hist_edges", "psi", "psi_by", "psi_cells", "psi_edges", "psi_of_tally", "psi_totals", "tally_cells"]
