"""Validation metrics of a scored table.

Everything cumulates over tallies, one row per distinct score or probability. Raw
rows are never windowed.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lendmark.functions.expr import bin_index
from lendmark.functions.scale import ks_band, tau
from lendmark.functions.state import local_frame, settle
from lendmark.operators.quantiles import even_probs, exact_quantiles
from lendmark.operators.tally import Tally, running_totals, weighted_quantiles

SCORE_DECILES = 10


def outcome_counts(target: str) -> list[Column]:
    y = F.col(target)
    return [
        F.count(y).alias("total"),
        F.count_if(y == 1).alias("bads"),
        F.count_if(y == 0).alias("goods"),
    ]


def value_tally(df: DataFrame, value: str, target: str = "target", by: Sequence[str] = ()) -> Tally:
    """Outcomes per distinct value (and group), in one pass over the rows; nulls have none."""
    return Tally.of_values(df.groupBy(*by, value).agg(*outcome_counts(target)), value)


def cut_edges(quantiles: Sequence[float]) -> list[float]:
    """Distinct quantiles as bin edges; the lowest value belongs to the first bin."""
    edges = sorted(set(quantiles))
    return [-math.inf, *edges[1:-1], math.inf] if len(edges) > 1 else [-math.inf, math.inf]


def deciles(df: DataFrame, target: str = "target", score: str = "score", q: int = SCORE_DECILES) -> DataFrame:
    """Quantile bins of the score (1 = lowest), with cumulative shares and separation.

    Equal scores stay together, so there may be fewer than ``q`` bins. Shares
    are null when a class is absent.
    """
    counts = value_tally(df, score, target)
    return _deciles(counts, score, q)


def _deciles(counts: Tally, score: str, q: int) -> DataFrame:
    edges = weighted_quantiles(counts, score, "total", even_probs(q))
    return _decile_table(counts.rows, score, cut_edges(edges))


def _decile_table(counts: DataFrame, score: str, edges: Sequence[float]) -> DataFrame:
    table = (
        counts.withColumn("decile", bin_index(score, edges) + 1)
        .groupBy("decile")
        .agg(
            F.sum("total").alias("total"),
            F.sum("bads").alias("bads"),
            F.sum("goods").alias("goods"),
            F.min(score).alias("min_score"),
            F.max(score).alias("max_score"),
        )
    )
    everything = W.partitionBy(F.lit(1))  # at most q rows
    upto = everything.orderBy("decile").rowsBetween(W.unboundedPreceding, W.currentRow)
    for side in ("bads", "goods"):
        share = F.try_divide(F.col(side), F.sum(side).over(everything))
        cumulative = F.try_divide(F.sum(side).over(upto), F.sum(side).over(everything))
        table = table.withColumns({f"pct_{side}": share, f"cum_pct_{side}": cumulative})
    return table.select(
        "decile",
        "total",
        "bads",
        "goods",
        "min_score",
        "max_score",
        F.try_divide("bads", "total").alias("bad_rate"),
        "pct_bads",
        "pct_goods",
        "cum_pct_bads",
        "cum_pct_goods",
        F.abs(F.col("cum_pct_bads") - F.col("cum_pct_goods")).alias("ks_separation"),
    )


def ks(decile_table: DataFrame) -> DataFrame:
    """(ks, ks_percent, ks_decile, band): the largest separation and where it is."""
    best = decile_table.agg(
        F.max("ks_separation").alias("ks"),
        F.min_by("decile", F.struct(-F.col("ks_separation"), F.col("decile"))).alias("ks_decile"),
    )
    percent = F.round(F.col("ks") * 100.0, 2)
    return best.select("ks", percent.alias("ks_percent"), "ks_decile", ks_band(percent).alias("band"))


def ks_exact(df: DataFrame, target: str = "target", score: str = "score") -> DataFrame:
    """Largest separation over every distinct score."""
    counts = value_tally(df, score, target)
    running = running_totals(counts, score, {"cum_bads": "bads", "cum_goods": "goods"})
    separation = F.abs(F.try_divide("cum_bads", "all_cum_bads") - F.try_divide("cum_goods", "all_cum_goods"))
    return running.agg(
        F.max(separation).alias("ks_exact"),
        F.min_by(score, F.struct(-separation, F.col(score))).alias("at_score"),
    )


# ------------------------------------------------------------------ curves


def curve(df: DataFrame, target: str = "target", p: str = "pd") -> DataFrame:
    """Per distinct probability, from the highest down: own and cumulative counts, and those of all rows."""
    return _curve(value_tally(df, p, target), p)


def _curve(counts: Tally, p: str) -> DataFrame:
    steps = Tally(counts.rows.select(p, "bads", "goods"), counts.small)
    return running_totals(steps, p, {"cum_bads": "bads", "cum_goods": "goods"}, descending=True)


def curve_points(df: DataFrame, target: str = "target", p: str = "pd") -> DataFrame:
    """(threshold, tpr, fpr, precision, recall) of predicting bad at p >= threshold."""
    hits, misses = F.col("cum_bads"), F.col("cum_goods")
    found = F.try_divide(hits, "all_cum_bads")
    return curve(df, target, p).select(
        F.col(p).alias("threshold"),
        found.alias("tpr"),
        F.try_divide(misses, "all_cum_goods").alias("fpr"),
        F.try_divide(hits, hits + misses).alias("precision"),
        found.alias("recall"),
    )


def auc(df: DataFrame, target: str = "target", p: str = "pd") -> DataFrame:
    """(roc_auc, gini): share of (bad, good) pairs ranked right, ties counting half."""
    return _auc(curve(df, target, p))


def _auc(steps: DataFrame) -> DataFrame:
    # pairs lost by the bads of a step: goods ranked above them, and half of the tied ones
    lost = F.sum(F.col("bads").cast("double") * (F.col("cum_goods") - F.col("goods") / 2.0))
    pairs = F.sum("bads").cast("double") * F.sum("goods").cast("double")
    area = 1.0 - F.try_divide(lost, pairs)
    return steps.agg(area.alias("roc_auc"), (area * 2.0 - 1.0).alias("gini"))


def pr_auc(df: DataFrame, target: str = "target", p: str = "pd") -> DataFrame:
    """(pr_auc, prior_rate): trapezoids over recall, from the end point (0, 1).

    The previous point of each step follows from its own counts, so no lag is needed.
    """
    steps = curve(df, target, p)
    hits, seen = F.col("cum_bads"), F.col("cum_bads") + F.col("cum_goods")
    now = F.try_divide(hits, seen)
    before = F.coalesce(F.try_divide(hits - F.col("bads"), seen - F.col("bads") - F.col("goods")), F.lit(1.0))
    return steps.agg(
        F.try_divide(F.sum(F.col("bads") * (now + before) / 2.0), F.sum("bads")).alias("pr_auc"),
        F.try_divide(F.sum("bads"), F.sum(F.col("bads") + F.col("goods"))).alias("prior_rate"),
    )


# ------------------------------------------------------------- calibration


def brier(df: DataFrame, target: str = "target", p: str = "pd") -> DataFrame:
    return df.agg(F.avg(F.pow(F.col(p) - F.col(target), F.lit(2.0))).alias("brier_score"))


def brier_parts(df: DataFrame, target: str = "target", p: str = "pd", q: int = 10) -> DataFrame:
    """Reliability, resolution and uncertainty over quantile bins of ``p``, and
    what they leave unexplained (p varies within a bin)."""
    edges = cut_edges(exact_quantiles(df, {p: even_probs(q)})[p] or [])
    bins = (
        df.filter(F.col(p).isNotNull())
        .groupBy(bin_index(p, edges).alias("bin"))
        .agg(
            F.count("*").cast("double").alias("n"),
            F.avg(p).alias("p"),
            F.avg(target).alias("y"),
            F.sum(F.pow(F.col(p) - F.col(target), F.lit(2.0))).alias("sq"),
        )
    )
    bins = settle(bins)
    everything = W.partitionBy(F.lit(1))  # at most q rows
    rated = bins.withColumns(
        {
            "w": F.col("n") / F.sum("n").over(everything),
            "base": F.sum(F.col("n") * F.col("y")).over(everything) / F.sum("n").over(everything),
        }
    )
    parts = rated.agg(
        F.sum(F.col("w") * F.pow(F.col("p") - F.col("y"), F.lit(2.0))).alias("reliability"),
        F.sum(F.col("w") * F.pow(F.col("y") - F.col("base"), F.lit(2.0))).alias("resolution"),
        F.max(F.col("base") * (1 - F.col("base"))).alias("uncertainty"),
        (F.sum("sq") / F.sum("n")).alias("brier_score"),
    )
    explained = F.col("reliability") - F.col("resolution") + F.col("uncertainty")
    return parts.withColumn("residual", F.col("brier_score") - explained)


def confusion(
    df: DataFrame,
    target: str = "target",
    p: str = "pd",
    cutoff: float | None = None,
    cost_fp: float = 300.0,
    cost_fn: float = 10_000.0,
) -> DataFrame:
    """Counts at p >= cutoff (the cost-optimal one by default) and what they cost.

    Balanced training inflates p, so the default cutoff declines most applicants.
    """
    cutoff = tau(cost_fp, cost_fn) if cutoff is None else cutoff
    flagged, bad, good = F.col(p) >= cutoff, F.col(target) == 1, F.col(target) == 0
    cells = df.agg(
        F.count_if(~flagged & good).alias("tn"),
        F.count_if(flagged & good).alias("fp"),
        F.count_if(~flagged & bad).alias("fn"),
        F.count_if(flagged & bad).alias("tp"),
    )
    return cells.select(
        F.lit(cutoff).alias("cutoff"),
        "tn",
        "fp",
        "fn",
        "tp",
        F.coalesce(F.try_divide("tp", F.col("tp") + F.col("fp")), F.lit(0.0)).alias("precision"),
        F.coalesce(F.try_divide("tp", F.col("tp") + F.col("fn")), F.lit(0.0)).alias("recall"),
        (F.col("fp") * F.lit(cost_fp) + F.col("fn") * F.lit(cost_fn)).alias("total_loss"),
    )


def expected_loss(df: DataFrame, p: Column, lgd: Column, ead: Column, by: str) -> DataFrame:
    """Expected loss (p x lgd x ead) and exposure per segment."""
    return df.groupBy(by).agg(
        F.count("*").alias("loans"),
        F.sum(ead).alias("exposure"),
        F.sum(p * lgd * ead).alias("expected_loss"),
    )


# ------------------------------------------------------------------ bundle


def evaluate(
    df: DataFrame,
    target: str = "target",
    p: str = "pd",
    score: str = "score",
    cost_fp: float = 300.0,
    cost_fn: float = 10_000.0,
) -> DataFrame:
    """One row with all metrics, rounded to 4 digits (separation and loss to 2).

    The table is read once, into its ``profile``; all metrics follow from that.
    Only one-row results reach the driver.
    """
    return evaluate_profile(profile(df, target, p, score), p, score, cost_fp, cost_fn)


def profile(
    df: DataFrame, target: str = "target", p: str = "pd", score: str = "score", by: Sequence[str] = ()
) -> Tally:
    """Outcomes per (group, probability, score): what metrics and stability need of a scored table. Profiles add up."""
    return Tally.of_values(df.groupBy(*by, p, score).agg(*outcome_counts(target)), p, score)


def evaluate_profile(
    seen: Tally, p: str = "pd", score: str = "score", cost_fp: float = 300.0, cost_fn: float = 10_000.0
) -> DataFrame:
    """``evaluate`` from a profile."""
    cutoff = tau(cost_fp, cost_fn)
    tallies = [F.sum(c).alias(c) for c in ("total", "bads", "goods")]
    flagged = F.col(p) >= cutoff
    squares = F.col("bads") * F.pow(1 - F.col(p), F.lit(2.0)) + F.col("goods") * F.pow(F.col(p), F.lit(2.0))
    losses = [
        F.sum(squares).alias("squares"),
        F.sum(F.when(flagged, F.col("goods")).otherwise(0)).alias("fp"),
        F.sum(F.when(flagged, F.col("bads")).otherwise(0)).alias("tp"),
    ]
    separation = ks(_deciles(seen.fold([score], tallies), score, SCORE_DECILES)).first()["ks"]
    area = _auc(_curve(seen.fold([p], tallies), p)).first()["roc_auc"]
    sums = seen.rows.agg(*tallies, *losses).first()
    tp, fp = sums["tp"] or 0, sums["fp"] or 0
    fn = (sums["bads"] or 0) - tp
    result = (
        area,
        None if area is None else 2.0 * area - 1.0,
        separation,
        sums["squares"] / sums["total"] if sums["total"] else None,
        cutoff,
        tp / (tp + fp) if tp + fp else 0.0,
        tp / (tp + fn) if tp + fn else 0.0,
        fp * cost_fp + fn * cost_fn,
    )
    names = (
        "roc_auc", "gini", "ks_statistic", "brier_score",
        "cost_optimal_tau", "precision_at_tau", "recall_at_tau", "total_financial_loss",
    )
    frame = local_frame(seen.rows.sparkSession, [result], ", ".join(f"{c} double" for c in names))
    digits = {"total_financial_loss": 2}
    return frame.select(
        *(
            F.round(F.col(c) * 100.0, 2).alias(c) if c == "ks_statistic" else F.round(c, digits.get(c, 4)).alias(c)
            for c in names
        )
    )
