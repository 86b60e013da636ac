"""Score scaling and the fixed classification bands."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Pdo:
    """Points-to-double-the-odds calibration: ``base`` points at ``odds`` good to 1 bad."""

    base: float = 600.0
    odds: float = 50.0
    pdo: float = 20.0

    @property
    def factor(self) -> float:
        return self.pdo / math.log(2.0)

    @property
    def offset(self) -> float:
        return self.base - self.factor * math.log(self.odds)


SCORE_MIN, SCORE_MAX = 300, 850


def score_from_logit(logit: Column, pdo: Pdo = Pdo()) -> Column:
    """Integer score; halves round to even, bounded to 300..850."""
    points = F.rint(F.lit(pdo.offset) - F.lit(pdo.factor) * logit)
    return F.least(F.greatest(points, F.lit(float(SCORE_MIN))), F.lit(float(SCORE_MAX))).cast("int")


def score_from_pd(p: Column, pdo: Pdo = Pdo()) -> Column:
    """Score of a probability, with the odds bounded to 1e-7..1e7."""
    odds = F.when(p >= 1.0, F.lit(1e7)).otherwise(F.try_divide(p, 1.0 - p))
    return score_from_logit(F.log(F.least(F.greatest(odds, F.lit(1e-7)), F.lit(1e7))), pdo)


def pd_from_logit(logit: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-logit))


def tau(cost_fp: float = 300.0, cost_fn: float = 10_000.0) -> float:
    """Probability above which declining is the cheaper error."""
    return cost_fp / (cost_fp + cost_fn)


# The labels and limits of the rating bands.


def iv_rating(iv: Column) -> Column:
    return (
        F.when(iv < 0.02, "Unpredictive (<0.02) - DROP")
        .when(iv < 0.10, "Weak (0.02-0.10)")
        .when(iv <= 0.30, "Medium / Strong (0.10-0.30) - PRIME")
        .when(iv <= 0.50, "Very Strong (0.30-0.50)")
        .otherwise("Suspiciously High (>0.50) - LEAKAGE CHECK")
    )


def psi_status(psi: Column) -> Column:
    return (
        F.when(psi < 0.10, "STABLE")
        .when(psi < 0.25, "MODERATE_DRIFT")
        .when(psi.isNotNull(), "SIGNIFICANT_DRIFT")
    )


def ks_band(ks_percent: Column) -> Column:
    """The band 55..60 is not covered by the published table."""
    return (
        F.when(ks_percent < 20, "rejected")
        .when(ks_percent < 35, "acceptable")
        .when(ks_percent <= 55, "ideal")
        .when(ks_percent > 60, "leakage audit")
        .when(ks_percent.isNotNull(), "unclassified")
    )


def condition_band(kappa: Column) -> Column:
    return F.when(kappa < 100, "well-conditioned").when(kappa <= 1000, "moderate").otherwise("severe")
