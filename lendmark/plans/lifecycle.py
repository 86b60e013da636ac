"""The three-epoch life of a scorecard: train, monitor, retrain, gate, explain."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendmark.functions.scale import Pdo
from lendmark.functions.state import local_frame
from lendmark.operators import card as cards
from lendmark.operators import drift, explain, govern, impute, validate, woe
from lendmark.operators.collinearity import vif_filter
from lendmark.plans.layers import derive, window_of, with_epoch

# Candidate columns of the published model.
NUMERIC = (
    "dti", "revol_util", "fico_range_low", "fico_range_high", "annual_inc", "installment",
    "loan_amnt", "open_acc", "total_acc", "inq_last_6mths", "delinq_2yrs",
)
CATEGORICAL = ("emp_length", "home_ownership", "purpose")
VIF_CANDIDATES = (
    "fico_mid", "dti", "revol_util", "annual_inc", "installment",
    "loan_amnt", "installment_to_inc", "open_acc", "inq_last_6mths", "delinq_2yrs",
)


@dataclass(frozen=True)
class Model:
    """Everything fitted on one training window."""

    imputers: impute.Imputers
    bins: woe.WoeModel
    card: cards.Card

    def prepare(self, loans: DataFrame) -> DataFrame:
        return woe.apply_woe(derive(impute.impute(loans, self.imputers)), self.bins)

    def score(self, loans: DataFrame) -> DataFrame:
        return cards.scored(self.prepare(loans), self.card)


def train(
    loans: DataFrame,
    features: Sequence[str] | None = None,
    numeric: Sequence[str] = NUMERIC,
    categorical: Sequence[str] = CATEGORICAL,
    candidates: Sequence[str] = VIF_CANDIDATES,
    n_bins: int = 5,
    pdo: Pdo = Pdo(),
    target: str = "target",
) -> Model:
    """Fit imputers, collinearity screen, bins and card.

    The window is read several times by the fits, so its needed columns are
    kept (memory, then disk) until they are done. ``features`` skips the screen.
    """
    needed = [c for c in dict.fromkeys([*numeric, *categorical, target]) if c in loans.columns]
    window = loans.select(*needed).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        state = impute.fit_imputers(window, numeric, categorical)
        ready = derive(impute.impute(window, state))
        if features is None:
            screen = vif_filter(ready, [c for c in candidates if c in ready.columns])
            features = [*screen.kept, *(c for c in categorical if c in ready.columns)]
        bins = woe.fit_woe(ready, features, target, n_bins)
        weighed = woe.apply_woe(ready, bins).select(*woe.woe_columns(bins), target)
        card = cards.fit_card(weighed, woe.woe_columns(bins), target, pdo=pdo)
    finally:
        window.unpersist()
    return Model(state, bins, card)


@dataclass(frozen=True)
class Lifecycle:
    """Fitted models plus the small result tables; ``notices`` stays distributed."""

    first: Model
    second: Model | None
    stages: DataFrame
    stability: DataFrame
    gate: DataFrame
    notices: DataFrame


def lifecycle(
    loans: DataFrame,
    epochs: Mapping[str, tuple[int, int]],
    rolling: tuple[int, int],
    force_retrain: bool = True,
    gate_threshold: float = 0.20,
    log_path: str | None = None,
    run_prefix: str = "",
) -> Lifecycle:
    """Train on the baseline epoch, watch the later ones, retrain on the rolling window
    when they drift (or when forced), validate out of time, explain the declines.

    ``loans`` holds preprocessed rows; ``epochs`` names year ranges ``baseline``,
    ``inference``, ``drift`` and ``holdout``.
    """
    spark = loans.sparkSession
    parts = {name: window_of(loans, *years) for name, years in epochs.items()}
    first = train(parts["baseline"])
    # one scoring pass serves the metrics of the baseline and the stability of all watched epochs
    seen = [epochs[name] for name in ("baseline", "inference", "drift") if name in epochs]
    years = window_of(loans, min(a for a, _ in seen), max(b for _, b in seen))
    watched = with_epoch(years, epochs).filter(F.col("epoch").isin("baseline", "inference", "drift"))
    # outcomes per epoch, probability and score are all that is kept of it
    seen = validate.profile(first.score(watched), by=["epoch"])
    baseline = seen.where(F.col("epoch") == "baseline")
    base_metrics = validate.evaluate_profile(baseline).first().asDict()
    stability = drift.psi_of_tally(seen, "total", "epoch", "baseline")
    verdict = [r.asDict() for r in govern.retrain_decision(stability, force=force_retrain).collect()]

    second = None
    if any(v["retrain"] for v in verdict):
        second = train(window_of(loans, *rolling), features=first.bins.features)
    final = second or first
    held_out = final.score(parts["holdout"])
    oot_metrics = validate.evaluate(held_out).first().asDict()
    oot = None if oot_metrics["ks_statistic"] is None else oot_metrics["ks_statistic"] / 100.0
    gate = govern.oot_decision(local_frame(spark, [(oot,)], "ks double"), gate_threshold)

    stages = [("baseline", "v1", k, v) for k, v in base_metrics.items()]
    stages += [("holdout", "v2" if second else "v1", k, v) for k, v in oot_metrics.items()]
    stages += [(v["epoch"], "v1", "psi", v["psi"]) for v in verdict]
    if log_path:
        pdo = first.card.pdo
        # Names of the logged parameters and metrics.
        calibration = {"base_score": pdo.base, "base_odds": pdo.odds, "pdo": pdo.pdo,
                       "factor": round(pdo.factor, 4), "offset": round(pdo.offset, 4)}
        govern.log_run(spark, log_path, run_prefix + "baseline_model_v1", calibration, base_metrics)
        for v in verdict:
            govern.log_run(
                spark, log_path, run_prefix + v["epoch"], {}, {"psi_vs_baseline": v["psi"]}, {"status": v["status"]}
            )
        promoted = gate.first()["decision"]
        govern.log_run(spark, log_path, run_prefix + "candidate_model", {}, oot_metrics, {"gate": promoted})
    return Lifecycle(
        first,
        second,
        local_frame(spark, stages, "stage string, model string, metric string, value double"),
        local_frame(spark, [(v["epoch"], v["psi"], v["status"], v["retrain"]) for v in verdict],
                    "epoch string, psi double, status string, retrain boolean"),
        gate,
        explain.notices(explain.declined(held_out), final.card, final.card.means),
    )
