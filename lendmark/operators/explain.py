"""Per-applicant attributions, decline reasons and adverse-action notices.

All of it is row-local arithmetic over the fitted coefficients: every declined
row gets its notice in the same pass that scores it.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lendmark.functions.scale import tau
from lendmark.functions.state import local_frame
from lendmark.operators.card import Card
from lendmark.operators.woe import WoeModel

# Reason code per feature; the statements are our own wording.
REASONS = {
    "dti": ("RC01", "Existing debt payments are high in relation to income."),
    "revol_util": ("RC02", "A large part of the available revolving credit is in use."),
    "fico_mid": ("RC03", "The credit bureau score is below the level required."),
    "inq_last_6mths": ("RC04", "Many credit inquiries were made in recent months."),
    "delinq_2yrs": ("RC05", "Payments were past due within the last two years."),
    "annual_inc": ("RC06", "Income is low in relation to the obligations."),
    "open_acc": ("RC07", "Too few active credit accounts are on record."),
}
OTHER_REASON = "RC99"
# Fixed value: the framework named in notices.
FRAMEWORK = "Federal Reserve SR 11-7 / ECOA Notice of Adverse Action"
NO_ID = 999_999


def other_statement(feature: Column) -> Column:
    return F.concat(F.lit("The credit profile entry '"), feature, F.lit("' does not meet the lending criteria."))


def reason_table(spark: SparkSession) -> DataFrame:
    rows = [(f, code, text) for f, (code, text) in REASONS.items()]
    return local_frame(spark, rows, "feature string, reason_code string, statement string")


def with_reasons(df: DataFrame, codes: DataFrame | None = None) -> DataFrame:
    """Join (feature) rows with their reason code and statement; RC99 for other features."""
    codes = reason_table(df.sparkSession) if codes is None else codes
    return (
        df.join(codes, "feature", "left")
        .withColumn("reason_code", F.coalesce("reason_code", F.lit(OTHER_REASON)))
        .withColumn("statement", F.coalesce("statement", other_statement(F.col("feature"))))
    )


def bin_means(model: WoeModel, card: Card) -> dict[str, float]:
    """Means of the WoE columns over the rows that the bins were fitted on, from the bin table alone.

    Rows without a bin have weight 0. No pass over the rows is needed.
    """
    sums = model.bins.groupBy("feature").agg(F.sum(F.col("total") * F.col("woe")).alias("s")).collect()
    by_feature = {r["feature"]: r["s"] for r in sums}  # a row per feature
    return {c: (by_feature.get(c.removesuffix("_woe")) or 0.0) / max(model.rows, 1) for c in card.coefs}


def woe_means(df: DataFrame, card: Card) -> dict[str, float]:
    """Training means of the WoE columns, over all rows."""
    row = df.agg(*(F.avg(c).alias(c) for c in card.coefs)).first()
    return {c: row[c] or 0.0 for c in card.coefs}


def attribution(card: Card, means: Mapping[str, float], column: str) -> Column:
    return F.lit(card.coefs[column]) * (F.col(column) - F.lit(means[column]))


def attributions(df: DataFrame, card: Card, means: Mapping[str, float]) -> DataFrame:
    """Add ``phi_<feature>``: coefficient x (WoE - mean WoE). Positive is riskier."""
    return df.withColumns({f"phi_{c.removesuffix('_woe')}": attribution(card, means, c) for c in card.coefs})


def _described(entry: Column) -> Column:
    feature = entry["feature"]
    code, text = F.lit(OTHER_REASON), other_statement(feature)
    for name, (reason, statement) in REASONS.items():
        code = F.when(feature == name, reason).otherwise(code)
        text = F.when(feature == name, statement).otherwise(text)
    return F.struct(
        code.alias("reason_code"),
        feature.alias("feature_name"),
        F.round(-entry["rank"], 4).alias("attribution_impact"),
        text.alias("statement"),
    )


def top_reasons(df: DataFrame, card: Card, k: int = 4) -> DataFrame:
    """Add ``reasons``: the ``k`` largest attributions with code and statement, whatever
    their sign; the feature name decides ties. Sorted within the row, no shuffle."""
    entries = F.array(
        *(F.struct((-F.col(f"phi_{f}")).alias("rank"), F.lit(f).alias("feature")) for f in card.features)
    )
    return df.withColumn("reasons", F.transform(F.slice(F.sort_array(entries), 1, k), _described))


def declined(df: DataFrame, policy: str = "score", cutoff: float | None = None, target: str = "target") -> DataFrame:
    """``score``: known bad or score below 600. ``cutoff``: probability at or above the cutoff."""
    if policy == "score":
        return df.filter((F.col(target) == 1) | (F.col("score") < 600))
    if policy == "cutoff":
        return df.filter(F.col("pd") >= (tau() if cutoff is None else cutoff))
    raise ValueError(f"unknown policy {policy!r}")


def notices(df: DataFrame, card: Card, means: Mapping[str, float], key: str = "loan_id", k: int = 4) -> DataFrame:
    """One notice per row of (already declined) applicants."""
    ready = top_reasons(attributions(df, card, means), card, k)
    application = F.coalesce(F.col(key), F.lit(NO_ID)) if key in df.columns else F.lit(NO_ID)
    return ready.select(
        application.cast("bigint").alias("application_id"),
        F.lit("DECLINED").alias("decision"),
        F.lit(FRAMEWORK).alias("regulatory_framework"),
        F.col("score").alias("calculated_fico_score"),
        F.round("pd", 4).alias("predicted_default_probability"),
        F.round(F.lit(tau()), 4).alias("decision_threshold_tau_star"),
        F.col("reasons").alias("top_adverse_action_reasons"),
    )


def attribution_long(df: DataFrame, card: Card, means: Mapping[str, float], key: str = "loan_id") -> DataFrame:
    """(key, position, feature, phi): waterfall rows per applicant, from the smallest phi up."""
    entries = F.sort_array(
        F.array(*(F.struct(F.col(f"phi_{f}").alias("phi"), F.lit(f).alias("feature")) for f in card.features))
    )
    return (
        attributions(df, card, means)
        .select(key, F.posexplode(entries).alias("position", "entry"))
        .select(key, (F.col("position") + 1).alias("position"), "entry.feature", "entry.phi")
    )
