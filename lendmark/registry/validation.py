"""Validation metrics of the scored loans."""

from __future__ import annotations

from pyspark.sql import functions as F

from lendmark.functions.scale import tau
from lendmark.operators import validate
from lendmark.registry.base import SCORED, held, out, probs_sql, query, rounded, scored_loans, with_

SCORE_COLUMNS = ("loan_id", "target", "pd", "score")
DECILES = f"""cuts AS (SELECT list_sort(list_distinct(quantile_cont(score::DOUBLE, {probs_sql(10)}))) AS e FROM scored),
grouped AS (
  SELECT (len(list_filter(e[2:len(e) - 1], lambda x: x < score)) + 1)::INT AS decile, count(*) AS total,
         sum(target)::BIGINT AS bads, (count(*) - sum(target))::BIGINT AS goods, min(score) AS min_score,
         max(score) AS max_score
  FROM scored CROSS JOIN cuts GROUP BY 1),
deciles AS (
  SELECT *, bads / total AS bad_rate, bads / sum(bads) OVER () AS pct_bads, goods / sum(goods) OVER () AS pct_goods,
         sum(bads) OVER w / sum(bads) OVER () AS cum_pct_bads, sum(goods) OVER w / sum(goods) OVER () AS cum_pct_goods,
         abs(sum(bads) OVER w / sum(bads) OVER () - sum(goods) OVER w / sum(goods) OVER ()) AS ks_separation
  FROM grouped WINDOW w AS (ORDER BY decile))"""
BAND = (
    "CASE WHEN ks_percent < 20 THEN 'rejected' WHEN ks_percent < 35 THEN 'acceptable' WHEN ks_percent <= 55 THEN 'ideal' "
    "WHEN ks_percent > 60 THEN 'leakage audit' ELSE 'unclassified' END AS band"
)
KS = (
    "(SELECT max(ks_separation) AS ks, round(max(ks_separation) * 100.0, 2) AS ks_percent, "
    "arg_max(decile, ks_separation) AS ks_decile FROM deciles)"
)


def scores(spark, sf_dir):
    return scored_loans(spark, sf_dir, ["loan_id"]).select(*SCORE_COLUMNS)


@query("decile_table", with_(SCORED, DECILES, select=out("decile total bads goods min_score max_score",
       "bad_rate pct_bads pct_goods cum_pct_bads cum_pct_goods ks_separation", "deciles")))
def decile_table(spark, sf_dir):
    return rounded(validate.deciles(scores(spark, sf_dir)))


@query("ks_statistic", with_(SCORED, DECILES, select=out("ks_decile", "ks ks_percent", KS)))
def ks_statistic(spark, sf_dir):
    return rounded(validate.ks(validate.deciles(scores(spark, sf_dir))).select("ks", "ks_percent", "ks_decile"))


@query("ks_band", with_(SCORED, DECILES, select=f"SELECT ks_percent, {BAND} FROM {KS}"))
def ks_band(spark, sf_dir):
    return validate.ks(validate.deciles(scores(spark, sf_dir))).select("ks_percent", "band")


@query("ks_exact", with_(SCORED, """counts AS (
  SELECT score, sum(target)::DOUBLE AS bads, (count(*) - sum(target))::DOUBLE AS goods FROM scored GROUP BY score),
gaps AS (SELECT score, abs(sum(bads) OVER w / sum(bads) OVER () - sum(goods) OVER w / sum(goods) OVER ()) AS gap
  FROM counts WINDOW w AS (ORDER BY score))""",
       select=out("at_score", "ks_exact", "(SELECT max(gap) AS ks_exact, arg_max(score, gap) AS at_score FROM gaps)")))
def ks_exact(spark, sf_dir):
    return rounded(validate.ks_exact(scores(spark, sf_dir)))


AUC = """counts AS (
  SELECT pd, sum(target)::DOUBLE AS bads, (count(*) - sum(target))::DOUBLE AS goods FROM scored GROUP BY pd),
area AS (
  SELECT sum(bads * (below + goods / 2)) / (sum(bads) * sum(goods)) AS roc_auc FROM (
    SELECT *, coalesce(sum(goods) OVER (ORDER BY pd ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
    FROM counts))"""


@query("roc_auc", with_(SCORED, AUC, select=out("", "roc_auc", "area")))
def roc_auc(spark, sf_dir):
    return rounded(validate.auc(scores(spark, sf_dir)).select("roc_auc"))


@query("gini", with_(SCORED, AUC, select=out("", "roc_auc gini", "(SELECT roc_auc, 2 * roc_auc - 1 AS gini FROM area)")))
def gini(spark, sf_dir):
    return rounded(validate.auc(scores(spark, sf_dir)))


@query("brier", with_(SCORED, select=out("", "brier_score", "(SELECT avg((pd - target) ** 2) AS brier_score FROM scored)")))
def brier(spark, sf_dir):
    return rounded(validate.brier(scores(spark, sf_dir)))


@query("brier_decomposition", with_(SCORED, f"""cuts AS (
  SELECT list_sort(list_distinct(quantile_cont(pd, {probs_sql(10)}))) AS e FROM scored),
bins AS (
  SELECT len(list_filter(e[2:len(e) - 1], lambda x: x < pd)) AS bin, count(*)::DOUBLE AS n, avg(pd) AS p,
         avg(target) AS y, sum((pd - target) ** 2) AS sq FROM scored CROSS JOIN cuts GROUP BY 1),
weighted AS (SELECT *, n / sum(n) OVER () AS w, sum(n * y) OVER () / sum(n) OVER () AS base FROM bins),
parts AS (
  SELECT sum(w * (p - y) ** 2) AS reliability, sum(w * (y - base) ** 2) AS resolution,
         max(base * (1 - base)) AS uncertainty, sum(sq) / sum(n) AS brier_score FROM weighted)""",
       select=out("", "reliability resolution uncertainty brier_score residual",
                  "(SELECT *, brier_score - (reliability - resolution + uncertainty) AS residual FROM parts)")))
def brier_decomposition(spark, sf_dir):
    with held(scores(spark, sf_dir)) as rows:
        return rounded(validate.brier_parts(rows))


@query("cost_cutoff", with_(SCORED, select=out("purpose loans above", "tau",
       f"(SELECT purpose, {tau()!r} AS tau, count(*) AS loans, count(*) FILTER (WHERE pd >= {tau()!r}) AS above FROM scored "
       "GROUP BY purpose)")))  # fmt: skip
def cost_cutoff(spark, sf_dir):
    flagged = F.count_if(F.col("pd") >= tau())
    return rounded(
        scored_loans(spark, sf_dir, ["purpose"])
        .groupBy("purpose")
        .agg(F.lit(tau()).alias("tau"), F.count("*").alias("loans"), flagged.alias("above"))
    )


TAU = f"{tau()!r}::DOUBLE"


@query("confusion_at_cutoff", with_(SCORED, f"""cells AS (
  SELECT {TAU} AS cutoff, count(*) FILTER (WHERE pd < {TAU} AND target = 0) AS tn,
         count(*) FILTER (WHERE pd >= {TAU} AND target = 0) AS fp, count(*) FILTER (WHERE pd < {TAU} AND target = 1) AS fn,
         count(*) FILTER (WHERE pd >= {TAU} AND target = 1) AS tp
  FROM scored)""", select=out("tn fp fn tp", "cutoff precision recall total_loss",
       "(SELECT *, coalesce(tp / nullif(tp + fp, 0), 0) AS precision, coalesce(tp / nullif(tp + fn, 0), 0) AS recall, "
       "fp * 300.0 + fn * 10000.0 AS total_loss FROM cells)")))  # fmt: skip
def confusion_at_cutoff(spark, sf_dir):
    return rounded(validate.confusion(scores(spark, sf_dir)))


CURVE = """counts AS (
  SELECT round(pd, 6) AS p, sum(target)::DOUBLE AS bads, (count(*) - sum(target))::DOUBLE AS goods FROM scored GROUP BY 1),
steps AS (
  SELECT p, bads, goods, sum(bads) OVER w AS cum_bads, sum(goods) OVER w AS cum_goods, sum(bads) OVER () AS all_bads,
         sum(goods) OVER () AS all_goods FROM counts WINDOW w AS (ORDER BY p DESC))"""


def steady(spark, sf_dir):
    """Scores with the probability cut to six digits, so that both engines tie the same rows."""
    return scores(spark, sf_dir).withColumn("pd", F.round("pd", 6))


@query("roc_points", with_(SCORED, CURVE, select=out("", "threshold tpr fpr",
       "(SELECT p AS threshold, cum_bads / all_bads AS tpr, cum_goods / all_goods AS fpr FROM steps)")))
def roc_points(spark, sf_dir):
    return rounded(validate.curve_points(steady(spark, sf_dir)).select("threshold", "tpr", "fpr"))


@query("pr_points", with_(SCORED, CURVE, select=out("", "threshold precision recall",
       "(SELECT p AS threshold, cum_bads / (cum_bads + cum_goods) AS precision, cum_bads / all_bads AS recall FROM steps)")))
def pr_points(spark, sf_dir):
    return rounded(validate.curve_points(steady(spark, sf_dir)).select("threshold", "precision", "recall"))


@query("pr_auc", with_(SCORED, CURVE, select=out("", "pr_auc prior_rate", """(
  SELECT sum((recall - before_recall) * (precision + before_precision) / 2) AS pr_auc, max(prior) AS prior_rate FROM (
    SELECT recall, precision, prior, coalesce(lag(recall) OVER (ORDER BY p DESC), 0) AS before_recall,
           coalesce(lag(precision) OVER (ORDER BY p DESC), 1) AS before_precision
    FROM (SELECT p, cum_bads / all_bads AS recall, cum_bads / (cum_bads + cum_goods) AS precision,
                 all_bads / (all_bads + all_goods) AS prior FROM steps)))""")))  # fmt: skip
def pr_auc(spark, sf_dir):
    return rounded(validate.pr_auc(steady(spark, sf_dir)))


@query("expected_loss", with_(SCORED, select=out("grade loans", "exposure expected_loss",
       "(SELECT grade, count(*) AS loans, sum(loan_amnt) AS exposure, sum(pd * 0.45::DOUBLE * loan_amnt) AS expected_loss "
       "FROM scored GROUP BY grade)").replace("6) AS exp", "2) AS exp")))  # fmt: skip
def expected_loss(spark, sf_dir):
    rows = scored_loans(spark, sf_dir, ["grade", "loan_amnt"])
    return rounded(validate.expected_loss(rows, F.col("pd"), F.lit(0.45), F.col("loan_amnt"), "grade"), 2)


@query("evaluate_all", with_(SCORED, DECILES, AUC, f"""sums AS (
  SELECT avg((pd - target) ** 2) AS brier, count(*) FILTER (WHERE pd >= {tau()!r} AND target = 0) AS fp,
         count(*) FILTER (WHERE pd < {tau()!r} AND target = 1) AS fn,
         count(*) FILTER (WHERE pd >= {tau()!r} AND target = 1) AS tp FROM scored)""",
       select=f"""SELECT round(roc_auc, 4) AS roc_auc, round(2 * roc_auc - 1, 4) AS gini, ks_percent AS ks_statistic,
  round(brier, 4) AS brier_score, round({tau()!r}::DOUBLE, 4) AS cost_optimal_tau,
  round(coalesce(tp / nullif(tp + fp, 0), 0), 4) AS precision_at_tau,
  round(coalesce(tp / nullif(tp + fn, 0), 0), 4) AS recall_at_tau,
  round(fp * 300.0::DOUBLE + fn * 10000.0::DOUBLE, 2) AS total_financial_loss
FROM area CROSS JOIN {KS} CROSS JOIN sums"""))
def evaluate_all(spark, sf_dir):
    return validate.evaluate(scores(spark, sf_dir))
