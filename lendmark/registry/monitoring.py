"""Drift, governance, reason codes and the whole lifecycle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import functions as F

from lendmark.functions.expr import clip
from lendmark.functions.scale import tau
from lendmark.functions.state import kept
from lendmark.operators import drift, explain, govern, validate
from lendmark.operators.card import scored
from lendmark.operators.explain import FRAMEWORK, OTHER_REASON, REASONS
from lendmark.operators.woe import apply_woe, fit_woe
from lendmark.plans.layers import preprocess, with_epoch, write_bronze
from lendmark.plans.lifecycle import CATEGORICAL as LIFE_CATEGORICAL
from lendmark.plans.lifecycle import NUMERIC as LIFE_NUMERIC
from lendmark.plans.lifecycle import VIF_CANDIDATES, lifecycle
from lendmark.registry.base import (
    CARD,
    CARD_FEATURES,
    CARD_NUMERIC,
    FACTOR,
    FIRST_YEAR,
    LOANS,
    OFFSET,
    SCORE_OF,
    SCORED,
    WEIGHED,
    YEAR,
    epoch_sql,
    fresh_path,
    held,
    model_loans,
    out,
    probs_sql,
    query,
    resolved_sql,
    rounded,
    scored_loans,
    scored_sql,
    target_sql,
    weighed_loans,
    weighed_sql,
    with_,
    woe_sql,
)
from lendmark.registry.statistics import named_sql, screen_sql
from lendmark.registry.validation import AUC, DECILES, KS
from lendmark.sources import files
from lendmark.sources.tables import EPOCHS, loan_view

# ---------------------------------------------------------------------- drift


def by_epoch(spark, sf_dir):
    return with_epoch(scored_loans(spark, sf_dir, ["issue_year"]), EPOCHS).select("epoch", "score", "target", "pd")


def shocked(spark, sf_dir):
    """Baseline scores, and the drift years rescored after a worsening of two features."""
    loans = kept(model_loans(spark, sf_dir).select(*CARD_FEATURES, "target", "issue_year"), "loans")
    model = fit_woe(loans, CARD_FEATURES)
    base = loans.filter(F.col("issue_year") <= 1997).withColumn("epoch", F.lit("baseline"))
    worse = (
        loans.filter(F.col("issue_year").between(1999, 2000))
        .withColumn("dti", F.col("dti") * 1.5)
        .withColumn("revol_util", clip(F.col("revol_util") + 20.0, 0.0, 100.0))
        .withColumn("epoch", F.lit("shocked"))
    )
    return scored(apply_woe(base.unionByName(worse), model), CARD).select("epoch", "score")


ROUTED = SCORED + f""",
pool AS (SELECT {epoch_sql()} AS epoch, score FROM scored)"""
SHOCKED = (
    SCORED
    + """,
worse AS (SELECT * EXCLUDE (dti, revol_util), dti * 1.5 AS dti, least(greatest(revol_util + 20.0, 0.0), 100.0)::DOUBLE AS revol_util
  FROM base WHERE issue_year BETWEEN 1999 AND 2000),
"""
    + weighed_sql(CARD_NUMERIC, ["home_ownership"], "worse", "worse_weighed")
    + ",\n"
    + scored_sql("worse_weighed", "worse_scored")
    + """,
pool AS (SELECT 'baseline' AS epoch, score FROM scored WHERE issue_year <= 1997
         UNION ALL SELECT 'shocked', score FROM worse_scored)"""
)


def psi_sql(eps: str = "1e-4", uniform: bool = False) -> str:
    """CTE ``cells`` from ``pool(epoch, score)`` against its baseline epoch."""
    expected = "1" if uniform else "count(*) FILTER (WHERE epoch = 'baseline')"
    return f"""psi_edges AS (
  SELECT e[2:len(e) - 1] AS e FROM (SELECT list_sort(list_distinct(quantile_cont(score::DOUBLE, {probs_sql(10)}))) AS e
  FROM pool WHERE epoch = 'baseline')),
located AS (SELECT epoch, len(list_filter(e, lambda x: x < score)) AS bin FROM pool CROSS JOIN psi_edges),
{cells_sql(eps, expected)}"""


def cells_sql(eps: str, expected: str) -> str:
    return f"""bin_ids AS (SELECT unnest(range(len(e) + 1)) AS bin FROM psi_edges),
base_counts AS (
  SELECT b.bin, ({expected.replace('count(*)', 'count(epoch)')})::DOUBLE AS n FROM bin_ids b LEFT JOIN located l USING (bin) GROUP BY b.bin),
later AS (SELECT DISTINCT epoch FROM located WHERE epoch <> 'baseline'),
late_counts AS (
  SELECT t.epoch, b.bin, count(l.epoch)::DOUBLE AS n FROM later t CROSS JOIN bin_ids b
  LEFT JOIN located l ON l.epoch = t.epoch AND l.bin = b.bin GROUP BY t.epoch, b.bin),
floored AS (
  SELECT a.epoch, a.bin, greatest(b.n / sum(b.n) OVER p, {eps}::DOUBLE) AS e, greatest(a.n / sum(a.n) OVER p, {eps}::DOUBLE) AS a
  FROM late_counts a JOIN base_counts b USING (bin) WINDOW p AS (PARTITION BY a.epoch)),
shares AS (
  SELECT epoch, (bin + 1)::INT AS bin_index, e / sum(e) OVER p AS expected_share, a / sum(a) OVER p AS actual_share
  FROM floored WINDOW p AS (PARTITION BY epoch)),
cells AS (
  SELECT *, (actual_share - expected_share) * ln(actual_share / expected_share) AS psi_contribution FROM shares)"""


CELLS = "expected_share actual_share psi_contribution"
STATUS = (
    "CASE WHEN sum(psi_contribution) < 0.10 THEN 'STABLE' WHEN sum(psi_contribution) < 0.25 THEN 'MODERATE_DRIFT' "
    "ELSE 'SIGNIFICANT_DRIFT' END AS status"
)
TOTALS = f"SELECT epoch, round(sum(psi_contribution), 4) AS psi, {STATUS} FROM cells GROUP BY epoch"


@query("psi_edges", with_(SCORED, f"""ends AS (
  SELECT list_sort(list_distinct(quantile_cont(score::DOUBLE, {probs_sql(10)}))) AS e FROM scored WHERE issue_year <= 1997),
bounds AS (SELECT [NULL::DOUBLE] || e[2:len(e) - 1] || [NULL::DOUBLE] AS e FROM ends)""",
       select=out("bin_index", "lower upper", "(SELECT n::INT AS bin_index, e[n] AS lower, e[n + 1] AS upper "
                  "FROM (SELECT e, unnest(range(1, len(e))) AS n FROM bounds))")))  # fmt: skip
def psi_edges(spark, sf_dir):
    rows = by_epoch(spark, sf_dir)
    return rounded(drift.edge_rows(rows, drift.psi_edges(rows.filter(F.col("epoch") == "baseline"))))


@query("psi_breakdown", with_(SHOCKED, psi_sql(), select="SELECT epoch, bin_index, round(expected_share * 100.0, 2) AS expected_pct, "
       "round(actual_share * 100.0, 2) AS actual_pct, round(psi_contribution, 4) AS psi_contribution FROM cells"))  # fmt: skip
def psi_breakdown(spark, sf_dir):
    return drift.breakdown(drift.psi_cells(shocked(spark, sf_dir), "epoch", "baseline"))


@query("psi_status", with_(SHOCKED, psi_sql(), select=TOTALS))
def psi_status(spark, sf_dir):
    return drift.psi_by(shocked(spark, sf_dir), "epoch", "baseline")


@query("psi_uniform_expected", with_(SHOCKED, psi_sql(uniform=True), select=out("bin_index", CELLS, "cells")))
def psi_uniform_expected(spark, sf_dir):
    rows = shocked(spark, sf_dir)
    with held(rows) as both:
        edges = drift.psi_edges(both.filter(F.col("epoch") == "baseline"))
        cells = drift.psi(both.filter(F.col("epoch") == "shocked"), None, edges=edges)
    return rounded(cells.drop("epoch"))


@query("psi_histogram", with_(SHOCKED, f"""raw_ends AS (
  SELECT quantile_cont(score::DOUBLE, {probs_sql(10)}) AS q FROM pool WHERE epoch = 'baseline'),
ends AS (SELECT [q[1] - 1e-5] || q[2:len(q) - 1] || [q[len(q)] + 1e-5] AS q FROM raw_ends),
psi_edges AS (SELECT q[2:len(q) - 1] AS e FROM ends),
located AS (
  SELECT epoch, len(list_filter(q[2:len(q) - 1], lambda x: x <= score)) AS bin
  FROM pool CROSS JOIN ends WHERE score >= q[1] AND score <= q[len(q)])""",
       cells_sql("1e-6", "count(*) FILTER (WHERE epoch = 'baseline')"), select=out("epoch bin_index", CELLS, "cells")))
def psi_histogram(spark, sf_dir):
    return rounded(drift.psi_cells(shocked(spark, sf_dir), "epoch", "baseline", mode="hist", eps=1e-6))


@query("psi_by_epoch", with_(ROUTED, psi_sql(), select=TOTALS))
def psi_by_epoch(spark, sf_dir):
    return drift.psi_by(by_epoch(spark, sf_dir), "epoch", "baseline")


@query("retrain_trigger", with_(SHOCKED, psi_sql(), select=f"SELECT *, psi >= 0.25 AS retrain FROM ({TOTALS})"))
def retrain_trigger(spark, sf_dir):
    return govern.retrain_decision(drift.psi_by(shocked(spark, sf_dir), "epoch", "baseline"))


HOLDOUT = SCORED + f""",
held_out AS (SELECT * FROM scored WHERE {epoch_sql()} = 'holdout'),
cuts AS (SELECT list_sort(list_distinct(quantile_cont(score::DOUBLE, {probs_sql(10)}))) AS e FROM held_out),
grouped AS (
  SELECT len(list_filter(e[2:len(e) - 1], lambda x: x < score)) AS bin, sum(target) AS bads, count(*) - sum(target) AS goods
  FROM held_out CROSS JOIN cuts GROUP BY 1),
gaps AS (
  SELECT abs(sum(bads) OVER w / sum(bads) OVER () - sum(goods) OVER w / sum(goods) OVER ()) AS gap
  FROM grouped WINDOW w AS (ORDER BY bin))"""


@query("oot_gate", with_(HOLDOUT, select=out("decision", "ks threshold", "(SELECT max(gap) AS ks, 0.2 AS threshold, "
       "CASE WHEN max(gap) >= 0.2 THEN 'PROMOTE' ELSE 'REJECT' END AS decision FROM gaps)")))  # fmt: skip
def oot_gate(spark, sf_dir):
    held_out = by_epoch(spark, sf_dir).filter(F.col("epoch") == "holdout")
    return rounded(govern.oot_decision(validate.ks(validate.deciles(held_out))))


EVALUATED = [
    ("roc_auc", "round(roc_auc, 4)"), ("gini", "round(2 * roc_auc - 1, 4)"), ("ks_statistic", "ks_percent"),
    ("brier_score", "round(brier, 4)"), ("cost_optimal_tau", f"round({tau()!r}::DOUBLE, 4)"),
    ("precision_at_tau", "round(coalesce(tp / nullif(tp + fp, 0), 0), 4)"),
    ("recall_at_tau", "round(coalesce(tp / nullif(tp + fn, 0), 0), 4)"),
    ("total_financial_loss", "round(fp * 300.0::DOUBLE + fn * 10000.0::DOUBLE, 2)"),
]
METRIC_LIST = ", ".join(f"{{'key': '{name}', 'value': CAST(CAST({text} AS DOUBLE) AS VARCHAR)}}" for name, text in EVALUATED)
SUMS = f"""sums AS (
  SELECT avg((pd - target) ** 2) AS brier, count(*) FILTER (WHERE pd >= {tau()!r} AND target = 0) AS fp,
         count(*) FILTER (WHERE pd < {tau()!r} AND target = 1) AS fn,
         count(*) FILTER (WHERE pd >= {tau()!r} AND target = 1) AS tp FROM scored)"""


@query("run_log", with_(ROUTED, psi_sql(), DECILES, AUC, SUMS, f"""observed AS (
  SELECT unnest([{{'key': 'rows', 'value': CAST(count(*) AS VARCHAR)}}, {{'key': 'bads', 'value': CAST(sum(target)::BIGINT AS VARCHAR)}},
    {{'key': 'best_score', 'value': CAST(max(score) AS VARCHAR)}}, {{'key': 'seconds', 'value': 'true'}}]) AS m FROM scored),
measured AS (SELECT unnest([{METRIC_LIST}]) AS m FROM area CROSS JOIN {KS} CROSS JOIN sums),
watched AS (SELECT epoch, round(sum(psi_contribution), 4) AS psi FROM cells GROUP BY epoch)""", select=f"""
SELECT 'scoring' AS run_name, 'metric' AS kind, m.key AS key, m.value AS value FROM observed
UNION ALL SELECT 'scoring', 'tag', 'model', 'fixed card'
UNION ALL SELECT 'baseline', 'param', 'pdo', '{CARD.pdo.pdo}'
UNION ALL SELECT 'baseline', 'metric', m.key, m.value FROM measured
UNION ALL SELECT 'baseline', 'tag', 'status', 'logged'
UNION ALL SELECT 'watch', 'metric', epoch, CAST(psi AS VARCHAR) FROM watched"""))
def run_log(spark, sf_dir):
    """A scoring run that logs what it writes while it writes it, then its metrics and its stability, read back."""
    path, target = fresh_path(spark, "runs"), fresh_path(spark, "scores")
    counts = {"bads": F.sum("target"), "best_score": F.max("score")}
    govern.logged_write(by_epoch(spark, sf_dir), lambda df: df.write.parquet(target), path, "scoring", counts, tags={"model": "fixed card"})
    seen = validate.profile(spark.read.parquet(target), by=["epoch"])
    metrics = validate.evaluate_profile(seen).first().asDict()
    govern.log_run(spark, path, "baseline", {"pdo": CARD.pdo.pdo}, metrics, {"status": "logged"})
    psi = drift.psi_of_tally(seen.where("epoch IS NOT NULL"), "total", "epoch", "baseline").collect()
    govern.log_run(spark, path, "watch", {}, {r["epoch"]: r["psi"] for r in psi})
    timed = F.when(F.col("key") == "seconds", (F.col("value").cast("double") >= 0).cast("string")).otherwise(F.col("value"))
    return govern.runs(spark, path).drop("logged_at").withColumn("value", timed)


# The lifecycle as one statement. Every fit is a CTE with its own inner WITH, and a feature that the screen
# dropped keeps weight 0 everywhere, which the penalty turns into the coefficient 0.
LIFE_FEATURES = [*VIF_CANDIDATES, *LIFE_CATEGORICAL]
ROLLING = (1997, 2000)


def between(years: tuple[int, int]) -> str:
    return f"issue_year BETWEEN {years[0]} AND {years[1]}"


def ready_sql(tag: str, years: tuple[int, int]) -> str:
    """CTE ``ready_<tag>``: all loans, imputed from a window and with the modelling ratios."""
    window = f"(SELECT * FROM prepared WHERE {between(years)})"
    fills = [f"median({c}) AS {c}" for c in LIFE_NUMERIC]
    fills += [
        f"(SELECT {c} FROM {window} WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS {c}"
        for c in LIFE_CATEGORICAL
    ]
    filled = ", ".join(f"coalesce(p.{c}, f.{c}) AS {c}" for c in [*LIFE_NUMERIC, *LIFE_CATEGORICAL])
    return f"""fills_{tag} AS MATERIALIZED (SELECT {', '.join(fills)} FROM {window}),
imputed_{tag} AS (SELECT loan_id, target, issue_year, {filled} FROM prepared p CROSS JOIN fills_{tag} f),
ready_{tag} AS MATERIALIZED (
  SELECT * EXCLUDE (revol_util), (fico_range_low + fico_range_high) / 2.0 AS fico_mid,
         least(greatest(revol_util, 0.0), 100.0)::DOUBLE AS revol_util,
         least(greatest(installment / greatest(annual_inc / 12.0, 1.0) * 100.0, 0.0), 100.0)::DOUBLE AS installment_to_inc
  FROM imputed_{tag})"""


def beta_sql(source: str, d: int, rounds: int = 10) -> str:
    """Statement for the coefficients ``b`` of the balanced fit on ``source(x, target)``, x beginning with one.

    A Newton step sums gradient and Hessian, and a recursion eliminates one unknown after the other.
    """
    text = f"""WITH cells AS MATERIALIZED (
  SELECT x, target, n * sum(n) OVER () / (2.0::DOUBLE * sum(n) OVER (PARTITION BY target)) AS w
  FROM (SELECT x, target, count(*) AS n FROM {source} GROUP BY x, target)),
b0 AS MATERIALIZED (SELECT [{', '.join(['0.0::DOUBLE'] * d)}] AS b)"""
    sums = [f"sum(h * x[{i + 1}] * x[{j + 1}]) AS h{i}_{j}" for i in range(d) for j in range(i + 1)]
    sums += [f"sum(e * x[{i + 1}]) AS g{i}" for i in range(d)]
    lines = []
    for i in range(d):
        cells = [f"h{max(i, j)}_{min(i, j)}" + (" + 1.0::DOUBLE" if i == j and i else "") for j in range(d)]
        lines.append(f"[{', '.join([*cells, f'g{i} + b[{i + 1}]' if i else f'g{i}'])}]")
    for r in range(rounds):
        text += f""",
p{r} AS (SELECT x, w * (q - target) AS e, w * q * (1 - q) AS h
         FROM (SELECT *, 1 / (1 + exp(-list_dot_product(b, x))) AS q FROM cells CROSS JOIN b{r})),
n{r} AS MATERIALIZED (SELECT {', '.join(sums)} FROM p{r}),
b{r + 1} AS MATERIALIZED (
  WITH RECURSIVE swept(k, m) AS (
    SELECT 1, [{', '.join(lines)}] FROM n{r} CROSS JOIN b{r}
    UNION ALL
    SELECT k + 1, list_transform(m, lambda line, i: list_transform(line, lambda v, j:
             CASE WHEN i = k THEN v / m[k][k] ELSE v - line[k] * m[k][j] / m[k][k] END))
    FROM swept WHERE k <= {d})
  SELECT list_transform(range(1, {d + 1}), lambda i: b[i] - m[i][{d + 1}]) AS b FROM swept CROSS JOIN b{r} WHERE k = {d + 1})"""
    return text + f"\nSELECT b FROM b{rounds}"


def model_sql(tag: str, years: tuple[int, int]) -> str:
    """CTE ``scored_<tag>``: all loans with the probability and the score of the card fitted on a window."""
    weights = ", ".join(f"{f}_woe" for f in LIFE_FEATURES)
    score = SCORE_OF.format(x=f"{OFFSET}::DOUBLE - {FACTOR}::DOUBLE * z")
    return f"""woe_{tag} AS MATERIALIZED (
  WITH base AS (SELECT * FROM ready_{tag} WHERE {between(years)}),
  {woe_sql(VIF_CANDIDATES, LIFE_CATEGORICAL)}
  SELECT * FROM woe WHERE category IS NOT NULL OR feature IN (SELECT feature FROM screened)),
weighed_{tag} AS MATERIALIZED (
  WITH woe AS (SELECT * FROM woe_{tag}),
  {weighed_sql(VIF_CANDIDATES, LIFE_CATEGORICAL, f"ready_{tag}", "weighed")}
  SELECT loan_id, target, issue_year, [1.0::DOUBLE, {weights}] AS x FROM weighed),
window_{tag} AS (SELECT * FROM weighed_{tag} WHERE {between(years)}),
beta_{tag} AS MATERIALIZED ({beta_sql(f"window_{tag}", len(LIFE_FEATURES) + 1)}),
scored_{tag} AS MATERIALIZED (
  SELECT loan_id, target, issue_year, {epoch_sql()} AS epoch, 1.0 / (1.0 + exp(-z)) AS pd, {score} AS score
  FROM (SELECT *, list_dot_product(b, x) AS z FROM weighed_{tag} CROSS JOIN beta_{tag}))"""


def measured_sql(name: str, source: str) -> str:
    """CTE of (metric, value) rows of scored loans."""
    rows = ", ".join(f"{{'metric': '{metric}', 'value': CAST({text} AS DOUBLE)}}" for metric, text in EVALUATED)
    inner = with_(f"scored AS (SELECT * FROM {source})", DECILES, AUC, SUMS,
                  select=f"SELECT unnest([{rows}]) AS m FROM area CROSS JOIN {KS} CROSS JOIN sums")
    return f"{name} AS MATERIALIZED (SELECT m.metric AS metric, m.value AS value FROM ({inner}))"


LIFECYCLE = with_(
    LOANS,
    f"""prepared AS MATERIALIZED (
  SELECT loan_id, {target_sql('package')} AS target, {YEAR} AS issue_year, {', '.join([*LIFE_NUMERIC, *LIFE_CATEGORICAL])}
  FROM loans WHERE {resolved_sql('package')} AND {YEAR} >= {FIRST_YEAR})""",
    ready_sql("v1", EPOCHS["baseline"]),
    f"""screened AS MATERIALIZED (
  WITH base AS (SELECT * FROM ready_v1 WHERE {between(EPOCHS['baseline'])}),
  {screen_sql(VIF_CANDIDATES)}
  SELECT {named_sql(VIF_CANDIDATES)} AS feature FROM e{len(VIF_CANDIDATES) - 2} WHERE i = j)""",
    model_sql("v1", EPOCHS["baseline"]),
    ready_sql("v2", ROLLING),
    model_sql("v2", ROLLING),
    "trained AS (SELECT * FROM scored_v1 WHERE epoch = 'baseline')",
    "kept_out AS (SELECT * FROM scored_v2 WHERE epoch = 'holdout')",
    measured_sql("before", "trained"),
    measured_sql("after", "kept_out"),
    "pool AS (SELECT epoch, score FROM scored_v1 WHERE epoch IN ('baseline', 'inference', 'drift'))",
    psi_sql(),
    select="""SELECT 'baseline' AS stage, 'v1' AS model, metric, value FROM before
UNION ALL SELECT 'holdout', 'v2', metric, value FROM after
UNION ALL SELECT epoch, 'v1', 'psi', round(sum(psi_contribution), 4) FROM cells GROUP BY epoch
UNION ALL SELECT 'holdout', 'v2', 'promoted', CASE WHEN value >= 20.0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END
          FROM after WHERE metric = 'ks_statistic'
UNION ALL SELECT 'holdout', 'v2', 'notices', count(*)::DOUBLE FROM kept_out WHERE target = 1 OR score < 600""",
)


@query("lifecycle_3_epochs", LIFECYCLE)
def lifecycle_3_epochs(spark, sf_dir):
    """Batches are written per year first, so that every later step reads the folders of its years only."""
    path = fresh_path(spark, "batches")
    write_bronze(preprocess(loan_view(spark, sf_dir), "package", FIRST_YEAR), path)
    result = lifecycle(spark.read.parquet(path), EPOCHS, rolling=ROLLING)
    model = F.lit("v1" if result.second is None else "v2")
    promoted = result.gate.select(F.lit("promoted"), (F.col("decision") == "PROMOTE").cast("double"))
    letters = result.notices.agg(F.count("*").cast("double")).select(F.lit("notices"), "*")
    gate = promoted.union(letters).toDF("metric", "value").select(F.lit("holdout").alias("stage"), model.alias("model"), "metric", "value")
    return result.stages.unionByName(gate)


# -------------------------------------------------------------- explanations

MEANS = "means AS (SELECT " + ", ".join(f"avg({c}) AS m_{c}" for c in CARD.coefs) + " FROM weighed)"


def phi(column: str) -> str:
    return f"{CARD.coefs[column]!r} * ({column} - m_{column})"


def phi_long(source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT loan_id, '{c.removesuffix('_woe')}' AS feature, {phi(c)} AS phi FROM {source} CROSS JOIN means" for c in CARD.coefs
    )


PHI_COLUMNS = [f"phi_{f}" for f in CARD.features]


@query("linear_attribution", with_(WEIGHED, MEANS, select=out("loan_id", " ".join(PHI_COLUMNS), "(SELECT loan_id, "
       + ", ".join(f"{phi(c)} AS phi_{c.removesuffix('_woe')}" for c in CARD.coefs) + " FROM weighed CROSS JOIN means)")))
def linear_attribution(spark, sf_dir):
    rows, bins = weighed_loans(spark, sf_dir)
    means = explain.bin_means(bins, CARD)
    return rounded(explain.attributions(rows, CARD, means).select("loan_id", *PHI_COLUMNS))


@query("decline_filter", with_(SCORED, select=f"""SELECT 'score' AS policy, loan_id, score FROM scored WHERE target = 1 OR score < 600
UNION ALL SELECT 'cutoff', loan_id, score FROM scored WHERE pd >= {tau()!r}"""))
def decline_filter(spark, sf_dir):
    rows = scored_loans(spark, sf_dir)
    parts = [explain.declined(rows, p).select(F.lit(p).alias("policy"), "loan_id", "score") for p in ("score", "cutoff")]
    return parts[0].unionByName(parts[1])


def reason_sql(column: str, values: Sequence[tuple[str, str]], other: str) -> str:
    cases = " ".join("WHEN '{}' THEN '{}'".format(f, v.replace("'", "''")) for f, v in values)
    return f"CASE feature {cases} ELSE {other} END AS {column}"


CODE = reason_sql("reason_code", [(f, c) for f, (c, _) in REASONS.items()], f"'{OTHER_REASON}'")
STATEMENT = reason_sql("statement", [(f, s) for f, (_, s) in REASONS.items()],
                       "'The credit profile entry ''' || feature || ''' does not meet the lending criteria.'")


@query("reason_code_join", with_(WEIGHED, MEANS, f"phis AS ({phi_long('weighed')})",
       select=out("loan_id feature reason_code statement", "phi", f"(SELECT *, {CODE}, {STATEMENT} FROM phis)")))
def reason_code_join(spark, sf_dir):
    rows, bins = weighed_loans(spark, sf_dir)
    long = explain.attribution_long(rows, CARD, explain.bin_means(bins, CARD))
    return rounded(explain.with_reasons(long.drop("position")))


DECLINED = SCORED + f""",
{MEANS},
declined AS (SELECT * FROM scored WHERE target = 1 OR score < 600),
phis AS ({phi_long('declined')}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY loan_id ORDER BY phi DESC, feature) AS position FROM phis),
top AS (SELECT loan_id, position::INT AS position, feature AS feature_name, round(phi, 4) + 0.0::DOUBLE AS attribution_impact,
               {CODE}, {STATEMENT} FROM ranked WHERE position <= 4)"""


def declined_with_means(spark, sf_dir):
    rows, bins = weighed_loans(spark, sf_dir)
    means = explain.bin_means(bins, CARD)
    return explain.declined(scored(rows, CARD)), means


@query("top_reasons", with_(DECLINED, select="SELECT loan_id, position, reason_code, feature_name, attribution_impact FROM top"))
def top_reasons(spark, sf_dir):
    rows, means = declined_with_means(spark, sf_dir)
    ready = explain.top_reasons(explain.attributions(rows, CARD, means), CARD)
    flat = ready.select("loan_id", F.posexplode("reasons").alias("position", "r"))
    return rounded(
        flat.select(
            "loan_id", (F.col("position") + 1).alias("position"), "r.reason_code", "r.feature_name", "r.attribution_impact"
        )
    )


@query("adverse_action_notice", with_(DECLINED, select=f"""SELECT loan_id AS application_id, 'DECLINED' AS decision,
  '{FRAMEWORK}' AS regulatory_framework, score AS calculated_fico_score, round(pd, 4) AS predicted_default_probability,
  round({tau()!r}::DOUBLE, 4) AS decision_threshold_tau_star, position, reason_code, feature_name, attribution_impact, statement
FROM declined JOIN top USING (loan_id)"""))
def adverse_action_notice(spark, sf_dir):
    rows, means = declined_with_means(spark, sf_dir)
    letters = explain.notices(rows, CARD, means)
    flat = letters.select("*", F.posexplode("top_adverse_action_reasons").alias("at", "r"))
    return rounded(
        flat.select(
            *letters.columns[:-1],
            (F.col("at") + 1).alias("position"),
            "r.reason_code",
            "r.feature_name",
            "r.attribution_impact",
            "r.statement",
        )
    )


@query("attribution_long", with_(WEIGHED, MEANS, f"phis AS ({phi_long('weighed')})", select=out("loan_id position feature", "phi",
       "(SELECT *, (row_number() OVER (PARTITION BY loan_id ORDER BY phi, feature))::INT AS position FROM phis)")))
def attribution_long(spark, sf_dir):
    rows, bins = weighed_loans(spark, sf_dir)
    return rounded(explain.attribution_long(rows, CARD, explain.bin_means(bins, CARD)))


@query("sink_notice_json", with_(DECLINED, select="SELECT loan_id AS application_id, score AS calculated_fico_score, position, "
       "reason_code, feature_name, attribution_impact FROM top JOIN declined USING (loan_id)"))  # fmt: skip
def sink_notice_json(spark, sf_dir):
    rows, means = declined_with_means(spark, sf_dir)
    letters = explain.notices(rows, CARD, means)
    path = fresh_path(spark, "notices")
    files.write_notices(letters, path)
    back = spark.read.schema(letters.schema).json(path)
    reasons = back.select("application_id", "calculated_fico_score", F.posexplode("top_adverse_action_reasons").alias("at", "r"))
    return rounded(
        reasons.select(
            "application_id",
            "calculated_fico_score",
            (F.col("at") + 1).alias("position"),
            "r.reason_code",
            "r.feature_name",
            "r.attribution_impact",
        )
    )
