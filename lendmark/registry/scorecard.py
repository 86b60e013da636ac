"""Scorecard fit, probabilities, scores and points."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import functions as F

from lendmark.functions.scale import Pdo, score_from_pd
from lendmark.operators import card as cards
from lendmark.operators.woe import woe_columns
from lendmark.registry.base import (
    CARD,
    CARD_WOE,
    FACTOR,
    MODEL_LOANS,
    OFFSET,
    SCORED,
    SCORE_OF,
    WEIGHED,
    fresh_path,
    model_loans,
    out,
    query,
    rounded,
    scored_loans,
    weighed_loans,
    with_,
)
from lendmark.sources import files

COLUMNS = list(CARD.coefs)

# ----------------------------------------------------------------------- fit


@query("balanced_weights", with_(MODEL_LOANS, select=out("target loans", "class_weight",
       "(SELECT target, count(*) AS loans, (SELECT count(*) FROM base) / (2.0 * count(*)) AS class_weight FROM base "
       "GROUP BY target)")))  # fmt: skip
def balanced_weights(spark, sf_dir):
    weighted = cards.with_weights(model_loans(spark, sf_dir))
    return rounded(weighted.groupBy("target").agg(F.count("*").alias("loans"), F.max("class_weight").alias("class_weight")))


def newton_sql(columns: Sequence[str], rounds: int = 8) -> str:
    """CTE ``beta(i, v)``: minimum of the weighted, penalised log-loss by Newton steps.

    Every step sums gradient and Hessian over the rows, then solves the system
    by eliminating one unknown after the other.
    """
    d = len(columns) + 1
    x = ["1.0::DOUBLE", *columns]
    text = f"""cells AS MATERIALIZED (
  SELECT {', '.join(columns)}, target, count(*) * (SELECT count(*) FROM weighed)
         / (2.0 * (SELECT count(*) FROM weighed o WHERE o.target = weighed.target)) AS w
  FROM weighed GROUP BY {', '.join(columns)}, target),
b0 AS MATERIALIZED (SELECT {', '.join(f'0.0::DOUBLE AS b{i}' for i in range(d))})"""
    for r in range(rounds):
        logit = " + ".join(f"b{i} * {x[i]}" for i in range(d))
        sums = [
            f"sum(h * {x[i]} * {x[j]}) + {1.0 if i == j and i else 0.0}::DOUBLE AS h{i}_{j}" for i in range(d) for j in range(i + 1)
        ]
        sums += [f"sum(e * {x[i]}) + {f'max(b{i})' if i else '0.0::DOUBLE'} AS g{i}" for i in range(d)]
        cells = [f"SELECT {i} AS i, {j} AS j, h{max(i, j)}_{min(i, j)} AS v FROM n{r}" for i in range(d) for j in range(d)]
        cells += [f"SELECT {i}, {d}, g{i} FROM n{r}" for i in range(d)]
        text += f""",
p{r} AS (SELECT *, w * (1 / (1 + exp(-({logit}))) - target) AS e,
                w * (1 / (1 + exp(-({logit})))) * (1 - 1 / (1 + exp(-({logit})))) AS h FROM cells CROSS JOIN b{r}),
n{r} AS MATERIALIZED (SELECT {', '.join(sums)} FROM p{r}),
a{r}_0 AS MATERIALIZED ({' UNION ALL '.join(cells)})"""
        for k in range(d):
            text += f""",
a{r}_{k + 1} AS MATERIALIZED (
  SELECT a.i, a.j, CASE WHEN a.i = {k} THEN a.v / p.v ELSE a.v - c.v * q.v / p.v END AS v
  FROM a{r}_{k} a JOIN a{r}_{k} c ON c.i = a.i AND c.j = {k} JOIN a{r}_{k} q ON q.i = {k} AND q.j = a.j
  JOIN a{r}_{k} p ON p.i = {k} AND p.j = {k})"""
        moves = ", ".join(
            f"(SELECT b{i} FROM b{r}) - max(v) FILTER (WHERE i = {i} AND j = {d}) AS b{i}" for i in range(d)
        )
        text += f",\nb{r + 1} AS MATERIALIZED (SELECT {moves} FROM a{r}_{d})"
    rows = [f"SELECT {i} AS position, '{n}' AS feature, b{i} AS coefficient FROM b{rounds}"
            for i, n in enumerate(["Intercept", *columns])]
    return text + f",\nbeta AS ({' UNION ALL '.join(rows)})"


FITTED = WEIGHED + ",\n" + newton_sql(COLUMNS)


def fit(spark, sf_dir):
    loans, model = weighed_loans(spark, sf_dir, [])
    return cards.fit_card(loans, woe_columns(model))


@query("fit_scorecard", with_(FITTED, select="SELECT position, feature, round(coefficient, 4) AS coefficient FROM beta"))
def fit_scorecard(spark, sf_dir):
    table = cards.coefficients(spark, fit(spark, sf_dir))
    return rounded(table.select("position", "feature", "coefficient"), 4)


@query("coefficient_table", with_(FITTED, select="SELECT position, feature, round(coefficient, 4) AS coefficient, "
       "round(exp(coefficient), 4) AS odds_ratio FROM beta"))  # fmt: skip
def coefficient_table(spark, sf_dir):
    return rounded(cards.coefficients(spark, fit(spark, sf_dir)), 4)


# -------------------------------------------------------------------- scores


@query("predict_pd", with_(SCORED, select=out("loan_id", "pd", "scored")))
def predict_pd(spark, sf_dir):
    rows, _ = weighed_loans(spark, sf_dir, ["loan_id"])
    return rounded(cards.with_pd(rows, CARD).select("loan_id", "pd"))


@query("pdo_calibration", with_(MODEL_LOANS, select=out("issue_year", "factor offset_points observed_odds points",
       f"(SELECT issue_year, {FACTOR}::DOUBLE AS factor, {OFFSET}::DOUBLE AS offset_points, odds AS observed_odds, "
       f"{OFFSET}::DOUBLE + {FACTOR}::DOUBLE * ln(odds) AS points FROM (SELECT issue_year, "
       "(count(*) - sum(target)) / sum(target)::DOUBLE AS odds FROM base GROUP BY issue_year))")))  # fmt: skip
def pdo_calibration(spark, sf_dir):
    """The scale applied to the good:bad odds of every vintage."""
    pdo = Pdo()
    odds = F.try_divide(F.count_if(F.col("target") == 0), F.count_if(F.col("target") == 1))
    vintages = model_loans(spark, sf_dir).groupBy("issue_year").agg(odds.alias("observed_odds"))
    return rounded(
        vintages.select(
            "issue_year",
            F.lit(pdo.factor).alias("factor"),
            F.lit(pdo.offset).alias("offset_points"),
            "observed_odds",
            (F.lit(pdo.offset) + F.lit(pdo.factor) * F.log("observed_odds")).alias("points"),
        )
    )


@query("score_scale", with_(SCORED, select="SELECT loan_id, score FROM scored"))
def score_scale(spark, sf_dir):
    return scored_loans(spark, sf_dir, ["loan_id"]).select("loan_id", "score")


@query("score_from_pd", with_(SCORED, select="SELECT loan_id, " + SCORE_OF.format(
       x=f"{OFFSET}::DOUBLE - {FACTOR}::DOUBLE * ln(least(greatest(pd / (1 - pd), 1e-7), 1e7))") + " AS score FROM scored"))
def score_from_pd_query(spark, sf_dir):
    return scored_loans(spark, sf_dir, ["loan_id"]).select("loan_id", score_from_pd(F.col("pd")).alias("score"))


BETAS = " UNION ALL ".join(f"SELECT '{c.removesuffix('_woe')}' AS feature, {b!r}::DOUBLE AS coefficient" for c, b in CARD.coefs.items())
BASE_POINTS = f"(({OFFSET}::DOUBLE - {FACTOR}::DOUBLE * {CARD.intercept!r}) / {len(COLUMNS)})"
POINTS = f"""betas AS ({BETAS}),
points AS (
  SELECT feature, bin AS bin_id, lower, upper, category, goods, bads, round(woe, 4) AS woe,
         CAST(round_even({BASE_POINTS} - {FACTOR}::DOUBLE * coefficient * woe, 0) AS INT) AS scorecard_points
  FROM woe JOIN betas USING (feature))"""


@query("points_table", with_(CARD_WOE, POINTS, select="SELECT feature, bin_id, category, goods, bads, woe, scorecard_points FROM points"))
def points_table(spark, sf_dir):
    _, model = weighed_loans(spark, sf_dir, [])
    table = cards.points(model.bins, CARD)
    return table.select("feature", "bin_id", "category", "goods", "bads", "woe", "scorecard_points")


@query("score_by_points", with_(CARD_WOE, POINTS, select="""SELECT loan_id, sum(scorecard_points)::INT AS points_score FROM (
  SELECT loan_id, scorecard_points FROM long JOIN points USING (feature) WHERE value > lower AND value <= upper
  UNION ALL SELECT loan_id, scorecard_points FROM long_text t JOIN points p
  ON t.feature = p.feature AND t.value = p.category) GROUP BY loan_id"""))  # fmt: skip
def score_by_points(spark, sf_dir):
    loans, model = weighed_loans(spark, sf_dir, ["loan_id"])
    table = cards.points(model.bins, CARD)
    return cards.score_by_points(loans, model, table, CARD).select("loan_id", "points_score")


@query("sink_points_csv", with_(CARD_WOE, POINTS, select="SELECT feature, coalesce(category, printf('(%.2f, %.2f]', lower, upper)) "
       "AS bin, goods, bads, woe, scorecard_points FROM points"))  # fmt: skip
def sink_points_csv(spark, sf_dir):
    _, model = weighed_loans(spark, sf_dir, [])
    path = fresh_path(spark, "points")
    table = cards.points(model.bins, CARD).select("feature", "bin", "goods", "bads", "woe", "scorecard_points")
    files.write_points(table, path)
    return spark.read.schema(table.schema).csv(path, header=True)


