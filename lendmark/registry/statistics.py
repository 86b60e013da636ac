"""Imputation, collinearity, binning and weight of evidence."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import functions as F

from lendmark.functions.state import local_frame
from lendmark.operators import collinearity, impute, woe
from lendmark.operators.quantiles import quantile_edges
from lendmark.registry.base import (
    CATEGORICAL,
    LOANS,
    MODEL_LOANS,
    NUMERIC,
    VIF_FEATURES,
    fitted,
    held,
    long_sql,
    model_loans,
    out,
    probs_sql,
    query,
    rounded,
    weighed_sql,
    with_,
    woe_sql,
)
from lendmark.sources.tables import loan_view, table

# ------------------------------------------------------------------ imputers

MEDIAN_COLUMNS = ["dti", "revol_util", "annual_inc", "installment", "loan_amnt", "open_acc", "mort_acc"]
MODE_COLUMNS = ["emp_length", "home_ownership", "purpose", "verification_status"]
MEDIANS = " UNION ALL ".join(f"SELECT '{c}' AS feature, median({c}) AS value FROM loans" for c in MEDIAN_COLUMNS)
MODES = " UNION ALL ".join(
    f"(SELECT '{c}' AS feature, {c} AS value FROM loans WHERE {c} IS NOT NULL GROUP BY {c} "
    f"ORDER BY count(*) DESC, {c} LIMIT 1)"
    for c in MODE_COLUMNS
)


@query("median_imputer", with_(LOANS, select=out("feature", "value", f"({MEDIANS})")))
def median_imputer(spark, sf_dir):
    with held(loan_view(spark, sf_dir).select(*MEDIAN_COLUMNS)) as loans:
        medians = impute.fit_medians(loans, MEDIAN_COLUMNS)
    return rounded(local_frame(spark, list(medians.items()), "feature string, value double"))


@query("mode_imputer", with_(LOANS, select=f"SELECT feature, value FROM ({MODES})"))
def mode_imputer(spark, sf_dir):
    modes = impute.fit_modes(loan_view(spark, sf_dir), MODE_COLUMNS)
    return local_frame(spark, list(modes.items()), "feature string, value string")


@query("impute_apply", with_(LOANS, select=out("loan_id emp_length", "mort_acc dti",
       "(SELECT loan_id, coalesce(emp_length, (SELECT emp_length FROM loans WHERE emp_length IS NOT NULL GROUP BY 1 "
       "ORDER BY count(*) DESC, 1 LIMIT 1)) AS emp_length, "
       "coalesce(mort_acc, (SELECT median(mort_acc) FROM loans)) AS mort_acc, dti FROM loans)")))  # fmt: skip
def impute_apply(spark, sf_dir):
    loans = loan_view(spark, sf_dir)
    with held(loans.select("mort_acc", "dti", "emp_length")) as rows:
        state = impute.fit_imputers(rows, ["mort_acc", "dti", "not_a_column"], ["emp_length"])
    return rounded(impute.impute(loans, state).select("loan_id", "emp_length", "mort_acc", "dti"))


# -------------------------------------------------------------- collinearity


def inverse_sql(features: Sequence[str]) -> str:
    """CTE ``inverse(i, j, v)``: inverse correlation matrix by sweeping one feature after the other."""
    pairs = ", ".join(
        f"corr({a}, {b}) AS c{i}_{j}" for i, a in enumerate(features) for j, b in enumerate(features) if i < j
    )
    cells = " UNION ALL ".join(
        f"SELECT {i} AS i, {j} AS j, " + ("1.0::DOUBLE" if i == j else f"c{min(i, j)}_{max(i, j)}") + " AS v FROM pairs"
        for i in range(len(features))
        for j in range(len(features))
    )
    complete = " AND ".join(f"{f} IS NOT NULL" for f in features)
    text = f"pairs AS MATERIALIZED (SELECT {pairs} FROM base WHERE {complete}),\nq0 AS MATERIALIZED ({cells})"
    for k in range(len(features)):
        text += f""",
q{k + 1} AS MATERIALIZED (
  SELECT a.i, a.j, CASE WHEN a.i = {k} AND a.j = {k} THEN 1 / p.v
                        WHEN a.i = {k} THEN a.v / p.v
                        WHEN a.j = {k} THEN -a.v / p.v
                        ELSE a.v - c.v * r.v / p.v END AS v
  FROM q{k} a JOIN q{k} c ON c.i = a.i AND c.j = {k} JOIN q{k} r ON r.i = {k} AND r.j = a.j
  JOIN q{k} p ON p.i = {k} AND p.j = {k})"""
    return text + f",\ninverse AS (SELECT * FROM q{len(features)})"


def named_sql(features: Sequence[str]) -> str:
    return "list_extract([" + ", ".join(f"'{f}'" for f in features) + "], i + 1)"


VIFS = with_(MODEL_LOANS, inverse_sql(VIF_FEATURES),
             select=f"SELECT {named_sql(VIF_FEATURES)} AS feature, round(v, 2) AS vif FROM inverse WHERE i = j")


@query("vif_table", VIFS)
def vif_table(spark, sf_dir):
    with held(model_loans(spark, sf_dir).select(*VIF_FEATURES)) as loans:
        return collinearity.vif(loans, VIF_FEATURES)


@query("vif_oneshot", f"SELECT * FROM ({VIFS}) WHERE vif < 10.0")
def vif_oneshot(spark, sf_dir):
    with held(model_loans(spark, sf_dir).select(*VIF_FEATURES)) as loans:
        return collinearity.vif_oneshot(loans, VIF_FEATURES)


def screen_sql(features: Sequence[str], threshold: float = 10.0) -> str:
    """CTEs ``e<n>(i, j, v)``, the last one of the kept features: greedy elimination on the inverse.

    Removing a feature is one Schur complement.
    """
    text = inverse_sql(features) + ",\ne0 AS MATERIALIZED (SELECT * FROM inverse)"
    rounds = len(features) - 2
    for k in range(rounds):
        text += f""",
w{k} AS MATERIALIZED (
  SELECT i AS worst, round(v, 2) AS vif FROM e{k}
  WHERE i = j AND round(v, 2) >= {threshold} AND (SELECT count(*) FROM e{k} WHERE i = j) > 2
  ORDER BY round(v, 2) DESC, i LIMIT 1),
e{k + 1} AS MATERIALIZED (
  SELECT a.i, a.j, CASE WHEN p.v IS NULL THEN a.v ELSE a.v - c.v * r.v / p.v END AS v
  FROM e{k} a LEFT JOIN w{k} ON true
  LEFT JOIN e{k} c ON c.i = a.i AND c.j = worst LEFT JOIN e{k} r ON r.i = worst AND r.j = a.j
  LEFT JOIN e{k} p ON p.i = worst AND p.j = worst
  WHERE worst IS NULL OR (a.i <> worst AND a.j <> worst))"""
    return text


def vif_filter_sql(features: Sequence[str]) -> str:
    rounds, name = len(features) - 2, named_sql(features)
    steps = [f"SELECT {name} AS feature, round(v, 2) AS vif, 'kept' AS decision, 0 AS step FROM e{rounds} WHERE i = j"]
    steps += [
        f"SELECT {name} AS feature, vif, 'dropped' AS decision, {k + 1} AS step FROM (SELECT worst AS i, vif FROM w{k})"
        for k in range(rounds)
    ]
    return with_(MODEL_LOANS, screen_sql(features), select=" UNION ALL ".join(steps))


@query("vif_filter", vif_filter_sql(VIF_FEATURES))
def vif_filter(spark, sf_dir):
    with held(model_loans(spark, sf_dir).select(*VIF_FEATURES)) as loans:
        return collinearity.vif_filter(loans, VIF_FEATURES).frame(spark)


@query("condition_number", with_(MODEL_LOANS, select=out("features band", "kappa",
       "(SELECT 2 AS features, k AS kappa, CASE WHEN k < 100 THEN 'well-conditioned' WHEN k <= 1000 THEN 'moderate' "
       "ELSE 'severe' END AS band FROM (SELECT (1 + abs(corr(open_acc, total_acc))) / (1 - abs(corr(open_acc, total_acc))) "
       "AS k FROM base))")))  # fmt: skip
def condition_number(spark, sf_dir):
    with held(model_loans(spark, sf_dir).select("open_acc", "total_acc")) as loans:
        return rounded(collinearity.condition_number(loans, ["open_acc", "total_acc"]))


# ------------------------------------------------------------------- binning



@query("quantile_edges", with_(MODEL_LOANS, long_sql(NUMERIC), f"""raw_edges AS (
  SELECT feature, list_sort(list_distinct(quantile_cont(value, {probs_sql(5)}))) AS e FROM long GROUP BY feature),
edges AS (SELECT feature, CASE WHEN len(e) < 3 THEN [NULL, NULL] ELSE [NULL::DOUBLE] || e[2:len(e) - 1] || [NULL::DOUBLE] END AS e
  FROM raw_edges),
numbered AS (SELECT feature, e, unnest(range(len(e) - 1)) AS n FROM edges)""",
       select=out("feature edge_id", "lower upper",
                  "(SELECT feature, n::INT AS edge_id, e[n + 1] AS lower, e[n + 2] AS upper FROM numbered)")))
def quantile_edges_query(spark, sf_dir):
    with held(model_loans(spark, sf_dir).select(*NUMERIC)) as loans:
        edges = quantile_edges(loans, NUMERIC)
        return rounded(woe.edges_frame(loans, edges))


def finite(column: str) -> str:
    return f"CASE WHEN isfinite({column}) THEN {column} END"


BIN_TABLE = "(SELECT feature, bin AS bin_id, {lower} AS lower, {upper} AS upper, category, total, goods, bads, pct_goods, " \
            "pct_bads, woe, iv_contrib FROM woe)".format(lower=finite("lower"), upper=finite("upper"))  # fmt: skip
NUMERIC_KEYS, WEIGHTS = "feature bin_id total goods bads", "lower upper pct_goods pct_bads woe iv_contrib"


def _finite(bins):
    infinite = F.lit(float("inf"))
    return bins.withColumns({c: F.when(F.abs(F.col(c)) != infinite, F.col(c)) for c in ("lower", "upper")})


@query("monotone_bins", with_(MODEL_LOANS, woe_sql(NUMERIC), select=out("feature bin_id total goods bads",
       "lower upper bad_rate", f"(SELECT *, bads / total AS bad_rate FROM {BIN_TABLE})")))
def monotone_bins(spark, sf_dir):
    model = fitted(model_loans(spark, sf_dir), NUMERIC)
    return rounded(
        _finite(model.bins).select(
            "feature", "bin_id", "total", "goods", "bads", "lower", "upper", (F.col("bads") / F.col("total")).alias("bad_rate")
        )
    )


@query("woe_table_numeric", with_(MODEL_LOANS, woe_sql(NUMERIC, monotone=False),
       select=out(NUMERIC_KEYS, WEIGHTS, BIN_TABLE)))
def woe_table_numeric(spark, sf_dir):
    model = fitted(model_loans(spark, sf_dir), NUMERIC, monotone=False)
    return rounded(_finite(model.bins).select(*NUMERIC_KEYS.split(), *WEIGHTS.split()))


CATEGORY_KEYS, CATEGORY_WEIGHTS = "feature category total goods bads", "pct_goods pct_bads woe iv_contrib"


@query("woe_table_categorical", with_(MODEL_LOANS, woe_sql([], CATEGORICAL), select=out(CATEGORY_KEYS, CATEGORY_WEIGHTS, "woe")))
def woe_table_categorical(spark, sf_dir):
    model = fitted(model_loans(spark, sf_dir), CATEGORICAL)
    return rounded(model.bins.select(*CATEGORY_KEYS.split(), *CATEGORY_WEIGHTS.split()))


ALL_WOE = MODEL_LOANS + ",\n" + woe_sql(NUMERIC, CATEGORICAL)
IVS = "(SELECT feature, sum(iv_contrib) AS information_value FROM woe GROUP BY feature)"
RATING = (
    "CASE WHEN information_value < 0.02 THEN 'Unpredictive (<0.02) - DROP' WHEN information_value < 0.10 "
    "THEN 'Weak (0.02-0.10)' WHEN information_value <= 0.30 THEN 'Medium / Strong (0.10-0.30) - PRIME' "
    "WHEN information_value <= 0.50 THEN 'Very Strong (0.30-0.50)' ELSE 'Suspiciously High (>0.50) - LEAKAGE CHECK' END"
)


def all_bins(spark, sf_dir):
    return fitted(model_loans(spark, sf_dir), [*NUMERIC, *CATEGORICAL]).bins


@query("information_value", with_(ALL_WOE, select=out("feature", "information_value", IVS)))
def information_value(spark, sf_dir):
    return rounded(woe.information_value(all_bins(spark, sf_dir)))


@query("iv_rating", with_(ALL_WOE, select=f"SELECT feature, round(information_value, 4) AS information_value, "
       f"{RATING} AS strength_rating FROM {IVS}"))  # fmt: skip
def iv_rating_query(spark, sf_dir):
    return woe.iv_summary(all_bins(spark, sf_dir))


@query("iv_screen", with_(ALL_WOE, select=f"SELECT feature, round(information_value, 4) AS information_value, "
       f"{RATING} AS strength_rating FROM {IVS} WHERE round(information_value, 4) >= 0.02"))  # fmt: skip
def iv_screen(spark, sf_dir):
    return woe.iv_screen(woe.iv_summary(all_bins(spark, sf_dir)))


ALL_WEIGHED = ALL_WOE + ",\n" + weighed_sql(NUMERIC, CATEGORICAL)
WOE_COLUMNS = " ".join(f + "_woe" for f in [*NUMERIC, *CATEGORICAL])


@query("woe_transform", with_(ALL_WEIGHED, select=out("loan_id target", WOE_COLUMNS, "weighed")))
def woe_transform(spark, sf_dir):
    loans = model_loans(spark, sf_dir)
    model = fitted(loans, [*NUMERIC, *CATEGORICAL])
    return rounded(woe.apply_woe(loans, model).select("loan_id", "target", *WOE_COLUMNS.split()))


# Bins are learned on the first years and looked up for the later ones.
TRAINED = MODEL_LOANS.replace("\nbase AS (", "\neverything AS (") + ",\nbase AS (SELECT * FROM everything WHERE issue_year <= 1997)"


@query("woe_lookup_join", with_(TRAINED, woe_sql(["dti"], ["emp_length"]), """later AS (
  SELECT * FROM everything WHERE issue_year > 1997)""",
       select=out("loan_id", "dti_woe emp_length_woe", """(
  SELECT loan_id, coalesce(d.woe, 0.0) AS dti_woe, coalesce(c.woe, 0.0) AS emp_length_woe FROM later
  LEFT JOIN woe d ON d.feature = 'dti' AND dti > d.lower AND dti <= d.upper
  LEFT JOIN woe c ON c.feature = 'emp_length' AND c.category = coalesce(emp_length, 'nan'))""")))  # fmt: skip
def woe_lookup_join(spark, sf_dir):
    loans = model_loans(spark, sf_dir)
    model = fitted(loans.filter(F.col("issue_year") <= 1997), ["dti", "emp_length"])
    later = loans.filter(F.col("issue_year") > 1997)
    return rounded(woe.apply_woe(later, model).select("loan_id", "dti_woe", "emp_length_woe"))


SHARE_WOE = """(SELECT feature, bin::INT AS bin_id, goods, bads, g AS pct_goods, b AS pct_bads, ln(g / b) AS woe,
  (g - b) * ln(g / b) AS iv_contrib FROM (
  SELECT *, greatest(goods::DOUBLE / all_goods, 1e-6::DOUBLE) AS g, greatest(bads::DOUBLE / all_bads, 1e-6::DOUBLE) AS b
  FROM merged CROSS JOIN tot))"""


@query("woe_table_pctclip", with_(MODEL_LOANS, woe_sql(NUMERIC, monotone=False),
       select=out("feature bin_id goods bads", CATEGORY_WEIGHTS, SHARE_WOE)))
def woe_table_pctclip(spark, sf_dir):
    model = fitted(model_loans(spark, sf_dir), NUMERIC, smoothing="share", monotone=False)
    return rounded(model.bins.select("feature", "bin_id", "goods", "bads", *CATEGORY_WEIGHTS.split()))


# A second target on other tables: low quality of labelled documents.
DOCUMENTS = """base AS (
  SELECT d.doc_id AS loan_id, n_chars, lang, source, 1 - quality AS target FROM documents d JOIN labels l USING (doc_id))"""


@query("woe_documents", with_(DOCUMENTS, woe_sql(["n_chars"], ["lang", "source"]),
       select=out("feature bin_id category total goods bads", WEIGHTS, BIN_TABLE)))
def woe_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars", "lang", "source")
    labelled = docs.join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id")
    rows = labelled.withColumn("target", 1 - F.col("quality"))
    bins = fitted(rows, ["n_chars", "lang", "source"]).bins
    return rounded(_finite(bins).select("feature", "bin_id", "category", "total", "goods", "bads", *WEIGHTS.split()))


