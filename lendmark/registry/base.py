"""Registration of queries with their SQL counterparts, and shared inputs of both."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendmark.functions.expr import POLICIES
from lendmark.functions.state import kept
from lendmark.operators.card import Card, scored
from lendmark.operators.woe import WoeModel, apply_woe, fit_woe
from lendmark.plans.layers import derive, preprocess
from lendmark.session import scratch_dir
from lendmark.sources.tables import EPOCHS, loan_view

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


# ------------------------------------------------------------ Spark inputs

FIRST_YEAR = 1995
NUMERIC = ["dti", "revol_util", "fico_mid", "annual_inc", "loan_amnt", "open_acc", "inq_last_6mths", "delinq_2yrs"]
CATEGORICAL = ["home_ownership", "purpose", "emp_length"]
VIF_FEATURES = ["fico_mid", "dti", "revol_util", "annual_inc", "installment", "loan_amnt", "open_acc", "total_acc",
                "inq_last_6mths", "delinq_2yrs"]

# A card with given coefficients, for checking everything downstream of a fit.
CARD_FEATURES = ["dti", "revol_util", "fico_mid", "open_acc", "delinq_2yrs", "home_ownership"]
CARD = Card(
    intercept=-3.3,
    coefs={
        "dti_woe": -0.71,
        "revol_util_woe": -0.83,
        "fico_mid_woe": -0.64,
        "open_acc_woe": -0.92,
        "delinq_2yrs_woe": -0.57,
        "home_ownership_woe": -0.48,
    },
)


@contextmanager
def held(df: DataFrame) -> Iterator[DataFrame]:
    """Keep a derived input while a fit reads it several times."""
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()


def model_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Resolved loans with target, year and modelling ratios."""
    return derive(preprocess(loan_view(spark, sf_dir), "package", FIRST_YEAR))


def fitted(loans: DataFrame, features: Sequence[str], **options) -> WoeModel:
    with held(loans.select(*features, "target")) as rows:
        return fit_woe(rows, features, **options)


def weighed_loans(spark: SparkSession, sf_dir: str, columns: Sequence[str] | None = None) -> tuple[DataFrame, WoeModel]:
    """Loans with the weights of their bins. With ``columns`` only these and the card's features are read, and
    written once for the fit and all that follows; otherwise all columns come, from the tables each time."""
    loans = model_loans(spark, sf_dir)
    if columns is None:
        model = fitted(loans, CARD_FEATURES)
    else:
        loans = kept(loans.select(*dict.fromkeys([*CARD_FEATURES, "target", *columns])), "loans")
        model = fit_woe(loans, CARD_FEATURES)
    return apply_woe(loans, model), model


def scored_loans(spark: SparkSession, sf_dir: str, columns: Sequence[str] | None = None) -> DataFrame:
    rows, _ = weighed_loans(spark, sf_dir, columns)
    return scored(rows, CARD)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, since engines add in different orders; never a negative zero."""
    return df.select(
        *(
            (F.round(c, digits) + F.lit(0.0)).alias(c) if t in ("double", "float") else F.col(c)
            for c, t in df.dtypes
        )
    )


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"


# -------------------------------------------------------------- SQL inputs


def names(text: str) -> list[str]:
    return text.split()


def out(keys: str, doubles: str, source: str) -> str:
    """SELECT list of plain and of rounded columns."""
    columns = names(keys) + [f"0.0::DOUBLE + round(CAST({c} AS DOUBLE), 6) AS {c}" for c in names(doubles)]
    return f"SELECT {', '.join(columns)}\nFROM {source}"


def with_(*parts: str, select: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n" + select


def sql_list(values: Sequence[str]) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


LOANS = """lines AS (
  SELECT l_orderkey, CAST(count(*) AS DOUBLE) AS n_lines, CAST(count(DISTINCT l_suppkey) AS DOUBLE) AS n_suppliers,
         sum(l_extendedprice) AS price, avg(l_tax) AS tax, avg(l_discount) AS discount, avg(l_quantity) AS quantity,
         CAST(count(*) FILTER (WHERE l_returnflag = 'N') AS DOUBLE) AS n_new,
         CAST(count(*) FILTER (WHERE l_returnflag = 'R') AS DOUBLE) AS n_returned,
         CAST(count(*) FILTER (WHERE l_linestatus = 'F') AS DOUBLE) AS n_filled
  FROM lineitem GROUP BY l_orderkey),
rated AS (
  SELECT *, round(5 + 100 * tax, 6) AS int_rate, (round(5 + 100 * tax, 6) - 5) / 1.2 AS grade_pos,
         CASE WHEN o_orderkey % 4 = 0 THEN 60 ELSE 36 END AS months
  FROM lines JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey),
loans AS (
  SELECT o_orderkey AS loan_id, o_totalprice AS loan_amnt, o_totalprice AS funded_amnt,
         CAST(months AS VARCHAR) || ' months' AS term, int_rate,
         round(o_totalprice * ((int_rate / 1200) * pow(1 + int_rate / 1200, months))
               / nullif(pow(1 + int_rate / 1200, months) - 1, 0), 2) AS installment,
         substr('ABCDEFG', CAST(floor(grade_pos) AS INT) + 1, 1) AS grade,
         substr('ABCDEFG', CAST(floor(grade_pos) AS INT) + 1, 1)
           || CAST(CAST(floor((grade_pos - floor(grade_pos)) * 5) AS INT) + 1 AS VARCHAR) AS sub_grade,
         CASE WHEN o_orderkey % 20 <> 0 THEN o_orderpriority END AS emp_length,
         c_mktsegment AS home_ownership, c_acctbal * 12 AS annual_inc,
         CASE o_orderkey % 3 WHEN 0 THEN 'Verified' WHEN 1 THEN 'Source Verified' ELSE 'Not Verified' END
           AS verification_status,
         strftime(o_orderdate, '%b-%Y') AS issue_d,
         CASE WHEN o_orderstatus = 'P' THEN 'Current' WHEN n_returned / n_lines >= 0.5 THEN 'Charged Off'
              ELSE 'Fully Paid' END AS loan_status,
         o_orderpriority AS purpose, round(price / 5000, 6) AS dti, n_filled AS delinq_2yrs,
         620 + floor(quantity) * 5 AS fico_range_low, 624 + floor(quantity) * 5 AS fico_range_high,
         n_new AS inq_last_6mths, n_lines AS open_acc, n_lines - n_suppliers AS pub_rec,
         round(price, 2) AS revol_bal, round(1200 * discount, 6) AS revol_util, n_lines + n_suppliers AS total_acc,
         CASE WHEN o_orderkey % 10 <> 0 THEN CAST(o_orderkey % 3 AS DOUBLE) END AS mort_acc,
         CASE WHEN n_returned >= 3 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS pub_rec_bankruptcies
  FROM rated)"""

YEAR = "CAST(split_part(issue_d, '-', 2) AS INT)"


def target_sql(policy: str) -> str:
    return f"CASE WHEN loan_status IN ({sql_list(POLICIES[policy].bad)}) THEN 1 ELSE 0 END"


def resolved_sql(policy: str) -> str:
    return f"loan_status IN ({sql_list(POLICIES[policy].resolved)})"


# model_loans(): imputation is left out, ratios as in plans.layers.derive
MODEL_LOANS = (
    LOANS
    + f""",
base AS (
  SELECT * EXCLUDE (revol_util), {target_sql('package')} AS target, {YEAR} AS issue_year,
         (fico_range_low + fico_range_high) / 2.0 AS fico_mid,
         least(greatest(revol_util, 0.0), 100.0)::DOUBLE AS revol_util,
         least(greatest(installment / greatest(annual_inc / 12.0, 1.0) * 100.0, 0.0), 100.0)::DOUBLE
           AS installment_to_inc
  FROM loans
  WHERE {resolved_sql('package')} AND {YEAR} >= {FIRST_YEAR})"""
)


def probs_sql(n: int) -> str:
    return "[" + ", ".join(repr(i * (1.0 / n)) for i in range(n)) + ", 1.0]"


def long_sql(features: Sequence[str], name: str = "long", source: str = "base", value: str = "{f}") -> str:
    rows = " UNION ALL ".join(
        f"SELECT loan_id, target, '{f}' AS feature, {value.format(f=f)} AS value FROM {source}" for f in features
    )
    return f"{name} AS ({rows})"


def bins_sql(features: Sequence[str], n: int = 5, monotone: bool = True) -> str:
    """CTE ``merged(feature, bin, lower, upper, total, goods, bads)`` of numeric features."""
    text = long_sql(features) + f""",
raw_edges AS (SELECT feature, list_sort(list_distinct(quantile_cont(value, {probs_sql(n)}))) AS e FROM long GROUP BY feature),
edges AS (SELECT feature, CASE WHEN len(e) < 3 THEN []::DOUBLE[] ELSE e[2:len(e) - 1] END AS e FROM raw_edges),
placed AS (
  SELECT feature, e, target, CASE WHEN value IS NOT NULL THEN len(list_filter(e, lambda x: x < value)) END AS bin
  FROM long JOIN edges USING (feature)),
m0 AS (
  SELECT feature, bin, CASE WHEN bin = 0 THEN '-infinity'::DOUBLE ELSE any_value(e)[bin] END AS lower,
         CASE WHEN bin = len(any_value(e)) THEN 'infinity'::DOUBLE ELSE any_value(e)[bin + 1] END AS upper,
         count(target) AS total, count(*) FILTER (WHERE target = 0) AS goods,
         count(*) FILTER (WHERE target = 1) AS bads
  FROM placed WHERE bin IS NOT NULL GROUP BY feature, bin)"""
    rounds = n - 2 if monotone else 0
    for k in range(rounds):
        text += f""",
s{k} AS (
  SELECT *, lead(bads / total) OVER w - bads / total AS step, count(*) OVER (PARTITION BY feature) AS n_bins
  FROM m{k} WINDOW w AS (PARTITION BY feature ORDER BY bin)),
d{k} AS (
  SELECT feature, CASE WHEN max(n_bins) > 2 AND min(step) < -1e-4 AND max(step) > 1e-4
                       THEN arg_min(bin, abs(step)) END AS cut
  FROM s{k} GROUP BY feature),
m{k + 1} AS (
  SELECT feature, CASE WHEN bin > cut THEN bin - 1 ELSE bin END AS bin, min(lower) AS lower, max(upper) AS upper,
         sum(total)::BIGINT AS total, sum(goods)::BIGINT AS goods, sum(bads)::BIGINT AS bads
  FROM m{k} JOIN d{k} USING (feature) GROUP BY 1, 2)"""
    return text + f""",
merged AS (SELECT * FROM m{rounds})"""


WEIGH_COLUMNS = """greatest(goods, 0.5)::DOUBLE / all_goods AS pct_goods, greatest(bads, 0.5)::DOUBLE / all_bads AS pct_bads,
  ln((greatest(goods, 0.5)::DOUBLE / all_goods) / (greatest(bads, 0.5)::DOUBLE / all_bads)) AS woe,
  (greatest(goods, 0.5)::DOUBLE / all_goods - greatest(bads, 0.5)::DOUBLE / all_bads)
    * ln((greatest(goods, 0.5)::DOUBLE / all_goods) / (greatest(bads, 0.5)::DOUBLE / all_bads)) AS iv_contrib"""

CLASS_TOTALS = """tot AS (SELECT count(*) FILTER (WHERE target = 0) AS all_goods, count(*) FILTER (WHERE target = 1) AS all_bads
  FROM base)"""


def woe_sql(numeric: Sequence[str], categorical: Sequence[str] = (), n: int = 5, monotone: bool = True) -> str:
    """CTE ``woe(feature, bin, lower, upper, category, total, goods, bads, pct..., woe, iv_contrib)``."""
    parts, sources = [CLASS_TOTALS], []
    if numeric:
        parts.append(bins_sql(numeric, n, monotone))
        sources.append(
            "SELECT feature, bin::INT AS bin, lower, upper, NULL::VARCHAR AS category, total, goods, bads FROM merged"
        )
    if categorical:
        parts.append(long_sql(categorical, "long_text", value="coalesce({f}, 'nan')"))
        sources.append(
            "SELECT feature, NULL::INT AS bin, NULL::DOUBLE AS lower, NULL::DOUBLE AS upper, value AS category, "
            "count(target) AS total, count(*) FILTER (WHERE target = 0) AS goods, "
            "count(*) FILTER (WHERE target = 1) AS bads "
            "FROM long_text GROUP BY feature, value"
        )
    parts.append(
        f"woe AS (SELECT feature, bin, lower, upper, category, total, goods, bads, {WEIGH_COLUMNS} "
        f"FROM ({' UNION ALL '.join(sources)}) CROSS JOIN tot)"
    )
    return ",\n".join(parts)


def weighed_sql(
    numeric: Sequence[str], categorical: Sequence[str] = (), source: str = "base", name: str = "weighed"
) -> str:
    """CTE ``weighed``: the source plus one ``<feature>_woe`` column per feature, weights from ``woe``."""
    parts = [long_sql(numeric, f"{name}_long", source)]
    hits = (
        f"SELECT loan_id, feature, woe FROM {name}_long JOIN woe USING (feature) WHERE value > lower AND value <= upper"
    )
    if categorical:
        parts.append(long_sql(categorical, f"{name}_text", source, value="coalesce({f}, 'nan')"))
        hits += (
            f" UNION ALL SELECT loan_id, t.feature, woe FROM {name}_text t JOIN woe w "
            "ON t.feature = w.feature AND t.value = w.category"
        )
    columns = ", ".join(
        f"coalesce(max(woe) FILTER (WHERE feature = '{f}'), 0.0::DOUBLE) AS {f}_woe" for f in [*numeric, *categorical]
    )
    parts.append(f"{name}_weights AS (SELECT loan_id, {columns} FROM ({hits}) GROUP BY loan_id)")
    parts.append(f"{name} AS (SELECT * FROM {source} JOIN {name}_weights USING (loan_id))")
    return ",\n".join(parts)


CARD_NUMERIC = [f for f in CARD_FEATURES if f != "home_ownership"]
LOGIT = " + ".join([repr(CARD.intercept), *(f"({b!r} * {c})" for c, b in CARD.coefs.items())])
SCORE_OF = "CAST(least(greatest(round_even({x}, 0), 300), 850) AS INT)"
FACTOR, OFFSET = repr(CARD.pdo.factor), repr(CARD.pdo.offset)

CARD_WOE = MODEL_LOANS + ",\n" + woe_sql(CARD_NUMERIC, ["home_ownership"])
WEIGHED = CARD_WOE + ",\n" + weighed_sql(CARD_NUMERIC, ["home_ownership"])


def scored_sql(source: str = "weighed", name: str = "scored") -> str:
    score = SCORE_OF.format(x=f"{OFFSET}::DOUBLE - {FACTOR}::DOUBLE * ({LOGIT})")
    return f"{name} AS (SELECT *, 1.0 / (1.0 + exp(-({LOGIT}))) AS pd, {score} AS score FROM {source})"


SCORED = WEIGHED + ",\n" + scored_sql()


def epoch_sql(year: str = "issue_year") -> str:
    cases = " ".join(f"WHEN {year} BETWEEN {a} AND {b} THEN '{name}'" for name, (a, b) in EPOCHS.items())
    return f"CASE {cases} END"
