import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lendmark.functions import expr
from lendmark.operators import collinearity, explain, impute, quality
from lendmark.operators.card import Card
from lendmark.plans import layers
from lendmark.sources import files
from lendmark.sources.schema import LOAN_COLUMNS, RAW_LOAN_SCHEMA


def values(df, column):
    return [r[0] for r in df.select(column).collect()]


def test_text_parsing(spark):
    df = spark.createDataFrame([(" 13.5%", "Dec-2015"), ("n/a", "2015"), (None, None), ("NaN", "x-y")], "p string, d string")
    assert values(df, expr.pct_to_double(F.col("p"))) == [13.5, None, None, None]
    assert values(df, expr.issue_year(F.col("d"))) == [2015, 2015, 0, 0]


def test_policies_differ_on_late_and_policy_statuses(spark):
    statuses = ["Fully Paid", "Charged Off", "Late (31-120 days)", "Does not meet the credit policy. Status:Charged Off", "Current"]
    df = spark.createDataFrame([(s,) for s in statuses], "loan_status string")
    kept = {p: layers.with_target(layers.resolved(df, p), p).agg(F.count("*"), F.sum("target")).first() for p in expr.POLICIES}
    assert {p: tuple(r) for p, r in kept.items()} == {"package": (3, 2), "curated": (3, 2), "basic": (2, 1)}


def test_ratios(spark):
    df = spark.createDataFrame([(100.0, 12000.0), (5000.0, 6.0), (10.0, None), (10.0, 0.0)], "i double, a double")
    assert values(df, expr.installment_to_income(F.col("i"), F.col("a"))) == [10.0, 100.0, None, 100.0]
    assert values(df, expr.installment_to_income(F.col("i"), F.col("a"), "fraction")) == [0.1, 10000.0, None, None]
    assert values(df, expr.clip(F.col("a"), 1, 100)) == [100.0, 6.0, None, 1.0]
    payment = values(df.limit(1), expr.annuity(F.lit(10000.0), F.lit(0.01), F.lit(36)))[0]
    assert payment == pytest.approx(332.14)


def test_bins_are_right_closed(spark):
    df = spark.createDataFrame([(1.0,), (1.5,), (2.0,), (9.0,), (None,), (float("nan"),)], "x double")
    assert values(df, expr.bin_index("x", [-math.inf, 1.0, 2.0, math.inf])) == [0, 1, 1, 2, None, None]
    assert values(df, expr.bin_index("x", [1.0, 1.5, 2.0])) == [None, 0, 1, None, None, None]


def test_staging_and_gold_from_text(spark):
    raw = {c: None for c in RAW_LOAN_SCHEMA.fieldNames()}
    loan = raw | {"id": "7", "loan_status": "Charged Off", "issue_d": "Dec-2015", "int_rate": "13.5%", "annual_inc": "60000",
                  "dti": "120", "fico_range_low": "700", "fico_range_high": "704", "installment": "500", "revol_util": "150%"}
    bad_key = loan | {"id": "x"}
    poor = loan | {"id": "8", "annual_inc": "0"}
    df = spark.createDataFrame([tuple(r.values()) for r in (loan, bad_key, poor)], RAW_LOAN_SCHEMA)
    staged = layers.staging(df)
    assert staged.columns == [*LOAN_COLUMNS, "issue_year", "target"] and staged.count() == 2
    gold = layers.gold(layers.silver(staged)).collect()
    assert len(gold) == 1
    row = gold[0]
    assert (row["fico_mid"], row["dti"], row["installment_to_inc"], row["revol_util"]) == (702.0, 100.0, 0.1, 100.0)
    assert (row["target"], row["issue_year"], row["emp_length"], row["has_delinq"]) == (1, 2015, "Unknown", 0)


def test_csv_scan_keeps_and_renames(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text("id,extra,loan_status\n1,zzz,Current\n2,yyy,Default\n")
    df = files.scan_csv(spark, str(path), "id long, extra string, loan_status string", ["id", "loan_status"])
    assert df.columns == ["loan_id", "loan_status"] and df.count() == 2


def test_imputation(spark):
    df = spark.createDataFrame([(1.0, "b", None), (None, "a", None), (4.0, "a", None), (float("nan"), "b", None)],
                               "x double, c string, e string")
    state = impute.fit_imputers(df, ["x", "absent"], ["c", "e", "absent"])
    assert state.medians == {"x": 2.5} and state.modes == {"c": "a", "e": "MISSING"}
    assert [tuple(r) for r in impute.impute(df, state).collect()] == [
        (1.0, "b", "MISSING"), (2.5, "a", "MISSING"), (4.0, "a", "MISSING"), (2.5, "b", "MISSING")]


def test_inflation_matches_auxiliary_regressions(spark):
    rng = np.random.default_rng(2)
    a, b = rng.normal(size=400), rng.normal(size=400)
    pdf = pd.DataFrame({"a": a, "b": b, "c": a + b + 0.1 * rng.normal(size=400)})
    got = {r["feature"]: r["vif"] for r in collinearity.vif(spark.createDataFrame(pdf), list("abc")).collect()}
    for f in "abc":
        x = np.column_stack([np.ones(400), pdf.drop(columns=f)])
        residual = pdf[f] - x @ np.linalg.lstsq(x, pdf[f], rcond=None)[0]
        assert got[f] == pytest.approx(round(pdf[f].var(ddof=0) / residual.var(ddof=0), 2), abs=0.01)


def test_filter_drops_until_below_and_rereads_after_gaps(spark):
    rng = np.random.default_rng(4)
    a, b, c = rng.normal(size=(3, 500))
    pdf = pd.DataFrame({"a": a, "b": b, "twin": a + 0.01 * rng.normal(size=500), "c": c})
    df = spark.createDataFrame(pdf).withColumn("twin", F.when(F.rand(3) > 0.3, F.col("twin")))
    screen = collinearity.vif_filter(df, ["a", "b", "twin", "c"])
    assert len(screen.kept) == 3 and {"b", "c"} <= set(screen.kept)
    exact = spark.createDataFrame(pd.DataFrame({"a": a, "copy": a, "b": b}))
    assert collinearity.vif(exact, ["a", "copy", "b"]).filter("vif = double('inf')").count() == 2
    assert collinearity.vif_filter(exact, ["a", "copy"]).kept == ["a", "copy"]
    assert collinearity.condition_number(exact, ["a", "b"]).first()["band"] == "well-conditioned"


def test_data_tests_count_failures(spark):
    df = spark.createDataFrame([(1, 0), (1, 2), (None, None)], "loan_id int, target int")
    rules = [quality.Rule("loan_id", "unique"), quality.Rule("loan_id", "not_null"), quality.Rule("target", "accepted_values", (0, 1))]
    got = {r["rule"]: (r["failures"], r["passed"]) for r in quality.dq_report({"t": (df, rules)}).collect()}
    assert got == {"unique": (1, False), "not_null": (1, False), "accepted_values": (1, False)}


CARD = Card(-1.0, {"dti_woe": -0.5, "home_ownership_woe": -0.8, "fico_mid_woe": -0.2, "open_acc_woe": -0.9, "purpose_woe": -0.1})


def test_attributions_add_up_and_reasons_are_ranked(spark):
    rng = np.random.default_rng(6)
    pdf = pd.DataFrame(rng.normal(size=(50, 5)), columns=list(CARD.coefs))
    pdf["loan_id"], pdf["target"], pdf["score"], pdf["pd"] = range(50), 1, 500, 0.4
    df = spark.createDataFrame(pdf)
    means = explain.woe_means(df, CARD)
    rows = explain.attributions(df, CARD, means).select("*", CARD.logit().alias("logit"))
    base = CARD.intercept + sum(b * means[c] for c, b in CARD.coefs.items())
    total = sum((F.col(f"phi_{f}") for f in CARD.features), F.lit(0.0))
    assert rows.agg(F.max(F.abs(total - (F.col("logit") - base)))).first()[0] < 1e-12
    notice = explain.notices(df, CARD, means).orderBy("application_id").first()
    impacts = {f: CARD.coefs[f + "_woe"] * (pdf[f + "_woe"][0] - means[f + "_woe"]) for f in CARD.features}
    ranked = sorted(impacts, key=impacts.get, reverse=True)[:4]
    reasons = notice["top_adverse_action_reasons"]
    assert [r["feature_name"] for r in reasons] == ranked
    codes = {"dti": "RC01", "fico_mid": "RC03", "open_acc": "RC07"}
    assert [r["reason_code"] for r in reasons] == [codes.get(f, "RC99") for f in ranked]
    assert notice["decision_threshold_tau_star"] == 0.0291
    assert explain.notices(df.drop("loan_id"), CARD, means).first()["application_id"] == 999999
    long = explain.attribution_long(df, CARD, means).filter("loan_id = 0").orderBy("position").collect()
    assert [r["phi"] for r in long] == sorted(r["phi"] for r in long)


def test_notices_survive_a_json_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, 0.1, 500, 0.5, *[0.3] * 5)], "loan_id int, x double, score int, pd double, "
                               + ", ".join(f"{c} double" for c in CARD.coefs))
    letters = explain.notices(df, CARD, explain.woe_means(df, CARD))
    files.write_notices(letters, str(tmp_path / "n"))
    back = spark.read.schema(letters.schema).json(str(tmp_path / "n"))
    assert back.collect() == letters.collect()
