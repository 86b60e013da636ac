"""Sources, sinks, expressions, layers and data tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendmark.functions.expr import annuity, clip, event_flag, fico_midpoint, installment_to_income, issue_year
from lendmark.functions.expr import pct_to_double
from lendmark.operators import quality
from lendmark.operators.quality import LAYER_RULES
from lendmark.plans import layers
from lendmark.registry.base import (
    FIRST_YEAR,
    LOANS,
    YEAR,
    epoch_sql,
    fresh_path,
    names,
    out,
    query,
    resolved_sql,
    rounded,
    target_sql,
    with_,
)
from lendmark.sources import files
from lendmark.sources.schema import LOAN_COLUMNS, LOAN_SCHEMA
from lendmark.sources.tables import EPOCHS, loan_view, raw_loan_text, table

DOUBLES = [f.name for f in LOAN_SCHEMA if f.dataType.simpleString() == "double"]
OTHERS = [c for c in LOAN_COLUMNS if c not in DOUBLES]
PACKAGE = LOANS + f""",
prepared AS (SELECT *, {target_sql('package')} AS target, {YEAR} AS issue_year FROM loans
  WHERE {resolved_sql('package')} AND {YEAR} >= {FIRST_YEAR})"""
STAGED = LOANS + f""",
staged AS (
  SELECT loan_id, loan_amnt, funded_amnt, term, int_rate, installment, grade, sub_grade,
         coalesce(emp_length, 'Unknown') AS emp_length, coalesce(home_ownership, 'OTHER') AS home_ownership,
         annual_inc, verification_status, issue_d, loan_status, purpose, dti, delinq_2yrs, fico_range_low,
         fico_range_high, inq_last_6mths, open_acc, pub_rec, revol_bal, revol_util, total_acc,
         coalesce(mort_acc, 0.0)::DOUBLE AS mort_acc, pub_rec_bankruptcies, {YEAR} AS issue_year,
         {target_sql('curated')} AS target
  FROM loans WHERE {resolved_sql('curated')})"""
GOLD = STAGED + """,
gold AS (
  SELECT loan_id, target, issue_year, issue_d, (fico_range_low + fico_range_high) / 2.0 AS fico_mid,
         least(dti, 100.0)::DOUBLE AS dti, loan_amnt, annual_inc, installment * 12.0 / annual_inc AS installment_to_inc,
         revol_bal, least(greatest(revol_util, 0.0), 100.0)::DOUBLE AS revol_util, inq_last_6mths, open_acc, total_acc,
         mort_acc, CASE WHEN delinq_2yrs > 0 THEN 1 ELSE 0 END AS has_delinq,
         CASE WHEN pub_rec > 0 THEN 1 ELSE 0 END AS has_pub_rec,
         CASE WHEN pub_rec_bankruptcies > 0 THEN 1 ELSE 0 END AS has_bankruptcy,
         home_ownership, purpose, emp_length, verification_status
  FROM staged WHERE annual_inc > 0 AND dti >= 0)"""
GOLD_KEYS = (
    "loan_id target issue_year issue_d has_delinq has_pub_rec has_bankruptcy home_ownership purpose emp_length "
    "verification_status"
)
GOLD_DOUBLES = (
    "fico_mid dti loan_amnt annual_inc installment_to_inc revol_bal revol_util inq_last_6mths open_acc total_acc mort_acc"
)


def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layers.preprocess(loan_view(spark, sf_dir), "package", FIRST_YEAR)


def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layers.staging(raw_loan_text(loan_view(spark, sf_dir)), "curated")


def gold_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layers.gold(staged(spark, sf_dir))


# ---------------------------------------------------------- sources and sinks


@query(
    "scan_parquet_epochs",
    with_(PACKAGE, select=f"SELECT {epoch_sql()} AS epoch, count(*) AS loans, sum(target)::BIGINT AS bads FROM prepared "
          "WHERE issue_year BETWEEN 1998 AND 2000 GROUP BY 1"),
)
def scan_parquet_epochs(spark, sf_dir):
    path = fresh_path(spark, "epochs")
    files.write_epochs(layers.with_epoch(prepared(spark, sf_dir), EPOCHS), path)
    picked = files.scan_epochs(spark, path, ["inference", "drift"])
    return picked.groupBy("epoch").agg(F.count("*").alias("loans"), F.sum("target").alias("bads"))


@query("scan_csv_loans", with_(LOANS, select=out(" ".join(OTHERS), " ".join(DOUBLES), "loans")))
def scan_csv_loans(spark, sf_dir):
    path = fresh_path(spark, "csv")
    raw = loan_view(spark, sf_dir).withColumnRenamed("loan_id", "id").withColumn("unused", F.lit("x"))
    raw.write.option("header", True).option("compression", "gzip").csv(path)
    loans = files.scan_csv(spark, path, raw.schema, ["id", *LOAN_COLUMNS], partitions=spark.sparkContext.defaultParallelism)
    return rounded(loans.select(*LOAN_COLUMNS))


@query("scan_table", with_(LOANS, select="SELECT loan_status, count(*) AS loans FROM loans GROUP BY loan_status"))
def scan_table(spark, sf_dir):
    files.materialize(loan_view(spark, sf_dir), "lendmark_loans", "view")
    return spark.table("lendmark_loans").groupBy("loan_status").agg(F.count("*").alias("loans"))


@query(
    "bronze_ingest",
    with_(PACKAGE, select=out("loan_id issue_year source_batch target loan_status stamped", "loan_amnt dti",
          "(SELECT *, 'batch_1' AS source_batch, true AS stamped FROM prepared)")),
)
def bronze_ingest(spark, sf_dir):
    path = fresh_path(spark, "bronze")
    layers.write_bronze(layers.bronze(prepared(spark, sf_dir), "batch_1"), path)
    stamped = F.col("bronze_ingest_time").isNotNull().alias("stamped")
    columns = ["loan_id", "issue_year", "source_batch", "target", "loan_status", stamped, "loan_amnt", "dti"]
    return rounded(spark.read.parquet(path).select(*columns))


@query("silver_newest_ingest", with_(PACKAGE, select=out("loan_id issue_year target", "annual_inc loan_amnt", """(
  SELECT loan_id, issue_year, target, loan_amnt, CASE WHEN issue_year >= 1998 THEN annual_inc - 5000 ELSE annual_inc END AS annual_inc
  FROM prepared)""")))  # fmt: skip
def silver_newest_ingest(spark, sf_dir):
    """A later batch corrects the incomes of the newer loans; the silver layer keeps what was ingested last."""
    path = fresh_path(spark, "bronze")
    loans = prepared(spark, sf_dir)
    corrected = loans.filter("issue_year >= 1998").withColumn("annual_inc", F.col("annual_inc") - 5000)
    for batch, rows in (("first", loans), ("second", corrected)):
        layers.append_bronze(layers.bronze(rows, batch), path)
    newest = layers.silver(layers.staging(layers.read_bronze(spark, path), "package"))
    return rounded(newest.select("loan_id", "issue_year", "target", "annual_inc", "loan_amnt"))


@query("bronze_schema_evolution", with_(PACKAGE, select=out("loan_id issue_year source_batch loan_status channel", "loan_amnt int_rate", """(
  SELECT loan_id, issue_year, 'first' AS source_batch, loan_status, NULL::VARCHAR AS channel, loan_amnt, NULL::DOUBLE AS int_rate
  FROM prepared WHERE issue_year < 1998
  UNION ALL SELECT loan_id, issue_year, 'second', loan_status, verification_status, loan_amnt, int_rate
  FROM prepared WHERE issue_year >= 1998)""")))  # fmt: skip
def bronze_schema_evolution(spark, sf_dir):
    """Two batches of different columns; the second is ingested twice, as after a failure."""
    path = fresh_path(spark, "bronze")
    loans = prepared(spark, sf_dir).select("loan_id", "issue_year", "loan_status", "loan_amnt", "int_rate", "verification_status")
    first = loans.filter("issue_year < 1998").drop("int_rate", "verification_status")
    second = loans.filter("issue_year >= 1998").withColumnRenamed("verification_status", "channel")
    for batch, rows in (("first", first), ("second", second), ("second", second)):
        layers.append_bronze(layers.bronze(rows, batch), path)
    columns = ["loan_id", "issue_year", "source_batch", "loan_status", "channel", "loan_amnt", "int_rate"]
    return rounded(layers.read_bronze(spark, path).select(*columns))


@query(
    "sink_epoch_parquet",
    with_(PACKAGE, select=out("epoch loan_id issue_year target grade loan_status", "loan_amnt dti",
          f"(SELECT *, {epoch_sql()} AS epoch FROM prepared)")),
)
def sink_epoch_parquet(spark, sf_dir):
    path = fresh_path(spark, "epochs")
    files.write_epochs(layers.with_epoch(prepared(spark, sf_dir), EPOCHS), path)
    columns = ["epoch", "loan_id", "issue_year", "target", "grade", "loan_status", "loan_amnt", "dti"]
    return rounded(files.scan_epochs(spark, path).select(*columns))


# ---------------------------------------------------------------- expressions


@query("typed_projection", with_(LOANS, select=out(" ".join(OTHERS), " ".join(DOUBLES), "loans")))
def typed_projection(spark, sf_dir):
    return rounded(layers.typed(raw_loan_text(loan_view(spark, sf_dir))))


@query("strip_percent", with_(LOANS, select=out("loan_id", "int_rate revol_util", "loans")))
def strip_percent(spark, sf_dir):
    raw = raw_loan_text(loan_view(spark, sf_dir))
    return rounded(
        raw.select(F.col("id").alias("loan_id"), *(pct_to_double(F.col(c)).alias(c) for c in ("int_rate", "revol_util")))
    )


@query("not_null_keys", with_(LOANS, select="SELECT loan_id, emp_length FROM loans WHERE emp_length IS NOT NULL "
       "AND mort_acc IS NOT NULL AND loan_status IS NOT NULL AND issue_d IS NOT NULL"))  # fmt: skip
def not_null_keys(spark, sf_dir):
    rows = layers.require(loan_view(spark, sf_dir), ["loan_id", "loan_status", "issue_d", "emp_length", "mort_acc"])
    return rows.select("loan_id", "emp_length")


@query("resolved_filter", with_(LOANS, select=" UNION ALL ".join(
    f"SELECT '{p}' AS policy, loan_status, count(*) AS loans FROM loans WHERE {resolved_sql(p)} GROUP BY loan_status"
    for p in ("package", "curated", "basic"))))
def resolved_filter(spark, sf_dir):
    per_status = loan_view(spark, sf_dir).groupBy("loan_status").agg(F.count("*").alias("loans"))
    parts = [layers.resolved(per_status, p).select(F.lit(p).alias("policy"), "loan_status", "loans")
             for p in ("package", "curated", "basic")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("target_flag", with_(LOANS, select=f"SELECT loan_id, loan_status, {target_sql('package')} AS target FROM loans"))
def target_flag(spark, sf_dir):
    return layers.with_target(loan_view(spark, sf_dir)).select("loan_id", "loan_status", "target")


@query("issue_year", with_(LOANS, select=f"SELECT loan_id, issue_d, {YEAR} AS issue_year FROM loans"))
def issue_year_query(spark, sf_dir):
    return loan_view(spark, sf_dir).select("loan_id", "issue_d", issue_year(F.col("issue_d")).alias("issue_year"))


@query("year_floor_filter", with_(LOANS, select=f"SELECT loan_id, {YEAR} AS issue_year FROM loans "
       f"WHERE {resolved_sql('package')} AND {YEAR} >= 1998"))  # fmt: skip
def year_floor_filter(spark, sf_dir):
    return layers.preprocess(loan_view(spark, sf_dir), "package", 1998).select("loan_id", "issue_year")


@query("coalesce_defaults", with_(LOANS, select=out("loan_id emp_length home_ownership", "mort_acc revol_util",
       "(SELECT loan_id, coalesce(emp_length, 'Unknown') AS emp_length, home_ownership, "
       "coalesce(mort_acc, 0.0)::DOUBLE AS mort_acc, revol_util FROM loans)")))  # fmt: skip
def coalesce_defaults(spark, sf_dir):
    rows = layers.with_defaults(loan_view(spark, sf_dir))
    return rounded(rows.select("loan_id", "emp_length", "home_ownership", "mort_acc", "revol_util"))


@query("gold_domain_filter", with_(LOANS, select=out("loan_id", "annual_inc dti", "loans WHERE annual_inc > 0 AND dti >= 0")))
def gold_domain_filter(spark, sf_dir):
    return rounded(layers.gold_domain(loan_view(spark, sf_dir)).select("loan_id", "annual_inc", "dti"))


@query("fico_midpoint", with_(LOANS, select=out("loan_id", "fico_mid fico_from_low",
       "(SELECT loan_id, (fico_range_low + fico_range_high) / 2.0 AS fico_mid, fico_range_low + 2 AS fico_from_low "
       "FROM loans)")))  # fmt: skip
def fico_midpoint_query(spark, sf_dir):
    low, high = F.col("fico_range_low"), F.col("fico_range_high")
    return rounded(
        loan_view(spark, sf_dir).select(
            "loan_id", fico_midpoint(low, high).alias("fico_mid"), fico_midpoint(low).alias("fico_from_low")
        )
    )


@query("installment_to_income", with_(LOANS, select=out("loan_id", "pti_percent pti_fraction",
       "(SELECT loan_id, least(greatest(installment / greatest(annual_inc / 12.0, 1.0) * 100.0, 0.0), 100.0) AS pti_percent, "
       "installment * 12.0 / nullif(annual_inc, 0) AS pti_fraction FROM loans)")))  # fmt: skip
def installment_to_income_query(spark, sf_dir):
    pay, income = F.col("installment"), F.col("annual_inc")
    return rounded(
        loan_view(spark, sf_dir).select(
            "loan_id",
            installment_to_income(pay, income, "percent").alias("pti_percent"),
            installment_to_income(pay, income, "fraction").alias("pti_fraction"),
        )
    )


@query("clip_ratio", with_(LOANS, select=out("loan_id", "dti revol_util mort_acc",
       "(SELECT loan_id, least(dti, 100.0) AS dti, least(greatest(revol_util, 0.0), 100.0) AS revol_util, "
       "CASE WHEN mort_acc IS NOT NULL THEN least(mort_acc, 1.0) END AS mort_acc FROM loans)")))  # fmt: skip
def clip_ratio(spark, sf_dir):
    return rounded(
        loan_view(spark, sf_dir).select(
            "loan_id",
            clip(F.col("dti"), high=100).alias("dti"),
            clip(F.col("revol_util"), 0, 100).alias("revol_util"),
            clip(F.col("mort_acc"), high=1).alias("mort_acc"),
        )
    )


@query("event_flags", with_(LOANS, select="SELECT loan_id, " + ", ".join(
    f"CASE WHEN {c} > 0 THEN 1 ELSE 0 END AS {n}" for c, n in
    (("delinq_2yrs", "has_delinq"), ("pub_rec", "has_pub_rec"), ("pub_rec_bankruptcies", "has_bankruptcy"),
     ("mort_acc", "has_mortgage"))) + " FROM loans"))
def event_flags(spark, sf_dir):
    return loan_view(spark, sf_dir).select(
        "loan_id",
        event_flag(F.col("delinq_2yrs")).alias("has_delinq"),
        event_flag(F.col("pub_rec")).alias("has_pub_rec"),
        event_flag(F.col("pub_rec_bankruptcies")).alias("has_bankruptcy"),
        event_flag(F.col("mort_acc")).alias("has_mortgage"),
    )


@query("annuity_installment", out("o_orderkey", "payment",
       "(SELECT o_orderkey, round(o_totalprice * (0.01::DOUBLE * pow(1.01::DOUBLE, 36)) "
       "/ (pow(1.01::DOUBLE, 36) - 1), 2) AS payment FROM orders)"))  # fmt: skip
def annuity_installment(spark, sf_dir):
    payment = annuity(F.col("o_totalprice"), F.lit(0.01), F.lit(36))
    return rounded(table(spark, sf_dir, "orders").select("o_orderkey", payment.alias("payment")))


@query("gold_features", with_(GOLD, select=out(GOLD_KEYS, GOLD_DOUBLES, "gold")))
def gold_features(spark, sf_dir):
    return rounded(gold_loans(spark, sf_dir).select(*names(GOLD_KEYS), *names(GOLD_DOUBLES)))


@query("epoch_route", with_(PACKAGE, select=f"SELECT loan_id, issue_year, {epoch_sql()} AS epoch FROM prepared"))
def epoch_route(spark, sf_dir):
    return layers.with_epoch(prepared(spark, sf_dir), EPOCHS).select("loan_id", "issue_year", "epoch")


@query("rolling_window_union", with_(PACKAGE, select="SELECT issue_year, count(*) AS loans, sum(target)::BIGINT AS bads "
       "FROM prepared WHERE issue_year BETWEEN 1997 AND 2000 GROUP BY issue_year"))  # fmt: skip
def rolling_window_union(spark, sf_dir):
    window = layers.window_of(prepared(spark, sf_dir), 1997, 2000)
    return window.groupBy("issue_year").agg(F.count("*").alias("loans"), F.sum("target").alias("bads"))


# ------------------------------------------------------ summaries, data tests


@query("vintage_summary", with_(GOLD, select="SELECT issue_year, count(*) AS loan_count, "
       "round(avg(target) * 100, 2) AS default_rate_pct, round(avg(fico_mid), 1) AS avg_fico, "
       "round(avg(dti), 1) AS avg_dti FROM gold GROUP BY issue_year ORDER BY issue_year"))  # fmt: skip
def vintage_summary(spark, sf_dir):
    return quality.vintages(gold_loans(spark, sf_dir))


@query("default_rate", with_(PACKAGE, select=out("epoch loans", "default_rate",
       f"(SELECT {epoch_sql()} AS epoch, count(*) AS loans, avg(target) AS default_rate FROM prepared GROUP BY 1)")))
def default_rate(spark, sf_dir):
    return rounded(quality.default_rate(layers.with_epoch(prepared(spark, sf_dir), EPOCHS), "epoch"))


def _dq(table_name: str, rule: str, column: str, count: str, source: str) -> str:
    return (
        f"SELECT '{table_name}' AS table_name, '{column}' AS column_name, '{rule}' AS rule, "
        f"({count})::BIGINT AS failures FROM {source}"
    )


def _passed(parts: list[str]) -> str:
    return f"SELECT *, failures = 0 AS passed FROM ({' UNION ALL '.join(parts)})"


def _dq_rule(table_name: str, rule: quality.Rule, source: str) -> str:
    if rule.kind == "unique":
        grouped = f"(SELECT {rule.column} FROM {source} WHERE {rule.column} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)"
        return _dq(table_name, rule.kind, rule.column, "count(*)", grouped)
    if rule.kind == "not_null":
        return _dq(table_name, rule.kind, rule.column, f"count(*) FILTER (WHERE {rule.column} IS NULL)", source)
    values = ", ".join(repr(v) for v in rule.values)
    return _dq(table_name, rule.kind, rule.column, f"count(*) FILTER (WHERE {rule.column} NOT IN ({values}))", source)


NULL_CHECKED = ["loan_id", "loan_status", "emp_length", "mort_acc", "dti"]


@query("dq_not_null", with_(LOANS, select=_passed(
    [_dq_rule("loans", quality.Rule(c, "not_null"), "loans") for c in NULL_CHECKED])))
def dq_not_null(spark, sf_dir):
    return quality.not_null(loan_view(spark, sf_dir), NULL_CHECKED)


@query("dq_unique", _passed([_dq_rule("lineitem", quality.Rule("l_orderkey", "unique"), "lineitem")]))
def dq_unique(spark, sf_dir):
    return quality.unique(table(spark, sf_dir, "lineitem"), "l_orderkey", "lineitem")


STATUSES = ("Fully Paid", "Charged Off")


@query("dq_accepted_values", with_(LOANS, select=_passed(
    [_dq_rule("loans", quality.Rule("loan_status", "accepted_values", STATUSES), "loans")])))
def dq_accepted_values(spark, sf_dir):
    return quality.accepted(loan_view(spark, sf_dir), "loan_status", STATUSES)


SOURCES = {"stg_raw_loans": "staged", "silver_fact_loans": "staged", "gold_scorecard_features": "gold"}


@query("dq_report", with_(GOLD, select=_passed(
    [_dq_rule(name, rule, SOURCES[name]) for name, rules in LAYER_RULES.items() for rule in rules])))
def dq_report(spark, sf_dir):
    rows = staged(spark, sf_dir)
    silver = layers.silver(rows)
    frames = {"stg_raw_loans": rows, "silver_fact_loans": silver, "gold_scorecard_features": layers.gold(silver)}
    return quality.dq_report({name: (frames[name], rules) for name, rules in LAYER_RULES.items()})
