"""Data tests and portfolio summaries."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """``kind`` is ``not_null``, ``accepted_values`` or ``unique``."""

    column: str
    kind: str
    values: tuple = ()


def _row_failures(rule: Rule) -> Column:
    c = F.col(rule.column)
    if rule.kind == "not_null":
        return F.count_if(c.isNull())
    if rule.kind == "accepted_values":
        return F.count_if(~c.isin(*rule.values))
    raise ValueError(f"unknown rule {rule.kind!r}")


def _long(counted: DataFrame, name: str, rules: Sequence[Rule]) -> DataFrame:
    rows = F.array(
        *(
            F.struct(
                F.lit(name).alias("table_name"),
                F.lit(r.column).alias("column_name"),
                F.lit(r.kind).alias("rule"),
                F.col(f"f{i}").alias("failures"),
            )
            for i, r in enumerate(rules)
        )
    )
    return counted.select(F.inline(rows))


def _check(df: DataFrame, name: str, rules: Sequence[Rule]) -> DataFrame:
    """All rules of one table that look at a row or at one key, in one pass, in long form.

    Failures are summed per key first, which also tells how often a key occurs.
    """
    keys = [r.column for r in rules if r.kind == "unique"]
    by_row = {i: _row_failures(r) for i, r in enumerate(rules) if r.kind != "unique"}
    if not keys:
        return _long(df.agg(*(c.alias(f"f{i}") for i, c in by_row.items())), name, rules)
    per_key = df.groupBy(F.col(keys[0]).alias("__key")).agg(
        F.count("*").alias("__n"), *(c.alias(f"f{i}") for i, c in by_row.items())
    )
    twice = F.count_if(F.col("__key").isNotNull() & (F.col("__n") > 1))
    totals = [
        twice.alias(f"f{i}") if r.kind == "unique" else F.coalesce(F.sum(f"f{i}"), F.lit(0)).alias(f"f{i}")
        for i, r in enumerate(rules)
    ]
    return _long(per_key.agg(*totals), name, rules)


def duplicate_keys(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row counts (nulls do not count)."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.dropna(subset=keys).groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def dq_report(tables: Mapping[str, tuple[DataFrame, Sequence[Rule]]]) -> DataFrame:
    """All rules of all tables: (table_name, column_name, rule, failures, passed).

    One scan per table, plus one for each unique rule after the first.
    """
    parts = []
    for name, (df, rules) in tables.items():
        unique_rules = [r for r in rules if r.kind == "unique"]
        parts.append(_check(df, name, [r for r in rules if r not in unique_rules[1:]]))
        parts += [_check(df, name, [r]) for r in unique_rules[1:]]
    return reduce(DataFrame.unionByName, parts).withColumn("passed", F.col("failures") == 0)


def not_null(df: DataFrame, columns: Iterable[str], name: str = "loans") -> DataFrame:
    return dq_report({name: (df, [Rule(c, "not_null") for c in columns])})


def unique(df: DataFrame, key: str, name: str = "loans") -> DataFrame:
    return dq_report({name: (df, [Rule(key, "unique")])})


def accepted(df: DataFrame, column: str, values: Sequence, name: str = "loans") -> DataFrame:
    return dq_report({name: (df, [Rule(column, "accepted_values", tuple(values))])})


# The data tests declared for the three layers.
LAYER_RULES = {
    "stg_raw_loans": [
        Rule("loan_id", "not_null"),
        Rule("target", "not_null"),
        Rule("target", "accepted_values", (0, 1)),
    ],
    "silver_fact_loans": [
        Rule("loan_id", "unique"),
        Rule("loan_id", "not_null"),
        Rule("target", "not_null"),
        Rule("target", "accepted_values", (0, 1)),
        Rule("fico_range_low", "not_null"),
        Rule("fico_range_high", "not_null"),
    ],
    "gold_scorecard_features": [
        Rule("loan_id", "unique"),
        Rule("loan_id", "not_null"),
        Rule("target", "not_null"),
        Rule("target", "accepted_values", (0, 1)),
        Rule("fico_mid", "not_null"),
        Rule("dti", "not_null"),
        Rule("installment_to_inc", "not_null"),
    ],
}


def vintages(df: DataFrame) -> DataFrame:
    """Per issue year: loans, default rate in percent, mean score midpoint and dti."""
    return (
        df.groupBy("issue_year")
        .agg(
            F.count("*").alias("loan_count"),
            F.round(F.avg("target") * 100, 2).alias("default_rate_pct"),
            F.round(F.avg("fico_mid"), 1).alias("avg_fico"),
            F.round(F.avg("dti"), 1).alias("avg_dti"),
        )
        .orderBy("issue_year")
    )


def default_rate(df: DataFrame, by: str | None = None, target: str = "target") -> DataFrame:
    """Rows and mean target, over all rows or per group."""
    grouped = df.groupBy(by) if by else df.groupBy()
    return grouped.agg(F.count("*").alias("loans"), F.avg(target).alias("default_rate"))
