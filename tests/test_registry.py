import duckdb
import pytest

import __spark_entry__ as driver
from lendmark.plans.layers import preprocess
from lendmark.plans.lifecycle import lifecycle
from lendmark.registry.catalog import load
from lendmark.sources.tables import EPOCHS, loan_view

SF_DIR = "/root/testdata/sf0.001"
CHECKED = ["gold_features", "scd2_from_history", "iv_rating", "vif_filter", "score_scale", "psi_status", "top_reasons",
           "lifecycle_3_epochs"]


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(round(r[i], 5) if isinstance(r[i], float) else r[i] for i in order)) for r in rows)


def test_every_sql_has_its_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())
    queries, oracles = load()
    assert set(queries) == set(oracles)


def test_entry_has_rows(spark):
    assert driver.entry(spark).count() > 5


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("lineitem", "orders", "customer", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    df = driver.queries()[name](spark, SF_DIR)
    cursor = con.execute(driver.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert canonical(df.columns, df.collect()) == canonical(columns, cursor.fetchall())


def test_lifecycle_keeps_the_feature_list_and_logs(spark, tmp_path):
    loans = preprocess(loan_view(spark, SF_DIR), "package", 1995).cache()
    path = str(tmp_path / "runs")
    result = lifecycle(loans, EPOCHS, rolling=(1997, 2000), log_path=path)
    assert result.second.bins.features == result.first.bins.features
    assert {r["epoch"] for r in result.stability.collect()} == {"inference", "drift"}
    assert result.gate.first()["decision"] in ("PROMOTE", "REJECT")
    assert result.notices.count() > 0
    assert spark.read.parquet(path).select("run_name").distinct().count() == 4
    quiet = lifecycle(loans, EPOCHS, rolling=(1997, 2000), force_retrain=False)
    drifted = any(r["psi"] >= 0.25 for r in quiet.stability.collect())
    assert (quiet.second is not None) == drifted
    loans.unpersist()
