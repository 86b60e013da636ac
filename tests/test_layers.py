"""Bronze batches of different columns, and the run log of a write."""

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lendmark.operators import govern
from lendmark.plans import layers


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_batches_of_different_columns_are_read_together(spark, tmp_path):
    path = str(tmp_path / "bronze")

    def ingest(rows, schema, batch):
        layers.append_bronze(layers.bronze(spark.createDataFrame(rows, schema), batch), path)

    ingest([(1, 2013, "a"), (2, 2014, "b")], "loan_id int, issue_year int, grade string", "one")
    ingest([(3, 2014, 0.5)], "loan_id int, issue_year int, rate double", "two")
    ingest([(4, 2015, "c", 0.7)], "loan_id int, issue_year int, grade string, rate double", "three")
    columns = ["loan_id", "issue_year", "grade", "rate", "source_batch"]
    expected = sorted([(1, 2013, "a", None, "one"), (2, 2014, "b", None, "one"), (3, 2014, None, 0.5, "two"),
                       (4, 2015, "c", 0.7, "three")], key=repr)
    whole = layers.read_bronze(spark, path)
    assert rows_of(whole.select(*columns)) == expected
    assert rows_of(layers.read_bronze(spark, path, whole.schema).select(*columns)) == expected
    ingest([(2, 2014, "x")], "loan_id int, issue_year int, grade string", "one")  # again: its folders are replaced
    again = layers.read_bronze(spark, path).select("loan_id", "grade", "source_batch")
    assert rows_of(again) == sorted([(1, "a", "one"), (2, "x", "one"), (3, None, "two"), (4, "c", "three")], key=repr)


def test_silver_keeps_what_was_ingested_last(spark):
    rows = spark.createDataFrame(
        [(1, 2014, "2020-01-01 00:00:00", "G"), (1, 2013, "2020-01-02 00:00:00", "A"), (2, 2013, None, "B"),
         (2, 2013, "2020-01-01 00:00:00", "A"), (3, 2013, "2020-01-01 00:00:00", "C"), (3, 2013, "2020-01-01 00:00:00", "D")],
        "loan_id int, issue_year int, at string, grade string",
    )
    staged = rows.select("loan_id", "issue_year", F.col("at").cast("timestamp").alias(layers.INGEST_TIME), "grade")
    assert rows_of(layers.silver(staged).select("loan_id", "grade")) == [(1, "A"), (2, "A"), (3, "D")]
    assert rows_of(layers.silver(staged.drop(layers.INGEST_TIME)).select("loan_id", "grade")) == [(1, "G"), (2, "B"), (3, "D")]
    assert rows_of(layers.silver(rows, "at").select("loan_id", "grade")) == [(1, "A"), (2, "A"), (3, "D")]


def test_types_that_do_not_widen_are_an_error(spark, tmp_path):
    path = str(tmp_path / "bronze")
    for value, batch in (("1", "one"), ("'x'", "two")):
        layers.append_bronze(layers.bronze(spark.sql(f"SELECT 1 AS issue_year, {value} AS v"), batch), path)
    with pytest.raises((PySparkException, Py4JJavaError)):
        layers.read_bronze(spark, path).collect()


def test_a_write_logs_what_passes_through_it_in_one_job(spark, tmp_path):
    log, target = str(tmp_path / "log"), str(tmp_path / "target")
    df = spark.range(0, 1000, 1, 4).withColumn("x", F.col("id") % 7)
    jobs = []

    def write(rows):
        before = spark.sparkContext._jsc.sc().dagScheduler().numTotalJobs()
        rows.write.parquet(target)
        jobs.append(spark.sparkContext._jsc.sc().dagScheduler().numTotalJobs() - before)

    found = govern.logged_write(df, write, log, "load", {"largest": F.max("x"), "gaps": F.count_if(F.col("x").isNull())}, {"k": 1})
    assert found == {"rows": 1000, "largest": 6, "gaps": 0} and jobs == [1]
    logged = {(r["kind"], r["key"]): r["value"] for r in govern.runs(spark, log).collect()}
    assert float(logged.pop(("metric", "seconds"))) >= 0
    assert logged == {("metric", "rows"): "1000", ("metric", "largest"): "6", ("metric", "gaps"): "0", ("param", "k"): "1"}
    assert spark.read.parquet(target).count() == 1000


def test_a_write_that_fails_logs_nothing(spark, tmp_path):
    log = tmp_path / "log"
    bad = spark.range(10).select(F.raise_error(F.lit("no")).cast("string").alias("x"))
    with pytest.raises(PySparkException):
        govern.logged_write(bad, lambda df: df.write.parquet(str(tmp_path / "t")), str(log), "load")
    assert not log.exists()
