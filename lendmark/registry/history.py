"""Dedup, incremental loads, SCD2 and sampling."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import functions as F

from lendmark.operators import history, sampling
from lendmark.plans.layers import SCD2_CHECK
from lendmark.registry.base import MODEL_LOANS, fresh_path, model_loans, out, query, rounded, with_
from lendmark.registry.layers import STAGED, staged
from lendmark.sources import files, folded
from lendmark.sources.tables import table
from lendmark.streaming import incremental

LINE_COLUMNS = [
    "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey",
    "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
]
LINE_ORDER = ", ".join(f"{c} DESC NULLS LAST" for c in LINE_COLUMNS[2:])
NEWEST_LINE = f"""ranked AS (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LINE_ORDER}) AS rn FROM lineitem)"""


@query("latest_per_key", with_(NEWEST_LINE, select=f"SELECT {', '.join(LINE_COLUMNS)} FROM ranked WHERE rn = 1"))
def latest_per_key(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(*LINE_COLUMNS)
    return history.latest(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


@contextmanager
def own_layer(spark):
    """The name of a layer that is gone afterwards."""
    name = f"lendmark_{uuid.uuid4().hex[:12]}"
    try:
        yield name
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def copied(df):
    """What a layer holds now, beyond its end."""
    path = fresh_path(df.sparkSession, "layer")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


# Orders are loaded in two steps: an old state of all, then the newer half as updates.
UPDATE_FROM = "1998-06-01"
UPDATED = f"""changed AS (
  SELECT o_orderkey, o_custkey, 'U' AS o_orderstatus, o_totalprice * 2 AS o_totalprice, o_orderdate, o_orderpriority
  FROM orders WHERE o_orderdate >= TIMESTAMP '{UPDATE_FROM}'
  UNION ALL
  SELECT o_orderkey + 100000000, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
  FROM orders WHERE o_orderdate >= TIMESTAMP '{UPDATE_FROM}')"""


def _changed(orders):
    recent = orders.filter(F.col("o_orderdate") >= F.lit(UPDATE_FROM).cast("timestamp"))
    updates = recent.withColumns({"o_orderstatus": F.lit("U"), "o_totalprice": F.col("o_totalprice") * 2})
    return updates.unionByName(recent.withColumn("o_orderkey", F.col("o_orderkey") + 100_000_000))


UPSERTED = with_(UPDATED, select=out("o_orderkey o_custkey o_orderstatus o_orderdate o_orderpriority",
       "o_totalprice", "(SELECT * FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM changed) "
       "UNION ALL SELECT * FROM changed)"))  # fmt: skip


@query("upsert_by_key", UPSERTED)
def upsert_by_key(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    merged = history.upsert(orders, _changed(orders), "o_orderkey", ["o_orderdate"])
    return rounded(merged.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority", "o_totalprice"))


@query("upsert_bucketed", UPSERTED)
def upsert_bucketed(spark, sf_dir):
    """The same upsert into a bucketed table, whose rows are not shuffled."""
    columns = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority", "o_totalprice"]
    orders = table(spark, sf_dir, "orders").select(*columns)
    with own_layer(spark) as name:
        history.write_bucketed(orders, name, "o_orderkey", 16)
        return rounded(copied(history.upsert_bucketed(spark.table(name), _changed(orders), "o_orderkey", ["o_orderdate"], 16)))


@query("incremental_watermark", "SELECT event_id, ts, event_type FROM events WHERE ts > "
       "(SELECT max(ts) FROM events WHERE ts < TIMESTAMP '2024-01-20')")  # fmt: skip
def incremental_watermark(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    loaded = events.filter(F.col("ts") < F.lit("2024-01-20").cast("timestamp"))
    return history.newer_than(events, "ts", loaded).select("event_id", "ts", "event_type")


EVENT_ORDER = "ts DESC, event_id DESC, event_type DESC, value DESC NULLS LAST"
LATEST_EVENT = f"""ranked AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY {EVENT_ORDER}) AS rn FROM events)"""


@query("incremental_upsert_run", with_(LATEST_EVENT, select=out("user_id ts event_id event_type", "value",
       "ranked WHERE rn = 1")))
def incremental_upsert_run(spark, sf_dir):
    """First half, then everything, then everything again: the last run finds nothing new."""
    events = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type", "value")
    state = None
    for landing in (events.filter(F.col("ts") < F.lit("2024-01-15").cast("timestamp")), events, events):
        path = fresh_path(spark, "increment")
        history.load_increment(landing, state, "user_id", "ts").write.parquet(path)
        state = spark.read.parquet(path)
    return rounded(state)


@query("incremental_upsert_stream", with_(LATEST_EVENT, select=out("user_id ts event_id event_type", "value",
       "ranked WHERE rn = 1")))
def incremental_upsert_stream(spark, sf_dir):
    """The same load as a stream over a landing folder that grows between two runs."""
    events = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type", "value")
    landing, marks = fresh_path(spark, "landing"), fresh_path(spark, "stream")
    early = F.col("ts") < F.lit("2024-01-15").cast("timestamp")
    with own_layer(spark) as name:
        for part in (events.filter(early), events.filter(~early)):
            part.write.mode("append").parquet(landing)
            incremental.load_stream(spark, landing, name, marks, events.schema, "user_id", "ts")
        return rounded(copied(folded.layer(spark, name)))


@query("materialize_incremental", with_(LATEST_EVENT, select=out("user_id ts event_id event_type", "value",
       "ranked WHERE rn = 1")))
def materialize_incremental(spark, sf_dir):
    """The newest event per user as a named layer that a second run folds more rows into."""
    events = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type", "value")
    early = F.col("ts") < F.lit("2024-01-15").cast("timestamp")
    with own_layer(spark) as name:
        for part in (events.filter(~early), events.filter(early), events):
            state = files.materialize(part, name, "incremental", "user_id", ["ts"])
        return rounded(copied(state))


SCD2_COLUMNS = "loan_id grade sub_grade home_ownership verification_status valid_from valid_to is_current"


@query("scd2_seed", with_(STAGED, select=out(SCD2_COLUMNS, "annual_inc",
       "(SELECT *, issue_d AS valid_from, NULL::VARCHAR AS valid_to, true AS is_current FROM staged)")))
def scd2_seed(spark, sf_dir):
    return rounded(history.scd2_seed(staged(spark, sf_dir), "loan_id", SCD2_CHECK, "issue_d"))


def _snapshot(loans):
    """A later state: every third loan regraded, every seventh gone, copies of every fifth under new keys."""
    key = F.col("loan_id")
    kept = loans.filter(key % 7 != 0).withColumn("grade", F.when(key % 3 == 0, "G").otherwise(F.col("grade")))
    added = loans.filter(key % 5 == 0).withColumn("loan_id", key + 100_000_000)
    return kept.unionByName(added)


@query("scd2_apply", with_(STAGED, f"""snap AS (
  SELECT loan_id, CASE WHEN loan_id % 3 = 0 THEN 'G' ELSE grade END AS grade, sub_grade, home_ownership, annual_inc,
         verification_status FROM staged WHERE loan_id % 7 <> 0
  UNION ALL SELECT loan_id + 100000000, grade, sub_grade, home_ownership, annual_inc, verification_status
  FROM staged WHERE loan_id % 5 = 0),
versions AS (
  SELECT d.loan_id, d.grade, d.sub_grade, d.home_ownership, d.annual_inc, d.verification_status,
         d.issue_d AS valid_from,
         CASE WHEN s.loan_id IS NOT NULL AND d.grade <> s.grade THEN 'Jan-2002' END AS valid_to,
         NOT (s.loan_id IS NOT NULL AND d.grade <> s.grade) AS is_current
  FROM staged d LEFT JOIN snap s USING (loan_id)
  UNION ALL
  SELECT s.loan_id, s.grade, s.sub_grade, s.home_ownership, s.annual_inc, s.verification_status, 'Jan-2002', NULL, true
  FROM snap s LEFT JOIN staged d USING (loan_id) WHERE d.loan_id IS NULL OR d.grade <> s.grade)""",
       select=out(SCD2_COLUMNS, "annual_inc", "versions")))
def scd2_apply(spark, sf_dir):
    loans = staged(spark, sf_dir)
    dim = history.scd2_seed(loans, "loan_id", SCD2_CHECK, "issue_d")
    return rounded(history.scd2_apply(dim, _snapshot(loans), "loan_id", SCD2_CHECK, F.lit("Jan-2002")))


@query("scd2_from_history", """WITH seen AS (
  SELECT user_id, event_id, event_type, ts, lag(event_type) OVER w AS before, row_number() OVER w AS rn
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
starts AS (SELECT * FROM seen WHERE rn = 1 OR event_type IS DISTINCT FROM before),
ended AS (SELECT user_id, event_id, event_type, ts AS valid_from,
  lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS valid_to FROM starts)
SELECT *, valid_to IS NULL AS is_current FROM ended""")
def scd2_from_history(spark, sf_dir):
    return history.scd2_history(table(spark, sf_dir, "events"), "user_id", ["ts", "event_id"], ["event_type"])


HASHED = MODEL_LOANS + """,
ordered AS (
  SELECT *, md5(CAST(loan_id AS VARCHAR) || '#42') AS h FROM base)"""


@query("stratified_sample", with_(HASHED, select="""SELECT loan_id, issue_year, target FROM (
  SELECT *, row_number() OVER (PARTITION BY issue_year, target ORDER BY h, loan_id) AS rn,
         count(*) OVER (PARTITION BY issue_year, target) AS n FROM ordered)
  WHERE rn <= round_even(0.2::DOUBLE * n, 0)"""))
def stratified_sample(spark, sf_dir):
    loans = model_loans(spark, sf_dir).select("loan_id", "issue_year", "target")
    return sampling.stratified_sample(loans, ["issue_year", "target"], 0.2, "loan_id")


@query("background_sample", with_(HASHED, select="SELECT loan_id, issue_year, target FROM ordered ORDER BY h, loan_id LIMIT 500"))
def background_sample(spark, sf_dir):
    return sampling.bounded_sample(model_loans(spark, sf_dir).select("loan_id", "issue_year", "target"), 500, "loan_id")


