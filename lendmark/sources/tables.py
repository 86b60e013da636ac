"""The star-schema tables and the loan view derived from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendmark.functions.expr import annuity
from lendmark.sources.schema import LOAN_COLUMNS

# Year ranges of the loan view: training, first scoring batch, later batch, hold-out.
EPOCHS = {"baseline": (1995, 1997), "inference": (1998, 1998), "drift": (1999, 2000), "holdout": (2001, 2001)}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def loan_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One loan per order that has line items, in the 27-column loan schema.

    The line items collapse to one row per order before any join; the distinct
    supplier count is planned by Spark as a two-level aggregate, so an order
    that holds a large share of the lines is combined before it is shuffled.
    Ratios are rounded so that the order of a float sum cannot move a value
    across a bin edge.
    """
    item, order, customer = (table(spark, sf_dir, t) for t in ("lineitem", "orders", "customer"))
    lines = item.groupBy("l_orderkey").agg(
        F.count("*").cast("double").alias("n_lines"),
        F.countDistinct("l_suppkey").cast("double").alias("n_suppliers"),
        F.sum("l_extendedprice").alias("price"),
        F.avg("l_tax").alias("tax"),
        F.avg("l_discount").alias("discount"),
        F.avg("l_quantity").alias("quantity"),
        F.count_if(F.col("l_returnflag") == "N").cast("double").alias("n_new"),
        F.count_if(F.col("l_returnflag") == "R").cast("double").alias("n_returned"),
        F.count_if(F.col("l_linestatus") == "F").cast("double").alias("n_filled"),
    )
    # Customers first: the skewed join moves narrow rows, and the result ends up
    # partitioned by the loan key, which the layers group by.
    applicants = order.join(
        customer.select("c_custkey", "c_acctbal", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey")
    )
    joined = applicants.join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
    key = F.col("o_orderkey")
    rated = joined.withColumn("int_rate", F.round(5 + 100 * F.col("tax"), 6)).withColumn(
        "grade_pos", (F.col("int_rate") - 5) / 1.2
    )
    step = F.floor("grade_pos")
    grade = F.substring(F.lit("ABCDEFG"), (step + 1).cast("int"), F.lit(1))
    months = F.when(key % 4 == 0, 60).otherwise(36)
    band = F.floor("quantity") * 5
    status = (
        F.when(F.col("o_orderstatus") == "P", "Current")
        .when(F.col("n_returned") / F.col("n_lines") >= 0.5, "Charged Off")
        .otherwise("Fully Paid")
    )
    columns = {
        "loan_id": key,
        "loan_amnt": F.col("o_totalprice"),
        "funded_amnt": F.col("o_totalprice"),
        "term": F.concat(months.cast("string"), F.lit(" months")),
        "int_rate": F.col("int_rate"),
        "installment": annuity(F.col("o_totalprice"), F.col("int_rate") / 1200, months),
        "grade": grade,
        "sub_grade": F.concat(grade, (F.floor((F.col("grade_pos") - step) * 5) + 1).cast("string")),
        "emp_length": F.when(key % 20 != 0, F.col("o_orderpriority")),
        "home_ownership": F.col("c_mktsegment"),
        "annual_inc": F.col("c_acctbal") * 12,
        "verification_status": F.when(key % 3 == 0, "Verified")
        .when(key % 3 == 1, "Source Verified")
        .otherwise("Not Verified"),
        "issue_d": F.date_format("o_orderdate", "MMM-yyyy"),
        "loan_status": status,
        "purpose": F.col("o_orderpriority"),
        "dti": F.round(F.col("price") / 5000, 6),
        "delinq_2yrs": F.col("n_filled"),
        "fico_range_low": (620 + band).cast("double"),
        "fico_range_high": (624 + band).cast("double"),
        "inq_last_6mths": F.col("n_new"),
        "open_acc": F.col("n_lines"),
        "pub_rec": F.col("n_lines") - F.col("n_suppliers"),
        "revol_bal": F.round("price", 2),
        "revol_util": F.round(1200 * F.col("discount"), 6),
        "total_acc": F.col("n_lines") + F.col("n_suppliers"),
        "mort_acc": F.when(key % 10 != 0, (key % 3).cast("double")),
        "pub_rec_bankruptcies": F.when(F.col("n_returned") >= 3, 1.0).otherwise(0.0),
    }
    return rated.select(*(columns[c].alias(c) for c in LOAN_COLUMNS))


def raw_loan_text(loans: DataFrame) -> DataFrame:
    """The loan view as a raw file delivers it: ``id`` as key, percents as text with a sign."""
    return loans.withColumnRenamed("loan_id", "id").withColumns(
        {
            c: F.concat(F.lit(" "), F.col(c).cast("decimal(14,6)").cast("string"), F.lit("%"))
            for c in ("int_rate", "revol_util")
        }
    )
