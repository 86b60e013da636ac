"""The loan table: column order, types and the named column groups."""

from __future__ import annotations

from pyspark.sql import types as T

# The 27 loan columns, in the order of the raw files.
LOAN_SCHEMA = T.StructType(
    [
        T.StructField("loan_id", T.LongType()),
        T.StructField("loan_amnt", T.DoubleType()),
        T.StructField("funded_amnt", T.DoubleType()),
        T.StructField("term", T.StringType()),
        T.StructField("int_rate", T.DoubleType()),
        T.StructField("installment", T.DoubleType()),
        T.StructField("grade", T.StringType()),
        T.StructField("sub_grade", T.StringType()),
        T.StructField("emp_length", T.StringType()),
        T.StructField("home_ownership", T.StringType()),
        T.StructField("annual_inc", T.DoubleType()),
        T.StructField("verification_status", T.StringType()),
        T.StructField("issue_d", T.StringType()),
        T.StructField("loan_status", T.StringType()),
        T.StructField("purpose", T.StringType()),
        T.StructField("dti", T.DoubleType()),
        T.StructField("delinq_2yrs", T.DoubleType()),
        T.StructField("fico_range_low", T.DoubleType()),
        T.StructField("fico_range_high", T.DoubleType()),
        T.StructField("inq_last_6mths", T.DoubleType()),
        T.StructField("open_acc", T.DoubleType()),
        T.StructField("pub_rec", T.DoubleType()),
        T.StructField("revol_bal", T.DoubleType()),
        T.StructField("revol_util", T.DoubleType()),
        T.StructField("total_acc", T.DoubleType()),
        T.StructField("mort_acc", T.DoubleType()),
        T.StructField("pub_rec_bankruptcies", T.DoubleType()),
    ]
)

LOAN_COLUMNS = LOAN_SCHEMA.fieldNames()
PERCENT_COLUMNS = ("int_rate", "revol_util")

# Columns that arrive as text in raw files; typed by ``plans.layers.typed``.
RAW_LOAN_SCHEMA = T.StructType(
    [T.StructField("id" if f.name == "loan_id" else f.name, T.StringType()) for f in LOAN_SCHEMA]
)
