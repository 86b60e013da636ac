import pytest
from pyspark.sql import types as T

from lendmark.llm.shipping import ship

DOCUMENT = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    # names that operators use themselves
    T.StructField("tag", T.StringType()), T.StructField("places", T.StringType()), T.StructField("row", T.IntegerType()),
])


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture
def docs(spark):
    def make(rows):
        return spark.createDataFrame([(i, t, None, "x", 1) for i, t in rows], DOCUMENT)

    return make


@pytest.fixture
def by_id():
    def collect(df):
        return {r["doc_id"]: r for r in df.collect()}

    return collect
