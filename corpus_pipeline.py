"""A training corpus from raw documents: quality, near duplicates, repeated passages, personal data, packing.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows of ``docs``;
all but the last return the columns of ``docs``. Between stages the rows are
written to the shared folder, so a lost executor costs one stage at most.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendmark.llm import near_dups, packing, pii, quality, substrings
from lendmark.llm.scratch import kept
from lendmark.llm.shipping import ship

VOCABULARY = "byte_bpe_50k.json"


def _measured(docs: DataFrame) -> DataFrame:
    """``n_chars`` again that of the text, where there is such a column."""
    if "n_chars" not in docs.columns:
        return docs
    length = F.length("text").cast(docs.schema["n_chars"].dataType)
    return docs.select(*(length.alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns))


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject."""
    ship(spark)
    return quality.accepted(docs, quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, similarity of 0.8 or more)."""
    ship(spark)
    return near_dups.representatives(docs, shingle_words=5)


def first_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of 20 words that start earlier; the others keep their form."""
    ship(spark)
    return _measured(substrings.without_duplicates(docs))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts in which personal data is replaced by its kind."""
    ship(spark)
    return _measured(pii.redact(docs, pii.fit(pii.labelled_sample(docs))))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens with their places in sequences."""
    ship(spark)
    return packing.pack(docs, public_tokenizers.path(VOCABULARY))


STAGES = [
    ("quality classifier", good_quality),
    ("near duplicates", one_of_each),
    ("repeated passages", first_passages),
    ("personal data", without_personal_data),
    ("best-fit packing", packed),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
