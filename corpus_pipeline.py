"""From raw documents to packed training sequences; part of the llm subpackage.

Each stage gets what its predecessor kept, written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from twinledger.llm import exact, mixing, packing, quality, simhash
from twinledger.llm.common import documents, labels, staged


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.keep_good(docs, labels(spark, sf_dir))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id."""
    return exact.drop_exact(docs)


def unlike(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the row with the smallest id."""
    return simhash.drop_near(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mixing.mixed(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents with their places in the sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", good),
    ("exact dedup", distinct),
    ("simhash near-dedup", unlike),
    ("mixing sources to target weights", mixture),
    ("best-fit packing", sequences),
]

#: Classifier scores, BK-tree links and token ids have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
