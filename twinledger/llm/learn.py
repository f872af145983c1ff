"""Bounded samples of labelled documents for the classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinledger.llm.common import held_out, text_of


def label_sample(docs: DataFrame, labels: DataFrame, label_col: str, most: int, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, label) of at most ``most`` label rows that may be learnt from, in the order of a hash of the id.

    Rows with a null id, a label other than 0 and 1 or an id that no document has are left out
    before the sample is taken; only ids are shuffled for that.
    """
    ident, label = F.col(id_col).cast("long"), F.col(label_col).cast("int")
    usable = labels.select(ident.alias("doc_id"), label.alias("label")).filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull())
    usable = usable.filter(~held_out(F.col("doc_id"))).join(docs.select(ident.alias("doc_id")), "doc_id", "left_semi")
    return usable.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(most)


def labelled(docs: DataFrame, sample: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, label, text) of the sampled rows; the sample is broadcast, its size is bounded."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    return rows.join(F.broadcast(sample), "doc_id").select("doc_id", "label", "text")
