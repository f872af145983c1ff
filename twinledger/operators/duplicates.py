"""Repeated rows of the two sides and their classification."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinledger.functions import values as V
from twinledger.operators.clean import COPIES, DIGEST
from twinledger.operators.reconcile import IN_SOURCE, IN_TARGET, reconcile

SURPLUS = "surplus"


def surplus_duplicates(df: DataFrame) -> DataFrame:
    """Rows that occur more than once and their copies after the first."""
    return (
        df.groupBy(*[F.col(V.quoted(c)) for c in df.columns])
        .agg((F.count(F.lit(1)) - 1).alias(SURPLUS))
        .where(F.col(SURPLUS) > 0)
    )


def surplus_of_copies(grouped: DataFrame) -> DataFrame:
    """The same from rows that were already grouped by ``count_copies``."""
    return (
        grouped.where(F.col(COPIES) > 1)
        .withColumn(SURPLUS, F.col(COPIES) - 1)
        .drop(COPIES, DIGEST)
    )


def surplus_total(surplus: DataFrame) -> DataFrame:
    return surplus.agg(
        F.coalesce(F.sum(SURPLUS), F.lit(0)).cast("bigint").alias("surplus_rows"),
        F.count(F.lit(1)).alias("duplicate_groups"),
    )


def duplicate_groups(src_surplus: DataFrame, tgt_surplus: DataFrame, key, target_unique: bool = False) -> DataFrame:
    """Duplicate groups of both sides matched on the key, each with its class.

    Only rows with surplus copies get here, so the join is small next to the
    grouping that finds them.
    """
    s = src_surplus.select(*key, SURPLUS)
    t = tgt_surplus.select(*key, SURPLUS)
    joined = reconcile(s, t, key, target_unique)
    a, b = F.col(f"source__{SURPLUS}"), F.col(f"target__{SURPLUS}")
    label = (
        F.when(~F.col(IN_TARGET), "DUPLICATES_ONLY_SOURCE")
        .when(~F.col(IN_SOURCE), "DUPLICATES_ONLY_TARGET")
        .when(a == b, "DUPLICATES_EQUAL")
        .when(a > b, "DUPLICATES_PARTIAL")
        .otherwise("DUPLICATES_EXTRA_LOADED")
    )
    return joined.select(*key, a.alias("source_surplus"), b.alias("target_surplus"), label.alias("code"))


def duplicate_classes(groups: DataFrame) -> DataFrame:
    return groups.groupBy("code").agg(F.count(F.lit(1)).alias("groups"))
