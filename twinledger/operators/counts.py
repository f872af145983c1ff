"""Row counts of the two sides."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinledger.functions import values as V
from twinledger.operators.clean import is_empty_row


def _tagged(src: DataFrame, tgt: DataFrame, aggregates) -> DataFrame:
    """One row per side; the sides aggregate on their own and only the single
    result rows meet."""
    one = src.agg(*aggregates(src)).withColumn("side", F.lit("source"))
    two = tgt.agg(*aggregates(tgt)).withColumn("side", F.lit("target"))
    return one.unionByName(two)


def _pick(side: str, name: str):
    return F.sum(F.when(F.col("side") == side, F.col(name)).otherwise(0)).cast("bigint")


def count_validation(src: DataFrame, tgt: DataFrame) -> DataFrame:
    """Raw row counts and their verdict: (source_count, target_count, result)."""
    both = _tagged(src, tgt, lambda df: [F.count(F.lit(1)).alias("n")])
    out = both.agg(_pick("source", "n").alias("source_count"), _pick("target", "n").alias("target_count"))
    same = F.col("source_count") == F.col("target_count")
    return out.withColumn("result", F.when(same, "Pass").otherwise("Fail"))


def empty_row_balance(src: DataFrame, tgt: DataFrame) -> DataFrame:
    """Rows that are null in every column, per side, and what the target has
    too many (extra) or too few (missing)."""
    both = _tagged(src, tgt, lambda df: [F.count_if(F.expr(is_empty_row(df.columns))).alias("n")])
    out = both.agg(_pick("source", "n").alias("source_empty"), _pick("target", "n").alias("target_empty"))
    diff = F.col("target_empty") - F.col("source_empty")
    return out.select(
        "source_empty",
        "target_empty",
        F.greatest(diff, F.lit(0)).cast("bigint").alias("extra_in_target"),
        F.greatest(-diff, F.lit(0)).cast("bigint").alias("missing_in_target"),
    )


def non_null_counts(df: DataFrame) -> DataFrame:
    """One row with the number of values of every column."""
    return df.agg(*[F.count(F.col(V.quoted(c))).alias(c) for c in df.columns])


def null_populated_columns(src: DataFrame, tgt: DataFrame, key=()) -> DataFrame:
    """Non-key columns that have values in the source and none in the target.

    Both frames carry the same column names.
    """
    columns = [c for c in src.columns if c not in key]

    def long(df):
        wide = non_null_counts(df.select(*columns))
        rows = [F.struct(F.lit(i).alias("ordinal"), F.lit(c).alias("column_name"), F.col(V.quoted(c)).alias("n"))
                for i, c in enumerate(columns)]
        return wide.select(F.inline(F.array(*rows)))

    both = long(src).withColumn("side", F.lit("source")).unionByName(long(tgt).withColumn("side", F.lit("target")))
    return (
        both.groupBy("ordinal", "column_name")
        .agg(_pick("source", "n").alias("source_values"), _pick("target", "n").alias("target_values"))
        .where("source_values > 0 and target_values = 0")
        .select("column_name", "source_values", "target_values")
    )


