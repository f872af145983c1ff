"""Cleaning of one side: missing values, empty rows, copies of rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinledger.functions import values as V

COPIES = "__copies"
DIGEST = "__digest"


def with_missing_as_null(df: DataFrame) -> DataFrame:
    """NaN becomes null, so that one notion of a missing value remains; a
    column of no type at all becomes text."""
    fields = df.schema.fields
    if not any(isinstance(f.dataType, V.FLOATING + (T.NullType,)) for f in fields):
        return df
    return df.selectExpr(*[
        f"{V.missing_to_null(V.quoted(f.name), f.dataType)} as {V.quoted(f.name)}" for f in fields])


def is_empty_row(columns) -> str:
    return " and ".join(f"{V.quoted(c)} is null" for c in columns)


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def drop_empty_rows(df: DataFrame) -> DataFrame:
    """Rows with a value in at least one column."""
    return df.dropna(how="all", subset=[V.quoted(c) for c in df.columns])


def clean(df: DataFrame) -> DataFrame:
    return drop_empty_rows(distinct_rows(with_missing_as_null(df)))


def count_copies(df: DataFrame) -> DataFrame:
    """Every distinct row with its number of copies and a row digest.

    The grouping combines on the map side, so a row that makes up a third of
    the table crosses the network once per map task.  Everything later in a
    validation (count, duplicates, classes, key, values) reads this frame.
    """
    df = with_missing_as_null(df)
    grouped = df.groupBy(*[F.col(V.quoted(c)) for c in df.columns]).agg(F.count(F.lit(1)).alias(COPIES))
    return grouped.withColumn(DIGEST, F.xxhash64(*[V.quoted(c) for c in df.columns]))


def with_row_digest(df: DataFrame) -> DataFrame:
    df = with_missing_as_null(df)
    return df.withColumn(DIGEST, F.xxhash64(*[V.quoted(c) for c in df.columns]))


def repeated_digests(rows: DataFrame) -> DataFrame:
    """Digests that more than one row has: a shuffle of eight bytes a row."""
    return rows.groupBy(DIGEST).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(DIGEST)


def group_copies(rows: DataFrame) -> DataFrame:
    """Rows with digests, grouped by all their columns: copies beside the digest."""
    return rows.groupBy(*[F.col(V.quoted(c)) for c in rows.columns]).agg(F.count(F.lit(1)).alias(COPIES))


def split_copies(rows: DataFrame, repeated: DataFrame):
    """``count_copies`` of rows with digests in two parts, when the few repeated digests are known.

    Rows whose digest is single have no copy and stay where they were read;
    only the others are grouped by all columns.  ``repeated`` is sent to all
    tasks, so the caller checks its size.
    """
    few = F.broadcast(repeated.select(DIGEST))
    single = rows.join(few, DIGEST, "left_anti").withColumn(COPIES, F.lit(1).cast("bigint"))
    return single, group_copies(rows.join(few, DIGEST, "left_semi"))
