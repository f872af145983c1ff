"""Control inputs of a run: the pair manifest and the datatype mapping."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinledger.model import DatasetError


def read_control(spark: SparkSession, name: str) -> DataFrame:
    """A CSV, JSON or Parquet path, or else a table name."""
    kind = name.rsplit(".", 1)[-1].lower()
    if kind == "csv":
        return spark.read.csv(name, header=True, escape='"')
    if kind in ("json", "parquet"):
        return spark.read.format(kind).load(name)
    return spark.table(name)


def read_mapping(spark: SparkSession, name: str) -> DataFrame:
    """SQL Server type -> Snowflake type, both in upper case."""
    df = read_control(spark, name)
    missing = {"SQLServer", "Snowflake"} - set(df.columns)
    if missing:
        raise DatasetError("BAD_MAPPING", f"mapping lacks {', '.join(sorted(missing))}")
    return df.select(*[F.upper(F.trim(c)).alias(c) for c in ("SQLServer", "Snowflake")])
