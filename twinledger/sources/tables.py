"""Catalog tables and views of the Spark session."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from twinledger.model import DatasetError
from twinledger.sources.files import upper_header


@dataclass(frozen=True)
class TableRef:
    table: str
    schema: str | None = None
    database: str | None = None

    @property
    def name(self) -> str:
        return ".".join(f"`{p}`" for p in (self.database, self.schema, self.table) if p)

    @property
    def label(self) -> str:
        return self.table


def table_exists(spark: SparkSession, ref: TableRef) -> bool:
    return spark.catalog.tableExists(ref.name)


def list_tables(spark: SparkSession, schema: str | None = None):
    return sorted(t.name.upper() for t in spark.catalog.listTables(schema))


def list_columns(spark: SparkSession, ref: TableRef):
    return [c.upper() for c in spark.table(ref.name).columns]


def read_table(spark: SparkSession, ref: TableRef) -> DataFrame:
    if not table_exists(spark, ref):
        raise DatasetError("TABLE_NOT_FOUND", ref.name)
    return upper_header(spark.table(ref.name))
