"""Appending report rows to files, tables and databases."""

from __future__ import annotations

from pyspark.sql import DataFrame

from twinledger.model import DatasetError, RunConfig
from twinledger.sinks.ledger import append_once

CSV_OPTIONS = {"header": True, "quote": '"', "escape": '"', "encoding": "UTF-8"}


def append_csv(rows: DataFrame, path: str) -> None:
    """A folder of CSV parts, each with a header, quoted where needed."""
    rows.write.mode("append").options(**CSV_OPTIONS).csv(path)


def append_parquet(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def append_table(rows: DataFrame, table: str) -> None:
    """Created on first use."""
    rows.write.mode("append").saveAsTable(table)


def append_jdbc(rows: DataFrame, connection, database: str, table: str) -> None:
    """Created on first use; values are bound, so quotes need no escaping."""
    rows.write.format("jdbc").mode("append").options(**connection.jdbc_options(database)).option("dbtable", table).save()


def write_report(rows: DataFrame, config: RunConfig, once: str | None = None) -> None:
    """Append to the output that the configuration names.

    With a name in ``once`` a folder of files takes the rows under that name only once, however often
    they are written. A table or a database cannot tell: there a run that ends between
    the append and its mark in the ledger appends the rows of that one pair again.
    """
    kind = config.output_type
    if once and kind in ("CSV", "PARQUET") and config.output_path:
        append_once(rows, config.output_path, once, kind, CSV_OPTIONS if kind == "CSV" else {})
        return
    if kind == "CSV" and config.output_path:
        append_csv(rows, config.output_path)
    elif kind == "PARQUET" and config.output_path:
        append_parquet(rows, config.output_path)
    elif kind == "TABLE" and config.output_table:
        append_table(rows, config.output_table)
    elif kind in ("SQLSERVER", "SNOWFLAKE") and config.output_connection and config.output_table:
        database, _, table = config.output_table.partition(".")
        append_jdbc(rows, config.output_connection, database, table)
    else:
        raise DatasetError("BAD_CONFIG", f"output {kind} lacks its path, table or connection")
