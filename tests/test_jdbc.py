"""Texts and options handed to the JDBC reader; no database is opened."""

import pytest

from twinledger.model import SNOWFLAKE, SQLSERVER, DatasetError, RunConfig
from twinledger.plans.pair import pair_spec
from twinledger.sources import jdbc

SQL = jdbc.SqlServerConnection("host:1433", "u", "p")
SNOW = jdbc.SnowflakeConnection("acc", "wh", "u", "p")
REF = jdbc.JdbcRef(SQL, "DB", "DBO", "ORDERS", partition_column="ID", partitions=8)


def test_connections():
    assert SQL.jdbc_options("DB")["url"] == "jdbc:sqlserver://host:1433;databaseName=DB"
    assert SQL.jdbc_options("DB")["user"] == "u"
    login = jdbc.SqlServerConnection("host").jdbc_options(None)
    assert "integratedSecurity=true" in login["url"] and "user" not in login
    assert SNOW.jdbc_options("DB")["url"] == "jdbc:snowflake://acc.snowflakecomputing.com/?warehouse=wh&db=DB"
    assert "p'" not in repr(SQL) and "password" not in repr(SNOW)


def test_only_named_columns_are_read():
    assert jdbc.table_query(REF, ["ID", "QTY"]) == "SELECT ID, QTY FROM DB.DBO.ORDERS"
    assert jdbc.table_query(REF) == "SELECT * FROM DB.DBO.ORDERS"


def test_read_is_split_by_the_partition_column():
    assert jdbc.bounds_query(REF) == "SELECT MIN(ID) AS LO, MAX(ID) AS HI FROM DB.DBO.ORDERS"
    assert jdbc.split_options(REF, 1, 900) == {
        "partitionColumn": "ID", "lowerBound": "1", "upperBound": "900", "numPartitions": "8"}


def test_metadata_queries_quote_names():
    odd = jdbc.JdbcRef(SQL, "DB", "O'X", "T")
    assert "TABLE_SCHEMA = 'O''X'" in jdbc.columns_query(odd)
    assert "CONSTRAINT_TYPE = 'PRIMARY KEY'" in jdbc.primary_key_query(odd)
    assert jdbc.tables_query("DB", "DBO").endswith("WHERE TABLE_SCHEMA = 'DBO'")


def test_manifest_rows_become_database_references():
    row = dict.fromkeys(["SourceFilePath", "TargetFilePath", "SourceColumns", "TargetColumns"])
    row |= {f"{s}{p}": f"{p.upper()}" for s in ("Source", "Target") for p in ("DB", "Schema", "Table")}
    config = RunConfig(source_type=SQLSERVER, target_type=SNOWFLAKE, source_connection=SQL, target_connection=SNOW)
    spec = pair_spec({**row, "SourceKey": "A, b"}, config)
    assert spec.source == jdbc.JdbcRef(SQL, "DB", "SCHEMA", "TABLE", key=("A", "B"))
    assert (spec.source_system, spec.target_system, spec.declared_key) == (SQLSERVER, SNOWFLAKE, ("A", "B"))
    with pytest.raises(DatasetError):
        pair_spec(row, RunConfig(source_type=SQLSERVER))


def test_reads_are_split_by_a_key_column_with_an_order():
    types = {"CODE": "NVARCHAR", "ID": "BIGINT", "DAY": "DATE"}
    plain = jdbc.JdbcRef(SQL, "DB", "DBO", "ORDERS")
    assert jdbc.split_column(REF, types) == "ID"
    assert jdbc.split_column(plain, types, ["CODE", "ID"]) == "ID"
    assert jdbc.split_column(jdbc.JdbcRef(SQL, "DB", "DBO", "ORDERS", key=("DAY",)), types, ["ID"]) == "DAY"
    assert jdbc.split_column(plain, types, ["CODE"]) is None


def test_manifest_names_the_column_that_splits_a_read():
    row = dict.fromkeys(["SourceFilePath", "TargetFilePath", "SourceColumns", "TargetColumns"])
    row |= {f"{s}{p}": f"{p.upper()}" for s in ("Source", "Target") for p in ("DB", "Schema", "Table")}
    config = RunConfig(source_type=SQLSERVER, target_type=SNOWFLAKE, source_connection=SQL, target_connection=SNOW)
    spec = pair_spec({**row, "SourcePartitionColumn": "ID", "TargetPartitionColumn": "NR"}, config)
    assert (spec.source.partition_column, spec.target.partition_column) == ("ID", "NR")


def test_table_names_are_found_in_any_case(monkeypatch):
    monkeypatch.setattr(jdbc, "list_tables", lambda *a: ["ORDERS"])
    assert jdbc.table_exists(None, jdbc.JdbcRef(SQL, "DB", "DBO", "orders"))
