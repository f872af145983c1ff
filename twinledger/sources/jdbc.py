"""SQL Server and Snowflake tables through Spark's JDBC reader.

The driver jar is the user's.  Metadata questions are pushed to the database
as queries; table reads are split over executors by a numeric column.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinledger.model import SNOWFLAKE, SQLSERVER, DatasetError
from twinledger.sources.files import upper_header


@dataclass(frozen=True)
class SqlServerConnection:
    """Password login, or integrated login when user and password are empty."""

    server_name: str
    username: str = ""
    password: str = field(default="", repr=False)
    options: dict = field(default_factory=dict, hash=False)
    system = SQLSERVER

    def jdbc_options(self, database: str | None) -> dict:
        url = f"jdbc:sqlserver://{self.server_name}"
        if database:
            url += f";databaseName={database}"
        out = {"driver": "com.microsoft.sqlserver.jdbc.SQLServerDriver"}
        if self.username and self.password:
            out |= {"user": self.username, "password": self.password}
        else:
            url += ";integratedSecurity=true"
        return {"url": url, **out, **self.options}


@dataclass(frozen=True)
class SnowflakeConnection:
    account: str
    warehouse: str
    username: str
    password: str = field(repr=False)
    options: dict = field(default_factory=dict, hash=False)
    system = SNOWFLAKE

    def jdbc_options(self, database: str | None) -> dict:
        url = f"jdbc:snowflake://{self.account}.snowflakecomputing.com/?warehouse={self.warehouse}"
        if database:
            url += f"&db={database}"
        return {
            "url": url, "driver": "net.snowflake.client.jdbc.SnowflakeDriver",
            "user": self.username, "password": self.password, **self.options,
        }


@dataclass(frozen=True)
class JdbcRef:
    connection: object
    database: str
    schema: str
    table: str
    partition_column: str | None = None
    partitions: int = 64
    fetch_size: int = 10_000
    key: tuple = ()  # the key named in the manifest

    @property
    def label(self) -> str:
        return self.table

    @property
    def full_name(self) -> str:
        return f"{self.database}.{self.schema}.{self.table}"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def table_query(ref: JdbcRef, columns=None) -> str:
    return f"SELECT {', '.join(columns) if columns else '*'} FROM {ref.full_name}"


def bounds_query(ref: JdbcRef) -> str:
    c = ref.partition_column
    return f"SELECT MIN({c}) AS LO, MAX({c}) AS HI FROM {ref.full_name}"


def columns_query(ref: JdbcRef) -> str:
    """Type name and the length triple of every column."""
    return (
        "SELECT UPPER(COLUMN_NAME) AS COLUMN_NAME, UPPER(DATA_TYPE) AS DATA_TYPE, ORDINAL_POSITION, "
        "CHARACTER_MAXIMUM_LENGTH, NUMERIC_PRECISION, NUMERIC_PRECISION_RADIX "
        f"FROM {ref.database}.INFORMATION_SCHEMA.COLUMNS "
        f"WHERE TABLE_NAME = {_text(ref.table)} AND TABLE_SCHEMA = {_text(ref.schema)}"
    )


def tables_query(database: str, schema: str) -> str:
    return (
        f"SELECT UPPER(TABLE_NAME) AS TABLE_NAME FROM {database}.INFORMATION_SCHEMA.TABLES "
        f"WHERE TABLE_SCHEMA = {_text(schema)}"
    )


def primary_key_query(ref: JdbcRef) -> str:
    """Columns of the declared primary key, in key order (SQL Server)."""
    return (
        "SELECT UPPER(k.COLUMN_NAME) AS COLUMN_NAME, k.ORDINAL_POSITION "
        f"FROM {ref.database}.INFORMATION_SCHEMA.KEY_COLUMN_USAGE k "
        f"INNER JOIN {ref.database}.INFORMATION_SCHEMA.TABLE_CONSTRAINTS c "
        "ON c.CONSTRAINT_NAME = k.CONSTRAINT_NAME AND c.TABLE_SCHEMA = k.TABLE_SCHEMA "
        f"WHERE c.CONSTRAINT_TYPE = 'PRIMARY KEY' AND k.TABLE_NAME = {_text(ref.table)} "
        f"AND k.TABLE_SCHEMA = {_text(ref.schema)}"
    )


def run_query(spark: SparkSession, connection, database: str | None, query: str) -> DataFrame:
    return spark.read.format("jdbc").options(**connection.jdbc_options(database)).option("query", query).load()


# Types whose values a read may be split by.
SPLIT_TYPES = ("TINYINT", "SMALLINT", "INT", "BIGINT", "DECIMAL", "NUMERIC", "NUMBER", "DATE", "DATETIME", "DATETIME2",
               "SMALLDATETIME", "TIMESTAMP_NTZ")


def split_column(ref: JdbcRef, types: dict, key=()) -> str | None:
    """The column that a read is split by: the one named, else the first of
    the key whose type has an order that the database can cut."""
    if ref.partition_column:
        return ref.partition_column
    return next((c for c in (*ref.key, *key) if types.get(c.upper()) in SPLIT_TYPES), None)


def split_options(ref: JdbcRef, low, high) -> dict:
    return {
        "partitionColumn": ref.partition_column, "lowerBound": str(low), "upperBound": str(high),
        "numPartitions": str(ref.partitions),
    }


def read_jdbc(spark: SparkSession, ref: JdbcRef, columns=None) -> DataFrame:
    reader = (
        spark.read.format("jdbc")
        .options(**ref.connection.jdbc_options(ref.database))
        .option("fetchsize", ref.fetch_size)
        .option("dbtable", f"({table_query(ref, columns)}) t")
    )
    if not ref.partition_column:
        types = {r["column_name"]: r["data_type"] for r in column_metadata(spark, ref).collect()}
        ref = replace(ref, partition_column=split_column(ref, types, declared_key(spark, ref)))
    if ref.partition_column:
        row = run_query(spark, ref.connection, ref.database, bounds_query(ref)).first()
        if row["LO"] is not None:
            reader = reader.options(**split_options(ref, row["LO"], row["HI"]))
    return upper_header(reader.load())


def list_tables(spark: SparkSession, connection, database: str, schema: str):
    rows = run_query(spark, connection, database, tables_query(database, schema)).collect()
    return sorted(r["TABLE_NAME"] for r in rows)


def table_exists(spark: SparkSession, ref: JdbcRef) -> bool:
    return ref.table.upper() in list_tables(spark, ref.connection, ref.database, ref.schema)


def column_metadata(spark: SparkSession, ref: JdbcRef) -> DataFrame:
    raw = run_query(spark, ref.connection, ref.database, columns_query(ref))
    whole = lambda c: F.coalesce(F.col(c).cast("int"), F.lit(0))
    return raw.select(
        F.col("ORDINAL_POSITION").cast("int").alias("ordinal"),
        F.col("COLUMN_NAME").alias("column_name"),
        F.col("DATA_TYPE").alias("data_type"),
        whole("CHARACTER_MAXIMUM_LENGTH").alias("char_len"),
        whole("NUMERIC_PRECISION").alias("num_precision"),
        whole("NUMERIC_PRECISION_RADIX").alias("num_radix"),
    )


def list_columns(spark: SparkSession, ref: JdbcRef):
    rows = run_query(spark, ref.connection, ref.database, columns_query(ref)).collect()
    return [r["COLUMN_NAME"] for r in sorted(rows, key=lambda r: r["ORDINAL_POSITION"])]


def declared_key(spark: SparkSession, ref: JdbcRef):
    """Declared primary key.  Snowflake shows keys only through a SHOW command,
    which no sub-query can hold: there the key is named in the manifest."""
    if ref.connection.system != SQLSERVER:
        return []
    rows = run_query(spark, ref.connection, ref.database, primary_key_query(ref)).collect()
    return [r["COLUMN_NAME"] for r in sorted(rows, key=lambda r: r["ORDINAL_POSITION"])]


def require_connection(connection, side: str):
    if connection is None:
        raise DatasetError("NO_CONNECTION", f"{side} has a database type but no connection")
    return connection
