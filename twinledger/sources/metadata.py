"""Declared types and lengths of columns as a frame.

Columns: ordinal, column_name, data_type, char_len, num_precision, num_radix.
A char_len of -1 is unbounded, 0 says that the type has no such length.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinledger.functions import values as V
from twinledger.model import SNOWFLAKE, SPARK, SQLSERVER

METADATA_SCHEMA = (
    "ordinal int, column_name string, data_type string, char_len int, num_precision int, num_radix int"
)

# The type name that a Spark type goes by in each system.
TYPE_NAMES = {
    T.ByteType: ("TINYINT", "TINYINT", "NUMBER"),
    T.ShortType: ("SMALLINT", "SMALLINT", "NUMBER"),
    T.IntegerType: ("INT", "INT", "NUMBER"),
    T.LongType: ("BIGINT", "BIGINT", "NUMBER"),
    T.DecimalType: ("DECIMAL", "DECIMAL", "NUMBER"),
    T.BooleanType: ("BOOLEAN", "BIT", "BOOLEAN"),
    T.FloatType: ("FLOAT", "REAL", "FLOAT"),
    T.DoubleType: ("DOUBLE", "FLOAT", "FLOAT"),
    T.StringType: ("STRING", "VARCHAR", "TEXT"),
    T.CharType: ("CHAR", "CHAR", "TEXT"),
    T.VarcharType: ("VARCHAR", "VARCHAR", "TEXT"),
    T.BinaryType: ("BINARY", "VARBINARY", "BINARY"),
    T.DateType: ("DATE", "DATE", "DATE"),
    T.TimeType: ("TIME", "TIME", "TIME"),
    T.TimestampType: ("TIMESTAMP", "DATETIME2", "TIMESTAMP_TZ"),
    T.TimestampNTZType: ("TIMESTAMP_NTZ", "DATETIME2", "TIMESTAMP_NTZ"),
    T.ArrayType: ("ARRAY", "ARRAY", "ARRAY"),
    T.StructType: ("STRUCT", "STRUCT", "OBJECT"),
    T.MapType: ("MAP", "MAP", "OBJECT"),
}
SYSTEM_POSITION = {SPARK: 0, SQLSERVER: 1, SNOWFLAKE: 2}
# Fixed values: (precision, radix) of the binary and integral types.
NUMBER_LENGTHS = {
    T.ByteType: (3, 10),
    T.ShortType: (5, 10),
    T.IntegerType: (10, 10),
    T.LongType: (19, 10),
    T.FloatType: (24, 2),
    T.DoubleType: (53, 2),
}


def type_name(dtype: T.DataType, system: str = SPARK) -> str:
    names = TYPE_NAMES.get(type(dtype))
    return names[SYSTEM_POSITION[system]] if names else dtype.simpleString().upper()


def _lengths(field: T.StructField):
    dtype = field.dataType
    if isinstance(dtype, T.DecimalType):
        return 0, dtype.precision, 10
    if type(dtype) in NUMBER_LENGTHS:
        return (0, *NUMBER_LENGTHS[type(dtype)])
    if isinstance(dtype, (T.CharType, T.VarcharType)):
        return dtype.length, 0, 0
    if isinstance(dtype, T.StringType):
        # char(n) / varchar(n) columns of tables load as string and keep the
        # declared form beside it
        declared = (field.metadata or {}).get("__CHAR_VARCHAR_TYPE_STRING", "")
        m = re.search(r"\((\d+)\)", declared)
        return (int(m.group(1)) if m else -1), 0, 0
    return 0, 0, 0


def declared_metadata(df: DataFrame, system: str = SPARK) -> DataFrame:
    """Metadata from the schema alone; no row is read."""
    rows = [(i, f.name, type_name(f.dataType, system), *_lengths(f)) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, METADATA_SCHEMA)


def observed_metadata(df: DataFrame, system: str = SPARK) -> DataFrame:
    """Metadata in which a text column without a declared length has the
    length of its longest value: one aggregate over the table."""
    fields = df.schema.fields
    open_text = [f.name for f in fields if isinstance(f.dataType, V.TEXTUAL) and _lengths(f)[0] < 0]
    longest = {n: F.coalesce(F.max(F.char_length(F.col(V.quoted(n)))), F.lit(0)) for n in open_text}
    wide = df.agg(F.lit(0).alias("__none"), *[agg.alias(n) for n, agg in longest.items()])
    rows = []
    for i, f in enumerate(fields):
        chars, precision, radix = _lengths(f)
        chars = F.col(V.quoted(f.name)) if f.name in longest else F.lit(chars)
        rows.append(F.struct(
            F.lit(i).alias("ordinal"), F.lit(f.name).alias("column_name"),
            F.lit(type_name(f.dataType, system)).alias("data_type"), chars.cast("int").alias("char_len"),
            F.lit(precision).alias("num_precision"), F.lit(radix).alias("num_radix"),
        ))
    return wide.select(F.inline(F.array(*rows)))
