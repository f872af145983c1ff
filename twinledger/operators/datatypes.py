"""Declared types and lengths of the two sides."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinledger.model import SNOWFLAKE, SPARK, SQLSERVER

# SQL Server type -> family.
SQLSERVER_FAMILIES = {
    "TINYINT": "NUMERICS",
    "SMALLINT": "NUMERICS",
    "INT": "NUMERICS",
    "BIGINT": "NUMERICS",
    "SMALLMONEY": "NUMERICS",
    "MONEY": "NUMERICS",
    "DECIMAL": "NUMERICS",
    "NUMERIC": "NUMERICS",
    "BIT": "NUMERICS",
    "REAL": "APP_NUMERICS",
    "FLOAT": "APP_NUMERICS",
    "CHAR": "CHAR_STR",
    "VARCHAR": "CHAR_STR",
    "TEXT": "CHAR_STR",
    "NCHAR": "UNICODE_CHAR_STR",
    "NVARCHAR": "UNICODE_CHAR_STR",
    "NTEXT": "UNICODE_CHAR_STR",
    "BINARY": "BINARY_FAM",
    "VARBINARY": "BINARY_FAM",
    "IMAGE": "BINARY_FAM",
    "DATE": "DATE",
    "TIME": "TIME",
    "DATETIME2": "DATETIME2",
    "DATETIMEOFFSET": "DATETIME2",
    "DATETIME": "DATETIME",
    "SMALLDATETIME": "DATETIME",
}
# Spark and Snowflake names that occur when a side is a Spark dataset; such a
# pair knows one text family and one timestamp family.
OTHER_FAMILIES = {
    "BOOLEAN": "NUMERICS",
    "NUMBER": "NUMERICS",
    "DOUBLE": "APP_NUMERICS",
    "STRING": "CHAR_STR",
    "TIMESTAMP": "DATETIME",
    "TIMESTAMP_NTZ": "DATETIME",
    "TIMESTAMP_LTZ": "DATETIME",
    "TIMESTAMP_TZ": "DATETIME",
    "ARRAY": "ARRAY",
    "STRUCT": "STRUCT",
    "OBJECT": "STRUCT",
}
MERGED = {"UNICODE_CHAR_STR": "CHAR_STR", "DATETIME2": "DATETIME"}
RELAXED_FAMILIES = {
    name: MERGED.get(family, family) for name, family in {**SQLSERVER_FAMILIES, **OTHER_FAMILIES}.items()
}
LENGTH_COLUMNS = ("char_len", "num_precision", "num_radix")
FLOAT_LENGTHS = (0, 53, 2)


def _lookup(table: dict, c: str) -> str:
    pairs = ", ".join(f"'{name}', '{family}'" for name, family in table.items())
    return f"try_element_at(map({pairs}), {c})"


def _meta(meta: DataFrame, side: str) -> DataFrame:
    lengths = [f"coalesce({c}, 0) as {side}_{c}" for c in ("char_len", "num_precision", "num_radix")]
    return meta.selectExpr(f"upper(column_name) as {side}_column", f"upper(data_type) as {side}_type", *lengths)


def datatype_comparison(src_meta: DataFrame, tgt_meta: DataFrame, pairs, source_system=SPARK,
                        target_system=SPARK, mapping: DataFrame | None = None) -> DataFrame:
    """One row per column pair: types, the forms compared and the verdict flags.

    The frames are control data of as many rows as there are columns, so the
    planner broadcasts them by their size.
    """
    spark = src_meta.sparkSession
    rows = [(i, p.source.upper(), p.target.upper()) for i, p in enumerate(pairs)]
    out = (
        spark.createDataFrame(rows, "ordinal int, source_column string, target_column string")
        .join(_meta(src_meta, "source"), "source_column", "left")
        .join(_meta(tgt_meta, "target"), "target_column", "left")
    )
    systems = (source_system, target_system)
    names_matter = False
    compared = {"source": "source_type", "target": "target_type"}
    forced = None
    if SPARK in systems or systems == (SQLSERVER, SQLSERVER):
        names_matter = source_system == target_system
        families = RELAXED_FAMILIES if SPARK in systems else SQLSERVER_FAMILIES
        compared = {side: _lookup(families, f"{side}_type") for side in compared}
    elif systems != (SNOWFLAKE, SNOWFLAKE):
        mapped, forced = ("source", "target") if source_system == SQLSERVER else ("target", "source")
        if mapping is None:  # every type is unmapped then
            mapping = spark.createDataFrame([], "SQLServer string, Snowflake string")
        names = mapping.selectExpr(f"upper(SQLServer) as {mapped}_type", "upper(Snowflake) as mapped_type")
        out = out.join(names.groupBy(f"{mapped}_type").agg(F.max("mapped_type").alias("mapped_type")),
                       f"{mapped}_type", "left")
        compared[mapped] = "mapped_type"

    def length(side, position):
        c = f"{side}_{LENGTH_COLUMNS[position]}"
        if side == forced:
            c = f"if({side}_type = 'FLOAT', {FLOAT_LENGTHS[position]}, {c})"
        return f"if({c} < 0, 2147483647, {c})"  # -1 is unbounded

    longer = " or ".join(f"{length('source', i)} > {length('target', i)}" for i in range(3))
    renamed = "source_type <> target_type" if names_matter else "false"
    return (
        out.selectExpr("*", f"{compared['source']} as source_as", f"{compared['target']} as target_as")
        .selectExpr("*", f"coalesce(source_as = target_as and ({longer}), false) as truncation")
        .selectExpr(
            "ordinal", "source_column", "target_column", "source_type", "target_type",
            "source_as is null or target_as is null as unmapped",
            f"coalesce(source_as <> target_as, false) or (truncation and {renamed}) as mismatch",
            "truncation",
        )
    )


def datatype_findings(comparison: DataFrame) -> DataFrame:
    """(ordinal, source_column, target_column, code): a row per finding."""
    codes = ("array_compact(array(if(unmapped, 'TYPE_UNMAPPED', null), if(mismatch, 'TYPE_MISMATCH', null), "
             "if(truncation, 'TRUNCATION', null)))")
    return comparison.selectExpr("ordinal", "source_column", "target_column", "source_type", "target_type",
                                 f"explode({codes}) as code")


def datatype_verdict(comparison: DataFrame) -> DataFrame:
    """Truncation alone is a warning and passes."""
    return comparison.selectExpr(
        "count_if(unmapped) as unmapped", "count_if(mismatch) as mismatched", "count_if(truncation) as truncated",
    ).selectExpr("*", "if(unmapped + mismatched = 0, 'Pass', 'Fail') as result")
