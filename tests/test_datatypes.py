import pytest

from twinledger.model import SNOWFLAKE, SPARK, SQLSERVER, ColumnPair
from twinledger.operators.datatypes import datatype_comparison, datatype_findings, datatype_verdict
from twinledger.sources.metadata import METADATA_SCHEMA, declared_metadata

CASES = [
    (SQLSERVER, SQLSERVER, ("VARCHAR", 50, 0, 0), ("VARCHAR", 50, 0, 0), [], "Pass"),
    (SQLSERVER, SQLSERVER, ("VARCHAR", 50, 0, 0), ("VARCHAR", 20, 0, 0), ["TRUNCATION"], "Pass"),
    (SQLSERVER, SQLSERVER, ("BIGINT", 0, 19, 10), ("INT", 0, 10, 10), ["TRUNCATION", "TYPE_MISMATCH"], "Fail"),
    (SQLSERVER, SQLSERVER, ("VARCHAR", 20, 0, 0), ("NVARCHAR", 20, 0, 0), ["TYPE_MISMATCH"], "Fail"),
    (SQLSERVER, SQLSERVER, ("VARCHAR", 50, 0, 0), ("VARCHAR", -1, 0, 0), [], "Pass"),
    (SQLSERVER, SQLSERVER, ("VARCHAR", -1, 0, 0), ("VARCHAR", 50, 0, 0), ["TRUNCATION"], "Pass"),
    (SNOWFLAKE, SNOWFLAKE, ("NUMBER", 0, 38, 10), ("NUMBER", 0, 10, 10), ["TRUNCATION"], "Pass"),
    (SNOWFLAKE, SNOWFLAKE, ("TEXT", 10, 0, 0), ("NUMBER", 0, 38, 10), ["TYPE_MISMATCH"], "Fail"),
    (SQLSERVER, SNOWFLAKE, ("INT", 0, 10, 10), ("NUMBER", 0, 38, 10), [], "Pass"),
    (SQLSERVER, SNOWFLAKE, ("FLOAT", 0, 53, 2), ("FLOAT", 0, 0, 0), [], "Pass"),
    (SNOWFLAKE, SQLSERVER, ("FLOAT", 0, 0, 0), ("FLOAT", 0, 53, 2), [], "Pass"),
    (SNOWFLAKE, SQLSERVER, ("FLOAT", 0, 0, 0), ("REAL", 0, 24, 2), ["TRUNCATION"], "Pass"),
    (SQLSERVER, SNOWFLAKE, ("XML", 0, 0, 0), ("TEXT", 10, 0, 0), ["TYPE_UNMAPPED"], "Fail"),
    (SNOWFLAKE, SQLSERVER, ("TEXT", 10, 0, 0), ("XML", 0, 0, 0), ["TYPE_UNMAPPED"], "Fail"),
    (SQLSERVER, SQLSERVER, ("XML", 0, 0, 0), ("XML", 0, 0, 0), ["TYPE_UNMAPPED"], "Fail"),
    (SPARK, SQLSERVER, ("STRING", -1, 0, 0), ("NVARCHAR", -1, 0, 0), [], "Pass"),
    (SQLSERVER, SPARK, ("DATETIME2", 0, 0, 0), ("TIMESTAMP", 0, 0, 0), [], "Pass"),
    (SPARK, SPARK, ("BIGINT", 0, 19, 10), ("INT", 0, 10, 10), ["TRUNCATION", "TYPE_MISMATCH"], "Fail"),
]


def test_every_direction(spark):
    mapping = spark.createDataFrame([("int", "number"), ("FLOAT", "FLOAT"), ("REAL", "FLOAT")], "SQLServer string, Snowflake string")
    for s_sys, t_sys in dict.fromkeys((c[0], c[1]) for c in CASES):
        cases = [c for c in CASES if (c[0], c[1]) == (s_sys, t_sys)]
        rows = lambda k: [(i, f"{'ab'[k - 2]}{i}", *c[k]) for i, c in enumerate(cases)]  # noqa: E731,B023
        src, tgt = (spark.createDataFrame(rows(k), METADATA_SCHEMA) for k in (2, 3))
        pairs = [ColumnPair(f"A{i}", f"B{i}") for i in range(len(cases))]
        compared = datatype_comparison(src, tgt, pairs, s_sys, t_sys, mapping)
        got = {}
        for r in datatype_findings(compared).collect():
            got.setdefault(r["ordinal"], []).append(r["code"])
        for i, c in enumerate(cases):
            assert sorted(got.get(i, [])) == c[4], c
        failed = any(c[5] == "Fail" for c in cases)
        assert datatype_verdict(compared).first()["result"] == ("Fail" if failed else "Pass")


@pytest.mark.parametrize("ddl,want", [
    ("a varchar(20)", ("VARCHAR", 20, 0, 0)),
    ("a string", ("STRING", -1, 0, 0)),
    ("a decimal(12,2)", ("DECIMAL", 0, 12, 10)),
    ("a int", ("INT", 0, 10, 10)),
    ("a timestamp_ntz", ("TIMESTAMP_NTZ", 0, 0, 0)),
])
def test_metadata_of_spark_columns(spark, ddl, want):
    spark.sql("drop table if exists tl_meta")
    spark.sql(f"create table tl_meta ({ddl}) using parquet")
    row = declared_metadata(spark.table("tl_meta")).first()
    got = (row["data_type"], row["char_len"], row["num_precision"], row["num_radix"])
    # a varchar column of a table loads as string and keeps its length aside
    assert got == want or (want[0] == "VARCHAR" and got == ("STRING", *want[1:]))
