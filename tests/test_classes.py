from twinledger.functions import values as V
from twinledger.operators import classes as C


def classes_of(spark, src, tgt, key=()):
    a, b = C.collect_facts(src, tgt, src.columns)
    return C.infer_classes(src.schema, tgt.schema, a, b, key), a, b


def test_one_boolean_side_is_enough(spark):
    src = spark.createDataFrame([("yes", 3), ("no", 1)], "a string, b int")
    tgt = spark.createDataFrame([("true", 1), ("0", 0)], "a string, b int")
    got, _, _ = classes_of(spark, src, tgt)
    assert got["a"].kind == "boolean" and got["b"].kind == "boolean"


def test_side_without_values_counts_as_boolean(spark):
    src = spark.createDataFrame([(10, "x")], "a int, b string")
    tgt = spark.createDataFrame([(None, None)], "a int, b string")
    got, s, t = classes_of(spark, src, tgt)
    assert got["a"].kind == got["b"].kind == "boolean"
    assert (s.columns["a"].values, t.columns["a"].values) == (1, 0)


def test_key_is_never_boolean(spark):
    src = spark.createDataFrame([("1",), ("0",)], "k string")
    got, _, _ = classes_of(spark, src, src, key=["k"])
    assert got["k"].kind == "numeric"


def test_numeric_needs_both_sides(spark):
    src = spark.createDataFrame([("1", "2"), ("3", "x")], "a string, b string")
    tgt = spark.createDataFrame([(1.0, 2), (4.0, 5)], "a double, b int")
    got, _, _ = classes_of(spark, src, tgt)
    assert got["a"].kind == "numeric" and got["a"].number == "double"
    assert got["b"].kind == "string"


def test_number_types(spark):
    src = spark.createDataFrame([(5, "1.50", "12345678901234567890123")], "a int, b string, c string")
    tgt = spark.createDataFrame([(6, "2", "3")], "a long, b string, c string")
    got, _, _ = classes_of(spark, src, tgt)
    assert got["a"].number == "bigint"
    assert got["b"].number == "decimal(2,1)"
    assert got["c"].number == "decimal(23,0)"


def test_exact_numbers_of_any_length_stay_exact(spark):
    src = spark.createDataFrame([("1" * 30, "5", "1.5e0")], "a string, b string, c string")
    tgt = spark.createDataFrame([("0." + "1" * 30, "2", "9007199254740993")], "a string, b string, c string")
    got, _, _ = classes_of(spark, src, tgt)
    assert [got[c].number for c in "abc"] == [V.DIGITS, "decimal(1,0)", V.DIGITS]
    wide = spark.sql("select cast(5 as decimal(38,2)) a, cast(5 as decimal(38,30)) b, 1.5D c")
    assert classes_of(spark, wide, spark.sql("select '7' a, '7' b, '7' c"))[0]["a"].number == "decimal(38,2)"
    assert classes_of(spark, wide, src)[0]["a"].number == "decimal(38,2)"
    assert classes_of(spark, wide, spark.sql("select '7' a, cast(7 as decimal(38,0)) b, '7' c"))[0]["b"].number == V.DIGITS
    assert classes_of(spark, wide, spark.sql("select '7' a, '7' b, '7' c"))[0]["c"].number == "double"


def test_dates_of_different_layouts(spark):
    src = spark.createDataFrame([("2024-01-31", "01/02/2024"), ("2024-02-01", "13/02/2024")], "a string, b string")
    tgt = spark.createDataFrame([("01/31/2024", "2024-02-01"), ("02/01/2024", "2024-02-13")], "a string, b string")
    got, _, _ = classes_of(spark, src, tgt)
    assert (got["a"].source_format, got["a"].target_format) == ("yyyy-MM-dd", "MM/dd/yyyy")
    # no single month-first reading fits 13/02, so the column is day first
    assert (got["b"].source_format, got["b"].target_format) == ("dd/MM/yyyy", "yyyy-MM-dd")


def test_mixed_layouts_are_text(spark):
    src = spark.createDataFrame([("2024-01-31",), ("01/31/2024",)], "a string")
    got, _, _ = classes_of(spark, src, src)
    assert got["a"].kind == "string"


def test_integers_are_never_dates(spark):
    src = spark.createDataFrame([(20240131,), (20240201,)], "a int")
    tgt = spark.createDataFrame([("2024-01-31",)], "a string")
    assert classes_of(spark, src, tgt)[0]["a"].kind == "string"


def test_nested_columns_are_compared_as_they_are(spark):
    src = spark.createDataFrame([([1.0, 2.0], 1)], "a array<double>, b int")
    assert classes_of(spark, src, src)[0]["a"].kind == "nested"


def test_layouts_are_told_apart_only_for_date_like_columns(spark):
    src = spark.createDataFrame([("2024-01-31", "free text")], "d string, t string")
    _, s, _ = classes_of(spark, src, src)
    assert s.columns["d"].not_date["yyyy-MM-dd"] == 0 and s.columns["d"].not_date["MM/dd/yyyy"] == 1
    assert s.columns["t"].not_date == {}
