import decimal
import fractions

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinledger.functions import values as V

S = T.StringType()


def texts(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")


def column(df, expression):
    return [r[0] for r in df.orderBy("i").selectExpr(expression).collect()]


def test_boolean_literals_in_any_spelling(spark):
    df = texts(spark, ["1", "0", "True", "FALSE", "yes", None, "1.0"])
    assert column(df, V.is_boolean_literal("v", S)) == [True, True, True, True, False, None, False]
    assert column(df, V.as_boolean_text("v", S)) == ["true", "false", "true", "false", "yes", None, "true"]


def test_float_one_is_true(spark):
    df = spark.createDataFrame([(0, 1.0), (1, 0.0), (2, 2.5)], "i int, v double")
    assert column(df, V.as_boolean_text("v", T.DoubleType())) == ["true", "false", "2.5"]
    assert column(df, V.is_boolean_literal("v", T.DoubleType())) == [True, True, False]


def test_numbers(spark):
    df = texts(spark, [" 12 ", "1e3", "-.5", "12d", "0x1F", "abc", "", None, "7."])
    assert column(df, V.is_number("v", S)) == [True, True, True, False, False, False, False, None, True]
    assert column(df, V.as_number("v", S, "double")) == [12.0, 1000.0, -0.5, None, None, None, None, None, 7.0]


def test_exact_numbers_keep_long_integers(spark):
    df = texts(spark, ["9007199254740993", "9007199254740992.0"])
    assert column(df, V.is_plain_number("v")) == [True, True]
    shown = df.selectExpr("i", V.as_number("v", S, "decimal(17,1)") + " as v")
    assert column(shown, V.render("v", T.DecimalType(17, 1))) == ["9007199254740993", "9007199254740992"]


def test_digits_of_a_number_are_counted(spark):
    df = texts(spark, ["0012.3400", "-.5", "7.", "0", "1e3", "x"])
    assert column(df, V.is_plain_number("v")) == [True, True, True, True, False, False]
    assert column(df.limit(4), V.whole_digits("v")) == [2, 0, 1, 0]
    assert column(df.limit(4), V.fraction_digits("v")) == [2, 1, 0, 0]


def exact(text):
    """Value of a number's text, told apart from every other value."""
    d = decimal.Decimal(text.strip())
    return fractions.Fraction(d) if abs(d.adjusted()) < 500 else d.normalize()


def test_digits_as_text_are_equal_where_values_are(spark):
    values = ["0", "-0.0", "00", ".0", "1", "1.0", "+1", "01.000", "1e0", "10e-1", "0.1e1", "100", "1e2", "1E+2", "-1", "-1.0", "0.001", "1e-3", "12345678901234567890123.45",
              "12345678901234567890123.46", "1234567890123456789012345e-2", "9007199254740993", "9007199254740992", "9.007199254740993e15", "1e300", "10e299", "1e-300", "1" + "0" * 60, "1e60",
              " 7 ", "7.", "-.5", "-5e-1", "123456789" * 6, "123456789" * 6 + ".0"]
    df = texts(spark, values)
    got = column(df, V.as_number("v", S, V.DIGITS))
    with decimal.localcontext(decimal.Context(prec=2000, Emax=10**6, Emin=-(10**6))):
        for a, x in zip(values, got):
            for b, y in zip(values, got):
                assert (exact(a) == exact(b)) == (x == y), (a, b, x, y)
        assert all(exact(a) == exact(x) for a, x in zip(values, got))
    typed = spark.sql("select 0 as i, cast('12345678901234567890123.45' as decimal(38,2)) as v, 9007199254740993L as l")
    assert column(typed, V.as_number("v", T.DecimalType(38, 2), V.DIGITS)) == ["12345678901234567890123.45"]
    assert column(typed, V.as_number("l", T.LongType(), V.DIGITS)) == ["9007199254740993"]


@pytest.mark.parametrize("text", ["2024-03-09T07:08:05.000", "2024-03-09T07:08:05.000Z", "2024-03-09 07:08:05.0", "2024-03-09 07:08:05.123456789", "2024-03-09 09:08:05+02:00",
                                  "2024-03-09T09:08:05+0200", "2024-03-09T09:08:05.5+02", "2024-03-09 07:08"])
def test_dates_as_databases_write_them(spark, text):
    df = texts(spark, [text])
    assert column(df, V.fits_some_layout("v", V.DATE_FORMATS)) == [True]
    fits = [x for f in V.DATE_FORMATS if (x := column(df, V.as_timestamp("v", S, f))[0]) is not None]
    assert len(fits) == 1 and fits[0].strftime("%Y-%m-%d %H:%M") == "2024-03-09 07:08"


def test_number_texts_are_boolean_by_value(spark):
    df = texts(spark, ["1.0", "0.0", "1e0", "01", "1.0000000000000000001", "2", "-0"])
    assert column(df, V.as_boolean_text("v", S)) == ["true", "false", "true", "true", "1.0000000000000000001", "2", "false"]


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(0, float("nan")), (1, 1.5), (2, None)], "i int, v double")
    assert column(df, V.missing_to_null("v", T.DoubleType())) == [None, 1.5, None]


def test_every_layout_reads_its_own_dates(spark):
    df = spark.createDataFrame([(0, "2024-03-09 07:08:05")], "i int, v string").withColumn("t", F.col("v").cast("timestamp_ntz"))
    for fmt in V.DATE_FORMATS:
        text = df.withColumn("v", F.date_format("t", fmt))
        assert column(text, V.fits_some_layout("v", V.DATE_FORMATS)) == [True], fmt
        assert column(text, V.as_timestamp("v", S, fmt))[0].strftime("%Y-%m-%d") == "2024-03-09", fmt


def test_texts_that_are_no_dates(spark):
    df = texts(spark, ["2024-13-01", "20240101", "x2024-01-01", "01/32/2024", None])
    assert column(df, V.as_timestamp("v", S, "yyyy-MM-dd")) == [None] * 5
    assert column(df, V.as_timestamp("v", S, "MM/dd/yyyy")) == [None] * 5
    assert column(df, V.fits_some_layout("v", V.DATE_FORMATS)) == [True, False, False, True, None]


def test_display_names(spark):
    names = ["ORDER_ID", "order", "a__b", "QTY_ON_HAND"]
    df = texts(spark, names)
    want = ["Order_Id", "Order", "A__B", "Qty_On_Hand"]
    assert [V.display_name(n) for n in names] == want
    assert column(df, V.display_name_of("v")) == want


def test_quotes_in_literals(spark):
    df = texts(spark, ["it's", "a\\b"])
    assert column(df, f"v = {V.text_literal(chr(39).join(['it', 's']))}") == [True, False]
    assert column(df, f"v = {V.text_literal('a' + chr(92) + 'b')}") == [False, True]


def test_maps_are_found_at_any_depth():
    inner = T.ArrayType(T.StructType([T.StructField("m", T.MapType(S, S))]))
    assert not V.is_comparable(inner)
    assert not V.is_comparable(T.VariantType())
    assert V.is_comparable(T.ArrayType(S))
