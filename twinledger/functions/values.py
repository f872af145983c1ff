"""Expressions that bring two sides to comparable values.

Everything here is a built-in expression: no Python runs on the rows.
"""

from __future__ import annotations

import re

from pyspark.sql import types as T

# Boolean literals (compared in lower case), the text tokens a
# CSV reader takes for a missing value, and the accepted date layouts in the
# order in which they are tried.
TRUE_LITERALS = ("1", "true")
FALSE_LITERALS = ("0", "false")
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
)
DATE_FORMATS = (
    "yyyy-MM-dd",
    "yyyy-MM-dd HH:mm",
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy/MM/dd",
    "yyyy/MM/dd HH:mm:ss",
    "MM/dd/yyyy",
    "MM/dd/yyyy HH:mm:ss",
    "dd/MM/yyyy",
    "dd-MM-yyyy",
    "dd-MMM-yyyy",
)
NUMBER_SHAPE = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
# a number without an exponent
PLAIN_SHAPE = r"^\s*[+-]?(\d+\.?\d*|\.\d+)\s*$"
DECIMAL_DIGITS = 38  # of Spark's widest decimal type
# the number type of exact values that no decimal type holds: digits as text
DIGITS = "digits"
# whole numbers are shown with up to this many zeros, smaller and larger ones with an exponent
SHOWN_ZEROS = 40

INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
FLOATING = (T.FloatType, T.DoubleType)
TEMPORAL = (T.DateType, T.TimestampType, T.TimestampNTZType)
TEXTUAL = (T.StringType, T.CharType, T.VarcharType)
NESTED = (T.ArrayType, T.StructType)


def is_numeric_type(dtype: T.DataType) -> bool:
    return isinstance(dtype, INTEGRAL + FLOATING + (T.DecimalType,))


# types without an order or an equality, in which rows cannot be grouped
UNCOMPARABLE = (T.MapType, T.VariantType, T.CalendarIntervalType)


def is_comparable(dtype: T.DataType) -> bool:
    if isinstance(dtype, UNCOMPARABLE):
        return False
    if isinstance(dtype, T.ArrayType):
        return is_comparable(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return all(is_comparable(f.dataType) for f in dtype.fields)
    return True


def holds_map(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.ArrayType):
        return holds_map(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return any(holds_map(f.dataType) for f in dtype.fields)
    return isinstance(dtype, T.MapType)


def without_maps(c: str, dtype: T.DataType, depth: int = 0) -> str:
    """The value with each map, at every depth, as its entries sorted by key: equal maps become equal values that group and join."""
    if not holds_map(dtype):
        return c
    x = f"x{depth}"
    if isinstance(dtype, T.ArrayType):
        return f"transform({c}, {x} -> {without_maps(x, dtype.elementType, depth + 1)})"
    if isinstance(dtype, T.StructType):
        fields = ", ".join(f"{text_literal(f.name)}, {without_maps(f'{c}.{quoted(f.name)}', f.dataType, depth)}" for f in dtype.fields)
        return f"if({c} is null, null, named_struct({fields}))"
    value = without_maps(f"{x}.value", dtype.valueType, depth + 1)
    return f"array_sort(transform(map_entries({c}), {x} -> named_struct('key', {x}.key, 'value', {value})))"


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def text_literal(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def text_list(values) -> str:
    return ", ".join(text_literal(v) for v in values)


# The functions below take and give SQL expressions: one text per column is
# handed to Spark, however many columns, classes and layouts there are.


def missing_to_null(c: str, dtype: T.DataType) -> str:
    """NaN counts as a missing value; a value without a type is a missing text."""
    if isinstance(dtype, T.NullType):
        return f"cast({c} as string)"
    return f"nullif({c}, {dtype.simpleString()}('NaN'))" if isinstance(dtype, FLOATING) else c


def null_tokens_to_null(c: str, tokens=NULL_TOKENS) -> str:
    return f"case when {c} not in ({text_list(tokens)}) then {c} end" if tokens else c


def is_boolean_literal(c: str, dtype: T.DataType) -> str:
    if isinstance(dtype, T.BooleanType):
        return "true"
    if is_numeric_type(dtype):
        return f"{c} in (0, 1)"
    if isinstance(dtype, TEXTUAL):
        return f"lower({c}) in ({text_list(TRUE_LITERALS + FALSE_LITERALS)})"
    return "false"


def matches(c: str, pattern: str) -> str:
    return f"{c} rlike {text_literal(pattern)}"


def is_number(c: str, dtype: T.DataType) -> str:
    if is_numeric_type(dtype):
        return "true"
    return matches(c, NUMBER_SHAPE) if isinstance(dtype, TEXTUAL) else "false"


def is_plain_number(c: str) -> str:
    """A text whose number of whole and fraction digits can be read off."""
    return matches(c, PLAIN_SHAPE)


def whole_digits(c: str) -> str:
    return f"length(regexp_extract({c}, {text_literal(r'^[\s+-]*0*(\d*)')}, 1))"


def fraction_digits(c: str) -> str:
    return f"length(regexp_extract({c}, {text_literal(r'\.(\d*?)0*\s*$')}, 1))"


def digits_of(c: str) -> str:
    """Exact value of a number's text as a text that equal values share.

    Sign, digits without outer zeros and the power of ten of the last digit say
    all of a value; they are written as a plain number where that is short.
    """
    shape = text_literal(r"^\s*([+-]?)(\d*)\.?(\d*)(?:[eE]([+-]?\d+))?\s*$")
    part = lambda k: f"regexp_extract({c}, {shape}, {k})"
    first = (
        f"named_struct('minus', {part(1)} = '-', 'all', ltrim('0', concat({part(2)}, {part(3)})), "
        f"'power', try_cast(if({part(4)} = '', '0', {part(4)}) as decimal(38,0)) - length({part(3)}))"
    )
    second = (
        "named_struct('minus', v.minus, 'd', rtrim('0', v.all), "
        "'e', v.power + length(v.all) - length(rtrim('0', v.all)))"
    )
    n = "cast(-w.e as int)"
    plain = (
        f"case when w.e is null then trim({c}) when w.d = '' then '0' "
        f"when w.e between 0 and {SHOWN_ZEROS} then concat(w.d, repeat('0', cast(w.e as int))) "
        f"when w.e < 0 and -w.e < length(w.d) then concat(left(w.d, length(w.d) - {n}), '.', right(w.d, {n})) "
        f"when w.e < 0 and -w.e - length(w.d) <= {SHOWN_ZEROS} then concat('0.', repeat('0', {n} - length(w.d)), w.d) "
        "else concat(w.d, 'E', cast(w.e as string)) end"
    )
    signed = f"concat(if(w.minus and w.d <> '' and w.e is not null, '-', ''), {plain})"
    return f"transform(transform(array({first}), v -> {second}), w -> {signed})[0]"


def date_shape(fmt: str) -> str:
    """Regular expression of the texts that can possibly fit a date layout.

    Parsing a text that does not fit throws and catches inside the JVM; the
    shape keeps all but plausible dates away from the parser.
    """
    out = []
    for m in re.finditer(r"'([^']*)'|([A-Za-z])\2*|.", fmt):
        text = m.group(0)
        if m.group(1) is not None:
            out.append(m.group(1))
        elif m.group(2) == "M" and len(text) > 2:
            out.append("[A-Za-z]{3}" if len(text) == 3 else "[A-Za-z]{3,9}")
        elif m.group(2) == "a":
            out.append("[AaPp][Mm]")
        elif m.group(2) and len(text) == 1:
            out.append(r"\d{1,2}")
        elif m.group(2):
            out.append(r"\d{%d}" % len(text))
        else:
            out.append({"[": "(", "]": ")?"}.get(text) or re.escape(text))
    return "".join(out) + (OPTIONAL_SHAPE if has_seconds(fmt) else "")


def has_seconds(fmt: str) -> bool:
    """After seconds a fraction and a zone may follow, as databases and Spark write them."""
    return fmt.endswith("ss")


OPTIONAL_SHAPE = r"(\.\d{1,9})?(Z|[+-]\d{2}(:?\d{2})?)?"
OPTIONAL_FORMAT = "[.SSSSSSSSS][XXX][XX][X]"


def fits_some_layout(c: str, formats) -> str:
    return matches(c, "^(" + "|".join(date_shape(f) for f in formats) + ")$")


def as_timestamp(c: str, dtype: T.DataType, fmt: str | None = None) -> str:
    """Wall-clock timestamp, null where the value is no date of the layout.

    A text with a zone is an instant, taken to the wall clock of the session's zone.
    """
    if isinstance(dtype, TEMPORAL):
        return f"cast({c} as timestamp_ntz)"
    if isinstance(dtype, TEXTUAL) and fmt:
        layout = fmt + (OPTIONAL_FORMAT if has_seconds(fmt) else "")
        parsed = f"cast(try_to_timestamp({c}, {text_literal(layout)}) as timestamp_ntz)"
        return f"case when {matches(c, '^' + date_shape(fmt) + '$')} then {parsed} end"
    return "cast(null as timestamp_ntz)"


def as_text(c: str, dtype: T.DataType) -> str:
    if isinstance(dtype, NESTED):
        return f"to_json(struct({c} as v))"
    if isinstance(dtype, T.BinaryType):
        return f"hex({c})"
    return c if isinstance(dtype, TEXTUAL) else f"cast({c} as string)"


def as_boolean_text(c: str, dtype: T.DataType) -> str:
    """1/0/true/false in any spelling, numbers by value, become true/false; the rest is lower case."""
    low = f"lower({as_text(c, dtype)})"
    if is_numeric_type(dtype):
        return f"case when {c} = 1 then 'true' when {c} = 0 then 'false' else {low} end"
    known = (
        f"case when {low} in ({text_list(TRUE_LITERALS)}) then 'true' "
        f"when {low} in ({text_list(FALSE_LITERALS)}) then 'false' "
    )
    if isinstance(dtype, TEXTUAL):
        known += f"when {matches(c, NUMBER_SHAPE)} then decode({digits_of(c)}, '1', 'true', '0', 'false', {low}) "
    return known + f"else {low} end"


def as_number(c: str, dtype: T.DataType, number: str) -> str:
    if number == DIGITS:
        text = f"cast({c} as int)" if isinstance(dtype, T.BooleanType) else c
        text = c if isinstance(dtype, TEXTUAL) else f"cast({text} as string)"
        return f"case when {matches(text, NUMBER_SHAPE)} then {digits_of(text)} end"
    if isinstance(dtype, TEXTUAL):
        return f"case when {matches(c, NUMBER_SHAPE)} then try_cast(trim({c}) as {number}) end"
    if isinstance(dtype, T.BooleanType):
        return f"cast(cast({c} as int) as {number})"
    return f"try_cast({c} as {number})"


def render(c: str, dtype: T.DataType) -> str:
    """Text of a normalised value as shown in findings."""
    if isinstance(dtype, T.DecimalType):
        zeros, dot = text_literal(r"(\.\d*?)0+$"), text_literal(r"\.$")
        return f"regexp_replace(regexp_replace(cast({c} as string), {zeros}, '$1'), {dot}, '')"
    if isinstance(dtype, NESTED):
        return f"to_json({c})"
    return as_text(c, dtype)


def display_name(name: str) -> str:
    """ORDER_ID -> Order_Id."""
    return "_".join(part[:1].upper() + part[1:].lower() for part in name.split("_"))


def display_name_of(c: str) -> str:
    """The same as ``display_name`` for a column of names."""
    return f"array_join(transform(split({c}, '_'), w -> concat(upper(left(w, 1)), lower(substr(w, 2)))), '_')"
