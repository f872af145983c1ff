"""Value classes: how the two columns of a pair are to be compared.

One aggregate pass per side gives, for every column, the number of values and
the numbers of values that break each class.  No distinct values are gathered.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinledger.functions import values as V
from twinledger.model import ValueClass
from twinledger.operators import layouts
from twinledger.operators.clean import COPIES, is_empty_row


@dataclass
class ColumnFacts:
    values: int
    not_boolean: int
    not_number: int
    not_plain: int  # values whose digits cannot be counted: floating types, exponents
    whole: int = 0  # the most digits before and behind the point of the others
    fraction: int = 0
    not_date: dict = field(default_factory=dict)  # layout -> values it does not fit
    derived: str | None = None  # a layout outside the list that fits all values
    ambiguous: bool = False  # dates in which day and month cannot be told apart


@dataclass
class SideFacts:
    rows: int
    empty_rows: int
    surplus_rows: int
    columns: dict


def _column_aggregates(name: str, dtype: T.DataType, formats):
    """The aggregates of one column, most of them spared by its type."""
    c = V.quoted(name)
    out = {"values": f"count({c})"}
    if isinstance(dtype, V.TEXTUAL):
        out["not_boolean"] = f"count_if(not ({V.is_boolean_literal(c, dtype)}))"
        out["not_number"] = f"count_if(not ({V.is_number(c, dtype)}))"
        plain = V.is_plain_number(c)
        out["not_plain"] = f"count_if(not ({plain}))"
        out["whole"] = f"coalesce(max(case when {plain} then {V.whole_digits(c)} end), 0)"
        out["fraction"] = f"coalesce(max(case when {plain} then {V.fraction_digits(c)} end), 0)"
        out["not_date"] = f"count_if(not ({V.fits_some_layout(c, formats)}))"
        out["not_like"] = f"count_if(not ({layouts.is_date_like(c)}))"
    elif V.is_numeric_type(dtype):
        out["not_boolean"] = f"count_if(not ({V.is_boolean_literal(c, dtype)}))"
    return out


def class_statistics(df: DataFrame, columns, formats=V.DATE_FORMATS) -> DataFrame:
    """One row of counts, columns named <position>_<fact>; row facts in front.

    The frame may be plain rows or distinct rows with their copies.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    copies = COPIES if COPIES in df.columns else "1L"
    aggs = [
        f"coalesce(sum({copies}), 0L) as rows",
        f"coalesce(sum(case when {is_empty_row(columns)} then {copies} end), 0L) as empty_rows",
        f"coalesce(sum({copies} - 1), 0L) as surplus_rows",
    ]
    for i, name in enumerate(columns):
        for fact, agg in _column_aggregates(name, types[name], formats).items():
            aggs.append(f"{agg} as `{i}_{fact}`")
    return df.selectExpr(*aggs)


def date_statistics(df: DataFrame, columns, formats=V.DATE_FORMATS) -> DataFrame:
    """Per text column and layout the number of values that are no such date."""
    types = {f.name: f.dataType for f in df.schema.fields}
    aggs = []
    for i, name in enumerate(columns):
        c = V.quoted(name)
        for j, fmt in enumerate(formats):
            bad = f"{c} is not null and {V.as_timestamp(c, types[name], fmt)} is null"
            aggs.append(f"count_if({bad}) as `{i}_{j}`")
    return df.selectExpr(*aggs)


def read_facts(row: Row, schema: T.StructType, columns) -> SideFacts:
    """Facts of a side from its one row of ``class_statistics``."""
    types = {f.name: f.dataType for f in schema.fields}
    facts = {}
    for i, name in enumerate(columns):
        get = lambda fact: row[f"{i}_{fact}"]
        n, dtype = get("values"), types[name]
        if isinstance(dtype, V.TEXTUAL):
            facts[name] = ColumnFacts(n, *[get(f) for f in ("not_boolean", "not_number", "not_plain", "whole", "fraction")])
        elif V.is_numeric_type(dtype):
            plain = n if isinstance(dtype, V.FLOATING) else 0
            facts[name] = ColumnFacts(n, get("not_boolean"), 0, plain, *_type_digits(dtype))
        else:
            boolean = 0 if isinstance(dtype, T.BooleanType) else n
            facts[name] = ColumnFacts(n, boolean, n, n)
    return SideFacts(row["rows"], row["empty_rows"], row["surplus_rows"], facts)


def collect_facts(src: DataFrame, tgt: DataFrame, columns, formats=V.DATE_FORMATS):
    """Facts of both sides: two aggregate scans in one job, two rows back.

    A text column in which every value has the shape of some date layout gets
    a second pass, over those columns alone, that tells the layouts apart; one
    whose values look like dates of another layout has that derived from their shapes.
    """
    sides = (src, tgt)
    one, two = (class_statistics(df, columns, formats).withColumn("side", F.lit(k)) for k, df in enumerate(sides))
    rows = {r["side"]: r for r in one.unionByName(two, allowMissingColumns=True).collect()}
    facts = tuple(read_facts(rows[k], df.schema, columns) for k, df in enumerate(sides))
    for k, df in enumerate(sides):
        types = {f.name: f.dataType for f in df.schema.fields}
        dates = [
            c for i, c in enumerate(columns)
            if isinstance(types[c], V.TEXTUAL) and facts[k].columns[c].values and rows[k][f"{i}_not_date"] == 0
        ]
        if dates:
            row = date_statistics(df, dates, formats).first()
            for i, c in enumerate(dates):
                facts[k].columns[c].not_date = {fmt: row[f"{i}_{j}"] for j, fmt in enumerate(formats)}
        like = [
            c for i, c in enumerate(columns)
            if isinstance(types[c], V.TEXTUAL) and facts[k].columns[c].values and facts[k].columns[c].not_number
            and rows[k][f"{i}_not_like"] == 0 and 0 not in facts[k].columns[c].not_date.values()
        ]
        if like:
            shapes = layouts.shape_counts(df, like).collect()
            for i, c in enumerate(like):
                own = [(r["shape"], r["first"], r["second"]) for r in shapes if r["place"] == i]
                facts[k].columns[c].derived, facts[k].columns[c].ambiguous = layouts.derive(own)
    return facts


def _date_format(facts: ColumnFacts, dtype: T.DataType, formats):
    """(fits, layout): one layout must fit all values of a side."""
    if isinstance(dtype, V.TEMPORAL):
        return True, None
    if isinstance(dtype, V.TEXTUAL) and facts.values:
        for fmt in formats:
            if facts.not_date.get(fmt) == 0:
                return True, fmt
        if facts.derived:
            return True, facts.derived
    return False, None


def _type_digits(dtype: T.DataType):
    """Digits before and behind the point that a numeric type can hold."""
    if isinstance(dtype, T.DecimalType):
        return dtype.precision - dtype.scale, dtype.scale
    return {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}.get(type(dtype), 0), 0


def _number_type(a: T.DataType, b: T.DataType, fa: ColumnFacts, fb: ColumnFacts) -> str:
    """Common type: double only where a side is floating, else one that holds every value of both sides."""
    if isinstance(a, V.INTEGRAL) and isinstance(b, V.INTEGRAL):
        return "bigint"
    if isinstance(a, V.FLOATING) or isinstance(b, V.FLOATING):
        return "double"
    whole, scale = max(fa.whole, fb.whole), max(fa.fraction, fb.fraction)
    if fa.not_plain or fb.not_plain or whole + scale > V.DECIMAL_DIGITS:
        return V.DIGITS
    return f"decimal({max(whole + scale, 1)},{scale})"


def value_class(a: T.DataType, b: T.DataType, fa: ColumnFacts, fb: ColumnFacts,
                formats=V.DATE_FORMATS, is_key: bool = False) -> ValueClass:
    """Class of one column pair.

    boolean: either side holds nothing but boolean literals (a side without
    values counts); numeric, date: both sides; string otherwise.  A key is
    never boolean, so that 1 and true stay different keys.
    """
    if not is_key and (fa.not_boolean == 0 or fb.not_boolean == 0):
        return ValueClass("boolean")
    if isinstance(a, V.NESTED) or isinstance(b, V.NESTED):
        return ValueClass("nested" if a == b else "string")
    if isinstance(a, T.BinaryType) and isinstance(b, T.BinaryType):
        return ValueClass("nested")
    if fa.not_number == 0 and fb.not_number == 0 and (fa.values and fb.values or is_key):
        return ValueClass("numeric", number=_number_type(a, b, fa, fb))
    fits_a, fmt_a = _date_format(fa, a, formats)
    fits_b, fmt_b = _date_format(fb, b, formats)
    if fits_a and fits_b:
        return ValueClass("date", source_format=fmt_a, target_format=fmt_b)
    return ValueClass("string")


def infer_classes(src_schema, tgt_schema, src_facts: SideFacts, tgt_facts: SideFacts,
                  key=(), formats=V.DATE_FORMATS) -> dict:
    """Column name -> ValueClass for frames that carry the same names."""
    a = {f.name: f.dataType for f in src_schema.fields}
    b = {f.name: f.dataType for f in tgt_schema.fields}
    return {
        name: value_class(a[name], b[name], src_facts.columns[name], tgt_facts.columns[name],
                          formats, name in key)
        for name in src_facts.columns
    }


def normalized(c: str, dtype: T.DataType, cls: ValueClass, side: str) -> str:
    if cls.kind == "boolean":
        return V.as_boolean_text(c, dtype)
    if cls.kind == "numeric":
        return V.as_number(c, dtype, cls.number)
    if cls.kind == "date":
        return V.as_timestamp(c, dtype, cls.source_format if side == "source" else cls.target_format)
    return c if cls.kind == "nested" else V.as_text(c, dtype)


def normalize(df: DataFrame, classes: dict, side: str) -> DataFrame:
    """Every classified column in its comparable form; the rest unchanged."""
    out = []
    for f in df.schema.fields:
        c = V.quoted(f.name)
        out.append(f"{normalized(c, f.dataType, classes[f.name], side)} as {c}" if f.name in classes else c)
    return df.selectExpr(*out)
