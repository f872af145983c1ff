"""The date layout of a text column, derived from the shapes of its texts.

A shape is the text with each run of digits and each name of a month as one
sign. There are few shapes of dates, however many texts, so they are counted on
the executors and only the counts are looked at. All other texts count as one shape.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinledger.functions import values as V

# English names of months.
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
#: Texts that may be dates: digits, names of months, separators, of such a length.
LEAST, MOST = 6, 35
DATE_LIKE = r"(?i)^(?:[0-9]{1,2}|[0-9]{4}|" + "|".join(f"{m[:3]}(?:{m[3:]})?" for m in MONTHS) + r"|[ap]m|t|[ ,./:-])++$"
# Signs: Y four digits, # one or two, L a month's full name, S its first letters, A "may", which is both, P am or pm.
SIGNS = (
    ("|".join(m for m in MONTHS if m != "may"), "L"), ("may", "A"), ("|".join(m[:3] for m in MONTHS if m != "may"), "S"),
    ("[ap]m", "P"), (r"(?<!\d)\d{4}(?!\d)", "Y"), (r"(?<!\d)\d{1,2}(?!\d)", "#"),
)
DATE = r"(?P<date>#([/. -])#\2Y|Y([/. -])#\3#|#([ /-])[LSA]\4Y|#\. [LSA] Y|[LSA] #,? Y|Y([ /-])[LSA]\5#)"
TIME = r"(?P<time>( |t|, )#:#(:#)?( ?P)?)?"
SHAPE = re.compile(f"^{DATE}{TIME}$")
OTHER = "other"


def is_date_like(c: str) -> str:
    return f"(length({c}) between {LEAST} and {MOST} and {V.matches(c, DATE_LIKE)})"


def shape(c: str) -> str:
    out = f"lower({c})"
    for pattern, sign in SIGNS:
        out = f"regexp_replace({out}, {V.text_literal(pattern)}, '{sign}')"
    return f"case when {V.matches(out, SHAPE.pattern.replace('?P<', '?<'))} then {out} else '{OTHER}' end"


def shape_counts(df: DataFrame, columns) -> DataFrame:
    """(place, shape, n, first, second): the texts of each shape of each column, with the largest of their first two numbers."""
    begin = V.text_literal(r"^(\d{1,2})\D(\d{1,2})\D")
    cells = []
    for i, name in enumerate(columns):
        c = V.quoted(name)
        cells.append(f"if({c} is null, null, struct({i} as place, {shape(c)} as shape, try_cast(regexp_extract({c}, {begin}, 1) as int) as first, "
                     f"try_cast(regexp_extract({c}, {begin}, 2) as int) as second))")
    found = df.selectExpr(f"inline(array_compact(array({', '.join(cells)})))")
    return found.groupBy("place", "shape").agg(F.count(F.lit(1)).alias("n"), F.max("first").alias("first"), F.max("second").alias("second"))


def derive(shapes) -> tuple[str | None, bool]:
    """(layout that fits all shapes, day and month cannot be told apart) of (shape, first, second) rows of one column.

    The shapes must share their date; a time may be missing in some. Of two
    numbers before a year the one that exceeds 12 somewhere is the day; if both do, no layout fits.
    """
    parts = [SHAPE.match(s) for s, _, _ in shapes]
    if not parts or not all(parts):
        return None, False
    dates = {re.sub("[LSA]", "M", m["date"]) for m in parts}
    times = {m["time"] or "" for m in parts}
    if len(dates) > 1 or len(times - {""}) > 1:
        return None, False
    date = dates.pop()
    full = {s for m in parts for s in re.findall("[LS]", m["date"])}
    if len(full) > 1:
        return None, False
    if date[0] == "#" and "M" not in date:
        first, second = (max((r[k] or 0) for r in shapes) for k in (1, 2))
        if first > 12 and second > 12:
            return None, False
        if first <= 12 and second <= 12:
            return None, True
        order = "dM" if first > 12 else "Md"
    else:
        order = "d" if "M" in date else "Md"
    letters = iter(order)
    layout = "".join({"#": None, "Y": "yyyy", "M": "MMMM" if full == {"L"} else "MMM"}.get(x, x) or next(letters) for x in date)
    time = next(iter(times - {""}), "")
    if time:
        letters = iter("hms" if "P" in time else "Hms")
        told = "".join({"#": None, "P": "a", "t": "'T'"}.get(x, x) or next(letters) for x in time)
        layout += f"[{told}]" if "" in times else told
    return layout, False
