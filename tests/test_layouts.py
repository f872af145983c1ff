"""Date layouts derived from the shapes of texts."""

import pytest
from pyspark.sql import types as T

from twinledger.functions import values as V
from twinledger.model import RunConfig
from twinledger.operators import layouts
from twinledger.plans.pair import PairSpec, run_pair

CASES = [
    (["3/14/2024", "12/1/2023"], "M/d/yyyy", False), (["14.3.2024", "1.12.2023"], "d.M.yyyy", False), (["1.2.2024", "3.4.2024"], None, True),
    (["13/1/2024", "1/13/2024"], None, False), (["March 4, 2024", "May 14, 2023"], "MMMM d, yyyy", False), (["4 Mar 2024", "14 may 2023"], "d MMM yyyy", False),
    (["May 4, 2024"], "MMM d, yyyy", False), (["March 4, 2024", "Apr 4, 2024"], None, False), (["2024/3/4 5:06", "2024/12/14 15:16"], "yyyy/M/d H:m", False),
    (["3/14/2024 5:06 PM", "3/1/2024 11:00 am"], "M/d/yyyy h:m a", False), (["2024-3-4", "2024-3-4T5:06:07"], "yyyy-M-d['T'H:m:s]", False),
    (["4-Mar-2024", "14/Mar/2024"], None, False), (["3/14/2024", "somewhere"], None, False), (["2024 03 04 17"], None, False), (["1/2/34567"], None, False),
    (["2024 Mar 4"], "yyyy MMM d", False), (["10. May 2024"], "d. MMM yyyy", False),
]


def test_layouts_of_columns(spark):
    most = max(len(texts) for texts, _, _ in CASES)
    rows = [tuple(texts[k] if k < len(texts) else None for texts, _, _ in CASES) for k in range(most)]
    names = [f"c {i}" for i in range(len(CASES))]
    df = spark.createDataFrame(rows, ", ".join(f"`{n}` string" for n in names)).repartition(3)
    shapes = layouts.shape_counts(df, names).collect()
    for i, (texts, layout, ambiguous) in enumerate(CASES):
        own = [(r["shape"], r["first"], r["second"]) for r in shapes if r["place"] == i]
        assert sum(r["n"] for r in shapes if r["place"] == i) == len(texts)
        assert layouts.derive(own) == (layout, ambiguous), texts


@pytest.mark.parametrize("layout,text,want", [
    ("M/d/yyyy h:m a", "3/4/2024 5:06 pm", "2024-03-04 17:06:00"), ("MMMM d, yyyy", "may 14, 2023", "2023-05-14 00:00:00"),
    ("yyyy-M-d['T'H:m:s]", "2024-3-4", "2024-03-04 00:00:00"), ("yyyy-M-d['T'H:m:s]", "2024-3-4T5:06:07", "2024-03-04 05:06:07"),
    ("d.M.yyyy", "31.2.2024", None), ("yyyy MMM d", "2024 mar 4", "2024-03-04 00:00:00"),
])
def test_derived_layouts_are_read(spark, layout, text, want):
    df = spark.createDataFrame([(text,)], "t string").selectExpr(f"cast({V.as_timestamp('t', T.StringType(), layout)} as string) as d")
    assert df.first()["d"] == want


def test_a_pair_with_a_layout_outside_the_list(spark):
    src = spark.sql("select id, timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(cast(id as int)) as d, 'x' as v from range(60)")
    tgt = src.selectExpr("id", "concat(month(d), '/', day(d), '/', year(d)) as d", "v")
    result = run_pair(spark, PairSpec(src, tgt, declared_key=("ID",)), RunConfig())
    assert result.classes["D"].kind == "date" and result.classes["D"].target_format == "M/d/yyyy"
    data = [r for r in result.report.collect() if r["Validation_type"] == "Data Validation"]
    assert [r["Validation_Result"] for r in data] == ["Pass"]
    few = tgt.where("id < 12").selectExpr("id", "replace(d, '/', '.') as d", "v")
    rows = run_pair(spark, PairSpec(few, few, declared_key=("ID",)), RunConfig()).report.collect()
    told = [(r["Validation_Result"], r["Reason"]) for r in rows if r["Validation_type"] == "Data Validation"]
    assert told == [("Pass", "warning: day and month cannot be told apart in D")]
