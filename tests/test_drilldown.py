import random

import pytest
from pyspark.sql import functions as F

from tests.check_queries import spark_rows
from twinledger.operators import drilldown as D
from twinledger.operators import reconcile as R

SCHEMA = "`a key` long, `b``c` string, v double, w string"


def sides(spark, rows=3000, seed=1, changed=0.02):
    rng = random.Random(seed)
    src, tgt = [], []
    for i in range(rows):
        row = (i, f"k{i % 7}", float(rng.choice([0.0, -0.0, 1.5, i])), rng.choice([None, "", "x", "é"]))
        src.append(row)
        what = rng.random() / changed
        if what < 0.25:
            continue
        tgt.append(row if what > 1 else (i, row[1], None, row[3]) if what < 0.5 else (i + 10**6, *row[1:]) if what < 0.75 else (i, row[1], row[2], row[2].hex()))
    src += [(None, "n", 1.0, "s"), (None, None, 2.0, None)]
    tgt += [(None, "n", 1.0, "t"), (None, None, 2.0, None)]
    return (spark.createDataFrame(x, SCHEMA).repartition(n) for x, n in ((src, 5), (tgt, 3)))


KEY = ["a key", "b`c"]


@pytest.mark.parametrize("levels", [(0,), (1, 2), (4, 8, 12), D.LEVELS])
def test_rows_of_the_plain_reconciliation(spark, levels):
    src, tgt = sides(spark)
    assert spark_rows(D.reconcile_by_buckets(src, tgt, KEY, levels)) == spark_rows(R.reconcile(src, tgt, KEY))


@pytest.mark.parametrize("pair", ["equal", "no target", "no source", "none", "all differ"])
def test_extreme_pairs(spark, pair):
    src, tgt = sides(spark, 300)
    src, tgt = {"equal": (src, src), "no target": (src, tgt.limit(0)), "no source": (src.limit(0), tgt), "none": (src.limit(0), tgt.limit(0)),
                "all differ": (src, src.withColumn("w", F.lit("other")))}[pair]
    assert spark_rows(D.reconcile_by_buckets(src, tgt, KEY)) == spark_rows(R.reconcile(src, tgt, KEY))
    assert spark_rows(D.difference_by_cells(src, tgt, first=4, most=16)) == spark_rows(R.multiset_difference(src, tgt))


def weak(df):
    """Rows collide in the first digest; the second one is as it should be."""
    return F.lit(5).cast("long"), D.row_digests(df)[1]


def test_collisions_are_decided_by_values(spark):
    src, tgt = sides(spark, 500)
    assert spark_rows(D.reconcile_by_buckets(src, tgt, KEY, digests=weak)) == spark_rows(R.reconcile(src, tgt, KEY))
    # all rows in the same three cells: never decodes, the rows are compared as a whole
    assert spark_rows(D.difference_by_cells(src, tgt, first=4, most=32, digests=weak)) == spark_rows(R.multiset_difference(src, tgt))
    # a poor check in both digests of one bucket: its rows are joined by value all the same
    few = lambda df: (F.pmod(D.row_digests(df)[0], F.lit(3)), F.pmod(D.row_digests(df)[1], F.lit(1000)))
    assert spark_rows(D.reconcile_by_buckets(src, tgt, KEY, (2, 4), digests=few)) == spark_rows(R.reconcile(src, tgt, KEY))


def test_nulls_in_other_places_are_other_rows(spark):
    a = spark.createDataFrame([(1, None, 2)], "k int, x int, y int")
    b = spark.createDataFrame([(1, 2, None)], "k int, x int, y int")
    assert D.reconcile_by_buckets(a, b, ["k"]).where("not (source__x <=> target__x)").count() == 1
    assert D.difference_by_cells(a, b).count() == 2
    with pytest.raises(ValueError):
        D.reconcile_by_buckets(a, b.withColumn("y", F.lit("2")), ["k"])




def test_few_rows_are_joined_where_few_differ(spark):
    """200,000 rows, one in a thousand changed: of each side under a twentieth is left for the join."""
    src = spark.range(200_000).selectExpr("id k", "cast(id * 7 as string) v", "repeat('x', 50) w")
    tgt = src.withColumn("v", F.when(F.col("k") % 1000 == 3, "changed").otherwise(F.col("v")))
    drilled = D.Drilled(src, tgt, ["k"])
    assert len(D.unequal_buckets(src, tgt, ["k"], D.LEVELS[0]).collect()) <= 200
    assert 200 <= drilled.source.count() <= 10_000 and drilled.source.count() == drilled.target.count()
    whole = D.reconcile_by_buckets(src, tgt, ["k"])
    assert whole.count() == 200_000 and whole.where("not (source__v <=> target__v)").count() == 200
    plan = D.differing_rows(src, tgt, ["k"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftSemi") >= 2  # the sides are cut before the join


def test_cells_hold_copies_and_decode_up_to_their_limit(spark):
    rows = [(i % 40, "t") for i in range(400)]
    src = spark.createDataFrame(rows + [(1, "s")] * 3 + [(2, None)], "i long, t string")
    tgt = spark.createDataFrame(rows + [(1, "s")] + [(3, "t")] * 4, "i long, t string")
    assert spark_rows(D.difference_by_cells(src, tgt)) == spark_rows(R.multiset_difference(src, tgt))
    a, b = spark.range(3000).toDF("i"), spark.range(500, 3500).toDF("i")
    for size, decodes in ((1 << 10, True), (1 << 8, False)):  # 1,000 differing rows in 3,072 and in 768 cells
        sums = {r.cell: (int(r.n), int(r.a), int(r.b), int(r.c)) for r in D.cells(a, b, size).collect()}
        told = D.peel(sums, size)
        assert (told is not None) == decodes
        if decodes:
            assert sorted(told.values()) == [-1] * 500 + [1] * 500
    assert spark_rows(D.difference_by_cells(a, b, first=1 << 8)) == spark_rows(R.multiset_difference(a, b))


def test_many_differences_need_two_passes_and_groups_of_cells(spark, monkeypatch):
    """The strata tell how many differ; no pass of cells fails, nothing reaches the driver, undecoded groups are compared by values."""
    a, b = spark.range(30_000).toDF("i"), spark.range(4000, 34_000).toDF("i")  # 8,000 differing rows
    a = a.unionByName(a.where("i < 10")).unionByName(spark.range(50_000, 50_100).toDF("i"))
    want = spark_rows(R.multiset_difference(a, b))
    passes, plain = [], D._sums
    monkeypatch.setattr(D, "_sums", lambda src, tgt, size, digests, group: passes.append(size) or plain(src, tgt, size, digests, group))
    monkeypatch.setattr(D, "GROUP_CELLS", 1 << 9)
    assert spark_rows(D.difference_by_cells(a, b, first=1 << 8)) == want
    assert passes == [1 << 8, 1 << 9]
    peel = D.peel
    monkeypatch.setattr(D, "peel", lambda found, size: None if size == 1 << 9 and len(found) % 2 else peel(found, size))
    assert spark_rows(D.difference_by_cells(a, b, first=1 << 8)) == want


def test_sums_of_cells_are_exact(spark):
    a = spark.createDataFrame([(i % 5,) for i in range(100)], "i long")
    b = spark.createDataFrame([(i % 7,) for i in range(70)], "i long")
    digests = {r.i: (r.x, r.y) for r in a.unionByName(b).select("i", *[d.alias(n) for d, n in zip(D.row_digests(a), "xy")]).distinct().collect()}
    sums = {r.cell: (int(r.n), int(r.a), int(r.b), int(r.c)) for r in D.cells(a, b, 64).collect()}
    assert D.peel(sums, 64) == {digests[i]: (20 if i < 5 else 0) - 10 for i in range(7)}
