import random

import pytest
from pyspark.sql import functions as F

from twinledger.operators import clean
from twinledger.operators import duplicates as D
from twinledger.operators import reconcile as R


def brute(src, tgt):
    out, seen = [], set()
    by_key = {k: v for k, v in src}
    for k, v in tgt:
        if k in by_key:
            seen.add(k)
            out.append((k, True, True, by_key[k], v))
        else:
            out.append((k, False, True, None, v))
    out += [(k, True, False, v, None) for k, v in src if k not in seen]
    return sorted(out, key=repr)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def frames(spark, src, tgt, parts=4):
    return (spark.createDataFrame(src, "k int, v string").repartition(parts),
            spark.createDataFrame(tgt, "k int, v string").repartition(parts))


def data(repeat):
    rng = random.Random(3)
    src = [(k, rng.choice(["a", "b", None])) for k in range(200)] + [(None, "n")]
    tgt = [(k, rng.choice(["a", "b", None])) for k in range(40, 260)] + [(None, "m")]
    if repeat:  # a third of the target rows share one key, and the null key repeats
        tgt += [(50, rng.choice("xyz")) for _ in range(110)] + [(None, "o")] * 3 + [(900, "u")] * 5
    return src, tgt


@pytest.mark.parametrize("repeat", [False, True])
def test_both_plans_equal_brute_force(spark, repeat):
    src, tgt = data(repeat)
    s, t = frames(spark, src, tgt)
    assert rows(R.reconcile(s, t, ["k"])) == brute(src, tgt)
    if not repeat:
        assert rows(R.reconcile(s, t, ["k"], target_unique=True)) == brute(src, tgt)


def test_partition_count_does_not_matter(spark):
    src, tgt = data(True)
    want = None
    for parts in (1, 4, 64):
        s, t = frames(spark, src, tgt, parts)
        joined = R.reconcile(s, t, ["k"])
        got = (rows(R.mismatch_counts(joined, ["v"])), rows(R.mismatch_samples(joined, ["k"], ["v"], 4)))
        want = want or got
        assert got == want


def test_null_equals_null_only(spark):
    s = spark.createDataFrame([(1, None, None, "nan"), (2, -9999.0, None, None)], "k int, n double, d timestamp, t string")
    t = spark.createDataFrame([(1, None, None, None), (2, None, None, "nan")], "k int, n double, d timestamp, t string")
    joined = R.reconcile(s, t, ["k"], target_unique=True)
    got = {r["column_name"]: r["mismatches"] for r in R.mismatch_counts(joined, ["n", "d", "t"]).collect()}
    assert got == {"n": 1, "t": 2}


def test_samples_are_limited_per_column_in_key_order(spark):
    s = spark.createDataFrame([(k, "a", "b") for k in range(50)], "k int, x string, y string").repartition(7)
    t = spark.createDataFrame([(k, "z", "b" if k % 2 else "q") for k in range(50)], "k int, x string, y string").repartition(5)
    joined = R.reconcile(s, t, ["k"], target_unique=True)
    got = [(r["column_name"], r["k"]) for r in R.mismatch_samples(joined, ["k"], ["x", "y"], 3).orderBy("ordinal", "example").collect()]
    assert got == [("x", 0), ("x", 1), ("x", 2), ("y", 0), ("y", 2), ("y", 4)]
    assert R.mismatch_samples(joined, ["k"], ["x", "y"], 0).count() == 0


def test_limit_is_applied_before_the_shuffle(spark):
    s = spark.createDataFrame([(1, "a")], "k int, x string")
    joined = R.reconcile(s, s, ["k"], target_unique=True)
    plan = R.mismatch_samples(joined, ["k"], ["x"], 3)._jdf.queryExecution().executedPlan().toString()
    before = plan[plan.index("Exchange hashpartitioning(ordinal"):]  # what a task does before it hands cells on
    assert "WindowGroupLimit" in before and "Partial" in before


def test_samples_of_a_hot_target_key(spark):
    s = spark.createDataFrame([(1, "a"), (2, "b")], "k int, x string")
    t = spark.createDataFrame([(1, f"z{i:03}") for i in range(300)] + [(2, "c")], "k int, x string").repartition(6)
    got = R.mismatch_samples(R.reconcile(s, t, ["k"]), ["k"], ["x"], 3).orderBy("example").collect()
    assert [(r["k"], r["target_value"], r["example"]) for r in got] == [(1, "z000", 1), (1, "z001", 2), (1, "z002", 3)]


def test_a_hot_target_key_is_dealt_to_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(R, "HOT_ROWS", 100, raising=False)
    monkeypatch.setattr(R, "CELLS_A_TASK", 100, raising=False)
    s = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (None, "d")], "k int, x string")
    t = spark.createDataFrame([(1, f"z{i:04}") for i in range(2000)] + [(None, f"n{i}") for i in range(300)] + [(2, "b"), (4, "e")], "k int, x string")
    names = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        joined = R.reconcile(s, t, ["k"])
        sizes = [r["count"] for r in joined.where("k = 1").groupBy(F.spark_partition_id()).count().collect()]
        got = joined.selectExpr("count(*)", "count_if(in_source and in_target)", "count_if(not in_source)", "count_if(not in_target)").first()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert tuple(got) == (2303, 2301, 1, 1)
    assert sum(sizes) == 2000 and len(sizes) > 4 and max(sizes) < 1000
    diff = R.differences(joined, ["x"]).coalesce(1)
    spread = R.spread_cells(diff, 2300).groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in spread) == 2300 and max(r["count"] for r in spread) < 300
    one, two = (rows(R.mismatch_samples(diff, ["k"], ["x"], 4, cells=n)) for n in (0, 2300))
    assert one == two and len(one) == 4


def test_full_outer_join_is_an_equi_join(spark):
    src, tgt = data(False)
    s, t = frames(spark, src, tgt)
    plan = R.reconcile(s, t, ["k"], target_unique=True)._jdf.queryExecution().executedPlan().toString()
    assert "FullOuter" in plan and ("SortMergeJoin" in plan or "ShuffledHashJoin" in plan)
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_multiset_difference(spark):
    s = spark.createDataFrame([(1, "a")] * 3 + [(2, None)], "k int, v string")
    t = spark.createDataFrame([(1, "a")] + [(2, None)] * 2 + [(3, "c")], "k int, v string")
    assert rows(R.multiset_difference(s, t)) == sorted([(1, "a", 2, 0), (2, None, 0, 1), (3, "c", 0, 1)], key=repr)


def test_swapping_sides_swaps_extras(spark):
    src, tgt = data(False)
    s, t = frames(spark, src, tgt)
    a = R.extra_record_counts(R.reconcile(s, t, ["k"], True)).first()
    b = R.extra_record_counts(R.reconcile(t, s, ["k"], True)).first()
    assert (a[0], a[1]) == (b[1], b[0])
    assert len(src) - a[0] == len(tgt) - a[1]


def test_duplicate_classes(spark):
    def copies(spec):
        return spark.createDataFrame([(k, None) for k, n in spec.items() for _ in range(n)], "k int, v string")

    s = copies({1: 2, 2: 3, 3: 2, 4: 1, 5: 2, 6: 1})
    t = copies({1: 2, 2: 2, 3: 1, 4: 2, 5: 4, 6: 1})
    groups = D.duplicate_groups(D.surplus_duplicates(s), D.surplus_duplicates(t), ["k"])
    assert rows(groups) == sorted([
        (1, 1, 1, "DUPLICATES_EQUAL"), (2, 2, 1, "DUPLICATES_PARTIAL"), (3, 1, None, "DUPLICATES_ONLY_SOURCE"),
        (4, None, 1, "DUPLICATES_ONLY_TARGET"), (5, 1, 3, "DUPLICATES_EXTRA_LOADED")], key=repr)


def test_copies_are_counted_with_nan_as_null(spark):
    df = spark.createDataFrame([(1, float("nan")), (1, None), (2, 0.0), (2, -0.0), (3, 1.0)], "k int, v double")
    for out in (clean.count_copies(df), copies_of(df)):
        got = sorted((r["k"], r["v"], r[clean.COPIES]) for r in out.collect())
        assert got == [(1, None, 2), (2, 0.0, 2), (3, 1.0, 1)]
        digests = {r["k"]: r[clean.DIGEST] for r in out.collect()}
        assert len(set(digests.values())) == 3


def test_a_group_of_copies_with_a_third_of_the_rows(spark):
    rows = [(i, "x") for i in range(400)] + [(7, "x")] * 200
    df = spark.createDataFrame(rows, "k int, v string").repartition(6)
    for out in (clean.count_copies(df), copies_of(df)):
        got = {r["k"]: r[clean.COPIES] for r in out.collect()}
        assert got[7] == 201 and len(got) == 400 and sum(got.values()) == 600


def test_single_rows_are_not_shuffled(spark):
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    plan = copies_of(df)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def copies_of(df):
    rows = clean.with_row_digest(df)
    single, several = clean.split_copies(rows, clean.repeated_digests(rows))
    return single.unionByName(several)
