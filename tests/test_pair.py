from datetime import datetime

from twinledger.model import RunConfig
from twinledger.operators import reconcile as R
from twinledger.operators.clean import COPIES
from twinledger.plans.pair import PairSpec, Side, run_pair
from twinledger.session import Staged

NOW = datetime(2024, 1, 1)


def facts(result):
    return [(r["Validation_type"], r["Validation_Result"], r["Reason"]) for r in result.report.collect()]


def golden(spark):
    keys = [(101, 10), (102, 15), (104, 25), (105, 30)]
    src = spark.createDataFrame(keys, "PRODUCTID int, QUANTITY int")
    tgt = spark.createDataFrame([(k, None) for k, _ in keys], "PRODUCTID int, QUANTITY int")
    return src, tgt


def test_golden_case(spark):
    src, tgt = golden(spark)
    result = run_pair(spark, PairSpec(src, tgt, labels=("PRODUCT", "PRODUCTCHANGES")), RunConfig(), execution_time=NOW)
    assert result.key.columns == ("PRODUCTID",)
    text = "mismatched data: source Quantity = {}, target Quantity = null for key Productid = {}"
    assert facts(result) == [
        ("Data Validation", "Fail", "target columns populated as nulls: Quantity"),
        ("Data Validation", "Fail", "mismatch count by column: Quantity = 4"),
        ("Data Validation", "Fail", text.format(10, 101)),
        ("Data Validation", "Fail", text.format(15, 102)),
        ("Data Validation", "Fail", text.format(25, 104)),
        ("Data Validation", "Fail", text.format(30, 105)),
        ("Count validation", "Pass", "source count = 4, target count = 4"),
        ("Datatype Validation", "Pass", ""),
        ("Duplicate Validation", "Pass", ""),
    ]


def found(result, *columns):
    return sorted((tuple(r[c] for c in columns) for r in result.findings.collect()), key=repr)


def codes(result):
    return sorted({r["code"] for r in result.findings.collect()})


def test_a_table_equals_itself(spark):
    df = spark.createDataFrame([(i, f"n{i}", i / 3, None) for i in range(30)], "id int, n string, x double, z string")
    result = run_pair(spark, PairSpec(df, df))
    assert codes(result) == ["COUNT"] and all(r[1] == "Pass" for r in facts(result))


def test_copies_fail_the_duplicate_check_even_as_a_warning(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "id int, v string")
    result = run_pair(spark, PairSpec(df, df))
    assert ("Duplicate Validation", "Fail", "warning: 1 duplicate records are the same on both sides") in facts(result)
    assert ("Data Validation", "Pass", "") in facts(result)


def test_empty_records_are_counted_on_raw_rows(spark):
    src = spark.createDataFrame([(1, "a"), (None, None)], "id int, v string")
    tgt = spark.createDataFrame([(1, "a"), (None, None), (None, None), (None, None)], "id int, v string")
    result = run_pair(spark, PairSpec(src, tgt))
    assert ("EXTRA_EMPTY_RECORDS", 2) in found(result, "code", "count")
    assert "EXTRA_IN_TARGET" not in codes(result)


def test_keys_match_by_value(spark):
    src = spark.createDataFrame([(101, "x"), (102, "y")], "id int, v string")
    tgt = spark.createDataFrame([("101.0", "x"), ("102", "z")], "id string, v string")
    result = run_pair(spark, PairSpec(src, tgt, declared_key=("ID",)))
    rows = [(r["code"], r["key"]) for r in result.findings.collect() if r["code"] == "VALUE_MISMATCH"]
    assert rows == [("VALUE_MISMATCH", {"ID": "102"})]
    assert result.key.origin == "declared"


def test_renamed_columns(spark):
    src = spark.createDataFrame([(1, 5, "a"), (2, 6, "b")], "id int, qty int, t string")
    tgt = spark.createDataFrame([(1, 5, "a"), (2, 7, "b")], "code int, amount int, t string")
    result = run_pair(spark, PairSpec(src, tgt, "id,qty,t", "code,amount"))
    assert ("MISMATCH_COUNT", "QTY", "AMOUNT", 1) in found(result, "code", "source_column", "target_column", "count")


def test_source_keys_that_meet_after_normalising(spark):
    """'1' and '1.0' are one number: such rows are compared as whole rows."""
    src = spark.createDataFrame([("1", "a"), ("1.0", "b"), ("2", "c")], "id string, v string")
    tgt = spark.createDataFrame([("1", "b"), ("2", "d")], "id string, v string")
    result = run_pair(spark, PairSpec(src, tgt, declared_key=("ID",)), RunConfig(max_error_records=3))
    assert result.key.columns == ("ID",)
    assert ("EXTRA_IN_SOURCE", 1) in found(result, "code", "count")
    assert "EXTRA_IN_TARGET" not in codes(result)
    assert [r["key"] for r in result.findings.collect() if r["code"] == "VALUE_MISMATCH"] == [{"ID": "2"}]


def test_repeated_null_keys_match_as_a_set(spark):
    src = spark.createDataFrame([(None, f"v{i}") for i in range(40)] + [(1, "v1"), (2, "v1")], "id int, v string")
    tgt = spark.createDataFrame([(None, f"v{i}") for i in range(3, 45)] + [(1, "v1"), (2, "w")], "id int, v string")
    result = run_pair(spark, PairSpec(src, tgt))
    assert result.key.columns == ("ID",) and result.key.origin == "discovered_ignoring_nulls"
    got = found(result, "code", "count")
    assert ("EXTRA_IN_SOURCE", 3) in got and ("EXTRA_IN_TARGET", 5) in got and ("MISMATCH_COUNT", 1) in got


def test_single_null_key_is_joined(spark):
    src = spark.createDataFrame([(None, "a", 1), (1, "b", 1), (2, "c", 1)], "id int, v string, w int")
    tgt = spark.createDataFrame([(None, "z", 1), (1, "b", 1), (2, "c", 1)], "id int, v string, w int")
    result = run_pair(spark, PairSpec(src, tgt, declared_key=("ID",)))
    assert [(r["key"], r["source_value"], r["target_value"]) for r in result.findings.collect()
            if r["code"] == "VALUE_MISMATCH"] == [({"ID": "null"}, "a", "z")]


def test_empty_source_has_no_key(spark):
    src = spark.createDataFrame([], "id int, v string")
    tgt = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    result = run_pair(spark, PairSpec(src, tgt))
    assert result.key.origin == "none"
    assert ("EXTRA_IN_TARGET", 2) in found(result, "code", "count")
    assert ("Data Validation", "Fail", "2 extra records in target") in facts(result)


def test_intervals_are_reported_and_the_rest_compared(spark):
    src = spark.sql("select 1 as id, make_interval(1) as m, array(1, 2) as l, 'x' as v")
    tgt = spark.sql("select 1 as id, make_interval(1) as m, array(1, 3) as l, 'x' as v")
    result = run_pair(spark, PairSpec(src, tgt, declared_key=("ID",)))
    got = found(result, "code", "source_column", "source_value", "target_value")
    assert ("UNSUPPORTED_TYPE", "M", None, None) in got
    assert ("VALUE_MISMATCH", "L", "[1,2]", "[1,3]") in got


def test_maps_compare_without_the_order_of_their_keys(spark):
    """Maps in maps, arrays and structs; null and empty maps differ; copies count as copies."""
    rows = """values (1, map('a', map(1, 'x', 2, 'y'), 'b', map(3, 'z')), array(map('k', 1, 'l', 2)), named_struct('m', map(1, 2, 3, 4))),
                     (2, map(), array(), named_struct('m', null)), (3, null, null, null), (4, map('q', null), array(null), null)"""
    turned = """values (1, map('b', map(3, 'z'), 'a', map(2, 'y', 1, 'x')), array(map('l', 2, 'k', 1)), named_struct('m', map(3, 4, 1, 2))),
                       (2, map(), array(), named_struct('m', null)), (3, map(), null, null), (4, map('q', map(1, 'w')), array(null), null)"""
    src, tgt = (spark.sql(f"select * from ({r}) t(id, m, l, s)") for r in (rows, turned))
    result = run_pair(spark, PairSpec(src, src.unionByName(src)))
    assert {r["Validation_type"]: r["Validation_Result"] for r in result.report.collect()}["Data Validation"] == "Pass"
    got = found(run_pair(spark, PairSpec(src, tgt)), "code", "source_column", "count")
    assert {g for g in got if g[0] in ("MISMATCH_COUNT", "UNSUPPORTED_TYPE", "EXTRA_IN_SOURCE")} == {("MISMATCH_COUNT", "M", 2)}


def test_odd_column_names(spark):
    src = spark.createDataFrame([(1, "a", "it's")], "`the id` int, `a.b` string, `x'y` string")
    tgt = spark.createDataFrame([(1, "b", "it's")], "`the id` int, `a.b` string, `x'y` string")
    result = run_pair(spark, PairSpec(src, tgt, declared_key=("THE ID",)))
    assert ("VALUE_MISMATCH", "A.B", {"THE ID": "1"}) in found(result, "code", "source_column", "key")


def test_columns_that_differ_become_a_report_row(spark):
    src, tgt = spark.sql("select 1 as a"), spark.sql("select 1 as b")
    rows = facts(run_pair(spark, PairSpec(src, tgt)))
    assert len(rows) == 1 and rows[0][1] == "Fail" and "COLUMNS_DIFFER" in rows[0][2]


def test_injected_changes_are_reported_exactly(spark):
    rows = [(i, f"name {i}", i * 1.5, i % 2 == 0) for i in range(300)]
    changed = [(i, n + "!" if i % 50 == 7 else n, x + 1 if i % 60 == 1 else x, b) for i, n, x, b in rows if i % 100 != 3]
    schema = "id int, n string, x double, b boolean"
    result = run_pair(spark, PairSpec(spark.createDataFrame(rows, schema), spark.createDataFrame(changed, schema)),
                      RunConfig(max_error_records=2))
    got = found(result, "code", "source_column", "count")
    assert ("EXTRA_IN_SOURCE", None, 3) in got
    assert ("MISMATCH_COUNT", "N", 6) in got and ("MISMATCH_COUNT", "X", 5) in got
    assert sum(g[0] == "VALUE_MISMATCH" for g in got) == 4


def test_column_without_a_type(spark):
    src = spark.sql("select id, null as v from range(3)")
    tgt = spark.sql("select id, if(id = 1, 'x', null) as v from range(3)")
    result = run_pair(spark, PairSpec(src, tgt, declared_key=("ID",)))
    assert ("VALUE_MISMATCH", None, "x") in found(result, "code", "source_value", "target_value")


def test_result_does_not_depend_on_partitions(spark):
    rows = [(i, f"n{i % 7}", i / 3) for i in range(90)]
    changed = [(i, n if i % 11 else "z", x) for i, n, x in rows if i % 17]
    want = None
    for parts in (1, 4, 64):
        src = spark.createDataFrame(rows, "id int, n string, x double").repartition(parts)
        tgt = spark.createDataFrame(changed, "id int, n string, x double").repartition(parts)
        got = facts(run_pair(spark, PairSpec(src, tgt), RunConfig(max_error_records=3)))
        want = want or got
        assert got == want


def test_swapping_sides_swaps_the_extras(spark):
    src = spark.createDataFrame([(i, "a") for i in range(20)], "id int, v string")
    tgt = spark.createDataFrame([(i, "a") for i in range(5, 28)], "id int, v string")
    one = dict(found(run_pair(spark, PairSpec(src, tgt)), "code", "count"))
    two = dict(found(run_pair(spark, PairSpec(tgt, src)), "code", "count"))
    assert (one["EXTRA_IN_SOURCE"], one["EXTRA_IN_TARGET"]) == (5, 8)
    assert (two["EXTRA_IN_SOURCE"], two["EXTRA_IN_TARGET"]) == (8, 5)


def test_a_changed_amount_never_passes(spark):
    src = spark.sql("select 1 as id, cast('12345678901234567890123.45' as decimal(38,2)) as amount")
    tgt = spark.sql("select 1 as id, '12345678901234567890123.46' as amount")
    got = found(run_pair(spark, PairSpec(src, tgt, declared_key=("ID",))), "code", "source_value", "target_value")
    assert ("VALUE_MISMATCH", "12345678901234567890123.45", "12345678901234567890123.46") in got
    src = spark.sql("select * from values (1, 9007199254740993L), (2, 1L) t(id, n)")
    tgt = spark.sql("select * from values (1, '9007199254740992'), (2, '1.0e0') t(id, n)")
    got = found(run_pair(spark, PairSpec(src, tgt, declared_key=("ID",))), "code", "source_value", "target_value")
    assert [g for g in got if g[0] == "VALUE_MISMATCH"] == [("VALUE_MISMATCH", "9007199254740993", "9007199254740992")]


def test_number_text_equals_a_flag(spark):
    src = spark.createDataFrame([(i, str(float(i % 2))) for i in range(10)], "id int, f string")
    tgt = spark.createDataFrame([(i, i % 2) for i in range(10)], "id int, f int")
    assert codes(run_pair(spark, PairSpec(src, tgt, declared_key=("ID",)))) == ["COUNT", "TYPE_MISMATCH"]


def test_declared_key_is_never_taken_for_a_position(spark):
    """c1 is a column of the tables, outside the compared ones, and also an inner name."""
    src = spark.createDataFrame([(i, i % 3, i % 5) for i in range(30)], "a int, b int, c1 int")
    result = run_pair(spark, PairSpec(src, src, "a,b", declared_key=("C1",)))
    assert result.key.columns == ("A",) and result.key.origin == "discovered"
    assert ("KEY_NOTE", "declared key is outside the compared columns") in found(result, "code", "source_value")


def test_a_source_is_read_once_and_its_copies_grouped_either_way(spark, tmp_path):
    rows = [(i % 40, f"v{i % 40}") for i in range(100)] + [(100 + i, "w") for i in range(50)]
    want = {}
    for n in rows:
        want[n] = want.get(n, 0) + 1
    frame = spark.createDataFrame(rows, "id int, v string").repartition(4)
    frame.write.parquet(f"{tmp_path}/t")
    for most in (0, 1_000_000):
        df = spark.read.parquet(f"{tmp_path}/t")
        side = Side(df, most)
        assert {(r["id"], r["v"]): r[COPIES] for r in side.frame.collect()} == want
        plan = side.frame._jdf.queryExecution().executedPlan().toString()
        assert f"{tmp_path}/t" not in plan  # nothing reads the source again
        side.release()


def test_both_settings_of_the_broadcast_give_one_report(spark):
    src = spark.createDataFrame([(i % 30, "a") for i in range(50)], "id int, v string")
    tgt = spark.createDataFrame([(i % 31, "a" if i % 7 else "b") for i in range(55)], "id int, v string")
    one, two = (facts(run_pair(spark, PairSpec(src, tgt), RunConfig(broadcast_digests=n))) for n in (0, 1000))
    assert one == two


def test_examples_of_many_columns_read_the_differences_once(spark):
    n = 100
    src = spark.range(40).selectExpr("id", *[f"id * {i} as c{i}" for i in range(n)])
    tgt = spark.range(40).selectExpr("id", *[f"id * {i} + if(id % 9 = 4, 1, 0) as c{i}" for i in range(n)])
    payload = [f"c{i}" for i in range(n)]
    diff = Staged(R.differences(R.reconcile(src, tgt, ["id"], True), payload), "diff")
    out = R.mismatch_samples(diff.frame, ["id"], payload, 2)
    got = out.collect()
    assert len(got) == 2 * n and {r["id"] for r in got} == {4, 13}
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("InMemoryTableScan") + plan.count("FileScan") == 1
