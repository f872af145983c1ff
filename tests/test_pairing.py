import pytest

from twinledger.model import ColumnPair, DatasetError, RunConfig
from twinledger.plans.pairing import align, pair_columns, split_supported, translate_key

HEAD = ["ID", "NAME", "QTY"]


def names(pairs):
    return [(p.source, p.target) for p in pairs]


def test_one_list_serves_both():
    assert names(pair_columns("id, name", None, HEAD, HEAD)) == [("ID", "ID"), ("NAME", "NAME")]
    assert names(pair_columns(None, "qty", HEAD, HEAD)) == [("QTY", "QTY")]


def test_tail_of_the_longer_list_completes_the_shorter():
    got = pair_columns("id,name,qty", "code", HEAD, ["CODE", "NAME", "QTY"])
    assert names(got) == [("ID", "CODE"), ("NAME", "NAME"), ("QTY", "QTY")]
    got = pair_columns("id", "code , title", ["ID", "TITLE"], ["CODE", "TITLE"])
    assert names(got) == [("ID", "CODE"), ("TITLE", "TITLE")]


def test_no_list_needs_the_same_columns():
    assert names(pair_columns(None, None, ["B", "a"], ["A", "b"])) == [("A", "A"), ("B", "B")]
    with pytest.raises(DatasetError) as e:
        pair_columns(None, None, ["A", "B"], ["A", "C"])
    assert e.value.code == "COLUMNS_DIFFER"


def test_header_of_the_only_file_serves_both():
    assert names(pair_columns(None, None, ["B", "A"], ["A", "B", "X"], source_is_file=True)) == [("B", "B"), ("A", "A")]
    assert names(pair_columns(None, None, ["A", "B", "X"], ["B"], target_is_file=True)) == [("B", "B")]


@pytest.mark.parametrize("src,tgt,side", [("id,zip", "id,name", "source"), ("id,name", "id,zip", "target")])
def test_both_sides_are_checked(src, tgt, side):
    with pytest.raises(DatasetError) as e:
        pair_columns(src, tgt, HEAD, HEAD)
    assert e.value.code == "COLUMNS_MISSING" and side in e.value.message


def test_a_column_listed_twice_is_refused():
    with pytest.raises(DatasetError):
        pair_columns("id,id", None, HEAD, HEAD)


def test_key_translation():
    pairs = [ColumnPair("A", "X"), ColumnPair("B", "Y")]
    assert translate_key(["B", "A"], pairs) == ["Y", "X"]


def test_align_and_maps(spark):
    src = spark.sql("select 1 as a, map('k', 'v') as m")
    tgt = spark.sql("select 2 as x, map('k', 'v') as m")
    s, t = align(src, tgt, [ColumnPair("a", "x"), ColumnPair("m", "m")])
    assert s.columns == t.columns == ["a", "m"]
    assert split_supported(s, t) == (["a", "m"], [])
    assert s.schema["m"].dataType.simpleString() == "array<struct<key:string,value:string>>"


def test_example_limit_must_be_whole():
    assert RunConfig(max_error_records=0).max_error_records == 0
    for bad in (-1, 1.5, "3", True):
        with pytest.raises(DatasetError):
            RunConfig(max_error_records=bad)
