import pytest

import __spark_entry__ as entry
from suite.spark_queries import QUERIES
from tests.check_queries import compare


@pytest.mark.parametrize("name", list(entry.oracle_sql()))
def test_query_equals_its_sql(spark, sf_dir, name):
    same, got, want = compare(spark, sf_dir, name)
    assert same, (got[0], want[0], got[1][:3], want[1][:3])


def test_entry(spark):
    assert entry.entry(spark).count() == 2


def test_every_query_of_the_suite_has_sql():
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())
