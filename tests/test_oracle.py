"""Every registered query of the package against its SQL over the whole tables."""

import pytest

import __spark_entry__ as entry_point
from conftest import DATA
from oracle_compare import connect, duck_rows, spark_rows
from roadevents.oracle import ORACLE_SQL
from roadevents.queries import QUERIES

FOLDER = f"{DATA}/sf0.01"


def test_every_query_has_sql_and_is_registered():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(ORACLE_SQL) <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, name):
    expected = duck_rows(connect(FOLDER), ORACLE_SQL[name])
    assert spark_rows(QUERIES[name](spark, FOLDER)) == expected
    assert expected[1]


def test_entry(spark):
    assert entry_point.entry(spark).count() == 5
