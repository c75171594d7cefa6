"""The operators' registered queries against their SQL over whole tables."""

import duckdb
import pytest

from conftest import DATA
from oracle_compare import duck_rows, spark_rows
from roadevents.llm.queries import ORACLE_SQL, QUERIES

FOLDER = f"{DATA}/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    connection = duckdb.connect()
    for t in ("documents", "benchmark", "conversations", "labels", "pages"):
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    expected = duck_rows(connection, ORACLE_SQL[name])
    assert spark_rows(QUERIES[name](spark, FOLDER)) == expected
    assert expected[1]
