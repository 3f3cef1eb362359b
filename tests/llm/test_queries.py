"""Registered queries against their SQL twins."""

import oracle
import pytest

from trolley.llm.oracle import SQL
from trolley.llm.queries import QUERIES


@pytest.fixture(scope="module")
def con():
    return oracle.duck("sf0.001")


@pytest.mark.parametrize("name", SQL)
def test_query_matches_sql(spark, con, name, small):
    columns, rows = oracle.spark_rows(QUERIES[name](spark, small))
    sql_columns, sql_rows = oracle.duck_rows(con, SQL[name])
    assert columns == sql_columns
    assert rows == sql_rows


def test_all_are_registered():
    import __spark_entry__

    assert {*QUERIES, "pipeline"} <= set(__spark_entry__.queries())
