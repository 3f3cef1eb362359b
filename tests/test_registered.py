"""Every registered query against its SQL twin, and against the expected counts."""

import oracle
import pytest

import __spark_entry__ as entry_point
from trolley.plans import catalog
from trolley.plans import oracle as twins

QUERIES = {name: entry_point.queries()[name] for name in catalog.QUERIES}
SQL = {name: entry_point.oracle_sql()[name] for name in twins.SQL}


@pytest.fixture(scope="module")
def con():
    return oracle.duck("sf0.001")


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, con, name):
    columns, rows = oracle.spark_rows(QUERIES[name](spark, f"{oracle.DATA}/sf0.001"))
    sql_columns, sql_rows = oracle.duck_rows(con, SQL[name])
    assert columns == sql_columns
    assert rows == sql_rows


def test_entry(spark):
    result = entry_point.entry(spark)
    assert result.columns == ["product_id", "cnt"]
    assert result.count() == 25


# (rows, max count, sum of counts) at sf0.01, worked out beforehand in SQL.
WINDOW_COUNTS = {
    "purchase_windows": (5855, 2, 5943),
    "latest_purchases": (100, 1, 100),
    "purchase_windows_event_3s": (5943, 1, 5943),
    "purchase_windows_event": (5695, 3, 5943),
    "removal_windows": (9784, 3, 10070),
    "latest_removals": (100, 2, 102),
    "removal_windows_event": (9338, 3, 10070),
}


@pytest.mark.parametrize("name", WINDOW_COUNTS)
def test_expected_window_counts(spark, name):
    row = (
        QUERIES[name](spark, f"{oracle.DATA}/sf0.01")
        .selectExpr("count(*)", "max(cnt)", "sum(cnt)")
        .first()
    )
    assert tuple(row) == WINDOW_COUNTS[name]


def test_expected_outcomes(spark):
    folder = f"{oracle.DATA}/sf0.01"

    def outcomes(name):
        return {r[0]: r[1] for r in QUERIES[name](spark, folder).groupBy("outcome").count().collect()}

    assert outcomes("abandonment_replay") == {"no_purchase": 1258, "late_purchase": 339, "purchased": 409}
    assert outcomes("abandonment_event") == {"no_purchase": 1605, "purchased": 401}
    final = QUERIES["abandonment_final"](spark, folder)
    assert (final.count(), final.where("abandoned").count()) == (1601, 1299)
    assert QUERIES["abandoned_carts"](spark, folder).count() == 1300


def test_expected_rankings(spark):
    folder = f"{oracle.DATA}/sf0.01"
    top = QUERIES["top_users"](spark, folder).select("user_id", "score").take(3)
    assert [tuple(r) for r in top] == [(20, 144), (30, 135), (41, 131)]
    sizes = {"user_product": 3493, "unconverted_views": 3, "unconverted_views_min2": 110}
    assert {n: QUERIES[n](spark, folder).count() for n in sizes} == sizes
