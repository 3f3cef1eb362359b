"""What the plans must look like to hold at scale."""

import os
import re
from datetime import datetime

import oracle
import pytest

from trolley import session
from trolley.operators import abandonment, activity, affinity, ranking, windows
from trolley.plans import dashboard
from trolley.plans.catalog import QUERIES
from trolley.sources import tables
from trolley.sources.event_table import shopping_events

SMALL = f"{oracle.DATA}/sf0.001"
BATCH = [n for n in QUERIES if not n.startswith(("stream_", "dashboard_"))]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    df.collect()
    return plan(df).split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", BATCH)
def test_no_python_and_no_cross_join(spark, name):
    text = plan(QUERIES[name](spark, SMALL))
    for bad in ("Python", "ArrowEval", "MapIn", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in text


def test_filters_and_columns_reach_the_scan(spark):
    purchases = shopping_events(spark, SMALL, ("purchase",))
    text = windows.purchase_windows(purchases, "event_ts")._jdf.queryExecution().toString()
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(event_type,purchase\)|In\(event_type", text)
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,props:string>" in text


def test_one_user_is_filtered_in_the_scan(spark):
    pairs = affinity.user_product(shopping_events(spark, SMALL, ("view", "cart")))
    text = affinity.unconverted_views(pairs, user_id=15)._jdf.queryExecution().toString()
    assert "EqualTo(user_id,15)" in text


def test_reads_of_kept_tables_filter_in_the_scan(spark, tmp_path):
    tables.reset(spark, str(tmp_path), ("user_product", "abandonment_log"))
    text = dashboard.unconverted_for_user(spark, str(tmp_path), 15)._jdf.queryExecution().toString()
    assert "EqualTo(user_id,15)" in text
    log = tables.read_rows(spark, str(tmp_path), "abandonment_log")
    text = ranking.page_after(log, datetime(2024, 1, 1), "s")._jdf.queryExecution().toString()
    assert "LessThanOrEqual(fired_at," in text and "TakeOrderedAndProject" in text


@pytest.mark.parametrize(
    "make",
    [
        lambda ev: windows.purchase_windows(ev, "arrival_ts"),
        lambda ev: activity.user_activity(ev),
        lambda ev: affinity.user_product(ev),
    ],
)
def test_counts_are_combined_before_their_only_shuffle(spark, make):
    text = plan(make(shopping_events(spark, SMALL)))
    assert text.count("Exchange") == 1
    assert text.index("Exchange") < text.index("partial_")


def test_top_lists_do_not_sort_everything(spark):
    ev = shopping_events(spark, SMALL)
    for top in (
        ranking.top_products(windows.latest_counts(ev, "purchase", "arrival_ts", "1 second")),
        ranking.top_users(activity.user_activity(ev)),
    ):
        assert "TakeOrderedAndProject" in plan(top)


@pytest.mark.parametrize("clock", ["replay", "event"])
def test_timers_read_and_shuffle_the_events_once(spark, clock):
    ev = shopping_events(spark, SMALL, ("cart", "purchase"))
    text = final_plan(abandonment.firings(ev, clock))
    assert text.count("FileScan") == 1
    assert "ReusedExchange" in text


def test_lists_read_and_shuffle_the_items_once(spark, tmp_path):
    log = abandonment.abandonment_log(abandonment.firings(shopping_events(spark, SMALL), "event"))
    log.write.parquet(str(tmp_path / "log"))
    items = abandonment.cart_items(shopping_events(spark, SMALL, ("cart",)), "event")
    lists = abandonment.abandoned_carts(items, spark.read.parquet(str(tmp_path / "log")))
    text = final_plan(lists)
    assert text.count("FileScan") == 2 and "ReusedExchange" in text


def test_sessions_are_cut_into_stretches(spark):
    """The only window over whole sessions runs on one line per stretch, after an aggregate."""
    text = plan(abandonment.firings(shopping_events(spark, SMALL), "event"))
    by_session = [m.start() for m in re.finditer(r"hashpartitioning\(user_session#\d+, \d+\)", text)]
    assert len(by_session) == 1
    assert "HashAggregate(keys=[user_session" in text[by_session[0] :].split("\n")[1]


def test_json_is_parsed_once_and_texts_are_converted_once(spark):
    assert plan(QUERIES["event_json_roundtrip"](spark, SMALL)).count("from_json") == 1
    assert plan(QUERIES["clean_rows"](spark, SMALL)).count("RLIKE") == 3


def test_a_page_filters_both_tables_by_its_sessions(spark, tmp_path):
    log = abandonment.abandonment_log(abandonment.firings(shopping_events(spark, SMALL), "event"))
    log.write.parquet(str(tmp_path / "log"))
    abandonment.cart_items(shopping_events(spark, SMALL, ("cart",)), "event").write.parquet(str(tmp_path / "items"))
    log, items = (spark.read.parquet(str(tmp_path / name)) for name in ("log", "items"))
    text = plan(dashboard.page_with_lists(log, items))
    assert "TakeOrderedAndProject" not in text
    scans = [line for line in text.split("\n") if "PushedFilters" in line and "user_session" in line]
    assert scans and all("In(user_session" in line for line in scans)


def test_a_written_copy_is_deleted(spark, tmp_path):
    rows = session.cut(spark.range(5))
    assert rows.count() == 5
    files = rows.inputFiles()
    session.clean_up(spark)
    assert not any(os.path.exists(f.removeprefix("file://")) for f in files)
