"""Windows, activity, affinity, top lists and pages on hand-made events."""

from datetime import datetime, timedelta

import pytest
from helpers import make_events, tuples
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from trolley.operators import activity, affinity, ranking, windows


def buy(seconds, kind="purchase", product="p1"):
    return {"event_type": kind, "product_id": product, "arrival_ms": int(seconds * 1000)}


def starts(df):
    rows = df.select((F.unix_millis("window_start") / 1000).cast("int"), "cnt").collect()
    return {r[0]: r[1] for r in rows}


def test_purchase_windows(spark):
    events = make_events(spark, [buy(10.0), buy(10.5), buy(12.9), buy(10.0, "cart")])
    counts = windows.purchase_windows(events, "arrival_ts")
    assert starts(counts) == {8: 2, 9: 2, 10: 3, 11: 1, 12: 1}
    assert windows.latest_of(counts).first().cnt == 1
    assert windows.latest_counts(events, "purchase", "arrival_ts", "1 second").first().cnt == 1


def test_window_edges(spark):
    assert starts(windows.purchase_windows(make_events(spark, [buy(11.0)]), "arrival_ts")) == {
        9: 1,
        10: 1,
        11: 1,
    }
    removed = make_events(spark, [buy(10.0, "remove_from_cart")])
    assert starts(windows.removal_windows(removed, "arrival_ts")) == dict.fromkeys(range(6, 11), 1)


def test_rows_without_product_are_left_out(spark):
    events = make_events(spark, [buy(1, product=None), buy(1, product="a:b")])
    assert tuples(windows.latest_counts(events, "purchase", "arrival_ts", "1 second"), "product_id") == [
        ("a:b",)
    ]


@settings(max_examples=5, deadline=None)
@given(
    st.lists(
        st.tuples(st.integers(0, 40_000), st.sampled_from("ab"), st.sampled_from(["purchase", "view"])),
        min_size=1,
        max_size=60,
    )
)
def test_windows_against_counting(spark, rows):
    events = make_events(spark, [buy(ms / 1000, kind, product) for ms, product, kind in rows])
    expected = {}
    for ms, product, kind in rows:
        if kind == "purchase":
            for back in range(6):
                key = (product, (ms // 1000 - back))
                expected[key] = expected.get(key, 0) + 1
    straight = windows.sliding_counts(events, "purchase", "arrival_ts", "6 seconds", "1 second")
    by_slide = windows.sliding_counts_by_slide(
        events, "purchase", "arrival_ts", "6 seconds", "1 second"
    )
    for result in (straight, by_slide):
        got = result.select("product_id", (F.unix_millis("window_start") / 1000).cast("int"), "cnt")
        assert {(r[0], r[1]): r[2] for r in got.collect()} == expected
    odd = ("purchase", "arrival_ts", "3 seconds", "2 seconds")  # made of panes of one second
    assert windows.pane_width(*odd[2:]) == "1000000 microseconds"
    straight_odd, by_panes = windows.sliding_counts(events, *odd), windows.sliding_counts_by_slide(events, *odd)
    assert straight_odd.exceptAll(by_panes).count() == 0 and by_panes.exceptAll(straight_odd).count() == 0
    latest = windows.latest_counts(events, "purchase", "arrival_ts", "1 second")
    assert latest.exceptAll(windows.latest_of(straight)).count() == 0


def test_activity(spark):
    kinds = ["view", "view", "cart", "purchase", "remove_from_cart", "signup"]
    rows = [{"user_id": 7, "event_type": k} for k in kinds]
    rows += [{"user_id": 8, "event_type": "remove_from_cart"}, {"user_id": 0, "event_type": "view"}]
    rows += [{"user_id": None, "event_type": "view"}]
    result = activity.user_activity(make_events(spark, rows))
    columns = ["user_id", "score", "views", "cart_adds", "purchases", "removals"]
    assert tuples(result, *columns) == [(0, 1, 1, 0, 0, 0), (7, 7, 2, 1, 1, 1), (8, -2, 0, 0, 0, 1)]


def test_activity_with_other_weights(spark):
    rows = [{"event_type": k} for k in ("view", "cart", "signup", "signup")]
    result = activity.user_activity(make_events(spark, rows), {"signup": 10, "view": 1})
    assert tuples(result, "score", "views", "cart_adds") == [(21, 1, 0)]


def test_unconverted_views(spark):
    def seen(user, product, *kinds):
        return [{"user_id": user, "product_id": product, "event_type": k} for k in kinds]

    rows = seen(1, "pA", *["view"] * 3)
    rows += seen(1, "pB", *["view"] * 4, "cart")
    rows += seen(1, "pC", *["view"] * 2)
    rows += seen(1, "pD", "cart", *["view"] * 3)
    rows += seen(1, "pE", *["view"] * 3, "cart", "remove_from_cart")
    rows += seen(0, "pA", *["view"] * 3) + seen(1, "", *["view"] * 3) + seen(None, "pA", *["view"] * 3)
    events = make_events(spark, rows)
    pairs = affinity.user_product(events)
    assert tuples(affinity.unconverted_views(pairs)) == [(1, "pA", 3)]
    assert affinity.unconverted_views(pairs, user_id=2).count() == 0

    views = pairs.where("views >= 3").select("user_id", "product_id", "views")
    added = events.where("event_type = 'cart'").select("user_id", "product_id")
    anti = views.join(added, ["user_id", "product_id"], "left_anti")
    assert tuples(anti) == tuples(affinity.unconverted_views(pairs))


def test_top_lists_break_ties_by_key(spark):
    latest = spark.createDataFrame(
        [(f"p{i:02}", i % 3) for i in range(30)], "product_id string, cnt bigint"
    )
    top = ranking.top_products(latest).collect()
    assert len(top) == 25 and [r.product_id for r in top[:3]] == ["p02", "p05", "p08"]
    users = spark.createDataFrame([(i, 5) for i in range(30)], "user_id bigint, score bigint")
    assert [r.user_id for r in ranking.top_users(users).collect()] == list(range(15))


def log_of(spark, n, per_instant=1, step=timedelta(hours=5)):
    first = datetime(2020, 1, 1)
    rows = [(f"s{i:04}", first + step * (i // per_instant)) for i in range(n)]
    log = spark.createDataFrame(rows, "user_session string, fired_at timestamp")
    newest_first = sorted(rows, key=lambda r: (-r[1].timestamp(), r[0]))
    return log, newest_first


def test_pages(spark):
    log, rows = log_of(spark, 23)
    assert tuples(ranking.page_count(log)) == [(23, 3)]
    assert [tuple(r) for r in ranking.page(log, 2).collect()] == rows[20:]
    assert ranking.page(log, 3).count() == 0
    empty = log.where(F.lit(False))
    assert tuples(ranking.page_count(empty)) == [(0, 1)]
    assert ranking.page(empty, 0).count() == 0


@pytest.mark.parametrize("step", [timedelta(hours=5), timedelta(seconds=7), timedelta(milliseconds=3)])
@pytest.mark.parametrize("per_instant", [1, 4])
def test_deep_pages_are_found_by_counting(spark, step, per_instant):
    log, rows = log_of(spark, 120, per_instant, step)
    for number in (0, 3, 11, 12):
        page = ranking.page(log, number, near=1)
        assert [tuple(r) for r in page.collect()] == rows[number * 10 : number * 10 + 10]


def test_pages_by_position(spark):
    log, rows = log_of(spark, 40, per_instant=4)
    page = [tuple(r) for r in ranking.page(log, 0).collect()]
    for start in (10, 20, 30):
        page = [tuple(r) for r in ranking.page_after(log, page[-1][1], page[-1][0]).collect()]
        assert page == rows[start : start + 10]
    assert ranking.page_after(log, page[-1][1], page[-1][0]).count() == 0
