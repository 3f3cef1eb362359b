"""Cart timers: hand-made cases, and random ones against a row-by-row replay."""

import random
from datetime import datetime

import pytest
from helpers import at, make_events, tuples
from pyspark.sql import functions as F

from trolley.operators import abandonment as ab


def ev(session, kind, seconds=0, arrival=None, product="p", text=None):
    return {
        "user_session": session,
        "event_type": kind,
        "product_id": product,
        "event_time": at(seconds) if text is None else text,
        "arrival_ms": int(1000 * (seconds if arrival is None else arrival)),
    }


def outcomes(spark, rows, clock="replay", **kw):
    fired = ab.firings(make_events(spark, rows), clock, **kw)
    return sorted((r.user_session, r.outcome) for r in fired.collect())


def test_decisions(spark):
    rows = [
        ev("A", "cart"),
        ev("B", "cart"),
        ev("B", "purchase", 60),
        ev("C", "cart"),
        ev("C", "purchase", 61, arrival=30),
        ev("D", "purchase", -100, arrival=1),
        ev("D", "cart", 0, arrival=2),
        ev("E", "cart"),
        ev("E", "purchase", 30, arrival=61),
        ev("F", "view"),
        ev("F", "remove_from_cart"),
        ev("G", "purchase"),
    ]
    assert outcomes(spark, rows) == [
        ("A", "no_purchase"),
        ("B", "purchased"),
        ("C", "late_purchase"),
        ("D", "purchased"),
        ("E", "no_purchase"),
    ]
    log = ab.abandonment_log(ab.firings(make_events(spark, rows)))
    assert [s for s, _ in tuples(log)] == ["A", "C", "E"]
    assert outcomes(spark, rows, "event") == [
        ("A", "no_purchase"),
        ("B", "purchased"),
        ("C", "no_purchase"),
        ("D", "purchased"),
        ("E", "purchased"),
    ]


def test_times_that_do_not_parse(spark):
    bad = "2020-02-30 00:00:00"
    rows = [
        ev("badcart", "cart", text=bad, arrival=0),
        ev("badbuy", "cart", arrival=0),
        ev("badbuy", "purchase", text=bad, arrival=1),
        ev("noshape", "cart", text="2020-01-01", arrival=0),
        ev("notime", "cart", text="", arrival=0),
        ev("replaced", "cart", arrival=0),
        ev("replaced", "cart", text=bad, arrival=1),
    ]
    assert outcomes(spark, rows) == [
        ("badbuy", "bad_purchase_time"),
        ("badcart", "bad_cart_time"),
        ("replaced", "bad_cart_time"),
        ("replaced", "bad_cart_time"),
    ]
    log = ab.abandonment_log(ab.firings(make_events(spark, rows)))
    assert [s for s, _ in tuples(log)] == ["badbuy"]


def test_rows_without_session_are_left_out(spark):
    assert outcomes(spark, [ev(None, "cart"), ev("s", "cart")]) == [("s", "no_purchase")]


def test_list_holds_every_cart_newest_first(spark):
    rows = [ev("s", "cart", 0, product="p1"), ev("s", "cart", 1, product="p2"), ev("s", "cart", 2, product="p1")]
    events = make_events(spark, rows)
    log = ab.abandonment_log(ab.firings(events))
    assert log.count() == 3
    carts = ab.abandoned_carts(ab.cart_items(events), log)
    assert [tuple(r) for r in carts.collect()] == [("s", 0, ["p1", "p2", "p1"])]


def test_list_stops_at_the_last_abandoned_firing(spark):
    rows = [
        ev("s", "cart", 0, product="p1"),
        ev("s", "cart", 50, product="p2"),
        ev("s", "cart", 100, product="p3"),
        ev("s", "purchase", 105),
    ]
    events = make_events(spark, rows)
    log = ab.abandonment_log(ab.firings(events))
    assert log.count() == 1  # the timers at 110 and 160 know the purchase
    for stretch in (24 * ab.HOUR_MS, 40_000, 7_000):
        carts = ab.abandoned_carts(ab.cart_items(events), log, stretch_ms=stretch)
        assert [tuple(r) for r in carts.collect()] == [("s", 0, ["p2", "p1"])]


def test_long_lists_come_in_rows(spark):
    rows = [ev("s", "cart", i, product=f"p{i}") for i in range(25)]
    events = make_events(spark, rows)
    log = ab.abandonment_log(ab.firings(events))
    carts = ab.abandoned_carts(ab.cart_items(events), log, stretch_ms=4_000, chunk=10)
    got = {r.chunk: r.products for r in carts.collect()}
    assert {k: len(v) for k, v in got.items()} == {0: 10, 1: 10, 2: 5}
    assert [p for k in (2, 1, 0) for p in got[k]] == [f"p{i}" for i in reversed(range(25))]


def replayed(rows, wait=60):
    """The stored values of a session, row by row, with timers run as time passes."""
    log, carts, buys, lists, final = [], {}, {}, {}, {}
    todo = [(r["arrival_ms"], 0, i, r) for i, r in enumerate(rows)]
    todo += [
        (r["arrival_ms"] + wait * 1000, 1, i, r) for i, r in enumerate(rows) if r["event_type"] == "cart"
    ]
    for ms, is_timer, _, r in sorted(todo, key=lambda t: t[:3]):
        s = r["user_session"]
        when = datetime.strptime(r["event_time"], "%Y-%m-%d %H:%M:%S UTC")
        if not is_timer:
            if r["event_type"] == "cart":
                carts[s] = when
                lists.setdefault(s, []).insert(0, r["product_id"])
            elif r["event_type"] == "purchase":
                buys[s] = when
        elif s not in buys or (buys[s] - carts[s]).total_seconds() > wait:
            log.append((s, ms))
            final[s] = list(lists[s])
    return sorted(log), final


@pytest.mark.parametrize("seed", range(4))
def test_against_row_by_row_replay(spark, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(400):
        kind = rng.choice(["cart", "cart", "purchase", "view", "remove_from_cart"])
        session = rng.choice(["hot", "hot", "a", "b", "c", f"s{i % 40}"])
        rows.append(ev(session, kind, rng.randrange(0, 300), arrival=i * 0.2, product=f"p{i % 9}"))
    log, lists = replayed(rows)
    events = make_events(spark, rows)
    for stretch in (24 * ab.HOUR_MS, 61_000, 5_000, 300):
        fired = ab.abandonment_log(ab.firings(events, stretch_ms=stretch))
        got = fired.select("user_session", F.unix_millis(F.col("fired_at").cast("timestamp")))
        assert sorted(tuple(r) for r in got.collect()) == log
        carts = ab.abandoned_carts(ab.cart_items(events), fired, stretch_ms=stretch)
        assert {r.user_session: r.products for r in carts.collect()} == lists


@pytest.mark.parametrize("seed", [11, 12])
def test_recorded_arrivals_with_ties(spark, seed):
    """Many rows in one millisecond: the order of arrival decides, timers of an instant are one."""
    rng = random.Random(seed)
    rows = []
    for i in range(300):
        kind = rng.choice(["cart", "cart", "purchase"])
        session = rng.choice(["hot", "hot", "a", "b", f"s{i % 20}"])
        rows.append(ev(session, kind, rng.randrange(0, 300), arrival=i // 6 * 3, product=f"p{i % 9}"))
    log, lists = replayed(rows)
    events = make_events(spark, rows)
    for stretch in (None, 10_000, 1):
        fired = ab.abandonment_log(ab.firings(events, "arrival", stretch_ms=stretch))
        got = fired.select("user_session", F.unix_millis(F.col("fired_at").cast("timestamp")))
        assert sorted(tuple(r) for r in got.collect()) == sorted(set(log))
        items = ab.cart_items(events, "arrival")
        carts = ab.abandoned_carts(items, fired, "arrival", stretch)
        assert {r.user_session: r.products for r in carts.collect()} == lists


@pytest.mark.parametrize("stretch", [ab.HOUR_MS, 30_000, 999])
def test_event_clock_is_first_purchase_by_then(spark, stretch):
    rng = random.Random(5)
    rows = [
        ev(rng.choice("abcdefgh"), rng.choice(["cart", "purchase", "view", "cart"]), rng.randrange(0, 900))
        for _ in range(60)
    ]
    expected = set()
    for r in rows:
        if r["event_type"] == "cart":
            fire = r["event_time"]
            limit = datetime.strptime(fire, "%Y-%m-%d %H:%M:%S UTC").timestamp() + 60
            bought = any(
                q["event_type"] == "purchase"
                and q["user_session"] == r["user_session"]
                and datetime.strptime(q["event_time"], "%Y-%m-%d %H:%M:%S UTC").timestamp() <= limit
                for q in rows
            )
            expected.add((r["user_session"], limit, not bought))
    fired = ab.firings(make_events(spark, rows), "event", stretch_ms=stretch)
    got = fired.select("user_session", F.unix_seconds(F.col("fired_at").cast("timestamp")), "abandoned")
    assert sorted(tuple(r) for r in got.collect()) == sorted(expected)


def test_final_state(spark):
    rows = [
        ev("A", "cart"),
        ev("B", "cart", 0, arrival=0),
        ev("B", "purchase", 61, arrival=1),
        ev("B", "purchase", 5, arrival=2),
        ev("C", "purchase"),
    ]
    result = ab.final_state(make_events(spark, rows))
    assert tuples(result, "user_session", "outcome") == [("A", "no_purchase"), ("B", "purchased")]
