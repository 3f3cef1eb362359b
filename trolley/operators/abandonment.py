"""Abandoned carts per session: timer decisions, the log of firings and the product lists.

Every cart event starts a timer. When the timer fires, the session's last cart time and last
purchase time *as known by then* are compared; see ``decide``. The as-of lookup is a window over
the session, cut into stretches of time so that no task ever holds a whole session: inside a
stretch a window finds the last values, and a small table with one line per session and stretch
carries the values over from earlier stretches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trolley.functions.text import ms_to_ntz
from trolley.schema import ABANDON_AFTER_SECONDS, CART, PURCHASE

# Marks a time text that has the right shape but is no real time.
UNPARSED = -(2**63)

HOUR_MS = 3_600_000

# Time column and stretch length per clock: the producer's own pace, the recorded arrival times or
# the event times. Rows are combined per session and millisecond (or come 200 ms apart on the
# replay clock), so a stretch of one session has a bounded row count.
CLOCKS = {
    "replay": ("arrival_ms", 6 * HOUR_MS),
    "arrival": ("arrival_ms", HOUR_MS),
    "event": ("event_ms", HOUR_MS),
}

# Stretch length for numbering list items, which are not combined: short where any number may come
# in a second, long where five do.
LIST_STRETCH = {"replay": 6 * HOUR_MS, "arrival": 1000, "event": 1000}

# Most items of one list in a row.
CHUNK = 1000


def time_code(event_ts: Column) -> Column:
    """Event time in microseconds, or ``UNPARSED``; numbers keep the aggregates hash-based."""
    return F.coalesce(F.unix_micros(event_ts.cast("timestamp")), F.lit(UNPARSED))


def tracked(events: DataFrame, at: str) -> DataFrame:
    """Cart and purchase events that cart tracking can use, with their time on the chosen clock.

    On the arrival clocks, an event without ``arrival_ms`` is an error rather than dropped in silence.
    """
    known = F.col(at).isNotNull()
    if at == "arrival_ms":
        known = F.when(known, True).otherwise(F.raise_error(F.lit("arrival_ms is missing: use the event clock")))
    return events.where(
        F.col("event_type").isin(CART, PURCHASE)
        & F.col("user_session").isNotNull()
        & F.col("time_ok")
        & known
    ).select(
        "user_session",
        "product_id",
        F.col(at).alias("at_ms"),
        "ordinal",
        time_code(F.col("event_ts")).alias("code"),
        (F.col("event_type") == CART).alias("is_cart"),
    )


def _stretch(at: str, stretch_ms: int) -> Column:
    # Never NULL, so that joins on it add no filter that would keep two plans from sharing a shuffle.
    return F.coalesce(F.expr(f"{at} div {stretch_ms}"), F.lit(0)).alias("stretch")


def decide(last_cart: Column, last_purchase: Column, seconds: int) -> Column:
    """Outcome of one timer, by name.

    Without a readable cart time nothing is decided. A purchase time that cannot be read counts
    as no purchase, and a purchase counts only if it came at most ``seconds`` after the last cart
    (also when it came before it).
    """
    late = last_purchase - last_cart > F.lit(seconds * 1_000_000)
    return (
        F.when(last_cart.isNull() | (last_cart == UNPARSED), "bad_cart_time")
        .when(last_purchase.isNull(), "no_purchase")
        .when(last_purchase == UNPARSED, "bad_purchase_time")
        .when(late, "late_purchase")
        .otherwise("purchased")
    )


def _abandoned(outcome: Column) -> Column:
    return outcome.isin("no_purchase", "bad_purchase_time", "late_purchase")


def _per_instant(rows: DataFrame, unique: bool) -> DataFrame:
    """One row per session and millisecond: the last cart and the last purchase time in it."""
    cart = F.when(F.col("is_cart"), F.col("code"))
    purchase = F.when(~F.col("is_cart"), F.col("code"))
    if unique:
        return rows.select("user_session", "at_ms", cart.alias("cart"), purchase.alias("purchase"))
    order = F.coalesce("ordinal", "at_ms")
    return rows.groupBy("user_session", "at_ms").agg(
        F.max_by(cart, F.when(F.col("is_cart"), order)).alias("cart"),
        F.max_by(purchase, F.when(~F.col("is_cart"), order)).alias("purchase"),
    )


def firings(
    events: DataFrame,
    clock: str = "replay",
    seconds: int = ABANDON_AFTER_SECONDS,
    stretch_ms: int | None = None,
) -> DataFrame:
    """One row per timer: session, firing time, what was decided and whether the cart is abandoned.

    Rows arriving at the very millisecond of the firing count as seen. Timers of one session in
    the same millisecond are one timer.
    """
    at, default_stretch = CLOCKS[clock]
    stretch_ms = stretch_ms or default_stretch
    instants = _per_instant(tracked(events, at), unique=clock == "replay")

    nothing = F.lit(None).cast("bigint")
    seen = F.struct(
        F.col("at_ms").alias("at_ms"),
        F.lit(False).alias("is_timer"),
        F.col("cart").alias("cart"),
        F.col("purchase").alias("purchase"),
    )
    timer = F.struct(
        (F.col("at_ms") + F.lit(seconds * 1000)).alias("at_ms"),
        F.lit(True).alias("is_timer"),
        nothing.alias("cart"),
        nothing.alias("purchase"),
    )
    marks = (
        instants.select(
            "user_session",
            F.explode(
                F.when(F.col("cart").isNotNull(), F.array(seen, timer)).otherwise(F.array(seen))
            ).alias("m"),
        )
        .select("user_session", _stretch("m.at_ms", stretch_ms), "m.*")
        .repartition("user_session", "stretch")
    )

    so_far = (
        Window.partitionBy("user_session", "stretch")
        .orderBy("at_ms", "is_timer")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    timers = marks.select(
        "user_session",
        "stretch",
        "at_ms",
        "is_timer",
        F.last("cart", ignorenulls=True).over(so_far).alias("cart"),
        F.last("purchase", ignorenulls=True).over(so_far).alias("purchase"),
    ).where("is_timer")

    # Reads the same columns as the window above, so that both share one shuffle.
    def last_of(name: str):
        is_value = F.col(name).isNotNull() & ~F.col("is_timer")
        return F.max_by(name, F.when(is_value, F.col("at_ms"))).alias(name)

    before = (
        Window.partitionBy("user_session")
        .orderBy("stretch")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = (
        marks.groupBy("user_session", "stretch")
        .agg(last_of("cart"), last_of("purchase"))
        .select(
            "user_session",
            "stretch",
            F.last("cart", ignorenulls=True).over(before).alias("old_cart"),
            F.last("purchase", ignorenulls=True).over(before).alias("old_purchase"),
        )
    )
    outcome = decide(
        F.coalesce("cart", "old_cart"), F.coalesce("purchase", "old_purchase"), seconds
    )
    return timers.join(carried, ["user_session", "stretch"], "left").select(
        "user_session",
        ms_to_ntz(F.col("at_ms")).alias("fired_at"),
        outcome.alias("outcome"),
        _abandoned(outcome).alias("abandoned"),
    )


def abandonment_log(fired: DataFrame) -> DataFrame:
    """The abandoned firings: a session appears once per firing."""
    return fired.where("abandoned").select("user_session", "fired_at")


def last_firings(log: DataFrame) -> DataFrame:
    """The last firing of each session in the log."""
    return log.groupBy("user_session").agg(F.max("fired_at").alias("fired_at"))


def final_state(events: DataFrame, seconds: int = ABANDON_AFTER_SECONDS) -> DataFrame:
    """The same rule once per session, over everything that arrived (no timers)."""
    rows = tracked(events, "arrival_ms")
    cart, purchase = F.col("is_cart"), ~F.col("is_cart")
    # Ordinals are comparable within a file or a topic's partition only; arrival goes first.
    place = F.struct("at_ms", F.coalesce("ordinal", F.lit(0)))
    last = rows.groupBy("user_session").agg(
        F.max_by(F.when(cart, F.col("code")), F.when(cart, place)).alias("last_cart"),
        F.max_by(F.when(purchase, F.col("code")), F.when(purchase, place)).alias("last_purchase"),
    )
    outcome = decide(F.col("last_cart"), F.col("last_purchase"), seconds)
    return last.where(F.col("last_cart").isNotNull()).select(
        "user_session", outcome.alias("outcome"), _abandoned(outcome).alias("abandoned")
    )


def cart_items(events: DataFrame, clock: str = "replay") -> DataFrame:
    """Cart events as list items: session, product and their place in time."""
    return tracked(events, CLOCKS[clock][0]).where("is_cart").select(
        "user_session", "product_id", "at_ms", "ordinal"
    )


def abandoned_carts(
    items: DataFrame, log: DataFrame, clock: str = "event", stretch_ms: int | None = None, chunk: int = CHUNK
) -> DataFrame:
    """Product lists of abandoned sessions as of their last abandoned firing, newest first.

    A list holds every cart product of the session so far, duplicates included. Long lists come
    as several rows: ``chunk`` 0 has the oldest items, higher ones the newer, none more than
    ``chunk`` items, so a list of any length is whole and no task collects more than that.

    Items are numbered within their stretch; a table with one line per session and stretch adds
    how many came before. Both read the items through one shuffle.
    """
    stretch_ms = stretch_ms or LIST_STRETCH[clock]
    here = Window.partitionBy("user_session", "stretch").orderBy("at_ms", "ordinal", "product_id")
    numbered = (
        items.select("*", _stretch("at_ms", stretch_ms))
        .repartition("user_session", "stretch")
        .select("user_session", "stretch", "product_id", "at_ms", F.row_number().over(here).alias("nth"))
    )
    last_fired = log.groupBy("user_session").agg(
        F.unix_millis(F.max("fired_at").cast("timestamp")).alias("fired_ms")
    )
    # Stretches are added up within an hour or so, and those sums across the session.
    span = F.coalesce(F.expr(f"stretch div {max(1, HOUR_MS // stretch_ms)}"), F.lit(0)).alias("span")
    counts = numbered.groupBy("user_session", "stretch").agg(F.max("nth").alias("n")).select("*", span)
    so_far = Window.rowsBetween(Window.unboundedPreceding, -1)
    inside = so_far.partitionBy("user_session", "span").orderBy("stretch")
    across = so_far.partitionBy("user_session").orderBy("span")
    spans = counts.groupBy("user_session", "span").agg(F.sum("n").alias("n")).select(
        "user_session", "span", F.coalesce(F.sum("n").over(across), F.lit(0)).alias("earlier")
    )
    older = (
        counts.withColumn("within", F.coalesce(F.sum("n").over(inside), F.lit(0)))
        .join(spans, ["user_session", "span"])
        .join(last_fired, "user_session")
        .select("user_session", "stretch", "fired_ms", (F.col("earlier") + F.col("within")).alias("older"))
    )
    placed = (
        numbered.join(older, ["user_session", "stretch"])
        .where(F.col("at_ms") <= F.col("fired_ms"))
        .select("user_session", "product_id", (F.col("older") + F.col("nth") - 1).alias("place"))
    )
    newest_first = F.sort_array(F.collect_list(F.struct("place", "product_id")), asc=False)
    return (
        placed.groupBy("user_session", F.floor(F.col("place") / chunk).alias("chunk"))
        .agg(newest_first.alias("list"))
        .select("user_session", "chunk", F.col("list.product_id").alias("products"))
    )
