"""Column names, types and default parameters shared by every job.

A *shopping event* is a row with these columns (batch or stream):

``event_type, product_id, user_id, user_session, event_ts, time_ok, ordinal, arrival_ms``

``event_ts`` is NULL when the time text does not parse, ``time_ok`` says whether the text has the
two-part shape that cart tracking asks for, ``ordinal`` is the arrival order and ``arrival_ms`` the
arrival time in epoch milliseconds.
"""

from __future__ import annotations

from pyspark.sql import types as T

TOPIC = "shopping-events"

VIEW, CART, PURCHASE, REMOVE = "view", "cart", "purchase", "remove_from_cart"

# Activity weights per event type.
ACTIVITY_WEIGHTS = {VIEW: 1, CART: 2, PURCHASE: 5, REMOVE: -2}

# Sliding windows (size, slide).
PURCHASE_WINDOW = ("3 seconds", "1 second")
REMOVAL_WINDOW = ("5 seconds", "1 second")

# Thresholds, page and list sizes.
ABANDON_AFTER_SECONDS = 60
MIN_VIEWS = 3
TOP_PRODUCTS = 25
TOP_USERS = 15
PAGE_SIZE = 10

# Fixed value: the producer sends one accepted row every 200 ms.
REPLAY_STEP_MS = 200

# Ours: how long event-time streams wait for late rows.
WATERMARK_DELAY = "10 minutes"

# Ours: totals whose state expires are kept per period of arrival, and a period waits so long for rows
# that arrived in it.
PERIOD, PERIOD_DELAY = "1 day", "1 hour"

# Schema of one JSON event on the wire. Numbers are read as text and cast afterwards, so that
# 5, 5.0 and "5" are all accepted and ``_corrupt`` marks broken JSON only.
WIRE_SCHEMA = T.StructType(
    [
        T.StructField("event_time", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("category_id", T.StringType()),
        T.StructField("price", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("user_session", T.StringType()),
        T.StructField("_corrupt", T.StringType()),
    ]
)

RESULT_SCHEMAS = {
    "purchase_panes": "product_id STRING, pane_start TIMESTAMP, cnt BIGINT",
    "removal_panes": "product_id STRING, pane_start TIMESTAMP, cnt BIGINT",
    "latest_purchases": "product_id STRING, window_start TIMESTAMP, cnt BIGINT",
    "latest_removals": "product_id STRING, window_start TIMESTAMP, cnt BIGINT",
    "user_product": "user_id BIGINT, product_id STRING, views BIGINT, added BOOLEAN",
    "user_activity": (
        "user_id BIGINT, score BIGINT, views BIGINT, cart_adds BIGINT, purchases BIGINT, "
        "removals BIGINT"
    ),
    "user_activity_periods": (
        "user_id BIGINT, period_start TIMESTAMP, score BIGINT, views BIGINT, cart_adds BIGINT, purchases BIGINT, "
        "removals BIGINT"
    ),
    "user_product_periods": (
        "user_id BIGINT, product_id STRING, period_start TIMESTAMP, views BIGINT, added BOOLEAN"
    ),
    "abandonment_log": "user_session STRING, fired_at TIMESTAMP",
    "abandonment_counts": "day BIGINT, second BIGINT, n BIGINT",
    "abandoned_sessions": "user_session STRING, fired_at TIMESTAMP",
    "cart_items": "user_session STRING, product_id STRING, at_ms BIGINT, ordinal BIGINT",
    "rejects": "value STRING, reason STRING",
}

# Tables kept up to date: the columns of their key, and those that order a key's versions before the
# micro-batch does. The others are only added to.
RESULT_KEYS = {
    "purchase_panes": (("product_id", "pane_start"), ()),
    "removal_panes": (("product_id", "pane_start"), ()),
    # A late event may change a window that is older than the product's latest.
    "latest_purchases": (("product_id",), ("window_start",)),
    "latest_removals": (("product_id",), ("window_start",)),
    "user_product": (("user_id", "product_id"), ()),
    "user_activity": (("user_id",), ()),
    "user_activity_periods": (("user_id", "period_start"), ()),
    "user_product_periods": (("user_id", "product_id", "period_start"), ()),
    "abandoned_sessions": (("user_session",), ("fired_at",)),
}

# Tables of counts that are added to: the columns of their key, and the one that is summed.
RESULT_SUMS = {"abandonment_counts": (("day", "second"), "n")}

# The column whose range in each file is known, if it isn't the first.
RESULT_ORDER = {"abandonment_log": "fired_at"}
