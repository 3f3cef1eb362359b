"""The registered queries once more as plain SQL, for an independent engine to check against."""

from __future__ import annotations

from trolley.plans.dirt import FAULTS

EVENTS = """
ev AS (
  SELECT CASE event_type WHEN 'click' THEN 'cart' WHEN 'error' THEN 'remove_from_cart'
              ELSE event_type END AS event_type,
         json_extract_string(props, '$.k') AS product_id,
         user_id,
         CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y-%m-%d') AS user_session,
         ts AS event_ts,
         event_id AS ordinal,
         event_id * 200 AS arrival_ms,
         make_timestamp(event_id * 200000) AS arrival_ts,
         epoch_us(ts) // 1000 AS event_ms
  FROM events
)"""


def _windows(kind: str, time: str, size_s: int, slide_s: int) -> str:
    slide = slide_s * 1_000_000
    return f"""
WITH {EVENTS},
spread AS (
  SELECT product_id, (epoch_us({time}) // {slide} - i) * {slide} AS start_us
  FROM ev, range(0, {size_s // slide_s}) AS r(i)
  WHERE event_type = '{kind}'
)
SELECT product_id, make_timestamp(start_us) AS window_start,
       make_timestamp(start_us + {size_s * 1_000_000}) AS window_end, count(*) AS cnt
FROM spread GROUP BY product_id, start_us"""


def _latest(kind: str, time: str, size_s: int, slide_s: int) -> str:
    """From the full windows, while the Spark query counts per slide."""
    return f"""
WITH w AS ({_windows(kind, time, size_s, slide_s)})
SELECT product_id, max(window_start) AS window_start, arg_max(cnt, window_start) AS cnt
FROM w GROUP BY product_id"""


def _top(kind: str, time: str, size_s: int, slide_s: int) -> str:
    return f"""
SELECT product_id, cnt FROM ({_latest(kind, time, size_s, slide_s)})
ORDER BY cnt DESC, product_id LIMIT 25"""


ACTIVITY = f"""
WITH {EVENTS}
SELECT user_id,
       CAST(sum(CASE event_type WHEN 'view' THEN 1 WHEN 'cart' THEN 2 WHEN 'purchase' THEN 5
                ELSE -2 END) AS BIGINT) AS score,
       count(*) FILTER (event_type = 'view') AS views,
       count(*) FILTER (event_type = 'cart') AS cart_adds,
       count(*) FILTER (event_type = 'purchase') AS purchases,
       count(*) FILTER (event_type = 'remove_from_cart') AS removals
FROM ev WHERE event_type IN ('view', 'cart', 'purchase', 'remove_from_cart')
GROUP BY user_id"""

USER_PRODUCT = f"""
WITH {EVENTS}
SELECT user_id, product_id, count(*) FILTER (event_type = 'view') AS views,
       bool_or(event_type = 'cart') AS added
FROM ev
WHERE event_type IN ('view', 'cart') AND user_id <> 0 AND product_id <> ''
GROUP BY user_id, product_id"""


def _unconverted(min_views: int, user: str = "") -> str:
    """As an anti-join, while the Spark query uses one pass."""
    return f"""
WITH {EVENTS},
v AS (
  SELECT user_id, product_id, count(*) AS views FROM ev
  WHERE event_type = 'view' AND user_id <> 0 AND product_id <> '' GROUP BY user_id, product_id
)
SELECT user_id, product_id, views FROM v
WHERE views >= {min_views} {user} AND NOT EXISTS (
  SELECT 1 FROM ev c WHERE c.event_type = 'cart' AND c.user_id = v.user_id
                       AND c.product_id = v.product_id)"""


def _firings(at: str) -> str:
    """Every timer joined to all rows it could have seen."""
    return f"""
WITH {EVENTS},
k AS (SELECT user_session, event_type, ordinal, {at} AS at_ms, epoch_us(event_ts) AS t_us FROM ev
      WHERE event_type IN ('cart', 'purchase')),
timers AS (SELECT DISTINCT user_session, at_ms + 60000 AS fire_ms FROM k WHERE event_type = 'cart'),
known AS (
  SELECT t.user_session, t.fire_ms,
         arg_max(k.t_us, k.ordinal) FILTER (k.event_type = 'cart') AS last_cart,
         arg_max(k.t_us, k.ordinal) FILTER (k.event_type = 'purchase') AS last_purchase
  FROM timers t JOIN k ON k.user_session = t.user_session AND k.at_ms <= t.fire_ms
  GROUP BY t.user_session, t.fire_ms
)
SELECT user_session, make_timestamp(fire_ms * 1000) AS fired_at,
       CASE WHEN last_purchase IS NULL THEN 'no_purchase'
            WHEN last_purchase - last_cart > 60000000 THEN 'late_purchase'
            ELSE 'purchased' END AS outcome,
       last_purchase IS NULL OR last_purchase - last_cart > 60000000 AS abandoned
FROM known"""


FINAL = f"""
WITH {EVENTS},
k AS (
  SELECT user_session,
         arg_max(epoch_us(event_ts), ordinal) FILTER (event_type = 'cart') AS last_cart,
         arg_max(epoch_us(event_ts), ordinal) FILTER (event_type = 'purchase') AS last_purchase
  FROM ev GROUP BY user_session
)
SELECT user_session,
       CASE WHEN last_purchase IS NULL THEN 'no_purchase'
            WHEN last_purchase - last_cart > 60000000 THEN 'late_purchase'
            ELSE 'purchased' END AS outcome,
       last_purchase IS NULL OR last_purchase - last_cart > 60000000 AS abandoned
FROM k WHERE last_cart IS NOT NULL"""


def _log(at: str) -> str:
    return f"SELECT user_session, fired_at FROM ({_firings(at)}) WHERE abandoned"


def _lists(at: str) -> str:
    """Rows (session, place, product); place 0 is the oldest item of the list."""
    return f"""
WITH {EVENTS},
lastfire AS (SELECT user_session, max(epoch_us(fired_at) // 1000) AS fire_ms FROM ({_log(at)}) GROUP BY 1)
SELECT user_session, product_id,
       row_number() OVER (PARTITION BY user_session ORDER BY {at}, ordinal) - 1 AS place
FROM ev JOIN lastfire USING (user_session)
WHERE event_type = 'cart' AND {at} <= fire_ms"""


def _carts(at: str) -> str:
    return f"""
SELECT user_session, place // 1000 AS chunk,
       CAST(to_json(list(product_id ORDER BY place DESC)) AS VARCHAR) AS products
FROM ({_lists(at)}) GROUP BY user_session, place // 1000"""


def _page(number: int) -> str:
    return f"""
WITH page AS (SELECT * FROM ({_log('arrival_ms')})
              ORDER BY fired_at DESC, user_session LIMIT 10 OFFSET {number * 10})
SELECT user_session, fired_at, place // 1000 AS chunk,
       string_agg(product_id, ', ' ORDER BY place DESC) AS products
FROM page JOIN ({_lists('arrival_ms')}) USING (user_session)
GROUP BY user_session, fired_at, place // 1000"""


def _faulty(name: str, text: str) -> str:
    for place, (column, fault) in FAULTS.items():
        if column == name:
            value = "NULL" if fault is None else f"'{fault}'"
            text = f"CASE WHEN event_id % 20 = {place} THEN {value} ELSE {text} END"
    return f"{text} AS {name}"


_TIME = "strftime(ts, '%Y-%m-%d %H:%M:%S') || ' UTC'"
_USER = "CAST(user_id AS VARCHAR)"

RAW = f"""
raw AS (
  SELECT event_id,
    {_faulty("event_time", f"CASE WHEN event_id % 20 = 14 THEN chr(9) || {_TIME} || '  ' ELSE {_TIME} END")},
    event_type,
    json_extract_string(props, '$.k') AS product_id,
    {_faulty("category_id", "CAST(event_id % 7 AS VARCHAR)")},
    {_faulty("price", "CAST(value AS VARCHAR)")},
    {_faulty("user_id", f"CASE event_id % 20 WHEN 0 THEN ' ' || {_USER} || ' ' WHEN 1 THEN {_USER} || '.9' ELSE {_USER} END")},
    {_USER} || '-' || strftime(ts, '%Y-%m-%d') AS user_session
  FROM events
),
spelled AS (
  SELECT *,
    CASE WHEN regexp_full_match(trim(user_id), '[+-]?[0-9_]+([.][0-9]*)?([eE][+-]?[0-9]+)?')
         THEN TRY_CAST(replace(trim(user_id), '_', '') AS DOUBLE) END AS user_num,
    CASE WHEN regexp_full_match(trim(category_id), '[+-]?[0-9_]+([.][0-9]*)?([eE][+-]?[0-9]+)?')
         THEN TRY_CAST(category_id AS DOUBLE) END AS category_num,
    CASE WHEN regexp_full_match(trim(price), '[+-]?([0-9]+([.][0-9]*)?([eE][+-]?[0-9]+)?|nan|inf)')
         THEN TRY_CAST(price AS DOUBLE) END AS price_num
  FROM raw
),
checked AS (
  SELECT *,
    TRY_CAST(trunc(user_num) AS BIGINT) AS user_int,
    TRY_CAST(trunc(category_num) AS BIGINT) AS category_int,
    CASE WHEN user_num IS NULL THEN 'bad_user_id'
         WHEN TRY_CAST(trunc(user_num) AS BIGINT) IS NULL THEN 'out_of_range'
         WHEN category_num IS NULL THEN 'bad_category_id'
         WHEN TRY_CAST(trunc(category_num) AS BIGINT) IS NULL THEN 'out_of_range'
         WHEN price_num IS NULL THEN 'bad_price'
         WHEN event_time IS NULL THEN 'missing_event_time' END AS reason
  FROM spelled
)"""

CLEAN = f"""
WITH {RAW}
SELECT event_id, trim(event_time, ' ' || chr(9)) AS event_time, event_type, product_id,
       category_int AS category_id,
       CASE WHEN NOT isnan(price_num) THEN price_num END AS price,
       user_int AS user_id, user_session, isnan(price_num) AS price_is_nan
FROM checked WHERE reason IS NULL"""

REJECTED = f"""
WITH {RAW}
SELECT event_id, event_time, event_type, product_id, category_id, price, user_id, user_session, reason
FROM checked WHERE reason IS NOT NULL"""

ROUNDTRIP = f"""
WITH {RAW}
SELECT event_type, product_id, category_int AS category_id,
       CASE WHEN NOT isnan(price_num) THEN price_num END AS price,
       user_int AS user_id, user_session,
       strptime(trim(replace(event_time, ' UTC', ''), ' ' || chr(9)), '%Y-%m-%d %H:%M:%S') AS event_ts,
       true AS time_ok
FROM checked WHERE reason IS NULL"""

TIME_SHAPES = """
WITH texts AS (
    SELECT event_id, CASE event_id % 6
        WHEN 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') || ' UTC'
        WHEN 1 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
        WHEN 2 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') || ' extra'
        WHEN 3 THEN chr(9) || strftime(ts, '%Y-%m-%d') || ' ' || chr(9) || strftime(ts, '%H:%M:%S') || ' '
        WHEN 4 THEN strftime(ts, '%Y') || '-13-01 ' || strftime(ts, '%H:%M:%S') END AS event_time
    FROM events
), split AS (
    SELECT event_id, regexp_split_to_array(trim(replace(event_time, ' UTC', ''), ' ' || chr(9)), '[ \t]+') AS parts FROM texts
)
SELECT event_id, coalesce(len(parts) = 2, false) AS time_ok, len(parts)::INT AS parts,
    try_strptime(array_to_string(parts, ' '), '%Y-%m-%d %H:%M:%S') AS event_ts
FROM split"""

# In a CSV file a missing last time and an empty one look the same, and an empty time is kept.
CSV_REPLAY = f"""
WITH {RAW}
SELECT event_id, coalesce(trim(event_time, ' ' || chr(9)), '') AS event_time, user_int AS user_id,
       row_number() OVER (ORDER BY event_id) - 1 AS ordinal,
       make_timestamp((row_number() OVER (ORDER BY event_id) - 1) * 200000) AS arrival_ts
FROM checked WHERE reason IS NULL OR reason = 'missing_event_time'"""

JSON_REJECTS = """
WITH lines AS (
  SELECT event_id % 5 AS turn,
    '{"event_id":' || event_id || ',"event_type":"view"' ||
    CASE WHEN event_id % 5 = 2 THEN '' ELSE ',"user_id":' || user_id END ||
    CASE WHEN event_id % 5 = 0 THEN '' ELSE '}' END AS line
  FROM events
)
SELECT CASE WHEN turn = 1 THEN '[' || line || ']' ELSE line END AS value,
       CASE turn WHEN 0 THEN 'malformed_json' WHEN 1 THEN 'not_an_object'
            ELSE 'missing_user_id' END AS reason
FROM lines WHERE turn < 3"""

def _top_of(kind: str, size_s: int) -> str:
    return f"""
SELECT product_id, arg_max(cnt, window_start) AS cnt
FROM ({_windows(kind, 'event_ts', size_s, 1)}) GROUP BY product_id
ORDER BY cnt DESC, product_id LIMIT 25"""


LIVE_PAGE = f"""
WITH {EVENTS},
log AS ({_log('event_ms')}),
page AS (SELECT * FROM log ORDER BY fired_at DESC, user_session LIMIT 10),
lastfire AS (SELECT user_session, max(epoch_us(fired_at) // 1000) AS fire_ms FROM log GROUP BY 1),
items AS (
  SELECT user_session, product_id,
         row_number() OVER (PARTITION BY user_session ORDER BY event_ms, ordinal) - 1 AS place
  FROM ev JOIN lastfire USING (user_session) WHERE event_type = 'cart' AND event_ms <= fire_ms
)
SELECT user_session, fired_at, place // 1000 AS chunk,
       string_agg(product_id, ', ' ORDER BY place DESC) AS products
FROM page JOIN items USING (user_session) GROUP BY user_session, fired_at, place // 1000"""

SQL: dict[str, str] = {
    "purchase_windows": _windows("purchase", "arrival_ts", 3, 1),
    "purchase_windows_event_3s": _windows("purchase", "event_ts", 3, 1),
    "purchase_windows_event": _windows("purchase", "event_ts", 3 * 3600, 3600),
    "purchase_windows_by_slide": _windows("purchase", "event_ts", 24 * 3600, 3600),
    "latest_purchases": _latest("purchase", "arrival_ts", 3, 1),
    "top_purchased": _top("purchase", "arrival_ts", 3, 1),
    "top_purchased_event": _top("purchase", "event_ts", 3 * 3600, 3600),
    "removal_windows": _windows("remove_from_cart", "arrival_ts", 5, 1),
    "removal_windows_event": _windows("remove_from_cart", "event_ts", 5 * 3600, 3600),
    "latest_removals": _latest("remove_from_cart", "arrival_ts", 5, 1),
    "top_removed": _top("remove_from_cart", "arrival_ts", 5, 1),
    "user_activity": ACTIVITY,
    "top_users": f"SELECT * FROM ({ACTIVITY}) ORDER BY score DESC, user_id LIMIT 15",
    "user_product": USER_PRODUCT,
    "unconverted_views": _unconverted(3),
    "unconverted_views_min2": _unconverted(2),
    "unconverted_for_user": _unconverted(2, "AND user_id = 15"),
    "abandonment_replay": _firings("arrival_ms"),
    "abandonment_event": _firings("event_ms"),
    "abandonment_final": FINAL,
    "abandonment_log": _log("arrival_ms"),
    "abandonment_pages": (
        "SELECT count(*) AS entries, greatest(1, (count(*) + 9) // 10) AS pages "
        f"FROM ({_log('arrival_ms')})"
    ),
    "abandoned_carts": _carts("arrival_ms"),
    "abandoned_carts_event": _carts("event_ms"),
    "abandoned_page": _page(0),
    "abandoned_page_deep": _page(100),
    "abandoned_page_after": (
        f"SELECT * FROM ({_log('arrival_ms')}) ORDER BY fired_at DESC, user_session LIMIT 10 OFFSET 10"
    ),
    "clean_rows": CLEAN,
    "rejected_rows": REJECTED,
    "event_json_roundtrip": ROUNDTRIP,
    "json_rejects": JSON_REJECTS,
    "csv_replay": CSV_REPLAY,
    "time_shapes": TIME_SHAPES,
    "stream_purchase_windows": _windows("purchase", "event_ts", 3, 1),
    "stream_removal_windows": _windows("remove_from_cart", "event_ts", 5, 1),
    "stream_user_activity": ACTIVITY,
    "stream_user_product": USER_PRODUCT,
    "stream_abandonment_log": _log("event_ms"),
    "stream_abandonment_arrival": _log("arrival_ms"),
    "dashboard_top_purchased": _top_of("purchase", 3),
    "dashboard_top_removed": _top_of("remove_from_cart", 5),
    "dashboard_top_users": f"SELECT * FROM ({ACTIVITY}) ORDER BY score DESC, user_id LIMIT 15",
    "dashboard_unconverted_for_user": _unconverted(2, "AND user_id = 15"),
    "dashboard_abandoned_page": LIVE_PAGE,
    "compacted_purchase_windows": _windows("purchase", "event_ts", 3, 1),
    "compacted_top_purchased": _top_of("purchase", 3),
    "compacted_user_activity": ACTIVITY,
    "reset_and_rerun": ACTIVITY,
    "compacted_for_user": _unconverted(2, "AND user_id = 15"),
}
