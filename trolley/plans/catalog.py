"""The registered queries: each takes (spark, folder of the test tables) and returns a DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trolley.functions.text import bare_time, has_time_shape, ms_to_ntz, to_event_ts
from trolley.operators import abandonment, activity, affinity, cleaning, ranking, windows
from trolley.plans import dashboard, dirt
from trolley.schema import CART, PURCHASE, REMOVE, REPLAY_STEP_MS, VIEW
from trolley.session import cut, shared_dir
from trolley.sources import raw_csv, tables, topic
from trolley.sources.event_table import (
    as_shopping_events,
    read_table,
    read_table_stream,
    shopping_events,
)
from trolley.sources.tables import read_latest, read_rows
from trolley.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]

BOUGHT = (PURCHASE,)
REMOVED = (REMOVE,)
SEEN = (VIEW, CART)
TRACKED = (CART, PURCHASE)
SCORED = (VIEW, CART, PURCHASE, REMOVE)

PAGE_DEEP = 100


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return affinity.user_product(shopping_events(spark, sf_dir, SEEN))


def _firings(spark: SparkSession, sf_dir: str, clock: str) -> DataFrame:
    return abandonment.firings(shopping_events(spark, sf_dir, TRACKED), clock)


def _log(spark: SparkSession, sf_dir: str, clock: str) -> DataFrame:
    return abandonment.abandonment_log(_firings(spark, sf_dir, clock))


def _carts(spark: SparkSession, sf_dir: str, clock: str) -> DataFrame:
    items = abandonment.cart_items(shopping_events(spark, sf_dir, (CART,)), clock)
    lists = abandonment.abandoned_carts(items, _log(spark, sf_dir, clock), clock)
    return lists.withColumn("products", F.to_json("products"))


def _page_with_products(spark: SparkSession, sf_dir: str, number: int, near: int) -> DataFrame:
    log = cut(_log(spark, sf_dir, "replay"))
    items = abandonment.cart_items(shopping_events(spark, sf_dir, (CART,)), "replay")
    return dashboard.page_with_lists(log, items, number, near=near, clock="replay")


def _page_after_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = cut(_log(spark, sf_dir, "replay"))
    last = ranking.page(log, 0).orderBy("fired_at", F.desc("user_session")).first()
    if last is None:
        return ranking.page(log, 0)
    return ranking.page_after(log, last["fired_at"], last["user_session"])


def _clean_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cleaning.clean(dirt.raw_rows(read_table(spark, sf_dir)))
    not_a_number = F.isnan("price")
    return rows.withColumn("price_is_nan", not_a_number).withColumn(
        "price", F.when(~not_a_number, F.col("price"))
    )


def _rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.rejected(dirt.raw_rows(read_table(spark, sf_dir)))


def _json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = dirt.raw_rows(read_table(spark, sf_dir))
    lines = topic.encode(cleaning.clean(raw).drop("event_id"))
    events = topic.accepted(topic.parse(lines), ("user_id", "product_id", "user_session"))
    return events.select(
        "event_type",
        "product_id",
        "category_id",
        F.when(~F.isnan("price"), F.col("price")).alias("price"),
        "user_id",
        "user_session",
        F.col("event_ts").cast("timestamp_ntz").alias("event_ts"),
        "time_ok",
    )


def _json_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topic.rejects(topic.parse(dirt.json_lines(read_table(spark, sf_dir))), ("user_id",))


def _csv_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows to CSV files and back: cleaned, numbered in file order, on the replay clock."""
    folder = f"{shared_dir(spark)}/csv-{uuid.uuid4().hex}"
    raw = dirt.raw_rows(read_table(spark, sf_dir)).select(*dirt.RAW_COLUMNS)
    (
        raw.repartitionByRange("event_id")
        .sortWithinPartitions("event_id")
        .write.option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(folder)
    )
    rows = cleaning.number_rows(cleaning.clean(raw_csv.read_raw_csv(spark, folder, dirt.RAW_COLUMNS)))
    return rows.select(
        F.col("event_id").cast("bigint").alias("event_id"),
        "event_time",
        "user_id",
        "ordinal",
        ms_to_ntz(F.col("arrival_ms")).alias("arrival_ts"),
    )


def _time_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("event_time")
    return dirt.time_texts(read_table(spark, sf_dir)).select(
        "event_id",
        has_time_shape(text).alias("time_ok"),
        F.size(F.split(bare_time(text), "[ \t]+")).alias("parts"),
        to_event_ts(text).cast("timestamp_ntz").alias("event_ts"),
    )


def _reset_and_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A compacted table, emptied, and filled by the job from the start again."""
    root = _live_compacted(spark, sf_dir, jobs.user_activity)
    tables.reset(spark, root)
    rows = as_shopping_events(read_table_stream(spark, sf_dir))
    jobs.user_activity(rows, root, checkpoints=f"{root}/_again").awaitTermination()
    return tables.read_latest(spark, root, "user_activity")


def _end_of_stream(spark: SparkSession, sf_dir: str, root: str) -> DataFrame:
    """A stream of one row a day after the last of the table, on both clocks: all timers come due."""
    table = read_table(spark, sf_dir)
    last = {
        "event_id": F.max("event_id") + 86_400_000 // REPLAY_STEP_MS,
        "ts": F.max("ts") + F.expr("INTERVAL 1 DAY"),
        "event_type": F.lit(PURCHASE),
    }
    values = [last.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in table.schema]
    table.agg(*values).write.parquet(f"{root}/end_of_stream")
    return spark.readStream.schema(table.schema).parquet(f"{root}/end_of_stream")


def _in_parts(spark: SparkSession, sf_dir: str, parts: int) -> DataFrame:
    """The events table as a stream of so many micro-batches, in no order."""
    folder = f"{shared_dir(spark)}/parts-{uuid.uuid4().hex}"
    table = read_table(spark, sf_dir)
    table.repartitionByRange(parts, "event_id").write.parquet(f"{folder}/events.parquet")
    return read_table_stream(spark, folder, 1)


def _live(spark: SparkSession, sf_dir: str, *started, ended: bool = False, parts: int = 0) -> str:
    """Run live jobs over the events table as a stream, to its end; returns the tables' root."""
    root = f"{shared_dir(spark)}/live-{uuid.uuid4().hex}"
    rows = _in_parts(spark, sf_dir, parts) if parts else read_table_stream(spark, sf_dir)
    if ended:
        rows = rows.unionByName(_end_of_stream(spark, sf_dir, root))
    for query in [job(as_shopping_events(rows), root) for job in started]:
        query.awaitTermination()
    return root


def _live_compacted(spark: SparkSession, sf_dir: str, job) -> str:
    """The job in seven micro-batches, with its tables compacted in between."""
    return _live(spark, sf_dir, partial(job, compact_every=2), parts=7)


#: For a stream whose files come in no order.
NEVER_LATE = "3650 days"


def _plain_times(rows: DataFrame) -> DataFrame:
    """Zone-free times."""
    return rows.select(
        *[F.col(c).cast("timestamp_ntz").alias(c) if t == "timestamp" else c for c, t in rows.dtypes]
    )


def _live_rows(spark: SparkSession, sf_dir: str, job) -> DataFrame:
    """The table a job leaves."""
    return _plain_times(read_rows(spark, _live(spark, sf_dir, job), job.__name__))


def _live_log(spark: SparkSession, sf_dir: str, clock: str) -> DataFrame:
    root = _live(spark, sf_dir, partial(jobs.abandonment_log, clock=clock), ended=True)
    return read_rows(spark, root, "abandonment_log").withColumn("fired_at", F.col("fired_at").cast("timestamp_ntz"))


def _live_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _live(spark, sf_dir, jobs.abandonment_log, jobs.cart_items, ended=True)
    return dashboard.abandoned_page(spark, root).withColumn(
        "fired_at", F.col("fired_at").cast("timestamp_ntz")
    )


QUERIES: dict[str, Query] = {
    "purchase_windows": lambda s, d: windows.purchase_windows(shopping_events(s, d, BOUGHT), "arrival_ts"),
    "purchase_windows_event_3s": lambda s, d: windows.purchase_windows(
        shopping_events(s, d, BOUGHT), "event_ts"
    ),
    "purchase_windows_event": lambda s, d: windows.purchase_windows(
        shopping_events(s, d, BOUGHT), "event_ts", ("3 hours", "1 hour")
    ),
    "purchase_windows_by_slide": lambda s, d: windows.sliding_counts_by_slide(
        shopping_events(s, d, BOUGHT), PURCHASE, "event_ts", "24 hours", "1 hour"
    ),
    "latest_purchases": lambda s, d: windows.latest_counts(
        shopping_events(s, d, BOUGHT), PURCHASE, "arrival_ts", "1 second"
    ),
    "top_purchased": lambda s, d: ranking.top_products(
        windows.latest_counts(shopping_events(s, d, BOUGHT), PURCHASE, "arrival_ts", "1 second")
    ),
    "top_purchased_event": lambda s, d: ranking.top_products(
        windows.latest_counts(shopping_events(s, d, BOUGHT), PURCHASE, "event_ts", "1 hour")
    ),
    "removal_windows": lambda s, d: windows.removal_windows(shopping_events(s, d, REMOVED), "arrival_ts"),
    "removal_windows_event": lambda s, d: windows.removal_windows(
        shopping_events(s, d, REMOVED), "event_ts", ("5 hours", "1 hour")
    ),
    "latest_removals": lambda s, d: windows.latest_counts(
        shopping_events(s, d, REMOVED), REMOVE, "arrival_ts", "1 second"
    ),
    "top_removed": lambda s, d: ranking.top_products(
        windows.latest_counts(shopping_events(s, d, REMOVED), REMOVE, "arrival_ts", "1 second")
    ),
    "user_activity": lambda s, d: activity.user_activity(shopping_events(s, d, SCORED)),
    "top_users": lambda s, d: ranking.top_users(activity.user_activity(shopping_events(s, d, SCORED))),
    "user_product": _pairs,
    "unconverted_views": lambda s, d: affinity.unconverted_views(_pairs(s, d)),
    "unconverted_views_min2": lambda s, d: affinity.unconverted_views(_pairs(s, d), 2),
    "unconverted_for_user": lambda s, d: affinity.unconverted_views(_pairs(s, d), 2, 15),
    "abandonment_replay": lambda s, d: _firings(s, d, "replay"),
    "abandonment_event": lambda s, d: _firings(s, d, "event"),
    "abandonment_final": lambda s, d: abandonment.final_state(shopping_events(s, d, TRACKED)),
    "abandonment_log": lambda s, d: _log(s, d, "replay"),
    "abandonment_pages": lambda s, d: ranking.page_count(_log(s, d, "replay")),
    "abandoned_carts": lambda s, d: _carts(s, d, "replay"),
    "abandoned_carts_event": lambda s, d: _carts(s, d, "event"),
    "abandoned_page": lambda s, d: _page_with_products(s, d, 0, ranking.NEAR),
    "abandoned_page_deep": lambda s, d: _page_with_products(s, d, PAGE_DEEP, 20),
    "abandoned_page_after": _page_after_first,
    "clean_rows": _clean_rows,
    "rejected_rows": _rejected_rows,
    "event_json_roundtrip": _json_roundtrip,
    "json_rejects": _json_rejects,
    "csv_replay": _csv_replay,
    "time_shapes": _time_shapes,
    "stream_purchase_windows": lambda s, d: _plain_times(
        dashboard.purchase_windows(s, _live(s, d, jobs.purchase_windows))
    ),
    "stream_removal_windows": lambda s, d: _plain_times(
        dashboard.removal_windows(s, _live(s, d, jobs.removal_windows))
    ),
    "stream_user_activity": lambda s, d: _live_rows(s, d, jobs.user_activity),
    "stream_user_product": lambda s, d: _live_rows(s, d, jobs.user_product),
    "stream_abandonment_log": lambda s, d: _live_log(s, d, "event"),
    "stream_abandonment_arrival": lambda s, d: _live_log(s, d, "arrival"),
    "dashboard_top_purchased": lambda s, d: dashboard.top_purchased(s, _live(s, d, jobs.purchase_windows)),
    "dashboard_top_removed": lambda s, d: dashboard.top_removed(s, _live(s, d, jobs.removal_windows)),
    "dashboard_top_users": lambda s, d: dashboard.top_users(s, _live(s, d, jobs.user_activity)),
    "dashboard_unconverted_for_user": lambda s, d: dashboard.unconverted_for_user(
        s, _live(s, d, jobs.user_product), 15, 2
    ),
    "dashboard_abandoned_page": _live_page,
    "compacted_purchase_windows": lambda s, d: _plain_times(
        dashboard.purchase_windows(s, _live_compacted(s, d, partial(jobs.purchase_windows, delay=NEVER_LATE)))
    ),
    "compacted_top_purchased": lambda s, d: dashboard.top_purchased(
        s, _live_compacted(s, d, partial(jobs.purchase_windows, delay=NEVER_LATE))
    ),
    "compacted_user_activity": lambda s, d: read_latest(
        s, _live_compacted(s, d, jobs.user_activity), "user_activity"
    ),
    "reset_and_rerun": _reset_and_rerun,
    "compacted_for_user": lambda s, d: dashboard.unconverted_for_user(
        s, _live_compacted(s, d, jobs.user_product), 15, 2
    ),
}
