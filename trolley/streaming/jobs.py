"""The live jobs: event stream in, result table out, each restartable from its checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from trolley.operators import abandonment, activity, affinity, cleaning, ranking, windows
from trolley.schema import (
    ABANDON_AFTER_SECONDS,
    PERIOD,
    PERIOD_DELAY,
    PURCHASE,
    PURCHASE_WINDOW,
    REMOVAL_WINDOW,
    REMOVE,
    REPLAY_STEP_MS,
    TOPIC,
    WATERMARK_DELAY,
)
from trolley.session import configure
from trolley.sources import tables, topic
from trolley.streaming import timers


#: The columns each job needs of an event: give them to ``topic.parse``, which then reads no other field.
COLUMNS = {
    "purchase_windows": ("event_type", "product_id", "event_ts"),
    "removal_windows": ("event_type", "product_id", "event_ts"),
    "user_activity": ("event_type", "user_id"),
    "user_activity_periods": ("event_type", "user_id"),
    "user_product": ("event_type", "user_id", "product_id"),
    "user_product_periods": ("event_type", "user_id", "product_id"),
    "abandonment_log": ("event_type", "user_session", "product_id", "event_ts", "event_ms", "time_ok"),
    "cart_items": ("event_type", "user_session", "product_id", "event_ts", "event_ms", "time_ok"),
}


def live(events: DataFrame) -> DataFrame:
    """Events with zoned timestamps, the only kind that watermarks take."""
    if "event_ts" in events.columns:
        events = events.withColumn("event_ts", F.col("event_ts").cast("timestamp"))
    return events.withColumn("arrival_ts", F.coalesce(F.timestamp_millis("arrival_ms"), F.current_timestamp()))


def start(
    frame: DataFrame,
    root: str,
    name: str,
    mode: str,
    interval: str | None = None,
    checkpoints: str | None = None,
    derived: dict | None = None,
    compact_every: int | None = None,
) -> StreamingQuery:
    """Run ``frame`` into the table ``name``: all there is and stop, or every ``interval``.

    ``derived`` names further tables and how their rows follow from a micro-batch. ``compact_every``
    compacts the tables after so many micro-batches (see ``tables.compact``).

    The number of state partitions is fixed by the session's shuffle partitions at the first
    start of a checkpoint; choose it for the largest state expected.
    """
    configure(frame.sparkSession)
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return (
        frame.writeStream.queryName(name)
        .outputMode(mode)
        .option("checkpointLocation", f"{checkpoints or root + '/_checkpoints'}/{name}")
        .foreachBatch(tables.batch_writer(root, name, derived, compact_every))
        .trigger(**trigger)
        .start()
    )


def _panes(events: DataFrame, kind: str, time_col: str, window: tuple[str, str], delay: str | None) -> DataFrame:
    if windows.pane_width(*window) != windows.pane_width(window[1], window[1]):
        raise ValueError("the size of live windows must be a multiple of their slide")
    # Arrival times come in order, so nothing has to be waited for.
    delay = delay or ("0 seconds" if time_col == "arrival_ts" else WATERMARK_DELAY)
    # A pane counts until the last window it is in has passed.
    delay = f"{delay} {windows.microseconds(window[0]) - windows.microseconds(window[1])} microseconds"
    of_kind = live(events).where((F.col("event_type") == kind) & F.col(time_col).isNotNull())
    return windows.panes(of_kind.withWatermark(time_col, delay), kind, time_col, window[1])


def _latest(panes: DataFrame) -> DataFrame:
    """A product's last window starts with the last pane it has; no later pane has anything."""
    return windows.latest_of(panes.withColumnRenamed("pane_start", "window_start"))


def purchase_windows(
    events: DataFrame,
    root: str,
    time_col: str = "event_ts",
    window: tuple[str, str] = PURCHASE_WINDOW,
    delay: str | None = None,
    **run,
) -> StreamingQuery:
    """Counts per pane, of which ``dashboard.purchase_windows`` makes the windows when it reads.

    State and table have a row per product and slide, not one per window. Every micro-batch writes the
    panes it changed; ``time_col="arrival_ts"`` goes by arrival. The watermark only bounds the state:
    an event is dropped if all its windows are over for ``delay`` (10 minutes, by arrival none). The
    latest window per product is kept in a table of its own, which the top list reads.
    """
    frame = _panes(events, PURCHASE, time_col, window, delay)
    return start(frame, root, "purchase_panes", "update", derived={"latest_purchases": _latest}, **run)


def removal_windows(
    events: DataFrame,
    root: str,
    time_col: str = "event_ts",
    window: tuple[str, str] = REMOVAL_WINDOW,
    delay: str | None = None,
    **run,
) -> StreamingQuery:
    """The same for products removed from carts."""
    frame = _panes(events, REMOVE, time_col, window, delay)
    return start(frame, root, "removal_panes", "update", derived={"latest_removals": _latest}, **run)


def user_activity(events: DataFrame, root: str, **run) -> StreamingQuery:
    """Running totals; each micro-batch writes the users it changed."""
    return start(activity.user_activity(events), root, "user_activity", "update", **run)


def user_product(events: DataFrame, root: str, **run) -> StreamingQuery:
    return start(affinity.user_product(events), root, "user_product", "update", **run)


def user_activity_periods(
    events: DataFrame, root: str, width: str = PERIOD, delay: str = PERIOD_DELAY, **run
) -> StreamingQuery:
    """Totals per user and period of arrival: a period's state goes when it has been over for ``delay``.

    The table keeps the periods, and ``dashboard.top_users_since`` adds them up, so totals stay right
    while the state holds the users of the last period or two only. Rows that arrive later than
    ``delay`` are dropped; without a recorded arrival none are.
    """
    arrived = live(events).withWatermark("arrival_ts", delay)
    frame = activity.user_activity(arrived, period=("arrival_ts", width))
    return start(frame, root, "user_activity_periods", "update", **run)


def user_product_periods(
    events: DataFrame, root: str, width: str = PERIOD, delay: str = PERIOD_DELAY, **run
) -> StreamingQuery:
    """Views and flags per user, product and period of arrival; as ``user_activity_periods``."""
    arrived = live(events).withWatermark("arrival_ts", delay)
    frame = affinity.user_product(arrived, period=("arrival_ts", width))
    return start(frame, root, "user_product_periods", "update", **run)


def abandonment_log(
    events: DataFrame,
    root: str,
    clock: str = "event",
    seconds: int = ABANDON_AFTER_SECONDS,
    delay: str = WATERMARK_DELAY,
    forget: int | None = None,
    **run,
) -> StreamingQuery:
    """Abandoned firings: by event time, by recorded arrivals (``clock="arrival"``) or by the wall
    clock (``clock="ingest"``).

    Counts per second and the last firing of each session are kept in tables of their own, for pages.
    ``delay`` is how late a row may be on the first two clocks. ``forget`` drops the state of
    sessions so many seconds after their last row.

    Timers of the wall clock, and ``forget``, are always waiting for the time to pass, so such a job
    never runs out of things to do: it takes an interval (one second by default) and runs until it
    is stopped.
    """
    if clock == "ingest" or forget is not None:
        run.setdefault("interval", "1 second")
    if clock == "ingest":
        frame = timers.abandonment_by_ingest(events, seconds, forget)
    else:
        frame = timers.abandonment_by_time(events, f"{clock}_ms", seconds, delay, forget)
    derived = {"abandonment_counts": ranking.slice_counts, "abandoned_sessions": abandonment.last_firings}
    return start(frame, root, "abandonment_log", "append", derived=derived, **run)


def cart_items(events: DataFrame, root: str, clock: str = "event", **run) -> StreamingQuery:
    """Cart events as list items, from which the product lists are read."""
    if clock != "ingest":
        frame = abandonment.cart_items(events, clock)
    else:
        now_ms = F.unix_millis(F.current_timestamp())
        arrived = events.withColumn("arrival_ms", F.coalesce("arrival_ms", now_ms))
        frame = abandonment.cart_items(arrived, "arrival")
    return start(frame, root, "cart_items", "append", **run)


def rejects(parsed: DataFrame, root: str, needs: tuple[str, ...] = (), **run) -> StreamingQuery:
    return start(topic.rejects(parsed, needs), root, "rejects", "append", **run)


def replay_rejects(raw: DataFrame, root: str, **run) -> StreamingQuery:
    """The raw CSV rows that a replay leaves out, as JSON with a reason, into the table ``rejects``."""
    bad = cleaning.rejected(raw)
    line = F.to_json(F.struct(*cleaning.payload(raw).columns), {"ignoreNullFields": "false"})
    return start(bad.select(line.alias("value"), "reason"), root, "rejects", "append", **run)


def _sent(lines: DataFrame, servers: str, checkpoint: str, topic_name: str, trigger: dict) -> StreamingQuery:
    return (
        lines.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic_name)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def replay_to_topic(
    raw: DataFrame, servers: str, checkpoint: str, topic_name: str = TOPIC, interval: str = "200 milliseconds"
) -> StreamingQuery:
    """Clean a stream of raw CSV rows and send it to the topic, paced by the trigger."""
    lines = topic.encode(cleaning.payload(cleaning.clean(raw)))
    return _sent(lines, servers, checkpoint, topic_name, {"processingTime": interval})


def replay_to_files(
    raw: DataFrame, folder: str, checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """The same into a folder of JSON lines, which ``read_lines_stream`` takes as a topic."""
    lines = topic.encode(cleaning.payload(cleaning.clean(raw)))
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return (
        lines.writeStream.format("text")
        .option("path", folder)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def prepare_replay(raw: DataFrame, folder: str) -> None:
    """Number the clean rows in file order, and write them sorted by number for ``replay_by_pace``."""
    numbered = cleaning.payload(cleaning.number_rows(cleaning.clean(raw)))
    rows = numbered.repartitionByRange("ordinal").sortWithinPartitions("ordinal")
    rows.write.parquet(folder)


def replay_by_pace(
    spark: SparkSession,
    prepared: str,
    checkpoint: str,
    folder: str | None = None,
    servers: str | None = None,
    topic_name: str = TOPIC,
    per_second: int = 1000 // REPLAY_STEP_MS,
    interval: str = "1 second",
) -> StreamingQuery:
    """Send prepared rows in their order, ``per_second`` of them a second, to a folder of lines or a topic.

    A clock counts rows up from the first start, and each micro-batch reads the rows whose numbers have
    come up; sorted files skip all others. The clock's offset is the checkpoint's, so a restart repeats
    and leaves out nothing, and makes up for the time in between. A micro-batch that has its folder
    already isn't written again. On a topic a failed micro-batch may be sent twice. The job idles after
    the last row until it is stopped.
    """
    rows = spark.read.parquet(prepared)
    clock = spark.readStream.format("rate").option("rowsPerSecond", per_second).load()

    def send(batch: DataFrame, batch_id: int) -> None:
        low, high = batch.agg(F.min("value"), F.max("value")).first()
        if low is None:
            return
        due = rows.where(F.col("ordinal").between(low, high)).orderBy("ordinal")
        lines = topic.encode(due.drop("ordinal", "arrival_ms"))
        if servers:
            topic.write_topic(lines, servers, topic_name)
        else:
            topic.write_lines_once(lines, f"{folder}/{batch_id:012d}")

    return (
        clock.writeStream.queryName("replay")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(send)
        .trigger(processingTime=interval)
        .start()
    )
