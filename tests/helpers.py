"""Small hand-made event tables."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from trolley.functions.text import epoch_ms, has_time_shape, to_event_ts

EVENT = (
    "event_type string, product_id string, user_id bigint, user_session string, "
    "event_time string, arrival_ms bigint, ordinal bigint"
)
T0 = datetime(2020, 1, 1)


def at(seconds: float) -> str:
    """Event time text so many seconds after the start."""
    return (T0 + timedelta(seconds=seconds)).strftime("%Y-%m-%d %H:%M:%S") + " UTC"


def make_events(spark, rows: list[dict]):
    """Rows in arrival order; arrival defaults to the replay pace."""
    full = []
    for i, row in enumerate(rows):
        values = {
            "event_type": None,
            "product_id": "p",
            "user_id": 1,
            "user_session": "s",
            "event_time": at(0),
            "arrival_ms": i * 200,
            "ordinal": i,
        } | row
        full.append(tuple(values[c.split()[0]] for c in EVENT.split(", ")))
    return (
        spark.createDataFrame(full, EVENT)
        .withColumn("event_ts", to_event_ts(F.col("event_time")))
        .withColumn("time_ok", has_time_shape(F.col("event_time")))
        .withColumn("event_ms", epoch_ms(F.col("event_ts")))
        .withColumn("arrival_ts", F.timestamp_millis("arrival_ms"))
    )


def tuples(df, *columns):
    return sorted(tuple(r) for r in df.select(*(columns or df.columns)).collect())
