"""Raw rows and JSON lines with faults, derived from the events table.

The test tables are clean, so every 20th row gets one particular fault; the rest stay good. The
SQL twins in ``oracle`` inject the same faults.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# event_id % 20 -> (column, text put there; NULL text means the field is missing)
FAULTS = {
    2: ("user_id", "abc"),
    3: ("user_id", ""),
    4: ("user_id", "nan"),
    5: ("price", "nan"),
    6: ("category_id", "1487580005268456287"),
    7: ("user_id", "1e300"),
    8: ("category_id", "0x10"),
    9: ("event_time", None),
    10: ("price", "1.0d"),
    11: ("price", "inf"),
    12: ("user_id", "1_000"),
    13: ("user_id", "-5.9"),
    15: ("category_id", "inf"),
}

RAW_COLUMNS = [
    "event_id",
    "event_time",
    "event_type",
    "product_id",
    "category_id",
    "price",
    "user_id",
    "user_session",
]


def _with_faults(name: str, text: Column) -> Column:
    turn = F.col("event_id") % 20
    for place, (column, fault) in FAULTS.items():
        if column == name:
            text = F.when(turn == place, F.lit(fault).cast("string")).otherwise(text)
    return text


def raw_rows(table: DataFrame) -> DataFrame:
    """The events table as raw text rows, some of them faulty."""
    turn = F.col("event_id") % 20
    user = F.col("user_id").cast("string")
    time = F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit(" UTC"))
    padded_user = F.when(turn == 0, F.concat(F.lit(" "), user, F.lit(" "))).when(
        turn == 1, F.concat(user, F.lit(".9"))
    )
    columns = {
        "event_time": F.when(turn == 14, F.concat(F.lit("\t"), time, F.lit("  "))).otherwise(time),
        "event_type": F.col("event_type"),
        "product_id": F.get_json_object("props", "$.k"),
        "category_id": (F.col("event_id") % 7).cast("string"),
        "price": F.col("value").cast("string"),
        "user_id": F.coalesce(padded_user, user),
        "user_session": F.concat_ws("-", "user_id", F.date_format("ts", "yyyy-MM-dd")),
    }
    return table.select(
        "event_id", *[_with_faults(name, text).alias(name) for name, text in columns.items()]
    )


def json_lines(table: DataFrame) -> DataFrame:
    """One JSON line per event; by turns broken, an array, without a user, or good."""
    turn = F.col("event_id") % 5
    user = F.when(turn == 2, "").otherwise(F.concat(F.lit(',"user_id":'), F.col("user_id").cast("string")))
    line = F.concat(
        F.lit('{"event_id":'),
        F.col("event_id").cast("string"),
        F.lit(',"event_type":"view"'),
        user,
        F.when(turn == 0, "").otherwise("}"),
    )
    return table.select(
        F.when(turn == 1, F.concat(F.lit("["), line, F.lit("]"))).otherwise(line).alias("value")
    )


def time_texts(table: DataFrame) -> DataFrame:
    """The events' times as texts: by turns as sent, in one part, in three, with tabs, no real date, none."""
    turn = F.col("event_id") % 6
    date, clock = F.date_format("ts", "yyyy-MM-dd"), F.date_format("ts", "HH:mm:ss")
    text = (
        F.when(turn == 0, F.concat(date, F.lit(" "), clock, F.lit(" UTC")))
        .when(turn == 1, F.concat(date, F.lit("T"), clock))
        .when(turn == 2, F.concat(date, F.lit(" "), clock, F.lit(" extra")))
        .when(turn == 3, F.concat(F.lit("\t"), date, F.lit(" \t"), clock, F.lit(" ")))
        .when(turn == 4, F.concat(F.date_format("ts", "yyyy"), F.lit("-13-01 "), clock))
    )
    return table.select("event_id", text.alias("event_time"))
