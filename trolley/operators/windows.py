"""Sliding-window counts per product."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.schema import PURCHASE, PURCHASE_WINDOW, REMOVAL_WINDOW, REMOVE


def sliding_counts(events: DataFrame, kind: str, time_col: str, size: str, slide: str) -> DataFrame:
    """Count events of one type per product and sliding window.

    Windows are start-inclusive, end-exclusive and aligned to the epoch; empty ones are absent.
    Each row is expanded to its windows before the partial aggregate, so a hot product leaves a
    task as one row per window and the shuffle key (product, window) spreads it.
    """
    return (
        events.where((F.col("event_type") == kind) & F.col("product_id").isNotNull())
        .groupBy("product_id", F.window(time_col, size, slide).alias("w"))
        .agg(F.count("*").alias("cnt"))
        .select(
            "product_id",
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            "cnt",
        )
    )


def pane_width(size: str, slide: str) -> str:
    """The widest panes that windows of ``size`` every ``slide`` are made of."""
    return f"{math.gcd(microseconds(size), microseconds(slide))} microseconds"


def microseconds(interval: str) -> int:
    """An interval such as ``3 seconds`` or ``1 hour``."""
    return pd.Timedelta(interval).value // 1000


def panes(events: DataFrame, kind: str, time_col: str, width: str) -> DataFrame:
    """Count events of one type per product and pane: windows that don't overlap.

    One row, and on a stream one row of state, per product and pane that has events.
    """
    return (
        events.where((F.col("event_type") == kind) & F.col("product_id").isNotNull())
        .groupBy("product_id", F.window(time_col, width).alias("w"))
        .agg(F.count("*").alias("cnt"))
        .select("product_id", F.col("w.start").alias("pane_start"), "cnt")
    )


def windows_of(counted: DataFrame, size: str, slide: str) -> DataFrame:
    """The sliding counts that panes of ``pane_width`` add up to."""
    return (
        counted.groupBy("product_id", F.window("pane_start", size, slide).alias("w"))
        .agg(F.sum("cnt").alias("cnt"))
        .select("product_id", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "cnt")
    )


def sliding_counts_by_slide(events: DataFrame, kind: str, time_col: str, size: str, slide: str) -> DataFrame:
    """The same as ``sliding_counts`` for windows many slides long, through panes.

    Rows are first counted per pane, then the counts are expanded and summed, so the expansion works
    on one row per product and pane instead of on every event.
    """
    return windows_of(panes(events, kind, time_col, pane_width(size, slide)), size, slide)


def latest_of(windows: DataFrame) -> DataFrame:
    """Per product, the count of its latest window (what an overwrite per product leaves)."""
    return windows.groupBy("product_id").agg(
        F.max("window_start").alias("window_start"), F.max_by("cnt", "window_start").alias("cnt")
    )


def latest_counts(events: DataFrame, kind: str, time_col: str, slide: str) -> DataFrame:
    """``latest_of`` straight from events.

    The last window that holds a product's last event starts at that event's slide, and nothing
    comes later, so counting per slide is enough: no row is expanded.
    """
    return latest_of(sliding_counts(events, kind, time_col, slide, slide))


def purchase_windows(events: DataFrame, time_col: str, window: tuple[str, str] = PURCHASE_WINDOW) -> DataFrame:
    return sliding_counts(events, PURCHASE, time_col, *window)


def removal_windows(events: DataFrame, time_col: str, window: tuple[str, str] = REMOVAL_WINDOW) -> DataFrame:
    return sliding_counts(events, REMOVE, time_col, *window)
