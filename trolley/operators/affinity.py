"""Views and cart flags per user and product, and views that led to no cart."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.schema import CART, MIN_VIEWS, VIEW


def user_product(events: DataFrame, period: tuple[str, str] | None = None) -> DataFrame:
    """View count and ever-added flag per (user, product); user 0 and empty products are dropped. With
    ``period`` (a time column and a width) per ``period_start``, too."""
    counted = (
        events.where(
            F.col("event_type").isin(VIEW, CART)
            & (F.col("user_id") != 0)
            & (F.col("product_id") != "")
        )
        .groupBy("user_id", "product_id", *([F.window(*period).alias("w")] if period else []))
        .agg(
            F.count_if(F.col("event_type") == VIEW).alias("views"),
            F.bool_or(F.col("event_type") == CART).alias("added"),
        )
    )
    start = [F.col("w.start").alias("period_start")] if period else []
    return counted.select("user_id", "product_id", *start, "views", "added")


def total(periods: DataFrame, since: datetime | None = None) -> DataFrame:
    """Views and flags per (user, product) from those per period, of all or of those from ``since`` on."""
    if since is not None:
        periods = periods.where(F.col("period_start") >= F.lit(since))
    return periods.groupBy("user_id", "product_id").agg(
        F.sum("views").cast("bigint").alias("views"), F.bool_or("added").alias("added")
    )


def unconverted_views(pairs: DataFrame, min_views: int = MIN_VIEWS, user_id: int | None = None) -> DataFrame:
    """Products viewed at least ``min_views`` times and never added to the cart.

    Takes the table of ``user_product``: one pass instead of an anti-join, and it also holds for
    a table that a stream keeps up to date. ``user_id`` narrows it to one user.
    """
    if user_id is not None:
        pairs = pairs.where(F.col("user_id") == user_id)
    return pairs.where((F.col("views") >= min_views) & ~F.col("added")).select(
        "user_id", "product_id", "views"
    )
