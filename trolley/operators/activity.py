"""Weighted activity score and event counts per user."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.schema import ACTIVITY_WEIGHTS, CART, PURCHASE, REMOVE, VIEW


def user_activity(
    events: DataFrame, weights: dict[str, int] = ACTIVITY_WEIGHTS, period: tuple[str, str] | None = None
) -> DataFrame:
    """Score and counts per user over all events whose type has a weight; with ``period`` (a time
    column and a width) per user and ``period_start``.

    The score is put together from the counts, after the aggregate. User 0 is a user like any
    other here; rows without a user belong to nobody and are left out.
    """

    def hits(kind: str):
        return F.count_if(F.col("event_type") == kind)

    counted = (
        events.where(F.col("event_type").isin(*weights) & F.col("user_id").isNotNull())
        .groupBy("user_id", *([F.window(*period).alias("w")] if period else []))
        .agg(*[hits(kind).alias(f"n_{kind}") for kind in sorted({*weights, VIEW, CART, PURCHASE, REMOVE})])
    )
    score = sum((F.col(f"n_{kind}") * weight for kind, weight in weights.items()), F.lit(0))
    return counted.select(
        "user_id",
        *([F.col("w.start").alias("period_start")] if period else []),
        score.cast("bigint").alias("score"),
        F.col(f"n_{VIEW}").alias("views"),
        F.col(f"n_{CART}").alias("cart_adds"),
        F.col(f"n_{PURCHASE}").alias("purchases"),
        F.col(f"n_{REMOVE}").alias("removals"),
    )


def total(periods: DataFrame, since: datetime | None = None) -> DataFrame:
    """Score and counts per user from those per period, of all periods or of those from ``since`` on."""
    if since is not None:
        periods = periods.where(F.col("period_start") >= F.lit(since))
    sums = [F.sum(c).cast("bigint").alias(c) for c in ("score", "views", "cart_adds", "purchases", "removals")]
    return periods.groupBy("user_id").agg(*sums)
