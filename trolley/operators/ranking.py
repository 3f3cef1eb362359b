"""Top lists and pages."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trolley.functions.text import epoch_ms
from trolley.schema import PAGE_SIZE, TOP_PRODUCTS, TOP_USERS

# Rows a plain top-n may look at; deeper pages are first narrowed down by counting.
NEAR = 10_000
SECOND_MS = 1000
DAY_MS = 86_400_000


def top_products(latest: DataFrame, n: int = TOP_PRODUCTS) -> DataFrame:
    """The ``n`` products with the highest count of their latest window; ties by product."""
    return latest.select("product_id", "cnt").orderBy(F.desc("cnt"), "product_id").limit(n)


def top_users(activity: DataFrame, n: int = TOP_USERS) -> DataFrame:
    """The ``n`` users with the highest score; ties by user."""
    return activity.orderBy(F.desc("score"), "user_id").limit(n)


def page_count(log: DataFrame, size: int = PAGE_SIZE) -> DataFrame:
    """Rows in the log and number of pages; an empty log still has one page."""
    return pages_of(log.agg(F.count("*").alias("entries")), size)


def pages_of(entries: DataFrame, size: int = PAGE_SIZE) -> DataFrame:
    pages = F.greatest(F.lit(1), F.ceil(F.col("entries") / size)).cast("bigint")
    return entries.select("entries", pages.alias("pages"))


def page(log: DataFrame, number: int = 0, size: int = PAGE_SIZE, near: int = NEAR) -> DataFrame:
    """Page ``number`` (from 0) of the log, newest first; ties by session.

    A page far from the top is found by counting rows per day, then per second, then per
    millisecond, and keeping only the slices the page lies in: the sort never sees what comes
    before, however deep the page is. Each of those steps reads the log, so give it a written one.
    """
    skip = number * size
    for width in (DAY_MS, SECOND_MS, 1):
        if skip + size <= near:
            break
        log, skip = _narrow(log, width, skip, size)
    return log.orderBy(F.desc("fired_at"), "user_session").offset(skip).limit(size)


def touched(counts: DataFrame, skip: int, size: int) -> tuple[list[int], int]:
    """Of slices (``slice``, ``n``), newest first, those that the rows ``skip`` to ``skip + size`` lie in,
    and the place of the first row of the first."""
    # One line per slice that has rows: bounded by the time covered, not by the rows.
    newer = Window.orderBy(F.desc("slice")).rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("n").over(newer), F.lit(0))
    # Every slice holds a row or more, so at most ``size`` + 1 of them touch the page.
    found = (
        counts.select("slice", "n", start.alias("start"))
        .where((F.col("start") < skip + size) & (F.col("start") + F.col("n") > skip))
        .collect()
    )
    return [r["slice"] for r in found], min((r["start"] for r in found), default=0)


def _narrow(log: DataFrame, width: int, skip: int, size: int) -> tuple[DataFrame, int]:
    slice_ = F.floor(epoch_ms(F.col("fired_at")) / width)
    slices, start = touched(log.groupBy(slice_.alias("slice")).agg(F.count("*").alias("n")), skip, size)
    if not slices:
        return log.where(F.lit(False)), 0
    return log.where(slice_.isin(slices)), skip - start


def slice_counts(log: DataFrame) -> DataFrame:
    """Rows of the log per day and second, the table that deep pages are found by."""
    ms = epoch_ms(F.col("fired_at"))
    by = [F.floor(ms / DAY_MS).alias("day"), F.floor(ms / SECOND_MS).alias("second")]
    return log.groupBy(*by).agg(F.count("*").alias("n"))


def page_seconds(counts: DataFrame, number: int, size: int = PAGE_SIZE) -> tuple[int, int, int] | None:
    """The first and the last second that hold rows of a page, and how many rows of these come before it;
    None if there is no such page. Reads ``counts`` (as ``slice_counts`` makes them) twice: by day, then
    the seconds of the days that the page lies in."""
    skip = number * size
    for name in ("day", "second"):
        found, start = touched(counts.groupBy(F.col(name).alias("slice")).agg(F.sum("n").alias("n")), skip, size)
        if not found:
            return None
        skip, counts = skip - start, counts.where(F.col(name).isin(found))
    return min(found), max(found), skip


def page_after(
    log: DataFrame, fired_at: datetime, user_session: str, size: int = PAGE_SIZE
) -> DataFrame:
    """The page following a given row: no counting, the filter reaches the scan."""
    last = F.lit(fired_at).cast(log.schema["fired_at"].dataType)
    older = (F.col("fired_at") < last) | (
        (F.col("fired_at") == last) & (F.col("user_session") > user_session)
    )
    return (
        log.where((F.col("fired_at") <= last) & older)
        .orderBy(F.desc("fired_at"), "user_session")
        .limit(size)
    )


def page_side(df: DataFrame, size: int) -> DataFrame:
    """Mark a frame of at most ``size`` rows for broadcast, if that is few."""
    return F.broadcast(df) if size <= NEAR else df


def with_products(entries: DataFrame, carts: DataFrame, size: int = PAGE_SIZE) -> DataFrame:
    """Join a page of the log to the product lists, newest first; sessions without one are skipped.

    The parts of a long list follow each other, newest items first.
    """
    return carts.join(page_side(entries, size), "user_session").select(
        "user_session",
        "fired_at",
        "chunk",
        F.array_join("products", ", ").alias("products"),
    ).orderBy(F.desc("fired_at"), "user_session", F.desc("chunk"))
