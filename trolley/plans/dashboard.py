"""The reads a dashboard makes, on the result tables that the live jobs keep."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trolley.operators import abandonment, activity, affinity, ranking, windows
from trolley.schema import MIN_VIEWS, PAGE_SIZE, PURCHASE_WINDOW, REMOVAL_WINDOW
from trolley.sources.tables import lookup, lookup_range, read_latest, read_rows, read_totals


def purchase_windows(spark: SparkSession, root: str, window: tuple[str, str] = PURCHASE_WINDOW) -> DataFrame:
    """The windows of a live job, summed from its panes; ``window`` as the job has it, or of another
    size that is a multiple of its slide."""
    return windows.windows_of(read_latest(spark, root, "purchase_panes"), *window)


def removal_windows(spark: SparkSession, root: str, window: tuple[str, str] = REMOVAL_WINDOW) -> DataFrame:
    return windows.windows_of(read_latest(spark, root, "removal_panes"), *window)


def product_windows(spark: SparkSession, root: str, products: list[str], window: tuple[str, str] = PURCHASE_WINDOW) -> DataFrame:
    """The purchase windows of a few products, from the files that hold them."""
    return windows.windows_of(lookup(spark, root, "purchase_panes", products), *window)


def top_purchased(spark: SparkSession, root: str) -> DataFrame:
    return ranking.top_products(read_latest(spark, root, "latest_purchases"))


def top_removed(spark: SparkSession, root: str) -> DataFrame:
    return ranking.top_products(read_latest(spark, root, "latest_removals"))


def top_users(spark: SparkSession, root: str) -> DataFrame:
    return ranking.top_users(read_latest(spark, root, "user_activity"))


def unconverted_for_user(
    spark: SparkSession, root: str, user_id: int | None, min_views: int = MIN_VIEWS
) -> DataFrame:
    """One user's viewed but never added products; no user, no rows."""
    pairs = lookup(spark, root, "user_product", [] if user_id is None else [user_id])
    return affinity.unconverted_views(pairs, min_views, user_id)


def top_users_since(spark: SparkSession, root: str, since: datetime | None = None) -> DataFrame:
    """The top users by the periods from ``since`` on (all, by default) of ``user_activity_periods``."""
    return ranking.top_users(activity.total(read_latest(spark, root, "user_activity_periods"), since))


def unconverted_since(
    spark: SparkSession, root: str, user_id: int | None, since: datetime | None = None, min_views: int = MIN_VIEWS
) -> DataFrame:
    """One user's viewed but never added products by the periods from ``since`` on."""
    periods = lookup(spark, root, "user_product_periods", [] if user_id is None else [user_id])
    return affinity.unconverted_views(affinity.total(periods, since), min_views, user_id)


def page_with_lists(
    log: DataFrame,
    items: DataFrame,
    number: int = 0,
    size: int = PAGE_SIZE,
    near: int = ranking.NEAR,
    clock: str = "event",
) -> DataFrame:
    """A page of the log with the product lists, built for the sessions on the page only.

    A page has ``size`` rows at most. Up to ``ranking.NEAR`` it is fetched first, once, so that its
    sessions are a filter on both tables, which skips what a table sorted by session holds of others.
    """
    entries = ranking.page(log, number, size, near)
    if size > ranking.NEAR:
        sessions = entries.select("user_session").distinct()
        items, log = (t.join(sessions, "user_session", "left_semi") for t in (items, log))
    else:
        entries, sessions = _fetched(entries)
        items, log = (t.where(F.col("user_session").isin(sessions)) for t in (items, log))
    return ranking.with_products(entries, abandonment.abandoned_carts(items, log, clock), size)


def _fetched(entries: DataFrame) -> tuple[DataFrame, list[str]]:
    """The rows of a page, fetched once, and their sessions."""
    rows = entries.collect()
    return entries.sparkSession.createDataFrame(rows, entries.schema), sorted({r["user_session"] for r in rows})


def log_page(spark: SparkSession, root: str, number: int = 0, size: int = PAGE_SIZE) -> DataFrame:
    """A page of the live log, newest first. The counts say in which seconds it lies, however deep; of the
    log only files that have rows of these seconds are opened."""
    where = ranking.page_seconds(read_totals(spark, root, "abandonment_counts"), number, size)
    if where is None:
        return read_rows(spark, root, "abandonment_log").limit(0)
    first, last, skip = where
    low, high = (datetime.fromtimestamp(s, timezone.utc) for s in (first, last + 1))
    rows = lookup_range(spark, root, "abandonment_log", low, high).where(F.col("fired_at") < F.lit(high))
    return rows.orderBy(F.desc("fired_at"), "user_session").offset(skip).limit(size)


def abandoned_page(spark: SparkSession, root: str, number: int = 0, size: int = PAGE_SIZE) -> DataFrame:
    """The page with the product lists, from the files that hold its sessions."""
    if size > ranking.NEAR:
        log = read_rows(spark, root, "abandonment_log")
        return page_with_lists(log, read_rows(spark, root, "cart_items"), number, size)
    entries, sessions = _fetched(log_page(spark, root, number, size))
    items, last = (lookup(spark, root, name, sessions) for name in ("cart_items", "abandoned_sessions"))
    return ranking.with_products(entries, abandonment.abandoned_carts(items, last), size)


def abandoned_pages(spark: SparkSession, root: str, size: int = PAGE_SIZE) -> DataFrame:
    """Rows and pages of the live log, from its counts."""
    counts = read_totals(spark, root, "abandonment_counts")
    entries = F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("entries")
    return ranking.pages_of(counts.agg(entries), size)
