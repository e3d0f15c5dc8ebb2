"""Page rankings, page views and unique visitors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.operators import (
    bitmap_uniques,
    exact_uniques,
    salted_tumbling_counts,
    sketch_uniques,
    sliding_counts,
    top_n,
    tumbling_counts,
)

#: Fixed value: URLs of static assets, left in by default.
STATIC_ASSETS = r"\.(css|js)$"


def page_requests(log: DataFrame, method: str = "GET", skip_assets: bool = False) -> DataFrame:
    kept = log.filter(F.col("method") == method)
    return kept.filter(~F.col("url").rlike(STATIC_ASSETS)) if skip_assets else kept


def page_counts(
    log: DataFrame,
    size: str = "10 minutes",
    slide: str = "5 seconds",
    ts: str = "event_time",
    live_from: Column | None = None,
    **filters,
) -> DataFrame:
    """Requests per (url, window end)."""
    return sliding_counts(page_requests(log, **filters), ["url"], ts, size, slide, live_from=live_from)


def hot_pages(
    log: DataFrame,
    n: int = 3,
    size: str = "10 minutes",
    slide: str = "5 seconds",
    ts: str = "event_time",
    live_from: Column | None = None,
    **filters,
) -> DataFrame:
    """The most requested URLs per window.

    Runs are listed behind the shuffle that makes them, where the group limit keeps ``n``
    rows per window and task, so the long tail of URLs is never shuffled.
    """
    return top_n(page_counts(log, size, slide, ts, live_from, **filters), "url", n)


def _views(behavior: DataFrame, kind: str) -> DataFrame:
    return behavior.filter(F.col("behavior") == kind)


def page_views(behavior: DataFrame, size: str = "1 hour", kind: str = "pv", ts: str = "event_time") -> DataFrame:
    return tumbling_counts(_views(behavior, kind), [], ts, size)


def page_views_salted(
    behavior: DataFrame, salt_on: list[str], size: str = "1 hour", kind: str = "pv", ts: str = "event_time"
) -> DataFrame:
    return salted_tumbling_counts(_views(behavior, kind), ts, size, salt_on)


def unique_visitors(
    behavior: DataFrame, method: str = "exact", size: str = "1 hour", kind: str = "pv", ts: str = "event_time"
) -> DataFrame:
    form = {"exact": exact_uniques, "bitmap": bitmap_uniques, "sketch": sketch_uniques}[method]
    return form(_views(behavior, kind), "user_id", ts, size)
