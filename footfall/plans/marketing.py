"""Channel counts and ad clicks by province."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.functions import bound_text, duration_us
from footfall.operators import click_cap, expand_runs, passed, sliding_count_runs, sliding_counts

#: Fixed value, spelled as the events' consumers expect: ``uninstall`` is counted.
EXCLUDED = ("unstall",)


def channel_count_runs(
    events: DataFrame,
    size: str = "1 hour",
    slide: str = "5 seconds",
    ts: str = "event_time",
    excluded: tuple[str, ...] = EXCLUDED,
) -> DataFrame:
    """Events per (channel, behavior) in every sliding window, as runs of equal counts."""
    kept = events.filter(~F.col("behavior").isin(*excluded))
    return sliding_count_runs(kept, ["channel", "behavior"], ts, size, slide)


def channel_counts(events: DataFrame, size: str = "1 hour", slide: str = "5 seconds", **options) -> DataFrame:
    """One row per (channel, behavior, window) with its bounds as text."""
    rows = expand_runs(channel_count_runs(events, size, slide, **options), slide)
    start = F.col("window_end") - F.lit(duration_us(size) // 1000)
    return rows.select(
        bound_text(start).alias("window_start"),
        bound_text("window_end").alias("window_end"),
        "channel",
        "behavior",
        "count",
    )


def province_counts(
    clicks: DataFrame,
    tie: str,
    key: tuple[str, ...] = ("user_id", "ad_id"),
    cap: int = 100,
    size: str = "1 hour",
    slide: str = "5 seconds",
    ts: str = "event_time",
    **options,
) -> DataFrame:
    """Clicks per (province, window) after the click cap."""
    kept = passed(click_cap(clicks.select(*key, "province", ts, tie), key, ts, tie, cap, **options))
    counts = sliding_counts(kept, ["province"], ts, size, slide)
    return counts.select(bound_text("window_end").alias("window_end"), "province", "count")
