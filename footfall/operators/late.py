"""Late rows, by a watermark that follows arrival order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.functions.times import duration_us, floor_to, micros
from footfall.operators.cuts import CUT, ordered_cuts, running_before

ON_TIME, REFIRE, LATE = "on_time", "refire", "late"


def with_watermark_before(
    df: DataFrame, ts: str, arrival: str | Column, tie: str, delay: str, parts: int | None = None
) -> DataFrame:
    """Adds ``watermark_us``: the largest event time that arrived before the row, less ``delay``.

    The order is global.  Rows are sorted by arrival into row-balanced cuts, so a burst is
    spread like any other rows; only rows of one arrival and tie stay together.  Each cut keeps
    a running maximum, and one maximum per cut is carried on.  The rows are read once, and
    written as cuts to the shared folder; ``parts`` is the number of cuts at most.
    """
    order = F.col(arrival) if isinstance(arrival, str) else arrival
    keyed = df.withColumn("_us", micros(ts)).withColumn("_arrival", order.cast("bigint"))
    place = ["_arrival", tie]
    cuts = ordered_cuts(keyed, place, "arrivals", parts)
    seen = running_before(cuts, [], place, {"_seen": (F.max, F.col("_us"))}, {"_seen": F.greatest})
    return seen.withColumn("watermark_us", F.col("_seen") - F.lit(duration_us(delay))).drop(CUT, "_us", "_arrival", "_seen")


def split_late(
    df: DataFrame,
    ts: str,
    arrival: str | Column,
    tie: str,
    delay: str,
    size: str,
    slide: str,
    lateness: str,
    parts: int | None = None,
) -> DataFrame:
    """Tags each row by what its arrival does to its windows.

    A window fires when the watermark reaches its last millisecond and is dropped
    ``lateness`` later.  ``late``: all windows of the row are gone; ``refire``: at
    least one live window has fired already; ``on_time``: none has.  Also adds
    ``live_from_us``, the first window end that the row still counts in, for
    ``sliding_counts(live_from=...)``.
    """
    return window_tags(with_watermark_before(df, ts, arrival, tie, delay, parts), ts, size, slide, lateness)


def window_tags(marked: DataFrame, ts: str, size: str, slide: str, lateness: str) -> DataFrame:
    """Adds ``live_from_us`` and ``tag`` by ``watermark_us``, the watermark before the row."""
    size_us, slide_us, lateness_us = duration_us(size), duration_us(slide), duration_us(lateness)
    us, wm = micros(ts), F.col("watermark_us")
    first_end = floor_to(us, slide_us) + F.lit(slide_us)
    last_end = floor_to(us, slide_us) + F.lit(size_us)
    ms = F.lit(1_000)
    # smallest aligned end whose last millisecond plus lateness is still ahead of the watermark
    alive = floor_to(wm - F.lit(lateness_us) + ms, slide_us) + F.lit(slide_us)
    live_from = F.when(wm.isNull(), first_end).otherwise(F.greatest(first_end, alive))
    tag = (
        F.when(wm.isNull(), ON_TIME)
        .when(live_from > last_end, LATE)
        .when(live_from - ms <= wm, REFIRE)
        .otherwise(ON_TIME)
    )
    return marked.withColumn("live_from_us", live_from).withColumn("tag", tag)
