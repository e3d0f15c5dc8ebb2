"""Unique visitors per window: exact, by hashed bitmap, and by sketch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.functions.hashing import poly_offset
from footfall.functions.times import as_col, duration_us, event_time


def _window(df: DataFrame, ts: str, size: str) -> Column:
    return F.window(event_time(df, ts), size)


def _ms(duration: str) -> int:
    return duration_us(duration) // 1000


def exact_uniques(df: DataFrame, user: str, ts: str, size: str, count: str = "count") -> DataFrame:
    """Distinct users per window.

    The distinct shuffles on (window, user), so one busy window is spread over all
    tasks, and a busy user is combined on the map side.  A stream cannot aggregate
    distinct values; there the same two steps are a de-duplication and a count.
    """
    if df.isStreaming:
        seen = df.select(_window(df, ts, size).alias("_w"), user, ts).dropDuplicates(["_w", user])
        return (
            seen.groupBy("_w")
            .agg(F.count(F.lit(1)).alias(count))
            .select(F.unix_millis("_w.end").alias("window_end"), count)
        )
    return (
        df.groupBy(_window(df, ts, size).alias("_w"))
        .agg(F.count_distinct(user).alias(count))
        .select(F.unix_millis("_w.end").alias("window_end"), count)
    )


def bitmap_rollup(df: DataFrame, user: str | Column, ts: str, size: str) -> DataFrame:
    """Bitmaps of hashed users: one row per (window end, bucket of 32,768 bits).

    Rows are de-duplicated first with map-side combine, so repeated visits are not
    shipped; bitmaps are then built where the bucket's offsets meet, because
    partial bitmaps of sparse buckets would be larger than the offsets in them.
    """
    offset = poly_offset(as_col(user))
    offsets = df.select(
        F.unix_millis(_window(df, ts, size).end).alias("window_end"), offset.alias("_offset")
    ).distinct()
    return (
        offsets.select(
            "window_end",
            F.bitmap_bucket_number("_offset").alias("bucket"),
            F.bitmap_bit_position("_offset").alias("_bit"),
        )
        .repartition("window_end", "bucket")
        .groupBy("window_end", "bucket")
        .agg(F.bitmap_construct_agg("_bit").alias("bitmap"))
    )


def merge_bitmaps(*rollups: DataFrame) -> DataFrame:
    """One rollup from several, for windows filled by more than one load."""
    merged = rollups[0]
    for other in rollups[1:]:
        merged = merged.unionByName(other)
    return merged.groupBy("window_end", "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def count_bitmaps(rollup: DataFrame, count: str = "count") -> DataFrame:
    return rollup.groupBy("window_end").agg(F.sum(F.bitmap_count("bitmap")).alias(count))


def bitmap_uniques(df: DataFrame, user: str, ts: str, size: str, count: str = "count") -> DataFrame:
    """Distinct hashed users per window.

    Ids of up to five digits have distinct offsets; longer ids may share one, so
    the count can fall below the exact one.
    """
    return count_bitmaps(bitmap_rollup(df, user, ts, size), count)


def sketch_rollup(df: DataFrame, user: str, ts: str, size: str, log_k: int = 12) -> DataFrame:
    """Mergeable HyperLogLog sketches per window; state of a few KiB whatever the number of users."""
    return (
        df.groupBy(_window(df, ts, size).alias("_w"))
        .agg(F.hll_sketch_agg(user, log_k).alias("sketch"))
        .select(F.unix_millis("_w.end").alias("window_end"), "sketch")
    )


def sketch_uniques(df: DataFrame, user: str, ts: str, size: str, log_k: int = 12, count: str = "count") -> DataFrame:
    rollup = sketch_rollup(df, user, ts, size, log_k)
    return rollup.select("window_end", F.hll_sketch_estimate("sketch").alias(count))


#: Relative standard error of a sketch with 2**log_k registers, times the square root of their number.
_SPREAD = 1.04


def sliding_sketches(panes: DataFrame, size: str, slide: str) -> DataFrame:
    """Sketches of sliding windows from those of their panes, ``sketch_rollup`` of one ``slide``.

    A pane's sketch, a few KiB whatever the number of users, goes to the windows it lies in and
    is merged there; stored rollups serve windows of any multiple of the slide.
    """
    ends = F.sequence(F.col("window_end"), F.col("window_end") + F.lit(_ms(size) - _ms(slide)), F.lit(_ms(slide)).cast("bigint"))
    placed = panes.select(F.explode(ends).alias("window_end"), "sketch")
    return placed.groupBy("window_end").agg(F.hll_union_agg("sketch").alias("sketch"))


def sliding_uniques(df: DataFrame, user: str, ts: str, size: str, slide: str, count: str = "count") -> DataFrame:
    """Distinct users per sliding window, exactly.

    A user's panes are distinct before they are listed by window, so repeated visits are not.
    """
    pane = F.unix_millis(_window(df, ts, slide).end).alias("_pane")
    seen = df.select(user, pane).distinct()
    ends = F.sequence(F.col("_pane"), F.col("_pane") + F.lit(_ms(size) - _ms(slide)), F.lit(_ms(slide)).cast("bigint"))
    return seen.select(user, F.explode(ends).alias("window_end")).groupBy("window_end").agg(F.count_distinct(user).alias(count))


def error_bound(log_k: int, deviations: float = 4.0) -> float:
    """The relative error that an estimate keeps to but for one in 15,000, at four standard deviations."""
    return deviations * _SPREAD / 2 ** (log_k / 2)
