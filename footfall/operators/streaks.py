"""Failure streaks: consecutive failures of a key, ended by any other event.

State is carried over any number of rows, so the look-ahead is unbounded and a
halo would not do.  A key of ordinary size is scanned as a whole.  The rows of a
hot key are scanned inside (key, block); one summary row per (key, block) is
scanned per key, and the carry is joined back to the rows, which are already
partitioned for it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.functions.times import duration_us, micros, micros_to_ts
from footfall.operators.blocks import BLOCK, batch_only, split_hot_keys, with_block


#: The texts of the warnings of streaks within two seconds.
ANCHORED_TEXT, CHAINED_TEXT = "login fail in 2s for %d times.", "login fail"


def failure_streaks(
    df: DataFrame,
    key: Sequence[str],
    ts: str,
    tie: str,
    is_fail: Column,
    linked_within: str,
    block: str | None = None,
    hot_rows: int = 5_000_000,
) -> DataFrame:
    """Each failure with its place in its streak, in order of (``ts``, ``tie``).

    Columns: the key, ``us`` (event time, µs), ``first_us`` (streak's first
    failure), ``prev_us`` (failure before, NULL at the start), ``position`` (from
    1) and ``linked`` (no gap in the streak so far exceeds ``linked_within``).

    Keys with more than ``hot_rows`` rows are cut into time blocks; ``block`` cuts
    every key by a fixed length instead and saves the count of rows per key.
    """
    batch_only(df, "streaming.processors.AnchoredFailures or ChainedFailures")
    gap_us = duration_us(linked_within)
    rows = df.select(
        *key,
        micros(ts).alias("_us"),
        F.col(tie).alias("_tie"),
        F.coalesce(is_fail, F.lit(False)).alias("_fail"),
    )
    # rows without key or time are in no streak; saying so here keeps the two uses
    # of blocked rows equal, so that they share one shuffle
    for c in (*key, "_us"):
        rows = rows.filter(F.col(c).isNotNull())
    if block:
        blocked = with_block(rows, F.col("_us"), duration_us(block)).filter(F.col(BLOCK).isNotNull())
    else:
        blocked = split_hot_keys(rows, key, "_us", hot_rows)

    parts = list(key) if blocked is None else [*key, BLOCK]
    inside = Window.partitionBy(*parts).orderBy("_us", "_tie")
    event = F.struct("_fail", "_us")
    local = (rows if blocked is None else blocked).select(
        "*",
        F.row_number().over(inside).cast("bigint").alias("_i"),
        F.lag(event).over(inside).alias("_prev"),
    )

    def starts(now: Column, prev: Column) -> Column:
        return now["_fail"] & ~F.coalesce(prev["_fail"], F.lit(False))

    def breaks(now: Column, prev: Column) -> Column:
        return now["_fail"] & F.coalesce(prev["_fail"], F.lit(False)) & (now["_us"] - prev["_us"] > F.lit(gap_us))

    start, broken = starts(event, F.col("_prev")), breaks(event, F.col("_prev"))
    at, carried, carried_ok = F.col("_i"), F.lit(None), F.lit(None)
    if blocked is not None:
        local = local.join(_carries(local, key, event, starts, breaks), parts)
        local = local.withColumn("_prev", F.when(F.col("_i") > 1, F.col("_prev")).otherwise(F.col("_prev_tail")))
        at, carried, carried_ok = F.col("_before") + F.col("_i"), F.col("_carried"), F.col("_carried_ok")

    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    here = F.struct(F.col("_us").alias("us"), at.alias("i"))
    mark = F.when(start, True).when(broken, False)
    scanned = local.select(
        *key,
        "_us",
        "_fail",
        at.alias("_at"),
        F.when(~start, F.col("_prev._us")).alias("prev_us"),
        F.coalesce(F.last(F.when(start, here), ignorenulls=True).over(upto), carried).alias("_first"),
        F.coalesce(F.last(mark, ignorenulls=True).over(upto), carried_ok).alias("linked"),
    )
    return scanned.filter("_fail").select(
        *key,
        F.col("_us").alias("us"),
        F.col("_first.us").alias("first_us"),
        "prev_us",
        (F.col("_at") - F.col("_first.i") + 1).alias("position"),
        "linked",
    )


def _carries(local: DataFrame, key: Sequence[str], event: Column, starts, breaks) -> DataFrame:
    """What each (key, block) takes over from the blocks before: number of rows, last
    row, and the open streak's start and linkage."""
    later = F.col("_i") > 1
    start, broken = starts(event, F.col("_prev")), breaks(event, F.col("_prev"))
    blocks = local.groupBy(*key, BLOCK).agg(
        F.max("_i").alias("_n"),
        F.max(F.when(~later, event)).alias("_head"),
        F.max_by(event, "_i").alias("_tail"),
        F.max(F.when(later & start, F.struct("_i", "_us"))).alias("_anchor"),
        F.max(F.when(later & (start | broken), F.struct(F.col("_i"), start.alias("ok")))).alias("_chain"),
    )
    per_key = Window.partitionBy(*key).orderBy(BLOCK)
    earlier = per_key.rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(
        "*",
        F.lag("_tail").over(per_key).alias("_prev_tail"),
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
    )
    head_start = starts(F.col("_head"), F.col("_prev_tail"))
    head_broken = breaks(F.col("_head"), F.col("_prev_tail"))

    def place(us: Column, i: Column) -> Column:
        return F.struct(us.alias("us"), (F.col("_before") + i).alias("i"))

    anchor = F.when(F.col("_anchor").isNotNull(), place(F.col("_anchor._us"), F.col("_anchor._i"))).when(
        head_start, place(F.col("_head._us"), F.lit(1))
    )
    chain = F.coalesce(F.col("_chain.ok"), F.when(head_start, True).when(head_broken, False))
    return blocks.select(
        *key,
        BLOCK,
        "_before",
        "_prev_tail",
        F.last(anchor, ignorenulls=True).over(earlier).alias("_carried"),
        F.last(chain, ignorenulls=True).over(earlier).alias("_carried_ok"),
    )


def anchored_alerts(
    df: DataFrame,
    key: Sequence[str],
    ts: str,
    tie: str,
    is_fail: Column,
    within: str = "2 seconds",
    block: str | None = None,
    hot_rows: int = 5_000_000,
    label: str = ANCHORED_TEXT,
) -> DataFrame:
    """A warning for each failure less than ``within`` after the first of its streak.

    ``msg`` gives the number of failures before this one in the streak.
    """
    streaks = failure_streaks(df, key, ts, tie, is_fail, within, block, hot_rows)
    hit = (F.col("position") > 1) & (F.col("us") - F.col("first_us") < F.lit(duration_us(within)))
    return streaks.filter(hit).select(
        *key,
        micros_to_ts("first_us").alias("first_fail_time"),
        micros_to_ts("us").alias("last_fail_time"),
        F.format_string(label, (F.col("position") - 1)).alias("msg"),
    )


def chained_alerts(
    df: DataFrame,
    key: Sequence[str],
    ts: str,
    tie: str,
    is_fail: Column,
    within: str = "2 seconds",
    block: str | None = None,
    hot_rows: int = 5_000_000,
    label: str = CHAINED_TEXT,
) -> DataFrame:
    """A warning for each failure at most ``within`` after the last matched one of its streak.

    The remembered failure moves on a match only.  In event-time order a gap that
    is too long therefore ends the alerts of the streak: every later failure is
    further away still.  So a failure warns if no gap before it was too long.
    """
    streaks = failure_streaks(df, key, ts, tie, is_fail, within, block, hot_rows)
    return streaks.filter((F.col("position") > 1) & F.col("linked")).select(
        *key,
        micros_to_ts("prev_us").alias("first_fail_time"),
        micros_to_ts("us").alias("last_fail_time"),
        F.lit(label).alias("msg"),
    )
