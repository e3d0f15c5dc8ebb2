"""Window counts.

Tumbling counts use Spark's ``window``.  A batch sliding count does not copy a
row into each of its ``size / slide`` windows (720 for one hour by five seconds):
it counts panes, turns each pane into a step up at its first window end and a
step down after its last, and takes a running sum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.functions.times import duration_us, event_time, floor_to, micros, step_number
from footfall.operators.blocks import BLOCK


def tumbling_counts(df: DataFrame, keys: list[str], ts: str, size: str, count: str = "count") -> DataFrame:
    """Rows per (keys, window).  Partial aggregation makes a salt unnecessary."""
    win = F.window(event_time(df, ts), size)
    return (
        df.groupBy(*keys, win.alias("_w"))
        .agg(F.count(F.lit(1)).alias(count))
        .select(*keys, F.unix_millis("_w.end").alias("window_end"), count)
    )


def salted_tumbling_counts(
    df: DataFrame, ts: str, size: str, salt_on: list[str], salts: int = 64, count: str = "count"
) -> DataFrame:
    """Two-level count: per (window, salt), then per window.

    Equal to the one-level count.  Kept for inputs whose map side combines badly;
    the salt is a hash of row columns, so a retried task gives the same rows.
    """
    win = F.window(event_time(df, ts), size)
    salt = F.pmod(F.xxhash64(*salt_on), F.lit(salts))
    return (
        df.groupBy(win.alias("_w"), salt.alias("_salt"))
        .agg(F.count(F.lit(1)).alias("_part"))
        .groupBy(F.unix_millis("_w.end").alias("window_end"))
        .agg(F.sum("_part").alias(count))
    )


def naive_sliding_counts(
    df: DataFrame, keys: list[str], ts: str, size: str, slide: str, count: str = "count"
) -> DataFrame:
    """Sliding counts by Spark's ``window``; the form for streams and the yardstick in tests."""
    win = F.window(event_time(df, ts), size, slide)
    return (
        df.groupBy(*keys, win.alias("_w"))
        .agg(F.count(F.lit(1)).alias(count))
        .select(*keys, F.unix_millis("_w.end").alias("window_end"), count)
    )


def pane_counts(
    df: DataFrame, keys: list[str], ts: str, size: str, slide: str, live_from: Column | None = None
) -> DataFrame:
    """Rows per (keys, pane): ``_n`` rows that count in the window ends ``[_start, _stop)``, in epoch µs.

    A pane is one slide long, or as long as size and slide allow where one is no multiple of the other.

    ``live_from`` is the first window end that a row may still count in, for late rows.
    """
    size_us, slide_us = duration_us(size), duration_us(slide)
    first, stop = end_range(micros(ts), size_us, slide_us)
    count = F.count(F.lit(1)).alias("_n")
    if live_from is not None:
        panes = df.groupBy(*keys, F.greatest(first, live_from).alias("_start"), stop.alias("_stop")).agg(count)
        return panes.filter("_start < _stop")
    if size_us % slide_us:  # starts and stops lie on two grids, whose cells are the panes
        return df.groupBy(*keys, first.alias("_start"), stop.alias("_stop")).agg(count)
    return df.groupBy(*keys, first.alias("_start")).agg(count).withColumn("_stop", F.col("_start") + F.lit(size_us))


def end_range(us: Column, size_us: int, slide_us: int) -> tuple[Column, Column]:
    """The window ends that a time counts in, from the first to before the second, in steps of the slide.

    Windows start at whole slides, so their ends lie ``size`` behind these.
    """
    if size_us % slide_us == 0:
        first = floor_to(us, slide_us) + F.lit(slide_us)
        return first, first + F.lit(size_us)
    first = floor_to(us - F.lit(size_us), slide_us) + F.lit(slide_us + size_us)
    return first, floor_to(us, slide_us) + F.lit(slide_us + size_us)


def runs_of_panes(
    panes: DataFrame, keys: list[str], size: str, slide: str, block: str | None = None, count: str = "count",
    merge: bool = True,
) -> DataFrame:
    """The running sum over panes, as described at ``sliding_count_runs``."""
    size_us, slide_us = duration_us(size), duration_us(slide)
    block_us = duration_us(block) if block else -(-24 * size_us // slide_us) * slide_us
    if block_us % slide_us or block_us < size_us:
        raise ValueError("block must be a multiple of slide and not shorter than size")
    grid = size_us % slide_us  # window ends lie so far behind whole slides

    b0 = step_number(F.col("_start") - F.lit(grid), block_us)
    b1 = step_number(F.col("_stop") - F.lit(slide_us + grid), block_us)
    edge = b1 * F.lit(block_us) + F.lit(grid)

    def step(block_no: Column, at: Column, delta: Column) -> Column:
        return F.struct(block_no.alias(BLOCK), at.alias("_end"), delta.alias("_d"))

    up, down = F.col("_n"), -F.col("_n")
    inside = F.array(step(b0, F.col("_start"), up), step(b0, F.col("_stop"), down))
    across = F.array(
        step(b0, F.col("_start"), up),
        step(b0, edge, down),
        step(b1, edge, up),
        step(b1, F.col("_stop"), down),
    )
    steps = panes.select(*keys, F.inline(F.when(b0 == b1, inside).otherwise(across)))

    w = Window.partitionBy(*keys, BLOCK).orderBy("_end")
    runs = steps.select(
        *keys,
        BLOCK,
        "_end",
        F.sum("_d").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias(count),
        F.lead("_end").over(w).alias("_next"),
    )
    # of the steps at one end only the last holds the full sum; the very last closes the block at zero
    runs = runs.filter(F.col("_next").isNull() | (F.col("_next") > F.col("_end")))
    if merge:
        changed = runs.withColumn("_before", F.lag(count).over(w)).filter(
            F.col("_before").isNull() | (F.col("_before") != F.col(count))
        )
        runs = changed.withColumn("_next", F.lead("_end").over(w))
    return runs.filter(F.col(count) > 0).select(
        *keys,
        F.call_function("div", F.col("_end"), F.lit(1000)).alias("first_end"),
        F.call_function("div", F.col("_next") - F.lit(slide_us), F.lit(1000)).alias("last_end"),
        count,
    )


def sliding_count_runs(
    df: DataFrame,
    keys: list[str],
    ts: str,
    size: str,
    slide: str,
    block: str | None = None,
    live_from: Column | None = None,
    count: str = "count",
    merge: bool = True,
) -> DataFrame:
    """Sliding counts as runs: ``count`` holds for every window end in
    ``[first_end, last_end]`` (epoch ms, step ``slide``).

    Runs are cut at block edges (default 24 sizes, so one day for hourly windows)
    and, with ``merge``, are otherwise as long as possible.

    Shuffles: pane counts on (keys, pane), combined on the map side; then at most
    four narrow steps per pane on (keys, block).  A task of the second holds one
    key's panes in one block, whatever the number of rows.
    """
    panes = pane_counts(df, keys, ts, size, slide, live_from)
    return runs_of_panes(panes, keys, size, slide, block, count, merge)


def expand_runs(runs: DataFrame, slide: str) -> DataFrame:
    """One row per window end from runs."""
    step_ms = duration_us(slide) // 1000
    others = [c for c in runs.columns if c not in ("first_end", "last_end")]
    ends = F.sequence(F.col("first_end"), F.col("last_end"), F.lit(step_ms).cast("bigint"))
    return runs.select(*others, F.explode(ends).alias("window_end"))


def sliding_counts(
    df: DataFrame,
    keys: list[str],
    ts: str,
    size: str,
    slide: str,
    block: str | None = None,
    live_from: Column | None = None,
    count: str = "count",
) -> DataFrame:
    """Rows per (keys, window end) for every non-empty sliding window."""
    if df.isStreaming:
        return naive_sliding_counts(df, keys, ts, size, slide, count)
    runs = sliding_count_runs(df, keys, ts, size, slide, block, live_from, count, merge=False)
    return expand_runs(runs, slide).select(*keys, "window_end", count)


def summarize_runs(runs: DataFrame, keys: list[str], slide: str, count: str = "count") -> DataFrame:
    """Windows, total and peak per (keys, UTC day of the window end), without expanding runs.

    A run that crosses days is cut at their edges, so a row per run and day is summed.
    """
    step_ms, day_ms = duration_us(slide) // 1000, 86_400_000
    div = lambda a, b: F.call_function("div", a, F.lit(b))
    day_of = lambda ms: div(ms - F.pmod(ms, F.lit(day_ms)), day_ms)
    days = F.explode(F.sequence(day_of(F.col("first_end")), day_of(F.col("last_end")))).alias("day")
    cut = runs.select(*keys, count, "first_end", "last_end", days)
    # ends are first_end plus whole steps; those of a day lie between its two edges
    start, last = F.col("day") * F.lit(day_ms), F.col("day") * F.lit(day_ms) + F.lit(day_ms - 1)
    before = F.greatest(start - F.col("first_end") + F.lit(step_ms - 1), F.lit(0))
    first_step = div(before, step_ms)
    last_step = div(F.least(last, F.col("last_end")) - F.col("first_end"), step_ms)
    return (
        cut.withColumn("_windows", last_step - first_step + F.lit(1))
        .filter("_windows > 0")
        .groupBy(*keys, "day")
        .agg(
            F.sum("_windows").alias("windows"),
            F.sum(F.col("_windows") * F.col(count)).alias("total"),
            F.max(count).alias("peak"),
        )
    )
