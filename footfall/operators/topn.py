"""Top n per group and first n per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.functions.times import duration_us, step_number
from footfall.operators.windows import expand_runs, pane_counts, runs_of_panes

_LIMIT_CONF = "spark.sql.optimizer.windowGroupLimitThreshold"


def rank_within(
    df: DataFrame, by: list[str], order_by: list[Column], n: int, rank: str = "row_num", salts: int = 256
) -> DataFrame:
    """The first ``n`` rows of each group in ``order_by``, numbered from 1.

    ``order_by`` must be a total order inside the group.  Spark turns the rank
    filter into a group limit before the shuffle, so each task ships at most n
    rows per group, however large the group.  Beyond the size up to which Spark
    does that, rows are first limited per (group, salt), which is exact too: the
    first n of a group are among the first n of its parts.
    """
    threshold = int(df.sparkSession.conf.get(_LIMIT_CONF))
    if n > threshold:
        salt = F.pmod(F.xxhash64(*df.columns), F.lit(salts))
        salted = df.withColumn("_salt", salt)
        part = Window.partitionBy(*by, "_salt").orderBy(*order_by)
        df = salted.withColumn("_part", F.row_number().over(part)).filter(F.col("_part") <= n).drop("_salt", "_part")
    w = Window.partitionBy(*by).orderBy(*order_by)
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= n)


def top_n(counts: DataFrame, id_col: str, n: int, count: str = "count", by: str = "window_end") -> DataFrame:
    """The ``n`` largest counts per window; equal counts by ascending id."""
    return rank_within(counts, [by], [F.col(count).desc(), F.col(id_col).asc()], n)


def top_n_sliding(
    df: DataFrame,
    id_col: str,
    ts: str,
    n: int,
    size: str,
    slide: str,
    chunk: str | None = None,
    live_from: Column | None = None,
    count: str = "count",
    salts: int = 64,
) -> DataFrame:
    """``top_n`` of sliding counts without listing windows of ids that cannot rank.

    Window ends are grouped into chunks (default half of ``size``).  Panes that
    count in every end of a chunk give an id a least count for all of it, so the
    n-th largest of these is a floor below which no id ranks at any of its ends, and
    an id that only reaches the floor ranks behind all smaller ids that hold it.
    Runs that cannot rank are dropped before they are expanded, which in a long
    tail of ids is nearly all of them.  Both uses of the panes share one shuffle.
    """
    slide_us = duration_us(slide)
    chunk_us = duration_us(chunk) if chunk else max(duration_us(size) // 2 // slide_us, 1) * slide_us
    if chunk_us % slide_us:
        raise ValueError("chunk must be a multiple of slide")
    panes = pane_counts(df, [id_col], ts, size, slide, live_from)

    lead = F.lit(chunk_us - 1)
    first_full = step_number(F.col("_start") + lead, chunk_us)
    last_full = step_number(F.col("_stop"), chunk_us) - F.lit(1)
    # no filter here: it would move below the pane counts and part the two uses of them
    chunks = F.when(first_full <= last_full, F.sequence(first_full, last_full))
    full = panes.select(id_col, "_n", F.explode(chunks).alias("_chunk"))
    least = full.groupBy("_chunk", id_col).agg(F.sum("_n").alias("_least"))
    floors = (
        rank_within(least, ["_chunk"], [F.col("_least").desc(), F.col(id_col)], n)
        .filter(F.col("row_num") == n)
        # one floor per chunk, given to each salt so that a busy chunk is spread over tasks
        .select(
            "_chunk",
            F.col("_least").alias("_floor"),
            F.col(id_col).alias("_floor_id"),
            F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt"),
        )
    )

    runs = runs_of_panes(panes, [id_col], size, slide, count=count, merge=False)
    slide_ms, chunk_ms = slide_us // 1000, chunk_us // 1000
    low, high = (F.call_function("div", F.col(end), F.lit(chunk_ms)) for end in ("first_end", "last_end"))
    chunk_start = F.col("_chunk") * F.lit(chunk_ms)
    cut = runs.select("*", F.explode(F.sequence(low, high)).alias("_chunk")).select(
        id_col,
        count,
        "_chunk",
        F.pmod(F.hash(id_col), F.lit(salts)).alias("_salt"),
        F.greatest(F.col("first_end"), chunk_start).alias("first_end"),
        F.least(F.col("last_end"), chunk_start + F.lit(chunk_ms - slide_ms)).alias("last_end"),
    )
    floor = F.col("_floor")
    can_rank = floor.isNull() | (F.col(count) > floor) | ((F.col(count) == floor) & (F.col(id_col) <= F.col("_floor_id")))
    kept = cut.join(floors, ["_chunk", "_salt"], "left").filter(can_rank)
    return top_n(expand_runs(kept.select(id_col, count, "first_end", "last_end"), slide), id_col, n, count)
