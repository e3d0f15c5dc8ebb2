"""Sliding counts on streams from tumbling pane counts.

Spark's sliding ``window`` copies a row, or a pane, into each of its windows and keeps a
state row for each.  Here the stateful query counts panes only, as long as size and slide have
in common; the windows that end with newly closed panes are swept from the panes of one window
size, as in batch.
"""

from __future__ import annotations

from collections.abc import Callable
from math import gcd

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.functions.times import duration_us
from footfall.operators.windows import end_range, runs_of_panes
from footfall.streaming.sinks import Writer

DAY_MS = 86_400_000


def pane_length(size: str, slide: str) -> str:
    """The longest panes that windows are made of."""
    return f"{gcd(duration_us(size), duration_us(slide))} microseconds"


def _windows(
    spark: SparkSession, path: str, keys: list[str], size: str, slide: str, after: int | None, upto: int, batch_id: int
) -> DataFrame:
    """Runs of the window ends in ``(after, upto]`` from the stored panes that count in them."""
    size_ms, slide_ms, pane_ms = duration_us(size) // 1000, duration_us(slide) // 1000, duration_us(pane_length(size, slide)) // 1000
    panes = spark.read.parquet(f"{path}/panes").filter(F.col("batch_id") <= batch_id)
    start, stop = end_range(F.col("window_end") - F.lit(pane_ms), size_ms, slide_ms)
    # the first window end behind a time
    behind = lambda ms: ((ms - size_ms) // slide_ms + 1) * slide_ms + size_ms
    if after is not None:
        # panes lie in folders by day, so older ones are not read
        oldest = after - size_ms
        panes = panes.filter((F.col("day") >= oldest // DAY_MS) & (F.col("window_end") > oldest))
        start = F.greatest(start, F.lit(behind(after)))
    stop = F.least(stop, F.lit(behind(upto)))
    cut = panes.select(*keys, F.col("count").alias("_n"), (start * 1000).alias("_start"), (stop * 1000).alias("_stop"))
    return runs_of_panes(cut.filter("_start < _stop"), keys, size, slide, merge=False)


def sliding_writer(
    path: str, keys: list[str], size: str, slide: str, then: Callable[[DataFrame], DataFrame] | None = None
) -> Writer:
    """For ``tumbling_counts`` of one ``pane_length`` in append mode: stores the sliding windows that a batch closes.

    Panes leave the aggregation in the order of the watermark, so all windows up to the
    last pane's end are final.  They go to ``path``/out as runs, or as what ``then`` makes
    of these.  A batch reads panes of one window size, and one row of the batch before.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, after = batch.sparkSession, None
        day = F.call_function("div", F.col("window_end"), F.lit(DAY_MS)).alias("day")
        panes = batch.select(*keys, "window_end", "count", day)
        panes.write.mode("overwrite").partitionBy("day").parquet(f"{path}/panes/batch_id={batch_id}")
        if batch_id > 0:
            after = spark.read.parquet(f"{path}/upto/batch_id={batch_id - 1}").first()[0]
        last = spark.read.schema("window_end bigint").parquet(f"{path}/panes/batch_id={batch_id}").agg(F.max("window_end")).first()[0]
        upto = after if last is None else last if after is None else max(last, after)
        spark.range(1).select(F.lit(upto).cast("bigint").alias("upto")).write.mode("overwrite").parquet(
            f"{path}/upto/batch_id={batch_id}"
        )
        if last is not None and upto != after:
            _emit(spark, path, keys, size, slide, after, upto, batch_id, then)

    return write


def _emit(spark, path, keys, size, slide, after, upto, batch_id, then) -> None:
    runs = _windows(spark, path, keys, size, slide, after, upto, batch_id)
    (then(runs) if then else runs).write.mode("overwrite").parquet(f"{path}/out/batch_id={batch_id}")


def close_windows(
    spark: SparkSession, path: str, keys: list[str], size: str, slide: str,
    then: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Ends a stream that has stopped: stores the windows behind its last pane, and returns all windows."""
    last = spark.read.parquet(f"{path}/upto").agg(F.max_by("upto", "batch_id"), F.max("batch_id")).first()
    if last[0] is not None:
        upto = last[0] + (duration_us(size) - duration_us(pane_length(size, slide))) // 1000
        _emit(spark, path, keys, size, slide, last[0], upto, last[1] + 1, then)
    return spark.read.parquet(f"{path}/out").drop("batch_id")
