"""Late-row side output for streams.

Spark drops rows behind the watermark without a trace, and what it drops depends on how the
input is cut into batches.  Here each row is judged by the rows that arrived before it: inside
a batch by a running maximum over row-balanced cuts, across batches by one carried maximum.
So the late rows are the same however the input is cut, as long as its order is; and what is
kept is never behind Spark's own watermark, which follows whole batches only.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.functions.times import duration_us, micros, micros_to_ts
from footfall.operators.cuts import CUT, ordered_cuts, running_before
from footfall.operators.late import LATE, window_tags
from footfall.session import move_folder
from footfall.streaming.sinks import Writer, _store, run_available


def _splitter(
    path: str, ts: str, arrival: Sequence[str], mark: Callable[[DataFrame, Column], DataFrame], late: Column
) -> Writer:
    """Stores a batch's rows under ``kept`` or ``late``.

    ``mark`` adds columns to rows, given the largest time (µs) that arrived before each, NULL for the
    first.  A batch reads one row of the batch before it.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, before = batch.sparkSession, None
        if batch_id > 0:
            before = spark.read.parquet(f"{path}/peaks/batch_id={batch_id - 1}").first()[0]
        before = F.lit(before).cast("bigint")
        cuts = ordered_cuts(batch.withColumn("_us", micros(ts)), arrival, "late")
        seen = running_before(cuts, [], arrival, {"_seen": (F.max, F.col("_us"))}, {"_seen": F.greatest})
        marked = mark(seen, F.greatest("_seen", before)).drop("_us", "_seen", CUT)
        is_late = F.coalesce(late, F.lit(False))
        _store(marked.filter(~is_late), f"{path}/kept", batch_id)
        _store(marked.filter(is_late), f"{path}/late", batch_id)
        _store(cuts.agg(F.greatest(F.max("_us"), before).alias("peak")), f"{path}/peaks", batch_id)

    return write


def late_rows_writer(path: str, ts: str, delay: str, arrival: Sequence[str]) -> Writer:
    """Rows at or behind the watermark, ``delay`` before the largest time that arrived earlier, are late."""
    delay_ms = duration_us(delay) // 1000

    def mark(rows: DataFrame, seen: Column) -> DataFrame:
        watermark_ms = F.call_function("div", seen, F.lit(1000)) - F.lit(delay_ms)
        return rows.withColumn("_late", micros(ts) <= watermark_ms * F.lit(1000))

    return _splitter(path, ts, arrival, mark, F.col("_late"))


class Settled:
    """What a stream holds now without its late rows, batch by batch.

    ``rows`` is a stream with a watermark.  It finds a batch's rows once ``release`` has moved
    them to ``main``, all at once: a batch that came in parts could fall behind the watermark
    of its first part.
    """

    def __init__(self, spark: SparkSession, folder: str, rows: DataFrame, batches: Sequence[Sequence[int]]):
        self.spark, self.folder, self.rows, self.batches = spark, folder, rows, [list(b) for b in batches]

    def release(self) -> bool:
        """Moves the next batch; False if there is none."""
        if not self.batches:
            return False
        for batch_id in self.batches.pop(0):
            name = f"batch_id={batch_id}"
            move_folder(self.spark, f"{self.folder}/kept/{name}", f"{self.folder}/main/{name}")
        return True


def settled(
    stream: DataFrame, path: str, ts: str, delay: str, arrival: Sequence[str], close_after: str | None = None
) -> Settled:
    """What ``stream`` holds now without its late rows, to be released batch by batch.

    A row is late if it is ``delay`` or more behind the largest time that arrived before it: in
    an earlier batch, or in its own by the columns ``arrival``.  Late rows are under
    ``path``/late.  With ``close_after`` a row of NULLs follows, that much later than the
    watermark's reach, as a source's end would: it closes all windows and timers of up to that
    length.  Rows without a time are kept.
    """
    run_available(stream, f"{path}/splitting", writer=late_rows_writer(path, ts, delay, arrival))
    return released(stream.sparkSession, path, stream, ts, [delay], close_after)


def released(
    spark: SparkSession, path: str, stream: DataFrame, ts: str, delays: Sequence[str], close_after: str | None = None
) -> Settled:
    """What a splitting writer has kept under ``path``, with a watermark that is the sum of ``delays`` behind."""
    behind_us = sum(duration_us(d) for d in delays)
    peaks = spark.read.parquet(f"{path}/peaks").orderBy("batch_id").collect()  # one row a batch
    batches = [[r.batch_id] for r in peaks]
    schema = spark.read.parquet(f"{path}/kept").drop("batch_id").schema if peaks else stream.schema
    if close_after and peaks and peaks[-1].peak is not None:
        end = micros_to_ts(F.lit(peaks[-1].peak + behind_us + duration_us(close_after)))
        nulls = [end.alias(f.name) if f.name == ts else F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
        last = peaks[-1].batch_id + 1
        _store(spark.range(1).select(*nulls), f"{path}/kept", last)
        batches[-1].append(last)
    rows = spark.readStream.schema(schema).parquet(f"{path}/main/batch_id=*").withWatermark(ts, f"{behind_us} microseconds")
    return Settled(spark, path, rows, batches)


def run_settled(sources: Sequence[Settled], run: Callable[[], None]) -> None:
    """Calls ``run``, which processes what its streams hold, after each release of a batch of all ``sources``."""
    while any([source.release() for source in sources]):
        run()


def late_splitting_writer(
    path: str, ts: str, delay: str, size: str, slide: str, lateness: str, arrival: Sequence[str]
) -> Writer:
    """Stores rows under ``kept`` and those late for all their windows under ``late``, with ``tag`` and
    ``watermark_us`` as ``split_late`` has them."""

    def mark(rows: DataFrame, seen: Column) -> DataFrame:
        marked = rows.withColumn("watermark_us", seen - F.lit(duration_us(delay)))
        return window_tags(marked, ts, size, slide, lateness)

    return _splitter(path, ts, arrival, mark, F.col("tag") == LATE)
