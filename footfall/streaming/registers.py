"""State that grows with a window: bitmaps of visitors, and counts by page in a map.

Both split a window over many keys, (window, bucket) or (window, part), so that a busy window is no
hot task, and free what they hold when a window can no longer change.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from footfall.functions.hashing import poly_offset
from footfall.functions.times import duration_us, event_time, micros
from footfall.operators.topn import top_n
from footfall.streaming.processors import use_rocksdb

#: Bits of a bucket, as in the bitmap aggregates.
BUCKET_BITS = 32_768


class VisitorBits(StatefulProcessor):
    """Sets the bits of new visitors, and tells how many there were.

    Key: window end and bucket.  Held: the bucket's bitmap, until the watermark reaches the window's end.
    """

    output = "window_end bigint, bucket bigint, added bigint"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.bits = handle.getValueState("bits", "bits binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held = np.zeros(BUCKET_BITS, dtype=bool)
        known = self.bits.exists()
        if known:
            held = np.unpackbits(np.frombuffer(self.bits.get()[0], dtype=np.uint8)).astype(bool)
        before = int(held.sum())
        for frame in rows:
            held[frame["bit"].to_numpy()] = True
        added = int(held.sum()) - before
        if not known:
            self.handle.registerTimer(int(key[0]))
        if added:
            self.bits.update((np.packbits(held).tobytes(),))
            yield pd.DataFrame([(key[0], key[1], added)], columns=["window_end", "bucket", "added"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.bits.clear()
        return iter(())

    def close(self) -> None:
        pass


def visitor_bits(stream: DataFrame, user: str, ts: str, size: str) -> DataFrame:
    """How many visitors each (window end, bucket) has gained: ``added`` adds up to distinct hashed users.

    ``stream`` has a watermark on ``ts``.  Rows without user or time count nobody.
    """
    use_rocksdb(stream.sparkSession)
    offset = poly_offset(F.col(user))
    placed = stream.filter(F.col(user).isNotNull() | F.col(ts).isNotNull()).select(
        F.coalesce(F.unix_millis(F.window(event_time(stream, ts), size).end), F.lit(0)).alias("window_end"),
        F.coalesce(F.bitmap_bucket_number(offset), F.lit(-1)).alias("bucket"),
        F.coalesce(F.bitmap_bit_position(offset), F.lit(0)).alias("bit"), ts,
    )
    grown = placed.groupBy("window_end", "bucket").transformWithStateInPandas(
        statefulProcessor=VisitorBits(), outputStructType=VisitorBits.output, outputMode="append", timeMode="eventTime"
    )
    return grown.filter("bucket >= 0 AND window_end > 0")


class PageCounts(StatefulProcessor):
    """Counts by page of a part of a window's pages, ranked when the window ends and again after each late row.

    Key: window end and part.  Held: a map from page to count.  The first timer gives the part's
    ranking, the second frees the map.  Timers are ``shift_ms`` early, as the watermark is that
    much behind to let late rows through.
    """

    output = "window_end bigint, part int, url bigint, count bigint"

    def __init__(self, n: int, shift_ms: int, lateness_ms: int):
        self.n, self.shift_ms, self.lateness_ms = n, shift_ms, lateness_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.counts = handle.getMapState("counts", "url bigint", "count bigint")

    def _fires(self, key) -> int:
        return int(key[0]) - self.shift_ms

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()
        for frame in rows:
            seen.update(frame["url"].to_numpy().tolist())
        for url, count in seen.items():
            before = self.counts.getValue((url,)) if self.counts.containsKey((url,)) else (0,)
            self.counts.updateValue((url,), (before[0] + count,))
        # a time that has passed already fires at the end of this batch: the window is ranked again
        self.handle.registerTimer(self._fires(key))
        self.handle.registerTimer(self._fires(key) + self.lateness_ms)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if expiredTimerInfo.getExpiryTimeInMs() != self._fires(key):
            self.counts.clear()
            return
        ranked = heapq.nsmallest(self.n, ((-v[0], k[0]) for k, v in self.counts.iterator()))
        if ranked:
            rows = [(key[0], key[1], url, -count) for count, url in ranked]
            yield pd.DataFrame(rows, columns=["window_end", "part", "url", "count"])

    def close(self) -> None:
        pass


def page_rankings(
    stream: DataFrame, ts: str, n: int, size: str, slide: str, lateness: str, parts: int = 8, live_from: str = "live_from_us"
) -> DataFrame:
    """Rankings of parts of the pages (``url``) of each window, anew after each late row that still counts.

    A row counts in the window ends from ``live_from`` on, as ``window_tags`` gives it.  The
    watermark of ``stream`` must be ``size`` and ``lateness`` behind that of the rows.
    """
    use_rocksdb(stream.sparkSession)
    size_us, slide_us = duration_us(size), duration_us(slide)
    first = F.greatest(micros(ts) - F.pmod(micros(ts), F.lit(slide_us)) + F.lit(slide_us), F.col(live_from))
    last = micros(ts) - F.pmod(micros(ts), F.lit(slide_us)) + F.lit(size_us)
    ends = F.when(first <= last, F.sequence(first, last, F.lit(slide_us).cast("bigint")))
    listed = stream.select(F.explode(ends).alias("_end"), "url", ts).select(
        F.call_function("div", F.col("_end"), F.lit(1000)).alias("window_end"),
        # a NULL would turn a batch's integers to floats on the way to Python: no page has a part of its own
        F.when(F.col("url").isNull(), -1).otherwise(F.pmod(F.hash("url"), F.lit(parts))).alias("part"),
        F.coalesce("url", F.lit(0)).cast("bigint").alias("url"), ts,
    )
    processor = PageCounts(n, (size_us + duration_us(lateness)) // 1000, duration_us(lateness) // 1000)
    ranked = listed.groupBy("window_end", "part").transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=PageCounts.output, outputMode="append", timeMode="eventTime"
    )
    return ranked.withColumn("url", F.when(F.col("part") >= 0, F.col("url")))


def merged_rankings(spark: SparkSession, path: str, n: int) -> DataFrame:
    """The ranking of each window from the last ones of its parts, stored batch by batch under ``path``."""
    stored = spark.read.parquet(path)
    last = stored.groupBy("window_end", "part").agg(F.max("batch_id").alias("batch_id"))
    return top_n(stored.join(last, ["window_end", "part", "batch_id"]).select("window_end", "url", "count"), "url", n)
