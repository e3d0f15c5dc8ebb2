"""Timer bursts: failures counted while a timer runs that the first of them has set.

A burst ends ``wait`` after its first failure, unless a success comes before and ends it
without a result.  The next failure after a burst's end starts the next one, so which failures start
bursts depends on all before them.  Here every failure is taken as a start, in turn:

* its *end* is a row of its own, put into the order of events at the time at which its wait is over.  The
  events around that place tell how many failures the burst holds, whether a success cut it
  short, and which failure comes next;
* failures behind a success, and a key's first ones, do start bursts; from them *pointers* to
  the next start are followed, twice as far in each round, until no further start is found.

All orders are over row-balanced cuts, so a key of very many failures is no hot task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.functions.times import duration_us, micros, micros_to_ts
from footfall.operators.blocks import batch_only
from footfall.operators.cuts import ordered_cuts, running_after, running_before, running_sum
from footfall.session import shared_folder

#: Fixed value: the text of the warning of bursts of two seconds.
BURST_TEXT = "login fail in 2s for %d times."


def _bursts(df: DataFrame, key: Sequence[str], ts: str, tie: str, is_fail: Column, wait_us: int, parts: int | None) -> DataFrame:
    """Each failure as if it started a burst: ``_n`` (its number among the key's events), ``_root`` (it does start
    one), ``_last_us`` and ``_size`` of the burst, ``_cut_short``, and ``_next``, the number of the next start if no
    success comes before it."""
    rows = df.select(
        *key, micros(ts).alias("_us"), F.col(tie).alias("_tie"), F.coalesce(is_fail, F.lit(False)).alias("_fail")
    )
    for c in (*key, "_us"):
        rows = rows.filter(F.col(c).isNotNull())
    order = ["_us", "_tie"]
    event = F.struct("_us", "_tie", "_fail")
    numbered = running_before(
        ordered_cuts(rows, [*key, *order], "bursts", parts), key, order,
        {"_n": (F.sum, F.lit(1)), "_ok": (F.sum, F.when(F.col("_fail"), 0).otherwise(1)), "_before": (F.max, event)},
        {"_n": running_sum, "_ok": running_sum, "_before": lambda carried, local: F.coalesce(local, carried)},
    )
    root = ~F.coalesce(F.col("_before._fail"), F.lit(False))
    events = numbered.select(*key, "_us", "_tie", "_fail", "_n", "_ok", root.alias("_root"))
    none = F.lit(None)
    # an end comes behind the events of its own time
    own = F.struct("_us", "_n", "_ok", "_root")
    ends = events.filter("_fail").select(*key, (F.col("_us") + F.lit(wait_us)).alias("_us"), "_tie", F.lit(1).alias("_end"), own.alias("_own"))
    both = events.select(
        *key, "_us", "_tie", F.lit(0).alias("_end"), "_n", F.when(F.col("_fail"), 0).otherwise(1).alias("_success"), "_fail"
    ).unionByName(ends.select(*key, "_us", "_tie", "_end", "_own"), allowMissingColumns=True)
    place = ["_us", "_end", "_tie"]
    is_event = F.col("_end") == 0
    cuts = ordered_cuts(both, [*key, *place], "burst-ends", parts)
    last = lambda carried, local: F.coalesce(local, carried)
    around = running_before(
        cuts, key, place,
        {"_count": (F.sum, F.when(is_event, 1).otherwise(0)), "_oks": (F.sum, F.coalesce("_success", F.lit(0))),
         "_last_us": (F.max, F.when(is_event, F.col("_us")))},
        {"_count": running_sum, "_oks": running_sum, "_last_us": F.greatest},
    )
    following = F.when(is_event, F.struct("_us", "_tie", "_n", "_fail"))
    around = running_after(around, key, place, {"_then": (F.min, following)}, {"_then": last})
    short = F.col("_oks") > F.col("_own._ok")
    return around.filter("_end = 1").select(
        *key, F.col("_own._us").alias("_us"), F.col("_own._n").alias("_n"), F.col("_own._root").alias("_root"), "_last_us",
        (F.col("_count") - F.col("_own._n")).alias("_size"), short.alias("_short"),
        F.when(~short & F.col("_then._fail"), F.col("_then._n")).otherwise(none).alias("_next"),
    )


def failure_bursts(
    df: DataFrame, key: Sequence[str], ts: str, tie: str, is_fail: Column, wait: str = "2 seconds",
    label: str = BURST_TEXT, parts: int | None = None,
) -> DataFrame:
    """A warning for each burst of two failures or more whose wait ends before any success.

    ``msg`` has the number of failures.  A failure at the very end of the wait still counts, and a
    success there still cancels.  Rows without key or time take no part.
    """
    batch_only(df, "streaming.processors.FailureBursts")
    spark, folder = df.sparkSession, shared_folder(df.sparkSession, "burst-starts")

    def written(rows: DataFrame, name: str) -> DataFrame:
        rows.write.parquet(f"{folder}/{name}")
        return spark.read.schema(rows.schema).parquet(f"{folder}/{name}")

    bursts = written(_bursts(df, key, ts, tie, is_fail, duration_us(wait), parts), "all")
    state = written(bursts.select(*key, "_n", F.col("_next").alias("_to"), F.col("_root").alias("_start")), "0")
    turn = 0
    # a start's pointer leads to a start; once no start points on, all are found
    while not state.filter("_to IS NOT NULL AND _start").isEmpty():
        turn += 1
        reached = state.filter("_start AND _to IS NOT NULL").select(*key, F.col("_to").alias("_n")).distinct()
        further = state.select(*key, F.col("_n").alias("_to"), F.col("_to").alias("_on"))
        grown = state.join(reached.withColumn("_met", F.lit(True)), [*key, "_n"], "left").join(further, [*key, "_to"], "left")
        state = written(
            grown.select(*key, "_n", F.col("_on").alias("_to"), (F.col("_start") | F.col("_met").isNotNull()).alias("_start")), str(turn)
        )
    starts = state.filter("_start").select(*key, "_n")
    warned = bursts.filter("NOT _short AND _size >= 2").join(starts, [*key, "_n"])
    return warned.select(
        *key, micros_to_ts("_us").alias("first_fail_time"), micros_to_ts("_last_us").alias("last_fail_time"),
        F.format_string(label, F.col("_size")).alias("msg"),
    )
