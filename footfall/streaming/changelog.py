"""Retracting top n: what a late or growing count changes in a ranking."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.functions.times import duration_us
from footfall.operators.topn import top_n
from footfall.session import drop_folder
from footfall.streaming.sinks import Writer, _store

INSERT, RETRACT = "+", "-"


def ranking_changes(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """``-`` rows of ``old`` and ``+`` rows of ``new`` where the two differ under a key.

    Both frames have the same columns.  Grouped, not joined, so that one shuffle
    serves both sides; a key has at most one row in each.
    """
    values = [c for c in new.columns if c not in keys]
    both = old.withColumn("_op", F.lit(RETRACT)).unionByName(new.withColumn("_op", F.lit(INSERT)))
    row = F.struct(*values)
    pairs = both.groupBy(*keys).agg(
        F.max(F.when(F.col("_op") == RETRACT, row)).alias("_old"),
        F.max(F.when(F.col("_op") == INSERT, row)).alias("_new"),
    )
    changed = pairs.filter(~F.col("_old").eqNullSafe(F.col("_new")))
    ops = F.array(
        F.struct(F.lit(RETRACT).alias("op"), F.col("_old").alias("row")),
        F.struct(F.lit(INSERT).alias("op"), F.col("_new").alias("row")),
    )
    return (
        changed.select(*keys, F.inline(ops)).filter(F.col("row").isNotNull()).select("op", *keys, "row.*")
    )


def retracting_top_n_writer(path: str, id_col: str, n: int, keep: str, count: str = "count") -> Writer:
    """Keeps the counts of open windows and ranking changes below ``path``.

    For counts in update mode: a batch brings the counts that changed.  They are put over the open
    windows' counts, a table that each batch writes anew; the windows they touch are ranked
    before and after, and the difference is stored under ``changes``.  Windows that end ``keep`` or
    more before the last one leave the table, so what a batch reads does not grow with what the stream has
    seen: ``keep`` is the window's size plus the watermark's delay, behind which none can change.
    """
    keep_ms = duration_us(keep) // 1000

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, key = batch.sparkSession, ["window_end", id_col]
        table = lambda k: f"{path}/open/batch_id={k}"
        _store(batch.select(*key, count), f"{path}/batch", batch_id)
        new = spark.read.schema(batch.select(*key, count).schema).parquet(f"{path}/batch/batch_id={batch_id}")
        old = spark.read.schema(new.schema).parquet(table(batch_id - 1)) if batch_id > 0 else new.limit(0)
        both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
        latest = both.groupBy(*key).agg(F.max_by(count, "_new").alias(count))
        last = latest.agg(F.max("window_end")).first()[0]
        kept = latest if last is None else latest.filter(F.col("window_end") > F.lit(last - keep_ms))
        _store(kept, f"{path}/open", batch_id)
        touched = new.select("window_end").distinct()
        now = latest.join(touched, "window_end", "left_semi")
        before = old.join(touched, "window_end", "left_semi")
        _store(ranking_changes(top_n(before, id_col, n, count), top_n(now, id_col, n, count), ["window_end", "row_num"]), f"{path}/changes", batch_id)
        for folder in (table(batch_id - 2), f"{path}/batch/batch_id={batch_id - 2}"):  # a retry needs the one before
            drop_folder(spark, folder)

    return write


def apply_changes(changes: DataFrame, keys: list[str]) -> DataFrame:
    """The ranking that a stored changelog leads to."""
    last = F.max_by(F.struct("op", *[c for c in changes.columns if c not in (*keys, "batch_id", "op")]),
                    F.struct("batch_id", F.col("op") == INSERT))
    return (
        changes.groupBy(*keys).agg(last.alias("_v")).filter(F.col("_v.op") == INSERT).select(*keys, "_v.*").drop("op")
    )
