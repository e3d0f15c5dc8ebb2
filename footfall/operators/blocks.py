"""Time blocks: the unit that splits a hot key over many tasks.

Operators that need the rows of a key in order partition by (key, block), never
by the key alone, so a key that holds a large share of all rows is spread over
as many tasks as there are blocks in its time span.  What has to cross a block
edge is a *carry*: one summary row per (key, block) is scanned per key and joined
back (see ``streaks``).  Orders over a whole table, and patterns, use ``cuts``.

A carry costs a summary row per (key, block), so there only keys with many rows
are split (``split_hot_keys``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.functions.times import step_number

BLOCK = "_block"


def batch_only(df: DataFrame, stream_form: str) -> None:
    """Row windows do not exist on streams; names what does the same there."""
    if df.isStreaming:
        raise ValueError(f"a stream needs {stream_form}")


def with_block(df: DataFrame, us: Column, block_us: int) -> DataFrame:
    return df.withColumn(BLOCK, step_number(us, block_us))


#: A hot key is cut into this many blocks at most.
MOST_BLOCKS = 1000


def split_hot_keys(
    rows: DataFrame, key: Sequence[str], us: str, hot_rows: int, max_hot_keys: int = 200_000
) -> DataFrame | None:
    """Adds ``_block`` so that a key with more than ``hot_rows`` rows is cut into time
    blocks of about that many; all other keys have one block.  None if no key is hot.

    Cuts are quantiles of the key's own times, so neither an outlier nor a burst makes
    a block large; only rows of one and the same time stay together.  Runs one job that
    counts rows per key, combined on the map side; if there are hot keys, another pass
    over their rows sketches the quantiles.  At most ``rows / hot_rows`` keys can be hot;
    the keys are broadcast if there are no more than ``max_hot_keys`` of them, and
    joined as Spark decides otherwise, where so many hot keys leave none that dominates.
    """
    stats = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > hot_rows)
    pieces = F.least(F.ceil(F.col("_n") / F.lit(hot_rows)), F.lit(MOST_BLOCKS)).cast("int")
    hot_keys = stats.select(*key, pieces.alias("_pieces"))
    hot = hot_keys.limit(max_hot_keys + 1).count()
    if hot == 0:
        return None
    hot_keys = F.broadcast(hot_keys) if hot <= max_hot_keys else hot_keys
    shares = F.array(*[F.lit(i / MOST_BLOCKS) for i in range(1, MOST_BLOCKS)])
    times = rows.select(*key, us).join(hot_keys, list(key)).groupBy(*key).agg(
        F.max("_pieces").alias("_pieces"), F.percentile_approx(us, shares, 10 * MOST_BLOCKS).alias("_times")
    )
    at = lambda i: F.element_at("_times", F.floor(i * MOST_BLOCKS / F.col("_pieces")).cast("int"))
    cuts = times.select(*key, F.transform(F.sequence(F.lit(1), F.col("_pieces") - 1), at).alias("_cuts"))
    block = F.coalesce(F.size(F.filter("_cuts", lambda c: c < F.col(us))), F.lit(0)).cast("bigint")
    return rows.join(cuts, list(key), "left").withColumn(BLOCK, block).drop("_cuts")
