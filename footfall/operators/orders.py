"""Order payment status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.functions.times import duration_us, micros
from footfall.operators.blocks import BLOCK, batch_only, split_hot_keys

#: The names of the outcomes.
PAID, PAID_LATE, TIMEOUT, NOT_CREATED = "payed", "payed but already timeout", "timeout", "payed but not created"


def order_status(
    df: DataFrame, order: str, ts: str, tie: str, is_create: Column, is_pay: Column, within: str = "15 minutes",
    hot_rows: int = 5_000_000, late_within: str | None = None,
) -> DataFrame:
    """The outcomes of each order, from all its creates and pays in order of (``ts``, ``tie``), creates first
    among rows of one time.

    A create waits for the next pay, which gives ``payed`` up to and including the limit
    and ``payed but already timeout`` beyond it; either ends the wait.  A further create
    takes the place of one that still waits; after the limit, or at the end, a create
    without pay gives ``timeout``.  A pay that no create waits for gives ``payed but not
    created``, as it waits only up to its own time.  With ``late_within`` a create is held so
    much longer than the limit; a pay beyond that finds it timed out.

    So an outcome depends on neighbouring rows alone.  Rows are narrow; orders with more
    than ``hot_rows`` rows are cut into time blocks whose first and last rows are passed on.
    Rows without order or time have no outcome.
    """
    batch_only(df, "streaming.processors.OrderStatus")
    rows = df.filter(is_create | is_pay).select(
        order, micros(ts).alias("_us"), F.col(tie).alias("_tie"), F.coalesce(is_create, F.lit(False)).alias("_create")
    )
    for c in (order, "_us"):
        rows = rows.filter(F.col(c).isNotNull())
    blocked = split_hot_keys(rows, [order], "_us", hot_rows)
    parts = [order] if blocked is None else [order, BLOCK]
    inside = Window.partitionBy(*parts).orderBy("_us", F.col("_create").desc(), "_tie")
    event = F.struct("_create", "_us")
    near = (rows if blocked is None else blocked).select(
        "*", F.lag(event).over(inside).alias("_before"), F.lead(event).over(inside).alias("_after")
    )
    if blocked is not None:
        place, per_order = F.struct(F.col("_us"), ~F.col("_create"), F.col("_tie")), Window.partitionBy(order).orderBy(BLOCK)
        edges = near.groupBy(*parts).agg(F.min_by(event, place).alias("_head"), F.max_by(event, place).alias("_tail"))
        edges = edges.select(
            *parts, F.lag("_tail").over(per_order).alias("_last"), F.lead("_head").over(per_order).alias("_next")
        )
        near = near.join(edges, parts).select(
            order, "_us", "_create",
            F.coalesce("_before", "_last").alias("_before"), F.coalesce("_after", "_next").alias("_after"),
        )
    limit = F.col("_us") + F.lit(duration_us(within))
    held_us = None if late_within is None else duration_us(within) + duration_us(late_within)
    after, before = F.col("_after"), F.col("_before")
    gone = F.lit(False) if held_us is None else after["_us"] > F.col("_us") + F.lit(held_us)
    forgotten = F.lit(False) if held_us is None else F.col("_us") > before["_us"] + F.lit(held_us)
    created = (
        F.when(after.isNull(), TIMEOUT)
        .when(after["_create"], F.when(after["_us"] > limit, TIMEOUT))
        .otherwise(F.when(after["_us"] <= limit, PAID).when(gone, TIMEOUT).otherwise(PAID_LATE))
    )
    unmatched = ~F.coalesce(before["_create"] & ~forgotten, F.lit(False))
    status = F.when(F.col("_create"), created).otherwise(F.when(unmatched, NOT_CREATED))
    return near.select(order, status.alias("status")).filter(F.col("status").isNotNull())
