"""Order payment in time, and payments against receipts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.operators import interval_join, match_sequence, order_status, reconcile


def payment_sequence(orders: DataFrame, tie: str, within: str = "15 minutes") -> DataFrame:
    """Each create with the pay that follows it in time, or ``timeout``."""
    steps = [("create", F.col("event_type") == "create"), ("pay", F.col("event_type") == "pay")]
    matches = match_sequence(
        orders, ["order_id"], "event_time", tie, steps, within, contiguity="relaxed", emit_timeouts=True,
        columns=["event_time"],
    )
    status = F.when(F.col("status") == "match", "payed").otherwise("timeout")
    return matches.select("order_id", status.alias("status"))


def payment_status(orders: DataFrame, within: str = "15 minutes", tie: str = "event_type") -> DataFrame:
    kind = F.col("event_type")
    return order_status(orders, "order_id", "event_time", tie, kind == "create", kind == "pay", within)


def payments(orders: DataFrame) -> DataFrame:
    """Order events that carry a transaction."""
    return orders.filter(F.coalesce("tx_id", F.lit("")) != "")


def matched_receipts(orders: DataFrame, receipts: DataFrame) -> DataFrame:
    return interval_join(payments(orders), receipts, ("tx_id", "tx_id"), ("event_time", "event_time"))


def reconciled_receipts(orders: DataFrame, receipts: DataFrame) -> DataFrame:
    return reconcile(payments(orders), receipts, ("tx_id", "tx_id"), ("event_time", "event_time"))
