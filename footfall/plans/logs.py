"""Queries that go through log files: events written as CSV lines to the shared folder and scanned again.

The files have the layouts of ``sources.schemas``; Spark writes and reads them in parts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.plans import marketing, payments
from footfall.plans.catalog import Query, events
from footfall.session import shared_folder
from footfall.sources import files

#: Channel windows are listed one by one, so they come less often than every five seconds.
LISTED_EVERY = "30 minutes"


def _log(rows: DataFrame, label: str) -> str:
    folder = shared_folder(rows.sparkSession, f"log-{label}")
    rows.write.csv(folder)
    return folder


def _item() -> Column:
    return F.get_json_object("props", "$.k").cast("bigint")


def _seconds() -> Column:
    return F.unix_seconds("event_time")


def log_behavior(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).select(
        "user_id", _item(), (_item() % 10).cast("int"), F.when(F.col("event_type") == "view", "pv").otherwise(F.col("event_type")), _seconds()
    )
    log = files.read_user_behavior(spark, _log(rows, "behavior"))
    return log.groupBy("behavior", "category_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("item_id").alias("items"), F.count_distinct("user_id").alias("users"),
        F.max(F.unix_seconds("event_time")).alias("last_ts"),
    )


def log_ad_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks per ad and province after the cap, from the click log."""
    rows = events(spark, sf_dir).filter("event_type = 'click'").select(
        "user_id", _item() % 7, F.concat(F.lit("province "), (F.col("user_id") % 5).cast("string")), F.lit("a city, quoted"), _seconds()
    )
    clicks = files.read_ad_clicks(spark, _log(rows, "ad-clicks"))
    return clicks.groupBy("province", "city", "ad_id").agg(F.count(F.lit(1)).alias("n"), F.max("ts").alias("last_ts"))


def log_logins(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("event_type") == "error", "fail").otherwise("success")
    rows = events(spark, sf_dir).select("user_id", F.concat(F.lit("10.0.0."), (F.col("user_id") % 256).cast("string")), kind, _seconds())
    logins = files.read_logins(spark, _log(rows, "logins"))
    return logins.groupBy("user_id", "ip").agg(
        F.count_if(F.col("event_type") == "fail").alias("fails"), F.count(F.lit(1)).alias("n"),
        F.min(F.unix_seconds("event_time")).alias("first_ts"),
    )


def log_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments against receipts, from an order log whose creates have no transaction, and a receipt log.

    Two of three purchases have a receipt, up to five seconds earlier or seven later; some receipts
    have no purchase.
    """
    df, number = events(spark, sf_dir), F.col("event_id").cast("string")
    pay, create = F.col("event_type") == "purchase", F.col("event_type") == "signup"
    orders = df.filter(pay | create).select(
        "user_id", F.when(pay, "pay").otherwise("create"), F.when(pay, F.concat(F.lit("tx"), number)).otherwise(""), _seconds()
    )
    receipted = (pay & (F.col("event_id") % 3 > 0)) | ((F.col("event_type") == "click") & (F.col("event_id") % 10 == 0))
    receipts = df.filter(receipted).select(
        F.concat(F.lit("tx"), number), F.when(F.col("event_id") % 2 == 0, "wechat").otherwise("alipay"),
        _seconds() + F.col("event_id") % 13 - 5,
    )
    order_log, receipt_log = files.read_orders(spark, _log(orders, "orders")), files.read_receipts(spark, _log(receipts, "receipts"))
    matched = payments.reconciled_receipts(order_log, receipt_log)
    return matched.select(F.coalesce("pay.tx_id", "receipt.tx_id").alias("tx_id"), "receipt.pay_channel", "tag")


def channel_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per channel, behaviour and window with its bounds as text, from a marketing log; errors are ``unstall`` rows."""
    behavior = F.when(F.col("event_type") == "error", "unstall").otherwise(F.col("event_type"))
    channel = F.element_at(F.array(*map(F.lit, ("app-store", "huawei-store", "wechat"))), (_item() % 3 + 1).cast("int"))
    rows = events(spark, sf_dir).select(F.col("user_id").cast("string"), channel, behavior, F.unix_millis("event_time"))
    log = files.read_marketing(spark, _log(rows, "marketing"))
    return marketing.channel_counts(log, slide=LISTED_EVERY)


LOG_QUERIES: dict[str, Query] = {
    "log_behavior": log_behavior,
    "log_ad_clicks": log_ad_clicks,
    "log_logins": log_logins,
    "log_payments": log_payments,
    "channel_windows": channel_windows,
}
