"""The analyses over the driver's tables.

``events`` stands in for the behaviour logs: a ``view`` is a page view of item
``props.k``, an ``error`` a failed action, a ``signup`` an order and a
``purchase`` its payment.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.functions import ITEM_REPORT, micros, ranking_report
from footfall.operators import (
    anchored_alerts,
    blacklist,
    chained_alerts,
    click_cap,
    error_bound,
    failure_bursts,
    first_come_match,
    interval_join,
    match_sequence,
    order_status,
    passed,
    reconcile,
    sketch_rollup,
    sliding_count_runs,
    sliding_counts,
    sliding_sketches,
    sliding_uniques,
    split_late,
    summarize_runs,
)
from footfall.plans import hot_items as items
from footfall.plans import marketing, traffic
from footfall.session import pin_zone
from footfall.sources.files import parse_access_log
from footfall.sources.kafka import decode_csv, to_kafka_value
from footfall.sources.schemas import USER_BEHAVIOR

Query = Callable[[SparkSession, str], DataFrame]

CAP = 2
CAP_KEY = ["user_id", "event_type"]
STREAK_WITHIN = "12 hours"
ORDER_WITHIN = "12 hours"
# a jitter of up to an hour, fixed per event, makes an arrival order with late rows
JITTER = "event_id * 7919 % 3600 * 1000000"
LATE = dict(delay="1 minute", size="10 minutes", slide="5 seconds", lateness="5 minutes")
RELISTED = dict(delay="10 minutes", size="20 minutes", slide="10 minutes", lateness="15 minutes")
# a size that is no multiple of the slide
UNEVEN = ("10 minutes", "4 minutes")
SKETCH_BITS = 12


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    pin_zone(spark)
    df = spark.read.parquet(f"{sf_dir}/events.parquet")
    return df.withColumn("event_time", F.col("ts").cast("timestamp"))


def behavior(spark: SparkSession, sf_dir: str) -> DataFrame:
    item = F.get_json_object("props", "$.k").cast("bigint")
    return events(spark, sf_dir).select(
        "event_id", "user_id", item.alias("item_id"), F.col("event_type").alias("behavior"), "event_time"
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return behavior(spark, sf_dir).select(
        "event_id", F.col("item_id").alias("url"), F.col("behavior").alias("method"), "event_time"
    )


def _ranked_items(spark, sf_dir):
    return items.hot_items(behavior(spark, sf_dir), kind="view")


def hot_items(spark, sf_dir):
    return _ranked_items(spark, sf_dir).select("window_end", "item_id", "count", "row_num")


def hot_items_sql(spark, sf_dir):
    behavior(spark, sf_dir).createOrReplaceTempView("footfall_behavior")
    return items.hot_items_sql(spark, "footfall_behavior", kind="view")


def hot_items_report(spark, sf_dir):
    return ranking_report(_ranked_items(spark, sf_dir), "item_id", "count", ITEM_REPORT)


def hot_pages(spark, sf_dir):
    ranked = traffic.hot_pages(requests(spark, sf_dir), method="view")
    return ranked.select("window_end", "url", "count", "row_num")


def hot_pages_daily(spark, sf_dir):
    """Over a day by the hour: dense counts, most pages in every window."""
    ranked = traffic.hot_pages(requests(spark, sf_dir), method="view", size="1 day", slide="1 hour")
    return ranked.select("window_end", "url", "count", "row_num")


def _late_events(df: DataFrame, late: dict[str, str] = LATE) -> DataFrame:
    arrival = micros("event_time") + F.expr(JITTER)
    return split_late(df, "event_time", arrival, "event_id", **late)


def late_split(spark, sf_dir):
    tagged = _late_events(events(spark, sf_dir).select("event_id", "event_time"))
    return tagged.select("event_id", "tag", "watermark_us")


def _hot_pages_late(spark, sf_dir, late):
    log = requests(spark, sf_dir).filter(F.col("method") == "view")
    live = _late_events(log, late).filter(F.col("tag") != "late")
    ranked = traffic.hot_pages(
        live, size=late["size"], slide=late["slide"], live_from=F.col("live_from_us"), method="view"
    )
    return ranked.select("window_end", "url", "count", "row_num")


def hot_pages_late(spark, sf_dir):
    return _hot_pages_late(spark, sf_dir, LATE)


def hot_pages_relisted(spark, sf_dir):
    """Windows of 20 minutes every ten, with rows that come up to a quarter of an hour after a window has ended."""
    return _hot_pages_late(spark, sf_dir, RELISTED)


def views_uneven(spark, sf_dir):
    """Views of ten minutes every four minutes, which is no whole part of ten."""
    views = behavior(spark, sf_dir).filter(F.col("behavior") == "view")
    return sliding_counts(views, [], "event_time", *UNEVEN).select("window_end", "count")


def unique_visitors_sliding_sketch(spark, sf_dir):
    """Visitors of a day, every hour: exactly, and whether the sketches' estimate keeps to its error bound."""
    views = behavior(spark, sf_dir).filter(F.col("behavior") == "view")
    panes = sketch_rollup(views, "user_id", "event_time", "1 hour", SKETCH_BITS)
    sketched = sliding_sketches(panes, "1 day", "1 hour").select("window_end", F.hll_sketch_estimate("sketch").alias("_estimate"))
    exact = sliding_uniques(views, "user_id", "event_time", "1 day", "1 hour")
    close = F.abs(F.col("_estimate") - F.col("count")) <= F.col("count") * error_bound(SKETCH_BITS)
    return exact.join(sketched, "window_end", "left").select("window_end", "count", F.coalesce(close, F.lit(False)).alias("within_bound"))


def page_views(spark, sf_dir):
    return traffic.page_views(behavior(spark, sf_dir), kind="view")


def page_views_salted(spark, sf_dir):
    return traffic.page_views_salted(behavior(spark, sf_dir), ["event_id"], kind="view")


def unique_visitors(spark, sf_dir):
    return traffic.unique_visitors(behavior(spark, sf_dir), "exact", kind="view")


def unique_visitors_bitmap(spark, sf_dir):
    return traffic.unique_visitors(behavior(spark, sf_dir), "bitmap", kind="view")


def unique_visitors_sketch(spark, sf_dir):
    return traffic.unique_visitors(behavior(spark, sf_dir), "sketch", kind="view")


def _channels(spark, sf_dir):
    df = behavior(spark, sf_dir)
    return df.select((F.col("item_id") % 3).alias("channel"), "behavior", "event_time")


def channel_counts(spark, sf_dir):
    return marketing.channel_count_runs(_channels(spark, sf_dir))


def channel_counts_daily(spark, sf_dir):
    runs = marketing.channel_count_runs(_channels(spark, sf_dir))
    return summarize_runs(runs, ["channel", "behavior"], "5 seconds")


def _capped(spark, sf_dir):
    narrow = events(spark, sf_dir).select("event_id", "user_id", "event_type", "event_time")
    return click_cap(narrow, CAP_KEY, "event_time", "event_id", CAP)


def click_cap_pass(spark, sf_dir):
    return passed(_capped(spark, sf_dir)).select("event_id", "user_id", "event_type")


def click_blacklist(spark, sf_dir):
    return blacklist(_capped(spark, sf_dir), CAP_KEY, CAP)


def capped_by_province(spark, sf_dir):
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", "c_nationkey")
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet").select("n_nationkey", F.col("n_name").alias("province"))
    # the cap comes first: it bounds the rows of a hot user before the join on users
    kept = passed(_capped(spark, sf_dir)).select("user_id", "event_time")
    located = (
        kept.join(customer, F.col("user_id") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("province", "event_time")
    )
    return sliding_count_runs(located, ["province"], "event_time", "1 hour", "5 seconds")


def _alerts(rows: DataFrame) -> DataFrame:
    return rows.select(
        "user_id", micros("first_fail_time").alias("first_us"), micros("last_fail_time").alias("last_us"), "msg"
    )


def fail_anchor(spark, sf_dir):
    failed = F.col("event_type") == "error"
    return _alerts(
        anchored_alerts(events(spark, sf_dir), ["user_id"], "event_time", "event_id", failed, STREAK_WITHIN)
    )


def fail_last_matched(spark, sf_dir):
    failed = F.col("event_type") == "error"
    return _alerts(
        chained_alerts(events(spark, sf_dir), ["user_id"], "event_time", "event_id", failed, STREAK_WITHIN)
    )


def fail_pairs_strict(spark, sf_dir):
    failed = F.col("event_type") == "error"
    pairs = match_sequence(
        events(spark, sf_dir), ["user_id"], "event_time", "event_id", [("first", failed), ("second", failed)],
        "2 hours", columns=["event_id"],
    )
    return pairs.select("user_id", F.col("first.event_id").alias("first_id"), F.col("second.event_id").alias("second_id"))


def fail_times2_global(spark, sf_dir):
    failed = F.col("event_type") == "error"
    pairs = match_sequence(
        events(spark, sf_dir), [], "event_time", "event_id", [("fails", failed)], "10 minutes", times=2,
        columns=["event_id"],
    )
    return pairs.select(F.col("fails_1.event_id").alias("first_id"), F.col("fails_2.event_id").alias("second_id"))


def _signups(spark, sf_dir):
    steps = [("create", F.col("event_type") == "signup"), ("pay", F.col("event_type") == "purchase")]
    return match_sequence(
        events(spark, sf_dir), ["user_id"], "event_time", "event_id", steps, ORDER_WITHIN, contiguity="relaxed",
        emit_timeouts=True, columns=["event_id"],
    )


def signup_purchase(spark, sf_dir):
    done = _signups(spark, sf_dir).filter(F.col("status") == "match")
    return done.select("user_id", F.col("create.event_id").alias("create_id"), F.col("pay.event_id").alias("pay_id"))


def signup_timeout(spark, sf_dir):
    open_ = _signups(spark, sf_dir).filter(F.col("status") == "timeout")
    return open_.select("user_id", F.col("create.event_id").alias("create_id"), "status")


def funnel_three_steps(spark, sf_dir):
    steps = [(kind, F.col("event_type") == kind) for kind in ("view", "click", "purchase")]
    found = match_sequence(
        events(spark, sf_dir), ["user_id"], "event_time", "event_id", steps, "1 day", contiguity="relaxed",
        emit_timeouts=True, columns=["event_id"],
    )
    ids = [F.col(f"{kind}.event_id").alias(f"{kind}_id") for kind in ("view", "click", "purchase")]
    return found.select("user_id", *ids, "status")


def order_status_query(spark, sf_dir):
    kind = F.col("event_type")
    return order_status(
        events(spark, sf_dir), "user_id", "event_time", "event_id", kind == "signup", kind == "purchase", ORDER_WITHIN
    )


def _two_sides(spark, sf_dir):
    df = events(spark, sf_dir).select("event_id", "user_id", "event_type", "event_time")
    side = lambda kind: df.filter(F.col("event_type") == kind).drop("event_type")
    return side("click"), side("purchase")


_MATCH = dict(on=("user_id", "user_id"), ts=("event_time", "event_time"), lower="-3 hours", upper="5 hours",
              names=("click", "purchase"))


def interval_join_query(spark, sf_dir):
    pairs = interval_join(*_two_sides(spark, sf_dir), **_MATCH)
    return pairs.select(F.col("click.event_id").alias("click_id"), F.col("purchase.event_id").alias("purchase_id"))


def reconcile_query(spark, sf_dir):
    rows = reconcile(*_two_sides(spark, sf_dir), tags=("matched", "click_only", "purchase_only"), **_MATCH)
    return rows.select(
        F.col("click.event_id").alias("click_id"), F.col("purchase.event_id").alias("purchase_id"), "tag"
    )


def two_stream_match(spark, sf_dir):
    """Clicks wait five hours for a purchase of their user, purchases three hours for a click; first come, first matched."""
    sides = events(spark, sf_dir).filter(F.col("event_type").isin("click", "purchase"))
    out = first_come_match(sides, "user_id", "event_time", "event_id", F.col("event_type") == "click", "5 hours", "3 hours")
    return out.select(F.col("left_tie").alias("click_id"), F.col("right_tie").alias("purchase_id"), "tag")


def fail_bursts(spark, sf_dir):
    failed = F.col("event_type") == "error"
    return _alerts(failure_bursts(events(spark, sf_dir), ["user_id"], "event_time", "event_id", failed, STREAK_WITHIN))


def order_status_held(spark, sf_dir):
    """A create that is not paid in time is held a day longer for a late pay."""
    kind = F.col("event_type")
    return order_status(
        events(spark, sf_dir), "user_id", "event_time", "event_id", kind == "signup", kind == "purchase", ORDER_WITHIN,
        late_within="1 day",
    )


def kafka_decode(spark, sf_dir):
    """Behaviour rows through the topic format: CSV lines in a binary ``value``, decoded again."""
    rows = behavior(spark, sf_dir).select(
        "user_id", "item_id", (F.col("item_id") % 10).cast("int").alias("category_id"), "behavior",
        F.unix_seconds("event_time").alias("ts"),
    )
    decoded = decode_csv(to_kafka_value(rows), USER_BEHAVIOR)
    return decoded.groupBy("behavior", "category_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("item_id").alias("items"), F.max("ts").alias("last_ts")
    )


def access_log(spark, sf_dir):
    """Events written as access-log lines and parsed again."""
    line = F.format_string(
        "10.0.0.%d %d - %s +0000 %s /page/%s",
        (F.col("user_id") % 256),
        F.col("user_id"),
        F.date_format("event_time", "dd/MM/yyyy:HH:mm:ss"),
        F.when(F.col("behavior") == "view", "GET").otherwise("POST"),
        F.col("item_id").cast("string"),
    )
    lines = behavior(spark, sf_dir).select(line.alias("value"))
    log = traffic.page_requests(parse_access_log(lines))
    return log.groupBy("url").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("ip").alias("ips"),
        F.max(F.unix_seconds("event_time")).alias("last_ts"),
    )


QUERIES: dict[str, Query] = {
    "hot_items": hot_items,
    "hot_items_sql": hot_items_sql,
    "hot_items_report": hot_items_report,
    "hot_pages": hot_pages,
    "hot_pages_daily": hot_pages_daily,
    "hot_pages_late": hot_pages_late,
    "hot_pages_relisted": hot_pages_relisted,
    "views_uneven": views_uneven,
    "unique_visitors_sliding_sketch": unique_visitors_sliding_sketch,
    "late_split": late_split,
    "page_views": page_views,
    "page_views_salted": page_views_salted,
    "unique_visitors": unique_visitors,
    "unique_visitors_bitmap": unique_visitors_bitmap,
    "unique_visitors_sketch": unique_visitors_sketch,
    "channel_counts": channel_counts,
    "channel_counts_daily": channel_counts_daily,
    "click_cap": click_cap_pass,
    "click_blacklist": click_blacklist,
    "capped_by_province": capped_by_province,
    "fail_anchor": fail_anchor,
    "fail_last_matched": fail_last_matched,
    "fail_pairs_strict": fail_pairs_strict,
    "fail_times2_global": fail_times2_global,
    "signup_purchase": signup_purchase,
    "signup_timeout": signup_timeout,
    "funnel_three_steps": funnel_three_steps,
    "fail_bursts": fail_bursts,
    "order_status": order_status_query,
    "order_status_held": order_status_held,
    "two_stream_match": two_stream_match,
    "interval_join": interval_join_query,
    "reconcile": reconcile_query,
    "kafka_decode": kafka_decode,
    "access_log": access_log,
}
