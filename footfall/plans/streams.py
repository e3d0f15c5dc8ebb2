"""Catalog queries that run as streams over the driver's tables.

Each reads the table as a file stream, processes what is there, and returns what
the stream has written to the shared folder.  Rows arrive batch by batch, and in a batch in
order of ``event_id``; those that are ``delay`` or more behind the largest time before them are
late (see ``streaming.late``) and kept apart, for ``stream_late_rows`` to return.  All that is
there is one batch, unless ``files_per_trigger`` says otherwise; a batch's rows go through
the query before those of the next.  The input ends, so a closing row ends all windows and timers.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.functions import micros
from footfall.operators import interval_join, sliding_counts, summarize_runs, top_n
from footfall.operators.uniques import exact_uniques
from footfall.operators.windows import expand_runs, tumbling_counts
from footfall.plans.catalog import JITTER, LATE, RELISTED, UNEVEN
from footfall.session import pin_zone, shared_folder, state_partitions
from footfall.streaming.changelog import apply_changes, retracting_top_n_writer
from footfall.streaming.late import Settled, late_rows_writer, late_splitting_writer, released, run_settled, settled
from footfall.streaming.panes import close_windows, pane_length, sliding_writer
from footfall.streaming.processors import (
    AnchoredFailures,
    ChainedFailures,
    ClickCap,
    FailureBursts,
    OrderStatus,
    TwoStreamMatch,
    run_processor,
)
from footfall.streaming.registers import merged_rankings, page_rankings, visitor_bits
from footfall.streaming.sinks import Writer, append_writer, from_one_run, run_available, tagged_writer, top_n_writer
from footfall.streaming.snapshots import read_snapshot, snapshot_writer

DELAY = "1 hour"
#: Longer than any window, day, wait or join range below.
CLOSE_AFTER = "2 days"
#: State machines wake up by the hour, as rows wait for an hour.
GRAIN_MS = 3_600_000


def _events(spark: SparkSession, sf_dir: str, kind: Column | None = None, files_per_trigger: int | None = None) -> DataFrame:
    pin_zone(spark)
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    stream = spark.readStream.schema(schema)
    if files_per_trigger:
        stream = stream.option("maxFilesPerTrigger", files_per_trigger)
    # a plain path must be a folder for a file stream; a pattern may also match one file
    rows = stream.parquet(f"{sf_dir}/events.parque[t]").withColumn("event_time", F.col("ts").cast("timestamp"))
    # filtered first, so that the watermark follows these alone
    return rows if kind is None else rows.filter(kind)


def settled_events(
    spark: SparkSession, sf_dir: str, label: str, delay: str = DELAY, kind: Column | None = None, close: bool = True,
    files_per_trigger: int | None = None,
) -> Settled:
    """Events within the delay; its folder has the late ones under ``late``."""
    rows, folder = _events(spark, sf_dir, kind, files_per_trigger), f"{shared_folder(spark, label)}/settled"
    with state_partitions(spark):
        return settled(rows, folder, "event_time", delay, ["event_id"], CLOSE_AFTER if close else None)


def _of_type(spark: SparkSession, sf_dir: str, kind: str, **options) -> Settled:
    return settled_events(spark, sf_dir, kind, kind=F.col("event_type") == kind, **options)


def _written(
    spark: SparkSession,
    label: str,
    sources: Sequence[Settled],
    stream: DataFrame,
    mode: str = "append",
    make: Callable[[str], Writer] | None = None,
) -> str:
    folder = shared_folder(spark, label)
    writer = make(f"{folder}/out") if make else None
    with state_partitions(spark):
        run_settled(sources, lambda: run_available(stream, f"{folder}/checkpoint", f"{folder}/out", mode, writer))
    return f"{folder}/out"


def stream_page_views(spark, sf_dir, **options):
    views = _of_type(spark, sf_dir, "view", **options)
    counts = tumbling_counts(views.rows, [], "event_time", "1 hour")
    return spark.read.parquet(_written(spark, "page-views", [views], counts))


def stream_unique_visitors(spark, sf_dir, **options):
    views = _of_type(spark, sf_dir, "view", **options)
    counts = exact_uniques(views.rows, "user_id", "event_time", "1 hour")
    return spark.read.parquet(_written(spark, "unique-visitors", [views], counts))


def _item_counts(spark, sf_dir, **options):
    item = F.get_json_object("props", "$.k").cast("bigint")
    views = _of_type(spark, sf_dir, "view", **options)
    items = views.rows.select(item.alias("item_id"), "event_time")
    return [views], sliding_counts(items, ["item_id"], "event_time", "1 hour", "5 minutes")


def stream_hot_items(spark, sf_dir, **options):
    out = _written(spark, "hot-items", *_item_counts(spark, sf_dir, **options), make=lambda path: top_n_writer(path, "item_id", 5))
    return spark.read.parquet(out).select("window_end", "item_id", "count", "row_num")


def stream_hot_items_retract(spark, sf_dir, **options):
    """The ranking that the change log of the retracting stream leads to; open windows are in it."""
    keep = f"1 hour {options.get('delay', DELAY)}"  # a window and the watermark's delay
    out = _written(spark, "hot-items-retract", *_item_counts(spark, sf_dir, close=False, **options), "update",
                   lambda path: retracting_top_n_writer(path, "item_id", 5, keep))
    changes = spark.read.parquet(f"{out}/changes")
    return apply_changes(changes, ["window_end", "row_num"]).select("window_end", "item_id", "count", "row_num")


def stream_page_views_upsert(spark, sf_dir, **options):
    """Page views kept in a keyed table by updates; open windows are in it."""
    views = _of_type(spark, sf_dir, "view", close=False, **options)
    counts = tumbling_counts(views.rows, [], "event_time", "1 hour")
    out = _written(spark, "page-views-upsert", [views], counts, "update", lambda path: snapshot_writer(path, ["window_end"]))
    return read_snapshot(spark, out)


def stream_interval_join(spark, sf_dir, **options):
    sides = [_of_type(spark, sf_dir, kind, **options) for kind in ("click", "purchase")]
    pairs = interval_join(
        *[side.rows.select("event_id", "user_id", "event_time") for side in sides], ("user_id", "user_id"), ("event_time", "event_time"), "-3 hours", "5 hours",
        names=("click", "purchase"),
    )
    ids = pairs.select(F.col("click.event_id").alias("click_id"), F.col("purchase.event_id").alias("purchase_id"))
    return spark.read.parquet(_written(spark, "interval-join", sides, ids))


def _machine(spark, label, source, rows, key, processor):
    processor.grain_ms = GRAIN_MS
    return spark.read.parquet(_written(spark, label, [source], run_processor(rows, key, processor)))


def _failures(spark, sf_dir, label, processor, **options):
    events = settled_events(spark, sf_dir, label, **options)
    rows = events.rows.select(
        "user_id", "event_time", micros("event_time").alias("us"), F.col("event_id").alias("tie"),
        (F.col("event_type") == "error").alias("fail"),
    )
    return _machine(spark, label, events, rows, ["user_id"], processor)


def stream_fail_anchor(spark, sf_dir, **options):
    return _failures(spark, sf_dir, "fail-anchor", AnchoredFailures(43_200_000_000), **options)


def stream_fail_last_matched(spark, sf_dir, **options):
    return _failures(spark, sf_dir, "fail-last-matched", ChainedFailures(43_200_000_000), **options)


def stream_fail_bursts(spark, sf_dir, **options):
    return _failures(spark, sf_dir, "fail-bursts", FailureBursts(43_200_000_000), **options)


def _clicks(spark, sf_dir, **options):
    day_offset = 28_800_000_000
    events = settled_events(spark, sf_dir, "clicks", **options)
    clicks = events.rows.select(
        "user_id", F.col("event_type").alias("target"), micros("event_time").alias("us"),
        F.col("event_id").alias("tie"), "event_time",
    )
    clicks = clicks.withColumn("day", F.expr(f"(us + {day_offset}) div 86400000000"))
    processor = ClickCap(2, day_offset)
    processor.grain_ms = GRAIN_MS
    return events, run_processor(clicks, ["user_id", "target"], processor)


def stream_click_cap(spark, sf_dir, **options):
    events, tagged = _clicks(spark, sf_dir, **options)
    out = spark.read.parquet(_written(spark, "click-cap", [events], tagged))
    return out.select("user_id", F.col("target").alias("event_type"), F.col("tie").alias("event_id"), "tag")


def stream_tagged_clicks(spark, sf_dir, **options):
    """The click cap's main and side output, each in a table of its own, counted by user."""
    events, tagged = _clicks(spark, sf_dir, **options)
    folder, tags = shared_folder(spark, "tagged"), ("pass", "blacklist")
    _written(spark, "tagging", [events], tagged, make=lambda path: tagged_writer({t: f"{folder}/{t}" for t in tags}))
    tables = [spark.read.parquet(f"{folder}/{t}").withColumn("tag", F.lit(t)) for t in tags]
    return tables[0].unionByName(tables[1]).groupBy("tag", "user_id").agg(F.count(F.lit(1)).alias("n"))


def stream_capped_by_province(spark, sf_dir, **options):
    """Windows of an hour every five seconds by province, of the clicks that a state machine lets through; by day.

    The machine gives rows when the watermark has passed them, so the count behind it has a
    watermark of its own.  A batch's rows may be a step of the machine's timers older than those before.
    """
    events, tagged = _clicks(spark, sf_dir, **options)
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", "c_nationkey")
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet").select("n_nationkey", F.col("n_name").alias("province"))
    kept = tagged.filter("tag = 'pass'").join(customer, F.col("user_id") == F.col("c_custkey")).join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    ).select("province", "us", "tie", F.timestamp_micros("us").alias("event_time"))
    folder, behind = shared_folder(spark, "passed"), f"{GRAIN_MS} milliseconds"
    writer = from_one_run(late_rows_writer(folder, "event_time", behind, ["us", "tie"]))
    with state_partitions(spark):
        run_settled([events], lambda: run_available(kept, f"{folder}/checkpoint", writer=writer))
    passed = released(spark, folder, kept, "event_time", [behind], CLOSE_AFTER)
    panes = tumbling_counts(passed.rows.select("province", "event_time"), ["province"], "event_time", "5 seconds")
    return summarize_runs(_swept(spark, "provinces", [passed], panes, ["province"], "1 hour", "5 seconds"), ["province"], "5 seconds")


def stream_order_status(spark, sf_dir, **options):
    """Sign-ups and purchases as creates and pays; a late pay is waited for a day longer."""
    kind = F.when(F.col("event_type") == "signup", "create").when(F.col("event_type") == "purchase", "pay")
    events = settled_events(spark, sf_dir, "orders", kind=kind.isNotNull(), **options)
    rows = events.rows.select(
        "user_id", kind.alias("kind"), micros("event_time").alias("us"), F.col("event_id").alias("tie"), "event_time"
    )
    out = _machine(spark, "orders", events, rows, ["user_id"], OrderStatus(43_200_000_000, 86_400_000_000))
    return out.select(F.col("order_id").alias("user_id"), "status")


def stream_two_stream_match(spark, sf_dir, **options):
    """Clicks wait five hours for a purchase of their user, purchases three hours for a click."""
    side = F.when(F.col("event_type") == "click", "pay").when(F.col("event_type") == "purchase", "receipt")
    events = settled_events(spark, sf_dir, "match", kind=side.isNotNull(), **options)
    rows = events.rows.select(
        F.col("user_id").cast("string").alias("tx_id"), side.alias("side"), micros("event_time").alias("us"),
        F.col("event_id").alias("tie"), "event_time",
    )
    out = _machine(spark, "match", events, rows, ["tx_id"], TwoStreamMatch(18_000_000_000, 10_800_000_000))
    return out.select(F.col("pay_tie").alias("click_id"), F.col("receipt_tie").alias("purchase_id"), "tag")


def stream_late_split(spark, sf_dir, files_per_trigger=None):
    """``late_split`` on a stream: rows arrive by their jittered times, each is judged by those before it."""
    rows = _events(spark, sf_dir, files_per_trigger=files_per_trigger)
    rows = rows.select("event_id", "event_time", (micros("event_time") + F.expr(JITTER)).alias("arrival"))
    folder = shared_folder(spark, "late-split")
    writer = late_splitting_writer(folder, "event_time", LATE["delay"], LATE["size"], LATE["slide"], LATE["lateness"], ["arrival", "event_id"])
    run_available(rows, f"{folder}/splitting", writer=writer)
    both = spark.read.parquet(f"{folder}/kept").unionByName(spark.read.parquet(f"{folder}/late"))
    return both.select("event_id", "tag", "watermark_us")


def stream_late_rows(spark, sf_dir, delay="20 minutes", files_per_trigger=None):
    """Views that are late by the plain delay rule, if they arrive by their jittered times."""
    rows = _events(spark, sf_dir, F.col("event_type") == "view", files_per_trigger)
    rows = rows.withColumn("arrival", micros("event_time") + F.expr(JITTER))
    folder = f"{shared_folder(spark, 'late-rows')}/settled"
    settled(rows, folder, "event_time", delay, ["arrival", "event_id"])
    return spark.read.parquet(f"{folder}/late").select("event_id", "user_id")


def stream_unique_visitors_bitmap(spark, sf_dir, **options):
    views = _of_type(spark, sf_dir, "view", **options)
    added = visitor_bits(views.rows, "user_id", "event_time", "1 hour")
    stored = spark.read.parquet(_written(spark, "unique-bits", [views], added))
    return stored.groupBy("window_end").agg(F.sum("added").alias("count"))


def stream_hot_pages_late(spark, sf_dir, files_per_trigger=None):
    """``hot_pages_relisted`` on a stream: windows are ranked when they end, and again after late rows."""
    views = _events(spark, sf_dir, F.col("event_type") == "view", files_per_trigger)
    rows = views.select(
        F.get_json_object("props", "$.k").cast("bigint").alias("url"), "event_id", "event_time",
        (micros("event_time") + F.expr(JITTER)).alias("arrival"),
    )
    folder = shared_folder(spark, "hot-pages-late")
    size, slide, lateness = (RELISTED[k] for k in ("size", "slide", "lateness"))
    run_available(rows, f"{folder}/splitting", writer=late_splitting_writer(folder, "event_time", arrival=["arrival", "event_id"], **RELISTED))
    kept = released(spark, folder, rows, "event_time", [RELISTED["delay"], size, lateness], CLOSE_AFTER)
    ranked = page_rankings(kept.rows, "event_time", 3, size, slide, lateness)
    out = _written(spark, "rankings", [kept], ranked, make=append_writer)
    return merged_rankings(spark, out, 3).select("window_end", "url", "count", "row_num")


def stream_views_uneven(spark, sf_dir, **options):
    """Views of ten minutes every four minutes, which is no whole part of ten."""
    views = _of_type(spark, sf_dir, "view", **options)
    panes = tumbling_counts(views.rows, [], "event_time", pane_length(*UNEVEN))
    runs = _swept(spark, "uneven", [views], panes, [], *UNEVEN)
    return expand_runs(runs, UNEVEN[1]).select("window_end", "count")


def _swept(spark, label, sources, panes, keys, size, slide, then=None):
    folder = shared_folder(spark, label)
    writer = sliding_writer(f"{folder}/windows", keys, size, slide, then)
    with state_partitions(spark):
        run_settled(sources, lambda: run_available(panes, f"{folder}/checkpoint", writer=writer))
    return close_windows(spark, f"{folder}/windows", keys, size, slide, then)


def stream_hot_pages(spark, sf_dir, **options):
    """The three most requested pages of ten minutes, every five seconds."""
    url = F.get_json_object("props", "$.k").cast("bigint")
    views = _of_type(spark, sf_dir, "view", **options)
    panes = tumbling_counts(views.rows.select(url.alias("url"), "event_time"), ["url"], "event_time", "5 seconds")
    ranked = lambda runs: top_n(expand_runs(runs, "5 seconds"), "url", 3)
    out = _swept(spark, "hot-pages", [views], panes, ["url"], "10 minutes", "5 seconds", ranked)
    return out.select("window_end", "url", "count", "row_num")


def stream_channel_counts_daily(spark, sf_dir, **options):
    """Windows of an hour every five seconds by channel and behaviour, summed up by day."""
    channel = (F.get_json_object("props", "$.k").cast("bigint") % 3).alias("channel")
    events = settled_events(spark, sf_dir, "channels", kind=F.col("event_type") != "unstall", **options)
    rows = events.rows.select(channel, F.col("event_type").alias("behavior"), "event_time")
    panes = tumbling_counts(rows, ["channel", "behavior"], "event_time", "5 seconds")
    runs = _swept(spark, "channels", [events], panes, ["channel", "behavior"], "1 hour", "5 seconds")
    return summarize_runs(runs, ["channel", "behavior"], "5 seconds")


STREAM_QUERIES = {
    "stream_page_views": stream_page_views,
    "stream_unique_visitors": stream_unique_visitors,
    "stream_unique_visitors_bitmap": stream_unique_visitors_bitmap,
    "stream_views_uneven": stream_views_uneven,
    "stream_hot_items": stream_hot_items,
    "stream_hot_items_retract": stream_hot_items_retract,
    "stream_page_views_upsert": stream_page_views_upsert,
    "stream_interval_join": stream_interval_join,
    "stream_fail_anchor": stream_fail_anchor,
    "stream_fail_last_matched": stream_fail_last_matched,
    "stream_fail_bursts": stream_fail_bursts,
    "stream_click_cap": stream_click_cap,
    "stream_tagged_clicks": stream_tagged_clicks,
    "stream_capped_by_province": stream_capped_by_province,
    "stream_order_status": stream_order_status,
    "stream_two_stream_match": stream_two_stream_match,
    "stream_hot_pages_late": stream_hot_pages_late,
    "stream_late_split": stream_late_split,
    "stream_late_rows": stream_late_rows,
    "stream_hot_pages": stream_hot_pages,
    "stream_channel_counts_daily": stream_channel_counts_daily,
}
