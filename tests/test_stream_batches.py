"""Registered streams over many batches, at a delay far shorter than the data, against the same rows in batch."""

import random

import pytest
from oracle_check import connect, difference
from pyspark.sql import functions as F

from footfall.plans.oracle import ORACLES
from footfall.plans.streams import STREAM_QUERIES, settled_events
from footfall.streaming.late import settled

SF = "/root/testdata/sf0.001"
DELAY_US = 6 * 3_600_000_000
#: The events that a stream takes at all, whose times its watermark follows.
KINDS = {
    "stream_page_views": ["view"], "stream_unique_visitors": ["view"], "stream_hot_items": ["view"], "stream_hot_pages": ["view"],
    "stream_hot_items_retract": ["view"], "stream_page_views_upsert": ["view"],
    "stream_unique_visitors_bitmap": ["view"], "stream_views_uneven": ["view"],
    "stream_order_status": ["signup", "purchase"], "stream_two_stream_match": ["click", "purchase"],
}


@pytest.fixture(scope="module")
def arrivals(spark):
    """Events in an order of arrival that is up to ten hours behind their times: (event_id, µs, type)."""
    rows = spark.read.parquet(f"{SF}/events.parquet").selectExpr("event_id", "unix_micros(cast(ts AS timestamp)) AS us", "event_type")
    draw = random.Random(11)
    late = {r.event_id: draw.choice([0, 0, 0, draw.randrange(36_000_000_000)]) for r in rows.collect()}
    return sorted(map(tuple, rows.collect()), key=lambda r: r[1] + late[r[0]])


@pytest.fixture(scope="module")
def cut(spark, arrivals, tmp_path_factory):
    """The events in two files in that order; ``event_id`` numbers the arrivals."""
    folder = str(tmp_path_factory.mktemp("events"))
    events = spark.read.parquet(f"{SF}/events.parquet")
    place = spark.createDataFrame([(r[0], n) for n, r in enumerate(arrivals)], "event_id bigint, place bigint")
    numbered = events.join(place, "event_id").select(F.col("place").alias("event_id"), *[c for c in events.columns if c != "event_id"])
    for low, high in ((0, 500), (500, 10_000)):
        part = numbered.filter(F.col("event_id").between(low, high - 1)).coalesce(1)
        part.write.mode("append").parquet(f"{folder}/events.parquet")
    for name in ("customer", "nation"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    return folder


def on_time(arrivals, kinds=None):
    """The numbers of the arrivals that a row-wise rule keeps."""
    kept, seen = [], None
    for n, (_, us, kind) in enumerate(arrivals):
        if kinds is None or kind in kinds:
            if seen is None or us > (seen - DELAY_US) // 1000 * 1000:
                kept.append(n)
            seen = us if seen is None else max(seen, us)
    return kept


@pytest.mark.parametrize("name", sorted(set(STREAM_QUERIES) - {"stream_late_split", "stream_late_rows", "stream_hot_pages_late"}))
def test_batches_give_what_a_row_wise_rule_keeps(spark, arrivals, cut, tmp_path, name):
    if name == "stream_interval_join":  # each side has a watermark of its own
        kept = on_time(arrivals, ["click"]) + on_time(arrivals, ["purchase"])
    else:
        kept = on_time(arrivals, KINDS.get(name))
    assert len(kept) < sum(kind in KINDS.get(name, [kind]) for _, _, kind in arrivals)
    spark.read.parquet(f"{cut}/events.parquet").filter(F.col("event_id").isin(kept)).coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    con = connect("/root/testdata/sf0.001")
    con.execute(f"CREATE OR REPLACE VIEW events AS SELECT * FROM read_parquet('{tmp_path}/events.parquet/*.parquet')")
    got = STREAM_QUERIES[name](spark, cut, delay="6 hours", files_per_trigger=1)
    assert difference(got, con, ORACLES[name]) is None


@pytest.mark.parametrize("files_per_trigger", [1, None])
def test_late_rows_do_not_depend_on_the_cut(spark, arrivals, cut, files_per_trigger):
    settle = settled_events(spark, cut, "late", delay="6 hours", close=False, files_per_trigger=files_per_trigger)
    late = {r.event_id for r in spark.read.parquet(f"{settle.folder}/late").collect()}
    kept = {r.event_id for r in spark.read.parquet(f"{settle.folder}/kept").collect()}
    assert sorted(kept) == on_time(arrivals)
    assert late == set(range(len(arrivals))) - kept and len(late) > 20


def test_nothing_is_dropped_behind_the_split(spark, cut):
    from footfall.streaming.late import run_settled
    from footfall.streaming.sinks import append_writer, read_latest, run_available

    settle = settled_events(spark, cut, "late", delay="6 hours", close=False, files_per_trigger=1)
    total = spark.read.parquet(f"{settle.folder}/kept").count()
    counted = settle.rows.groupBy(F.window("event_time", "1 hour")).count()
    folder = settle.folder
    run_settled([settle], lambda: run_available(counted, f"{folder}/counting", mode="update", writer=append_writer(f"{folder}/counts")))
    counts = read_latest(spark, f"{folder}/counts", ["window"])
    assert counts.agg(F.sum("count")).first()[0] == total
    assert spark.read.parquet(f"{folder}/counts").select("batch_id").distinct().count() >= 2


@pytest.mark.parametrize("name", ["stream_late_split", "stream_late_rows", "stream_hot_pages_late"])
def test_late_queries_over_files_in_order_of_arrival(spark, tmp_path, name):
    events = spark.read.parquet(f"{SF}/events.parquet")
    arrival = F.expr("unix_micros(cast(ts AS timestamp)) + event_id * 7919 % 3600 * 1000000")
    ranked = [r.event_id for r in events.orderBy(arrival, "event_id").collect()]
    for part in (ranked[:1], ranked[1:400], ranked[400:]):
        events.filter(F.col("event_id").isin(part)).coalesce(1).write.mode("append").parquet(f"{tmp_path}/events.parquet")
    got = STREAM_QUERIES[name](spark, str(tmp_path), files_per_trigger=1)
    assert got.count() > 3
    assert difference(got, connect(SF), ORACLES[name]) is None


def test_an_empty_stream(spark, tmp_path):
    schema = "id bigint, event_time timestamp"
    spark.createDataFrame([], schema).write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    settle = settled(source, str(tmp_path / "s"), "event_time", "1 hour", ["id"], "1 day")
    assert settle.rows.isStreaming
