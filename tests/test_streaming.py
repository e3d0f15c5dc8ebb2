"""Streams against the batch operators on the same rows."""

import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from footfall.functions import micros
from footfall.operators import (
    anchored_alerts,
    chained_alerts,
    click_cap,
    failure_bursts,
    first_come_match,
    match_sequence,
    order_status,
    reconcile,
    top_n,
)
from footfall.operators.windows import sliding_counts, tumbling_counts
from footfall.plans import hot_items, traffic
from footfall.streaming.changelog import apply_changes, ranking_changes, retracting_top_n_writer
from footfall.streaming.late import late_rows_writer, late_splitting_writer
from footfall.streaming.processors import (
    AnchoredFailures,
    ChainedFailures,
    ClickCap,
    FailureBursts,
    OrderStatus,
    SequenceMatch,
    TwoStreamMatch,
    run_processor,
)
from footfall.streaming.registers import merged_rankings, page_rankings
from footfall.streaming.sinks import (
    append_writer,
    compact_log,
    from_one_run,
    print_stream,
    read_latest,
    run_available,
    tagged_writer,
    top_n_writer,
    upsert_writer,
)
from footfall.streaming.snapshots import read_snapshot, snapshot_writer

SF = "/root/testdata/sf0.001/events.parquet"
START = datetime(2024, 1, 1, tzinfo=timezone.utc)


def at(seconds):
    return START + timedelta(seconds=seconds)


class Feed:
    """Micro-batches in files; each file is one batch, taken in order."""

    def __init__(self, spark, folder, schema):
        self.spark, self.folder, self.schema, self.n = spark, folder, schema, 0

    def add(self, rows):
        df = rows if hasattr(rows, "columns") else self.spark.createDataFrame(rows, self.schema)
        df.coalesce(1).write.mode("append").parquet(f"{self.folder}/in")
        self.n += 1
        return self

    def stream(self, delay="0 seconds", ts="event_time"):
        source = self.spark.readStream.schema(self.schema).option("maxFilesPerTrigger", 1)
        return source.parquet(f"{self.folder}/in").withWatermark(ts, delay)

    def run(self, stream, mode="append", writer=None):
        out = f"{self.folder}/out"
        run_available(stream, f"{self.folder}/checkpoint", out, mode, writer)
        return self.spark.read.parquet(out) if writer is None else None


BEHAVIOR = "event_id bigint, user_id bigint, item_id bigint, behavior string, event_time timestamp"


@pytest.fixture
def behavior(spark):
    item = F.get_json_object("props", "$.k").cast("bigint") % 10
    return spark.read.parquet(SF).select(
        "event_id", "user_id", item.alias("item_id"), F.col("event_type").alias("behavior"),
        F.col("ts").cast("timestamp").alias("event_time"),
    )


@pytest.fixture
def behavior_feed(spark, tmp_path, behavior):
    """Two halves of the table, then a row far ahead that closes every window."""
    feed = Feed(spark, str(tmp_path), BEHAVIOR)
    half = behavior.selectExpr("percentile(event_id, 0.5)").first()[0]
    feed.add(behavior.filter(F.col("event_id") <= half)).add(behavior.filter(F.col("event_id") > half))
    return feed.add([(-1, -1, -1, "view", at(10_000_000))])


def before_end(df):
    """Without the window of the closing row, which update mode reports too."""
    return df.filter(F.col("window_end") < int(at(9_000_000).timestamp()) * 1000)


def same(a, b):
    cols = sorted(a.columns)
    assert cols == sorted(b.columns)
    left, right = (sorted(map(str, df.select(*cols).collect())) for df in (a, b))
    assert left == right


def views(df):
    return df.filter(F.col("behavior") == "view")


def test_chained_counts_in_append_mode(behavior_feed, behavior):
    got = behavior_feed.run(traffic.page_views(behavior_feed.stream(), kind="view"))
    same(got, traffic.page_views(behavior, kind="view"))


def test_salted_two_level_count(behavior_feed, behavior):
    stream = views(behavior_feed.stream())
    salted = stream.groupBy(F.window("event_time", "1 hour").alias("w"), (F.col("event_id") % 4).alias("salt")).count()
    total = salted.groupBy(F.window(F.window_time("w"), "1 hour").alias("w")).agg(F.sum("count").alias("count"))
    got = behavior_feed.run(total.select(F.unix_millis("w.end").alias("window_end"), "count"))
    same(got, traffic.page_views(behavior, kind="view"))


def test_unique_visitors(behavior_feed, behavior):
    got = behavior_feed.run(traffic.unique_visitors(behavior_feed.stream(), kind="view"))
    same(got, traffic.unique_visitors(behavior, kind="view"))


def test_unique_visitor_sketch(behavior_feed, behavior):
    got = behavior_feed.run(traffic.unique_visitors(behavior_feed.stream(), "sketch", kind="view"))
    same(got, traffic.unique_visitors(behavior, "sketch", kind="view"))


def test_ranking_of_closed_windows(spark, tmp_path, behavior_feed, behavior):
    counts = hot_items.item_counts(behavior_feed.stream(), kind="view")
    path = str(tmp_path / "top")
    behavior_feed.run(counts, writer=top_n_writer(path, "item_id", 3))
    got = spark.read.parquet(path).drop("batch_id")
    same(got, hot_items.hot_items(behavior, n=3, kind="view"))


def test_retracting_ranking(spark, tmp_path, behavior_feed, behavior):
    counts = hot_items.item_counts(behavior_feed.stream(), size="1 day", slide="12 hours", kind="view")
    path = str(tmp_path / "top")
    behavior_feed.run(counts, mode="update", writer=retracting_top_n_writer(path, "item_id", 3, keep="2 days"))
    changes = spark.read.parquet(f"{path}/changes")
    want = hot_items.hot_items(behavior, n=3, size="1 day", slide="12 hours", kind="view")
    same(before_end(apply_changes(changes, ["window_end", "row_num"])), want)
    # the window that both halves fill was ranked twice
    assert changes.filter("op = '-'").count() > 0


def test_a_batch_of_ranking_changes_reads_open_windows_only(spark, tmp_path):
    path, hour = str(tmp_path / "top"), 3_600_000
    write = retracting_top_n_writer(path, "id", 2, keep="2 hours")
    sizes, truth = {}, {}
    for k in range(12):  # each batch counts on in the last window and starts the next one
        rows = [(end * hour, i, (i * 7 + k) % 11 + 1) for end in (k, k + 1) for i in range(5)]
        truth.update({(e, i): n for e, i, n in rows})
        write(spark.createDataFrame(rows, "window_end bigint, id bigint, count bigint").coalesce(1), k)
        if k == 7:  # a batch that runs again changes nothing
            write(spark.createDataFrame(rows, "window_end bigint, id bigint, count bigint").coalesce(1), k)
        open_ = spark.read.parquet(f"{path}/open/batch_id={k}")
        sizes[k] = (open_.count(), len(open_.inputFiles()), len(list((tmp_path / "top" / "open").iterdir())))
    assert sizes[11] == sizes[5] and sizes[11][0] == 15 - 5
    got = apply_changes(spark.read.parquet(f"{path}/changes"), ["window_end", "row_num"])
    want = top_n(spark.createDataFrame([(*k, n) for k, n in truth.items()], "window_end bigint, id bigint, count bigint"), "id", 2)
    same(got, want)


def test_snapshot_readers_see_one_version(spark, tmp_path):
    path = str(tmp_path / "table")
    write = snapshot_writer(path, ["k"], buckets=4)
    rows = lambda *r: spark.createDataFrame(r, "k bigint, v string")
    table = lambda df: {r.k: r.v for r in df.collect()}
    with pytest.raises(ValueError, match="no batch"):
        read_snapshot(spark, path)
    write(rows(*[(k, "a") for k in range(20)]), 0)
    reader = read_snapshot(spark, path)
    write(rows((3, "b"), (None, "n"), (100, "b")), 1)
    assert table(reader) == {k: "a" for k in range(20)}  # still the version it has taken
    write(rows((3, "again")), 1)  # a batch that runs again
    assert table(read_snapshot(spark, path)) == {**{k: "a" for k in range(20)}, 3: "b", None: "n", 100: "b"}
    folders = []
    for k in range(2, 12):
        write(rows((5, f"v{k}")), k)
        folders.append(len(list((tmp_path / "table" / "data").iterdir())))
    assert table(read_snapshot(spark, path))[5] == "v11" and len(table(read_snapshot(spark, path))) == 22
    assert len(read_snapshot(spark, path).inputFiles()) <= 4 and max(folders) <= 6
    write(rows(), 12)
    assert len(table(read_snapshot(spark, path))) == 22


def test_rankings_change_with_late_rows_and_are_freed(spark, tmp_path):
    schema = "url bigint, event_time timestamp, live_from_us bigint"
    feed = Feed(spark, str(tmp_path), schema)
    # windows of 60 s every 60 s, kept for 30 s; rows are read 90 s behind
    feed.add([(1, at(1), None), (2, at(2), None), (2, at(3), None), (None, at(4), None)])
    feed.add([(7, at(75), None)]).add([(7, at(75), None)])  # the first window has ended
    feed.add([(1, at(5), None), (1, at(6), None), (7, at(76), None)])  # late rows that still count
    feed.add([(7, at(400), None)]).add([(7, at(401), None)])
    ranked = page_rankings(feed.stream("90 seconds"), "event_time", 2, "60 seconds", "60 seconds", "30 seconds", parts=3)
    path = str(tmp_path / "ranked")
    feed.run(ranked, writer=append_writer(path))
    end = int(at(60).timestamp()) * 1000
    first = spark.read.parquet(path).filter(F.col("window_end") == end)
    assert first.select("batch_id").distinct().count() > 1  # ranked again
    got = merged_rankings(spark, path, 2).filter(F.col("window_end") == end).orderBy("row_num").collect()
    assert [(r.url, r["count"]) for r in got] == [(1, 3), (2, 2)]
    state = spark.read.format("statestore").option("path", f"{tmp_path}/checkpoint").option("stateVarName", "counts").load()
    ends = {r[0] for r in state.select("key.window_end").collect()}
    assert ends and min(ends) > end  # the first window's map is gone


def test_ranking_changes(spark):
    old = spark.createDataFrame([(1, 1, "a", 5), (1, 2, "b", 4)], "window_end int, row_num int, id string, count int")
    new = spark.createDataFrame([(1, 1, "b", 6), (1, 2, "a", 5), (2, 1, "c", 1)], old.schema)
    got = sorted(tuple(r) for r in ranking_changes(old, new, ["window_end", "row_num"]).collect())
    assert got == [
        ("+", 1, 1, "b", 6), ("+", 1, 2, "a", 5), ("+", 2, 1, "c", 1), ("-", 1, 1, "a", 5), ("-", 1, 2, "b", 4),
    ]
    assert ranking_changes(new, new, ["window_end", "row_num"]).count() == 0


def test_upsert_keeps_the_latest_value(spark, tmp_path, behavior_feed, behavior):
    counts = tumbling_counts(views(behavior_feed.stream()), [], "event_time", "30 days")
    path = str(tmp_path / "table")
    behavior_feed.run(counts, mode="update", writer=upsert_writer(path))
    assert spark.read.parquet(path).count() > read_latest(spark, path, ["window_end"]).count()
    same(before_end(read_latest(spark, path, ["window_end"])), tumbling_counts(views(behavior), [], "event_time", "30 days"))


def test_a_compacted_log_goes_on(spark, tmp_path):
    old, new = str(tmp_path / "old"), str(tmp_path / "new")
    table = lambda *rows: spark.createDataFrame(rows, "k string, n int")
    upsert_writer(old)(table(("a", 1), ("b", 1)), 0)
    upsert_writer(old)(table(("a", 2)), 1)
    compact_log(spark, old, new, ["k"])
    assert spark.read.parquet(new).count() == 2
    upsert_writer(new)(table(("b", 3), ("c", 3)), 2)
    assert {(r.k, r.n) for r in read_latest(spark, new, ["k"]).collect()} == {("a", 2), ("b", 3), ("c", 3)}


def test_a_retried_batch_is_stored_once(spark, tmp_path):
    write = append_writer(str(tmp_path / "t"))
    df = spark.range(5)
    write(df, 0)
    write(df, 0)
    assert spark.read.parquet(str(tmp_path / "t")).count() == 5


def test_console(spark, tmp_path):
    feed = Feed(spark, str(tmp_path), "id bigint, event_time timestamp").add([(42, at(0))])
    query = print_stream(feed.stream(), "labelled", str(tmp_path / "cp"))
    query.processAllAvailable()
    progress = query.recentProgress
    query.stop()
    assert sum(p["numInputRows"] for p in progress) == 1
    assert "Console" in progress[0]["sink"]["description"]


def test_tagged_outputs(spark, tmp_path):
    feed = Feed(spark, str(tmp_path), "id bigint, tag string, event_time timestamp")
    feed.add([(1, "a", at(0)), (2, "b", at(1)), (3, "a", at(2))])
    paths = {t: str(tmp_path / t) for t in "ab"}
    feed.run(feed.stream(), writer=tagged_writer(paths))
    assert sorted(r.id for r in spark.read.parquet(paths["a"]).collect()) == [1, 3]
    assert [r.id for r in spark.read.parquet(paths["b"]).collect()] == [2]


def test_late_rows_are_set_apart(spark, tmp_path):
    feed = Feed(spark, str(tmp_path), "id bigint, event_time timestamp")
    feed.add([(1, at(0)), (2, at(1000))])
    # windows of 60 s every 10 s; the watermark is 999 s, windows live 30 s longer
    feed.add([(3, at(905)), (4, at(915)), (5, at(1001))])
    path = str(tmp_path / "split")
    writer = late_splitting_writer(path, "event_time", "1 second", "60 seconds", "10 seconds", "30 seconds", ["id"])
    feed.run(feed.stream("1000 days"), writer=writer)
    assert sorted(r.id for r in spark.read.parquet(f"{path}/late").collect()) == [3]
    assert sorted(r.id for r in spark.read.parquet(f"{path}/kept").collect()) == [1, 2, 4, 5]


EVENT = "user_id bigint, us bigint, tie bigint, fail boolean, event_time timestamp"


@pytest.fixture
def failures(behavior):
    return behavior.select(
        (F.col("user_id") % 7).alias("user_id"), micros("event_time").alias("us"), F.col("event_id").alias("tie"),
        (F.col("behavior") == "error").alias("fail"), "event_time",
    )


@pytest.mark.parametrize("processor, batch", [(AnchoredFailures, anchored_alerts), (ChainedFailures, chained_alerts)])
def test_failure_alerts(spark, tmp_path, failures, processor, batch):
    feed = Feed(spark, str(tmp_path), EVENT)
    feed.add(failures.filter("tie < 400")).add(failures.filter("tie >= 400"))
    feed.add([(None, int(at(10_000_000).timestamp()) * 1_000_000, None, None, at(10_000_000))])
    got = feed.run(run_processor(feed.stream(), ["user_id"], processor(12 * 3_600_000_000)))
    want = batch(failures, ["user_id"], "event_time", "tie", F.col("fail"), "12 hours")
    want = want.select("user_id", micros("first_fail_time").alias("first_us"), micros("last_fail_time").alias("last_us"), "msg")
    assert want.count() > 10
    same(got, want)


END = int(at(10_000_000).timestamp()) * 1_000_000


def test_failure_bursts(spark, tmp_path, failures):
    feed = Feed(spark, str(tmp_path), EVENT)
    feed.add(failures.filter("tie < 400")).add(failures.filter("tie >= 400")).add([(None, END, None, None, at(10_000_000))])
    got = feed.run(run_processor(feed.stream(), ["user_id"], FailureBursts(12 * 3_600_000_000)))
    want = failure_bursts(failures, ["user_id"], "event_time", "tie", F.col("fail"), "12 hours")
    want = want.select("user_id", micros("first_fail_time").alias("first_us"), micros("last_fail_time").alias("last_us"), "msg")
    assert want.count() > 5
    same(got, want)


def test_click_cap(spark, tmp_path, behavior):
    rows = behavior.select(
        (F.col("user_id") % 3).alias("user_id"), F.col("behavior").alias("target"), micros("event_time").alias("us"),
        F.col("event_id").alias("tie"), "event_time",
    )
    day = F.expr("(us + 28800000000) div 86400000000")
    rows = rows.withColumn("day", day)
    feed = Feed(spark, str(tmp_path), rows.schema)
    feed.add(rows.filter("tie < 500")).add(rows.filter("tie >= 500"))
    # rows wait for the watermark; one far ahead without a key ends the stream
    feed.add([(None, None, int(at(10_000_000).timestamp()) * 1_000_000, None, at(10_000_000), None)])
    got = feed.run(run_processor(feed.stream(), ["user_id", "target"], ClickCap(2, 28_800_000_000)))
    want = click_cap(rows, ["user_id", "target"], "event_time", "tie", 2).select("user_id", "target", "tie", "tag")
    assert want.filter("tag = 'blacklist'").count() > 5
    same(got.drop("us"), want)


def test_keys_share_state_and_timers(spark, tmp_path):
    """A call into the state per key made streams of many keys slow, so timers are no more than buckets."""
    schema = "user_id bigint, target string, us bigint, tie bigint, day bigint, event_time timestamp"
    first, keys = int(START.timestamp()) * 1_000_000, 3 * ClickCap.buckets
    times = F.lit(first) + F.col("id") * 1000
    rows = spark.range(3 * keys).select(
        (F.col("id") % keys).alias("user_id"), F.lit("a").alias("target"), times.alias("us"), F.col("id").alias("tie"),
        F.expr(f"({first} + id * 1000) div 86400000000").alias("day"), F.timestamp_micros(times).alias("event_time"),
    )
    feed = Feed(spark, str(tmp_path), schema).add(rows)
    feed.add([(None, None, END, None, None, at(10_000_000))])
    tagged = run_processor(feed.stream("1 hour"), ["user_id", "target"], ClickCap(1, 0))
    query = (
        tagged.writeStream.option("checkpointLocation", f"{tmp_path}/checkpoint").option("path", f"{tmp_path}/out")
        .format("parquet").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    timers = sum(p["stateOperators"][0]["customMetrics"]["numRegisteredTimers"] for p in query.recentProgress)
    assert 0 < timers <= 2 * ClickCap.buckets
    got = spark.read.parquet(f"{tmp_path}/out")
    wanted = rows.filter(F.col("tie") < 2 * keys).select(
        "user_id", "target", "us", "tie", F.when(F.col("tie") < keys, "pass").otherwise("blacklist").alias("tag")
    )
    same(got, wanted)


def test_a_batch_from_one_run(spark, tmp_path):
    """A sort by range reads its input twice, which would run the state behind a batch twice."""
    runs = spark.sparkContext.accumulator(0)
    seen = F.udf(lambda x: runs.add(1) or x, "bigint").asNondeterministic()
    batch = spark.range(100).select(seen("id").alias("id"), F.timestamp_seconds("id").alias("event_time"))
    writer = from_one_run(late_rows_writer(str(tmp_path), "event_time", "1 hour", ["id"]))
    writer(batch, 0)
    assert runs.value == 100
    assert spark.read.parquet(f"{tmp_path}/kept").count() == 100


def test_order_status(spark, tmp_path):
    schema = "order_id bigint, kind string, us bigint, tie bigint, event_time timestamp"
    row = lambda order, kind, s: (order, kind, int(at(s).timestamp()) * 1_000_000, s, at(s))
    feed = Feed(spark, str(tmp_path), schema)
    # 1 in time, 2 at the limit, 3 never paid, 4 never created, 5 late, 6 too late, 7 pays before it is created in a later batch
    feed.add([row(1, "create", 0), row(1, "pay", 10), row(2, "create", 0), row(2, "pay", 900), row(3, "create", 5),
              row(4, "pay", 20), row(5, "create", 0), row(5, "pay", 901), row(6, "pay", 1001), row(7, "pay", 50)])
    feed.add([row(6, "create", 0), row(7, "create", 40), row(9, "create", 5000), row(9, "pay", 5001)])
    feed.add([(None, None, END, None, at(10_000_000))])
    late = run_processor(feed.stream("2 hours"), ["order_id"], OrderStatus(900_000_000, 100_000_000))
    got = sorted((r.order_id, r.status) for r in feed.run(late).collect())
    assert got == [
        (1, "payed"), (2, "payed"), (3, "timeout"), (4, "payed but not created"), (5, "payed but already timeout"),
        (6, "payed but not created"), (6, "timeout"), (7, "payed"), (9, "payed"),
    ]
    batch = order_status(spark.read.schema(schema).parquet(f"{tmp_path}/in"), "order_id", "event_time", "tie",
                         F.col("kind") == "create", F.col("kind") == "pay", "15 minutes", late_within="100 seconds")
    assert sorted((r.order_id, r.status) for r in batch.collect()) == got


def test_two_stream_match(spark, tmp_path):
    schema = "tx_id string, side string, us bigint, tie bigint, event_time timestamp"
    row = lambda tx, side, s, tie: (tx, side, int(at(s).timestamp()) * 1_000_000, tie, at(s))
    feed = Feed(spark, str(tmp_path), schema)
    feed.add([row("a", "pay", 0, 1), row("a", "receipt", 2, 2), row("b", "pay", 1, 3), row("c", "receipt", 2, 4), row("d", "receipt", 6, 6)])
    # d's pay comes in a later batch, but earlier; e's first pay is replaced; f's receipt is late by a second
    feed.add([row("d", "pay", 1, 5), row("e", "pay", 1, 7), row("e", "pay", 3, 8), row("e", "receipt", 8, 9), row("f", "pay", 1, 10), row("f", "receipt", 7, 11)])
    draw = random.Random(4)
    feed.add([row(f"r{draw.randrange(4)}", draw.choice(["pay", "receipt"]), draw.randrange(60, 400), 100 + i) for i in range(200)])
    feed.add([(None, None, END, None, at(10_000_000))])
    got = feed.run(run_processor(feed.stream("2 hours"), ["tx_id"], TwoStreamMatch()))
    rows = spark.read.schema(schema).parquet(f"{tmp_path}/in")
    want = first_come_match(rows, "tx_id", "event_time", "tie", F.col("side") == "pay", parts=30)
    same(got, want.withColumnsRenamed({"left_tie": "pay_tie", "right_tie": "receipt_tie"}))
    known = got.filter("tx_id < 'r'").collect()
    assert {(r.tx_id, r.pay_tie, r.receipt_tie, r.tag) for r in known} == {
        ("a", 1, 2, "matched"), ("b", 3, None, "unmatched-pays"), ("c", None, 4, "unmatched-receipts"), ("d", 5, 6, "matched"),
        ("e", 8, 9, "matched"), ("f", 10, None, "unmatched-pays"), ("f", None, 11, "unmatched-receipts"),
    }


@pytest.mark.parametrize("contiguity", ["strict", "relaxed"])
def test_sequences(spark, tmp_path, behavior, contiguity):
    rows = behavior.select(
        (F.col("user_id") % 7).alias("user_id"), micros("event_time").alias("us"), F.col("event_id").alias("tie"), "event_time",
        F.expr("int(behavior = 'view') + 2 * int(behavior = 'click') + 4 * int(behavior = 'purchase')").cast("bigint").alias("fits"),
    )
    feed = Feed(spark, str(tmp_path), rows.schema)
    feed.add(rows.filter("tie < 500")).add(rows.filter("tie >= 500"))
    feed.add([(-1, int(at(10_000_000).timestamp()) * 1_000_000, -1, at(10_000_000), 0)])
    got = feed.run(run_processor(feed.stream(), ["user_id"], SequenceMatch(3, 43_200_000_000, contiguity == "strict")))
    steps = [(name, F.col("fits") == bit) for name, bit in (("a", 1), ("b", 2), ("c", 4))]
    want = match_sequence(
        rows, ["user_id"], "event_time", "tie", steps, "12 hours", contiguity, emit_timeouts=True, columns=["tie"]
    ).select("user_id", F.array_compact(F.array("a.tie", "b.tie", "c.tie")).alias("ids"), "status")
    assert want.filter("status = 'match'").count() > 5
    same(got, want)


def test_interval_join_and_reconcile(spark, tmp_path, behavior):
    feed = Feed(spark, str(tmp_path), BEHAVIOR)
    feed.add(behavior).add([(-1, -1, -1, kind, at(10_000_000)) for kind in ("click", "purchase")])
    options = dict(on=("user_id", "user_id"), ts=("event_time", "event_time"), lower="-3 hours", upper="5 hours")
    side = lambda df, kind: df.filter(F.col("behavior") == kind).select("event_id", "user_id", "event_time")
    stream = feed.stream()
    joined = reconcile(side(stream, "click"), side(stream, "purchase"), **options)
    ids = ["pay.event_id as pay_id", "receipt.event_id as receipt_id", "tag"]
    got = feed.run(joined.selectExpr(*ids)).filter("coalesce(pay_id, receipt_id) >= 0")
    want = reconcile(side(behavior, "click"), side(behavior, "purchase"), **options).selectExpr(*ids)
    assert want.filter("tag = 'matched'").count() > 2
    same(got, want)


def test_batch_forms_name_their_stream_form(behavior_feed):
    steps = [("a", F.col("behavior") == "view"), ("b", F.col("behavior") == "click")]
    with pytest.raises(ValueError, match="SequenceMatch"):
        match_sequence(behavior_feed.stream(), ["user_id"], "event_time", "event_id", steps, "1 hour")


def test_sql_over_a_stream(spark, behavior_feed, behavior):
    behavior_feed.stream().createOrReplaceTempView("stream_behavior")
    counts = spark.sql(
        "SELECT item_id, unix_millis(window.end) AS window_end, count(item_id) AS count FROM stream_behavior"
        " WHERE behavior = 'view' GROUP BY item_id, window(event_time, '1 hour', '5 minutes')"
    )
    same(behavior_feed.run(counts), sliding_counts(views(behavior), ["item_id"], "event_time", "1 hour", "5 minutes"))


def test_lateness_by_a_longer_watermark(spark, tmp_path):
    """A window that has been reported is reported again when a late row comes in time."""
    feed = Feed(spark, str(tmp_path), "url string, event_time timestamp")
    feed.add([("a", at(1)), ("a", at(70))]).add([("a", at(2))]).add([("a", at(3)), ("b", at(200))])
    # Spark filters late rows by the watermark of the batch before
    feed.add([("b", at(201))]).add([("a", at(4))])
    counts = tumbling_counts(feed.stream("61 seconds"), ["url"], "event_time", "1 minute")
    path = str(tmp_path / "counts")
    feed.run(counts, mode="update", writer=upsert_writer(path))
    first_end = int(at(60).timestamp()) * 1000
    seen = [r["count"] for r in spark.read.parquet(path).filter(F.col("window_end") == first_end).orderBy("batch_id").collect()]
    assert seen == [1, 2, 3]
    ranked = top_n(read_latest(spark, path, ["window_end", "url"]), "url", 3)
    assert {(r.window_end, r.url, r["count"]) for r in ranked.collect()} >= {(first_end, "a", 3)}
