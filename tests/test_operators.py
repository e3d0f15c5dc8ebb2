"""Batch operators against brute force in Python, with block edges, ties and hot keys."""

import random
from collections import Counter, defaultdict
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from footfall.functions import PAGE_REPORT, bound_text, duration_us, poly_offset, ranking_report
from footfall.operators import (
    anchored_alerts,
    bitmap_rollup,
    bitmap_uniques,
    blacklist,
    chained_alerts,
    click_cap,
    count_bitmaps,
    error_bound,
    exact_uniques,
    expand_runs,
    interval_join,
    match_sequence,
    merge_bitmaps,
    naive_sliding_counts,
    order_status,
    passed,
    rank_within,
    reconcile,
    salted_tumbling_counts,
    sketch_rollup,
    sketch_uniques,
    sliding_count_runs,
    sliding_counts,
    sliding_sketches,
    sliding_uniques,
    split_late,
    top_n,
    top_n_sliding,
    tumbling_counts,
)
from footfall.operators.cuts import ordered_cuts

START = datetime(2024, 1, 1, tzinfo=timezone.utc)
BASE = int(START.timestamp())


def at(seconds):
    return START + timedelta(seconds=seconds)


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


@pytest.fixture(scope="module")
def log(spark):
    """3,000 events over three hours; user 0 holds a third of them; many equal times."""
    rnd = random.Random(7)
    data = []
    for i in range(3000):
        user = 0 if rnd.random() < 1 / 3 else rnd.randrange(1, 40)
        data.append((i, user, rnd.choice(["fail", "fail", "ok"]), rnd.randrange(-3600, 7200)))
    df = spark.createDataFrame([(i, u, k, at(s)) for i, u, k, s in data], "id bigint, user bigint, kind string, ts timestamp")
    df = df.repartition(7).persist()
    ordered = defaultdict(list)
    for i, u, k, s in sorted(data, key=lambda r: (r[3], r[0])):
        ordered[u].append((i, k, s))
    yield df, ordered
    df.unpersist()


# --- windows ---------------------------------------------------------------


@pytest.mark.parametrize("block", [None, "10 minutes", "1 hour"])
def test_sweep_equals_window(log, block):
    df, _ = log
    got = sliding_counts(df, ["user"], "ts", "10 minutes", "30 seconds", block)
    want = naive_sliding_counts(df, ["user"], "ts", "10 minutes", "30 seconds")
    assert rows(got, "user", "window_end", "count") == rows(want, "user", "window_end", "count")


def test_sliding_counts_add_up(log):
    df, _ = log
    got = sliding_counts(df, ["user"], "ts", "10 minutes", "5 seconds")
    assert got.agg(F.sum("count")).first()[0] == 3000 * 120


def test_runs_are_maximal(log):
    df, _ = log
    runs = sliding_count_runs(df, ["user"], "ts", "10 minutes", "30 seconds", "2 hours")
    assert rows(expand_runs(runs, "30 seconds"), "user", "window_end", "count") == rows(
        naive_sliding_counts(df, ["user"], "ts", "10 minutes", "30 seconds"), "user", "window_end", "count"
    )
    last = {}
    for user, first_end, last_end, count in rows(runs, "user", "first_end", "last_end", "count"):
        if user in last and last[user][0] == first_end - 30_000 and first_end % 7_200_000:
            assert last[user][1] != count
        last[user] = (last_end, count)


def test_window_edges(spark):
    """A row on an edge belongs to the windows that start there, not to those that end."""
    df = spark.createDataFrame([(at(0),), (at(60),)], "ts timestamp")
    ms = BASE * 1000
    assert rows(tumbling_counts(df, [], "ts", "1 minute"), "window_end", "count") == [(ms + 60_000, 1), (ms + 120_000, 1)]
    assert rows(sliding_counts(df, [], "ts", "1 minute", "30 seconds"), "window_end", "count") == [
        (ms + 30_000, 1), (ms + 60_000, 1), (ms + 90_000, 1), (ms + 120_000, 1),
    ]


def test_bad_windows(log):
    df, _ = log
    with pytest.raises(ValueError):
        sliding_counts(df, ["user"], "ts", "10 minutes", "5 seconds", block="5 minutes")


@pytest.mark.parametrize("size, slide", [("10 minutes", "4 minutes"), ("50 seconds", "7 seconds")])
def test_sizes_that_are_no_multiple_of_the_slide(log, size, slide):
    df, _ = log
    for keys in ([], ["user"]):
        want = naive_sliding_counts(df, keys, "ts", size, slide)
        got = sliding_counts(df, keys, "ts", size, slide)
        assert rows(got, *keys, "window_end", "count") == rows(want, *keys, "window_end", "count")


def test_sliding_sketches_keep_to_their_bound(spark):
    """More users than a sketch counts exactly: merged panes give the same estimate as one sketch, within the bound."""
    df = spark.range(60_000).select((F.col("id") * 7919 % 20_011).alias("user"), F.timestamp_seconds(F.col("id") + BASE).alias("ts"))
    panes = sketch_rollup(df, "user", "ts", "1 hour", 12)
    got = sliding_sketches(panes, "6 hours", "1 hour").select("window_end", F.hll_sketch_estimate("sketch").alias("estimate"))
    both = sliding_uniques(df, "user", "ts", "6 hours", "1 hour").join(got, "window_end").collect()
    assert len(both) == 17 + 5 and max(r["count"] for r in both) > 15_000
    assert any(r.estimate != r["count"] for r in both)
    assert all(abs(r.estimate - r["count"]) <= error_bound(12) * r["count"] for r in both)
    naive = df.groupBy(F.window("ts", "6 hours", "1 hour").alias("w")).agg(F.count_distinct("user").alias("n"))
    assert {(r.w.end.timestamp() * 1000, r.n) for r in naive.collect()} == {(r.window_end, r["count"]) for r in both}


def test_salted_count(log):
    df, _ = log
    salted = salted_tumbling_counts(df, "ts", "1 hour", ["id"])
    assert rows(salted, "window_end", "count") == rows(tumbling_counts(df, [], "ts", "1 hour"), "window_end", "count")


# --- ranking ---------------------------------------------------------------


def brute_top(counts, n):
    by = defaultdict(list)
    for user, end, count in counts:
        by[end].append((-count, user))
    return sorted((end, user, -neg, i + 1) for end, ids in by.items() for i, (neg, user) in enumerate(sorted(ids)[:n]))


def test_top_n_breaks_ties_by_id(log):
    df, _ = log
    counts = sliding_counts(df, ["user"], "ts", "10 minutes", "1 minute")
    want = brute_top(rows(counts, "user", "window_end", "count"), 5)
    assert rows(top_n(counts, "user", 5), "window_end", "user", "count", "row_num") == want


@pytest.mark.parametrize("chunk", [None, "1 minute", "5 minutes", "1 hour"])
def test_top_n_sliding(log, chunk):
    df, _ = log
    counts = naive_sliding_counts(df, ["user"], "ts", "10 minutes", "1 minute")
    got = top_n_sliding(df, "user", "ts", 3, "10 minutes", "1 minute", chunk)
    assert rows(got, "window_end", "user", "count", "row_num") == brute_top(rows(counts, "user", "window_end", "count"), 3)


def test_rank_beyond_the_group_limit(spark, log):
    df, ordered = log
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "10")
    try:
        got = rank_within(df, ["user"], [F.col("ts"), F.col("id")], 25, salts=4)
        want = sorted((u, i, n + 1) for u, seq in ordered.items() for n, (i, _, _) in enumerate(seq[:25]))
        assert rows(got, "user", "id", "row_num") == want
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")


def test_report(spark):
    ranked = spark.createDataFrame(
        [(BASE * 1000, "/b", 3, 2), (BASE * 1000, "/a", 9, 1)], "window_end bigint, url string, count bigint, row_num int"
    )
    assert ranking_report(ranked, "url", "count", PAGE_REPORT).first()["report"] == (
        "==========================================\n窗口结束时间：2024-01-01 00:00:00.0\n"
        "NO1:页面URL= /a页面访问量=9\nNO2:页面URL= /b页面访问量=3\n"
    )


# --- uniques ---------------------------------------------------------------


def test_uniques_agree(log):
    df, _ = log
    exact = rows(exact_uniques(df, "user", "ts", "1 hour"), "window_end", "count")
    assert exact == rows(bitmap_uniques(df, "user", "ts", "1 hour"), "window_end", "count")
    assert exact == rows(sketch_uniques(df, "user", "ts", "1 hour"), "window_end", "count")


def test_bitmaps_merge(log):
    df, _ = log
    parts = [bitmap_rollup(df.filter(F.col("id") % 2 == i), "user", "ts", "1 hour") for i in range(2)]
    got = count_bitmaps(merge_bitmaps(*parts))
    assert rows(got, "window_end", "count") == rows(exact_uniques(df, "user", "ts", "1 hour"), "window_end", "count")


def test_offsets(spark):
    ids = ["0", "7", "61", "99999", "100000", "123456789", "-5", str(2**63 - 1), str(-(2**63)), "", "ü1"]

    def plain(text):
        value = 0
        for ch in text:
            value = value * 61 + ord(ch)
        return value & (2**30 - 1)

    df = spark.createDataFrame([(t,) for t in ids], "t string").select("t", poly_offset("t").alias("o"))
    assert {r.t: r.o for r in df.collect()} == {t: plain(t) for t in ids}
    five = spark.range(100_000).select(poly_offset("id").alias("o"))
    assert five.distinct().count() == 100_000
    with pytest.raises(Exception, match="longer than"):
        spark.createDataFrame([("1" * 21,)], "t string").select(poly_offset("t")).collect()


# --- failures --------------------------------------------------------------


def brute_alerts(ordered, within, chained):
    out = []
    for user, seq in ordered.items():
        streak, saved = [], None
        for _, kind, s in seq:
            if kind != "fail":
                streak, saved = [], None
                continue
            if not chained and streak and s - streak[0] < within:
                out.append((user, at(streak[0]), at(s), len(streak)))
            if chained and saved is not None and s - saved <= within:
                out.append((user, at(saved), at(s), 0))
                saved = s
            saved = s if saved is None else saved
            streak.append(s)
    return sorted(out)


@pytest.mark.parametrize("split", [dict(block="10 seconds"), dict(block="1 day"), dict(hot_rows=100), dict(hot_rows=7), {}])
@pytest.mark.parametrize("within", [2, 600])
def test_failure_alerts(log, split, within):
    df, ordered = log
    naive = lambda r: (r[0], r[1].replace(tzinfo=timezone.utc), r[2].replace(tzinfo=timezone.utc))
    args = (df, ["user"], "ts", "id", F.col("kind") == "fail", f"{within} seconds")
    first = [(*naive(r), int(r[3].split()[-2])) for r in rows(anchored_alerts(*args, **split), "user", "first_fail_time", "last_fail_time", "msg")]
    assert sorted(first) == brute_alerts(ordered, within, chained=False)
    chain = [(*naive(r), 0) for r in rows(chained_alerts(*args, **split), "user", "first_fail_time", "last_fail_time")]
    assert sorted(chain) == brute_alerts(ordered, within, chained=True)


# --- sequences -------------------------------------------------------------


def brute_matches(seq, kinds, within, strict):
    out = []
    for n, (i, kind, s) in enumerate(seq):
        if kind != kinds[0]:
            continue
        ids, status, step = [i], "timeout", 1
        for j, k, t in seq[n + 1:]:
            if t - s >= within:
                break
            if k == kinds[step]:
                ids.append(j)
                step += 1
                if step == len(kinds):
                    status = "match"
                    break
            elif strict:
                status = "broken"
                break
        if status != "broken":
            out.append((ids, status))
    return out


@pytest.mark.parametrize("parts", [1, 60])
@pytest.mark.parametrize("contiguity", ["strict", "relaxed"])
def test_sequences(log, parts, contiguity):
    df, ordered = log
    kinds = ["fail", "ok", "fail"]
    steps = [(f"s{i}", F.col("kind") == k) for i, k in enumerate(kinds)]
    got = match_sequence(
        df, ["user"], "ts", "id", steps, "5 minutes", contiguity, emit_timeouts=True, columns=["id"], parts=parts
    )
    got = got.select("user", F.array_compact(F.array("s0.id", "s1.id", "s2.id")).alias("ids"), "status")
    want = sorted((u, ids, st) for u, seq in ordered.items() for ids, st in brute_matches(seq, kinds, 300, contiguity == "strict"))
    assert rows(got, "user", "ids", "status") == want
    assert sum(st == "match" for _, _, st in want) > 50


@pytest.mark.parametrize("parts", [1, 120])
def test_repeats_without_a_key(log, parts):
    df, ordered = log
    flat = sorted(((s, i, k) for seq in ordered.values() for i, k, s in seq))
    seq = [(i, k, s) for s, i, k in flat]
    got = match_sequence(
        df, [], "ts", "id", [("fails", F.col("kind") == "fail")], "10 seconds", times=3, columns=["id"], parts=parts
    )
    got = got.select("fails_1.id", F.col("fails_2.id").alias("b"), F.col("fails_3.id").alias("c"))
    want = sorted(tuple(ids) for ids, st in brute_matches(seq, ["fail"] * 3, 10, True) if st == "match")
    assert rows(got, "id", "b", "c") == want


@pytest.mark.parametrize("contiguity", ["strict", "relaxed"])
def test_four_steps_over_many_cuts(log, contiguity):
    """Chains that reach over several cuts, with and without a key."""
    df, ordered = log
    kinds = ["ok", "fail", "fail", "ok"]
    steps = [(f"s{i}", F.col("kind") == k) for i, k in enumerate(kinds)]
    flat = sorted(((s, i, k) for seq in ordered.values() for i, k, s in seq))
    for key, seqs in ((["user"], ordered.values()), ([], [[(i, k, s) for s, i, k in flat]])):
        got = match_sequence(df, key, "ts", "id", steps, "1 hour", contiguity, columns=["id"], parts=150)
        want = sorted(tuple(ids) for seq in seqs for ids, st in brute_matches(seq, kinds, 3600, contiguity == "strict") if st == "match")
        assert rows(got, "s0.id", "s1.id", "s2.id", "s3.id") == want


def test_a_hot_key_inside_the_limit_is_cut(spark):
    """Nine tenths of the rows are one key's, all inside ``within``: no cut holds over twice its share."""
    df = spark.range(20_000).select(
        "id", F.when(F.col("id") % 10 > 0, 0).otherwise(F.col("id")).alias("user"), F.timestamp_millis(F.col("id")).alias("ts"),
        F.when(F.col("id") % 3 > 0, "fail").otherwise("ok").alias("kind"),
    )
    steps = [("a", F.col("kind") == "fail"), ("b", F.col("kind") == "ok")]
    cuts = ordered_cuts(df, ["user", "ts", "id"], "test", 20)
    assert cuts.groupBy("_cut").count().agg(F.max("count")).first()[0] < 2 * 20_000 / 20
    for contiguity in ("strict", "relaxed"):
        one = match_sequence(df, ["user"], "ts", "id", steps, "1 hour", contiguity, columns=["id"], parts=1)
        many = match_sequence(df, ["user"], "ts", "id", steps, "1 hour", contiguity, columns=["id"], parts=20)
        assert rows(one, "user", "a.id", "b.id") == rows(many, "user", "a.id", "b.id")
        assert many.count() > 5000


def test_sequence_limit_is_strict(spark):
    df = spark.createDataFrame(
        [(1, "create", at(0), 0), (1, "pay", at(900), 1), (2, "create", at(0), 2), (2, "pay", at(899), 3)],
        "order bigint, kind string, ts timestamp, n int",
    )
    steps = [("create", F.col("kind") == "create"), ("pay", F.col("kind") == "pay")]
    got = match_sequence(df, ["order"], "ts", "n", steps, "15 minutes", "relaxed", emit_timeouts=True)
    assert rows(got, "order", "status") == [(1, "timeout"), (2, "match")]


# --- caps ------------------------------------------------------------------


@pytest.mark.parametrize("reset, offset", [("event_day", "8 hours"), ("event_day", "-30 minutes"), ("never", "8 hours")])
def test_click_cap(log, reset, offset):
    df, ordered = log
    shift = {"8 hours": 28800, "-30 minutes": -1800}[offset]
    tagged = click_cap(df, ["user", "kind"], "ts", "id", 5, reset, offset)
    seen, want = Counter(), []
    for user, seq in ordered.items():
        for i, kind, s in seq:
            day = (BASE + s + shift) // 86400 if reset == "event_day" else 0
            seen[user, kind, day] += 1
            n = seen[user, kind, day]
            if n <= 6:
                want.append((i, "pass" if n <= 5 else "blacklist"))
    assert rows(tagged, "id", "tag") == sorted(want)
    assert passed(tagged).count() == sum(tag == "pass" for _, tag in want)
    assert {r.msg for r in blacklist(tagged, ["user", "kind"], 5).collect()} == {"click over 5 times today"}


# --- orders ----------------------------------------------------------------


def test_order_status(spark):
    events = [
        (1, "create", 0), (1, "pay", 900),  # at the limit
        (2, "create", 0), (2, "pay", 901),
        (3, "create", 0),
        (4, "pay", 0),
        (5, "pay", 0), (5, "create", 10), (7, "pay", 4), (7, "create", 4),
        (6, "create", 0), (6, "pay", 5), (6, "pay", 2000), (6, "other", 1),
        # repeats: paid, re-armed and paid, a lone pay, timed out before the next, timed out at the end
        (8, "create", 0), (8, "pay", 5), (8, "create", 10), (8, "create", 20), (8, "pay", 915), (8, "pay", 916),
        (8, "create", 2000), (8, "create", 3000),
    ]
    df = spark.createDataFrame([(o, k, at(s), n) for n, (o, k, s) in enumerate(events)], "id bigint, kind string, ts timestamp, n int")
    for hot_rows in (100, 2):
        got = order_status(df, "id", "ts", "n", F.col("kind") == "create", F.col("kind") == "pay", hot_rows=hot_rows)
        assert rows(got, "id", "status") == [
            (1, "payed"), (2, "payed but already timeout"), (3, "timeout"), (4, "payed but not created"),
            (5, "payed but not created"), (5, "timeout"), (6, "payed"), (6, "payed but not created"), (7, "payed"),
            (8, "payed"), (8, "payed"), (8, "payed but not created"), (8, "timeout"), (8, "timeout"),
        ]


# --- two tables ------------------------------------------------------------


def test_interval_bounds_are_inclusive(spark):
    pays = spark.createDataFrame([("a", at(100)), ("b", at(100)), ("c", at(100)), ("d", at(100)), (None, at(100))], "tx string, ts timestamp")
    receipts = spark.createDataFrame([("a", at(97)), ("b", at(105)), ("c", at(96)), ("d", at(106)), (None, at(100))], "tx string, ts timestamp")
    got = interval_join(pays, receipts, ("tx", "tx"), ("ts", "ts"))
    assert rows(got, "pay.tx") == [("a",), ("b",)]
    tags = reconcile(pays, receipts, ("tx", "tx"), ("ts", "ts")).groupBy("tag").count()
    assert dict(rows(tags, "tag", "count")) == {"matched": 2, "unmatched-pays": 3, "unmatched-receipts": 3}


@pytest.mark.parametrize("lower, upper", [("-3 seconds", "5 seconds"), ("-2 minutes", "-1 minute"), ("0 seconds", "0 seconds")])
def test_reconcile(log, lower, upper):
    df, ordered = log
    left = df.filter("kind = 'fail'").select("id", "user", "ts")
    right = df.filter("kind = 'ok'").select("id", "user", "ts")
    lo, hi = (duration_us(v.lstrip("-")) / 1e6 * (-1 if v[0] == "-" else 1) for v in (lower, upper))
    pairs, lefts, rights = [], set(), set()
    for seq in ordered.values():
        lefts |= {i for i, k, _ in seq if k == "fail"}
        rights |= {i for i, k, _ in seq if k == "ok"}
        pairs += [(i, j) for i, k, s in seq if k == "fail" for j, m, t in seq if m == "ok" and lo <= t - s <= hi]
    got = reconcile(left, right, ("user", "user"), ("ts", "ts"), lower, upper)
    out = [tuple(r) for r in got.select("pay.id", F.col("receipt.id").alias("r"), "tag").collect()]
    assert sorted((a, b) for a, b, tag in out if tag == "matched") == sorted(pairs)
    assert sorted(a for a, _, tag in out if tag == "unmatched-pays") == sorted(lefts - {a for a, _ in pairs})
    assert sorted(b for _, b, tag in out if tag == "unmatched-receipts") == sorted(rights - {b for _, b in pairs})
    assert len(pairs) > 0


# --- late rows -------------------------------------------------------------


@pytest.mark.parametrize("spread", ["even", "outlier", "burst"])
def test_late_rows(spark, spread):
    rnd = random.Random(3)
    data = [(i, 2 * i - rnd.choice([0, 0, 0, rnd.randrange(400)])) for i in range(2000)]
    df = spark.createDataFrame([(i, at(s)) for i, s in data], "id bigint, ts timestamp").repartition(5)
    # the arrival order is that of the ids, however arrivals are spread over time
    arrival = {"even": "id", "outlier": "if(id = 1999, 1000000000000, id)", "burst": "id div 1500"}[spread]
    got = split_late(df, "ts", F.expr(arrival), "id", "1 second", "60 seconds", "10 seconds", "30 seconds", parts=20)
    want, counts, seen = [], Counter(), None
    for i, s in data:
        wm = None if seen is None else seen - 1000
        ends = [e * 1000 for e in range(s // 10 * 10 + 10, s // 10 * 10 + 70, 10)]
        live = [e for e in ends if wm is None or e - 1 + 30_000 > wm]
        want.append((i, "late" if not live else "refire" if wm is not None and live[0] - 1 <= wm else "on_time"))
        counts.update(live)
        seen = s * 1000 if seen is None else max(seen, s * 1000)
    assert rows(got, "id", "tag") == want
    assert len({tag for _, tag in want}) == 3
    kept = got.filter("tag <> 'late'")
    totals = sliding_counts(kept, [], "ts", "60 seconds", "10 seconds", live_from=F.col("live_from_us"))
    assert rows(totals, "window_end", "count") == sorted((BASE * 1000 + e, n) for e, n in counts.items())


# --- functions -------------------------------------------------------------


def test_durations_and_bounds(spark):
    assert duration_us("1 hour 30 minutes") == 5_400_000_000
    assert duration_us(timedelta(seconds=5)) == 5_000_000
    with pytest.raises(ValueError):
        duration_us("")
    df = spark.createDataFrame([(BASE * 1000,), (BASE * 1000 + 500,)], "ms bigint").select(bound_text("ms").alias("t"))
    assert rows(df, "t") == [("2024-01-01 00:00:00.0",), ("2024-01-01 00:00:00.5",)]


def test_bound_text_keeps_milliseconds(spark):
    ends = [(BASE * 1000 + ms,) for ms in (0, 1, 120, 250, 1250)]
    got = [r.t[-4:].lstrip("0:") for r in spark.createDataFrame(ends, "ms bigint").select(bound_text("ms").alias("t")).collect()]
    assert [g[g.index("."):] for g in got] == [".0", ".001"[-4:], ".12", ".25", ".25"]


def test_summaries_cut_runs_at_midnight(spark):
    from footfall.operators import summarize_runs

    df = spark.createDataFrame([("k", at(86_400 * 3 + 30))], "key string, ts timestamp")
    runs = sliding_count_runs(df, ["key"], "ts", "2 days", "1 hour")
    want = sliding_counts(df, ["key"], "ts", "2 days", "1 hour").groupBy("key", F.expr("window_end div 86400000").alias("day"))
    want = want.agg(F.count("*").alias("windows"), F.sum("count").alias("total"), F.max("count").alias("peak"))
    got = summarize_runs(runs, ["key"], "1 hour")
    cols = ["day", "windows", "total", "peak"]
    assert rows(got, *cols) == rows(want, *cols) and got.count() == 3


def test_an_outlier_does_not_undo_the_cut_of_a_hot_key(spark):
    from footfall.operators.blocks import split_hot_keys

    times = F.when(F.col("id") == 7, 0).otherwise(BASE * 1_000_000 + F.col("id") * 1000)
    rows_ = spark.range(20_000).select(F.lit(1).alias("k"), times.cast("bigint").alias("us"))
    rows_ = rows_.unionByName(spark.range(5).select(F.lit(2).alias("k"), F.col("id").alias("us")))
    sizes = {(r.k, r._block): r["count"] for r in split_hot_keys(rows_, ["k"], "us", 1000).groupBy("k", "_block").count().collect()}
    assert sum(sizes.values()) == 20_005 and sizes[2, 0] == 5
    assert max(sizes.values()) <= 2000 and len(sizes) >= 19
    same = spark.range(3000).select(F.lit(1).alias("k"), F.when(F.col("id") < 2000, 5).otherwise(F.col("id")).alias("us"))
    counts = split_hot_keys(same, ["k"], "us", 500).groupBy("_block").count().collect()
    assert sum(r["count"] for r in counts) == 3000 and max(r["count"] for r in counts) <= 2500
