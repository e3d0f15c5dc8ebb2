"""Readers, topic format and the analyses on typed logs."""

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from footfall import sources
from footfall.plans import logins, marketing, payments, traffic
from footfall.sources.files import parse_access_log, read_marketing
from footfall.sources.schemas import ORDER, USER_BEHAVIOR
from footfall.streaming.sinks import run_available

T = 1_600_000_000


def write(tmp_path, name, lines):
    folder = tmp_path / name
    folder.mkdir()
    (folder / "part.csv").write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(folder)


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def test_user_behavior(spark, tmp_path):
    path = write(tmp_path, "ub", [f"1,10,100,pv,{T}", f"2,11,101,buy,{T + 1}"])
    df = sources.read_user_behavior(spark, path)
    assert df.drop("event_time").schema == USER_BEHAVIOR
    assert rows(df, "user_id", "item_id", "category_id", "behavior", "ts") == [(1, 10, 100, "pv", T), (2, 11, 101, "buy", T + 1)]
    assert df.first().event_time == datetime.fromtimestamp(T, timezone.utc).replace(tzinfo=None)


def test_malformed_row_fails(spark, tmp_path):
    path = write(tmp_path, "bad", ["1,x,100,pv,5"])
    with pytest.raises(Exception, match="MALFORMED|malformed|parse"):
        sources.read_user_behavior(spark, path).collect()


def test_streaming_scan(spark, tmp_path):
    path = write(tmp_path, "ub", [f"1,10,100,pv,{T}", f"2,11,101,buy,{T + 1}"])
    out = str(tmp_path / "out")
    run_available(sources.read_user_behavior(spark, path, streaming=True), str(tmp_path / "cp"), out)
    assert rows(spark.read.parquet(out), "user_id", "behavior") == [(1, "pv"), (2, "buy")]


def test_empty_transaction_stays_text(spark, tmp_path):
    path = write(tmp_path, "orders", [f"1,create,,{T}", f"1,pay,tx1,{T + 5}"])
    df = sources.read_orders(spark, path)
    assert rows(df, "event_type", "tx_id") == [("create", ""), ("pay", "tx1")]
    assert rows(payments.payments(df), "tx_id") == [("tx1",)]


def test_topic_round_trip(spark, tmp_path):
    path = write(tmp_path, "orders", [f"1,create,,{T}", f"1,pay,tx1,{T + 5}"])
    df = sources.read_orders(spark, path).drop("event_time")
    topic = sources.to_kafka_value(df)
    assert topic.dtypes == [("value", "binary")]
    back = sources.decode_csv(topic, ORDER)
    assert rows(back.fillna({"tx_id": ""}), *df.columns) == rows(df, *df.columns)


LOG = [
    "83.149.9.216 - - 17/05/2015:10:05:03 +0000 GET /index.html",
    "83.149.9.216 - - 17/05/2015:10:05:43 +0000 GET /style.css",
    "83.149.9.217 7 - 17/05/2015:10:05:47 +0000 POST /index.html",
    "83.149.9.217 7 - 17/05/2015:10:05:50 +0000 GET /index.html",
]


def test_access_log(spark, tmp_path):
    df = sources.read_access_log(spark, write(tmp_path, "log", LOG))
    assert rows(df, "ip", "user_id", F.date_format("event_time", "HH:mm:ss"), "method", "url")[0] == (
        "83.149.9.216", "-", "10:05:03", "GET", "/index.html",
    )
    assert traffic.page_requests(df).count() == 3
    assert traffic.page_requests(df, skip_assets=True).count() == 2
    top = traffic.hot_pages(df, n=1).agg(F.max("count")).first()[0]
    assert top == 2


def test_log_time_is_required(spark):
    lines = spark.createDataFrame([("a b c not-a-time e GET /",)], "value string")
    with pytest.raises(Exception, match="CANNOT_PARSE|cannot be parsed|could not be parsed"):
        parse_access_log(lines).collect()


def test_channels_keep_uninstalls(spark, tmp_path):
    path = write(tmp_path, "m", [f"u1,wechat,{b},{T * 1000}" for b in ("unstall", "uninstall", "click", "click")])
    counts = marketing.channel_counts(read_marketing(spark, path))
    assert counts.count() == 2 * 720
    assert dict(rows(counts.select("behavior", "count").distinct(), "behavior", "count")) == {"uninstall": 1, "click": 2}
    first = counts.orderBy("window_end").first()
    assert (first.window_start, first.window_end) == ("2020-09-13 11:26:45.0", "2020-09-13 12:26:45.0")


@pytest.fixture
def logs(spark, tmp_path):
    """Small logs with the cases that matter: a click storm, adjacent failures, late and lone payments."""
    clicks = [f"1,7,north,a,{T + i}" for i in range(121)] + [f"{u},7,south,b,{T + u}" for u in range(2, 12)]
    tries = [(1, "fail", 0), (1, "fail", 1), (1, "fail", 2), (2, "fail", 3), (3, "success", 4), (2, "fail", 9), (2, "success", 10)]
    orders = [
        f"1,create,,{T}", f"1,pay,t1,{T + 10}", f"2,create,,{T}", f"2,pay,t2,{T + 1000}", f"3,create,,{T}", f"4,pay,t4,{T + 3}",
    ]
    receipts = [f"t1,wechat,{T + 15}", f"t2,alipay,{T + 996}", f"t9,alipay,{T}"]
    return dict(
        clicks=sources.read_ad_clicks(spark, write(tmp_path, "c", clicks)).withColumn("line", F.monotonically_increasing_id()),
        tries=sources.read_logins(spark, write(tmp_path, "l", [f"{u},10.0.0.1,{k},{T + s}" for u, k, s in tries])).withColumn("line", F.col("ts")),
        orders=sources.read_orders(spark, write(tmp_path, "o", orders)).withColumn("line", F.col("ts")),
        receipts=sources.read_receipts(spark, write(tmp_path, "r", receipts)),
    )


def test_province_counts(logs):
    counts = marketing.province_counts(logs["clicks"], "line")
    assert counts.agg(F.sum("count")).first()[0] == (100 + 10) * 720
    assert dict(rows(counts.groupBy("province").agg(F.max("count").alias("n")), "province", "n")) == {"north": 100, "south": 10}


def test_login_alerts(logs):
    users = lambda df: [r[0] for r in rows(df, "user_id")]
    assert users(logins.alerts_from_first_failure(logs["tries"], "line")) == [1]
    assert users(logins.alerts_from_last_match(logs["tries"], "line")) == [1, 1]
    assert users(logins.consecutive_failures(logs["tries"], "line")) == [1, 1]
    # over all users the failure of user 2 follows those of user 1
    assert users(logins.repeated_failures(logs["tries"], "line")) == [1, 1, 1]


def test_payments(logs):
    assert rows(payments.payment_sequence(logs["orders"], "line"), "order_id", "status") == [(1, "payed"), (2, "timeout"), (3, "timeout")]
    assert rows(payments.payment_status(logs["orders"]), "order_id", "status") == [
        (1, "payed"), (2, "payed but already timeout"), (3, "timeout"), (4, "payed but not created"),
    ]


def test_receipts(logs):
    matched = payments.matched_receipts(logs["orders"], logs["receipts"])
    assert rows(matched, "pay.tx_id", "receipt.pay_channel") == [("t1", "wechat")]
    tags = payments.reconciled_receipts(logs["orders"], logs["receipts"]).groupBy("tag").count()
    assert dict(rows(tags, "tag", "count")) == {"matched": 1, "unmatched-pays": 2, "unmatched-receipts": 2}
