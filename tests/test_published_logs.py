"""Known results on small logs of the four layouts, with the cases that the published ones hold.

121 clicks of one pair, a streak of three failures, an order paid too late, one never paid and a
pay without an order, and receipts of which few lie near their payment.
"""

import pytest
from pyspark.sql import functions as F

from footfall import sources
from footfall.operators import blacklist, click_cap, passed
from footfall.plans import logins, payments

T = 1_558_430_800


def ad_clicks():
    lines = [f"{user},{ad},{place},{place},{T + n}" for n, (user, ad, place) in enumerate([(1, 10, "beijing"), (2, 10, "hebei"), (1, 11, "hebei")])]
    lines += [f"937166,1715,beijing,beijing,{T + 10 + n}" for n in range(121)]
    # out of order by seconds, as the last lines of a log may be
    return [*lines, f"3,10,jiangsu,nanjing,{T + 5}", f"4,10,jiangsu,nanjing,{T + 4}"]


def login_lines():
    fails = [f"1035,83.149.9.216,fail,{T + s}" for s in (42, 43, 44)]
    return [f"5402,83.149.11.115,success,{T + 15}", *fails, f"1035,83.149.9.216,success,{T + 45}", f"7,10.0.0.1,fail,{T + 46}", f"7,10.0.0.1,success,{T + 47}", f"7,10.0.0.1,fail,{T + 48}"]


def order_lines():
    lines = []
    for order in range(34729, 34756):
        lines += [f"{order},create,,{T + order - 34729}", f"{order},pay,tx{order},{T + order - 34729 + 13}"]
    lines += [f"34756,create,,{T + 40}", f"34756,pay,tx34756,{T + 40 + 1038}", f"34767,create,,{T + 50}", f"34768,pay,tx34768,{T + 55}"]
    return [lines[1], lines[0], *lines[2:]]


def receipt_lines():
    """One for each pay but the last, at most 3 s before or 5 s behind it for four of them, and one of an unknown payment."""
    near = {34729: -3, 34730: 5, 34731: 0, 34732: 1, 34733: -4, 34734: 6}
    lines = [f"tx{o},wechat,{T + o - 34729 + 13 + near.get(o, 100)}" for o in range(34729, 34756)]
    return [*lines, f"other,alipay,{T}"]


READERS = {
    "ad_clicks": (sources.read_ad_clicks, ad_clicks), "logins": (sources.read_logins, login_lines),
    "orders": (sources.read_orders, order_lines), "receipts": (sources.read_receipts, receipt_lines),
}


@pytest.fixture
def read(spark, tmp_path):
    def log(name):
        reader, lines = READERS[name]
        path = tmp_path / f"{name}.csv"
        path.write_text("\n".join(lines()) + "\n", encoding="utf-8")
        return reader(spark, str(path)).withColumn("line", F.monotonically_increasing_id() + 1)

    return log


def counts(df, column):
    return {r[0]: r[1] for r in df.groupBy(column).count().collect()}


def test_click_cap(read):
    tagged = click_cap(read("ad_clicks"), ["user_id", "ad_id"], "event_time", "line", 100).persist()
    assert [(r.user_id, r.ad_id) for r in blacklist(tagged, ["user_id", "ad_id"]).collect()] == [(937166, 1715)]
    assert tagged.filter("tag = 'blacklist'").first().line == 104
    assert counts(passed(tagged), "province") == {"beijing": 101, "hebei": 2, "jiangsu": 2}


@pytest.mark.parametrize(
    "alerts, seconds",
    [
        (logins.alerts_from_first_failure, [(42, 43)]),
        (logins.alerts_from_last_match, [(42, 43), (43, 44)]),
        (logins.consecutive_failures, [(42, 43), (43, 44)]),
        (logins.repeated_failures, [(42, 43), (43, 44)]),
    ],
)
def test_login_alerts(read, alerts, seconds):
    rows = alerts(read("logins"), "line").select(
        "user_id", F.unix_seconds("first_fail_time") - T, F.unix_seconds("last_fail_time") - T
    )
    assert sorted(tuple(r) for r in rows.collect()) == [(1035, a, b) for a, b in seconds]


def test_orders(read):
    orders = read("orders")
    assert counts(payments.payment_sequence(orders, "line"), "status") == {"payed": 27, "timeout": 2}
    status = payments.payment_status(orders)
    assert counts(status, "status")["payed"] == 27
    assert {r.order_id: r.status for r in status.filter("status <> 'payed'").collect()} == {
        34756: "payed but already timeout", 34767: "timeout", 34768: "payed but not created",
    }


def test_receipts(read):
    orders, receipts = read("orders"), read("receipts")
    matched = payments.matched_receipts(orders, receipts).select("pay.tx_id")
    assert {r.tx_id for r in matched.collect()} == {"tx34729", "tx34730", "tx34731", "tx34732"}
    assert counts(payments.reconciled_receipts(orders, receipts), "tag") == {
        "matched": 4, "unmatched-pays": 25, "unmatched-receipts": 24,
    }
