from footfall.sources.files import (
    read_access_log,
    read_ad_clicks,
    read_logins,
    read_orders,
    read_receipts,
    read_user_behavior,
)
from footfall.sources.kafka import decode_csv, kafka_source, kafka_sink, to_kafka_value
from footfall.sources.schemas import AD_CLICK, LOGIN, MARKETING, ORDER, RECEIPT, USER_BEHAVIOR

__all__ = [
    "AD_CLICK",
    "LOGIN",
    "MARKETING",
    "ORDER",
    "RECEIPT",
    "USER_BEHAVIOR",
    "decode_csv",
    "kafka_sink",
    "kafka_source",
    "read_access_log",
    "read_ad_clicks",
    "read_logins",
    "read_orders",
    "read_receipts",
    "read_user_behavior",
    "to_kafka_value",
]
