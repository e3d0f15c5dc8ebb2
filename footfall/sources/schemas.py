"""Record layouts.  Fields are positional; time fields are epoch numbers."""

from __future__ import annotations

from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType


def _record(*fields: tuple[str, type]) -> StructType:
    return StructType([StructField(name, kind()) for name, kind in fields])


#: ``ts`` in seconds
USER_BEHAVIOR = _record(
    ("user_id", LongType),
    ("item_id", LongType),
    ("category_id", IntegerType),
    ("behavior", StringType),
    ("ts", LongType),
)
#: ``ts`` in milliseconds
MARKETING = _record(("user_id", StringType), ("channel", StringType), ("behavior", StringType), ("ts", LongType))
#: ``ts`` in seconds
AD_CLICK = _record(
    ("user_id", LongType),
    ("ad_id", LongType),
    ("province", StringType),
    ("city", StringType),
    ("ts", LongType),
)
#: ``ts`` in seconds
LOGIN = _record(("user_id", LongType), ("ip", StringType), ("event_type", StringType), ("ts", LongType))
#: ``ts`` in seconds; ``tx_id`` is empty for ``create``
ORDER = _record(("order_id", LongType), ("event_type", StringType), ("tx_id", StringType), ("ts", LongType))
#: ``ts`` in seconds
RECEIPT = _record(("tx_id", StringType), ("pay_channel", StringType), ("ts", LongType))
