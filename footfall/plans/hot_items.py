"""Most viewed items per sliding window, by DataFrame and by SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.operators import sliding_counts, top_n


def item_counts(
    behavior: DataFrame, size: str = "1 hour", slide: str = "5 minutes", kind: str = "pv", ts: str = "event_time"
) -> DataFrame:
    """Views per (item, window end)."""
    views = behavior.filter(F.col("behavior") == kind).select("item_id", ts)
    return sliding_counts(views, ["item_id"], ts, size, slide)


def hot_items(behavior: DataFrame, n: int = 5, **window: str) -> DataFrame:
    return top_n(item_counts(behavior, **window), "item_id", n)


def hot_items_sql(
    spark: SparkSession, view: str, n: int = 5, size: str = "1 hour", slide: str = "5 minutes", kind: str = "pv"
) -> DataFrame:
    """The same by SQL over a registered view with ``item_id``, ``behavior`` and ``event_time``."""
    return spark.sql(
        f"""
        SELECT window_end, item_id, cnt, row_num
        FROM (
          SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, item_id) AS row_num
          FROM (
            SELECT item_id, unix_millis(window.end) AS window_end, count(item_id) AS cnt
            FROM {view}
            WHERE behavior = :kind
            GROUP BY item_id, window(event_time, '{size}', '{slide}')
          )
        )
        WHERE row_num <= {int(n)}
        """,
        args={"kind": kind},
    )
