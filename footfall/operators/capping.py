"""Cap on the rows of a key per day, with one warning past the cap."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.functions.times import local_day, micros
from footfall.operators.blocks import batch_only
from footfall.operators.topn import rank_within

PASS, BLACKLIST = "pass", "blacklist"
#: Fixed value: the warning's text.
WARNING = "click over {} times today"


def click_cap(
    df: DataFrame,
    key: Sequence[str],
    ts: str,
    tie: str,
    cap: int = 100,
    reset: str = "event_day",
    day_offset: str = "8 hours",
) -> DataFrame:
    """The first ``cap`` rows of each key and day as ``tag = 'pass'`` and the next
    one, if any, as ``tag = 'blacklist'``.

    ``reset='never'`` counts over all days.  A key under attack holds many rows;
    the rank limit applies before the shuffle, so it ships ``cap + 1`` per task.
    """
    batch_only(df, "streaming.processors.ClickCap")
    if reset not in ("event_day", "never"):
        raise ValueError(f"unknown reset: {reset}")
    day = local_day(micros(ts), day_offset) if reset == "event_day" else F.lit(0).cast("bigint")
    first = rank_within(
        df.withColumn("_day", day), [*key, "_day"], [F.col(ts).asc(), F.col(tie).asc()], cap + 1, rank="_n"
    )
    tag = F.when(F.col("_n") <= cap, PASS).otherwise(BLACKLIST)
    return first.withColumn("tag", tag).drop("_day", "_n")


def passed(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.col("tag") == PASS).drop("tag")


def blacklist(tagged: DataFrame, key: Sequence[str], cap: int = 100) -> DataFrame:
    return tagged.filter(F.col("tag") == BLACKLIST).select(*key, F.lit(WARNING.format(cap)).alias("msg"))
