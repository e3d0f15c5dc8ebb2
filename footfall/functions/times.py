"""Event-time helpers.

Operators compute on epoch microseconds (BIGINT) so that microsecond inputs keep
their order, and report window bounds in epoch milliseconds.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

_UNITS = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
}


def duration_us(value: str | timedelta) -> int:
    """``'5 minutes'`` or a timedelta in microseconds."""
    if isinstance(value, timedelta):
        return round(value / timedelta(microseconds=1))
    words = value.split()
    if len(words) % 2 or not words:
        raise ValueError(f"not a duration: {value!r}")
    return sum(int(n) * _UNITS[unit.lower().removesuffix("s")] for n, unit in zip(words[::2], words[1::2]))


def as_col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def micros(ts: str | Column) -> Column:
    """Epoch microseconds of a TIMESTAMP or (read as UTC) TIMESTAMP_NTZ column."""
    return F.unix_micros(as_col(ts).cast("timestamp"))


def event_time(df: DataFrame, ts: str) -> Column:
    """``ts`` as TIMESTAMP; left as it is where it is one, so that its watermark stays on it."""
    return F.col(ts) if isinstance(df.schema[ts].dataType, TimestampType) else F.col(ts).cast("timestamp")


def micros_to_ts(us: str | Column) -> Column:
    return F.timestamp_micros(as_col(us))


def floor_to(us: Column, step: int) -> Column:
    """The start of the epoch-aligned step that holds ``us``; right before 1970 too."""
    return us - F.pmod(us, F.lit(step))


def step_number(us: Column, step: int) -> Column:
    """The index of the epoch-aligned step that holds ``us``, in exact integer arithmetic."""
    return F.call_function("div", floor_to(us, step), F.lit(step))


def bound_text(end_ms: str | Column) -> Column:
    """A window bound as text with one fractional digit, or as many as its milliseconds need, in the session zone."""
    text = F.date_format(F.timestamp_millis(as_col(end_ms)), "yyyy-MM-dd HH:mm:ss.SSS")
    return F.regexp_replace(text, r"(\.\d\d*?)0+$", "$1")


def local_day(us: Column, offset: str) -> Column:
    """The calendar day number of an event in a fixed-offset zone."""
    sign = -1 if offset.startswith("-") else 1
    shifted = us + F.lit(sign * duration_us(offset.lstrip("+-")))
    return step_number(shifted, _UNITS["day"])
