"""Alerts on consecutive failed logins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.operators import anchored_alerts, chained_alerts, match_sequence


def _failed():
    return F.col("event_type") == "fail"


def alerts_from_first_failure(logins: DataFrame, tie: str, within: str = "2 seconds") -> DataFrame:
    return anchored_alerts(logins, ["user_id"], "event_time", tie, _failed(), within)


def alerts_from_last_match(logins: DataFrame, tie: str, within: str = "2 seconds") -> DataFrame:
    return chained_alerts(logins, ["user_id"], "event_time", tie, _failed(), within)


def _pair_warnings(matches: DataFrame, first: str, last: str) -> DataFrame:
    return matches.select(
        F.col(f"{first}.user_id").alias("user_id"),
        F.col(f"{first}.event_time").alias("first_fail_time"),
        F.col(f"{last}.event_time").alias("last_fail_time"),
        F.lit("login-fail").alias("msg"),
    )


def consecutive_failures(logins: DataFrame, tie: str, within: str = "2 seconds") -> DataFrame:
    """Two failures of a user with nothing between them."""
    matches = match_sequence(
        logins, ["user_id"], "event_time", tie, [("first", _failed()), ("second", _failed())], within,
        columns=["user_id", "event_time"],
    )
    return _pair_warnings(matches, "first", "second")


def repeated_failures(logins: DataFrame, tie: str, times: int = 2, within: str = "10 seconds") -> DataFrame:
    """``times`` adjacent failures in the whole log, whoever the users are."""
    matches = match_sequence(
        logins, [], "event_time", tie, [("fails", _failed())], within, times=times,
        columns=["user_id", "event_time"],
    )
    return _pair_warnings(matches, "fails_1", "fails_2")
