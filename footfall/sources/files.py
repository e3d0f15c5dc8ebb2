"""File scans.  Each reader serves batch and streaming with the same schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from footfall.sources import schemas


def _csv(spark: SparkSession, path: str, schema: StructType, streaming: bool) -> DataFrame:
    reader = spark.readStream if streaming else spark.read
    # a malformed row fails the job, as a wrong number would in a typed parser
    return reader.schema(schema).option("mode", "FAILFAST").csv(path)


def with_event_time(df: DataFrame, unit: str = "second") -> DataFrame:
    """Adds ``event_time TIMESTAMP`` from the epoch number in ``ts``."""
    convert = {"second": F.timestamp_seconds, "millisecond": F.timestamp_millis}[unit]
    return df.withColumn("event_time", convert("ts"))


def read_user_behavior(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    return with_event_time(_csv(spark, path, schemas.USER_BEHAVIOR, streaming))


def read_marketing(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    return with_event_time(_csv(spark, path, schemas.MARKETING, streaming), "millisecond")


def read_ad_clicks(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    return with_event_time(_csv(spark, path, schemas.AD_CLICK, streaming))


def read_logins(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    return with_event_time(_csv(spark, path, schemas.LOGIN, streaming))


def read_orders(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    # the CSV reader turns an empty field into NULL; the record keeps it as text
    orders = _csv(spark, path, schemas.ORDER, streaming)
    return with_event_time(orders.withColumn("tx_id", F.coalesce("tx_id", F.lit(""))))


def read_receipts(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    return with_event_time(_csv(spark, path, schemas.RECEIPT, streaming))


#: Positions in a space-separated access-log line and its time pattern.
LOG_FIELDS = {"ip": 0, "user_id": 1, "time": 3, "method": 5, "url": 6}
LOG_TIME = "dd/MM/yyyy:HH:mm:ss"


def parse_access_log(lines: DataFrame, column: str = "value") -> DataFrame:
    """Typed log events from text lines; the zone field is not used."""
    parts = F.split(F.col(column), " ")
    fields = {name: parts.getItem(i) for name, i in LOG_FIELDS.items()}
    return lines.select(
        fields["ip"].alias("ip"),
        fields["user_id"].alias("user_id"),
        F.to_timestamp(fields["time"], LOG_TIME).alias("event_time"),
        fields["method"].alias("method"),
        fields["url"].alias("url"),
    )


def read_access_log(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    reader = spark.readStream if streaming else spark.read
    return parse_access_log(reader.text(path))
