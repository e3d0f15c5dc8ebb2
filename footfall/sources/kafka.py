"""Kafka topics of CSV lines.

``spark-sql-kafka`` must be on the class path for the two connector functions;
encoding and decoding work on any frame with a ``value`` column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StructType


def kafka_source(
    spark: SparkSession, servers: str, topic: str, group_id: str | None = None, streaming: bool = True
) -> DataFrame:
    reader = (spark.readStream if streaming else spark.read).format("kafka")
    reader = reader.option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    if group_id:
        reader = reader.option("kafka.group.id", group_id)
    return reader.load()


def decode_csv(messages: DataFrame, schema: StructType) -> DataFrame:
    """One row per message, from the CSV text in the binary ``value``."""
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
    record = F.from_csv(F.col("value").cast("string"), ddl, {"mode": "FAILFAST"})
    return messages.select(record.alias("record")).select("record.*")


def to_kafka_value(rows: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows as CSV lines in ``value``, the frame a Kafka sink expects; no message key."""
    picked = [F.col(c) for c in columns or rows.columns]
    return rows.select(F.to_csv(F.struct(*picked)).cast("binary").alias("value"))


def kafka_sink(rows: DataFrame, servers: str, topic: str, checkpoint: str | None = None) -> DataStreamWriter | None:
    """Writes a batch frame at once; for a stream returns the writer to start."""
    values = to_kafka_value(rows) if rows.columns != ["value"] else rows
    if rows.isStreaming:
        return (
            values.writeStream.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("topic", topic)
            .option("checkpointLocation", checkpoint)
        )
    values.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()
    return None
