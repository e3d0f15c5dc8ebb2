"""Streaming sinks.

Every ``foreachBatch`` writer stores a batch under its batch id and overwrites it
on a retry, so a batch that runs twice is stored once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from footfall.operators.topn import top_n

Writer = Callable[[DataFrame, int], None]


def run_available(
    stream: DataFrame, checkpoint: str, path: str | None = None, mode: str = "append", writer: Writer | None = None
) -> None:
    """Processes what the sources hold now and stops; rows go to parquet or to ``writer``."""
    out = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    query = out.foreachBatch(writer).start() if writer else out.format("parquet").option("path", path).start()
    query.awaitTermination()


def print_stream(stream: DataFrame, label: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Starts a labelled console query."""
    return (
        stream.writeStream.format("console")
        .queryName(label)
        .outputMode(mode)
        .option("truncate", "false")
        .option("checkpointLocation", checkpoint)
        .start()
    )


def _store(rows: DataFrame, path: str, batch_id: int) -> None:
    rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def append_writer(path: str) -> Writer:
    return lambda batch, batch_id: _store(batch, path, batch_id)


def upsert_writer(path: str) -> Writer:
    """Keyed upsert as a log of batches; ``read_latest`` gives the current table.

    A batch writes its own rows only, never the table, so its cost does not grow
    with what is stored.
    """
    return append_writer(path)


def read_latest(spark: SparkSession, path: str, keys: list[str], before: int | None = None) -> DataFrame:
    """The last stored row of each key, of batches below ``before`` if given."""
    log = spark.read.parquet(path)
    if before is not None:
        log = log.filter(F.col("batch_id") < before)
    values = [c for c in log.columns if c not in (*keys, "batch_id")]
    latest = F.max_by(F.struct(*values), "batch_id")
    return log.groupBy(*keys).agg(latest.alias("_v")).select(*keys, "_v.*")


def compact_log(spark: SparkSession, path: str, target: str, keys: list[str]) -> None:
    """Starts a new log at ``target`` from the current table of the one at ``path``.

    Its rows count as older than any batch, so a stream that goes on there with
    its checkpoint continues the table; the old log can then be dropped.
    """
    _store(read_latest(spark, path, keys), target, -1)


def top_n_writer(path: str, id_col: str, n: int, count: str = "count") -> Writer:
    """Ranks the closed windows of a batch.

    For counts in append mode: all rows of a window leave the aggregation in the
    same batch, so the batch ranking is final and needs no state of its own.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        _store(top_n(batch, id_col, n, count), path, batch_id)

    return write


def from_one_run(writer: Writer) -> Writer:
    """``writer`` over a batch that is computed once, however often ``writer`` reads it.

    For batches that come from keyed state: each reading would run the state again.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            writer(batch, batch_id)
        finally:
            batch.unpersist()

    return write


def tagged_writer(paths: dict[str, str], tag: str = "tag") -> Writer:
    """Main and side outputs: each tag's rows to its own table, from one computation of the batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        for value, path in paths.items():
            _store(batch.filter(F.col(tag) == value).drop(tag), path, batch_id)

    return from_one_run(write)
