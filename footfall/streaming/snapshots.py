"""A keyed table that streams update and others read meanwhile.

Rows lie in buckets of a hash of their key.  A batch writes the buckets that it touches anew, as
a version of its own, and then replaces one small file, the *pointer*, that names the version of
each bucket.  A reader takes the pointer once: it sees one version of the whole table, however many
batches follow while it reads, and opens one folder a bucket, however many came before.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.session import drop_folder, read_text, replace_text
from footfall.streaming.sinks import Writer

BUCKET = "_bucket"


def _pointer(spark: SparkSession, path: str) -> dict:
    text = read_text(spark, f"{path}/current.json")
    return json.loads(text) if text else {"version": -1, "buckets": {}, "schema": None}


def _rows(spark: SparkSession, path: str, pointer: dict, buckets: Sequence[str]) -> DataFrame:
    folders = [f"{path}/data/version={pointer['buckets'][b]}/{BUCKET}={b}" for b in buckets]
    return spark.read.schema(pointer["schema"]).parquet(*folders)


def snapshot_writer(path: str, keys: Sequence[str], buckets: int = 16, kept: int = 2) -> Writer:
    """Keyed upsert into a snapshot table: a batch's rows take the place of those of equal keys.

    A batch has at most one row a key, as aggregates in update mode give.  A batch that runs again
    after its version was published changes nothing.  Versions that no bucket of the last ``kept`` pointers
    uses are dropped, so a reader has the time of that many batches.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, pointer = batch.sparkSession, _pointer(batch.sparkSession, path)
        if pointer["version"] >= batch_id:
            return
        bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
        folder = f"{path}/data/version={batch_id}"
        incoming = f"{path}/incoming/version={batch_id}"
        batch.withColumn(BUCKET, bucket).write.mode("overwrite").partitionBy(BUCKET).parquet(incoming)
        new = spark.read.schema(batch.withColumn(BUCKET, bucket).schema).parquet(incoming)
        touched = [str(r[0]) for r in new.select(BUCKET).distinct().collect()]  # ``buckets`` at most
        old = [b for b in touched if b in pointer["buckets"]]
        merged = new.drop(BUCKET)
        if old:
            merged = _rows(spark, path, pointer, old).join(new.select(*keys), list(keys), "left_anti").unionByName(merged)
        # one file a bucket: a bucket is as large as the table divided by their number
        merged.withColumn(BUCKET, bucket).repartition(BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(folder)
        history = [pointer["buckets"], *pointer.get("history", [])][:kept]
        current = {**pointer["buckets"], **dict.fromkeys(touched, batch_id)}
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in merged.schema)
        replace_text(spark, f"{path}/current.json", json.dumps({"version": batch_id, "buckets": current, "schema": schema, "history": history}))
        drop_folder(spark, incoming)
        used = {v for b in (current, *history) for v in b.values()}
        for past in pointer.get("history", [])[kept - 1:]:
            for version in set(past.values()) - used:
                drop_folder(spark, f"{path}/data/version={version}")

    return write


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The table as of the last batch that was published."""
    pointer = _pointer(spark, path)
    if not pointer["buckets"]:
        raise ValueError(f"no batch has been written to {path}")
    return _rows(spark, path, pointer, sorted(pointer["buckets"]))
