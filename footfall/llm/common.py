"""Helpers that several corpus operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.session import shared_folder

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    """Lower-cases A-Z alone; null becomes the empty text.

    A text of as many bytes as characters is ASCII, where ``lower`` does the same in one pass.
    """
    whole = F.coalesce(text, F.lit(""))
    return F.when(F.length(whole) == F.octet_length(whole), F.lower(whole)).otherwise(F.translate(whole, UPPER, LOWER))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def work_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder that driver and executors share."""
    return shared_folder(spark, f"llm-{label}")


def written(df: DataFrame, path: str) -> DataFrame:
    """``df`` as a table in the shared folder: cuts the lineage and outlives executors."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucket_of(key: Column, modulus: int) -> Column:
    """crc32 of the key as text, modulo ``modulus``; a null key counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % modulus


def bounded_sample(
    rows: DataFrame, label: str, text: str, key: str, chars: int, longest: int, seed: int = 0
) -> list[tuple[object, str]]:
    """About ``chars`` characters of whole texts for each label, to fit a model on.

    Rows are drawn by a hash of their key, at the rate that brings ``chars`` characters
    a label; texts of over ``longest`` characters are no training rows, which bounds how
    far a draw can exceed its expectation.  Labels are few by their nature.
    """
    sized = rows.select(
        F.col(label).alias("label"), F.col(text).alias("text"), F.length(text).alias("size"),
        F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit(seed)), F.lit(1 << 30)).alias("draw"),
    ).filter(F.col("label").isNotNull() & F.col("size").between(1, longest))
    chosen = F.lit(False)
    for value, total in sized.groupBy("label").agg(F.sum("size")).collect():
        chosen |= (F.col("label") == F.lit(value)) & (F.col("draw") < F.lit(chars / total * (1 << 30)))
    return sorted(map(tuple, sized.filter(chosen).select("label", "text").collect()), key=lambda r: (str(r[0]), r[1]))


def sliced(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cuts record batches so that ``column`` holds about ``max_bytes``, one row at least."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ends = np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            done = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + max_bytes, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Words between ASCII white space: distinct words, each word's place among them, offsets by text.

    A null text has no words.
    """
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    flat, ends = lists.flatten(), np.asarray(lists.offsets, dtype=np.int64)
    ends = ends - ends[0]
    full = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    if not full.all():
        ends = np.concatenate([[0], np.cumsum(full)])[ends]
        flat = flat.filter(pa.array(full))
    coded = flat.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False), ends


def segment_sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between neighbouring ``ends``; empty segments give zero."""
    sums = np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0, dtype=np.float64)])
    return sums[ends[1:]] - sums[ends[:-1]]
