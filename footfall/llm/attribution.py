"""Token counts by offset-mapped attribution.

A document is encoded whole, once; each token's character span is then joined to the
document's sections by position, as intervals.  A token that crosses a boundary goes to the
section that holds most of its characters, and to the earlier one if two hold equally many.
Sections are whatever divides a text: lines, sentences, or windows of a number of characters,
as context windows and storage blocks are cut.  Windows cut words and tokens; lines do not, as no
token of a word-bound vocabulary spans white space.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm.common import sliced, table
from footfall.llm.tokens import encode, remembered, tokenizer_path


#: Characters of a section in the query.
SECTION_CHARS = 1000


def section_ends(text: str, separator: str = "\n") -> np.ndarray:
    """Where the sections of a text end: each holds the separator that ends it."""
    cuts, at = [], text.find(separator)
    while at >= 0:
        cuts.append(at + len(separator))
        at = text.find(separator, at + len(separator))
    if not cuts or cuts[-1] < len(text):
        cuts.append(len(text))
    return np.array(cuts, dtype=np.int64)


def window_ends(text: str, size: int) -> np.ndarray:
    """Where windows of ``size`` characters of a text end; the last may be shorter."""
    ends = np.arange(size, len(text) + size, size, dtype=np.int64)
    ends = np.minimum(ends, len(text))
    return ends if len(ends) else np.zeros(1, dtype=np.int64)


def attribute(spans: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The section of each span (start, end); ``ends`` are the sections' ends in order.

    A span may cross any number of boundaries.  One without characters goes to the
    section that holds its place.
    """
    last = len(ends) - 1
    first = np.minimum(np.searchsorted(ends, spans[:, 0], "right"), last)
    final = np.maximum(np.minimum(np.searchsorted(ends, spans[:, 1] - 1, "right"), last), first)
    chosen = first.copy()
    for i in np.flatnonzero(first != final):
        sections = np.arange(first[i], final[i] + 1)
        begins = np.maximum(np.concatenate([[0], ends])[sections], spans[i, 0])
        chosen[i] = sections[np.argmax(np.minimum(ends[sections], spans[i, 1]) - begins)]
    return chosen


def section_tokens(
    docs: DataFrame, tokenizer: str | None = None, key: str = "doc_id", text: str = "text", separator: str = "\n",
    window: int | None = None,
) -> DataFrame:
    """One row per section: ``key``, ``section``, ``first_char``, ``end_char``, ``n_tokens``, ``crossing``.

    Sections are windows of ``window`` characters or, without it, what the separator ends, in
    order from 0; their counts add up to the whole document's.  ``crossing`` counts the
    section's tokens that reach into another.
    A null or empty text is one empty section with no token.  Rows are treated one by
    one: repeated and null keys and further columns do no harm.
    """
    path = tokenizer or tokenizer_path()
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sliced(batches, "text", 4 << 20):
            found = encode(part.column("text"), path, spans=True)
            owners, numbers, begins, ends_, tokens, crossing = [], [], [], [], [], []
            for row, text in enumerate(part.column("text").to_pylist()):
                spans, ends = found.spans[found.ends[row] : found.ends[row + 1]], (window_ends(text, window) if window else section_ends(text, separator))
                where = attribute(spans, ends)
                starts = np.concatenate([[0], ends[:-1]])
                across = (spans[:, 0] < starts[where]) | (spans[:, 1] > ends[where])
                owners.append(np.full(len(ends), row))
                numbers.append(np.arange(len(ends)))
                begins.append(starts)
                ends_.append(ends)
                tokens.append(np.bincount(where, minlength=len(ends)))
                crossing.append(np.bincount(where[across], minlength=len(ends)))
            if owners:
                columns = [numbers, begins, ends_, tokens, crossing]
                yield pa.RecordBatch.from_arrays(
                    [part.column("key").take(pa.array(np.concatenate(owners))), *[pa.array(np.concatenate(c).astype(np.int64)) for c in columns]],
                    names=["key", "section", "first_char", "end_char", "n_tokens", "crossing"],
                )

        remembered.cache_clear()  # the worker lives on and does other work

    kind = rows.schema["key"].dataType.simpleString()
    counted = rows.mapInArrow(
        count, f"key {kind}, section long, first_char long, end_char long, n_tokens long, crossing long"
    )
    return counted.withColumnRenamed("key", key)


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every thousand characters of every document."""
    return section_tokens(table(spark, sf_dir, "documents"), window=SECTION_CHARS)
