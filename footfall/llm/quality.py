"""Quality classification by compression.

Two zstandard dictionaries are built from texts labelled good and bad.  A text is
compressed with either; the difference of the compressed sizes, divided by the text's
size, becomes the probability of label 1 by a logistic curve fitted on labelled texts
that neither dictionary has seen.  The curve is calibrated by how far the text
compresses at all: a saving means less in a text of few words repeated.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm.common import bucket_of, sliced, table

#: Dictionaries are built from pieces of about this many bytes.
PIECE = 400


@dataclass
class CompressionModel:
    bad: bytes
    good: bytes
    level: int
    curve: tuple[float, float, float]  # for saving, size and a constant

    def compressors(self) -> list[zstandard.ZstdCompressor]:
        return [
            zstandard.ZstdCompressor(level=self.level, dict_data=zstandard.ZstdCompressionDict(d)) if d
            else zstandard.ZstdCompressor(level=self.level)
            for d in (self.bad, self.good)
        ]

    def score(self, texts: list[bytes]) -> np.ndarray:
        return logistic(measured(texts, self.compressors()) @ np.array(self.curve))


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def measured(texts: list[bytes], compressors: list[zstandard.ZstdCompressor]) -> np.ndarray:
    """By text: what the good dictionary saves more than the bad one and the smaller size, of its bytes; 1."""
    sizes = np.array([[len(c.compress(t)) for c in compressors] for t in texts], dtype=float).reshape(-1, 2)
    length = np.array([max(len(t), 1) for t in texts], dtype=float)
    return np.stack([(sizes[:, 0] - sizes[:, 1]) / length, sizes.min(axis=1) / length, np.ones(len(texts))], axis=1)


def _dictionary(texts: list[bytes], size: int) -> bytes:
    pieces = [t[i : i + PIECE] for t in texts for i in range(0, len(t), PIECE)]
    try:
        return zstandard.train_dictionary(size, pieces).as_bytes()
    except zstandard.ZstdError:  # too little text to find anything common in it
        return b""


def fit(
    rows: list[tuple[int, str]], counts: dict[int, int], size: int = 262_144, level: int = 3
) -> CompressionModel:
    """``rows`` are (label, text) in any order; ``counts`` are the labels' true frequencies.

    Two thirds of the rows build the dictionaries, the others the curve, weighted so that
    the labels have their frequencies.  Without rows of both labels the score is the
    share of label 1, or one half if nothing is known.
    """
    by_label = {label: [t.encode() for _, t in sorted(r for r in rows if r[0] == label)] for label in (0, 1)}
    share = (counts.get(1, 0) + 1) / (counts.get(0, 0) + counts.get(1, 0) + 2)
    flat = CompressionModel(b"", b"", level, (0.0, 0.0, float(np.log(share / (1 - share)))))
    if min(len(x) for x in by_label.values()) < 6:
        return flat
    built = [_dictionary([t for i, t in enumerate(by_label[q]) if i % 3], size) for q in (0, 1)]
    if not all(built):
        return flat
    model = CompressionModel(*built, level, (0.0, 0.0, 0.0))
    compressors = model.compressors()
    unseen = [measured(by_label[label][::3], compressors) for label in (0, 1)]
    x, y = np.concatenate(unseen), np.repeat([0.0, 1.0], [len(u) for u in unseen])
    w = np.repeat([counts[label] / len(unseen[label]) for label in (0, 1)], [len(u) for u in unseen])
    scale, w = np.maximum(np.abs(x).mean(axis=0), 1e-12), w / w.mean()
    x, beta = x / scale, np.zeros(3)
    for _ in range(50):  # Newton steps with a slight ridge
        p = logistic(x @ beta)
        hessian = (x * (w * p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(3)
        beta += np.linalg.solve(hessian, x.T @ (w * (y - p)) - 1e-2 * beta)
    model.curve = tuple(float(b) for b in beta / scale)
    return model


def learn(
    docs: DataFrame, labels: DataFrame, documents: int = 2000, longest: int = 20_000, key: str = "doc_id",
    text: str = "text", quality: str = "quality",
) -> CompressionModel:
    """Fits a model on about ``documents`` labelled texts of either label.

    They are drawn by a hash of their ids among the labelled rows whose crc32 of the id
    is no multiple of 5; texts of over ``longest`` characters are left out.  Both bound
    what the driver receives.  Rows without label or text teach nothing.
    """
    known = labels.select(F.col(key).alias("key"), F.col(quality).cast("int").alias("label")).filter(
        (bucket_of(F.col(key), 5) != 0) & F.col("label").isin(0, 1)
    )
    counts = {r[0]: r[1] for r in known.groupBy("label").count().collect()}
    draw = F.pmod(F.xxhash64(F.col("key").cast("string")), F.lit(1 << 30))
    chosen = F.lit(False)
    for label, n in counts.items():
        chosen |= (F.col("label") == label) & (draw < F.lit(documents / n * (1 << 30)))
    drawn = F.broadcast(known.filter(chosen))  # two labels, ``documents`` rows each
    texts = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).filter(F.length("text").between(1, longest))
    return fit([tuple(r) for r in texts.join(drawn, "key").select("label", "text").collect()], counts)


def judged(docs: DataFrame, model: CompressionModel, threshold: float, text: str = "text") -> DataFrame:
    """``row``, a struct of all columns of ``docs``, with ``score`` and ``predicted``.

    Each whole text is compressed once per dictionary; a null text counts as empty and
    gets what the curve gives a text of nothing.  Rows are judged one by one, so repeated
    keys, null keys and columns of any name do no harm.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # two dictionaries of fixed size
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    row = rows.schema["row"].dataType.simpleString()

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for part in sliced(batches, "text"):
            score = model.score(pc.cast(part.column("text"), pa.binary()).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [part.column("row"), pa.array(score), pa.array((score >= threshold).astype(np.int32))],
                names=["row", "score", "predicted"],
            )

    return rows.mapInArrow(judge, f"row {row}, score double, predicted int")


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that are not rejected, with its columns."""
    kept = judged(docs, learn(docs, labels), threshold).filter("predicted = 1")
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def op5_quality(spark: SparkSession, sf_dir: str, threshold: float = 0.3) -> DataFrame:
    """Every document's score; learned from four folds of five."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = learn(docs, table(spark, sf_dir, "labels"))
    slim = docs.select("doc_id", "text")
    scored = judged(slim, model, threshold)
    return scored.select(
        "row.doc_id", (bucket_of(F.col("row.doc_id"), 5) == 0).alias("held_out"), "score", "predicted"
    )
