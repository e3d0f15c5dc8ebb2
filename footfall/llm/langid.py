"""Language identification by averaged hashed subword embeddings and a linear softmax.

A word's subwords are the character n-grams of ``<word>``; each is hashed to a row of an
embedding table, a text is the average over all its subwords, and a linear softmax over
the languages follows.  Both layers are trained by stochastic gradient descent in numpy
on a bounded sample of labelled rows.  As everything behind the table is linear, scoring
looks up the languages' logits of a subword and averages those.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm.common import bounded_sample, bucket_of, sliced, split_words, table

GRAMS = (1, 2, 3, 4)
UNKNOWN = "und"
#: Odd multipliers of a polynomial hash of code points.
MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], dtype=np.uint64)


def subwords(words: list[str], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the subwords of each word, one after the other, and their number by word."""
    text = "".join(f"<{w}>" for w in words)
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    lengths = np.fromiter((len(w) + 2 for w in words), dtype=np.int64, count=len(words))
    word = np.repeat(np.arange(len(words)), lengths)
    ids, owners = [], []
    for n in GRAMS:
        count = len(points) - n + 1
        if count <= 0:
            continue
        mixed = np.full(count, n, dtype=np.uint64)
        for i in range(n):
            mixed = (mixed ^ points[i : i + count]) * MIX[i]
            mixed ^= mixed >> np.uint64(29)
        inside = word[:count] == word[n - 1 :]
        ids.append((mixed[inside] % np.uint64(buckets)).astype(np.int32))
        owners.append(word[:count][inside])
    ids, owners = np.concatenate(ids), np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return ids[order], np.bincount(owners, minlength=len(words))


def softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


@dataclass
class LanguageModel:
    languages: list[str]
    logits: np.ndarray  # of a subword, by language
    bias: np.ndarray
    sharpness: float  # what logits are multiplied by, so that scores are frequencies
    accept: float  # scores below are rejected

    def scores(self, texts: pa.Array) -> np.ndarray:
        """Probabilities by text and language; texts without words get those of the bias."""
        words, codes, ends = split_words(pc.utf8_lower(texts))
        sums, counts = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts))
        if len(words):
            ids, sizes = subwords(words.to_pylist(), len(self.logits))
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            by_word = np.add.reduceat(self.logits[ids], starts, axis=0)
            full = np.flatnonzero(np.diff(ends))
            sums[full] = np.add.reduceat(by_word[codes], ends[full], axis=0)
            counts[full] = np.add.reduceat(sizes[codes], ends[full])
        return softmax((sums / np.maximum(counts, 1)[:, None] + self.bias) * self.sharpness)


def _examples(texts: list[tuple[object, str]], rng: np.random.Generator) -> tuple[list[list[str]], list[object]]:
    """Runs of 3 to 60 words of the training texts, so that short texts are learned too."""
    runs, labels = [], []
    for label, text in texts:
        words = text.lower().split()
        at = 0
        while at < len(words):
            size = int(rng.integers(3, 60))
            runs.append(words[at : at + size])
            labels.append(label)
            at += size
    return runs, labels


def train(
    texts: list[tuple[object, str]], buckets: int = 1 << 16, width: int = 16, epochs: int = 4, rate: float = 0.5,
    batch: int = 32, accuracy: float = 0.99, seed: int = 7,
) -> LanguageModel:
    """Fits the two layers on four fifths of the runs, calibrates on the rest.

    The temperature minimises the log loss there; ``accept`` is the lowest score above
    which a share ``accuracy`` of those runs is right.  Without texts there is one
    language, ``und``.
    """
    rng = np.random.default_rng(seed)
    languages = sorted({str(label) for label, _ in texts}) or [UNKNOWN]
    runs, labels = _examples(texts, rng)
    gold = np.array([languages.index(str(x)) for x in labels], dtype=np.int64)
    vocabulary = sorted({w for run in runs for w in run}) or [""]
    place = {w: i for i, w in enumerate(vocabulary)}
    ids, sizes = subwords(vocabulary, buckets)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    grams = [np.concatenate([ids[starts[p] : starts[p + 1]] for p in map(place.__getitem__, run)]) for run in runs]
    held = rng.random(len(runs)) < 0.2
    table_ = rng.uniform(-1, 1, (buckets, width)).astype(np.float32) / width
    weights, bias = np.zeros((width, len(languages)), dtype=np.float32), np.zeros(len(languages), dtype=np.float32)
    fit = np.flatnonzero(~held)
    steps, step = epochs * -(-len(fit) // batch), 0
    for _ in range(epochs):
        rng.shuffle(fit)
        for at in range(0, len(fit), batch):
            rows = fit[at : at + batch]
            flat = np.concatenate([grams[r] for r in rows])
            sizes_ = np.array([len(grams[r]) for r in rows])
            hidden = np.add.reduceat(table_[flat], np.concatenate([[0], np.cumsum(sizes_)[:-1]]), axis=0) / sizes_[:, None]
            error = softmax(hidden @ weights + bias)
            error[np.arange(len(rows)), gold[rows]] -= 1
            pace = rate * (1 - step / steps)
            back = error @ weights.T / sizes_[:, None]
            weights -= pace * hidden.T @ error
            bias -= pace * error.mean(axis=0)
            np.subtract.at(table_, flat, (pace * np.repeat(back, sizes_, axis=0)).astype(np.float32))
            step += 1
    model = LanguageModel(languages, (table_ @ weights).astype(np.float64), bias.astype(np.float64), 1.0, 0.0)
    if held.any():
        rows = np.flatnonzero(held)
        z = np.stack([model.logits[grams[r]].mean(axis=0) for r in rows]) + model.bias
        loss = lambda s: -np.log(np.maximum(softmax(z * s)[np.arange(len(rows)), gold[rows]], 1e-300)).mean()
        model.sharpness = float(min(np.geomspace(0.1, 20, 60), key=loss))
        p = softmax(z * model.sharpness)
        right, best = p.argmax(axis=1) == gold[rows], p.max(axis=1)
        order = np.argsort(-best)
        good = np.cumsum(right[order]) / np.arange(1, len(rows) + 1) >= accuracy
        model.accept = float(best[order][np.flatnonzero(good)[-1]]) if good.any() else 1.0
    return model


def identify(docs: DataFrame, model: LanguageModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` and ``accepted`` of every whole text.

    Texts that are null or without a letter are ``und`` with score 0 and not accepted.
    The score is the calibrated probability of the predicted language; ties go to the
    language first in order.  Rows are judged one by one, so repeated keys, null keys
    and further columns do no harm; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # buckets x languages, fixed by the model

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        names = np.array([*model.languages, UNKNOWN], dtype=object)
        for part in sliced(batches, "text"):
            p = model.scores(part.column("text"))
            letters = pc.fill_null(pc.match_substring_regex(part.column("text"), r"\p{L}"), False)
            letters = letters.to_numpy(zero_copy_only=False)
            best = np.where(letters, p.argmax(axis=1), len(model.languages))
            score = np.where(letters, p.max(axis=1), 0.0)
            yield pa.RecordBatch.from_arrays(
                [part.column("key"), pa.array(names[best], pa.string()), pa.array(score),
                 pa.array(letters & (score >= model.accept))],
                names=[key, "lang_pred", "score", "accepted"],
            )

    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(judge, f"`{key}` {kind}, lang_pred string, score double, accepted boolean")


def op10_language_id(spark: SparkSession, sf_dir: str, chars: int = 300_000, longest: int = 20_000) -> DataFrame:
    """Learned from the documents of three folds out of four, applied to all.

    The model is fitted on about ``chars`` characters a language of whole texts of up to
    ``longest`` characters, drawn by a hash of their ids.
    """
    docs = table(spark, sf_dir, "documents")
    held = bucket_of(F.col("doc_id"), 4) == 2
    model = train(bounded_sample(docs.filter(~held), "lang", "text", "doc_id", chars, longest))
    found = identify(docs, model)
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score", "accepted")
