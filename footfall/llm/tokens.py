"""Encoding whole texts with a public tokenizer, word by word.

The tokenizer's pieces never span white space, its normaliser acts inside words, and its
added tokens hold no white space.  So the ids of a text are those of its words, one after
the other.  A worker encodes a word when it first meets it, joined with other new words
to texts of moderate length, and remembers a bounded number of words.
"""

from __future__ import annotations

import os
from dataclasses import dataclass
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from footfall.llm.common import split_words

TOKENIZER = "word_bpe_49k.json"
#: Words that are encoded as one text.
JOINED = 2000
#: A worker forgets its words when they are so many: some 200 MB.
REMEMBERED = 1_200_000


def tokenizer_path(name: str = TOKENIZER) -> str:
    """Where the installed public vocabulary file of this name lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


@cache
def load(path: str):
    """The tokenizer of a vocabulary file, once per Python worker."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs as many workers as there are cores
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _encode_words(words: list[str], path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of the words, their number by word, and their characters in the word."""
    ids, sizes, spans = [], [], []
    for at in range(0, len(words), JOINED):
        part = words[at : at + JOINED]
        encoded = load(path).encode(" ".join(part), add_special_tokens=False)
        starts = np.concatenate([[0], np.cumsum(np.fromiter(map(len, part), dtype=np.int64, count=len(part)) + 1)[:-1]])
        where = np.fromiter(chain.from_iterable(encoded.offsets), dtype=np.int64, count=2 * len(encoded)).reshape(-1, 2)
        word = np.searchsorted(starts, where[:, 0], "right") - 1
        ids.append(np.array(encoded.ids, dtype=np.uint32))
        sizes.append(np.bincount(word, minlength=len(part)))
        spans.append(where - starts[word][:, None])
    if not ids:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros((0, 2), np.int64)
    return np.concatenate(ids), np.concatenate(sizes), np.concatenate(spans)


class Words:
    """The words that a worker has met, with their ids and the ids' characters."""

    def __init__(self, path: str):
        self.path = path
        self.forget()

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.used = 0  # of ids
        self.ids, self.spans = np.zeros(1 << 16, np.uint32), np.zeros((1 << 16, 2), np.int32)
        self.first, self.sizes = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int32)

    def find(self, words: list[str]) -> np.ndarray:
        """Places of the words, new ones being encoded."""
        if len(self.place) > REMEMBERED:
            self.forget()
        place = self.place
        new = [w for w in words if w not in place]
        if new:
            ids, sizes, spans = _encode_words(new, self.path)
            begin, count, used = len(place), len(place) + len(new), self.used + len(ids)
            for name, size in (("ids", used), ("spans", used), ("first", count), ("sizes", count)):
                old = getattr(self, name)
                if size > len(old):
                    grown = np.zeros((2 * size, *old.shape[1:]), old.dtype)
                    grown[: len(old)] = old
                    setattr(self, name, grown)
            self.ids[self.used : used], self.spans[self.used : used] = ids, spans
            self.sizes[begin:count] = sizes
            self.first[begin:count] = self.used + np.cumsum(sizes) - sizes
            self.used = used
            place.update(zip(new, range(begin, count), strict=True))
        return np.fromiter(map(place.__getitem__, words), dtype=np.int64, count=len(words))


@cache
def remembered(path: str) -> Words:
    return Words(path)


@dataclass
class Encoded:
    ids: np.ndarray  # of all texts, one after the other
    ends: np.ndarray  # where each text's ids end; one more than texts, from 0
    spans: np.ndarray | None  # start and end of each id's characters in its text


def _characters(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Where words start in their texts, in characters; the texts' lengths."""
    parts = [t or "" for t in texts.to_pylist()]
    lengths = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
    points = np.frombuffer(("\n".join(parts) + "\n").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    space = (points == 32) | ((points >= 9) & (points <= 13))
    starts = np.flatnonzero(~space & np.concatenate([[True], space[:-1]]))
    bases = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]]) if len(parts) else np.zeros(0, dtype=np.int64)
    owner = np.searchsorted(bases, starts, "right") - 1
    return starts - bases[owner], lengths


def encode(texts: pa.Array, path: str, spans: bool = False) -> Encoded:
    """The ids of each whole text without special tokens; a null text has none."""
    words, codes, ends = split_words(texts)
    known = remembered(path)
    places = known.find(words.to_pylist())[codes]
    per_word = known.sizes[places].astype(np.int64)
    word_ends = np.concatenate([[0], np.cumsum(per_word)])
    at = np.arange(int(word_ends[-1])) + np.repeat(known.first[places] - word_ends[:-1], per_word)
    result = Encoded(known.ids[at], word_ends[ends], None)
    if spans:
        starts, _ = _characters(texts)
        result.spans = known.spans[at] + np.repeat(starts, per_word)[:, None]
    return result


def lengths(texts: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.utf8_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
