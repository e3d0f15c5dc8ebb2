"""Secret scans: fixed patterns, and a linear-chain conditional random field.

A text is cut into pieces, and each piece is tagged as the beginning of a secret, inside
one, or outside.  The score of a tagging adds up, piece by piece, weights for the piece's
shape, the kinds and shapes of its neighbours, a keyword close before it and features of
the whole file, and weights for neighbouring tags; Viterbi finds the best tagging.  The
weights maximise the likelihood of a bounded sample of texts, in which the patterns mark the
secrets, and of the same texts with made-up secrets that no pattern marks (bare values, issued
prefixes, headers, credentials in addresses) and with what only looks like one (ids, paths, images
and versions) put into them.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm.common import sliced, split_words, table

#: The base patterns.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KINDS = ("assign", "access", "hex", "crf")

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
PIECES = re.compile(r"""[^=:"'`]+|[=:"'`]+""")
KEYWORD = r"(?i)pass|secret|token|api|key|cred|auth|bearer"
OUT, BEGIN, IN = range(3)
#: Features of a piece, each one of so many values: shape, kind before and after, a keyword
#: within five pieces before, short shape before and after, file, its own kind.
SIZES = (576, 7, 7, 2, 9, 9, 6, 7)
EDGE = 6  # the kind beyond a text's ends


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Kind, start and end of the base patterns' matches, in code points."""
    found = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    # a run of 24 or more is one that the pattern's matches hold as they are
    found += [("hex", m.start(), m.end()) for m in LONG_HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


LONG_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]))))


def _describe(pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shape, kind and short shape of each piece."""
    has = lambda pattern: pc.match_substring_regex(pieces, pattern).to_numpy(zero_copy_only=False).astype(np.int64)
    size = np.digitize(pc.utf8_length(pieces).to_numpy(zero_copy_only=False), [4, 8, 16, 24, 40])
    lower, upper, digit = has("[a-z]"), has("[A-Z]"), has("[0-9]")
    symbol, hexed = has(r"[^\p{L}0-9]"), has("^[0-9a-fA-F]+$")
    odd = np.flatnonzero(digit)
    switches = np.zeros(len(pieces), dtype=np.int64)
    if len(odd):
        changes = pc.count_substring_regex(pieces.take(pa.array(odd)), "[0-9][^0-9]|[^0-9][0-9]")
        switches[odd] = np.digitize(changes.to_numpy(zero_copy_only=False), [2, 5])
    shape = ((((size * 2 + lower) * 2 + upper) * 2 + digit) * 2 + symbol) * 2 + hexed
    kind = np.zeros(len(pieces), dtype=np.int64)
    for value, pattern in ((1, KEYWORD), (4, "://|@"), (3, r"""^["'`]+$"""), (2, """^["'`]*[=:]+["'`]*$"""), (5, "base64,")):
        kind[has(pattern) == 1] = value
    return shape * 3 + switches, kind, digit * 4 + upper * 2 + symbol


@dataclass
class Pieces:
    """The pieces of a batch of texts, one text after the other."""

    shape: np.ndarray
    kind: np.ndarray
    short: np.ndarray
    ends: np.ndarray  # by text, from 0
    suspects: np.ndarray  # whether a text may have a base match

    def features(self) -> np.ndarray:
        """Piece by feature: places in the table of all features' values."""
        count = len(self.shape)
        text = np.repeat(np.arange(len(self.ends) - 1), np.diff(self.ends))
        first = np.zeros(count, dtype=bool)
        first[self.ends[:-1][np.diff(self.ends) > 0]] = True
        last = np.concatenate([first[1:], [True]])[:count]
        before = lambda x, none: np.where(first, none, np.concatenate([[none], x[:-1]])[:count])
        after = lambda x, none: np.where(last, none, np.concatenate([x[1:], [none]])[:count])
        keyed = (self.kind == 1).astype(np.int64)
        sums = np.concatenate([[0], np.cumsum(keyed)])
        place = np.arange(count)
        near = sums[place] - sums[np.maximum(place - 5, self.ends[:-1][text])] > 0
        texts = len(self.ends) - 1
        sizes = np.maximum(np.bincount(text, minlength=texts), 1)
        digits = np.digitize(np.bincount(text, self.short >= 4, texts) / sizes, [0.01, 0.1])
        file = (np.bincount(text, keyed, texts) > 0) * 3 + digits
        columns = [
            self.shape, before(self.kind, EDGE), after(self.kind, EDGE), near, before(self.short, 8), after(self.short, 8), file[text], self.kind
        ]
        offsets = np.concatenate([[0], np.cumsum(SIZES)[:-1]])
        return np.stack([c + o for c, o in zip(columns, offsets, strict=True)], axis=1)


def cut(texts: pa.Array) -> Pieces:
    words, codes, ends = split_words(texts)
    split = pc.match_substring_regex(words, """[=:"'`]""").to_numpy(zero_copy_only=False)
    listed = [[w] for w in words.to_pylist()]
    for i in np.flatnonzero(split):
        listed[i] = PIECES.findall(listed[i][0])
    counts = np.fromiter(map(len, listed), dtype=np.int64, count=len(listed))
    flat = pa.array([p for ps in listed for p in ps], pa.string())
    shape, kind, short = _describe(flat)
    first = np.concatenate([[0], np.cumsum(counts)])
    per_word = counts[codes]
    word_ends = np.concatenate([[0], np.cumsum(per_word)])
    at = np.arange(int(word_ends[-1])) + np.repeat(first[codes] - word_ends[:-1], per_word)
    # words without which no base pattern can match
    suspect = pc.match_substring_regex(words, "(?i)password|passwd|secret|token|api_?key|AKIA|[0-9a-f]{24}")
    hits = np.concatenate([[0], np.cumsum(suspect.to_numpy(zero_copy_only=False)[codes])])
    return Pieces(shape[at], kind[at], short[at], word_ends[ends], hits[ends[1:]] > hits[ends[:-1]])


def piece_spans(text: str) -> list[tuple[int, int]]:
    return [(w.start() + p.start(), w.start() + p.end()) for w in SPACE.finditer(text) for p in PIECES.finditer(w[0])]


@dataclass
class Field:
    emit: np.ndarray  # feature value by tag
    move: np.ndarray  # tag by next tag
    ends: np.ndarray  # of a text's first and last tag

    def tag(self, features: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The best tags of all pieces of the texts between ``ends``.

        Where being outside wins whatever the neighbours' tags, by more than any of them
        could add, the chain is cut; only what lies between such pieces goes through Viterbi.
        """
        tags = np.zeros(len(features), dtype=np.int8)
        # what a tag's neighbours can add over being outside, at the most
        gain = max(0.0, *(
            (self.move[p, x] - self.move[p, OUT] + self.move[x, n] - self.move[OUT, n])
            for p in range(3) for n in range(3) for x in (BEGIN, IN)
        )) + 2 * float(np.abs(self.ends).max()) + 1e-9
        parts = [self.emit[o : o + n] for o, n in zip(np.concatenate([[0], np.cumsum(SIZES)[:-1]]), SIZES, strict=True)]
        over = [(p[:, 1:] - p[:, :1]).max(axis=1) for p in parts]
        # a look at the shape alone settles nearly all pieces
        maybe = np.flatnonzero(over[0][features[:, 0]] + sum(o.max() for o in over[1:]) + gain > 0)
        scores = self.emit[features[maybe]].sum(axis=1)
        open_ = scores[:, 1:].max(axis=1) - scores[:, 0] + gain > 0
        maybe, scores = maybe[open_], scores[open_]
        if not len(maybe):
            return tags
        text = np.searchsorted(ends, maybe, "right")
        starts = np.flatnonzero(np.concatenate([[True], (np.diff(maybe) > 1) | (np.diff(text) > 0)]))
        firsts, lasts = set(ends[:-1].tolist()), set((ends[1:] - 1).tolist())
        for a, b in zip(starts, [*starts[1:], len(maybe)], strict=True):
            head = self.ends[0] if int(maybe[a]) in firsts else self.move[OUT]
            tail = self.ends[1] if int(maybe[b - 1]) in lasts else self.move[:, OUT]
            tags[maybe[a:b]] = self._viterbi(scores[a:b], head, tail)
        return tags

    def _viterbi(self, scores: np.ndarray, head: np.ndarray, tail: np.ndarray) -> list[int]:
        best, back = scores[0] + head, []
        for row in scores[1:]:
            options = best[:, None] + self.move
            back.append(options.argmax(axis=0))
            best = options.max(axis=0) + row
        path = [int((best + tail).argmax())]
        for pointers in reversed(back):
            path.append(int(pointers[path[-1]]))
        return path[::-1]


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def fit(windows: list[tuple[np.ndarray, np.ndarray]], steps: int = 80, ridge: float = 1e-2, pace: float = 0.2) -> Field:
    """Maximum likelihood by Adam over all windows (features, tags) at once, padded to one length."""
    total = sum(SIZES)
    theta = np.zeros(total * 3 + 9 + 6)
    length = max((len(t) for _, t in windows), default=0)
    if not length:
        return Field(np.zeros((total, 3)), np.zeros((3, 3)), np.zeros((2, 3)))
    rows = len(windows)
    x, y = np.full((rows, length, len(SIZES)), total), np.zeros((rows, length), dtype=np.int64)
    size = np.array([len(t) for _, t in windows])
    for i, (f, t) in enumerate(windows):
        x[i, : len(t)], y[i, : len(t)] = f, t
    real = np.arange(length)[None] < size[:, None]
    gold = np.eye(3)[y] * real[..., None]
    both = real[:, 1:]
    gold_moves = np.einsum("nti,ntj->ij", gold[:, :-1], gold[:, 1:])
    last = (np.arange(rows), size - 1)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        emit, move, ends = theta[: total * 3].reshape(total, 3), theta[total * 3 : total * 3 + 9].reshape(3, 3), theta[-6:].reshape(2, 3)
        scores = np.concatenate([emit, np.zeros((1, 3))])[x].sum(axis=2)
        alpha, beta = np.zeros((rows, length, 3)), np.zeros((rows, length, 3))
        alpha[:, 0] = scores[:, 0] + ends[0]
        for t in range(1, length):
            now = _log_sum(alpha[:, t - 1, :, None] + move, 1) + scores[:, t]
            alpha[:, t] = np.where(real[:, t, None], now, alpha[:, t - 1])
        beta[:] = ends[1]
        for t in range(length - 2, -1, -1):
            now = _log_sum(move + (scores[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
            beta[:, t] = np.where(real[:, t + 1, None], now, ends[1])
        z = _log_sum(alpha[last] + ends[1], 1)
        p = np.exp(alpha + beta - z[:, None, None]) * real[..., None]
        pairs = alpha[:, :-1, :, None] + move + (scores[:, 1:] + beta[:, 1:])[:, :, None, :] - z[:, None, None, None]
        moves = (np.exp(np.where(both[..., None, None], pairs, -np.inf))).sum(axis=(0, 1))
        error = p - gold
        flat = x.reshape(-1, len(SIZES))
        g_emit = np.stack([
            sum(np.bincount(flat[:, k], error[..., tag].ravel(), total + 1)[:total] for k in range(len(SIZES))) for tag in range(3)
        ], axis=1)
        g_ends = np.stack([error[:, 0].sum(axis=0), error[last].sum(axis=0)])
        grad = np.concatenate([g_emit.ravel(), (moves - gold_moves).ravel(), g_ends.ravel()]) / rows + ridge * theta / rows
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        theta = theta - pace * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Field(theta[: total * 3].reshape(total, 3), theta[total * 3 : total * 3 + 9].reshape(3, 3), theta[-6:].reshape(2, 3))


def _marked(text: str) -> list[tuple[int, int]]:
    """The secrets themselves, without keyword and quotes."""
    spans = [m.span(2) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    return spans + [(a, b) for kind, a, b in base_spans(text) if kind != "assign"]


def _value(rng: np.random.Generator) -> str:
    letters = ["abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/", "abcdefghijklmnopqrstuvwxyz0123456789",
               "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "0123456789abcdef"][rng.integers(4)]
    return "".join(letters[i] for i in rng.integers(len(letters), size=rng.integers(16, 48)))


_ALNUM = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"


def _drawn(rng: np.random.Generator, letters: str, size: int) -> str:
    return "".join(letters[i] for i in rng.integers(len(letters), size=size))


def made_secret(rng: np.random.Generator) -> tuple[str, str, str]:
    """What stands before a made-up secret, the secret, and what stands behind it."""
    pick = lambda *options: options[rng.integers(len(options))]
    value = _value(rng)
    kind = rng.integers(5)
    if kind == 0:
        quote = pick('"', "", "'")
        return pick("password", "secret", "token", "api_key", "apikey") + pick(" = ", "=", ": ") + quote, value, quote
    if kind == 1:
        return pick("the key is ", "use the password ", "my token ", "credentials ", "secret key ", "the api key was "), value, ""
    if kind == 2:
        prefix = pick("ghp_", "sk_live_", "xoxb-", "glpat-", "AIza", "npm_", "hf_")
        return pick("", "with ", "key ", "export "), prefix + _drawn(rng, _ALNUM, int(rng.integers(20, 40))), ""
    if kind == 3:
        parts = ["eyJ" + _drawn(rng, _ALNUM, int(rng.integers(15, 40))) for _ in range(2)] + [_drawn(rng, _ALNUM + "-_", 43)]
        return pick("Authorization: Bearer ", "bearer ", "X-Auth-Key: "), pick(".".join(parts), value), ""
    return f"{pick('https', 'postgres', 'ftp')}://{_drawn(rng, _ALNUM[:26], 6)}:", value.replace("/", "x") + f"@{_drawn(rng, _ALNUM[:26], 8)}.org", ""


def made_lookalike(rng: np.random.Generator) -> str:
    """What has the shape of a secret and is none."""
    hexes = lambda n: _drawn(rng, "0123456789abcdef", n)
    return [
        lambda: "id " + "-".join(hexes(n) for n in (8, 4, 4, 4, 12)),
        lambda: "data:image/png;base64," + _drawn(rng, _ALNUM + "+/", int(rng.integers(60, 200))),
        lambda: f"https://{_drawn(rng, _ALNUM[:26], 9)}.org/{_drawn(rng, _ALNUM[:26], 7)}/{rng.integers(10**6)}?page={rng.integers(99)}",
        lambda: f"IMG_{rng.integers(20100101, 20301231)}_{rng.integers(10**6)}.jpg",
        lambda: f"version {rng.integers(9)}.{rng.integers(99)}.{rng.integers(99)}-rc{rng.integers(9)}",
        lambda: "commit " + hexes(int(rng.integers(7, 12))),
        lambda: f"order {rng.integers(10**9, 10**12)} of {rng.integers(2000, 2030)}-{rng.integers(1, 12):02}-{rng.integers(1, 28):02}",
        lambda: "/".join(_drawn(rng, _ALNUM[:26], int(rng.integers(3, 12))) for _ in range(5)) + f"/file{rng.integers(99)}.txt",
        lambda: _drawn(rng, _ALNUM[:26], 12) + _drawn(rng, _ALNUM[26:52], 1) + _drawn(rng, _ALNUM[:26], 12),
    ][rng.integers(9)]()


def planted(text: str, rng: np.random.Generator, secret: bool) -> tuple[str, list[tuple[int, int]], list[tuple[int, int]]]:
    """The text with a secret or a lookalike between two of its words: the text, secrets put in, and all that was put in."""
    spaces = [m.end() for m in SPACE.finditer(text)] or [0]
    at = spaces[rng.integers(len(spaces))]
    before, value, behind = made_secret(rng) if secret else (made_lookalike(rng), "", "")
    made = before + value + behind
    start = at + 1 + len(before)
    spans = [(start, start + len(value))] if secret else []
    return f"{text[:at]} {made} {text[at:]}", spans, [(at + 1, at + 1 + len(made))]


def windows_of(
    texts: list[tuple[str, list[tuple[int, int]], list[tuple[int, int]]]], reach: int = 20
) -> list[tuple[np.ndarray, np.ndarray]]:
    """Training windows: around each secret, marked by a pattern or put in, around all that was put in, and one
    in every 200 pieces besides."""
    found = []
    pieces = cut(pa.array([t for t, _, _ in texts], pa.string()))
    features = pieces.features()
    for row, (text, secrets, placed) in enumerate(texts):
        spans, marked = piece_spans(text), sorted(_marked(text) + secrets)
        tags = np.zeros(len(spans), dtype=np.int64)
        for i, (a, b) in enumerate(spans):
            for s, e in marked:
                if s < b and a < e:
                    tags[i] = BEGIN if a <= s or not i or not tags[i - 1] else IN
        own = features[pieces.ends[row] : pieces.ends[row + 1]]
        put = [i for i, (a, b) in enumerate(spans) if any(s <= a and b <= e for s, e in placed)]
        centres = [*np.flatnonzero(tags == BEGIN).tolist(), *put[:1], *range(row % 50, len(spans), 200)]
        for c in centres:
            found.append((own[max(0, c - reach) : c + reach], tags[max(0, c - reach) : c + reach]))
    return [w for w in found if len(w[1])]


def learn(docs: DataFrame, documents: int = 250, longest: int = 20_000, key: str = "doc_id", text: str = "text") -> Field:
    """Fits the field on about ``documents`` texts with a keyword or a key's shape and as many others.

    Both are drawn by a hash of the key among texts of up to ``longest`` characters, which
    bounds what the driver receives.  Every text is learned as it is, twice with a secret put into it
    and once with a lookalike, all made up from a fixed seed.
    """
    rows = docs.select(F.col(text).cast("string").alias("text"), F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(1 << 30)).alias("draw"))
    rows = rows.filter(F.length("text").between(1, longest)).withColumn(
        "likely", F.col("text").rlike("(?i)(password|passwd|secret|token|api_?key)[\"']? *[:=]|AKIA[A-Z0-9]{16}")
    )
    chosen = F.lit(False)
    for likely, n in rows.groupBy("likely").count().collect():
        chosen |= (F.col("likely") == likely) & (F.col("draw") < F.lit(documents / n * (1 << 30)))
    texts = sorted(r[0] for r in rows.filter(chosen).select("text").collect())
    rng = np.random.default_rng(11)
    made = [planted(t, rng, secret) for secret in (True, True, False) for t in texts]
    return fit(windows_of([(t, [], []) for t in texts] + made))


def scan(docs: DataFrame, field: Field, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n_assign``, ``n_access``, ``n_hex``, ``base_sha256`` and ``spans`` of every whole text.

    ``spans`` has all base matches and the field's secrets that overlap none of them, as
    kind:start:end in code points, by start.  A null text is empty and has none.  Rows are
    scanned one by one: repeats, null keys and further columns do no harm.
    """
    shared = docs.sparkSession.sparkContext.broadcast(field)  # of fixed size
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = shared.value
        for part in sliced(batches, "text", 4 << 20):
            texts = part.column("text")
            pieces = cut(texts)
            tags = field.tag(pieces.features(), pieces.ends)
            counts, digests, spans = [], [], []
            marked = np.concatenate([[0], np.cumsum(tags != OUT)])[pieces.ends]
            tagged = marked[1:] > marked[:-1]
            for row in range(len(texts)):
                base, added = [], []
                if pieces.suspects[row] or tagged[row]:
                    whole = texts[row].as_py()
                    base = base_spans(whole)
                if tagged[row]:
                    own = tags[pieces.ends[row] : pieces.ends[row + 1]]
                    places = piece_spans(whole)
                    for i in np.flatnonzero((own == BEGIN) | ((own == IN) & (np.concatenate([[OUT], own[:-1]]) == OUT))):
                        j = i + 1
                        while j < len(own) and own[j] == IN and places[j - 1][1] == places[j][0]:
                            j += 1
                        a, b = places[i][0], places[j - 1][1]
                        if not any(s < b and a < e for _, s, e in base):
                            added.append(("crf", a, b))
                counts.append([sum(k == kind for k, _, _ in base) for kind in KINDS[:3]])
                digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
                spans.append(joined(base + added))
            numbers = np.array(counts, dtype=np.int64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays(
                [part.column("key"), *[pa.array(numbers[:, i]) for i in range(3)], pa.array(digests, pa.string()), pa.array(spans, pa.string())],
                names=["key", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
            )

    kind = rows.schema["key"].dataType.simpleString()
    found = rows.mapInArrow(find, f"key {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
    return found.withColumnRenamed("key", key)


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, by patterns and by a field learned from a sample of them."""
    docs = table(spark, sf_dir, "documents")
    return scan(docs, learn(docs))
