"""Substring dedup: words covered by a window that also starts elsewhere, by level-wise doubling.

Windows repeated at one length alone are extended to twice that length: 9 words, 18, and 35
(two windows of 18 that share a word).

* **9 words.**  Each window of 35 is found by one window of 9 alone, its *anchor*: that with
  the least hash among the 18 at its head, the leftmost of equals.  The choice depends on
  the window's words only, so equal windows have equal anchors at the same place in them.
  Anchors are counted over all documents; one that is not repeated ends all its windows.
* **18 words.**  What is left is extended to the 18 words from the anchor on, which every
  window of that anchor holds, and grouped by them; groups of one occurrence end.
* **35 words.**  The windows of one anchor follow one another, so a hash of all words that
  they cover tells most of them at once: where it is repeated, so are all of them.  Only
  groups in which some occurrence stands alone with its surroundings, as at the ends of a
  copied passage, are extended to single windows, of each different surrounding once.  No
  repeated window is left to double further: longer ones cover no other words.

Documents come back by ``row``, a 64-bit hash of key and text; windows are compared within
equal 18-word hashes by 64-bit hashes of their own.  Among n different such rows the chance
that any two share a hash is about n*n/2**65.  Repeated anchors are looked up in a bitmap of
bounded size, which errs to one side: what it lets through wrongly ends at the next level.
Counts are summed before they are shuffled and joined back, never collected by key, so a
passage that a third of all documents hold is no hot task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm.common import sliced, split_words, table, work_folder, written

#: Words of a window at each level.
BASE, MIDDLE, WINDOW = 9, 18, 35
#: Starts at which a window's anchor may lie.
HEADS = WINDOW - MIDDLE + 1
#: Bits of a bitmap for each entry, and at most (16 MB).
SPARSE, MOST_BITS = 16, 1 << 27
#: An anchor's place: its first word, and how far before it its first and last window start.
PLACE_BITS = 5
STEP = np.uint64(0x9E3779B97F4A7C15)
BACK = np.uint64(pow(int(STEP), -1, 1 << 64))
MIX = np.uint64(0xD6E8FEB86659FD93)
BATCH = 4 << 20


class Words:
    """The words of some texts in a row, with hashes of any stretch of them."""

    def __init__(self, texts: pa.Array):
        words, codes, self.ends = split_words(texts)
        hashed = np.fromiter((xxhash.xxh64_intdigest(w) for w in words.to_pylist()), dtype=np.uint64, count=len(words))
        flat = hashed[codes]
        self.size = len(flat)
        ones = np.ones(1, dtype=np.uint64)
        powers = np.concatenate([ones, np.multiply.accumulate(np.full(self.size, STEP))])
        self.back = np.concatenate([ones, np.multiply.accumulate(np.full(self.size, BACK))])
        self.sums = np.concatenate([ones, np.cumsum(flat * powers[:-1], dtype=np.uint64) + ones])

    def hashes(self, start: np.ndarray, length: int | np.ndarray) -> np.ndarray:
        h = (self.sums[start + length] - self.sums[start]) * self.back[start] + np.asarray(length).astype(np.uint64)
        h = (h ^ (h >> np.uint64(31))) * MIX
        return h ^ (h >> np.uint64(32))

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Each anchor's place, its hash, and the first and the last start of its windows."""
        counts = np.maximum(np.diff(self.ends) - WINDOW + 1, 0)
        none = np.zeros(0, dtype=np.int64)
        if not counts.sum():
            return none, none.astype(np.uint64), none, none
        h = self.hashes(np.arange(self.size - BASE + 1), BASE)
        least, reach = np.arange(len(h)), 1
        while reach < HEADS:  # the least of twice as many, then of the number wanted
            shift = min(reach, HEADS - reach)
            left, right = least[: len(least) - shift], least[shift:]
            least, reach = np.where(h[left] <= h[right], left, right), reach + shift
        begins = np.repeat(self.ends[:-1] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts)
        starts = begins + np.arange(len(begins))
        owner = least[starts]
        first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        last = np.concatenate([first[1:], [len(owner)]]) - 1
        at = owner[first]
        return at, h[at], starts[first], starts[last]


def _rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(
        F.xxhash64(F.col(key).cast("string"), F.col(text).cast("string")).alias("row"), F.col(key).cast("long").alias("doc"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )


def _bit(tokens: np.ndarray, bits: int) -> np.ndarray:
    return ((tokens.view(np.uint64) >> np.uint64(7)) & np.uint64(bits - 1)).astype(np.int64)


def _has(bitmap: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    at = _bit(tokens, 64 * len(bitmap))
    return ((bitmap[at >> 6] >> (at & 63)) & 1).astype(bool)


def bitmap_of(tokens: DataFrame, column: str) -> np.ndarray:
    """Bits of the 64-bit hashes in ``column``; of bounded size, so that others may share them."""
    count = tokens.count()
    bits = min(MOST_BITS, 1 << max(10, (SPARSE * count - 1).bit_length()))
    token = F.col(column)
    bit = F.shiftrightunsigned(token, 7).bitwiseAND(F.lit(bits - 1))
    one = F.expr(f"shiftleft(1L, cast(shiftrightunsigned({column}, 7) & 63 as int))")
    longs = tokens.select(F.shiftright(bit, 6).alias("at"), one.alias("one")).groupBy("at").agg(F.bit_or("one").alias("bits"))
    bitmap, got = np.zeros(bits // 64, dtype=np.int64), longs.toArrow()
    bitmap[got["at"].to_numpy()] = got["bits"].to_numpy()
    return bitmap


def _repeated_anchors(rows: DataFrame, folder: str) -> DataFrame:
    """Hashes of 9-word anchors that occur more than once: ``token``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sliced(batches, "text", BATCH):
            tokens, n = np.unique(Words(part.column("text")).anchors()[1].view(np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(tokens), pa.array(n)], names=["token", "n"])

    counted = rows.select("text").mapInArrow(count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    return written(counted.filter("n > 1").select("token"), f"{folder}/anchors")


def _facts(rows: DataFrame, bitmap: np.ndarray) -> DataFrame:
    """Per document its words, their hash, and of anchors in ``bitmap`` 18-word hash, hash of all windows, place."""
    shared = rows.sparkSession.sparkContext.broadcast(bitmap)  # of bounded size

    def facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = shared.value
        for part in sliced(batches, "text", BATCH):
            words = Words(part.column("text"))
            at, token, first, last = words.anchors()
            kept = _has(bitmap, token)
            at, first, last = at[kept], first[kept], last[kept]
            middle = words.hashes(at, MIDDLE).view(np.int64)
            whole = words.hashes(first, last - first + WINDOW).view(np.int64)
            text = np.searchsorted(words.ends, at, "right") - 1
            place = (((at - words.ends[text]) << PLACE_BITS | (at - first)) << PLACE_BITS) | (at - last)
            ends = pa.array(np.searchsorted(text, np.arange(part.num_rows + 1)).astype(np.int32))
            lists = [pa.ListArray.from_arrays(ends, pa.array(v)) for v in (middle, whole, place)]
            plain = [b" ".join(t.split()) for t in part.column("text").cast(pa.binary()).to_pylist()]
            digests = pa.array([hashlib.sha256(t).hexdigest() for t in plain], pa.string())
            yield pa.RecordBatch.from_arrays(
                [part.column("row"), part.column("doc"), pa.array(np.diff(words.ends)), digests, *lists],
                names=["row", "doc", "n_words", "sha256", "middle", "whole", "place"],
            )

    longs = "array<bigint>"
    return rows.mapInArrow(
        facts, f"row long, doc long, n_words long, sha256 string, middle {longs}, whole {longs}, place {longs}"
    )


def _with_rows(rows: DataFrame, facts: DataFrame) -> DataFrame:
    """``rows`` joined with ``facts`` on ``row``; most of the others are left out before the shuffle."""
    shared = rows.sparkSession.sparkContext.broadcast(bitmap_of(facts, "row"))

    def meets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_has(shared.value, batch.column("row").to_numpy())))

    return rows.select("row", "text").mapInArrow(meets, "row long, text string").join(facts, "row")


def _flat(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The numbers in ``lists``, and the list that each is in."""
    return lists.flatten().to_numpy(), np.repeat(np.arange(len(lists)), np.diff(np.asarray(lists.offsets)))


def _single_windows(asked: DataFrame) -> DataFrame:
    """The windows of the anchors that are asked for, one by one."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sliced(batches, "text", BATCH):
            words = Words(part.column("text"))
            place, text = _flat(part.column("places"))
            weight, middle = part.column("weights").flatten().to_numpy(), part.column("middles").flatten().to_numpy()
            at = place >> (2 * PLACE_BITS)
            high, low = place >> PLACE_BITS & (1 << PLACE_BITS) - 1, place & (1 << PLACE_BITS) - 1
            count = high - low + 1
            each = np.repeat(np.arange(len(place)), count)
            start = at[each] - high[each] + np.arange(len(each)) - np.repeat(np.cumsum(count) - count, count)
            token = words.hashes(start + words.ends[text[each]], WINDOW).view(np.int64)
            row = part.column("row").to_numpy()[text[each]]
            columns = [row, start, middle[each], at[each] - start, token, weight[each]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c.astype(np.int64)) for c in columns], names=["row", "start", "middle", "offset", "token", "weight"]
            )

    return asked.mapInArrow(windows, "row long, start long, middle long, offset long, token long, weight long")


def _covered(found: DataFrame) -> DataFrame:
    """``row`` and the words to remove of it as ``cuts``, merged stretches by first word and word behind."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, cuts = [], []
            for row, places, notes in zip(*(batch.column(c).to_pylist() for c in ("row", "place", "notes")), strict=True):
                notes = np.array(notes or [], dtype=np.int64)
                alone = notes[notes & 1 == 0] >> 1
                places = np.setdiff1d(np.array(places, dtype=np.int64), alone)
                at, mask = places >> (2 * PLACE_BITS), (1 << PLACE_BITS) - 1
                single = notes[notes & 1 == 1] >> 1
                start = np.concatenate([at - (places >> PLACE_BITS & mask), single])
                stop = np.concatenate([at - (places & mask), single]) + WINDOW
                if not len(start):
                    continue
                order = np.argsort(start, kind="stable")
                start, stop = start[order], np.maximum.accumulate(stop[order])
                new = np.concatenate([[True], start[1:] > stop[:-1]])
                last = np.concatenate([np.flatnonzero(new)[1:], [len(start)]]) - 1
                rows.append(row)
                cuts.append(np.stack([start[new], stop[last]], axis=1).ravel())
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(cuts, pa.list_(pa.int64()))], names=["row", "cuts"])

    return found.mapInArrow(merge, "row long, cuts array<bigint>")


def _without(cut: DataFrame) -> DataFrame:
    """``row``, the number of words in its ``cuts``, the text without them and its SHA-256."""

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sliced(batches, "text", BATCH):
            removed, texts = [], []
            for text, cuts in zip(part.column("text").cast(pa.binary()).to_pylist(), part.column("cuts").to_pylist(), strict=True):
                words = text.split()
                kept, done = [], 0
                for start, stop in zip(cuts[::2], cuts[1::2], strict=True):
                    kept += words[done:start]
                    done = stop
                kept += words[done:]
                removed.append(len(words) - len(kept))
                texts.append(b" ".join(kept))
            digests = [hashlib.sha256(t).hexdigest() for t in texts]
            yield pa.RecordBatch.from_arrays(
                [part.column("row"), pa.array(removed, pa.int64()), pa.array(digests, pa.string())],
                names=["row", "n_removed", "kept_sha256"],
            )

    return cut.mapInArrow(remove, "row long, n_removed long, kept_sha256 string")


def repeated_stretches(docs: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """``facts`` of all rows, and the ``cuts`` of those ``row``s that hold a repeated window.

    Null and empty texts, and those of under 35 words, hold no window.  Rows that repeat
    key and text are alike and repeat one another.
    """
    folder = work_folder(docs.sparkSession, "repeats")
    rows = _rows(docs, key, text)
    facts = written(_facts(rows, bitmap_of(_repeated_anchors(rows, folder), "token")), f"{folder}/facts")
    each = facts.select("row", F.inline(F.arrays_zip("middle", "whole", "place")))
    # different surroundings of an 18-word window; a row and a place stand for each
    kinds = each.groupBy("middle", "whole", F.expr(f"place & {(1 << 2 * PLACE_BITS) - 1}").alias("around")).agg(
        F.count("*").alias("n"), F.min("row").alias("row"), F.min_by("place", "row").alias("place")
    )
    kinds = written(kinds.select("middle", "n", "row", "place"), f"{folder}/kinds")
    # 18-word windows that are repeated and have an occurrence that is alone with its surroundings
    open_ = kinds.groupBy("middle").agg(F.sum("n").alias("all"), F.min("n").alias("least")).filter("all > 1 AND least = 1")
    asked = kinds.join(open_.select("middle"), "middle").groupBy("row").agg(
        F.collect_list(F.struct("place", F.least("n", F.lit(2)).alias("weight"), "middle")).alias("asks")
    )
    asked = written(
        asked.select("row", F.col("asks.place").alias("places"), F.col("asks.weight").alias("weights"),
                     F.col("asks.middle").alias("middles")),
        f"{folder}/asked",
    )
    windows = written(_single_windows(_with_rows(rows, asked)), f"{folder}/windows")
    same = ["middle", "offset", "token"]
    again = windows.groupBy(*same).agg(F.sum("weight").alias("all")).filter("all > 1").select(*same)
    single = windows.filter("weight = 1").join(again, same).select("row", (F.col("start") * 2 + 1).alias("note"))
    alone = kinds.filter("n = 1").select("row", (F.col("place") * 2).alias("note"))
    notes = alone.unionByName(single).groupBy("row").agg(F.collect_list("note").alias("notes"))
    met = facts.filter(F.size("place") > 0).select("row", "place").join(notes, "row", "left")
    cuts = _covered(met).groupBy("row").agg(F.first("cuts").alias("cuts"))
    return facts, written(cuts, f"{folder}/cuts")


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc``, ``n_words``, ``n_removed``, ``kept_sha256``.

    Windows are judged on the input.  Nothing is removed from null, empty and short texts,
    whose kept words are all they have.  An empty table gives an empty result.
    """
    facts, cuts = repeated_stretches(docs, key, text)
    changed = _without(_with_rows(_rows(docs, key, text), cuts)).dropDuplicates(["row"])
    full = facts.select("row", "doc", "n_words", "sha256").join(changed, "row", "left")
    return full.select(
        "doc", "n_words", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("kept_sha256", "sha256").alias("kept_sha256"),
    )


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the passages that occur more than once."""
    return remove_repeats(table(spark, sf_dir, "documents")).withColumnRenamed("doc", "doc_id")


def repeats_sql() -> str:
    """The same by comparing all windows as text."""
    return rf"""
    WITH words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
    windows AS (SELECT doc_id, i, array_to_string(ws[i:i + {WINDOW - 1}], ' ') AS w
      FROM words, unnest(range(1, len(ws) - {WINDOW - 2})) AS t(i)),
    again AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY w) > 1),
    gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + {WINDOW})) AS i FROM again),
    each AS (SELECT doc_id, i, ws[i] AS word FROM words, unnest(range(1, len(ws) + 1)) AS t(i)),
    kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n
      FROM each ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
    SELECT doc_id, len(ws) AS n_words, len(ws) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
    FROM words LEFT JOIN kept USING (doc_id)"""
