"""Token-id files with keyed access.

A store is a folder of shards in ascending order of keys.  Shard k is two files:

* ``shard-k.ids``: the ids of its documents one after the other, raw little-endian
  integers of 2 bytes where the vocabulary fits, else 4.
* ``shard-k.idx``: an 80-byte header of little-endian longs (magic, id width, documents,
  keys, levels of the hash function, bytes of its bits, ids, three zeros), then the
  documents in order (key, whether it has one, first id), and the keyed index: levels and
  bits of a minimal perfect hash function, and by place a 32-bit fingerprint of the key
  and the number of its first document.  Documents that repeat a key stand side by side.

``manifest`` is a table of the shards.  A lookup finds a key's shards among their first
and last keys, its place by the hash function, refuses it if the fingerprint differs, and
reads its ids by offset: a constant number of steps each.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from footfall.llm.common import sliced, table, work_folder
from footfall.llm.mph import PerfectHash, fingerprints
from footfall.llm.tokens import encode, load, remembered, tokenizer_path

MAGIC, END = 0x31_5344_4953_4B54, 1
MANIFEST = "shard int, documents long, ids long, first_key long, last_key long, start long"


def _open(uri: str):
    """The file system of a folder, as pyarrow knows it, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("/") else uri.replace("file:", "file://", 1))


def _put(uri: str, name: str, blocks: Iterator[bytes]) -> None:
    """Writes a file under another name first, so that a lost or repeated task leaves no half."""
    files, path = _open(uri)
    files.create_dir(path, recursive=True)
    draft = f"{path}/.{name}-{uuid.uuid4().hex}"
    with files.open_output_stream(draft) as out:
        for block in blocks:
            out.write(block)
    files.move(draft, f"{path}/{name}")


@dataclass
class Shard:
    """What a shard's index file holds."""

    width: int
    keys: np.ndarray  # by document
    keyed: np.ndarray
    starts: np.ndarray  # first id by document, and the number of ids
    hash: PerfectHash
    prints: np.ndarray  # by place
    first: np.ndarray

    @classmethod
    def build(cls, width: int, keys: np.ndarray, keyed: np.ndarray, counts: np.ndarray) -> Shard:
        new = np.concatenate([[True], (keys[1:] != keys[:-1]) | ~keyed[:-1]])[: len(keys)] & keyed
        first = np.flatnonzero(new)
        function = PerfectHash.build(keys[first])
        order = np.empty(len(first), dtype=np.int64)
        order[function.places(keys[first])] = first
        starts = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
        return cls(width, keys, keyed, starts, function, fingerprints(keys[order]), order)

    def blocks(self) -> Iterator[bytes]:
        header = [MAGIC, self.width, len(self.keys), len(self.first), len(self.hash.sizes), len(self.hash.bits), self.starts[-1], 0, 0, 0]
        yield np.array(header, dtype="<i8").tobytes()
        yield self.keys.astype("<i8").tobytes()
        yield self.keyed.astype("u1").tobytes()
        yield self.starts.astype("<i8").tobytes()
        yield self.hash.sizes.astype("<i8").tobytes()
        yield self.hash.bits.tobytes()
        yield self.prints.astype("<u4").tobytes()
        yield self.first.astype("<i8").tobytes()

    @classmethod
    def read(cls, folder: str, shard: int) -> Shard:
        files, path = _open(folder)
        with files.open_input_file(f"{path}/shard-{shard}.idx") as f:
            data = f.read()
        magic, width, documents, keys, levels, nbits, *_ = np.frombuffer(data, "<i8", 10).tolist()
        if magic != MAGIC:
            raise ValueError(f"shard {shard} of {folder} is no index of a token store")
        at, parts = 80, []
        for kind, count in (("<i8", documents), ("u1", documents), ("<i8", documents + 1), ("<i8", levels), ("u1", nbits), ("<u4", keys), ("<i8", keys)):
            parts.append(np.frombuffer(data, kind, count, at))
            at += parts[-1].nbytes
        return cls(width, parts[0], parts[1] == 1, parts[2], PerfectHash(parts[3], parts[4]), parts[5], parts[6])

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key's first document, or -1."""
        place = self.hash.places(keys)
        ok = place >= 0
        ok[ok] = self.prints[place[ok]] == fingerprints(keys[ok])
        found = np.where(ok, self.first[np.where(ok, place, 0)] if len(self.first) else -1, -1)
        sure = found >= 0
        sure[sure] = self.keys[found[sure]] == keys[sure]  # a stranger may share a fingerprint
        return np.where(sure, found, -1)


    def documents(self, begin: int, end: int) -> np.ndarray:
        """The documents from ``begin`` to ``end``, each key's first one as the index finds it."""
        found = np.arange(begin, end)
        keyed = np.flatnonzero(self.keyed[begin:end])
        first = self.find(self.keys[begin:end][keyed])
        if (first < 0).any():
            raise ValueError("the index does not know a key of its shard")
        again = np.flatnonzero(first != found[keyed])
        # behind the first of its key a document follows the one before
        if (self.keys[first[again]] != self.keys[found[keyed][again]]).any() or (first[again] > found[keyed][again]).any():
            raise ValueError("the index leads to another key's document")
        first[again] = found[keyed][again]
        found[keyed] = first
        return found


def write_store(
    docs: DataFrame, folder: str, tokenizer: str | None = None, key: str = "doc_id", text: str = "text",
    shard_chars: int = 48 << 20,
) -> DataFrame:
    """Encodes every whole text and writes the store; returns the manifest.

    An id END follows each document.  Null texts are empty; documents without key come
    first and have no index entry; those that repeat a key follow each other, in an order
    that the text decides.  Shards hold about ``shard_chars`` characters, as a sample of
    the keys divides them; a hot key is divided by its texts, a hot text by its copies.  An empty table gives no shard.
    """
    spark = docs.sparkSession
    path = tokenizer or tokenizer_path()
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    # rows equal in key and text, as mixing makes them, may be many shards full: their copies are told apart, too
    placed = rows.withColumn("tie", F.xxhash64("text")).withColumn("copy", F.monotonically_increasing_id())
    dealt = placed.repartitionByRange(max(1, -(-total // shard_chars)), "key", "tie", "copy")

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        width = 2 if load(path).get_vocab_size() <= 1 << 16 else 4
        keys, keyed, counts = [], [], []

        def payload() -> Iterator[bytes]:
            for part in sliced(batches, "text"):
                found = encode(part.column("text"), path)
                ids = np.insert(found.ids, found.ends[1:], END)
                counts.append(np.diff(found.ends) + 1)
                keys.append(part.column("key").fill_null(0).to_numpy(zero_copy_only=False))
                keyed.append(part.column("key").is_valid().to_numpy(zero_copy_only=False))
                yield ids.astype(f"<u{width}").tobytes()

        _put(folder, f"shard-{shard}.ids", payload())
        remembered.cache_clear()  # the worker lives on and does other work
        if not keys:
            return
        index = Shard.build(width, np.concatenate(keys), np.concatenate(keyed), np.concatenate(counts))
        _put(folder, f"shard-{shard}.idx", index.blocks())
        bounds = index.keys[index.keyed]
        row = [shard, len(index.keys), int(index.starts[-1]), *((int(bounds[0]), int(bounds[-1])) if len(bounds) else (None, None)), 0]
        kinds = [pa.int32(), *[pa.int64()] * 5]
        yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names=[f.split()[0] for f in MANIFEST.split(", ")])

    shards = dealt.sortWithinPartitions("key", "tie").select("key", "text").mapInArrow(save, MANIFEST)
    shards.write.parquet(f"{folder}/shards")
    # one row a shard: the ids before it
    before = F.sum("ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    manifest = spark.read.parquet(f"{folder}/shards").withColumn("start", F.coalesce(before, F.lit(0)))
    manifest.write.parquet(f"{folder}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def _by_shard(manifest: DataFrame) -> DataFrame:
    """A partition for each few shards, whatever files the manifest lies in."""
    return manifest.select("shard", "start").repartition(max(1, manifest.count()), "shard")


def read_store(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """Every document from the files: ``key``, ``start``, ``n_tokens``, ``ids_crc32``, and ``ids`` if asked for.

    Each shard answers for its own keys: a key's document is found by ``Shard.find``, through place,
    fingerprint and offset.  Only documents that repeat a key, behind the first, and those
    without one are taken in their order.  ``start`` counts the ids of all documents before; the checksum is of the ids as
    little-endian unsigned 32-bit integers.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = _open(folder)
        for batch in batches:
            for shard, start in zip(batch.column("shard").to_pylist(), batch.column("start").to_pylist(), strict=True):
                index = Shard.read(folder, shard)
                with files.open_input_file(f"{path}/shard-{shard}.ids") as f:
                    for at in range(0, len(index.keys), 2000):
                        documents = index.documents(at, min(at + 2000, len(index.keys)))
                        ends = np.append(index.starts[documents], index.starts[documents[-1] + 1])
                        f.seek(int(ends[0]) * index.width)
                        ids = np.frombuffer(f.read(int(ends[-1] - ends[0]) * index.width), f"<u{index.width}").astype("<u4")
                        cuts = (ends - ends[0]).tolist()
                        sums = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                        keys = pa.array(index.keys[at : at + 2000], mask=~index.keyed[at : at + 2000])
                        columns = [keys, pa.array(ends[:-1] + start), pa.array(np.diff(ends)), pa.array(sums, pa.int64())]
                        if with_ids:
                            columns.append(pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(ids.astype(np.int32))))
                        yield pa.RecordBatch.from_arrays(columns, names=["key", "start", "n_tokens", "ids_crc32", "ids"][: len(columns)])

    kind = "key long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids
    return _by_shard(spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")).mapInArrow(scan, kind)


def lookup(keys: DataFrame, folder: str, key: str = "doc_id") -> DataFrame:
    """The ids of the documents with the given keys: ``key``, ``start``, ``ids``; unknown keys give no row.

    Keys go to the shards whose bounds hold them (two longs a shard are known to every
    task), and each shard answers its own from the hash index.
    """
    spark = keys.sparkSession
    bounds = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest").orderBy("shard").toArrow()
    shards, starts = bounds["shard"].to_numpy(), bounds["start"].to_numpy()
    low = bounds["first_key"].to_pandas().to_numpy(dtype=float, na_value=np.inf)
    high = bounds["last_key"].to_pandas().to_numpy(dtype=float, na_value=-np.inf)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = batch.column("key").drop_null().to_numpy()
            # rounding to doubles can only add a shard at a bound, where the index then says no
            held = [(k, s) for k in wanted.tolist() for s in np.flatnonzero((low <= float(k)) & (float(k) <= high))]
            yield pa.RecordBatch.from_arrays([pa.array([h[0] for h in held], pa.int64()), pa.array([int(h[1]) for h in held], pa.int32())], names=["key", "at"])

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = _open(folder)
        for batch in batches:
            at, wanted = batch.column("at").to_numpy(), batch.column("key").to_numpy()
            for s in np.unique(at).tolist():
                index, own = Shard.read(folder, int(shards[s])), wanted[at == s]
                with files.open_input_file(f"{path}/shard-{shards[s]}.ids") as f:
                    for k, d in zip(own.tolist(), index.find(own).tolist(), strict=True):
                        while 0 <= d < len(index.keys) and index.keys[d] == k and index.keyed[d]:
                            a, b = index.starts[d : d + 2].tolist()
                            f.seek(a * index.width)
                            ids = np.frombuffer(f.read((b - a) * index.width), f"<u{index.width}")
                            yield pa.RecordBatch.from_arrays(
                                [pa.array([k], pa.int64()), pa.array([int(starts[s]) + a], pa.int64()), pa.array([ids.tolist()], pa.list_(pa.int32()))],
                                names=["key", "start", "ids"],
                            )
                            d += 1

    routed = keys.select(F.col(key).cast("long").alias("key")).distinct().mapInArrow(route, "key long, at int")
    return routed.repartition("at").sortWithinPartitions("at").mapInArrow(answer, "key long, start long, ids array<int>")


def token_file_rows(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Writes ``docs`` as a store in the shared folder and reads it back."""
    folder = work_folder(docs.sparkSession, "store")
    write_store(docs, folder, tokenizer)
    return read_store(docs.sparkSession, folder).withColumnRenamed("key", "doc_id")


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as it lies in the token files."""
    return token_file_rows(table(spark, sf_dir, "documents"))
