"""N-gram Jaccard join: documents whose sets of word shingles are alike, and their components.

Documents with equal sets are one node.  Nodes meet in tiles, one per prefix shingle and
size band, in which hashed bitmaps bound the overlap of each pair from above; what passes
is intersected exactly.  Shingles are 64-bit hashes of five words, and so is a node's name
of its whole set: among n different sets, the chance that any two share a name is n*n/2**65.

No link is lost.  A set and its partner at similarity 0.8 or more differ in fewer elements
than a prefix has, whatever order the prefix follows, so the two prefixes meet:

* Shingles are ordered by hash, but those in very many documents come last.  Which these
  are changes cost alone, not results.
* A document is left out of the tiles if too few of its shingles occur in any other
  document to have a partner.  That is counted over all documents, on the shingles with
  the lowest hashes, and kept in a bitmap of fixed size that errs to one side only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm.common import lower_ascii, sliced, split_words, table, work_folder, written
from footfall.llm.components import components

WORDS = 5
#: Odd multipliers of the words of a shingle.
MIX = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F],
    dtype=np.uint64,
)
#: The part of the hash range on which all documents' shingles are counted.
COUNTED = 0.3
#: Bits of the bitmap of shared shingles (16 MB), and shingles in more documents than ``COMMON`` come last.
SHARED_BITS, COMMON, COMMON_KEPT = 1 << 27, 64, 1_000_000
#: Parts in which that bitmap comes to the driver, one after the other.
PARTS = 32
#: Longs of a document's bitmap, and the rows of a tile that are compared at once.
LONGS, BLOCK = 32, 1024
#: Sizes that can reach 0.8 differ by a factor of 1.25 at most; a band is a little wider.
BAND = float(np.log(1.26))


def _finish(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h = h * MIX[0]
    return h ^ (h >> np.uint64(29))


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """Of each text the sorted distinct 64-bit hashes of its shingles.

    Texts of fewer words are one shingle; null texts and texts without words have none.
    """
    words, codes, ends = split_words(texts)
    hashed = np.fromiter((xxhash.xxh64_intdigest(w) for w in words.to_pylist()), dtype=np.uint64, count=len(words))[codes]
    count = max(len(hashed) - WORDS + 1, 0)
    rolled = np.zeros(count, dtype=np.uint64)
    for j in range(WORDS):
        rolled += hashed[j : j + count] * MIX[j]
    rolled = _finish(rolled).view(np.int64)
    sets = []
    for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
        if b - a >= WORDS:
            sets.append(np.unique(rolled[a : b - WORDS + 1]))
        elif b > a:
            own = (hashed[a:b] * MIX[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
            sets.append(_finish(np.array([own])).view(np.int64))
        else:
            sets.append(np.zeros(0, dtype=np.int64))
    return sets


def prefix_length(n: int) -> int:
    """So many shingles of n, in any common order, hold one that a partner's prefix also holds."""
    return n - (4 * n + 4) // 5 + 1


def _limit() -> int:
    return int(-(1 << 63) + COUNTED * (1 << 64))


def _bit(tokens: np.ndarray) -> np.ndarray:
    return (tokens.view(np.uint64) >> np.uint64(7)) % np.uint64(SHARED_BITS)


def _texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    text_ = F.col(text).cast("string")
    return docs.select(
        F.col(key).cast("long").alias("doc"), F.xxhash64(text_).alias("text_key"), lower_ascii(text_).alias("text")
    )


def _count_shingles(rows: DataFrame, folder: str) -> tuple[np.ndarray, np.ndarray]:
    """The bitmap of shingles that more than one row has, and the sorted common shingles.

    Both have a fixed size, whatever the input.  The driver meets the bitmap in ``PARTS`` parts, each
    packed by a task, so beyond the bitmap itself it holds one of them.
    """
    spark, limit = rows.sparkSession, _limit()

    def low(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sliced(batches, "text"):
            tokens = np.concatenate([s[: np.searchsorted(s, limit)] for s in shingle_sets(part.column("text"))])
            yield pa.RecordBatch.from_arrays([pa.array(tokens)], names=["token"])

    counted = rows.select("text").mapInArrow(low, "token long").groupBy("token").agg(F.count("*").alias("n"))
    shared = written(counted.filter("n > 1"), f"{folder}/shared")
    bit = F.shiftrightunsigned("token", 7).bitwiseAND(F.lit(SHARED_BITS - 1))
    longs = shared.select(
        F.shiftright(bit, 6).alias("at"), F.expr("shiftleft(1L, cast(shiftrightunsigned(token, 7) & 63 as int))").alias("bits")
    ).groupBy("at").agg(F.bit_or("bits").alias("bits"))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = [(b.column("at").to_numpy().astype(np.int32), b.column("bits").to_numpy()) for b in batches]
        if columns:
            at, bits = (np.concatenate(c).tobytes() for c in zip(*columns))
            yield pa.RecordBatch.from_arrays([pa.array([at]), pa.array([bits])], names=["at", "bits"])

    bitmap = np.zeros(SHARED_BITS // 64, dtype=np.int64)
    for part in longs.repartition(PARTS, "at").mapInArrow(packed, "at binary, bits binary").toLocalIterator():
        bitmap[np.frombuffer(part["at"], np.int32)] = np.frombuffer(part["bits"], np.int64)
    common = shared.filter(F.col("n") > COMMON).orderBy(F.desc("n"), "token").limit(COMMON_KEPT).select("token")
    return bitmap, np.sort(common.toArrow()["token"].to_numpy())


def _sets(rows: DataFrame, bitmap: np.ndarray, common: np.ndarray) -> DataFrame:
    """Per row ``doc``, ``text_key``, ``n``, ``node``; of possible partners also ``prefix``, ``lone``, ``bits``, ``shingles``."""
    limit = _limit()
    shared = rows.sparkSession.sparkContext.broadcast((bitmap, common))  # of fixed size

    def kept(s: np.ndarray, bitmap: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, int] | None:
        p, low = prefix_length(len(s)), int(np.searchsorted(s, limit))
        at = _bit(s[:low]).astype(np.int64)
        met = (bitmap[at >> 6] >> (at & 63)) & 1
        if low - int(met.sum()) >= p:  # a partner has all but p - 1 of them
            return None
        usual = np.zeros(len(s), dtype=bool)
        if len(common):
            places = np.minimum(np.searchsorted(common, s), len(common) - 1)
            usual = common[places] == s
        prefix = np.concatenate([s[~usual], s[usual]])[:p]
        return prefix, int(low - met.sum())

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap, common = shared.value
        for part in sliced(batches, "text", 4 << 20):
            sets = shingle_sets(part.column("text"))
            sizes = [len(s) for s in sets]
            nodes = [xxhash.xxh64_intdigest(s.tobytes()) - (1 << 63) if len(s) else None for s in sets]
            prefixes, lone, bits, full = [], [], [], []
            for s in sets:
                found = kept(s, bitmap, common) if len(s) else None
                prefixes.append(found and found[0])
                lone.append(found and found[1])
                if found:
                    b = np.zeros(LONGS, dtype=np.uint64)
                    at = s.view(np.uint64) & np.uint64(64 * LONGS - 1)
                    np.bitwise_or.at(b, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
                    bits.append(b.view(np.int64))
                    full.append(s)
                else:
                    bits.append(None)
                    full.append(None)
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc"), part.column("text_key"), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()),
                 pa.array(prefixes, longs), pa.array(lone, pa.int32()), pa.array(bits, longs), pa.array(full, longs)],
                names=["doc", "text_key", "n", "node", "prefix", "lone", "bits", "shingles"],
            )

    longs = "array<bigint>"
    return rows.mapInArrow(
        build, f"doc long, text_key long, n long, node long, prefix {longs}, lone int, bits {longs}, shingles {longs}"
    )


def _linked(pairs: DataFrame, arrays: DataFrame) -> DataFrame:
    """The pairs (a, b) of which 100 * intersection >= 80 * union, by merging their sorted arrays."""
    left = arrays.select(F.col("node").alias("a"), F.col("shingles").alias("left"))
    right = arrays.select(F.col("node").alias("b"), F.col("shingles").alias("right"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right")

    def intersect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, dtype=bool)
            left, right = batch.column("left"), batch.column("right")
            for i in range(batch.num_rows):
                x, y = left[i].values.to_numpy(), right[i].values.to_numpy()
                at = np.minimum(np.searchsorted(x, y), len(x) - 1)
                met = int((x[at] == y).sum())
                keep[i] = 100 * met >= 80 * (len(x) + len(y) - met)
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(pa.array(keep)), batch.column("b").filter(pa.array(keep))], names=["a", "b"])

    return both.mapInArrow(intersect, "a long, b long")


def _tile_pairs(tiles: DataFrame, nearest: bool) -> DataFrame:
    """Distinct pairs of different roots in a tile whose bitmaps leave room for 0.8.

    With ``nearest``, of each node only its best pair and its best with the tile's most
    frequent root, whose own nodes need none.
    """

    def compare(group: dict[str, np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        own, root, node, n = np.flatnonzero(group["own"]), group["root"], group["node"], group["n"]
        bits = group["bits"]
        ones = np.bitwise_count(bits).sum(axis=1).astype(np.int64)
        names, counts = np.unique(root, return_counts=True)
        main = names[counts.argmax()]
        if nearest:
            own = own[root[own] != main]
        for i in range(0, len(own), 64):
            rows = own[i : i + 64]
            both = np.bitwise_count(bits[rows][:, None, :] & bits[None, :, :]).sum(axis=2).astype(np.int64)
            room = np.minimum(n[rows, None] - ones[rows, None] + both, n[None] - ones[None] + both)
            fits = (9 * room >= 4 * (n[rows, None] + n[None])) & (root[rows, None] != root[None])
            if nearest:
                alike = both / (ones[rows, None] + ones[None] - both)
                for allowed in (fits, fits & (root[None] == main)):
                    some = np.flatnonzero(allowed.any(axis=1))
                    yield node[rows[some]], node[np.where(allowed[some], alike[some], -1).argmax(axis=1)]
            else:
                # a pair counts once: with the lower band or the smaller node on the left, in one pair of blocks
                fits &= ~group["own"][None] | (node[rows, None] < node[None])
                fits &= (group["half"][rows, None] != group["half"][None]) | group["alone"][None]
                x, y = np.nonzero(fits)
                yield node[rows[x]], node[y]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["token", "band", "x", "y", "node", "n", "root", "own", "half", "alone"]
        rest: dict[str, np.ndarray] | None = None

        def groups(data: dict[str, np.ndarray], last: bool) -> Iterator[dict[str, np.ndarray] | None]:
            keys = np.stack([data[k] for k in ("token", "band", "x", "y")])
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            ends = [0, *cuts.tolist(), keys.shape[1]]
            stop = len(ends) - 1 if last else len(ends) - 2
            for a, b in zip(ends[:stop], ends[1 : stop + 1], strict=True):
                if b - a > 1:
                    yield {k: v[a:b] for k, v in data.items()}
            nonlocal rest
            rest = None if last else {k: v[ends[-2] :] for k, v in data.items()}

        def answer(data: dict[str, np.ndarray], last: bool) -> Iterator[pa.RecordBatch]:
            found = [p for g in groups(data, last) for p in compare(g) if len(p[0])]
            if found:
                a, b = np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])
                pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])

        for batch in batches:
            data = {k: batch.column(k).to_numpy(zero_copy_only=False) for k in names}
            data["bits"] = batch.column("bits").flatten().to_numpy().view(np.uint64).reshape(-1, LONGS)
            if rest is not None:
                data = {k: np.concatenate([rest[k], data[k]]) for k in data}
            if len(data["token"]):
                yield from answer(data, False)
        if rest is not None:
            yield from answer(rest, True)

    dealt = tiles.repartition("token", "band", "x", "y").sortWithinPartitions("token", "band", "x", "y")
    return dealt.mapInArrow(scan, "a long, b long").distinct()


def _cross_tiles(members: DataFrame, roots: DataFrame, bits: DataFrame) -> DataFrame:
    """Rows of the tiles in which nodes of several roots meet, cut into blocks.

    A tile is a shingle and a size band; a node also goes to the band below its own, where
    it meets smaller sets.  Tiles of more than BLOCK rows are cut by a hash of the node
    and each two blocks meet once.
    """
    rooted = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed = rooted.groupBy("token").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).filter("r0 <> r1")
    placed = rooted.join(mixed.select("token"), "token").select(
        "token", "node", "n", "root",
        F.explode(F.array(F.struct(F.col("band"), F.lit(True).alias("own")),
                          F.struct((F.col("band") - 1).alias("band"), F.lit(False).alias("own")))).alias("p"),
    ).select("token", "node", "n", "root", "p.band", "p.own")
    sizes = placed.groupBy("token", "band").agg(
        F.count("*").alias("size"), F.max("own").alias("any"), F.min("root").alias("r0"), F.max("root").alias("r1")
    ).filter("any and r0 <> r1").select("token", "band", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    cut = placed.join(sizes, ["token", "band"]).withColumn("half", block)
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    each = cut.withColumn("other", other)
    return each.select(
        "token", "band", F.least("half", "other").alias("x"), F.greatest("half", "other").alias("y"),
        "node", "n", "root", "own", "half", (F.least("half", "other") == F.greatest("half", "other")).alias("alone"),
    ).join(bits, "node")


def _salts(spark: SparkSession) -> int:
    """Parts of a group of copies: one a shuffle partition, at least 64."""
    return max(64, int(spark.conf.get("spark.sql.shuffle.partitions")))


def _named(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """``rows`` with ``root`` and ``least``, the smallest ``doc`` of the root's rows; both null without a node.

    A group may hold a third of all rows, as copies in one node or as nodes of one root.  No
    join or aggregate has a whole group under one key: parts of (node, salt) are found
    first, then of (root, salt), and a root's name goes back the same way.
    """
    parts = rows.filter("node is not null").groupBy("node", "salt").agg(F.min("doc").alias("part_least"))
    parts = parts.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    wide = parts.groupBy("root", "salt").agg(F.min("part_least").alias("wide_least"))
    names = wide.groupBy("root").agg(F.min("wide_least").alias("least"))
    wide = wide.select("root", "salt").join(names, "root")
    parts = parts.select("node", "salt", "root").join(wide, ["root", "salt"])
    return rows.join(parts, ["node", "salt"], "left")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc``, ``text_key``, ``n_shingles``, ``root``, ``component_id``.

    ``component_id`` is the smallest key that links of similarity 0.8 or more reach.  Rows
    without words have no ``root``, a component's inner name, and are their own component.  Rows that repeat a key or a
    text are judged row by row; a null key is never a component's name unless all of its
    rows lack a key.  An empty table gives an empty result.
    """
    spark = docs.sparkSession
    folder = work_folder(spark, "ngrams")
    rows = _texts(docs, key, text)
    bitmap, common = _count_shingles(rows, folder)
    salt = F.pmod(F.monotonically_increasing_id(), F.lit(_salts(spark))).cast("int").alias("salt")
    sets = written(_sets(rows, bitmap, common).select("*", salt), f"{folder}/sets")
    partners = sets.filter(F.col("prefix").isNotNull())
    arrays = written(partners.select("node", "bits", "shingles").dropDuplicates(["node"]), f"{folder}/arrays")
    band = F.floor(F.log("n") / BAND).cast("int")
    met = partners.select("node", "n", "lone", F.explode("prefix").alias("token")).groupBy("token", "node").agg(
        F.first("n").alias("n"), F.first("lone").alias("lone")
    )
    several = met.groupBy("token").agg(F.min("node").alias("n0"), F.max("node").alias("n1")).filter("n0 <> n1")
    members = met.join(several.select("token"), "token").withColumn("band", band)
    members = written(members, f"{folder}/members")
    # most links of large groups are found by testing few pairs: first each node meets one
    # other, of the heads of its tiles, the sets with the fewest shingles of their own, that
    # which it shares the most tiles with
    heads = members.groupBy("token", "band").agg(F.min(F.struct("lone", "node")).alias("head"))
    shared = members.join(heads, ["token", "band"]).select(
        F.col("node").alias("b"), F.col("head.node").alias("a")
    ).filter("a <> b").groupBy("b", "a").count()
    pairs = shared.groupBy("b").agg(F.max(F.struct("count", "a")).alias("best")).select(F.col("best.a").alias("a"), "b")
    links = written(_linked(pairs, arrays), f"{folder}/links-0")
    roots = written(components(links, f"{folder}/components-0"), f"{folder}/roots-0")
    # then those in other components meet in their tiles: the nearest, at last all
    for turn, nearest in ((1, True), (2, False)):
        tiles = _cross_tiles(members, roots, arrays.select("node", "bits"))
        pairs = written(_tile_pairs(tiles, nearest), f"{folder}/pairs-{turn}")
        found = written(_linked(pairs, arrays), f"{folder}/links-{turn}")
        # a component is a star: its nodes' links to the root stand for all found before
        links = roots.select(F.col("root").alias("a"), F.col("node").alias("b")).unionByName(found)
        roots = written(components(links, f"{folder}/components-{turn}"), f"{folder}/roots-{turn}")
    named = _named(sets.select("doc", "text_key", "n", "node", "salt"), roots)
    return named.select(
        "doc", "text_key", F.col("n").alias("n_shingles"), "root",
        F.when(F.col("root").isNull(), F.col("doc")).otherwise(F.col("least")).alias("component_id"),
    )


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each component the row with the smallest key.

    Rows without words are no near duplicates: they stay, once per key.  Rows that repeat
    both key and text stay once, too.
    """
    found = written(near_duplicates(docs, key, text), f"{work_folder(docs.sparkSession, 'kept')}/found")
    # rows without words have no root and are told apart by their keys
    group = F.struct("root", F.when(F.col("root").isNull(), F.col("doc")).alias("doc"))
    order = F.struct(F.col("doc").isNull().alias("keyless"), "doc", "text_key")
    best = found.groupBy(group.alias("group")).agg(F.min(order).alias("row"))
    stay = best.select("row.doc", "row.text_key")
    row = lambda other: docs[key].cast("long").eqNullSafe(other["doc"]) & (
        F.xxhash64(docs[text].cast("string")) == other["text_key"]
    )
    many = found.groupBy("doc", "text_key").count().filter("count > 1").select("doc", "text_key")
    if many.isEmpty():
        return docs.join(stay, row(stay), "left_semi")
    alone, repeated = (stay.join(many, stay["doc"].eqNullSafe(many["doc"]) & (stay["text_key"] == many["text_key"]), how)
                       for how in ("left_anti", "left_semi"))
    again = docs.join(repeated, row(repeated), "left_semi").dropDuplicates([key, text])
    return docs.join(alone, row(alone), "left_semi").unionByName(again)


def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shingle count and near-duplicate component."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("doc").alias("doc_id"), "n_shingles", "component_id")


def components_sql(docs: str = "documents") -> str:
    """The same over a table named ``docs`` by comparing all that share a shingle."""
    return rf"""
    WITH RECURSIVE words AS (
      SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^ 	-
]+') AS ws FROM {docs}),
    sets AS (
      SELECT DISTINCT doc_id, unnest(CASE
        WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
        WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS shingle FROM words),
    sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
    met AS (
      SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS same FROM sets a JOIN sets b
      ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
    links AS (
      SELECT x, y FROM met JOIN sizes sx ON x = sx.doc_id JOIN sizes sy ON y = sy.doc_id
      WHERE 100 * same >= 80 * (sx.n + sy.n - same)),
    reached(x, y) AS (
      SELECT doc_id, doc_id FROM {docs} UNION SELECT reached.x, links.y FROM reached JOIN links ON reached.y = links.x)
    SELECT r.x AS doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(r.y) AS component_id
    FROM reached r LEFT JOIN sizes ON sizes.doc_id = r.x GROUP BY r.x"""
