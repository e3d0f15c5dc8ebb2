"""Nearest neighbours by inner product over balanced posting lists.

Centroids are fitted on a bounded sample; every vector is posted to the list of its nearest
centroid and, if it lies near a boundary, to those of others almost as near.  Long lists are
cut into blocks of even size.  A query walks a graph of the centroids in memory and reads
the lists whose distance is within a ratio of the nearest one's; where these hold too few
rows, the ratio is taken of the distance up to which lists hold enough.  Blocks of queries meet
blocks of postings in tiles, where products are taken in double precision.

Inner products become distances by one more coordinate: with M the largest norm, a vector
x gets sqrt(M*M - |x|*|x|) and a query 0, and the nearest is the one with the largest product.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from footfall.llm.common import table, work_folder, written

#: Rows of a list per centroid that are aimed at, and the most centroids and sample rows.
LIST_ROWS, MOST_LISTS, SAMPLE = 512, 1024, 16_384
#: Rows and queries of a tile.
BLOCK, QUERY_BLOCK = 4096, 512
LINKS, BEAM = 12, 8
#: Rows of results that a task merges, about 24 bytes each.
HELD_ROWS = 1_000_000


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def _parts(batches: Iterator[pa.RecordBatch], rows: int = 2048) -> Iterator[pa.RecordBatch]:
    return (batch.slice(a, rows) for batch in batches for a in range(0, batch.num_rows, rows))


def _lifted(x: np.ndarray, most: float) -> np.ndarray:
    rest = np.sqrt(np.maximum(most * most - (x * x).sum(axis=1), 0))
    return np.concatenate([x, rest[:, None]], axis=1)


@dataclass
class Graph:
    """Centroids, each linked with its nearest and with a few far ones."""

    centroids: np.ndarray
    links: np.ndarray  # centroid by link

    @classmethod
    def build(cls, centroids: np.ndarray, seed: int = 5) -> Graph:
        k = len(centroids)
        d = ((centroids[:, None] - centroids[None]) ** 2).sum(axis=2) if k <= 256 else (
            (centroids**2).sum(axis=1)[:, None] - 2 * centroids @ centroids.T + (centroids**2).sum(axis=1)
        )
        np.fill_diagonal(d, np.inf)
        near = np.argsort(d, axis=1)[:, : min(LINKS, k - 1)]
        ring = np.stack([(np.arange(k) + 1) % k, np.random.default_rng(seed).permutation(k)], axis=1)  # reaches all
        return cls(centroids, np.concatenate([near, ring], axis=1))

    def search(self, points: np.ndarray, ratio: float) -> tuple[np.ndarray, np.ndarray]:
        """Points and centroids whose distance is within ``ratio`` of the least seen; distances.

        The walk opens the links of centroids within the ratio, and of the BEAM nearest seen.
        """
        count, k = len(points), len(self.centroids)
        d = np.full((count, k), np.inf)
        opened = np.zeros((count, k), dtype=bool)
        norms, own = (self.centroids**2).sum(axis=1), (points**2).sum(axis=1)
        rows, cols = np.arange(count), np.zeros(count, dtype=np.int64)
        while len(rows):
            for a in range(0, len(rows), 1 << 16):
                r, c = rows[a : a + (1 << 16)], cols[a : a + (1 << 16)]
                d[r, c] = np.sqrt(np.maximum(own[r] - 2 * np.einsum("ij,ij->i", points[r], self.centroids[c]) + norms[c], 0))
            best = d.min(axis=1)
            beam = np.partition(d, min(BEAM, k) - 1, axis=1)[:, min(BEAM, k) - 1]
            open_now = (d <= np.maximum(best * ratio, beam)[:, None]) & np.isfinite(d) & ~opened
            opened |= open_now
            r, c = np.nonzero(open_now)
            seen = np.zeros((count, k), dtype=bool)
            seen[np.repeat(r, self.links.shape[1]), self.links[c].ravel()] = True
            rows, cols = np.nonzero(seen & np.isinf(d))
        hit = d <= (d.min(axis=1) * ratio)[:, None]
        r, c = np.nonzero(hit)
        return np.stack([r, c]), d[r, c]


def balanced_centroids(sample: np.ndarray, k: int, rounds: int = 12, seed: int = 3) -> np.ndarray:
    """k-means whose assignment pays for the size that a cluster has, so that sizes even out."""
    rng = np.random.default_rng(seed)
    centroids = sample[rng.choice(len(sample), k, replace=False)].copy()
    sizes = np.zeros(k)
    for _ in range(rounds):
        d = (centroids**2).sum(axis=1) - 2 * sample @ centroids.T
        price = 0.1 * np.abs(d - d.mean(axis=1, keepdims=True)).mean() * k / len(sample)
        nearest = (d + price * sizes).argmin(axis=1)
        sizes = np.bincount(nearest, minlength=k).astype(float)
        sums = np.stack([np.bincount(nearest, sample[:, j], k) for j in range(sample.shape[1])], axis=1)
        centroids = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], centroids)
    return centroids


def _covering(points: np.ndarray, centroids: np.ndarray, sizes: np.ndarray, enough: int, ratio: float) -> tuple[np.ndarray, np.ndarray]:
    """Points and centroids within ``ratio`` of the distance up to which lists hold ``enough`` keys; all if none do."""
    squares = (points**2).sum(axis=1)[:, None] - 2 * points @ centroids.T + (centroids**2).sum(axis=1)
    d = np.sqrt(np.maximum(squares, 0))
    order = np.argsort(d, axis=1)
    held = np.cumsum(sizes[order], axis=1) >= enough
    reach = np.where(held.any(axis=1), d[np.arange(len(d)), order[np.arange(len(d)), held.argmax(axis=1)]] * ratio, np.inf)
    return np.nonzero(d <= reach[:, None])


def _valid(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """Keyed vectors with finite components that are not all zero."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    ok = F.col(key).isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0)
    return vectors.filter(ok).select(F.col(key).cast("long").alias("id"), v.alias("v"))


def _norm(v: str) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def _tile_products(tiles: DataFrame, width: int, most: int) -> DataFrame:
    """In each tile, of every query its best postings with their products."""

    def best(data: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
        asks = data["side"] == 1
        q, v, qid, vid = data["v"][asks], data["v"][~asks], data["id"][asks], data["id"][~asks]
        if not len(q) or not len(v):
            return None
        rough = q @ v.T
        rough[qid[:, None] == vid[None]] = -np.inf
        keys = np.unique(vid)
        if len(keys) > most:
            each = rough
            if len(keys) < len(v):  # rows that repeat a key count once
                order = np.argsort(vid, kind="stable")
                each = np.maximum.reduceat(rough[:, order], np.searchsorted(vid[order], keys), axis=1)
            # rounding may differ from the exact sums by far less than this
            floor = -np.partition(-each, most - 1, axis=1)[:, most - 1]
            slack = 1e-12 * np.linalg.norm(q, axis=1) * np.linalg.norm(v, axis=1).max()
        else:
            floor, slack = np.full(len(q), -np.inf), np.zeros(len(q))
        r, c = np.nonzero((rough >= (floor - slack)[:, None]) & np.isfinite(rough))
        # component after component, as a reader would add them
        score = np.cumsum(q[r] * v[c], axis=1)[:, -1] if len(r) else np.zeros(0)
        return first_of_each(qid[r], vid[c], score)

    def first_of_each(q: np.ndarray, v: np.ndarray, score: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The best of each query; a key that several lists or rows hold counts once, with its best product."""
        order = np.lexsort((-score, v, q))
        q, v, score = q[order], v[order], score[order]
        new = np.concatenate([[True], (q[1:] != q[:-1]) | (v[1:] != v[:-1])])[: len(q)]
        q, v, score = q[new], v[new], score[new]
        order = np.lexsort((v, -score, q))
        q, v, score = q[order], v[order], score[order]
        keep = np.arange(len(q)) - np.searchsorted(q, q, "left") < most
        return q[keep], v[keep], score[keep]

    def merged(held: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return first_of_each(*(np.concatenate([h[i] for h in held]) for i in range(3)))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest, held, size = None, [], 0
        record = lambda rows: pa.RecordBatch.from_arrays([pa.array(x) for x in rows], names=["query", "id", "score"])

        def tiles_of(batch: pa.RecordBatch | None) -> Iterator[dict[str, np.ndarray]]:
            nonlocal rest
            if batch is None:
                if rest is not None and len(rest["id"]):
                    yield rest
                return
            data = {k: batch.column(k).to_numpy(zero_copy_only=False) for k in ("list", "x", "y", "side", "id")}
            data["v"] = _matrix(batch.column("v"), width)
            if rest is not None:
                data = {k: np.concatenate([rest[k], data[k]]) for k in data}
            keys = np.stack([data[k] for k in ("list", "x", "y")])
            cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist()]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                yield {k: x[a:b] for k, x in data.items()}
            rest = {k: x[cuts[-1] :] for k, x in data.items()}

        # the tiles of a partition are merged before they leave it, in bounded memory
        for batch in chain(batches, [None]):
            for found in map(best, tiles_of(batch)):
                if found is not None:
                    held.append(found)
                    size += len(found[0])
                if size > 2 * HELD_ROWS:
                    held = [merged(held)]
                    size = len(held[0][0])
                    if size > HELD_ROWS:
                        yield record(held[0])
                        held, size = [], 0
        if held:
            yield record(merged(held))

    dealt = tiles.repartition("list", "x", "y").sortWithinPartitions("list", "x", "y")
    return dealt.mapInArrow(scan, "query long, id long, score double")


def _blocks(rows: DataFrame, size: int) -> DataFrame:
    return rows.groupBy("list").agg(F.ceil(F.count("*") / size).cast("int").alias("blocks"))


def nearest(
    vectors: DataFrame, queries: Column, k: int = 20, key: str = "vec_id", vector: str = "embedding",
    replicate: float = 1.05, copies: int = 2, prune: float = 1.2,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` of the ``k`` nearest found to each row that ``queries`` holds for.

    Vectors that are null, zero or hold null or non-finite components take no part, nor
    do rows without key or of another length than most.  Ties in the product go to the
    smaller key.  Rows that repeat a key count once, with their best product, and a query key that is
    repeated asks with all of its vectors.  A vector is
    posted to at most ``copies`` lists within ``replicate`` times its least distance, a
    query reads all lists within ``prune`` times its own, or, if those hold less than twice
    ``k`` keys, times the distance up to which lists hold that many; no list is cut short.
    So a query gets ``k`` rows whenever there are as many other keys.  The
    centroids are fitted on about SAMPLE vectors drawn by a hash of their keys.
    """
    spark = vectors.sparkSession
    folder = work_folder(spark, "ann")
    valid = _valid(vectors, key, vector)
    shapes = valid.groupBy(F.size("v").alias("width")).agg(F.count("*").alias("n"), F.max(_norm("v")).alias("norm"))
    shape = shapes.orderBy(F.desc("n"), "width").first()
    if shape is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    width, count, most = shape
    valid = valid.filter(F.size("v") == width)
    draw = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < F.lit(min(1.0, SAMPLE / count) * (1 << 30))
    drawn = valid.filter(draw).select("id", "v").toArrow().sort_by("id")
    sample = np.array(drawn["v"].to_pylist(), dtype=np.float64).reshape(-1, width)
    if not len(sample):
        sample = np.array([valid.first()["v"]], dtype=np.float64)
    lists = max(1, min(MOST_LISTS, -(-count // LIST_ROWS), len(sample) // 16))
    graph = Graph.build(balanced_centroids(_lifted(sample, most), lists))
    shared = spark.sparkContext.broadcast(graph)  # MOST_LISTS centroids at most

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches):
            (r, c), d = shared.value.search(_lifted(_matrix(batch.column("v"), width), most), replicate)
            order = np.lexsort((d, r))
            place = np.arange(len(r)) - np.searchsorted(r[order], r[order], "left")
            keep = order[place < copies]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c[keep].astype(np.int32)), *batch.select(["id", "v"]).take(pa.array(r[keep])).columns], names=["list", "id", "v"]
            )

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches):
            x = _matrix(batch.column("v"), width)
            # on the sphere of radius M, where all lifted vectors lie
            x = np.concatenate([x * (most / np.sqrt((x * x).sum(axis=1)))[:, None], np.zeros((len(x), 1))], axis=1)
            (r, c), _ = shared.value.search(x, prune)
            short = np.flatnonzero(np.bincount(r, homes[c], len(x)) < enough)
            if len(short):
                more_r, more_c = _covering(x[short], shared.value.centroids, homes, enough, prune)
                kept = ~np.isin(r, short)
                r, c = np.concatenate([r[kept], short[more_r]]), np.concatenate([c[kept], more_c])
            yield pa.RecordBatch.from_arrays(
                [pa.array(c.astype(np.int32)), *batch.select(["id", "v"]).take(pa.array(r)).columns], names=["list", "id", "v"]
            )

    kind = f"list int, id long, v {valid.schema['v'].dataType.simpleString()}"
    postings = written(valid.mapInArrow(post, kind), f"{folder}/postings")
    # each key counts in one of its lists, so that sums over lists are of different keys
    homes, enough = np.zeros(lists), 2 * (k + 1)
    for row in postings.groupBy("id").agg(F.min("list").alias("list")).groupBy("list").count().collect():  # a row a list
        homes[row["list"]] = row["count"]
    asking = _valid(vectors.filter(F.coalesce(queries, F.lit(False))), key, vector).filter(F.size("v") == width).dropDuplicates(["id", "v"])
    probes = written(asking.mapInArrow(ask, kind), f"{folder}/probes")
    cut = _blocks(postings, BLOCK).join(_blocks(probes, QUERY_BLOCK).withColumnRenamed("blocks", "asked"), "list")
    cut = written(cut, f"{folder}/cut")  # a row a list
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = lambda n, *of: F.pmod(F.xxhash64(*of), F.col(n)).cast("int")
    tiles = postings.join(cut, "list").select("list", own("blocks", "id", "v").alias("x"), all_of("asked").alias("y"), F.lit(0).alias("side"), "id", "v")
    tiles = tiles.unionByName(
        probes.join(cut, "list").select("list", own("asked", "id", "v").alias("y"), all_of("blocks").alias("x"), F.lit(1).alias("side"), "id", "v")
    )
    found = _tile_products(tiles, width, k).groupBy("query", "id").agg(F.max("score").alias("score"))
    return top_ranked(found, k)


def top_ranked(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best rows of each query; a task passes on ``k`` rows of a query at the most."""
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "id"))
    ranked = found.withColumn("rank", rank).filter(F.col("rank") <= k)
    return ranked.select(F.col("query").alias("query_id"), "rank", F.col("id").alias("vec_id"), "score")


def op2_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every vector whose id is divisible by 20, among all others."""
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
