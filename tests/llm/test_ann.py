"""Nearest neighbours against brute force."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from footfall.llm import ann

SF = "/root/testdata/sf0.1"


def brute(ids, vectors, queries, k):
    found = {}
    for q in queries:
        scores = [(-float(np.cumsum(vectors[q] * v)[-1]), i) for i, v in zip(ids, vectors) if i != ids[q]]
        found[ids[q]] = [(i, -s) for s, i in sorted(scores)[:k]]
    return found


def test_recall(spark):
    got = ann.op2_nearest_neighbours(spark, SF).toPandas()
    rows = duckdb.connect().execute(f"SELECT vec_id, embedding FROM '{SF}/embeddings.parquet' ORDER BY vec_id").fetchall()
    ids, vectors = [r[0] for r in rows], np.array([r[1] for r in rows], dtype=np.float64)
    want = brute(ids, vectors, [i for i, v in enumerate(ids) if v % 20 == 0], 20)
    assert set(got.query_id) == set(want)
    hits = 0
    for q, own in got.sort_values("rank").groupby("query_id"):
        assert own["rank"].tolist() == list(range(1, 21))
        assert own.score.is_monotonic_decreasing
        hits += len({v for v, _ in want[q]} & set(own.vec_id))
        exact = dict(want[q])
        assert all(s == exact[v] for v, s in zip(own.vec_id, own.score) if v in exact)
    assert hits >= 0.9 * 20 * len(want)


@pytest.mark.parametrize("copies", [5, 60])
def test_ties_norms_and_odd_vectors(spark, copies, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 8)
    monkeypatch.setattr(ann, "QUERY_BLOCK", 2)
    rng = np.random.default_rng(0)
    good = [rng.normal(size=4).astype(np.float32).tolist() for _ in range(40)] + [[1.0, 2.0, 3.0, 4.0]] * copies + [[10.0, 20.0, 30.0, 40.0]]
    rows = [(i, v, "x", i) for i, v in enumerate(good)]
    bad = [(1000, None), (1020, [0.0] * 4), (1040, [1.0, None, 2.0, 3.0]), (1060, [float("nan")] * 4), (1080, [float("inf")] + [0.0] * 3), (None, [1.0] * 4), (1100, [1.0])]
    rows += [(i, v, "x", 0) for i, v in bad] + [rows[3]]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, list string, id long")
    got = {}
    for r in ann.nearest(table, F.col("vec_id") % 20 == 0, k=12).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    vectors = np.array(good, dtype=np.float64)
    assert got == brute(list(range(len(good))), vectors, [i for i in range(len(good)) if i % 20 == 0], 12)


def test_tight_small_clusters_and_outliers(spark, monkeypatch):
    monkeypatch.setattr(ann, "LIST_ROWS", 16)
    rng = np.random.default_rng(4)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    centres = unit(rng.normal(size=(80, 8)))
    vectors = np.concatenate([np.repeat(centres, 8, axis=0) + rng.normal(size=(640, 8)) * 1e-6, unit(rng.normal(size=(60, 8)))])
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in ann.nearest(table, F.col("vec_id") % 5 == 0).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    want = brute(list(range(len(rows))), vectors, [i for i in range(len(rows)) if i % 5 == 0], 20)
    assert {q: len(own) for q, own in got.items()} == dict.fromkeys(want, 20)
    assert sum(len(got[q] & {v for v, _ in own}) for q, own in want.items()) >= 0.9 * 20 * len(want)


def test_few_and_no_rows(spark):
    table = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5])], "vec_id long, embedding array<double>")
    asked = F.col("vec_id") % 20 == 0
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in ann.nearest(table, asked).collect()] == [(0, 1, 1, 0.5)]
    assert ann.nearest(table.limit(0), asked).count() == 0
    assert ann.nearest(table, F.lit(False)).count() == 0


def test_the_graph_reaches_what_a_scan_finds():
    rng = np.random.default_rng(1)
    centroids, points = rng.normal(size=(300, 8)), rng.normal(size=(50, 8))
    d = np.sqrt(((points[:, None] - centroids[None]) ** 2).sum(axis=2))
    want = d <= 1.3 * d.min(axis=1, keepdims=True)
    (r, c), near = ann.Graph.build(centroids).search(points, 1.3)
    got = np.zeros_like(want)
    got[r, c] = True
    assert (got & want).sum() >= 0.97 * want.sum()
    assert np.allclose(near, d[r, c])


def test_a_repeated_query_key_asks_with_all_its_vectors(spark):
    rng = np.random.default_rng(8)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(200, 6)))]
    twice = [(20, (1e6 * rng.normal(size=6)).tolist()), (20, rng.normal(size=6).tolist()), (40, rows[40][1])]
    want = {}
    for q, x in rows + twice:
        if q % 20 == 0:
            for i, v in rows + twice:
                if i != q:
                    score = float(np.cumsum(np.array(x) * np.array(v))[-1])
                    want.setdefault(q, {})[i] = max(want.get(q, {}).get(i, -np.inf), score)
    for order in (1, -1):
        df = spark.createDataFrame((rows + twice)[::order], "vec_id long, embedding array<double>").repartition(3)
        got = ann.nearest(df, F.col("vec_id") % 20 == 0).collect()
        for q, scores in want.items():
            best = sorted(scores.items(), key=lambda s: (-s[1], s[0]))[:20]
            assert [(r.vec_id, r.score) for r in sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)] == best


def test_products_near_zero_of_long_vectors(spark):
    """Rounding follows the norms, not the products."""
    rng = np.random.default_rng(9)
    q = np.array([1e8, 1e8, 1.0])
    rows = [(0, q.tolist())] + [(i, [1e8, -1e8, float(x)]) for i, x in enumerate(rng.normal(size=60), 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = ann.nearest(df, F.col("vec_id") == 0).orderBy("rank").collect()
    exact = sorted(((-float(np.cumsum(q * np.array(v))[-1]), i) for i, v in rows[1:]))[:20]
    assert [(r.vec_id, r.score) for r in got] == [(i, -s) for s, i in exact]
