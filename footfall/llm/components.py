"""Connected components of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import written


def _state(edges: DataFrame) -> tuple[int, int]:
    mixed = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count("*"), mixed).first())


def components(links: DataFrame, folder: str) -> DataFrame:
    """``node`` and ``root``, the smallest node that it reaches, for every node in ``links`` (a, b).

    Each round hangs all larger neighbours of a node on its smallest neighbour, then all
    smaller ones; links never grow in number, and a chain of n nodes takes about log n
    rounds.  Rounds are written to ``folder``, so lineage stays short.  Minima are taken
    before the shuffle, so a node with very many links is no hot key there.
    """
    oriented = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    edges = written(oriented, f"{folder}/edges-0")
    before, turn = _state(edges), 0
    while True:
        turn += 1
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("low")).withColumn("low", F.least("a", "low"))
        large = both.join(lowest, "a").filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = large.filter("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        small = small.unionByName(low.select("a", F.col("low").alias("b"))).filter("a <> b").distinct()
        edges = written(small, f"{folder}/edges-{turn}")
        after = _state(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
