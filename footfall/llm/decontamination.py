"""Benchmark decontamination by SimHash windows and a multi-index Hamming search.

A document's windows have the size of a benchmark item.  Each gets a 64-bit SimHash of its
words; the items' fingerprints are indexed in four blocks of 16 bits, each with all keys
up to three bits away.  Two fingerprints at most 15 bits apart agree up to three bits in
some block, so the index finds all within that radius.  What it finds is verified by the
exact similarity of the shingles, weighted by how often they occur.

A fingerprint can differ in more bits although the similarity is reached: edits at an edge
or in a run change up to a ninth of the words, and repeated words weigh more.  A pair that
reaches it shares that part of the item's shingles, so the window has one of the item's
rarest ones, as many as may be missing and one more.  Windows further away than the radius
are found by these, so none is lost.

Windows are laid where they can match: a window that reaches the similarity has a shingle
of the item, so a window begins where the shared shingle has it begin, once per run of
shared shingles.  All others have similarity 0 or less than a neighbour.

Everything is a DataFrame expression.  What is broadcast is counted first: the benchmark's
shingles and the changed keys up to BROADCAST_ROWS rows.  With more, joins shuffle: of a
document its places go, a hash each, and its words once to the windows laid in it.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from footfall.llm.common import lower_ascii, table, work_folder, written
from footfall.llm.licenses import WORD

WORDS, RADIUS, BLOCKS = 5, 15, 4
#: All changes of a 16-bit block by up to RADIUS // BLOCKS bits.
CHANGES = [sum(1 << b for b in bits) for n in range(RADIUS // BLOCKS + 1) for bits in combinations(range(16), n)]
#: Rows of shingles or of changed keys up to which they are broadcast, some 100 bytes each.
BROADCAST_ROWS = 1_000_000
#: Places of a text that are looked up together; more if the longest item has more words.
STRETCH = 512


def _words(text: Column) -> Column:
    return F.regexp_extract_all(lower_ascii(text.cast("string")), F.lit(WORD), F.lit(0))


def _shingles(words: Column, size: Column | int) -> Column:
    """Hashes of the runs of ``size`` words, in order; none if there are fewer words."""
    last = F.size(words) - size
    return F.when(last < 0, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(1), last + 1), lambda i: F.xxhash64(F.slice(words, i, size)))
    )


def _placed(words: Column, size: int, first: Column, most: int) -> Column:
    """``k``, ``p``, ``hash``: the size, place and hash of ``most`` runs of ``size`` words from place ``first`` on."""
    count = F.least(F.size(words) - first - size + 1, F.lit(most))
    run = lambda i: F.struct(F.lit(size).alias("k"), (i - 1).alias("p"), F.xxhash64(F.slice(words, i, size)).alias("hash"))
    return F.when(count < 1, F.array().cast("array<struct<k:int,p:int,hash:bigint>>")).otherwise(
        F.transform(F.sequence(first + 1, first + count), run)
    )


def _stretches(rows: DataFrame, places: int, reach: int) -> DataFrame:
    """``rows`` cut into ``places`` places each: the first of them, ``at``, counted from ``base``, and ``words`` from there on.

    A stretch has ``reach`` words more on either side.  A place that is exploded takes the
    words beside it along: those of its stretch, not those of a whole long text.
    """
    begins = F.sequence(F.lit(0), F.greatest(F.size("words") - 1, F.lit(0)), F.lit(places))
    base = lambda b: F.greatest(b - reach, F.lit(0))
    of = F.transform(begins, lambda b: F.struct(
        base(b).alias("base"), (b - base(b)).alias("at"), F.slice("words", base(b) + 1, b - base(b) + places + reach).alias("words")))
    return rows.select("doc", "text_key", F.explode(of).alias("of")).select("doc", "text_key", "of.base", "of.at", "of.words")


def simhash(words: str) -> Column:
    """64 bits: bit b is set if more of the words' hashes have it than not."""
    return F.expr(f"""
        aggregate(sequence(0, 63), 0L, (all, b) -> all | shiftleft(if(
            aggregate(transform({words}, w -> xxhash64(w)), 0, (s, h) -> s + if((shiftright(h, b) & 1L) = 1L, 1, -1)) > 0,
            1L, 0L), b))""")


def _block_keys(fingerprint: str) -> Column:
    """(block, 16-bit key) of a fingerprint."""
    return F.expr(f"transform(sequence(0, {BLOCKS - 1}), b -> struct(b as block, shiftright({fingerprint}, 16 * b) & 65535L as key))")


def _numbered(hashes: Column) -> Column:
    """The multiset as a set: each occurrence of a hash is hashed with its number."""
    ordered = F.array_sort(hashes)
    return F.transform(ordered, lambda x, i: F.xxhash64(x, i - F.array_position(ordered, x).cast("int")))


def _items(benchmark: DataFrame, item: str, text: str) -> DataFrame:
    words = benchmark.select(F.col(item).alias("item"), _words(F.col(text)).alias("item_words"))
    sized = words.filter(F.size("item_words") > 0).withColumn("n", F.size("item_words"))
    sized = sized.withColumn("k", F.least(F.col("n"), F.lit(WORDS))).distinct()
    return sized.withColumn("print", simhash("item_words")).withColumn("row", F.monotonically_increasing_id())


def _windows(rows: DataFrame, anchors: DataFrame, sizes: list[int], reach: int, few: bool) -> DataFrame:
    """``doc``, ``text_key``, ``start``, ``n``, ``k``, ``window`` of the places where an item may begin.

    Documents are read once for all ``sizes`` of shingles; the longest item has ``reach`` words.  If the anchors are ``few`` they are
    broadcast and windows are cut from the row at hand; else only places and the word
    before them are shuffled, and the texts come once to the starts that are found.
    """
    if not sizes:
        return rows.filter(F.lit(False)).selectExpr("doc", "text_key", "0 as start", "0 as n", "0 as k", "words as window")
    most = max(STRETCH, reach)
    placed = [_placed(F.col("words"), size, F.col("at"), most) for size in sizes]
    places = _stretches(rows, most, reach).select("doc", "text_key", "base", "words", F.explode(F.concat(*placed)).alias("of"))
    ahead = F.when(F.col("of.p") > 0, F.element_at("words", F.col("of.p"))).alias("ahead")
    place = (F.col("base") + F.col("of.p")).alias("p")
    places = places.select("doc", "text_key", *(["base", "words"] if few else []), "of.k", place, "of.hash", ahead)
    met = places.join(F.broadcast(anchors) if few else anchors.hint("merge"), ["k", "hash"])
    # of a run of shared shingles, the first
    met = met.filter((F.col("t") == 0) | (F.col("p") == 0) | (F.col("ahead") != F.col("before")))
    laid = met.withColumn("start", F.greatest(F.col("p") - F.col("t"), F.lit(0)))
    window = F.slice("words", F.col("start") - F.col("base") + 1, F.col("n")).alias("window")
    at = ["doc", "text_key", "start", "n"]
    if few:
        return laid.select(*at, "k", window).groupBy(*at).agg(F.first("k").alias("k"), F.first("window").alias("window"))
    laid = laid.groupBy(*at).agg(F.first("k").alias("k"))
    # a text that repeats under one key is needed once
    keyed = lambda of: of.withColumn("named", F.coalesce(F.col("doc").cast("string"), F.lit(""))).withColumn("keyless", F.col("doc").isNull())
    texts = keyed(rows).drop("doc").dropDuplicates(["named", "keyless", "text_key"])
    window = F.slice("words", F.col("start") + 1, F.col("n")).alias("window")
    return keyed(laid).join(texts, ["named", "keyless", "text_key"]).select(*at, "k", window)


def _changed(keys: DataFrame) -> DataFrame:
    """``keys`` with every key up to RADIUS // BLOCKS bits away in place of each key."""
    changes = F.array(*[F.lit(c).cast("long") for c in CHANGES])
    return keys.withColumn("key", F.explode(F.transform(changes, lambda c: c.bitwiseXOR(F.col("key")))))


def _meeting(windows: DataFrame, items: DataFrame) -> DataFrame:
    """``at``, ``print``, ``row``, ``item_print`` where a window and an item of its size meet in a block.

    The side with fewer rows is the one whose keys are changed.  That side is broadcast up
    to BROADCAST_ROWS changed keys; with more, both are shuffled by size, block and key.
    """
    blocked = lambda of, *kept: of.select(*kept, F.explode(_block_keys("print")).alias("of")).select("*", "of.block", "of.key").drop("of")
    probes = blocked(windows, "at", "n", "print")
    index = blocked(items, "row", "n", "print").withColumnRenamed("print", "item_print")
    n_windows, n_items = windows.count(), items.count()
    changed = min(n_windows, n_items) * BLOCKS * len(CHANGES)
    side = F.broadcast if changed <= BROADCAST_ROWS else lambda of: of.hint("merge")
    if n_items <= n_windows:
        index = side(_changed(index))
    else:
        probes = side(_changed(probes))
    return probes.join(index, ["n", "block", "key"])


def _rare(items: DataFrame, similarity: int) -> DataFrame:
    """``hash``, ``n`` and ``row`` of the rarest shingles of each item, one of which any window that reaches the similarity has."""
    every = items.select("row", "n", "print", F.posexplode(_shingles(F.col("item_words"), F.col("k"))).alias("t", "hash"))
    often = every.groupBy("hash").agg(F.count("*").alias("often"))
    count = F.count("*").over(Window.partitionBy("row"))
    rank = F.row_number().over(Window.partitionBy("row").orderBy("often", "hash", "t"))
    ranked = every.join(often, "hash").select("hash", "n", "row", "print", count.alias("all"), rank.alias("rank"))
    # what is shared is at least this part of all
    kept = ranked.filter(F.col("rank") <= F.col("all") - F.ceil(F.col("all") * similarity / 100) + 1)
    return kept.select("hash", F.col("n").alias("item_n"), "row", F.col("print").alias("item_print")).distinct()


def leaks(
    docs: DataFrame, benchmark: DataFrame, similarity: int = 80, key: str = "doc_id", text: str = "text",
    item: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """``doc``, ``text_key``, ``item``, ``similarity``, ``first_word``, ``places`` of each document and item that it holds.

    Words are runs of letters and digits with A-Z in lower case.  Shingles are of five
    words, or the whole item if it is shorter.  ``similarity`` is in percent: the sum of
    the smaller counts of the shingles over that of the larger ones.  ``first_word`` is
    where the best window begins (the earliest of equals), ``places`` counts the windows
    that reach it.  Documents and items that are null, empty or without words hold and
    match nothing; rows that repeat a key or an item are treated one by one.
    """
    folder = work_folder(docs.sparkSession, "leaks")
    items = written(_items(benchmark, item, item_text), f"{folder}/items")
    longest = {r["k"]: r["n"] for r in items.groupBy("k").agg(F.max("n").alias("n")).collect()}  # five rows at most
    anchors = items.select("n", "k", "item_words", F.posexplode(_shingles(F.col("item_words"), F.col("k"))).alias("t", "hash"))
    anchors = anchors.select("hash", "n", "k", "t", F.when(F.col("t") > 0, F.element_at("item_words", F.col("t"))).alias("before")).distinct()
    anchors = written(anchors, f"{folder}/anchors")
    text_ = F.col(text).cast("string")
    rows = docs.select(F.col(key).alias("doc"), F.xxhash64(text_).alias("text_key"), _words(text_).alias("words"))
    windows = _windows(rows, anchors, sorted(longest), max(longest.values(), default=0), anchors.count() <= BROADCAST_ROWS)
    windows = windows.withColumn("print", simhash("window")).withColumn("at", F.monotonically_increasing_id())
    windows = written(windows, f"{folder}/windows")
    found = _meeting(windows, items)
    apart = F.bit_count(F.col("print").bitwiseXOR(F.col("item_print")))
    found = found.filter(apart <= RADIUS).select("at", "row")
    rare = written(_rare(items, similarity), f"{folder}/rare")
    if rare.count() <= BROADCAST_ROWS:
        rare = F.broadcast(rare)
    parts = windows.select("at", "n", "print", F.explode(F.array_distinct(_shingles(F.col("window"), F.col("k")))).alias("hash"))
    far = parts.join(rare, (parts.n == rare.item_n) & (parts.hash == rare.hash)).filter(apart > RADIUS).select("at", "row")
    # two fingerprints may agree in several blocks, two texts in several shingles
    pairs = found.unionByName(far).distinct().join(windows.drop("n", "print"), "at").join(items.select("row", "item", "item_words"), "row")
    a, b = _numbered(_shingles(F.col("window"), F.col("k"))), _numbered(_shingles(F.col("item_words"), F.col("k")))
    both = F.size(F.array_intersect("a", "b"))
    scored = pairs.select("doc", "text_key", "start", "item", a.alias("a"), b.alias("b")).select(
        "doc", "text_key", "start", "item", both.alias("both"), (F.size("a") + F.size("b") - both).alias("either")
    ).filter(100 * F.col("both") >= similarity * F.col("either"))
    share = (100.0 * F.col("both") / F.col("either")).alias("share")
    best = scored.select("doc", "text_key", "item", "start", share).groupBy("doc", "text_key", "item").agg(
        F.max(F.struct("share", (-F.col("start")).alias("back"))).alias("best"), F.count("*").alias("places")
    )
    return best.select(
        "doc", "text_key", "item", F.round("best.share", 6).alias("similarity"),
        (-F.col("best.back")).cast("long").alias("first_word"), "places",
    )


def drop_leaking(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with their columns."""
    folder = work_folder(docs.sparkSession, "clean")
    found = leaks(docs, benchmark, key=key, text=text, **options).select("doc", "text_key").distinct()
    held = written(found, f"{folder}/held")
    same = docs[key].eqNullSafe(held["doc"]) & (F.xxhash64(docs[text].cast("string")) == held["text_key"])
    return docs.join(held, same, "left_anti")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark item, with the item."""
    found = leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("doc").alias("doc_id"), F.col("item").alias("item_id"), "similarity", "first_word", "places")


def leaks_sql(docs: str = "documents") -> str:
    """The same over a table named ``docs`` with every window verified, without fingerprints."""
    words = rf"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '{WORD}')"""
    runs = "list_transform(range(1, len({0}) - {1} + 2), lambda i: array_to_string({0}[i:i + {1} - 1], ' '))"
    return f"""
    WITH items AS (SELECT item_id, iw, len(iw) AS n, least(len(iw), 5) AS k FROM (SELECT item_id, {words} AS iw FROM benchmark) WHERE len(iw) > 0),
    kept AS (SELECT doc_id, {words} AS ws FROM {docs}),
    anchors AS (SELECT n, k, unnest({runs.format('iw', 'k')}) AS s, unnest(range(0, n - k + 1)) AS t FROM items),
    ks AS (SELECT DISTINCT k FROM items),
    shingles AS (SELECT doc_id, k, unnest({runs.format('ws', 'k')}) AS s, unnest(range(0, len(ws) - k + 1)) AS p FROM kept, ks WHERE len(ws) >= k),
    laid AS (SELECT DISTINCT doc_id, greatest(p - t, 0) AS start, n FROM shingles JOIN anchors USING (k, s)),
    windows AS (SELECT doc_id, start, n, ws[start + 1:start + n] AS win FROM laid JOIN kept USING (doc_id)),
    pairs AS (SELECT doc_id, start, item_id, iw, k, win FROM windows JOIN items USING (n)),
    left_counts AS (SELECT doc_id, start, item_id, s, count(*) AS c FROM (SELECT doc_id, start, item_id, unnest({runs.format('win', 'k')}) AS s FROM pairs) GROUP BY ALL),
    right_counts AS (SELECT item_id, s, count(*) AS c FROM (SELECT item_id, unnest({runs.format('iw', 'k')}) AS s FROM items) GROUP BY ALL),
    met AS (SELECT l.doc_id, l.start, l.item_id, sum(least(l.c, r.c)) AS same FROM left_counts l JOIN right_counts r USING (item_id, s) GROUP BY ALL),
    scored AS (SELECT doc_id, start, item_id, same, greatest(len(win) - k + 1, 0) + len(iw) - k + 1 - same AS either FROM met JOIN pairs USING (doc_id, start, item_id)),
    good AS (SELECT *, 100.0::DOUBLE * same / either AS share FROM scored WHERE 100 * same >= 80 * either)
    SELECT doc_id, item_id, round(max(share), 6) AS similarity, arg_max(start, (share, -start))::BIGINT AS first_word, count(*) AS places
    FROM good GROUP BY doc_id, item_id"""
