"""Conversation prefix trie: which conversations start alike, and what sharing their starts saves.

Conversations are rebuilt, cut into segments, sorted by their turns into range shards, and
each shard builds a ternary search tree: turns are dictionary-encoded, different sequences
inserted median first, so that the search among siblings is balanced, and one traversal
without recursion adds up members, leaves and savings.  A node that no other shard can hold
is final.  The others, which the first or the last sequence of a shard passes, are merged by
their ids, and their subtrees summed by pointer doubling.

No conversation is ever held whole.  Its order is a running count over row-balanced cuts, and
it is cut into segments of 64 turns; a segment's tree hangs below its *context*, the id of
the node that the turns before it lead to.  A node's id is its depth and a sum of 128-bit
hashes of its turns at their depths, so that a context is a running sum, too.  The chance
that two of n nodes share an id is about n*n/2**129.  Conversations that are all alike are
dealt to shards by ``conv_id``; only their node's hash of all members is one pass, a stream
of numbers that keeps none of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from struct import Struct

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm.common import table, work_folder, written
from footfall.operators.cuts import ordered_cuts, running_before, running_sum

#: A conversation starts with so many turns, at most, of the first of its group of ``GROUP``.
SHARED, GROUP = 8, 5
#: Turns of a segment, turns that shards are sorted by, and turns and segments of a shard.
SEGMENT, SORTED, SHARD = 64, 8, 200_000
EMPTY = hashlib.sha256().hexdigest()
_PIECES = Struct(">4I")
_ROOT = "0" * 32


def turns(conversations: DataFrame) -> DataFrame:
    """``conv``, ``pos`` (from 1), ``digest`` of role and text, ``bytes`` of the text.

    Turns are in order of ``turn``, nulls first; those of one number in the order of their
    digests.  Null roles and texts are empty; rows without ``conv_id`` belong to none.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"), digest.alias("digest"),
        F.octet_length(text).cast("long").alias("bytes"), F.monotonically_increasing_id().alias("copy"),
    )
    order = ["turn", "digest", "copy"]
    cuts = ordered_cuts(rows, ["conv", *order], "llm-turns")
    numbered = running_before(cuts, ["conv"], order, {"before": (F.sum, F.lit(1))}, {"before": running_sum})
    return numbered.select("conv", (F.col("before") + 1).cast("long").alias("pos"), "digest", "bytes")


def rebuilt(own: DataFrame) -> DataFrame:
    """Turns of the rebuilt conversations: ``conv``, ``depth`` (from 1), ``digest``, ``bytes`` and ``total``, their number.

    Each conversation also has a row of depth 0.
    """
    heads = own.filter(F.col("pos") <= SHARED).groupBy(F.col("conv").alias("base")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "digest", "bytes"))).alias("head")  # 8 at most
    )
    convs = own.groupBy("conv").agg(F.max("pos").alias("size"))
    h = F.crc32(F.col("conv").cast("string")) % (SHARED + 1)
    convs = convs.select("conv", "size", (F.col("conv") - F.col("conv") % GROUP).alias("base"), h.cast("int").alias("h"))
    head = F.when(F.col("head").isNotNull() & (F.col("h") > 0), F.slice("head", 1, F.greatest("h", F.lit(1))))
    planned = convs.join(heads, "base", "left").withColumn("head", head)
    shared = F.coalesce(F.size("head"), F.lit(0))
    shared = F.when(F.col("head").isNull(), 0).otherwise(shared)
    plan = planned.select(
        "conv", "h", "head", shared.alias("shared"), (shared + F.greatest(F.col("size") - F.col("h"), F.lit(0))).alias("total")
    )
    no = F.lit(None)
    tops = plan.select("conv", F.lit(0).cast("long").alias("depth"), no.cast("string").alias("digest"), no.cast("long").alias("bytes"), "total")
    first = plan.select("conv", "total", F.posexplode("head").alias("at", "t")).select(
        "conv", (F.col("at") + 1).cast("long").alias("depth"), "t.digest", "t.bytes", "total"
    )
    rest = own.join(plan.select("conv", "h", "shared", "total"), "conv").filter(F.col("pos") > F.col("h")).select(
        "conv", (F.col("pos") - F.col("h") + F.col("shared")).alias("depth"), "digest", "bytes", "total"
    )
    return tops.unionByName(first).unionByName(rest)


def _contexts(rows: DataFrame) -> DataFrame:
    """Of each segment behind the first the sum of the hashes of all turns before: ``conv``, ``layer``, ``context``."""
    digest = F.md5(F.concat(F.col("depth").cast("string"), F.lit(":"), F.col("digest")))
    pieces = [f"p{i}" for i in range(4)]
    parts = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(p) for i, p in enumerate(pieces)]
    hashed = rows.filter((F.col("total") > SEGMENT) & (F.col("depth") > 0)).select("conv", "layer", *parts)
    sums = hashed.groupBy("conv", "layer").agg(*[F.sum(p).alias(p) for p in pieces])
    cuts = ordered_cuts(sums, ["conv", "layer"], "llm-contexts")
    before = [f"before_{p}" for p in pieces]
    carried = running_before(
        cuts, ["conv"], ["layer"], {b: (F.sum, F.col(p)) for b, p in zip(before, pieces)},
        {b: running_sum for b in before},
    )
    context = F.concat(*[F.lpad(F.lower(F.hex(F.col(b) % (1 << 32))), 8, "0") for b in before])
    return carried.filter("layer > 0").select("conv", "layer", context.alias("context"))


def segments(own: DataFrame, folder: str) -> DataFrame:
    """``conv``, ``layer``, ``context``, ``turns`` (64 at most), ``ends`` if it is the conversation's last, ``head`` to sort by."""
    layer = F.expr(f"(greatest(depth, 1) - 1) div {SEGMENT}")
    rows = rebuilt(own).withColumn("layer", layer)
    turn = F.when(F.col("depth") > 0, F.struct("depth", "digest", "bytes"))
    grouped = rows.groupBy("conv", "layer").agg(F.max("total").alias("total"), F.sort_array(F.collect_list(turn)).alias("turns"))
    placed = grouped.join(_contexts(rows), ["conv", "layer"], "left")
    return written(placed.select(
        "conv", "layer", F.coalesce("context", F.lit(_ROOT)).alias("context"),
        F.col("turns.digest").alias("digests"), F.col("turns.bytes").alias("bytes"),
        (F.expr(f"(greatest(total, 1) - 1) div {SEGMENT}") == F.col("layer")).alias("ends"),
        F.array_join(F.slice("turns.digest", 1, SORTED), "").alias("head"),
    ), f"{folder}/segments")


class SearchTree:
    """A ternary search tree of sequences of codes; a node stands for a sequence that others start with."""

    def __init__(self):
        self.code, self.low, self.high, self.down, self.up = [], [], [], [], []
        self.top = -1

    def insert(self, sequence: tuple[int, ...]) -> list[int]:
        """The nodes of the sequence's beginnings, shortest first."""
        path, parent = [], -1
        for code in sequence:
            links, place = (None, None), self.top if parent < 0 else self.down[parent]
            while place >= 0 and self.code[place] != code:
                side = self.low if code < self.code[place] else self.high
                links, place = (side, place), side[place]
            if place < 0:
                place = len(self.code)
                for column, value in ((self.code, code), (self.low, -1), (self.high, -1), (self.down, -1), (self.up, parent)):
                    column.append(value)
                if links[0] is not None:
                    links[0][links[1]] = place
                elif parent < 0:
                    self.top = place
                else:
                    self.down[parent] = place
            path.append(place)
            parent = place
        return path


def median_first(items: list) -> Iterator:
    """A sorted list's middle, then the middles of both halves, and so on."""
    spans = [(0, len(items))]
    while spans:
        a, b = spans.pop()
        if a < b:
            middle = (a + b) // 2
            yield items[middle]
            spans += [(middle + 1, b), (a, middle)]


NODES = (
    "shard int, id string, parent string, depth long, final boolean, conv long, n long, bytes long, "
    "children long, leaves long, saved long, parent_conv long, ends string"
)


def _shard_nodes(shard: int, rows: list[tuple]) -> Iterator[tuple]:
    """The nodes of a shard's sorted segments, as rows of ``NODES``.

    Figures of final nodes are whole.  Those of the others are this shard's share: members,
    and what their final children have; ``ends`` are the members that end there.
    """
    groups = {g: i for i, g in enumerate(dict.fromkeys((r[1], r[2]) for r in rows))}
    words = sorted({d for r in rows for d in r[3]})
    codes = {d: i for i, d in enumerate(words)}
    encode = lambda r: (groups[r[1], r[2]], *(codes[d] for d in r[3]))
    members: dict[tuple, list[tuple]] = {}
    for r in rows:
        members.setdefault(encode(r), []).append(r)
    tree, ends, n, conv, size, shared = SearchTree(), {}, [], [], [], []
    for sequence in median_first(sorted(members)):
        alike = members[sequence]
        path, least = tree.insert(sequence), min(r[0] for r in alike)
        new = len(tree.code) - len(n)
        for column, value in ((n, 0), (conv, least), (size, 0), (shared, False)):
            column += [value] * new
        sizes = alike[0][4]
        for depth, v in enumerate(path):
            n[v] += len(alike)
            conv[v] = min(conv[v], least)
            size[v] = sizes[depth - 1] if depth else 0
        ending = sorted(r[0] for r in alike if r[5])
        if ending:
            ends[path[-1]] = ending
        if len(ending) < len(alike):  # goes on in another segment
            shared[path[-1]] = True
    count = len(n)
    whole = [False] * count  # below the turns that shards are sorted by: all of it may be shared
    for r in (rows[0], rows[-1]):
        path = tree.insert(encode(r)[: SORTED + 1])
        for v in path:
            shared[v] = True
        if len(path) == SORTED + 1:
            whole[path[-1]] = True
    names, ids, depths = list(groups), [None] * count, [0] * count
    for v in range(count):  # parents come before their children
        parent = tree.up[v]
        if parent < 0:
            layer, context = names[tree.code[v]]
            depths[v], ids[v], shared[v] = layer * SEGMENT, _PIECES.unpack(bytes.fromhex(context)), True
        else:
            depths[v] = depths[parent] + 1
            step = _PIECES.unpack(hashlib.md5(f"{depths[v]}:{words[tree.code[v]]}".encode()).digest())
            ids[v] = tuple((a + b) % (1 << 32) for a, b in zip(ids[parent], step))
            whole[v] = whole[v] or whole[parent]
        shared[v] = shared[v] or whole[v]
    children, leaves, saved = [0] * count, [0] * count, [0] * count
    for v in range(count - 1, -1, -1):
        parent = tree.up[v]
        if shared[v]:
            if parent >= 0:
                shared[parent] = True
            continue
        leaves[v] += children[v] == 0
        saved[v] += (n[v] - 1) * size[v]
        children[parent] += 1
        leaves[parent] += leaves[v]
        saved[parent] += saved[v]
    name = lambda v: f"{depths[v]}:{_PIECES.pack(*ids[v]).hex()}"
    for v in range(count):
        parent, text = tree.up[v], ",".join(map(str, ends.get(v, [])))
        # a segment's top counts as a member's end of the segment before
        own = 0 if parent < 0 and depths[v] else n[v]
        known = conv[parent] if parent >= 0 and not shared[parent] else None
        mark = (text or None) if shared[v] else hashlib.sha256(text.encode()).hexdigest()
        yield (shard, name(v), name(parent) if parent >= 0 else None, depths[v], not shared[v], conv[v], own, size[v],
               children[v], leaves[v], saved[v], known, mark)


def _nodes(cut: DataFrame) -> DataFrame:
    """The nodes of all shards."""
    names = [f.split()[0] for f in NODES.split(", ")]
    kinds = {"int": pa.int32(), "string": pa.string(), "long": pa.int64(), "boolean": pa.bool_()}
    types = [kinds[f.split()[1]] for f in NODES.split(", ")]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = ("conv", "layer", "context", "digests", "bytes", "ends")
        rows = [r for b in batches for r in zip(*(b.column(c).to_pylist() for c in wanted), strict=True)]
        if not rows:
            return
        held = []

        def frame() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types, strict=True)], names=names)

        for node in _shard_nodes(TaskContext.get().partitionId(), rows):
            held.append(node)
            if len(held) == 20_000:
                yield frame()
                held = []
        if held:
            yield frame()

    return cut.mapInArrow(build, NODES)


def _hashes(chunks: DataFrame) -> DataFrame:
    """``id`` and the SHA-256 of its chunks in the order of their shards, in one pass that keeps none."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, None
        give = lambda: pa.RecordBatch.from_arrays([pa.array([current]), pa.array([state.hexdigest()])], names=["id", "ends_sha256"])
        for batch in batches:
            for id_, text in zip(batch.column("id").to_pylist(), batch.column("ends").to_pylist(), strict=True):
                if id_ == current:
                    state.update(b",")
                else:
                    if current is not None:
                        yield give()
                    current, state = id_, hashlib.sha256()
                state.update(text.encode())
        if current is not None:
            yield give()

    dealt = chunks.select("id", "shard", "ends").repartition("id").sortWithinPartitions("id", "shard")
    return dealt.mapInArrow(digest, "id string, ends_sha256 string")


def _subtrees(merged: DataFrame, folder: str) -> DataFrame:
    """``id`` with ``leaves`` and ``saved`` summed over its subtree, by pointer doubling.

    Each round a node adds what the nodes have whose pointer leads to it, and a pointer goes
    twice as far; so a path of n nodes takes about log n rounds.
    """
    turn, state = 0, written(merged.select("id", F.col("parent").alias("up"), "leaves", "saved"), f"{folder}/subtrees-0")
    while not state.filter("up IS NOT NULL").isEmpty():
        turn += 1
        gained = state.filter("up IS NOT NULL").groupBy(F.col("up").alias("id")).agg(
            F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved")
        )
        further = state.select(F.col("id").alias("up"), F.col("up").alias("next"))
        grown = state.join(gained, "id", "left").join(further, "up", "left").select(
            "id", F.col("next").alias("up"), (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
            (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"),
        )
        state = written(grown, f"{folder}/subtrees-{turn}")
    return state.select("id", "leaves", "saved")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node: ``conv_id``, ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens``, ``ends_sha256``.

    Rows without ``conv_id`` belong to no conversation, rows that repeat a turn are turns of
    their own, and an empty table has no node.  ``c - c % 5`` rounds towards zero.
    """
    spark, folder = conversations.sparkSession, work_folder(conversations.sparkSession, "trie")
    own = written(turns(conversations), f"{folder}/turns")
    cut = segments(own, folder)
    size = cut.agg(F.sum(F.size("digests") + 1)).first()[0] or 0
    key = ["layer", "context", "head", "conv"]
    dealt = cut.repartitionByRange(int(-(-size // SHARD)) or 1, *key).sortWithinPartitions(*key)
    nodes = written(_nodes(dealt), f"{folder}/nodes")
    shared = nodes.filter("NOT final")
    merged = shared.groupBy("id").agg(
        F.max("parent").alias("parent"), F.max("depth").alias("depth"), F.min("conv").alias("conv"), F.sum("n").alias("n"),
        F.max("bytes").alias("bytes"), *[F.sum(c).alias(c) for c in ("children", "leaves", "saved")],
    )
    merged = written(merged, f"{folder}/merged")
    kids = merged.groupBy(F.col("parent").alias("id")).agg(F.count("*").alias("kids"))
    n_children = F.col("children") + F.coalesce("kids", F.lit(0))
    whole = merged.join(kids, "id", "left").withColumn("n_children", n_children)
    whole = whole.withColumn("leaves", F.col("leaves") + F.when(F.col("n_children") == 0, 1).otherwise(0))
    whole = whole.withColumn("saved", F.col("saved") + (F.col("n") - 1) * F.col("bytes"))
    sums = _subtrees(whole, folder)
    above = merged.select(F.col("id").alias("parent"), F.col("conv").alias("parent_conv"))
    first = whole.drop("leaves", "saved").join(sums, "id").join(above, "parent", "left").join(
        _hashes(shared.filter("ends IS NOT NULL")), "id", "left"
    ).withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(EMPTY)))
    inner = nodes.filter("final").withColumnsRenamed({"children": "n_children", "ends": "ends_sha256"})
    # a top node may have very many final children: each shard's meet its own copy of it
    tops = shared.select("id", "shard").distinct().join(merged.select("id", F.col("conv").alias("top_conv")), "id")
    below = inner.filter("parent_conv IS NULL").join(tops.withColumnRenamed("id", "parent"), ["parent", "shard"])
    out = [
        F.col("conv").alias("conv_id"), "depth", F.col("parent_conv").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.col("n_children").cast("long").alias("n_children"), F.col("leaves").cast("long").alias("n_leaves"),
        F.col("saved").cast("long").alias("saved_tokens"), "ends_sha256",
    ]
    inside = inner.filter("parent_conv IS NOT NULL").select(*out)
    return inside.unionByName(below.withColumn("parent_conv", F.col("top_conv")).select(*out)).unionByName(first.select(*out))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all rebuilt ``conversations``."""
    return prefix_trie(table(spark, sf_dir, "conversations"))


def trie_sql() -> str:
    """The same from lists of turns."""
    # CRC-32, byte by byte and bit by bit
    bits = "list_reduce([xor(x, y)] || range(8)::BIGINT[], lambda s, i: xor(s >> 1, 3988292384 * (s & 1)))"
    crc = f"xor(list_reduce([4294967295] || list_transform(string_split(c::VARCHAR, ''), lambda a: ascii(a)::BIGINT), lambda x, y: {bits}), 4294967295)"
    return f"""
    WITH rows_ AS (SELECT conv_id AS c, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations WHERE conv_id IS NOT NULL),
    own AS (SELECT c, list({{'r': r, 't': t}} ORDER BY turn NULLS FIRST, md5(length(r) || ':' || r || t)) AS ts FROM rows_ GROUP BY c),
    planned AS (SELECT c, ts, c - c % {GROUP} AS base, {crc} % {SHARED + 1} AS h FROM own),
    rebuilt AS (SELECT p.c, coalesce(b.ts[1:h], []) || p.ts[h + 1:] AS ts FROM planned p LEFT JOIN own b ON b.c = p.base),
    starts AS (SELECT c, ts, unnest(range(0, len(ts) + 1)) AS d FROM rebuilt),
    nodes AS (SELECT d, ts[1:d] AS path, min(c) AS conv_id, count(*) AS n,
      sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (len(ts) = d), '')) AS ends_sha256
      FROM starts GROUP BY ALL),
    kids AS (SELECT path[1:d - 1] AS path, d - 1 AS d, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL),
    figures AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children,
      CASE WHEN d = 0 THEN 0 ELSE (n - 1) * strlen(path[d].t) END AS saved FROM nodes LEFT JOIN kids USING (d, path)),
    below AS (SELECT k AS d, path[1:k] AS path, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved) AS saved_tokens
      FROM figures, unnest(range(0, d + 1)) AS u(k) GROUP BY ALL)
    SELECT f.conv_id, f.d AS depth, p.conv_id AS parent_conv_id, f.n AS n_convs, f.n_children, n_leaves,
      saved_tokens::BIGINT AS saved_tokens, f.ends_sha256
    FROM figures f JOIN below USING (d, path) LEFT JOIN nodes p ON p.d = f.d - 1 AND p.path = f.path[1:f.d - 1]"""
