"""Filter audit, conversation trie and substring dedup against brute force, and on odd tables."""

import hashlib
import random
import re
import zlib
from collections import Counter
from itertools import permutations

import pytest

from footfall.llm import audit, repeats, trie

WORD = re.compile("[^\x20\x09-\x0d]+")


def table(df, *keys):
    return {tuple(r[k] for k in keys): r.asDict() for r in df.collect()}


# filter audit


def fails(rows):
    """The filters that each (doc_id, text, part) fails, by the plain definitions."""
    out = []
    for doc, text, part in rows:
        text = text or ""
        words = WORD.findall(text)
        own = ""
        own += "A" if len(words) < 200 else ""
        own += "B" if 100 * len(set(words)) < 50 * len(words) else ""
        own += "C" if 100 * len(re.findall("[A-Z]", text)) > 3 * len(text) else ""
        own += "D" if re.search("[#$%&*|]", text) else ""
        if doc is not None and any(d is not None and d < doc and (t or "") == text for d, t, _ in rows):
            own += "E"
        out.append((part or "", own, doc))
    return out


def test_audit_by_brute_force(spark, odd, none):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 1), (9, 1, 1), (12, None, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    good, toxic = {1, 9}, {1, 9, 12}
    rows = [(r.doc_id, r.text, r.lang) for r in odd.collect()]
    want, shapley = {}, Counter()
    for part in {p for p, _, _ in fails(rows)}:
        mine = [(own, doc) for p, own, doc in fails(rows) if p == part]
        for order in map("".join, permutations("ABCDE")):
            for step, letter in enumerate(order, 1):
                gone = [any(x in own for x in order[: step - 1]) for own, _ in mine]
                here = [letter in own for own, _ in mine]
                lost = [doc for (_, doc), g, h in zip(mine, gone, here) if h and not g]
                shapley[part, letter] += len(lost)
                want[part, order, step] = (
                    sum(not g and not h for g, h in zip(gone, here)), len(lost), sum(g and h for g, h in zip(gone, here)),
                    sum(own == letter for own, _ in mine), sum(d in good for d in lost), sum(d in toxic for d in lost),
                )
    got = table(audit.filter_audit(odd, labels), "part", "filter_order", "step")
    assert got.keys() == want.keys() and len(got) % 600 == 0
    for key, figures in want.items():
        assert tuple(got[key][f] for f in audit.FIGURES) == figures, key
        assert got[key]["shapley"] == shapley[key[0], key[1][key[2] - 1]]
    assert audit.filter_audit(none, labels).count() == 0
    assert audit.filter_audit(odd, labels.limit(0)).filter("good_lost > 0 OR toxic_lost > 0").count() == 0


def test_masks_at_the_limits():
    words = [f"w{i}" for i in range(100)]
    assert audit.text_mask(" ".join(words * 2).encode()) == 0  # 200 words, half of them distinct
    assert audit.text_mask(" ".join([*(words * 2), "w1"]).encode()) == 2
    assert audit.text_mask(" ".join((words * 2)[:-1]).encode()) == 1
    assert audit.text_mask(b"") == 1
    assert audit.text_mask(("é" * 97 + "ABC").encode()) == 1 and audit.text_mask(("é" * 96 + "ABC").encode()) == 5


def test_more_parts_than_the_recursion_limit_of_rows(spark):
    docs = spark.range(4000).selectExpr("id AS doc_id", "'a' AS text", "concat('p', id) AS lang")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    cells = audit.mask_cells(docs, labels)
    assert audit.prefix_steps(cells).count() == 4000 * 325


# conversation trie


def brute_trie(rows):
    own = {}
    key = lambda r: (r[1] is not None, r[1] or 0, hashlib.md5(f"{len(r[2] or '')}:{r[2] or ''}{r[3] or ''}".encode()).hexdigest())
    for r in rows:
        if r[0] is not None:
            own.setdefault(r[0], []).append(r)
    own = {c: [(r[2] or "", r[3] or "") for r in sorted(rs, key=key)] for c, rs in own.items()}
    built = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = tuple(own.get(c - c % 5, [])[:h] + ts[h:])
    members = {}
    for c, ts in built.items():
        for d in range(len(ts) + 1):
            members.setdefault(ts[:d], []).append(c)
    kids = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for path, cs in members.items():
        gain = (len(cs) - 1) * len(path[-1][1].encode()) if path else 0
        for d in range(len(path) + 1):
            leaves[path[:d]] += kids[path] == 0
            saved[path[:d]] += gain
    out = Counter()
    for path, cs in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in cs if built[c] == path))
        parent = min(members[path[:-1]]) if path else None
        out[min(cs), len(path), parent, len(cs), kids[path], leaves[path], saved[path], hashlib.sha256(ends.encode()).hexdigest()] += 1
    return out


def conversations(seed=3):
    """Nulls, ties, repeats, absent bases, copies and a conversation of several segments, with long starts that others share."""
    draw = random.Random(seed)
    rows = [(None, 1, "user", "nobody's"), (7, None, None, None), (7, 1, "user", "x"), (7, 1, "user", "x"), (7, 1, "a", "b"), (8, 0, "user", "")]
    for c in range(40, 160):
        kind = c % 7
        for t in range(draw.randrange(1, 9)):
            text = f"line {t}" if kind < 3 else f"line {t} {draw.randrange(3)} é"
            rows.append((c, t, ["user", "assistant"][t % 2], text))
    long = [(t, "user", f"t{t}") for t in range(150)]
    for c in (200, 205, 210, 213):
        rows += [(c, *t) for t in long[: {200: 150, 205: 128, 210: 64, 213: 141}[c]]]
    rows += [(200, 150 + t, "user", f"own {t}") for t in range(60)]
    return rows


@pytest.mark.parametrize("shard", [60, 200_000])
def test_trie_by_brute_force(spark, monkeypatch, shard):
    monkeypatch.setattr(trie, "SHARD", shard)
    rows = conversations()
    df = spark.createDataFrame([(*r, "extra", 1) for r in rows], "conv_id long, turn long, role string, text string, id string, conv int")
    got = trie.prefix_trie(df.repartition(3)).collect()
    assert Counter(map(tuple, got)) == brute_trie(rows)


def test_trie_of_copies_and_of_nothing(spark):
    rows = [(c, t, "user", f"same {t}") for c in range(500, 900) for t in range(3)]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    assert Counter(map(tuple, trie.prefix_trie(df).collect())) == brute_trie(rows)
    assert trie.prefix_trie(df.limit(0)).count() == 0


def test_search_tree_is_balanced():
    tree = trie.SearchTree()
    for s in trie.median_first([(i,) for i in range(1023)]):
        tree.insert(s)

    def height(v):
        return 0 if v < 0 else 1 + max(height(tree.low[v]), height(tree.high[v]))

    assert height(tree.top) == 10
    assert sorted(trie.median_first(list(range(7)))) == list(range(7))


# substring dedup


def brute_repeats(rows, window=35):
    words = [WORD.findall(t or "") for _, t in rows]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = Counter()
    for (doc, _), w in zip(rows, words):
        gone = {j for i in range(len(w) - window + 1) if seen[tuple(w[i : i + window])] > 1 for j in range(i, i + window)}
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out[doc, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()] += 1
    return out


def test_repeats_on_odd_tables(spark, odd, none):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert Counter(map(tuple, repeats.remove_repeats(odd).collect())) == brute_repeats(rows)
    assert repeats.remove_repeats(none).count() == 0


@pytest.mark.parametrize("bits", [1 << 27, 1 << 10])
def test_repeats_by_brute_force(spark, monkeypatch, bits):
    """Passages at edges, overlapping, inside one text, of 34 to 36 words, from a small vocabulary; with a full bitmap, too."""
    monkeypatch.setattr(repeats, "MOST_BITS", bits)
    draw = random.Random(5)
    fresh = lambda n: [f"u{draw.randrange(10**6)}" for _ in range(n)]
    passages = [fresh(n) for n in (34, 35, 36, 50, 90)] + [["again", "and"] * 30, ["same"] * 50]
    rows = []
    for i in range(300):
        words = fresh(draw.randrange(60))
        for _ in range(draw.randrange(3)):
            p = draw.choice(passages)
            a = draw.choice([0, 0, draw.randrange(20)])
            words += p[a:] + fresh(draw.choice([0, 1, 40]))
        rows.append((i, draw.choice([" ", "\n", "\t "]).join(words)))
    rows += [(300, " ".join(["x", "y", "z"] * 40)), (301, " ".join(f"v{i % 3}" for i in range(37))), (302, rows[0][1]), (0, rows[0][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert Counter(map(tuple, repeats.remove_repeats(df).collect())) == brute_repeats(rows)
