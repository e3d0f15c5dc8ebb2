"""Filter interaction audit: what each filter removes, in every order of the filters.

One pass over the texts reduces a document to a mask of the filters that it fails.  Masks
are counted into cells, at most 32 a part, and a recursive query extends prefixes of
filters by unused letters: each level joins a part's cells, carries the bits that the
prefix has applied, and gives the figures of its last step.  An order of all five letters
is five prefixes.  The recursion works on one row per part and prefix, so its size follows
the number of languages, not of documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm.common import sliced, table, work_folder, written

LETTERS = "ABCDE"
UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MARKS = b"#$%&*|"
#: Bytes that continue a UTF-8 character.
INNER = bytes(range(0x80, 0xC0))


def text_mask(text: bytes) -> int:
    """Bits 0 to 3: the filters A to D that a text fails by itself."""
    words = text.split()  # at ASCII white space
    capitals = len(text) - len(text.translate(None, UPPER))
    points = len(text.translate(None, INNER))
    marked = len(text) != len(text.translate(None, MARKS))
    return (len(words) < 200) | (100 * len(set(words)) < 50 * len(words)) << 1 | (100 * capitals > 3 * points) << 2 | marked << 3


def _judged(docs: DataFrame, key: str, text: str, part: str) -> DataFrame:
    """``doc``, ``part``, ``mask`` (A to D) and ``digest``, the SHA-256 of the text, of each row."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
            masks = pa.array([text_mask(t) for t in texts], pa.int32())
            digests = pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), batch.column("part"), masks, digests], names=["doc", "part", "mask", "digest"]
            )

    rows = docs.select(
        F.col(key).cast("long").alias("doc"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    return rows.mapInArrow(judge, "doc long, part string, mask int, digest binary")


def mask_cells(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """How many documents of a part fail which filters: ``part``, ``mask``, ``n``, ``good``, ``toxic``.

    A document fails E if a smaller key has its text; rows that repeat key and text do not
    fail by one another, and a null key is neither smaller nor larger.  A repeated label
    counts as 1 if any of its rows does; labels of a null key belong to no document.
    A text shared by very many rows is one least key, taken before the shuffle.
    """
    judged = written(_judged(docs, key, text, part), f"{work_folder(docs.sparkSession, 'audit')}/judged")
    # rows that repeat all of this, which could make one key hot, become one
    rows = judged.groupBy("digest", "doc", "part", "mask").agg(F.count("*").alias("n"))
    first = judged.groupBy("digest").agg(F.min("doc").alias("doc")).withColumn("first", F.lit(True))
    marks = labels.groupBy(F.col("doc_id").cast("long").alias("doc")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    again = F.col("first").isNull() & F.col("doc").isNotNull()
    mask = F.col("mask").bitwiseOR(F.when(again, 16).otherwise(0))
    full = rows.join(first, ["digest", "doc"], "left").join(marks, "doc", "left")
    return full.groupBy("part", mask.alias("mask")).agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.coalesce("good", F.lit(0))).alias("good"),
        F.sum(F.col("n") * F.coalesce("toxic", F.lit(0))).alias("toxic"),
    )


STEPS = """
WITH RECURSIVE letters AS (SELECT substr('{letters}', id + 1, 1) AS letter, shiftleft(1, id) AS bit FROM (
    SELECT CAST(id AS INT) AS id FROM range({count}))),
prefixes(part, prefix, applied, step, {figures}) AS (
  SELECT part, '' AS prefix, 0 AS applied, 0 AS step, {zeros} FROM {cells}
  UNION ALL
  SELECT p.part, concat(p.prefix, l.letter), p.applied | l.bit, p.step + 1,
    aggregate(c.cells, 0L, (s, x) -> s + if(x.mask & (p.applied | l.bit) = 0, x.n, 0L)),
    aggregate(c.cells, 0L, (s, x) -> s + if(x.mask & p.applied = 0 AND x.mask & l.bit <> 0, x.n, 0L)),
    aggregate(c.cells, 0L, (s, x) -> s + if(x.mask & p.applied <> 0 AND x.mask & l.bit <> 0, x.n, 0L)),
    aggregate(c.cells, 0L, (s, x) -> s + if(x.mask = l.bit, x.n, 0L)),
    aggregate(c.cells, 0L, (s, x) -> s + if(x.mask & p.applied = 0 AND x.mask & l.bit <> 0, x.good, 0L)),
    aggregate(c.cells, 0L, (s, x) -> s + if(x.mask & p.applied = 0 AND x.mask & l.bit <> 0, x.toxic, 0L))
  FROM prefixes p JOIN letters l ON p.applied & l.bit = 0 JOIN {cells} c ON c.part = p.part)
SELECT * FROM prefixes WHERE step > 0"""

FIGURES = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]
ROWS_LIMIT = "spark.sql.cteRecursionRowLimit"


def prefix_steps(cells: DataFrame, letters: str = LETTERS) -> DataFrame:
    """The figures of the last step of each prefix of different ``letters``, by ``part``."""
    spark, folder = cells.sparkSession, work_folder(cells.sparkSession, "prefixes")
    packed = cells.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    packed = written(packed, f"{folder}/cells")
    view = f"audit_{folder.rsplit('-', 1)[1]}"
    packed.createOrReplaceTempView(view)
    text = STEPS.format(
        letters=letters, count=len(letters), cells=view, figures=", ".join(FIGURES),
        zeros=", ".join(f"0L AS {f}" for f in FIGURES),
    )
    # the limit guards against endless recursion; here each level uses up a letter
    before = spark.conf.get(ROWS_LIMIT)
    spark.conf.set(ROWS_LIMIT, "-1")
    try:
        return written(spark.sql(text), f"{folder}/steps")
    finally:
        spark.conf.set(ROWS_LIMIT, before)
        spark.catalog.dropTempView(view)


def _orders(spark: SparkSession, letters: str) -> DataFrame:
    """Every order of the letters: ``filter_order``."""
    grown: Column = F.explode(F.split(F.lit(letters), ""))
    orders = spark.range(1).select(grown.alias("filter_order"))
    for _ in letters[1:]:
        more = orders.select("filter_order", F.explode(F.split(F.lit(letters), "")).alias("letter"))
        orders = more.filter(~F.col("filter_order").contains(F.col("letter"))).select(
            F.concat("filter_order", "letter").alias("filter_order")
        )
    return orders


def filter_audit(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang"
) -> DataFrame:
    """A row per part, order of the filters and step, with the figures of that step.

    ``kept``, ``removed``, ``redundant`` (failing the step's filter, removed earlier),
    ``unique_fails`` (failing that filter alone), ``good_lost``, ``toxic_lost`` and
    ``shapley``, the filter's removals summed over all orders.  Null and empty texts are
    the same; a null part is the empty one.  An empty table gives an empty result.
    """
    steps = prefix_steps(mask_cells(docs, labels, key, text, part))
    orders = _orders(docs.sparkSession, LETTERS).select(
        "filter_order", F.explode(F.sequence(F.lit(1), F.lit(len(LETTERS)))).alias("step")
    ).withColumn("prefix", F.expr("substr(filter_order, 1, step)"))
    each = steps.drop("applied", "step").join(F.broadcast(orders), "prefix")  # five rows an order
    letter = F.substring("prefix", -1, 1)
    total = each.groupBy("part", letter.alias("letter")).agg(F.sum("removed").alias("shapley"))
    full = each.withColumn("letter", letter).join(total, ["part", "letter"])
    return full.select("part", "filter_order", "step", *FIGURES, "shapley")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five filters over ``documents``, by language."""
    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def audit_sql() -> str:
    """The same, document by document, without cells."""
    order = "list_position(string_split(filter_order, ''), '{}')"
    earlier = " OR ".join(f"({order.format(x)} < step AND {x.lower()})" for x in LETTERS)
    own = " OR ".join(f"(letter = '{x}' AND {x.lower()})" for x in LETTERS)
    fails = " + ".join(f"{x.lower()}::INT" for x in LETTERS)
    return rf"""
    WITH RECURSIVE texts AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
      regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
    judged AS (SELECT doc_id, part, len(ws) < 200 AS a, 100 * len(list_distinct(ws)) < 50 * len(ws) AS b,
      100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) AS c, regexp_matches(t, '[#$%&*|]') AS d,
      coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS e FROM texts),
    marks AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
    rows_ AS (SELECT judged.*, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic FROM judged LEFT JOIN marks USING (doc_id)),
    grown(filter_order) AS (SELECT '' UNION ALL SELECT filter_order || l FROM grown,
      unnest(['A', 'B', 'C', 'D', 'E']) AS t(l) WHERE NOT contains(filter_order, l)),
    steps AS (SELECT filter_order, step, substr(filter_order, step, 1) AS letter
      FROM grown, range(1, 6) AS s(step) WHERE length(filter_order) = 5),
    met AS (SELECT part, filter_order, step, letter, good, toxic, ({earlier}) AS gone, ({own}) AS fails, ({fails}) AS many
      FROM rows_, steps),
    figures AS (SELECT part, filter_order, step, letter, count(*) FILTER (NOT gone AND NOT fails) AS kept,
      count(*) FILTER (NOT gone AND fails) AS removed, count(*) FILTER (gone AND fails) AS redundant,
      count(*) FILTER (fails AND many = 1) AS unique_fails, count(*) FILTER (NOT gone AND fails AND good = 1) AS good_lost,
      count(*) FILTER (NOT gone AND fails AND toxic = 1) AS toxic_lost FROM met GROUP BY ALL)
    SELECT part, filter_order, step::INT AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
      (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley FROM figures"""
