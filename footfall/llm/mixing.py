"""Mixing sources to target weights by Poisson replication.

Each document draws how often it is repeated from a Poisson distribution whose mean is
its source's repetition rate; the draw inverts the distribution at a number in [0, 1)
hashed from the document.  Documents are exploded by their counts and put into a global
random order.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.llm.common import table, work_folder, written

#: 13 hex digits of md5 are 52 bits, which a double holds exactly.
UNIT = float(1 << 52)


def hashed_unit(*parts: Column) -> Column:
    """A number in [0, 1) from the md5 of the parts."""
    digest = F.md5(F.concat_ws(":", *parts).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long").cast("double") / F.lit(UNIT)


#: Counts so many standard deviations, and some more, from the mean have a chance of under 2**-52.
REACH, MORE = 12, 40


def _log_factorial(n: Column) -> Column:
    """ln n! by Stirling's series, to some 14 digits from n = 16 on; 0 for the n below, where sums start at 0."""
    x = n.cast("double") + 1
    power = lambda p: F.pow(x, F.lit(float(p)))
    series = (x - 0.5) * F.log(x) - x + 0.5 * math.log(2 * math.pi)
    series = series + 1 / (12 * x) - 1 / (360 * power(3)) + 1 / (1260 * power(5)) - 1 / (1680 * power(7))
    return F.when(n > 0, series).otherwise(0.0)


def poisson_tables(rates: DataFrame) -> DataFrame:
    """Adds to ``source``, ``rate`` the ``least`` count and ``cdf``, P(count <= k) for k from ``least`` on.

    Counts with a chance of under 2**-52 on either side are left out, so a table has some
    24 times the root of the rate.  Masses are taken in logarithms, where ln k! is a running
    sum over rows of (source, count), and so are their sums.
    """
    spread = F.lit(REACH) * F.sqrt("rate") + MORE
    low = F.floor(F.col("rate") - spread)
    least = F.when(low < 16, 0).otherwise(low).cast("long")  # the series needs 16
    last = F.ceil(F.col("rate") + spread).cast("long")
    each = rates.filter("rate > 0").select(
        "source", "rate", least.alias("least"), F.explode(F.sequence(least, last)).alias("k")
    )
    upto = Window.partitionBy("source").orderBy("k")
    steps = F.sum(F.when(F.col("k") > F.col("least"), F.log(F.col("k").cast("double"))).otherwise(0.0)).over(upto)
    log_mass = F.col("k") * F.log("rate") - F.col("rate") - _log_factorial(F.col("least")) - steps
    summed = each.select("source", "least", "k", F.exp(log_mass).alias("mass")).select(
        "source", "least", "k", F.sum("mass").over(upto).alias("sum")
    )
    tables = summed.groupBy("source").agg(
        F.first("least").alias("least"), F.sort_array(F.collect_list(F.struct("k", "sum")))["sum"].alias("cdf")
    )
    joined = rates.join(tables.withColumnRenamed("source", "_of"), F.col("source").eqNullSafe(F.col("_of")), "left").drop("_of")
    return joined.withColumn("least", F.coalesce("least", F.lit(0).cast("long"))).withColumn(
        "cdf", F.coalesce("cdf", F.array(F.lit(1.0)))
    )


def sorted_before(values: Column, x: Column) -> Column:
    """How many of the ascending ``values`` are at most ``x``, by binary search."""
    halves = F.array(*[F.lit(1 << b) for b in range(30, -1, -1)])
    inside = F.filter(halves, lambda h: h <= F.size(values))
    step = lambda low, h: F.when(
        low + h <= F.size(values), F.when(F.get(values, low + h - 1) <= x, low + h).otherwise(low)
    ).otherwise(low)
    return F.aggregate(inside, F.lit(0), step)


def source_rates(
    docs: DataFrame, weights: Mapping[str | None, float] | None = None, total: int | None = None,
    source: str = "source", text: str = "text",
) -> DataFrame:
    """One row per source: ``source``, ``rate``, ``least`` and ``cdf``.

    A source's size is its characters plus one per document, over all its documents.
    ``weights`` are shares by source, in any unit; sources that it lacks get none, and
    without it every source gets the same.  ``total`` is the size to reach, by default
    the size of the input.  A null source is a source of its own.
    """
    sizes = docs.groupBy(F.col(source).alias("source")).agg(
        F.sum(F.coalesce(F.length(text), F.lit(0)) + 1).cast("double").alias("size")
    )
    if weights is None:
        shared = sizes.withColumn("weight", F.lit(1.0))
    else:
        schema = T.StructType([T.StructField("named", T.StringType()), T.StructField("weight", T.DoubleType())])
        given = docs.sparkSession.createDataFrame([(k, float(v)) for k, v in weights.items()], schema)
        joined = sizes.join(given, F.col("source").eqNullSafe(F.col("named")), "left")
        shared = joined.select("source", "size", F.coalesce("weight", F.lit(0.0)).alias("weight"))
    shared = written(shared, work_folder(docs.sparkSession, "sizes"))
    size, weight = shared.agg(F.sum("size"), F.sum("weight")).first()
    whole = float(total) if total is not None else float(size or 0)
    rate = F.col("weight") / F.lit(float(weight or 1)) * F.lit(whole) / F.col("size")
    return poisson_tables(shared.select("source", F.coalesce(rate, F.lit(0.0)).alias("rate")))


def poisson_mix(
    docs: DataFrame, weights: Mapping[str | None, float] | None = None, total: int | None = None, seed: str = "mix",
    key: str = "doc_id", source: str = "source", text: str = "text", ordered: bool = True,
) -> DataFrame:
    """Repeats of ``docs`` with all their columns in a struct ``row``, globally shuffled.

    Returns ``row``, ``copy`` (from 1), ``copies``, ``rate`` and ``place``, the number in
    [0, 1) that the rows are sorted by.  Nothing is dropped or capped but by a draw of
    zero.  The draw depends on seed, key and text: rows that repeat both draw the same
    count, and null keys or texts count as empty.  A hot source costs nothing extra:
    sizes are summed before their shuffle, rates are one row per source, and the order
    is by a hash.  Columns of ``docs`` cannot clash with the added ones.
    """
    drawn = hashed_unit(
        F.lit(seed), F.coalesce(F.col(key).cast("string"), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    )
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), drawn.alias("drawn"))
    # a small table, whose size Spark knows before it chooses the join
    rates = written(source_rates(docs, weights, total, source, text), work_folder(docs.sparkSession, "rates"))
    joined = rows.join(rates, F.col(f"row.{source}").eqNullSafe(F.col("source")))
    copies = (F.col("least") + sorted_before(F.col("cdf"), F.col("drawn"))).cast("int")
    counted = joined.select("row", "rate", copies.alias("copies")).filter(F.col("copies") > 0)
    each = counted.select("row", "rate", "copies", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    place = hashed_unit(
        F.lit(seed), F.col("copy").cast("string"), F.coalesce(F.col(f"row.{key}").cast("string"), F.lit("")),
        F.coalesce(F.col(f"row.{text}"), F.lit("")),
    )
    mixed = each.select("row", "copy", "copies", "rate", place.alias("place"))
    return mixed.orderBy("place", f"row.{key}", "copy") if ordered else mixed


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus with the columns of ``docs`` alone."""
    return poisson_mix(docs, **options).select("row.*")


def op7_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every source at the same share of as many characters as ``documents`` has."""
    mixed = poisson_mix(table(spark, sf_dir, "documents"))
    return mixed.select("row.doc_id", "row.source", "row.lang", "row.text", "copy", "copies", "rate", "place")


def mix_sql(docs: str = "documents", columns: str = "doc_id, source, lang, text, copy, copies, rate, place") -> str:
    """The same over a table named ``docs``."""
    unit = "CAST(('0x' || substr(md5({}), 1, 13)) AS BIGINT)::DOUBLE / 4503599627370496"
    key, text = "coalesce(doc_id::VARCHAR, '')", "coalesce(text, '')"
    return f"""
    WITH sizes AS (SELECT source AS s, sum(coalesce(length(text), 0) + 1)::DOUBLE AS size FROM {docs} GROUP BY source),
    rates AS (SELECT s, 1.0::DOUBLE / (SELECT count(*) FROM sizes) * (SELECT sum(size) FROM sizes) / size AS rate FROM sizes),
    masses AS (
      SELECT s, rate, k, exp(k * ln(rate) - rate - lgamma(k + 1.0)) AS p
      FROM rates, unnest(generate_series(0, ceil(rate + 12 * sqrt(rate) + 40)::BIGINT)) AS t(k)),
    cdf AS (SELECT s, rate, list(c ORDER BY c) AS cs FROM (
      SELECT s, rate, sum(p) OVER (PARTITION BY s ORDER BY k) AS c FROM masses) GROUP BY s, rate),
    drawn AS (SELECT *, {unit.format(f"'mix:' || {key} || ':' || {text}")} AS drawn FROM {docs}),
    counted AS (SELECT drawn.*, rate, len(list_filter(cs, lambda c: drawn >= c))::INT AS copies
      FROM drawn JOIN cdf ON drawn.source IS NOT DISTINCT FROM cdf.s),
    each AS (SELECT *, unnest(range(1, copies + 1))::INT AS copy FROM counted WHERE copies > 0)
    SELECT {columns} FROM (SELECT * EXCLUDE (drawn),
      {unit.format(f"'mix:' || copy || ':' || {key} || ':' || {text}")} AS place FROM each)"""
