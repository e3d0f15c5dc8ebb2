"""Row-balanced cuts: rows in one order, dealt to tasks by ranges of that order.

A window over a key, or over a whole table, puts all of its rows into one task.  Here rows
are sorted by range instead: cuts follow one another in the order, each with about as many
rows, whatever the keys are; a key of many rows just has many cuts.  What an operator needs
from beyond a cut's edge is one row per cut, or a few:

* ``running_before`` and ``running_after`` carry one aggregate a cut;
* ``with_next_rows`` gives a cut the first rows behind its end.

The cuts are a table in the shared folder, so that all that read them see the same ones, also
after a task or an executor was lost.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.session import shared_folder

CUT = "_cut"
NATIVE = "_native"


def ordered_cuts(df: DataFrame, order: Sequence[str], label: str, parts: int | None = None) -> DataFrame:
    """``df`` with ``_cut``, a number that grows with ``order``; columns of ``order`` sort ascending, nulls first.

    Only rows that are equal in all of ``order`` stay together.  ``parts`` is the number of
    cuts at most, by default that of shuffle partitions.
    """
    placed = df.repartitionByRange(parts, *order) if parts else df.repartitionByRange(*order)
    folder = shared_folder(df.sparkSession, label)
    placed.withColumn(CUT, F.spark_partition_id()).write.parquet(folder)
    return df.sparkSession.read.schema(placed.withColumn(CUT, F.lit(0)).schema).parquet(folder)


Totals = dict[str, tuple[Callable[[Column], Column], Column]]
Combine = dict[str, Callable[[Column, Column], Column]]


def _running(cuts: DataFrame, key: Sequence[str], order: Sequence[str], totals: Totals, combine: Combine, before: bool) -> DataFrame:
    reach = (Window.unboundedPreceding, -1) if before else (1, Window.unboundedFollowing)
    inside = Window.partitionBy(CUT, *key).orderBy(*order).rowsBetween(*reach)
    line = Window.partitionBy(*key).orderBy(CUT)
    beyond = line.rowsBetween(*reach)
    turn = Window.partitionBy(*key).orderBy(CUT if before else F.desc(CUT))
    per_cut = cuts.groupBy(CUT, *key).agg(*[agg(c).alias(f"_t_{name}") for name, (agg, c) in totals.items()])
    carried = per_cut.select(
        F.col(CUT).alias("_at"), *[F.col(k).alias(f"_k_{i}") for i, k in enumerate(key)],
        F.row_number().over(turn).alias("_turn"),
        *[agg(F.col(f"_t_{name}")).over(beyond).alias(f"_c_{name}") for name, (agg, _) in totals.items()],
    ).filter("_turn > 1")
    same = F.col(CUT) == F.col("_at")
    for i, k in enumerate(key):
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{i}"))
    local = cuts.select("*", *[agg(c).over(inside).alias(f"_l_{name}") for name, (agg, c) in totals.items()])
    joined = local.join(F.broadcast(carried), same, "left")
    out = [combine[name](F.col(f"_c_{name}"), F.col(f"_l_{name}")).alias(name) for name in totals]
    return joined.select(*[F.col(f"`{c}`") for c in cuts.columns], *out)


def running_before(cuts: DataFrame, key: Sequence[str], order: Sequence[str], totals: Totals, combine: Combine) -> DataFrame:
    """Adds each of ``totals``, (aggregate, column), over the earlier rows of the key; null if there are none.

    ``cuts`` are in order of (``key``, ``order``).  A cut has one key at most that goes on from
    a cut before, so the carried rows are no more than the cuts, and are broadcast.
    ``combine`` puts a carried and a local total together; it must ignore nulls.
    """
    return _running(cuts, key, order, totals, combine, True)


def running_after(cuts: DataFrame, key: Sequence[str], order: Sequence[str], totals: Totals, combine: Combine) -> DataFrame:
    """The same over the later rows of the key."""
    return _running(cuts, key, order, totals, combine, False)


def running_sum(left: Column, right: Column) -> Column:
    return F.coalesce(left, F.lit(0)) + F.coalesce(right, F.lit(0))


def with_next_rows(cuts: DataFrame, order: Sequence[str], rows: int) -> DataFrame:
    """Adds ``_native`` and copies the first ``rows`` rows behind each cut's end to that cut.

    Cuts may be short: a copy goes back over as many as it takes.  The copies are no more than
    ``rows`` times the cuts.
    """
    native = cuts.withColumn(NATIVE, F.lit(True))
    if not rows:
        return native
    first = Window.partitionBy(CUT).orderBy(*order)
    heads = cuts.withColumn("_n", F.row_number().over(first)).filter(F.col("_n") <= rows)
    # what lies between a cut and a row, over one row per cut
    sizes = heads.groupBy(CUT).agg(F.max("_n").alias("_size"))
    line = Window.orderBy(CUT)
    back = sizes.select(
        F.col(CUT).alias("_at"),
        F.array(*[F.struct(F.lag(CUT, i).over(line).alias("to"),
                           sum((F.coalesce(F.lag("_size", j).over(line), F.lit(0)) for j in range(1, i)), F.lit(0)).alias("between"))
                  for i in range(1, rows + 1)]).alias("_back"),
    )
    copies = heads.join(F.broadcast(back), F.col(CUT) == F.col("_at")).select(
        *[F.col(f"`{c}`") for c in cuts.columns if c != CUT], "_n", F.inline("_back")
    ).filter(F.col("to").isNotNull() & (F.col("between") + F.col("_n") <= rows))
    copies = copies.withColumn(CUT, F.col("to")).withColumn(NATIVE, F.lit(False))
    return native.unionByName(copies.select(*native.columns))
