"""Sequence patterns over ordered rows.

Spark has no ``MATCH_RECOGNIZE``.  Rows are sorted into row-balanced cuts (``cuts``), by key
and time or, without a key, by time alone, and matched inside a cut by plain window functions.
How many rows a key has, or how many of them lie inside ``within``, makes no task larger.
What goes on behind a cut's end is found in one of two ways:

* *strict* steps are on adjacent rows, so a cut also gets the first rows behind it, one less
  than there are steps;
* *relaxed* steps may be any number of cuts away.  Of each cut a summary says, for every step
  i, which is the first row that fits it and how the chain goes on inside the cut.  Summaries
  are composed from the last cut back, step by step, which gives the chain from the end of any
  cut on; a row whose own chain breaks off at step i takes the rest from there.  Only keys
  that reach over a cut's edge need it: two a cut at most.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.functions.times import duration_us, micros
from footfall.operators.blocks import batch_only
from footfall.operators.cuts import CUT, NATIVE, ordered_cuts, with_next_rows

STRICT, RELAXED = "strict", "relaxed"


def match_sequence(
    df: DataFrame,
    key: Sequence[str],
    ts: str,
    tie: str,
    steps: Sequence[tuple[str, Column]],
    within: str,
    contiguity: str = STRICT,
    times: int = 1,
    emit_timeouts: bool = False,
    columns: Sequence[str] | None = None,
    parts: int | None = None,
) -> DataFrame:
    """Every match of ``steps`` that starts at a row and ends less than ``within`` later.

    ``steps`` are (name, predicate) pairs over ``df``, in order of (``ts``, ``tie``);
    ``tie`` makes that order total.  ``strict`` wants the steps on adjacent rows;
    ``relaxed`` skips rows until the next one that fits.  ``times`` repeats the
    whole step list, numbering the names.  An empty ``key`` matches over all rows.
    Rows without a time are not looked at.

    Gives the key columns and one struct of ``columns`` per step.  With
    ``emit_timeouts`` a first step whose match is not complete in time is kept,
    with ``status = 'timeout'`` and NULL for the missing steps; complete matches
    have ``status = 'match'``.

    Writes the rows as cuts to the shared folder first; ``parts`` is their number at most, by
    default that of shuffle partitions.
    """
    batch_only(df, "streaming.processors.SequenceMatch")
    if contiguity not in (STRICT, RELAXED):
        raise ValueError(f"unknown contiguity: {contiguity}")
    if times > 1:
        steps = [(f"{name}_{i + 1}", pred) for i in range(times) for name, pred in steps]
    within_us = duration_us(within)
    keep = list(columns or dict.fromkeys([ts, tie]))
    names = [name for name, _ in steps]

    preds = {f"_is{i}": pred for i, (_, pred) in enumerate(steps)}
    rows = df.select(
        *key,
        micros(ts).alias("_us"),
        F.col(tie).alias("_tie"),
        F.struct(*keep).alias("_row"),
        *[F.coalesce(pred, F.lit(False)).alias(name) for name, pred in preds.items()],
    ).filter(F.col("_us").isNotNull())
    if contiguity == RELAXED:
        # rows that fit no step cannot interrupt a relaxed match
        any_step = F.lit(False)
        for name in preds:
            any_step = any_step | F.col(name)
        rows = rows.filter(any_step)
    order = [*key, "_us", "_tie"]
    cuts = ordered_cuts(rows, order, "sequence", parts)
    if contiguity == STRICT:
        found = _adjacent(with_next_rows(cuts, order, len(steps) - 1), key, len(steps)).filter(NATIVE)
    else:
        found = _following(cuts, key, len(steps))

    start = F.col("_us")
    complete, broken, out = F.lit(True), F.lit(False), [*key, F.col("_row").alias(names[0])]
    for i, name in enumerate(names[1:], 1):
        step = F.col(f"_s{i}")
        in_time = step.isNotNull() & (step["_us"] - start < F.lit(within_us))
        fits = step["_fits"] if contiguity == STRICT else F.lit(True)
        broken = broken | (complete & in_time & ~fits)
        complete = complete & in_time & fits
        out.append(F.when(complete, step["_row"]).alias(name))
    found = found.filter(F.col("_is0"))
    if emit_timeouts:
        # a strict match that another row interrupts is over, not timed out
        status = F.when(complete, "match").otherwise("timeout")
        return found.filter(~F.coalesce(broken, F.lit(False))).select(*out, status.alias("status"))
    return found.filter(complete).select(*out)


def _adjacent(rows: DataFrame, key: Sequence[str], n: int) -> DataFrame:
    """``_s1 .. _s(n-1)``: the next rows, and whether each fits its step."""
    w = Window.partitionBy(CUT, *key).orderBy("_us", "_tie")
    leads = [
        F.lead(F.struct("_us", "_row", F.col(f"_is{i}").alias("_fits")), i).over(w).alias(f"_s{i}")
        for i in range(1, n)
    ]
    return rows.select("*", *leads)


def _following(cuts: DataFrame, key: Sequence[str], n: int) -> DataFrame:
    """``_s1 .. _s(n-1)``: for each row the next row that fits, then the one after that, and so on.

    Built from the last step back; each row that fits step i carries its own rest
    of the chain, ``_c{i}``.  All passes share one partitioning and sort.
    """
    after = Window.partitionBy(CUT, *key).orderBy(F.col("_us").desc(), F.col("_tie").desc())
    after = after.rowsBetween(Window.unboundedPreceding, -1)
    rows = cuts
    for i in range(n - 1, 0, -1):
        rest = [F.col(f"_s{j}") for j in range(i + 1, n)]
        chain = F.struct(F.struct("_us", "_row").alias(f"_s{i}"), *rest)
        rows = rows.withColumn(f"_c{i}", F.when(F.col(f"_is{i}"), chain))
        rows = rows.withColumn("_chain", F.last(f"_c{i}", ignorenulls=True).over(after))
        rows = rows.withColumns({f"_s{j}": F.col(f"_chain._s{j}") for j in range(i, n)}).drop("_chain")
    if n == 1:
        return rows
    ahead = _chains_behind(rows, cuts, key, n)
    same = rows[CUT] == ahead["_at"]
    for i, k in enumerate(key):
        same = same & rows[k].eqNullSafe(ahead[f"_k{i}"])
    joined = rows.join(F.broadcast(ahead), same, "left")  # two rows a cut at most
    return joined.withColumns(_mended([F.col(f"_s{i}") for i in range(1, n)], 1, n))


def _mended(own: list[Column], first: int, n: int) -> dict[str, Column]:
    """Steps ``first`` to n-1 of a chain that may break off in its cut, with the rest from behind the cut's end.

    ``_f{i}`` is the chain from step i there.
    """
    out = {}
    for i in range(first, n):
        step = own[i - first]
        breaks = step.isNull() & (own[i - first - 1].isNotNull() if i > first else F.lit(True))
        # the chain taken over starts at the step at which this one breaks off, and holds all later ones
        froms = F.when(breaks, F.col(f"_f{i}._s{i}"))
        for j in range(first, i):
            broke = own[j - first].isNull() & (own[j - first - 1].isNotNull() if j > first else F.lit(True))
            froms = froms.when(broke, F.col(f"_f{j}._s{i}"))
        out[f"_s{i}"] = F.coalesce(step, froms)
    return out


def _edge_keys(cuts: DataFrame, key: Sequence[str]) -> DataFrame:
    """``_at`` and the keys (``_k0`` ...) that cut ``_at`` shares with a cut before or behind it."""
    name = F.struct(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(key)]) if key else F.lit(0)
    ends = cuts.groupBy(CUT).agg(F.min(name).alias("_low"), F.max(name).alias("_high"))
    line = Window.orderBy(CUT)  # over one row a cut
    ends = ends.select("*", F.lag("_high").over(line).alias("_before"), F.lead("_low").over(line).alias("_behind"))
    met = lambda other, own: F.when(F.col(other).isNotNull() & F.col(other).eqNullSafe(F.col(own)), F.col(own))
    names = F.array_distinct(F.array_compact(F.array(met("_before", "_low"), met("_behind", "_high"))))
    shared = ends.select(F.col(CUT).alias("_at"), F.explode(names).alias("_name"))
    return shared.select("_at", *[F.col(f"_name._k{i}").alias(f"_k{i}") for i in range(len(key))])


def _chains_behind(rows: DataFrame, cuts: DataFrame, key: Sequence[str], n: int) -> DataFrame:
    """``_at``, key and ``_f1 .. _f(n-1)``: the chain from step i on, behind the end of cut ``_at``."""
    edges = _edge_keys(cuts, key)
    names = [f"_k{i}" for i in range(len(key))]
    same = rows[CUT] == edges["_at"]
    for name, k in zip(names, key):
        same = same & rows[k].eqNullSafe(edges[name])
    place = F.struct("_us", "_tie")
    held = rows.join(F.broadcast(edges), same).groupBy("_at", *names).agg(
        *[F.min_by(f"_c{i}", F.when(F.col(f"_is{i}"), place)).alias(f"_c{i}") for i in range(1, n)]
    )
    line = Window.partitionBy(*names).orderBy("_at")
    onward = line.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    for i in range(n - 1, 0, -1):
        # the chain of this cut's first row for step i, whole; then that of the first cut that has one
        later = [F.col(f"_c{i}._s{j}") for j in range(i + 1, n)]
        rest = _mended(later, i + 1, n)
        whole = F.when(F.col(f"_c{i}").isNotNull(), F.struct(F.col(f"_c{i}._s{i}").alias(f"_s{i}"), *[rest[f"_s{j}"].alias(f"_s{j}") for j in range(i + 1, n)]))
        held = held.withColumn("_whole", whole)
        held = held.withColumn("_from", F.first("_whole", ignorenulls=True).over(onward))
        held = held.withColumn(f"_f{i}", F.lead("_from").over(line)).drop("_whole", "_from")
    return held.select("_at", *names, *[f"_f{i}" for i in range(1, n)])
