"""Interval join and reconciliation of two event tables.

In batch both sides are put into time buckets, so the pairs of a hot key are found bucket
by bucket on many tasks.  For the join one side keeps a single copy of each row, and the
other is copied to the buckets its interval touches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.functions.times import duration_us, micros, step_number
from footfall.operators.blocks import batch_only
from footfall.operators.cuts import ordered_cuts, running_after, running_before, running_sum

#: The names of the outputs.
MATCHED, LEFT_ONLY, RIGHT_ONLY = "matched", "unmatched-pays", "unmatched-receipts"


def _signed_us(value: str) -> int:
    return -duration_us(value[1:].strip()) if value.startswith("-") else duration_us(value)


def _sides(left: DataFrame, right: DataFrame, on: tuple[str, str], ts: tuple[str, str], names: tuple[str, str]):
    packed = []
    for df, key, time, name in zip((left, right), on, ts, names):
        packed.append(df.select(F.col(key).alias(f"{name}_key"), micros(time).alias(f"{name}_us"), F.struct("*").alias(name)))
    return packed


def _bucketed(one: DataFrame, many: DataFrame, names: tuple[str, str], low: int, high: int):
    """``one`` with its bucket and ``many`` in every bucket that can hold a row of
    ``one`` with ``many.us - one.us`` in [low, high]."""
    step = max(2 * (high - low), 1_000)
    one = one.withColumn("_bucket", step_number(F.col(f"{names[0]}_us"), step))
    us = F.col(f"{names[1]}_us")
    reach = F.sequence(step_number(us - F.lit(high), step), step_number(us - F.lit(low), step))
    return one, many.withColumn("_bucket_r", F.explode(reach))


def _condition(one: str, many: str, low: int, high: int, bucketed: bool) -> Column:
    gap = F.col(f"{many}_us") - F.col(f"{one}_us")
    cond = (F.col(f"{one}_key") == F.col(f"{many}_key")) & gap.between(F.lit(low), F.lit(high))
    return cond & (F.col("_bucket") == F.col("_bucket_r")) if bucketed else cond


def interval_join(
    left: DataFrame,
    right: DataFrame,
    on: tuple[str, str],
    ts: tuple[str, str],
    lower: str = "-3 seconds",
    upper: str = "5 seconds",
    names: tuple[str, str] = ("pay", "receipt"),
    how: str = "inner",
) -> DataFrame:
    """Pairs with equal keys and ``right.ts - left.ts`` in [lower, upper], as two structs.

    ``how`` may be ``inner`` or ``left``.  Streams need watermarks on both sides;
    Spark derives the state bounds from the plain range condition there.
    """
    low, high = _signed_us(lower), _signed_us(upper)
    if left.isStreaming or right.isStreaming:
        lo, hi = F.expr(f"interval {low} microseconds"), F.expr(f"interval {high} microseconds")
        a, b = left.alias("l"), right.alias("r")
        lt, rt = F.col(f"l.{ts[0]}"), F.col(f"r.{ts[1]}")
        cond = (F.col(f"l.{on[0]}") == F.col(f"r.{on[1]}")) & (rt >= lt + lo) & (rt <= lt + hi)
        pair = a.join(b, cond, {"left": "leftOuter"}.get(how, how))
        return pair.select(*[
            F.when(F.col(f"{side}.{key}").isNotNull(), F.struct(*[F.col(f"{side}.{c}") for c in df.columns])).alias(name)
            for side, df, key, name in zip("lr", (left, right), on, names)
        ])
    one, many = _sides(left, right, on, ts, names)
    one, many = _bucketed(one, many, names, low, high)
    return one.join(many, _condition(*names, low, high, True), how).select(*names)


def reconcile(
    left: DataFrame,
    right: DataFrame,
    on: tuple[str, str],
    ts: tuple[str, str],
    lower: str = "-3 seconds",
    upper: str = "5 seconds",
    names: tuple[str, str] = ("pay", "receipt"),
    tags: tuple[str, str, str] = (MATCHED, LEFT_ONLY, RIGHT_ONLY),
) -> DataFrame:
    """Pairs, left rows without a partner and right rows without one, told apart by ``tag``.

    In batch each side is read and shuffled once.  Left times are moved by ``lower``, so that
    a pair is a right row at most ``upper - lower`` behind a left one.  Both sides lie in
    buckets of four times that span, rows near a bucket's edge in the next one, too.  Sorted
    together, a left row's partners are a range frame, and the last left row before a right
    one tells whether it has any.  Rows without key or time have no partner.
    """
    if left.isStreaming or right.isStreaming:
        both = interval_join(left, right, on, ts, lower, upper, names, "fullOuter")
        tag = F.when(F.col(names[1]).isNull(), tags[1]).when(F.col(names[0]).isNull(), tags[2]).otherwise(tags[0])
        return both.withColumn("tag", tag)
    low, high = _signed_us(lower), _signed_us(upper)
    span = high - low
    step = max(4 * span, 1_000)

    def side(at: int, df: DataFrame, moved: int, reach: int) -> DataFrame:
        row, x = F.struct("*").alias(names[at]), micros(ts[at]) + F.lit(moved)
        rows = df.select(F.col(on[at]).alias("_key"), x.alias("_x"), row, F.lit(at == 0).alias("_left"))
        own, other = step_number(F.col("_x"), step), step_number(F.col("_x") + F.lit(reach), step)
        known = F.col("_key").isNotNull() & F.col("_x").isNotNull()
        place = lambda bucket, native: F.struct(bucket.alias("_bucket"), F.lit(native).alias("_native"))
        # rows that can have no partner are dealt by a hash of all they hold
        places = F.when(~known, F.array(place(F.pmod(F.xxhash64(names[at]), F.lit(1 << 20)), True)))
        places = places.when(own == other, F.array(place(own, True))).otherwise(F.array(place(own, True), place(other, False)))
        return rows.select("*", known.alias("_known"), F.inline(places))

    both = side(0, left, low, span).unionByName(side(1, right, 0, -span), allowMissingColumns=True)
    bucket = Window.partitionBy("_key", "_known", "_bucket").orderBy("_x")
    partners = F.collect_list(F.when(F.col("_known") & ~F.col("_left"), F.col(names[1]))).over(bucket.rangeBetween(0, span))
    last = F.max(F.when(F.col("_known") & F.col("_left"), F.col("_x"))).over(bucket.rangeBetween(Window.unboundedPreceding, 0))
    met = both.select("*", partners.alias("_partners"), last.alias("_last")).filter("_native")
    matched = F.coalesce(F.col("_last") >= F.col("_x") - F.lit(span), F.lit(False))
    none = F.array(F.lit(None).cast(both.schema[names[1]].dataType))
    out = (
        F.when(F.col("_left") & (F.size("_partners") > 0), F.col("_partners"))
        .when(F.col("_left"), none)
        .when(~matched, F.array(F.col(names[1])))
    )
    each = met.select("_left", names[0], F.explode(out).alias(names[1]))
    tag = F.when(~F.col("_left"), tags[2]).when(F.col(names[1]).isNull(), tags[1]).otherwise(tags[0])
    return each.select(*names, tag.alias("tag"))


def first_come_match(
    rows: DataFrame, key: str, ts: str, tie: str, is_left: Column, left_wait: str = "5 seconds",
    right_wait: str = "3 seconds", tags: tuple[str, str, str] = (MATCHED, LEFT_ONLY, RIGHT_ONLY), parts: int | None = None,
) -> DataFrame:
    """First come, first matched, of the rows of both sides in order of (``ts``, ``tie``).

    A row waits for one of the other side, up to and including the time its side waits.  The
    pair is ``matched`` and over.  A further row of the side that waits takes its place, and the
    one before has no result; a row whose time is over is unmatched.  Gives ``key``, the
    ``tie`` of both as ``left_tie`` and ``right_tie``, and ``tag``.  Rows without key or time
    take no part.

    Rows that could match the one before them form chains, in which the first matches the
    second, the third the fourth.  A row's place in its chain is a running count less the count
    at the chain's start, both carried over row-balanced cuts, so a hot key is no hot task.
    """
    batch_only(rows, "streaming.processors.TwoStreamMatch")
    narrow = rows.select(F.col(key).alias("_key"), micros(ts).alias("_us"), F.col(tie).alias("_tie"), is_left.alias("_left"))
    narrow = narrow.filter("_key IS NOT NULL AND _us IS NOT NULL AND _left IS NOT NULL")
    order = ["_us", "_tie"]
    cuts = ordered_cuts(narrow, ["_key", *order], "first-come", parts)
    row = F.struct("_us", "_tie", "_left")
    near = running_before(
        cuts, ["_key"], order, {"_n": (F.sum, F.lit(1)), "_before": (F.max, row)},
        {"_n": running_sum, "_before": lambda carried, local: F.coalesce(local, carried)},
    )
    near = running_after(
        near, ["_key"], order, {"_after": (F.min, row)}, {"_after": lambda carried, local: F.coalesce(local, carried)}
    )
    wait = lambda r: F.when(r["_left"], F.lit(duration_us(left_wait))).otherwise(F.lit(duration_us(right_wait)))
    meets = lambda a, b: (b["_us"] - a["_us"] <= wait(a)) & (a["_left"] != b["_left"])
    starts = ~F.coalesce(meets(F.col("_before"), row), F.lit(False))
    near = near.withColumn("_starts", F.when(starts, F.col("_n")))
    chained = running_before(
        near, ["_key"], order, {"_chain": (F.max, F.col("_starts"))}, {"_chain": F.greatest}
    ).withColumn("_chain", F.coalesce("_starts", "_chain"))
    after = F.col("_after")
    first = (F.col("_n") - F.col("_chain")) % 2 == 0
    pairs = F.coalesce(meets(row, after), F.lit(False))
    replaced = F.coalesce((after["_left"] == F.col("_left")) & (after["_us"] - F.col("_us") <= wait(row)), F.lit(False))
    lone = chained.filter(first & ~(~pairs & replaced))
    own, other = F.col("_tie"), F.when(pairs, after["_tie"])
    tag = F.when(pairs, tags[0]).when(F.col("_left"), tags[1]).otherwise(tags[2])
    return lone.select(
        F.col("_key").alias(key), F.when(F.col("_left"), own).otherwise(other).alias("left_tie"),
        F.when(F.col("_left"), other).otherwise(own).alias("right_tie"), tag.alias("tag"),
    )
