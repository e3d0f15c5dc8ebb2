"""Keyed state machines for streams, on ``transformWithStateInPandas``.

Input frames carry ``us`` (event time, µs) and ``tie``.  An ``OrderedProcessor`` keeps
rows until the watermark has passed them and takes them, and its timers, in order of time,
so its result does not depend on batches or arrival.  Beyond waiting rows it holds a
handful of values per key.  Its keys share state and timers by bucket, as a call into the
state costs far more than a row does.  ``run_processor`` wires a processor to a stream.
"""

from __future__ import annotations

from collections import namedtuple
from collections.abc import Iterator
from typing import Any

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from footfall.operators.matching import LEFT_ONLY, MATCHED, RIGHT_ONLY
from footfall.operators.orders import NOT_CREATED, PAID, PAID_LATE, TIMEOUT

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def _ordered(frames: Iterator[pd.DataFrame]) -> Iterator[Any]:
    rows = pd.concat(list(frames), ignore_index=True)
    return rows.sort_values(["us", "tie"], kind="stable").itertuples(index=False)


def _due_ms(us: int) -> int:
    """The first watermark (ms) that has reached ``us``."""
    return -(-us // 1000)


class KeyedProcessor(StatefulProcessor):
    """What processors share: the DDL of the result, and result rows as a frame."""

    #: DDL of the result
    output: str = ""
    #: Spark time mode: "none" or "eventTime"
    time_mode: str = "none"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open(handle)

    def open(self, handle: StatefulProcessorHandle) -> None:
        raise NotImplementedError

    def _frame(self, rows: list[tuple]) -> Iterator[pd.DataFrame]:
        if rows:
            names = [field.split()[0] for field in self.output.split(", ")]
            # as they are: a NULL would turn a column's integers to floats
            yield pd.DataFrame(rows, columns=names, dtype=object)

    def close(self) -> None:
        pass


#: What stands for NULL on the way to Python, where a NULL would turn a batch's integers to floats.
_FILL = {"bigint": 0, "int": 0, "boolean": False, "string": ""}
#: Names without a leading underscore, which frames of a group would lose.
_KEYLESS, _BUCKET = "keyless_", "bucket_"


def _packed(rows: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema) as out:
        out.write_table(rows)
    return sink.getvalue().to_pybytes()


def _unpacked(value: bytes) -> pa.Table:
    return pa.ipc.open_stream(value).read_all()


def _tuples(rows: pa.Table, names: list[str]) -> Iterator[tuple]:
    return zip(*[rows.column(name).to_numpy().tolist() for name in names])


def _filled(stream: DataFrame, key: list[str], columns: str) -> DataFrame:
    """Rows with a time, without NULLs in keys and columns; rows that lack a key are marked.

    They are not filtered out: a filter would move below the watermark, which they may advance.
    """
    types = dict(stream.dtypes)
    fill = lambda c: F.coalesce(c, F.lit(_FILL[types[c]]).cast(types[c]))
    names = dict.fromkeys([*key, *(field.split()[0] for field in columns.split(", "))])
    missing = F.lit(False)
    for c in key:
        missing = missing | F.col(c).isNull()
    return stream.filter(F.col("us").isNotNull()).withColumns({_KEYLESS: missing, **{c: fill(c) for c in names}})


def run_processor(stream: DataFrame, key: list[str], processor: KeyedProcessor, mode: str = "append") -> DataFrame:
    use_rocksdb(stream.sparkSession)
    if isinstance(processor, OrderedProcessor):
        bucket = F.pmod(F.xxhash64(*key), F.lit(processor.buckets))
        stream = _filled(stream, key, processor.columns).withColumn(_BUCKET, bucket)
        processor.keys, key = key, [_BUCKET]
    return stream.groupBy(*key).transformWithStateInPandas(
        statefulProcessor=processor,
        outputStructType=processor.output,
        outputMode=mode,
        timeMode=processor.time_mode,
    )


class OrderedProcessor(KeyedProcessor):
    """Takes rows, and what falls due between them, in event time.

    Rows wait until the watermark has passed them.  Then they and their keys' due times are
    taken in one order of time: what is due before a row takes effect before it.  What a key
    holds is one tuple.

    ``columns`` are what ``step`` needs of a row, ``us`` and ``tie`` first, ``held`` the DDL of the
    tuple.  Keys are dealt over ``buckets`` by their hash.  A bucket's waiting rows are tables of
    Arrow, one for each frame that came, and what its keys hold is another, so state and timers are called once a
    bucket, not once a key; a wake-up reads the bucket's keys, and writes them if one has changed.
    Timers lie on a grid of ``grain_ms``, so that a bucket with rows at many times wakes up
    once a step, and a waiting row is read and put back about delay / grain times, not once
    for each row before it.  ``buckets`` stays as at a query's first start.  Rows of a NULL key are
    left out, as the batch operators leave them out; ``run_processor`` marks them.
    """

    columns: str = ""
    held: str = ""
    time_mode = "eventTime"
    grain_ms = 60_000
    buckets = 1024
    #: Names of the key's columns, from ``run_processor``
    keys: list[str] = []

    def step(self, key, held, row) -> tuple[tuple | None, list[tuple]]:
        """What the key holds after ``row``, and the result rows."""
        raise NotImplementedError

    def due(self, held) -> int | None:
        """The last time (µs) at which a row may come before ``on_due``."""
        return None

    def on_due(self, key, held) -> tuple[tuple | None, list[tuple]]:
        return None, []

    def place(self, row) -> tuple:
        """Rows are taken in this order."""
        return row[:2]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "rows binary")
        self.kept = handle.getValueState("held", "keys binary")
        self.names = [field.split()[0] for field in self.columns.split(", ")]
        self.row = namedtuple("Row", self.names)

    def _wake(self, us: int) -> None:
        self.handle.registerTimer(-(-us // (1000 * self.grain_ms)) * self.grain_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        first = None
        for frame in rows:
            kept = frame.loc[~frame[_KEYLESS].astype(bool), list(dict.fromkeys([*self.keys, *self.names]))]
            if len(kept):
                table = pa.Table.from_pandas(kept, preserve_index=False).replace_schema_metadata()
                self.waiting.appendValue((_packed(table),))
                low = int(kept["us"].min())
                first = low if first is None else min(first, low)
        if first is not None:
            self._wake(first)
        return iter(())

    def _held(self) -> dict[tuple, tuple]:
        """What the bucket's keys hold."""
        if not self.kept.exists():
            return {}
        keys, n = _unpacked(self.kept.get()[0]), len(self.keys)
        return {row[:n]: row[n:] for row in _tuples(keys, keys.column_names)}

    def _hold(self, held: dict[tuple, tuple]) -> None:
        if not held:
            self.kept.clear()
            return
        columns = [pa.array(c) for c in zip(*[(*key, *values) for key, values in held.items()])]
        self.kept.update((_packed(pa.table(columns, names=[f"c{i}" for i in range(len(columns))])),))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now_us = timerValues.getCurrentWatermarkInMs() * 1000
        ready, rest = [], None
        if self.waiting.exists():
            rows = pa.concat_tables([_unpacked(value) for value, in self.waiting.get()])
            passed = pc.less_equal(rows.column("us"), now_us)
            due, rest = rows.filter(passed), rows.filter(pc.invert(passed))
            ready = list(zip(map(self.row._make, _tuples(due, self.names)), _tuples(due, self.keys)))
            ready.sort(key=lambda r: self.place(r[0]))
        before = self._held()
        held_by, out = dict(before), []

        def take(key, held, more):
            out.extend(more)
            if held is None:
                held_by.pop(key, None)
            else:
                held_by[key] = held
            return held

        for row, key in ready:
            held = held_by.get(key)
            while held is not None and (at := self.due(held)) is not None and at < row.us:
                held = take(key, *self.on_due(key, held))
            take(key, *self.step(key, held, row))
        for key, held in list(held_by.items()):
            while held is not None and (at := self.due(held)) is not None and at <= now_us:
                held = take(key, *self.on_due(key, held))
        if ready and rest.num_rows:
            self.waiting.put([(_packed(rest),)])
        elif ready:
            self.waiting.clear()
        if held_by != before:
            self._hold(held_by)
        wakes = [at for held in held_by.values() if (at := self.due(held)) is not None]
        if rest is not None and rest.num_rows:
            wakes.append(pc.min(rest.column("us")).as_py())
        if wakes:
            # behind the grid point just reached: rows and dues at or before the watermark are done
            self._wake(max(min(wakes), now_us + 1))
        yield from self._frame(out)


class AnchoredFailures(OrderedProcessor):
    """Warns of each failure less than ``within_us`` after the first of its streak.

    Wants a boolean ``fail``.  Held: first failure and length of the open streak.
    """

    output = "user_id bigint, first_us bigint, last_us bigint, msg string"
    columns = "us bigint, tie bigint, fail boolean"
    held = "first_us bigint, size bigint"

    def __init__(self, within_us: int, label: str = "login fail in 2s for %d times."):
        self.within_us, self.label = within_us, label

    def step(self, key, held, row):
        if not row.fail:
            return None, []
        if held is None:
            return (int(row.us), 1), []
        first_us, size = held
        warned = row.us - first_us < self.within_us
        return (first_us, size + 1), [(key[0], first_us, int(row.us), self.label % size)] if warned else []


class ChainedFailures(OrderedProcessor):
    """Warns of each failure at most ``within_us`` after the remembered one, which moves on a match only."""

    output = "user_id bigint, first_us bigint, last_us bigint, msg string"
    columns = "us bigint, tie bigint, fail boolean"
    held = "us bigint"

    def __init__(self, within_us: int, label: str = "login fail"):
        self.within_us, self.label = within_us, label

    def step(self, key, held, row):
        if not row.fail:
            return None, []
        if held is None or row.us - held[0] > self.within_us:
            return held or (int(row.us),), []
        return (int(row.us),), [(key[0], held[0], int(row.us), self.label)]


class FailureBursts(OrderedProcessor):
    """A timer burst: the first failure waits ``wait_us``; a success cancels; two or
    more failures when the wait ends give one warning."""

    output = "user_id bigint, first_us bigint, last_us bigint, msg string"
    columns = "us bigint, tie bigint, fail boolean"
    held = "first_us bigint, last_us bigint, size bigint"

    def __init__(self, wait_us: int, label: str = "login fail in 2s for %d times."):
        self.wait_us, self.label = wait_us, label

    def step(self, key, held, row):
        if not row.fail:
            return None, []
        if held is None:
            return (int(row.us), int(row.us), 1), []
        return (held[0], int(row.us), held[2] + 1), []

    def due(self, held):
        return held[0] + self.wait_us

    def on_due(self, key, held):
        first_us, last_us, size = held
        return None, [(key[0], first_us, last_us, self.label % size)] if size >= 2 else []


class ClickCap(OrderedProcessor):
    """Passes ``cap`` rows of a key per day, warns once, drops the rest.

    Days are those of ``day`` (a day number computed from the event).  As rows come in
    event time, one day is open at a time; its count goes when the day has ended.
    """

    output = "user_id bigint, target string, us bigint, tie bigint, tag string"
    columns = "us bigint, tie bigint, day bigint"
    held = "day bigint, size bigint"

    def __init__(self, cap: int, day_offset_us: int):
        self.cap, self.day_offset_us = cap, day_offset_us

    def step(self, key, held, row):
        size = held[1] if held and held[0] == row.day else 0
        tag = "pass" if size < self.cap else "blacklist" if size == self.cap else None
        return (int(row.day), size + 1), [(key[0], key[1], int(row.us), int(row.tie), tag)] if tag else []

    def due(self, held):
        return (held[0] + 1) * 86_400_000_000 - self.day_offset_us - 1


class OrderStatus(OrderedProcessor):
    """``order_status`` for streams: create and pay of an order, with a timer for the missing pay.

    Wants ``kind`` ('create' or 'pay').  A create that is not paid in time is held ``late_us``
    longer for a late pay, then times out.
    """

    output = "order_id bigint, status string"
    columns = "us bigint, tie bigint, kind string"
    held = "create_us bigint"

    def __init__(self, within_us: int, late_us: int = 0):
        self.within_us, self.late_us = within_us, late_us

    def place(self, row):
        return row.us, row.kind != "create", row.tie

    def step(self, key, held, row):
        in_time = held is not None and row.us - held[0] <= self.within_us
        if row.kind == "create":
            return (int(row.us),), [] if held is None or in_time else [(key[0], TIMEOUT)]
        if row.kind != "pay":
            return held, []
        return None, [(key[0], NOT_CREATED if held is None else PAID if in_time else PAID_LATE)]

    def due(self, held):
        return held[0] + self.within_us + self.late_us

    def on_due(self, key, held):
        return None, [(key[0], TIMEOUT)]


class TwoStreamMatch(OrderedProcessor):
    """``first_come_match`` for streams: a row waits for the other side until its time is over.

    Wants ``side`` ('pay' or 'receipt').  A further row of the side that waits
    takes its place, as there is one slot.
    """

    output = "tx_id string, pay_tie bigint, receipt_tie bigint, tag string"
    columns = "us bigint, tie bigint, side string"
    held = "us bigint, tie bigint, side string"

    def __init__(self, pay_wait_us: int = 5_000_000, receipt_wait_us: int = 3_000_000):
        self.wait_us = {"pay": pay_wait_us, "receipt": receipt_wait_us}

    def step(self, key, held, row):
        if row.side not in self.wait_us:
            return held, []
        if held is None or held[2] == row.side:
            return (int(row.us), int(row.tie), row.side), []
        pair = (int(row.tie), held[1]) if row.side == "pay" else (held[1], int(row.tie))
        return None, [(key[0], *pair, MATCHED)]

    def due(self, held):
        return held[0] + self.wait_us[held[2]]

    def on_due(self, key, held):
        lone = (held[1], None, LEFT_ONLY) if held[2] == "pay" else (None, held[1], RIGHT_ONLY)
        return None, [(key[0], *lone)]


class SequenceMatch(KeyedProcessor):
    """``match_sequence`` for streams, with rows taken in event time.

    Wants ``fits``, a bit per step whose predicate the row meets.  Rows wait until
    the watermark has passed them; open matches end ``within_us`` after their start.
    """

    output = "user_id bigint, ids array<bigint>, status string"
    time_mode = "eventTime"

    def __init__(self, steps: int, within_us: int, strict: bool):
        self.steps, self.within_us, self.strict = steps, within_us, strict

    def open(self, handle):
        self.pending = handle.getListState("pending", "us bigint, tie bigint, fits bigint")
        self.open_matches = handle.getListState("open", "us bigint, ids array<bigint>")

    def handleInputRows(self, key, rows, timerValues):
        added = [(int(r.us), int(r.tie), int(r.fits)) for r in _ordered(rows)]
        self.pending.appendList(added)
        self.handle.registerTimer(_due_ms(min(us for us, _, _ in added)))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        watermark_us = timerValues.getCurrentWatermarkInMs() * 1000
        waiting = sorted(tuple(r) for r in self.pending.get()) if self.pending.exists() else []
        matches = [(us, list(ids)) for us, ids in self.open_matches.get()] if self.open_matches.exists() else []
        out = []

        def expire(now):
            for us, ids in matches:
                if now - us >= self.within_us:
                    out.append((key[0], ids, "timeout"))
            matches[:] = [m for m in matches if now - m[0] < self.within_us]

        ready = [r for r in waiting if r[0] <= watermark_us]
        for us, tie, fits in ready:
            expire(us)
            going_on = []
            for start, ids in matches:
                if fits >> len(ids) & 1:
                    ids = [*ids, tie]
                    if len(ids) == self.steps:
                        out.append((key[0], ids, "match"))
                    else:
                        going_on.append((start, ids))
                elif not self.strict:
                    going_on.append((start, ids))
            if fits & 1:
                going_on.append((us, [tie]))
            matches[:] = going_on
        expire(watermark_us)

        rest = waiting[len(ready):]
        self._replace(self.pending, rest)
        self._replace(self.open_matches, matches)
        wake = [rest[0][0]] if rest else []
        if matches:
            wake.append(min(us for us, _ in matches) + self.within_us)
        for at_us in wake:
            self.handle.registerTimer(_due_ms(at_us))
        yield from self._frame(out)

    @staticmethod
    def _replace(state, rows):
        if rows:
            state.put(rows)
        else:
            state.clear()
