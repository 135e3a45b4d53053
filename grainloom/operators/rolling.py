"""Rolling totals over trailing periods, for invertible and other aggregates alike."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Days of one entity that one stretch of sorted work covers.
STRETCH = 1024


class TwoStackQueue:
    """The aggregate of a sliding window under any associative operation.

    Two stacks: values are pushed with running aggregates on the back stack;
    when the front stack runs empty the back one is turned over. Each value
    moves once, so a step costs O(1) on average and nothing is subtracted.
    """

    __slots__ = ("op", "unit", "front", "back", "raw")

    def __init__(self, op, unit):
        self.op, self.unit, self.front, self.back, self.raw = op, unit, [], [], []

    def push(self, x) -> None:
        self.raw.append(x)
        self.back.append(x if not self.back else self.op(self.back[-1], x))

    def pop(self) -> None:
        if not self.front:
            acc = None
            for x in reversed(self.raw):
                acc = x if acc is None else self.op(x, acc)
                self.front.append(acc)
            self.back, self.raw = [], []
        self.front.pop()

    def value(self):
        if self.front and self.back:
            return self.op(self.front[-1], self.back[-1])
        return self.front[-1] if self.front else self.back[-1] if self.back else self.unit

    def __len__(self) -> int:
        return len(self.front) + len(self.raw)


def _plus(a, b):
    return a + b


def rolling_totals(
    df: DataFrame,
    entity: str,
    day: str,
    amount: str,
    periods: Sequence[int] = (7, 30),
    *,
    until: int | None = None,
) -> DataFrame:
    """Totals, averages and greatest day over trailing periods, one row per entity and day.

    ``day`` is a day number; ``amount`` what happened that day. Days run from
    an entity's first to its last row (or to ``until``); days without a row
    count as zero. For each period n: ``sum_n``, ``avg_n`` (sum over n),
    ``max_n`` (the greatest daily amount of the period's days since the
    entity's first), and ``active`` marks days that had a row.

    Rows are added up per entity and day first, so that a hot entity has at
    most one row a day; work is then split by entity *and* stretch of days,
    with the days a window reaches back to repeated in the next stretch. A
    stretch is sorted and streamed through one two-stack queue per period.

    Null entity, day or amount: the row is left out. Empty input: empty
    result. Days after ``until`` are left out. Other columns are dropped.
    """
    reach = max(periods)
    d = df.select(F.col(entity).alias("_e"), F.col(day).cast("bigint").alias("_d"), F.col(amount).cast("double").alias("_a"))
    d = d.where(F.col("_e").isNotNull() & F.col("_d").isNotNull() & F.col("_a").isNotNull())
    if until is not None:
        d = d.where(F.col("_d") <= until)
    d = d.groupBy("_e", "_d").agg(F.sum("_a").alias("_a"))
    ends = d.groupBy("_e").agg(F.min("_d").alias("_first"), F.max("_d").alias("_last"))
    if until is not None:
        ends = ends.withColumn("_last", F.lit(until).cast("bigint"))
    part = lambda c: F.floor(c / F.lit(STRETCH))
    # A frame row for each stretch carries the range, so that idle stretches are emitted too.
    frames = ends.select("_e", "_first", "_last", F.explode(F.sequence(part(F.col("_first")), part(F.col("_last")))).alias("_s"))
    frames = frames.select("_e", "_s", F.lit(-(2**40)).cast("bigint").alias("_d"), F.lit(0.0).alias("_a"), "_first", "_last")
    own, nxt = part(F.col("_d")), part(F.col("_d") + reach - 1)
    rows = d.select("_e", F.explode(F.array_distinct(F.array(own, nxt))).alias("_s"), "_d", "_a", F.lit(None).cast("bigint").alias("_first"), F.lit(None).cast("bigint").alias("_last"))
    both = rows.unionByName(frames).repartition("_e", "_s").sortWithinPartitions("_e", "_s", "_d")
    kind = dict(d.dtypes)["_e"]
    out = ", ".join([f"_e {kind}", "day bigint", "amount double", "active boolean", *[f"sum_{n} double, avg_{n} double, max_{n} double" for n in periods]])
    run = _Stretches(tuple(periods))
    res = both.mapInArrow(run, out)
    return res.withColumnRenamed("_e", entity)


class _Stretches:
    """Streams sorted (entity, stretch, day) rows and emits finished days batch by batch."""

    def __init__(self, periods: tuple[int, ...]):
        self.periods = periods

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["_e", "day", "amount", "active"] + [f"{k}_{n}" for n in self.periods for k in ("sum", "avg", "max")]
        self.buf: list[list] = [[] for _ in names]
        state = None
        kind = None
        for b in batches:
            kind = b.schema.field("_e").type
            cols = [b.column(i).to_pylist() for i in range(6)]
            for e, s, d, a, first, last in zip(*cols):
                if state is None or state[0] != e or state[1] != s:
                    if state is not None:
                        self._finish(state)
                    state = (e, s, first, last, {})
                    if d < -(2**39):
                        continue
                state[4][d] = a
            if len(self.buf[0]) >= 20_000:
                yield self._flush(names, kind)
        if state is not None:
            self._finish(state)
        if self.buf[0]:
            yield self._flush(names, kind)

    def _finish(self, state) -> None:
        e, s, first, last, amounts = state
        if first is None:  # the days a later stretch would need, after the entity's last one
            return
        lo, hi = max(first, s * STRETCH), min(last, s * STRETCH + STRETCH - 1)
        sums = [TwoStackQueue(_plus, 0.0) for _ in self.periods]
        tops = [TwoStackQueue(max, 0.0) for _ in self.periods]
        buf = self.buf
        for d in range(max(first, lo - max(self.periods) + 1), hi + 1):
            a = amounts.get(d)
            x = 0.0 if a is None else a
            for n, q, m in zip(self.periods, sums, tops):
                q.push(x)
                m.push(x)
                if len(q) > n:
                    q.pop()
                    m.pop()
            if d >= lo:
                buf[0].append(e)
                buf[1].append(d)
                buf[2].append(x)
                buf[3].append(a is not None)
                k = 4
                for n, q, m in zip(self.periods, sums, tops):
                    v = q.value()
                    buf[k].append(v)
                    buf[k + 1].append(v / n)
                    buf[k + 2].append(m.value())
                    k += 3

    def _flush(self, names, kind) -> pa.RecordBatch:
        types = [kind, pa.int64(), pa.float64(), pa.bool_()] + [pa.float64()] * (3 * len(self.periods))
        out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(self.buf, types)], names=names)
        for c in self.buf:
            c.clear()
        return out
