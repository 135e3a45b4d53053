"""Fixed-capacity containers filled from source queues by deficit round-robin."""

from __future__ import annotations

import math
from bisect import bisect_right, insort
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainloom.session import cut

#: Tokens one packing task handles, in every round: its queues are bounded by this, not by any source.
TASK_TOKENS = 8_000_000
#: A task's windows below this fill give their items to the next round.
GOOD_FILL = 0.97
#: Rounds go on while each leaves less than this share of the tokens it was given.
GAIN = 0.5
#: Within this share of the capacity from full, the place goes to whatever fills it best.
CLOSING = 0.02
#: Sources that are owed shares of their own; those beyond share one queue.
OWN_QUEUES = 1000
FIELDS = ("container", "part", "window", "doc_id", "piece", "tokens", "window_tokens", "source", "queue", "owed")


class Queues:
    """Items by source and size; takes the largest within a bound."""

    def __init__(self):
        self.sizes: dict[str, list[int]] = defaultdict(list)
        self.items: dict[tuple[str, int], list] = defaultdict(list)

    def put(self, source: str, size: int, item) -> None:
        own = self.items[source, size]
        if not own:
            insort(self.sizes[source], size)
        own.append(item)

    def fits(self, source: str, room: float) -> int:
        s = self.sizes[source]
        i = bisect_right(s, room)
        return s[i - 1] if i else 0

    def take(self, source: str, size: int):
        own = self.items[source, size]
        item = own.pop()
        if not own:
            s = self.sizes[source]
            del s[bisect_right(s, size) - 1]
        return item

    def sources(self) -> list[str]:
        return [s for s, v in self.sizes.items() if v]


def fill_windows(q: Queues, capacity: int, share: dict[str, float], owed: dict[str, float]) -> Iterator[list]:
    """Windows of (source, size, item) lists until the queues are empty.

    Each window grants every waiting source its share of the capacity as
    deficit. The source owed most puts in an item and owes that much less;
    what is owed carries over to the next window. Deficits decide which
    source goes; its item is the largest that fits the window and is owed in
    full, or, where none is (and at a window's start), the largest that fits.
    Only the item that would leave less than ``CLOSING`` of the window free
    may give way to one of any source that leaves less.
    """
    while True:
        live = q.sources()
        if not live:
            return
        total = sum(share.get(s, 0.0) for s in live) or 1.0
        for s in live:
            owed[s] = owed.get(s, 0.0) + capacity * share.get(s, 0.0) / total
        room, window = capacity, []
        while room > 0:
            fit = [(owed[s], s, n) for s in live if (n := q.fits(s, room))]
            if not fit:
                break
            debt, s, n = max(fit)
            if window:
                n = q.fits(s, min(room, debt)) or n
            if room - n < CLOSING * capacity:
                _, most, s2 = max((k, o, x) for o, x, k in fit)
                k = q.fits(s2, room)
                if k > n:
                    s, n = s2, k
            window.append((s, n, q.take(s, n)))
            owed[s] -= n
            room -= n
        yield window


class _Pack:
    """Packs each run of equal (container, part) of a sorted stream."""

    def __init__(self, share: dict[str, float], last: bool):
        self.share, self.last = share, last

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, q, owed = None, Queues(), {}
        for b in batches:
            for kind, part, capacity, queue, doc, piece, n, source, debt in zip(*[c.to_pylist() for c in b.columns[:9]]):
                if (kind, part, capacity) != now:
                    if now is not None:
                        yield from self._run(now, q, owed)
                    now, q, owed = (kind, part, capacity), Queues(), {}
                if debt is not None:  # what a task of the round before ended with
                    owed[queue] = owed.get(queue, 0.0) + debt
                else:
                    q.put(queue, n, (doc, piece, source))
        if now is not None:
            yield from self._run(now, q, owed)

    def _run(self, now, q, owed) -> Iterator[pa.RecordBatch]:
        kind, part, capacity = now
        rows: list[tuple] = []
        number = 0
        for w in fill_windows(q, capacity, self.share, owed):
            full = sum(n for _, n, _ in w)
            done = self.last or full >= GOOD_FILL * capacity
            for s, n, (doc, piece, source) in w:
                rows.append((kind, part, number if done else -1, doc, piece, n, full if done else 0, source, s, None))
                if not done:  # it was not served after all
                    owed[s] += n
            number += done
            if len(rows) > 20_000:
                yield self._out(rows)
                rows = []
        if not self.last:
            rows += [(kind, part, -1, None, 0, 0, 0, None, s, v) for s, v in owed.items() if v]
        if rows:
            yield self._out(rows)

    @staticmethod
    def _out(rows) -> pa.RecordBatch:
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=list(FIELDS))


SCHEMA = "container string, part bigint, window bigint, doc_id bigint, piece bigint, tokens bigint, window_tokens bigint, source string, queue string, owed double"
RESULT = ("container", "part", "window", "doc_id", "piece", "tokens", "window_tokens", "source")


def pack(sizes: DataFrame, containers: list[tuple[str, int]], share: dict[str, float] | None = None, task_tokens: int = TASK_TOKENS, own_queues: int = OWN_QUEUES) -> DataFrame:
    """Containers for items: ``sizes`` has ``doc_id``, ``source``, ``tokens``; ``containers`` (kind, capacity) pairs.

    Result: one row for each piece: container kind, ``part`` and ``window``
    (together the container's number), ``doc_id``, ``piece`` (0 unless the
    item alone exceeds the capacity; then full containers and a rest),
    ``tokens``, ``window_tokens`` (the container's fill), ``source``.

    Items are spread over tasks of about ``task_tokens`` by a hash of the id,
    so that every task sees the sources in their true proportions and a source
    of any size is divided. Each task fills windows by deficit round-robin
    towards ``share`` (default: the sources' shares of all tokens). The items
    of windows that end badly filled, and the deficits the task ends with, go
    to another round of tasks of the same size, as many as those items need.
    When they need one task only, or when a round leaves more than ``GAIN`` of
    its tokens unplaced (these sizes can't fill a window), windows are closed
    as they come. No task in any round is given more than its share.

    The ``own_queues`` largest sources have queues and shares of their own;
    all others wait in one queue under their joint share. Null sources are a
    source of their own ("(none)"); items of no tokens (null or empty text) go
    into no container; an empty table gives an empty result; ids should be
    unique (repeated ones are items of their own), null ids are items too.
    """
    given = sizes.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("source"), F.lit("(none)")).alias("source"), F.col("tokens").cast("bigint").alias("tokens")).where("tokens > 0")
    s = cut(given)
    by = s.groupBy("source").agg(F.sum("tokens").alias("n"))
    top = by.orderBy(F.col("n").desc(), "source").limit(own_queues).collect()  # one row a queue
    total = s.agg(F.sum("tokens")).first()[0] or 0
    rest = total - sum(r["n"] for r in top)
    goal = dict(share) if share else {r["source"]: r["n"] / total for r in top}
    name = F.col("source")
    if rest:
        joint = "(rest)"
        while any(r["source"] == joint for r in top):
            joint += "_"
        goal.setdefault(joint, rest / total)
        name = F.when(F.col("source").isin([r["source"] for r in top]), name).otherwise(joint)
    capacities = dict(containers)
    k = F.explode(F.array(*[F.struct(F.lit(c).alias("container"), F.lit(int(n)).cast("bigint").alias("capacity")) for c, n in containers]))
    d = s.withColumn("queue", name).select("*", k.alias("k")).select("k.container", "k.capacity", "queue", "source", "doc_id", "tokens")
    whole = F.col("tokens") <= F.col("capacity")
    full = F.floor(F.col("tokens") / F.col("capacity"))
    over = F.col("tokens") - full * F.col("capacity")
    # Full pieces are full containers; no task needs to see them.
    own = d.where(~whole).select("container", F.lit(-1).cast("bigint").alias("part"), F.explode(F.sequence(F.lit(0).cast("bigint"), full - 1)).alias("piece"), "doc_id", F.col("capacity").alias("tokens"), F.col("capacity").alias("window_tokens"), "source")
    # Null ids have no number of their own; the row's place in the checkpoint serves.
    at = F.coalesce(F.col("doc_id"), F.monotonically_increasing_id())
    done = own.select("container", "part", F.concat_ws("-", at, "piece").alias("window"), "doc_id", "piece", "tokens", "window_tokens", "source")
    rows = d.where(whole | (over > 0)).select(
        "container", "capacity", "queue", "doc_id", F.when(whole, 0).otherwise(full).cast("bigint").alias("piece"), F.when(whole, F.col("tokens")).otherwise(over).alias("tokens"), "source",
        F.lit(None).cast("double").alias("owed"), F.xxhash64(at, "container").alias("_h"),
    )
    size = {c: total for c in capacities}  # tokens each kind has to place
    base, level, last = 0, 0, False
    while True:
        parts = {c: max(1, math.ceil(n / task_tokens)) for c, n in size.items()}
        last = last or all(n == 1 for n in parts.values())
        count = F.create_map(*[x for c, n in parts.items() for x in (F.lit(c), F.lit(n))])[F.col("container")]
        r = rows.select("container", F.pmod("_h", count).cast("bigint").alias("part"), "capacity", "queue", "doc_id", "piece", "tokens", "source", "owed")
        r = r.repartition(min(sum(parts.values()), 20_000), "container", "part").sortWithinPartitions("container", "part", "queue", "tokens", "doc_id", "piece")
        out = cut(r.mapInArrow(_Pack(goal, last), SCHEMA))
        fine = out.where("window >= 0").withColumn("window", F.col("window").cast("string")).withColumn("part", F.col("part") + base)
        done = done.unionByName(fine.select(*RESULT))
        if last:
            return done
        base, level = base + max(parts.values()), level + 1
        # One row a kind of container.
        left = {x["container"]: x["n"] for x in out.where("window < 0").groupBy("container").agg(F.sum("tokens").alias("n")).collect()}
        left = {c: left.get(c, 0) for c in capacities}
        last = any(left[c] > max(GAIN * size[c], task_tokens) for c in capacities)
        size = left
        capacity = F.create_map(*[x for c, n in containers for x in (F.lit(c), F.lit(int(n)).cast("bigint"))])[F.col("container")]
        # Items part anew; a task's deficits stay together.
        h = F.when(F.col("owed").isNull(), F.xxhash64(F.coalesce(F.col("doc_id"), F.monotonically_increasing_id()), "container", F.lit(level))).otherwise(F.xxhash64("part", "container"))
        rows = out.where("window < 0").select("container", capacity.alias("capacity"), "queue", "doc_id", "piece", "tokens", "source", "owed", h.alias("_h"))


def mixture(packed: DataFrame) -> DataFrame:
    """Per kind of container and source: share of all tokens packed, mean share and mean distance from it in a window.

    ``window_l1`` is the mean over windows of the sum of the distances of all
    sources. Containers filled by a piece of one item that exceeds them leave
    no choice and are left out, as are their pieces.
    """
    p = packed.where("part >= 0")
    own = p.groupBy("container", "part", "window", "source").agg(F.sum("tokens").alias("n"), F.max("window_tokens").alias("full"))
    # One row a kind and source, one a kind: both fixed in number, joined by hash or broadcast as their size allows.
    kinds = p.groupBy("container", "part", "window").agg(F.sum("tokens").alias("n")).groupBy("container").agg(F.count("*").alias("windows"), F.sum("n").alias("every"))
    goal = p.groupBy("container", "source").agg(F.sum("tokens").alias("n")).join(kinds, "container").select("container", "source", "windows", (F.col("n") / F.col("every")).alias("target_share"))
    part = F.col("n") / F.col("full")
    there = own.join(goal, ["container", "source"]).groupBy("container", "source").agg(
        F.first("target_share").alias("target_share"), F.first("windows").alias("windows"), F.count("*").alias("there"), F.sum(part).alias("parts"), F.sum(F.abs(part - F.col("target_share"))).alias("off")
    )
    off = (F.col("off") + (F.col("windows") - F.col("there")) * F.col("target_share")) / F.col("windows")
    r = there.select("container", "source", "windows", F.round("target_share", 4).alias("target_share"), F.round(F.col("parts") / F.col("windows"), 4).alias("actual_share"), off.alias("off"))
    l1 = r.groupBy("container").agg(F.round(F.sum("off"), 4).alias("window_l1"))
    return r.join(l1, "container").withColumn("mean_distance", F.round("off", 4)).drop("off")
