"""The N best rows of every group by a secondary sort, streamed without buffering groups."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _codes(v: pa.Array) -> np.ndarray:
    """A number for each value of a column: equal ones alike."""
    try:
        return v.dictionary_encode("encode").indices.to_numpy(zero_copy_only=False)
    except (pa.ArrowNotImplementedError, pa.ArrowInvalid):  # nested values
        seen: dict[str, int] = {}
        return np.array([seen.setdefault(repr(x), len(seen)) for x in v.to_pylist()], np.int64)


class _FirstN:
    """Passes the first n rows of each run of equal group keys (a hash, then the values behind it) in a sorted stream."""

    def __init__(self, n: int, key: str, values: Sequence[str] = ()):
        self.n, self.key, self.values = n, key, list(values)

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, seen = None, 0
        for b in batches:
            if not b.num_rows:
                continue
            g = np.asarray(b.column(b.schema.get_field_index(self.key)).to_numpy(zero_copy_only=False))
            k = len(g)
            new = np.empty(k, bool)
            new[1:] = g[1:] != g[:-1]
            mine = [b.column(b.schema.get_field_index(v)) for v in self.values]
            for v in mine:  # rows that share the hash are told apart by their values; nulls are equal, NaNs too
                new[1:] |= np.diff(_codes(v)) != 0
            ends = [(int(g[i]), *[repr(v[i].as_py()) for v in mine]) for i in (0, k - 1)]
            new[0] = ends[0] != last
            at = np.arange(k)
            start = np.maximum.accumulate(np.where(new, at, 0))
            rank = at - start
            if not new[0]:  # rows that continue the group of the batch before
                run = int(new.argmax()) if new.any() else k
                rank[:run] += seen
            last, seen = ends[1], int(rank[-1]) + 1
            keep = rank < self.n
            if keep.any():
                yield b if keep.all() else b.filter(pa.array(keep))


def top_n(df: DataFrame, groups: Sequence[Column], order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows of every group under ``order``, all rows of smaller groups.

    ``order`` must settle ties (end it with a unique id); rows equal in all
    of it are kept in an arbitrary but complete manner: n of them.

    Twice the same streaming pass: first inside each input partition, sorted
    by group and order, so that at most n rows a group leave a partition;
    then hash-partitioned by group and sorted again. A group of any size thus
    sends n rows a partition over the network, and no pass holds more than
    one Arrow batch. The sorts spill. Groups travel by a 64-bit hash of their
    values; the values themselves tell apart groups that share one.

    Null group values form a group; an empty table gives an empty result; all
    columns of ``df`` are kept, whatever their names.
    """
    free = "_group"
    while any(c.startswith(free) for c in df.columns):
        free += "_"
    gs = [g.alias(f"{free}{i}") for i, g in enumerate(groups)]
    names = [f"{free}{i}" for i in range(len(groups))]
    # Groups meet by a 64-bit hash of their values and null flags.
    key = F.xxhash64(*[F.struct(F.col(c).isNull().alias("n"), F.col(c).alias("v")) for c in names])
    d = df.select("*", *gs).withColumn(free, key)
    run = _FirstN(n, free, names)
    kinds = d.schema
    for shuffled in (False, True):
        if shuffled:
            d = d.repartition(free)
        d = d.sortWithinPartitions(free, *names, *order).mapInArrow(run, kinds)
    return d.drop(free, *names)
