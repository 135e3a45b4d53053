"""Irregular cumulative readings onto a regular grid."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A chunk of a series is never longer than this many grid cells, so that the
#: window over one chunk has a bounded number of rows however hot the key is.
CHUNK_CELLS = 1024


def usable(day: Column, value: Column, first: str = "2015-01-01", last: str = "2025-06-30") -> Column:
    """A reading that may enter a series: day and value known, value not negative, day in range."""
    return F.coalesce(
        day.isNotNull() & value.isNotNull() & (value >= 0)
        & day.between(F.lit(first).cast("date"), F.lit(last).cast("date")),
        F.lit(False),
    )


def one_per(df: DataFrame, keys: Sequence[str], order: Sequence[Column], keep: Sequence[str]) -> DataFrame:
    """One row for each combination of ``keys``: the greatest by ``order``, nulls lowest.

    A hash aggregate with map-side combine; replays of a key never meet in one
    task unreduced. Rows equal in ``order`` are settled by the kept values.
    """
    rank = F.struct(*[c.alias(f"_o{i}") for i, c in enumerate(order)], *[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)])
    best = df.groupBy(*keys).agg(F.max(rank).alias("_best"))
    return best.select(*keys, *[F.col(f"_best._k{i}").alias(c) for i, c in enumerate(keep)])


def with_previous(df: DataFrame, keys: Sequence[str], at: str, values: Sequence[str], chunk: int) -> DataFrame:
    """Adds ``_prev``: the struct of ``at`` and ``values`` of the reading before.

    The window is partitioned by key *and* stretch of ``chunk`` units of
    ``at``; the reading before a stretch comes from a table of the last
    reading of each stretch. No task holds the whole of one key.
    """
    cols = [at, *values]
    d = df.withColumn("_chunk", F.floor(F.col(at) / F.lit(chunk)))
    here = F.struct(*[F.col(c) for c in cols])
    w = Window.partitionBy(*keys, "_chunk").orderBy(at)
    ends = d.groupBy(*keys, "_chunk").agg(F.max_by(here, F.col(at)).alias("_last"))
    before = ends.withColumn("_carry", F.lag("_last").over(Window.partitionBy(*keys).orderBy("_chunk"))).select(*keys, "_chunk", "_carry")
    cond = [*keys, "_chunk"]
    return (
        d.withColumn("_in", F.lag(here).over(w))
        .join(before, cond, "left")
        .withColumn("_prev", F.coalesce("_in", "_carry"))
        .drop("_in", "_carry", "_chunk")
    )


def regular_grid(
    df: DataFrame,
    keys: Sequence[str],
    at: str,
    value: str,
    *,
    cell: int = 1,
    reset_below: float = 0.5,
    max_gap: int | None = None,
) -> DataFrame:
    """A regular series per key from irregular readings of a cumulative counter.

    ``at`` is an integer position (days, seconds, ...), the end of the time a
    reading speaks for; ``cell`` is the width of a grid cell in the same unit.
    Cell ``c`` covers the positions ``(c*cell - cell, c*cell]``, so that with
    whole days and ``cell=1`` the cell is the day of the reading itself.

    Consecutive readings are differenced. A fall below ``reset_below`` times
    the earlier value is a reset of the counter: the increment is then the new
    value. A smaller fall is a correction and counts as a negative increment.
    Each increment is spread over the cells between its two readings in
    proportion to their overlap. Cells run from the first reading's to the
    last reading's; a cell no reading falls in is marked ``filled``, or
    ``uncovered`` with null increment if its gap is longer than ``max_gap``.

    Columns: keys, ``cell`` BIGINT, ``readings`` BIGINT, ``increment`` DOUBLE,
    ``value`` DOUBLE (the counter at the cell's end: read, or interpolated
    inside a gap; null if uncovered), ``resets`` BIGINT, ``mark`` STRING.

    Rows with a null position or value are left out; several readings at one
    position count as the greatest value (choose beforehand with ``one_per``
    for another rule); an empty input gives an empty result; other columns
    are dropped; null keys form a series of their own.
    """
    named = {k: f"_key{i}" for i, k in enumerate(keys)}
    ks = list(named.values())
    r = df.select(*[F.col(k).alias(n) for k, n in named.items()], F.col(at).cast("bigint").alias("_t"), F.col(value).cast("double").alias("_v"))
    r = r.where(F.col("_t").isNotNull() & F.col("_v").isNotNull() & ~F.isnan("_v"))
    r = r.groupBy(*ks, "_t").agg(F.max("_v").alias("_v"))
    # Null keys do not meet in an equi-join; a null flag and a filler do.
    safe = []
    types = dict(r.dtypes)
    for k in ks:
        r = r.withColumn(f"{k}_n", F.col(k).isNull())
        if types[k] in ("string", "bigint", "int"):
            r = r.withColumn(k, F.coalesce(F.col(k), F.lit("" if types[k] == "string" else 0).cast(types[k])))
        safe += [k, f"{k}_n"]
    p = with_previous(r, safe, "_t", ["_v"], CHUNK_CELLS * cell)
    t0, v0 = F.col("_prev._t"), F.col("_prev._v")
    fell = v0.isNotNull() & (F.col("_v") < v0 * F.lit(reset_below))
    inc = F.when(v0.isNull(), F.lit(0.0)).when(fell, F.col("_v")).otherwise(F.col("_v") - v0)
    to_cell = lambda t: F.ceil(t.cast("double") / F.lit(float(cell))).cast("bigint")
    p = p.select(
        *safe, "_t", "_v", inc.alias("_inc"), fell.cast("bigint").alias("_reset"), t0.alias("_t0"), v0.alias("_v0"),
        to_cell(F.col("_t")).alias("_c1"), to_cell(F.coalesce(t0, F.col("_t"))).alias("_c0"),
    )
    p = p.withColumn("_c", F.explode(F.sequence(F.col("_c0"), F.col("_c1"))))
    lo = F.greatest(F.col("_t0"), F.col("_c") * cell - cell)
    hi = F.least(F.col("_t"), F.col("_c") * cell)
    span = (F.col("_t") - F.col("_t0")).cast("double")
    part = F.when(F.col("_t0").isNull(), 0.0).otherwise(F.col("_inc") * (hi - lo) / span)
    start = F.when(F.col("_reset") == 1, F.lit(0.0)).otherwise(F.coalesce("_v0", "_v"))
    inside = F.when(F.col("_t0").isNull(), F.col("_v")).otherwise(start + F.col("_inc") * (hi - F.col("_t0")) / span)
    lost = F.lit(False) if max_gap is None else (span > F.lit(float(max_gap)))
    is_end = F.col("_c") == F.col("_c1")
    is_open = (F.col("_c") == F.col("_c0")) & ~is_end
    p = p.select(
        *safe, F.col("_c"),
        F.when(is_end, 1).otherwise(0).cast("bigint").alias("_n"),
        part.alias("_part"),
        F.when(is_end, F.col("_reset")).otherwise(0).alias("_reset"),
        F.coalesce(lost, F.lit(False)).alias("_lost"),
        F.struct(hi.alias("t"), F.when(is_end, F.col("_v")).otherwise(inside).alias("v")).alias("_at"),
        is_open.alias("_open"),
    )
    # The opening cell of a stretch holds the reading before; day grids have no overlap there.
    if cell == 1:
        p = p.where(~F.col("_open"))
        cells = p.select(*safe, F.col("_c").alias("cell"), F.col("_n").alias("readings"), F.col("_part").alias("increment"), F.col("_at.v").alias("value"), F.col("_reset").alias("resets"), (F.col("_lost") & (F.col("_n") == 0)).alias("_lost"))
    else:
        cells = p.groupBy(*safe, F.col("_c").alias("cell")).agg(
            F.sum("_n").alias("readings"), F.sum("_part").alias("increment"), F.max("_at").alias("_at"), F.sum("_reset").alias("resets"), F.max("_lost").alias("_lost"),
        ).withColumn("_lost", F.col("_lost") & (F.col("readings") == 0)).withColumn("value", F.col("_at.v"))
    return cells.select(
        *[F.when(~F.col(f"{n}_n"), F.col(n)).alias(k) for k, n in named.items()],
        "cell", "readings",
        F.when(~F.col("_lost"), F.col("increment")).alias("increment"),
        F.when(~F.col("_lost"), F.col("value")).alias("value"),
        "resets",
        F.when(F.col("readings") > 0, "observed").when(F.col("_lost"), "uncovered").otherwise("filled").alias("mark"),
    )
