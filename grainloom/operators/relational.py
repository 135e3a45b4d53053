"""Keyed upserts, mirrors, deduplication and lookups as set operations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key. Null keys are one key. Plans as a group limit: one row a key leaves each partition."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def match(a: Sequence[str], left: str = "t", right: str = "s") -> Column:
    return reduce(lambda x, y: x & y, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in a])


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], *, order: Sequence[Column] = (), update: Sequence[str] | None = None, keep_if_null: Sequence[str] = (), keep_if_blank: Sequence[str] = ()) -> DataFrame:
    """``target`` after ``source`` was written into it by key: one full outer join.

    Of several source rows of a key the first under ``order`` counts (give
    it descending for last-wins). ``update`` names the columns the source may
    change (default all that are not keys); ``keep_if_null`` and
    ``keep_if_blank`` leave the old value where the new one is null or "".
    Applying the same source again changes nothing.
    """
    s = keep_first(source, keys, list(order) or [F.lit(1)])
    change = [c for c in target.columns if c not in keys and c in source.columns] if update is None else list(update)
    t = target.withColumn("_t", F.lit(True)).alias("t")
    j = t.join(s.withColumn("_s", F.lit(True)).alias("s"), match(keys), "full_outer")
    both = F.col("s._s").isNotNull()
    out = []
    for c in target.columns:
        old = F.col(f"t.{c}")
        if c in keys:
            v = F.when(F.col("t._t").isNotNull(), old).otherwise(F.col(f"s.{c}"))
        elif c in source.columns and (c in change):
            new = F.col(f"s.{c}")
            if c in keep_if_null:
                new = F.coalesce(new, old)
            if c in keep_if_blank:
                new = F.coalesce(F.nullif(new, F.lit("")), old)
            v = F.when(both, new).otherwise(old)
        elif c in source.columns:
            v = F.when(F.col("t._t").isNotNull(), old).otherwise(F.col(f"s.{c}"))
        else:
            v = old
        out.append(v.cast(target.schema[c].dataType).alias(c))
    return j.select(*out)


def snapshot_mirror(target: DataFrame, source: DataFrame, key: str, *, refresh: Sequence[str], keep_if_blank: Sequence[str] = ()) -> DataFrame:
    """``target`` made to hold exactly the keys of ``source``: new rows in, known ones refreshed, vanished ones out.

    An empty source changes nothing. One pass: the guard is a window-free
    count joined to every row.
    """
    got = source.agg(F.count("*").alias("n"))
    up = upsert(target, source, [key], update=list(refresh), keep_if_blank=keep_if_blank).alias("u")
    alive = up.join(source.select(key).distinct(), key, "left_semi").select(*target.columns)
    nothing = F.broadcast(got.select((F.col("n") == 0).alias("_empty")).where("_empty"))  # one row or none
    untouched = target.withColumn("_empty", F.lit(True)).join(nothing, "_empty").select(*target.columns)
    return alive.unionByName(untouched)


def replace_children(children: DataFrame, touched: DataFrame, new: DataFrame, parent: str) -> DataFrame:
    """Children of touched parents give way to the new ones, perhaps none."""
    return children.join(touched.select(parent).distinct(), parent, "left_anti").select(*children.columns).unionByName(new.select(*children.columns))


def fallback_union(primary: DataFrame, secondary: DataFrame, key: str) -> DataFrame:
    """All of ``primary``, and ``secondary`` for keys primary has nothing for."""
    return primary.unionByName(secondary.join(primary.select(key).distinct(), key, "left_anti").select(*secondary.columns))


def two_pass_lookup(df: DataFrame, dim: DataFrame, pairs: Sequence[tuple[str, str]], value: str, name: str) -> DataFrame:
    """``value`` of the dimension row found by the first pair of columns that matches; the least on ties.

    One equi-join a pair instead of a join on alternatives.
    """
    out = df
    for i, (mine, theirs) in enumerate(pairs):
        side = dim.where(F.col(theirs).isNotNull()).groupBy(F.col(theirs).alias(f"_k{i}")).agg(F.min(value).alias(f"_v{i}"))
        out = out.join(side, F.col(mine) == F.col(f"_k{i}"), "left").drop(f"_k{i}")
    return out.withColumn(name, F.coalesce(*[F.col(f"_v{i}") for i in range(len(pairs))])).drop(*[f"_v{i}" for i in range(len(pairs))])


def reconcile(df: DataFrame, schema: StructType) -> DataFrame:
    """``df`` with the columns a schema has and it lacks, null, at the end."""
    return df.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in schema if f.name not in df.columns])


def positional_join(left: DataFrame, right: DataFrame, seq: str, how: str = "left") -> DataFrame:
    return left.join(right, seq, how)


def within_lengths(df: DataFrame, limits: dict[str, int]) -> tuple[DataFrame, DataFrame]:
    """Rows whose texts fit their columns, and the others."""
    ok = reduce(lambda a, b: a & b, [F.coalesce(F.length(c) <= n, F.lit(True)) for c, n in limits.items()])
    return df.where(ok), df.where(~ok)
