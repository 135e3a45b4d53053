"""Rollups of cumulative series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Days of a series one window task sees.
STRETCH = 1024


def monotonic(df: DataFrame, key: str, at: str, value: str) -> DataFrame:
    """The running maximum from 0 of each series by date.

    Windows run over stretches of ``STRETCH`` days; what earlier stretches
    reached comes from a table of one row a stretch, so a hot series is
    divided.
    """
    d = df.withColumn("_s", F.floor(F.unix_date(at) / F.lit(STRETCH)))
    tops = d.groupBy(key, "_s").agg(F.max(value).alias("_top"))
    before = tops.withColumn("_before", F.max("_top").over(Window.partitionBy(key).orderBy("_s").rowsBetween(Window.unboundedPreceding, -1))).select(key, "_s", "_before")
    w = Window.partitionBy(key, "_s").orderBy(at).rowsBetween(Window.unboundedPreceding, 0)
    run = d.withColumn("_run", F.max(value).over(w)).join(before, [key, "_s"], "left")
    return run.select(key, at, F.greatest(F.lit(0), F.coalesce("_before", F.lit(0)), F.col("_run")).cast(df.schema[value].dataType).alias(value))


def star_rollup(df: DataFrame, key: str, at: str, value: str, as_of: Column, recent_days: int = 90) -> DataFrame:
    """Daily points of the last ``recent_days``, the last of each month before; monotonic throughout."""
    m = monotonic(df, key, at, value)
    edge = F.date_sub(as_of, recent_days)
    old = m.where(F.col(at) < edge).groupBy(key, F.trunc(at, "month").alias("_m")).agg(F.max(F.struct(at, value)).alias("_p")).select(key, f"_p.{at}", f"_p.{value}")
    return m.where(F.col(at) >= edge).unionByName(old)


def backfill_days(end: Column, n: Column, cap: int = 730) -> Column:
    """Days back from ``end``, newest first: n, at least one, at most ``cap``."""
    k = F.greatest(F.lit(1), F.least(n, F.lit(cap)))
    return F.sequence(end, F.date_sub(end, k - 1), F.expr("interval -1 day"))
