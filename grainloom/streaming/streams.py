"""Structured Streaming forms of the batch operators."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grainloom.operators.relational import upsert


def daily_counts(stream: DataFrame, at: str, key: str, late: str = "2 days") -> DataFrame:
    """Rows per key and day, closed once the watermark has passed; later rows are left out."""
    return stream.withWatermark(at, late).groupBy(F.window(at, "1 day").alias("w"), key).agg(F.count("*").alias("n")).select(F.col("w.start").alias("day"), key, "n")


def first_by_url(stream: DataFrame, at: str, url: str = "url", late: str = "7 days") -> DataFrame:
    """The first row of each URL within the watermark, across runs."""
    return stream.withWatermark(at, late).dropDuplicatesWithinWatermark([url])


def upsert_batches(keys: Sequence[str], read: Callable[[], DataFrame], write: Callable[[DataFrame], None], **options):
    """A ``foreachBatch`` function that writes every batch into a keyed table; a replayed batch changes nothing."""

    def each(batch: DataFrame, _: int) -> None:
        write(upsert(read(), batch, keys, **options))

    return each


def run_to_end(stream: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Drains an available-now stream into a memory table and returns it."""
    spark: SparkSession = stream.sparkSession
    q = stream.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.table(name)
