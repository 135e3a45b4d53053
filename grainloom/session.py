"""Session helpers: table loading and lineage cuts that survive lost executors."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table of the input folder, read lazily."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts.

    A cluster names it in ``spark.checkpoint.dir``. Only where that is unset,
    as in tests on one machine, a temporary folder is used.
    """
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    where = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not where:
        where = tempfile.mkdtemp(prefix="grainloom-checkpoint-")
    sc.setCheckpointDir(where)
    return where


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder and return it without lineage."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def merge_join(left: DataFrame, right: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """A join of two tables that both grow: by sort-merge, so that neither is ever gathered by the driver for a broadcast, whatever its size is thought to be."""
    return left.join(right.hint("merge"), on, how)


def empty_like(df: DataFrame) -> DataFrame:
    return df.limit(0)
