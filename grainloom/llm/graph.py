"""Connected components on edges that never leave the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainloom.session import cut, merge_join


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """``node``, ``root`` of every node in ``edges``: the least node of its component.

    Alternates the large-star and small-star steps of the known MapReduce
    algorithm until the edge set no longer changes: O(log^2 n) rounds, each
    two shuffles of at most the edges given. Lineage is cut every round in
    the shared checkpoint folder. Self loops and nulls are ignored.
    """
    e = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u IS NOT NULL AND v IS NOT NULL AND u <> v").distinct()
    e = cut(e)
    before = None
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = merge_join(both, low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # Small star: every node points down; its smaller neighbours and itself go to the least of them.
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small = merge_join(large, low2, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("x")).select("x.u", "x.v").where("u <> v").distinct()
        e = cut(small)
        now = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    star = e.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("node"), "root")
    roots = star.select(F.col("root").alias("node"), "root").distinct()
    return star.unionByName(roots)
