"""Titles that are nearly equal to a stored one."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from grainloom.functions.udfs import ratio_from


def similar_titles(new: DataFrame, stored: DataFrame, id_col: str, title: str, least: float = 0.9, keys: int = 3) -> DataFrame:
    """``id`` of each new row whose title has a gestalt ratio of ``least`` or more with some stored title.

    Candidates share one of the new title's ``keys`` pairs of neighbouring
    words that are rarest among stored titles, and their lengths allow the
    ratio (it can't exceed twice the shorter over both). Titles of one word
    are compared with equal ones. Null and blank titles are similar to none.
    """
    def words(d: DataFrame, name: str) -> DataFrame:
        t = F.lower(F.trim(F.col(title)))
        w = F.split(t, r"\s+")
        pairs = F.when(F.size(w) > 1, F.transform(F.sequence(F.lit(1), F.size(w) - 1), lambda i: F.concat(F.element_at(w, i), F.lit(" "), F.element_at(w, i + 1)))).otherwise(F.array(t))
        return d.where(t != "").select(F.col(id_col).alias(f"{name}_id"), t.alias(f"{name}_t"), F.explode(F.array_distinct(pairs)).alias("k"))

    s = words(stored, "s").select("s_t", "k").distinct()
    n = words(new, "n")
    freq = s.groupBy("k").agg(F.count("*").alias("f"))
    w = Window.partitionBy("n_id").orderBy("f", "k")
    rare = n.join(freq, "k").withColumn("r", F.row_number().over(w)).where(F.col("r") <= keys)
    short, both = F.least(F.length("n_t"), F.length("s_t")), F.length("n_t") + F.length("s_t")
    c = rare.join(s, "k").where(2 * short >= least * both).select("n_id", "n_t", "s_t").distinct()
    return c.where(ratio_from(least)("n_t", "s_t") >= least).select(F.col("n_id").alias(id_col)).distinct()
