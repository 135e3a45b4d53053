"""Queries of the training-data operators with their oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grainloom.llm import boilerplate, encoding, mixing, neardup, packing, tokens, topn, truncation
from grainloom.session import cut, merge_join, table

# The category names of the data model.
CATEGORIES = ("AI_LLM", "DEVOPS_SRE", "INFRA_CLOUD", "DATABASE", "BLOCKCHAIN", "SECURITY", "DATA_SCIENCE", "ARCHITECTURE", "MOBILE", "FRONTEND", "BACKEND", "OTHER")


def p2_body(spark: SparkSession, sf: str) -> DataFrame:
    """The author's body of every record."""
    return boilerplate.main_text(table(spark, sf, "raw_articles"), "raw_id", "content").withColumnRenamed("id", "raw_id")


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    return boilerplate.furniture_lines(table(spark, sf, "raw_articles"), "raw_id", "content").withColumnRenamed("id", "raw_id")


def _cuts(spark: SparkSession, sf: str) -> DataFrame:
    c = truncation.truncated(table(spark, sf, "raw_articles"), "raw_id", "source", "content")
    t = truncation.truncated(table(spark, sf, "articles"), "id", "source", "summary_ko_title", single_line=True)
    return c.withColumn("field", F.lit("content")).unionByName(t.withColumn("field", F.lit("summary_ko_title")))


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    return _cuts(spark, sf).where("cut").select("field", F.col("id").alias("row_id"))


def p4_rates(spark: SparkSession, sf: str) -> DataFrame:
    """How often each source's values are cut."""
    return _cuts(spark, sf).groupBy("field", "source").agg(F.count("*").alias("records"), F.count_if("cut").alias("cut"), F.round(F.avg(F.col("cut").cast("double")), 4).alias("share"))


def p4_whole(spark: SparkSession, sf: str) -> DataFrame:
    """What must hold of the rates: every value that is not blank is counted once, under its source."""
    return p4_rates(spark, sf).select("field", "source", "records", F.col("cut").between(0, F.col("records")).alias("possible"))


def p5_stories(spark: SparkSession, sf: str) -> DataFrame:
    """Every article with its story (the least id in it)."""
    a = table(spark, sf, "articles").select("id", "title_en", "url")
    return neardup.stories(a)


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    s = cut(p5_stories(spark, sf))
    return merge_join(s.alias("x"), s.alias("y"), "story").where("x.id < y.id").select(F.col("x.id").alias("id_a"), F.col("y.id").alias("id_b"))


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    a = table(spark, sf, "articles").where("score IS NOT NULL").select("id", "score", "created_at_source", "category")
    c = F.upper(F.trim("category"))
    a = a.select("id", "score", "created_at_source", F.when(c.isin(*CATEGORIES), c).otherwise("OTHER").alias("category"), F.date_format("created_at_source", "yyyy-MM").alias("month"))
    best = topn.top_n(a, [F.col("category"), F.col("month")], [F.col("score").desc(), F.col("created_at_source").desc(), F.col("id")], 5)
    return best.select("category", "month", "id")


def _sizes(spark: SparkSession, sf: str) -> DataFrame:
    """Every document's tokens and source, case and outer blanks of the source ignored."""
    d = table(spark, sf, "documents").select("doc_id", F.lower(F.trim("source")).alias("source"), "text")
    return tokens.with_tokens(d, ["doc_id", "source"], "text")


def p7_packed(spark: SparkSession, sf: str) -> DataFrame:
    """The container of every text (or piece) in each kind of container, with the container's fill."""
    kinds = [(r["container"], r["capacity_tokens"]) for r in table(spark, sf, "pack_sizes").orderBy("container").collect()]
    return packing.pack(_sizes(spark, sf), kinds)


def p7_fill(spark: SparkSession, sf: str) -> DataFrame:
    """Containers, tokens and mean fill of each kind."""
    p = p7_packed(spark, sf)
    c = p.groupBy("container", "part", "window").agg(F.max("window_tokens").alias("filled"))
    size = table(spark, sf, "pack_sizes").select("container", "capacity_tokens")
    return c.join(size, "container").groupBy("container", "capacity_tokens").agg(F.count("*").alias("containers"), F.sum("filled").alias("tokens"), F.round(F.avg(F.col("filled") / F.col("capacity_tokens")), 4).alias("mean_fill"))


def p7_mixture(spark: SparkSession, sf: str) -> DataFrame:
    """How near the windows come to the sources' shares."""
    return packing.mixture(cut(p7_packed(spark, sf)))


def p7_whole(spark: SparkSession, sf: str) -> DataFrame:
    """What must hold of every packing: all texts there in full, none split without need, no window overfull."""
    size = table(spark, sf, "pack_sizes").select("container", "capacity_tokens")
    p = cut(p7_packed(spark, sf)).join(size, "container")
    items = p.groupBy("container", "doc_id").agg(F.count("*").alias("pieces"), F.sum("tokens").alias("n"), F.max("capacity_tokens").alias("c"))
    items = items.groupBy("container").agg(F.count("*").alias("texts"), F.count_if((F.col("pieces") > 1) & (F.col("n") <= F.col("c"))).alias("split"))
    windows = p.groupBy("container", "part", "window").agg(F.sum("tokens").alias("n"), F.max("window_tokens").alias("w"), F.max("capacity_tokens").alias("c"))
    windows = windows.groupBy("container").agg(F.count_if((F.col("n") > F.col("c")) | (F.col("n") != F.col("w"))).alias("overfull"), F.avg(F.col("n") / F.col("c")).alias("fill"))
    return items.join(windows, "container").select("container", "texts", "split", "overfull", (F.col("fill") >= 0.9).alias("filled"))


def _targets(spark: SparkSession, sf: str) -> list[dict]:
    t = table(spark, sf, "mix_targets").select(F.lower(F.trim("source")).alias("source"), "target_share", "max_repeats", "budget_tokens")
    return [r.asDict() for r in t.orderBy("source").collect()]


def p8_drawn(spark: SparkSession, sf: str) -> DataFrame:
    """The drawn documents with the number of times each is used."""
    return mixing.draw(_sizes(spark, sf), _targets(spark, sf))[0]


def p8_shares(spark: SparkSession, sf: str) -> DataFrame:
    """Target and actual share of every source."""
    return mixing.shares(*mixing.draw(_sizes(spark, sf), _targets(spark, sf)))


def p8_whole(spark: SparkSession, sf: str) -> DataFrame:
    """What must hold of every mixture, per target source: no document over its cap, the target met to half a document or all used that may be."""
    d, report = mixing.draw(_sizes(spark, sf), _targets(spark, sf))
    got = mixing.shares(d, report)
    longest = d.groupBy("source").agg(F.max("tokens").alias("longest"))
    want = F.least(F.col("target_share") * F.col("budget_tokens"), (F.col("available_tokens") * F.col("max_repeats")).cast("double"))
    near = F.abs(F.col("drawn_tokens") - want) <= F.coalesce(F.col("longest"), F.lit(0)) / 2 + 1
    return got.join(longest, "source", "left").select("source", (F.col("most_uses") <= F.col("max_repeats")).alias("capped"), (near | (F.col("available_tokens") == 0)).alias("met"))


def p9_restored(spark: SparkSession, sf: str) -> DataFrame:
    """Damaged documents with their original text where it can be had."""
    return encoding.repair_encoding(table(spark, sf, "documents"), "doc_id", "text").withColumnRenamed("id", "doc_id")


def p9_found(spark: SparkSession, sf: str) -> DataFrame:
    return p9_restored(spark, sf).select("doc_id")


ORACLE = {
    "p6_found": f"""
WITH a AS (
  SELECT id, score, created_at_source, CASE WHEN upper(trim(category)) IN {CATEGORIES} THEN upper(trim(category)) ELSE 'OTHER' END AS category,
    strftime(created_at_source, '%Y-%m') AS month FROM articles WHERE score IS NOT NULL),
r AS (SELECT *, row_number() OVER (PARTITION BY category, month ORDER BY score DESC, created_at_source DESC NULLS LAST, id) AS rn FROM a)
SELECT category, month, id FROM r WHERE rn <= 5""",
    "p4_whole": """
SELECT 'content' AS field, coalesce(lower(trim(source)), '(none)') AS source, count(*) AS records, true AS possible FROM raw_articles WHERE trim(content) <> '' GROUP BY ALL
UNION ALL SELECT 'summary_ko_title', coalesce(lower(trim(source)), '(none)'), count(*), true FROM articles WHERE trim(summary_ko_title) <> '' GROUP BY ALL""",
    "p7_whole": "SELECT container, count(*) AS texts, 0 AS split, 0 AS overfull, true AS filled FROM documents, pack_sizes WHERE text <> '' GROUP BY container",
    "p8_whole": "SELECT lower(trim(source)) AS source, true AS capped, true AS met FROM mix_targets",
}

QUERIES = {
    "p2_found": p2_found, "p2_body": p2_body, "p4_found": p4_found, "p4_rates": p4_rates, "p4_whole": p4_whole, "p5_found": p5_found, "p5_stories": p5_stories, "p6_found": p6_found,
    "p7_packed": p7_packed, "p7_fill": p7_fill, "p7_mixture": p7_mixture, "p7_whole": p7_whole, "p8_drawn": p8_drawn, "p8_shares": p8_shares, "p8_whole": p8_whole, "p9_found": p9_found, "p9_restored": p9_restored,
}
