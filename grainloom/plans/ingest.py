"""Queries of the payload normalisers, page text, Arrow functions and streams."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, StringType

from grainloom.functions import text as T
from grainloom.functions import udfs as U
from grainloom.operators import relational as R
from grainloom.operators.similar import similar_titles
from grainloom.sources import payloads as P
from grainloom.session import table
from grainloom.streaming import streams

QUERIES: dict = {}
ORACLE: dict = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f

    return add


def _raw(spark: SparkSession, sf: str, source: str) -> DataFrame:
    d = table(spark, sf, "raw_articles").where(F.lower("source") == source)
    return d.withColumn("minutes", F.regexp_extract("read_time", r"^(\d+)", 1).try_cast("int")).withColumn("iso", F.date_format("published_at", "yyyy-MM-dd'T'HH:mm:ss'Z'"))


_MIN = "TRY_CAST(regexp_extract(read_time, '^([0-9]+)', 1) AS INT)"


@query("devto_articles", f"SELECT CAST(raw_id AS VARCHAR) AS external_id, title_en, url, 'devto' AS source, length(CASE WHEN raw_id % 2 = 0 AND content <> '' THEN content || '!' ELSE content END) AS chars, upvotes, comments, {_MIN} || ' min read' AS read_time FROM raw_articles WHERE lower(source) = 'devto' AND coalesce(upvotes, 0) >= 10")
def _(spark, sf):
    r = _raw(spark, sf, "devto")
    listing = r.select(F.col("raw_id").alias("id"), F.col("title_en").alias("title"), "url", F.col("iso").alias("published_at"), F.col("tags").alias("tag_list"), F.col("content").alias("description"), F.col("upvotes").alias("positive_reactions_count"), F.col("comments").alias("comments_count"), F.col("minutes").alias("reading_time_minutes"))
    detail = r.where("raw_id % 2 = 0").select(F.col("raw_id").alias("id"), F.when(F.col("content") != "", F.concat("content", F.lit("!"))).otherwise("").alias("body_markdown"), F.lit(None).cast("string").alias("body_html"))
    a = P.devto(listing, detail).where(F.coalesce("upvotes", F.lit(0)) >= 10)
    return a.select("external_id", "title_en", "url", "source", F.length("content").alias("chars"), "upvotes", "comments", "read_time")


@query("hashnode_articles", f"SELECT CAST(raw_id AS VARCHAR) AS external_id, title_en, url, 'hashnode' AS source, array_to_string(tags, ',') AS tags, length(content) AS chars, upvotes, nullif({_MIN}, 0) || ' min read' AS read_time FROM raw_articles WHERE lower(source) = 'hashnode'")
def _(spark, sf):
    node = F.struct(F.col("raw_id").cast("string").alias("id"), F.col("title_en").alias("title"), "url", F.col("iso").alias("publishedAt"), F.col("upvotes").alias("reactionCount"), F.col("comments").alias("responseCount"), F.col("minutes").alias("readTimeInMinutes"), F.transform("tags", lambda t: F.struct(t.alias("name"))).alias("tags"), F.col("content").alias("brief"), F.struct(F.lit("").alias("markdown")).alias("content"))
    # A captured page holds one node here; a real one holds fifty.
    pages = _raw(spark, sf, "hashnode").select(F.struct(F.struct(F.array(F.struct(node.alias("node"))).alias("edges")).alias("feed")).alias("data"))
    a = P.hashnode(pages)
    return a.select("external_id", "title_en", "url", "source", F.array_join("tags", ",").alias("tags"), F.length("content").alias("chars"), "upvotes", "read_time")


@query("reddit_articles", r"SELECT title_en, url, CASE WHEN raw_id % 3 = 0 THEN 'reddit' ELSE regexp_replace(lower(regexp_extract(url, '^[A-Za-z]+://([^/?#]*)', 1)), '^www\.', '') END AS source, coalesce(nullif(upvotes, 0), 0) AS upvotes, CASE WHEN w > 0 THEN CAST(greatest(1, w // 200) AS VARCHAR) || ' min read' END AS read_time FROM (SELECT *, len(regexp_extract_all(coalesce(content, ''), '[^ \t\n\r\f\v]+')) AS w FROM raw_articles WHERE lower(source) = 'reddit' AND raw_id % 5 <> 0)")
def _(spark, sf):
    post = F.struct(F.col("title_en").alias("title"), "url", F.lit("").alias("url_overridden_by_dest"), F.lit("").alias("permalink"), F.col("content").alias("selftext"), (F.col("raw_id") % 3 == 0).alias("is_self"), (F.col("raw_id") % 5 == 0).alias("stickied"), F.lit(False).alias("over_18"), F.lit(False).alias("is_gallery"), F.lit(None).cast("string").alias("post_hint"), F.col("upvotes").alias("score"), F.lit(0).alias("ups"), F.col("comments").alias("num_comments"), F.lit(1.7e9).alias("created_utc"))
    pages = _raw(spark, sf, "reddit").select(F.lit("programming").alias("subreddit"), F.struct(F.array(F.struct(post.alias("data"))).alias("children")).alias("data"))
    return P.reddit(P.reddit_posts(pages)).select("title_en", "url", "source", "upvotes", "read_time")


@query("hackernews_articles", "SELECT CAST(raw_id AS VARCHAR) AS external_id, CASE WHEN raw_id % 4 = 0 THEN 'https://news.ycombinator.com/item?id=' || raw_id ELSE url END AS url, CASE WHEN raw_id % 4 = 0 THEN 'hackernews' ELSE regexp_extract(url, '^[A-Za-z]+://([^/?#]*)', 1) END AS source, coalesce(upvotes, 0) AS upvotes FROM (SELECT *, row_number() OVER (ORDER BY raw_id) - 1 AS pos FROM raw_articles WHERE lower(source) = 'hackernews') WHERE pos < 100")
def _(spark, sf):
    r = _raw(spark, sf, "hackernews")
    # The place in the captured list of top stories.
    top = r.orderBy("raw_id").limit(100).select(F.col("raw_id").alias("id"), F.lit(0).alias("pos"), F.lit("story").alias("type"), F.lit("x").alias("by"), F.col("title_en").alias("title"), F.when(F.col("raw_id") % 4 == 0, "").otherwise(F.col("url")).alias("url"), F.lit("<p>Hi &amp; bye</p>").alias("text"), F.col("upvotes").alias("score"), F.col("comments").alias("descendants"), F.lit(1_700_000_000).cast("bigint").alias("time"))
    return P.hackernews(top).select("external_id", "url", "source", "upvotes")


@query("hn_filter", "SELECT id FROM articles WHERE created_at_source >= TIMESTAMP '2025-06-30 00:00:00' - INTERVAL 7 DAY AND coalesce(score, 0) >= 50 AND (coalesce(url, '') <> '' OR title_en LIKE 'Ask HN:%' OR title_en LIKE 'Show HN:%')")
def _(spark, sf):
    a = table(spark, sf, "articles")
    return a.where(P.hackernews_keep(F.col("title_en"), F.col("url"), F.col("score"), F.col("created_at_source"), F.lit("2025-06-30 00:00:00").cast("timestamp_ntz"))).select("id")


@query("media_post_filter", "SELECT o_orderkey FROM orders WHERE NOT ((o_orderkey % 2 = 0) AND (o_orderpriority = '1-URGENT' OR o_orderkey % 7 = 0)) AND coalesce(o_custkey, 0) >= 100")
def _(spark, sf):
    o = table(spark, sf, "orders")
    keep = P.reddit_keep(F.when(F.col("o_orderkey") % 2 == 0, " ").otherwise("text"), F.when(F.col("o_orderkey") % 7 == 0, "https://i.imgur.com/a.png").otherwise("https://x.example/"), F.when(F.col("o_orderpriority") == "1-URGENT", "image"), F.lit(False), F.col("o_custkey"))
    return o.where(keep).select("o_orderkey")


_ROW = "<article class=\"Box-row\"><h2 class=\"h3\"><a href=\"/{}\">x</a></h2><p> {} </p><span itemprop=\"programmingLanguage\">{}</span><a href=\"/{}/stargazers\"> {} </a><a href=\"/{}/forks\">1.5k</a><span class=\"d-inline-block float-sm-right\"> 1,2 stars this week </span></article>"


@query("trending_repos", "SELECT full_name, description, stars, 1500 AS forks, 12 AS stars_this_week, coalesce(lower(language), '') AS tag FROM (SELECT full_name, coalesce(nullif(trim(description), ''), 'none') AS description, coalesce(stars, 0) AS stars, nullif(trim(coalesce(language, '')), '') AS language FROM projects WHERE NOT regexp_matches(coalesce(description, ''), '[<>&]') AND NOT regexp_matches(coalesce(language, ''), '[<>&]'))")
def _(spark, sf):
    p = table(spark, sf, "projects").where(~F.coalesce("description", F.lit("")).rlike("[<>&]") & ~F.coalesce("language", F.lit("")).rlike("[<>&]"))
    parts = _ROW.split("{}")
    vals = [F.col("full_name"), F.coalesce(F.nullif(F.trim("description"), F.lit("")), F.lit("none")), F.coalesce("language", F.lit("")), F.col("full_name"), F.format_number(F.coalesce("stars", F.lit(0)), 0), F.col("full_name")]
    page = F.concat(*[x for a, v in zip(parts, vals) for x in (F.lit(a), v)], F.lit(parts[-1]))
    t = P.trending(p.select(page.alias("html")))
    return t.select("full_name", "description", "stars", "forks", "stars_this_week", F.coalesce(F.lower("language"), F.lit("")).alias("tag"))


def _models(spark, sf):
    p = table(spark, sf, "part")
    bad = F.col("p_partkey") % 11 == 0
    return p.select(
        F.concat(F.lit("m"), F.col("p_partkey").cast("string")).alias("id"), F.when(F.col("p_partkey") % 3 == 0, "").otherwise(T.slug(F.col("p_name"))).alias("slug"), F.col("p_name").alias("name"), F.lit("d").alias("description"),
        F.when(F.col("p_partkey") % 2 == 0, "2025-4-8").otherwise("soon").alias("release_date"), F.lit("mit").alias("license"), F.col("p_size").cast("bigint").alias("context_window"),
        F.struct(F.col("p_brand").alias("id"), F.col("p_brand").alias("name"), T.slug(F.col("p_brand")).alias("slug")).alias("model_creator"),
        F.struct(F.col("p_size").cast("string").alias("price_1m_input_tokens"), F.when(bad, "abc").otherwise("1.5").alias("price_1m_output_tokens"), F.lit(None).cast("string").alias("price_1m_blended_3_to_1")).alias("pricing"),
        F.lit("10").alias("median_output_tokens_per_second"), F.lit(None).cast("string").alias("median_time_to_first_token_seconds"), F.lit("0.5").alias("median_time_to_first_answer_token"),
        F.create_map(F.lit("tau2"), (F.col("p_size") / F.lit(40)).cast("string"), F.lit("artificial_analysis_math_index"), F.lit("41.5")).alias("evaluations"),
    )


@query("leaderboard_models", "SELECT 'm' || p_partkey AS external_id, CAST(p_size AS DECIMAL(10,2)) AS price_input, CASE WHEN p_partkey % 2 = 0 THEN DATE '2025-04-08' END AS release_date, CAST(CASE WHEN p_size <= 40 THEN p_size / 40.0 * 100 ELSE p_size / 40.0 END AS DECIMAL(10,1)) AS tau FROM part WHERE p_partkey % 11 <> 0")
def _(spark, sf):
    m = P.models(_models(spark, sf))
    # One place is exact in both engines; ties at two places round half-even here only.
    return m.select("external_id", "price_input", "release_date", F.col("score_tau_bench_telecom").cast("decimal(10,1)").alias("tau"))


@query("leaderboard_creators", "SELECT DISTINCT p_brand AS external_id, p_brand AS name, regexp_replace(lower(p_brand), '[^a-z0-9]+', '-', 'g') AS slug FROM part")
def _(spark, sf):
    c = P.creators(_models(spark, sf))
    return R.keep_first(c, ["external_id"], [F.col("slug")])


def _media(spark, sf):
    p = table(spark, sf, "part")
    kind = F.when(F.col("p_partkey") % 3 == 0, "text_to_image").when(F.col("p_partkey") % 3 == 1, "text_to_speech").otherwise("text_to_video")
    cat = F.struct(F.col("p_type").alias("style_category"), F.lit("s").alias("subject_matter_category"), F.lit("wide").alias("format_category"), F.format_number("p_retailprice", 2).alias("elo"), F.lit("—").alias("ci95"), F.col("p_size").alias("appearances"))
    return p.select(
        kind.alias("media_type"), F.when(F.col("p_partkey") % 13 == 0, "").otherwise(F.col("p_partkey").cast("string")).alias("id"), F.lit("s").alias("slug"), F.col("p_name").alias("name"), F.format_number("p_retailprice", 2).alias("elo"),
        F.format_number(F.col("p_partkey").cast("double") + 0.9, 1).alias("rank"), F.lit("N/A").alias("ci95"), F.lit("1,234.9").alias("appearances"), F.lit("2025").alias("release_date"),
        F.struct(F.lit("i").alias("id"), F.lit("n").alias("name"), F.lit("s").alias("slug")).alias("model_creator"), F.array(cat).alias("categories"),
    )


@query("media_models", "SELECT CAST(p_partkey AS VARCHAR) AS external_id, CASE p_partkey % 3 WHEN 0 THEN 'text_to_image' WHEN 1 THEN 'text_to_speech' ELSE 'text_to_video' END AS media_type, CAST(p_partkey AS INT) AS model_rank, 1234 AS appearances, CAST(NULL AS VARCHAR) AS ci95 FROM part WHERE p_partkey % 13 <> 0")
def _(spark, sf):
    return P.media_models(_media(spark, sf)).select("external_id", "media_type", "model_rank", "appearances", "ci95")


@query("media_categories", "SELECT CASE WHEN p_partkey % 13 = 0 THEN '' ELSE CAST(p_partkey AS VARCHAR) END AS model_id, p_type AS style_category, CASE WHEN p_partkey % 3 = 2 THEN 'wide' END AS format_category, p_size AS appearances FROM part WHERE p_partkey % 3 <> 1")
def _(spark, sf):
    return P.media_categories(_media(spark, sf)).select("model_id", "style_category", "format_category", "appearances")


@query("release_events", "SELECT o_orderkey, 'evt-' || o_custkey || '-' || substr(sha1(o_custkey || ':v' || o_orderkey || ':' || strftime(o_orderdate, '%Y-%m-%d')), 1, 16) AS external_id, 'v' || o_orderkey || ': ' || CASE WHEN o_orderstatus = 'F' THEN 'security, fix' ELSE 'misc' END AS summary, CASE WHEN o_orderstatus = 'F' THEN 6 ELSE 1 END AS impact_score FROM orders")
def _(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("project_id"), F.concat(F.lit("v"), F.col("o_orderkey").cast("string")).alias("tag_name"), F.lit("").alias("name"), F.when(F.col("o_orderstatus") == "F", "- CVE patched -\n  - one more").otherwise("hello").alias("body"), F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("published_at"), F.lit(None).cast("string").alias("created_at"), F.lit("u").alias("html_url"))
    e = P.releases(o, F.lit("2025-06-30").cast("date"))
    return e.select(F.substring("version", 2, 40).cast("bigint").alias("o_orderkey"), "external_id", "summary", "impact_score")


@query("event_upsert", "SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'new' ELSE 'old' END AS note FROM orders WHERE o_orderkey % 3 <> 2 OR o_orderkey % 2 = 0")
def _(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey")
    old = o.where("o_orderkey % 3 <> 2").withColumn("note", F.lit("old"))
    new = o.where("o_orderkey % 2 = 0").withColumn("note", F.lit("new"))
    return R.upsert(R.upsert(old, new, ["o_orderkey"]), new, ["o_orderkey"])  # a replay changes nothing


@query("schema_reconcile", "SELECT n_nationkey, n_name, CAST(NULL AS VARCHAR) AS bullets FROM nation")
def _(spark, sf):
    return R.reconcile(table(spark, sf, "nation").select("n_nationkey", "n_name"), StructType([StructField("n_name", StringType()), StructField("bullets", StringType())]))


_PAGE = "<html><head><title>t</title><style>p{}</style></head><body><nav>Menu<a>x</a></nav><article><h1>Head</h1><script>var a = '</p>';</script><p>Text ", " &amp; more</p></article><footer>Foot</footer></body></html>"


@query("page_main_text", "SELECT raw_id, 'Head' || chr(10) || 'Text ' || raw_id || ' & more' AS body FROM raw_articles")
def _(spark, sf):
    r = table(spark, sf, "raw_articles")
    return r.select("raw_id", T.page_text(F.concat(F.lit(_PAGE[0]), F.col("raw_id").cast("string"), F.lit(_PAGE[1]))).alias("body"))


@query("page_text_longest", "SELECT raw_id, greatest(length(coalesce(title_en, '')), 0) + CASE WHEN length(coalesce(content, '')) >= 300 THEN length(content) - length(coalesce(title_en, '')) WHEN length(coalesce(content, '')) > length(coalesce(title_en, '')) THEN length(content) - length(coalesce(title_en, '')) ELSE 0 END AS chars FROM raw_articles WHERE length(coalesce(title_en, '')) < 300")
def _(spark, sf):
    r = table(spark, sf, "raw_articles").where(F.length(F.coalesce("title_en", F.lit(""))) < 300)
    return r.select("raw_id", F.length(T.best_text(F.array(F.coalesce("title_en", F.lit("")), F.coalesce("content", F.lit(""))))).alias("chars"))


@query("base64_text", "SELECT id, title_en AS body FROM articles WHERE title_en IS NOT NULL")
def _(spark, sf):
    a = table(spark, sf, "articles").where("title_en IS NOT NULL")
    return a.select("id", T.from_base64(F.base64(F.encode("title_en", "UTF-8"))).alias("body"))


@query("source_label", "SELECT id, upper(substr(source, 1, 1)) || lower(substr(source, 2)) AS label FROM articles")
def _(spark, sf):
    return table(spark, sf, "articles").select("id", T.capitalized(F.col("source")).alias("label"))


@query("json_salvage")
def _(spark, sf):
    """Answers as a model might leave them: fenced, with trailing commas, cut off."""
    a = table(spark, sf, "articles").select("id", F.concat(F.lit('```json\n{"articles": [{"url": "'), F.coalesce("url", F.lit("")), F.lit('", "is_technical": true,},\n{"title_ko": "cut')).alias("answer"))
    fixed = F.from_json(U.salvage_json("answer"), "array<struct<url string, is_technical boolean>>")
    return a.select("id", fixed[0]["url"].alias("url"), F.coalesce(fixed[0]["is_technical"], F.lit(False)).alias("is_technical"))


ORACLE["json_salvage"] = "SELECT id, coalesce(url, '') AS url, true AS is_technical FROM articles"


@query("sanitize_nested")
def _(spark, sf):
    e = table(spark, sf, "events")
    return e.select("event_id", U.sanitize_json(F.concat(F.lit('{"token": "abc", "note": "Bearer xyz", "data": '), "props", F.lit("}"))).alias("shown"))


@query("hmac_sign")
def _(spark, sf):
    """Signatures with a made-up secret."""
    return table(spark, sf, "events").select("event_id", U.signed("example")("props").alias("signature"))


@query("message_packing")
def _(spark, sf):
    """Titles of each source's records without content, packed into messages."""
    r = table(spark, sf, "raw_articles").where("coalesce(content, '') = ''").select(F.lower("source").alias("source"), F.concat(F.lit("\n"), F.substring("title_en", 1, 80)).alias("line"), "raw_id")
    g = r.groupBy("source").agg(F.array_sort(F.collect_list(F.struct("raw_id", "line"))).alias("x"))
    return g.select("source", F.posexplode(U.pack_messages(F.concat(F.col("source"), F.lit("\n")), F.concat(F.lit("..."), "source", F.lit("\n")), F.transform("x", lambda x: x["line"]))).alias("number", "message"))


@query("title_similarity")
def _(spark, sf):
    a = table(spark, sf, "articles").select("id", "title_en", "created_at_source")
    edge = F.lit("2025-05-31").cast("timestamp_ntz")
    return similar_titles(a.where(F.col("created_at_source") >= edge), a.where(F.col("created_at_source") < edge), "id", "title_en")


@query("stream_daily_counts", "SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def _(spark, sf):
    batch = table(spark, sf, "events")
    path = f"{sf}/events.parquet"
    # A file source watches a folder; a lone file is picked out of its own.
    r = spark.readStream.schema(batch.schema)
    s = r.parquet(path) if os.path.isdir(path) else r.option("pathGlobFilter", "events.parquet").parquet(sf)
    s = s.withColumn("ts", F.col("ts").cast("timestamp"))
    # Complete mode: the folder is bounded, all windows are wanted.
    return streams.run_to_end(streams.daily_counts(s, "ts", "event_type"), "daily_counts", "complete")
