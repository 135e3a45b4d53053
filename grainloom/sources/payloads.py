"""Captured payloads to article, model and event rows: one schema and one normaliser per source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from grainloom.functions import numbers as N
from grainloom.functions import text as T

DEVTO = "id BIGINT, title STRING, url STRING, published_at STRING, tag_list ARRAY<STRING>, description STRING, positive_reactions_count INT, comments_count INT, reading_time_minutes INT"
DEVTO_DETAIL = "id BIGINT, body_markdown STRING, body_html STRING"
HASHNODE = "data STRUCT<feed: STRUCT<edges: ARRAY<STRUCT<node: STRUCT<id: STRING, title: STRING, url: STRING, publishedAt: STRING, reactionCount: INT, responseCount: INT, readTimeInMinutes: INT, tags: ARRAY<STRUCT<name: STRING>>, brief: STRING, content: STRUCT<markdown: STRING>>>>>>"
REDDIT = "subreddit STRING, data STRUCT<children: ARRAY<STRUCT<data: STRUCT<title: STRING, url: STRING, url_overridden_by_dest: STRING, permalink: STRING, selftext: STRING, is_self: BOOLEAN, stickied: BOOLEAN, over_18: BOOLEAN, is_gallery: BOOLEAN, post_hint: STRING, score: INT, ups: INT, num_comments: INT, created_utc: DOUBLE>>>>"
HACKERNEWS = "pos INT, id BIGINT, type STRING, by STRING, title STRING, url STRING, text STRING, score INT, descendants INT, time BIGINT"
LEADERBOARD = "id STRING, slug STRING, name STRING, description STRING, release_date STRING, license STRING, context_window BIGINT, model_creator STRUCT<id: STRING, name: STRING, slug: STRING>, pricing STRUCT<price_1m_input_tokens: STRING, price_1m_output_tokens: STRING, price_1m_blended_3_to_1: STRING>, median_output_tokens_per_second STRING, median_time_to_first_token_seconds STRING, median_time_to_first_answer_token STRING, evaluations MAP<STRING,STRING>"
MEDIA = "media_type STRING, id STRING, slug STRING, name STRING, elo STRING, rank STRING, ci95 STRING, appearances STRING, release_date STRING, model_creator STRUCT<id: STRING, name: STRING, slug: STRING>, categories ARRAY<STRUCT<style_category: STRING, subject_matter_category: STRING, format_category: STRING, elo: STRING, ci95: STRING, appearances: INT>>"
# Score columns and the evaluation each is read from.
EVALUATIONS = {
    "score_terminal_bench_hard": "terminalbench_hard", "score_tau_bench_telecom": "tau2", "score_aa_lcr": "lcr", "score_humanitys_last_exam": "hle", "score_mmlu_pro": "mmlu_pro", "score_gpqa_diamond": "gpqa",
    "score_livecode_bench": "livecodebench", "score_scicode": "scicode", "score_ifbench": "ifbench", "score_math_500": "math_500", "score_aime": "aime", "score_aime_2025": "aime_25",
}
INDICES = {"score_aa_intelligence_index": "artificial_analysis_intelligence_index", "score_aa_coding_index": "artificial_analysis_coding_index", "score_aa_math_index": "artificial_analysis_math_index"}
IMAGE_HOSTS = ("i.redd.it", "i.imgur.com")
ARTICLE = ("title_en", "url", "source", "published_at", "external_id", "tags", "content", "stars", "comments", "upvotes", "read_time", "language")


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Captured JSON under a fixed schema; bad records become null rows, never a failed job."""
    return spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)


def _article(df: DataFrame, **cols: Column) -> DataFrame:
    kinds = {"tags": "array<string>", "published_at": "timestamp_ntz", "stars": "int", "comments": "int", "upvotes": "int"}
    return df.select(*[cols.get(c, F.lit(None)).cast(kinds.get(c, "string")).alias(c) for c in ARTICLE])


def devto(listing: DataFrame, detail: DataFrame | None = None) -> DataFrame:
    body = F.lit(None).cast("string")
    d = listing
    if detail is not None:
        b = F.coalesce(F.nullif(F.col("body_markdown"), F.lit("")), F.nullif(F.col("body_html"), F.lit("")))
        d = listing.join(detail.select("id", b.alias("_body")), "id", "left")
        body = F.col("_body")
    return _article(
        d, title_en=F.col("title"), url=F.col("url"), source=F.lit("devto"), published_at=F.try_to_timestamp("published_at"), external_id=F.col("id"), tags=F.col("tag_list"),
        content=F.coalesce(body, F.col("description")), comments=F.col("comments_count"), upvotes=F.col("positive_reactions_count"), read_time=F.concat(F.col("reading_time_minutes").cast("string"), F.lit(" min read")),
    )


def hashnode(payload: DataFrame) -> DataFrame:
    d = payload.select(F.explode("data.feed.edges").alias("e")).select("e.node.*")
    return _article(
        d, title_en=F.col("title"), url=F.col("url"), source=F.lit("hashnode"), published_at=F.try_to_timestamp("publishedAt"), external_id=F.col("id"), tags=F.transform("tags", lambda t: t["name"]),
        content=F.coalesce(F.nullif(F.col("content.markdown"), F.lit("")), F.col("brief")), comments=F.col("responseCount"), upvotes=F.col("reactionCount"),
        read_time=F.concat(F.nullif(F.col("readTimeInMinutes"), F.lit(0)).cast("string"), F.lit(" min read")),
    )


def reddit_posts(payload: DataFrame) -> DataFrame:
    """Posts that are neither pinned nor adult, with their subreddit and place."""
    d = payload.select("subreddit", F.posexplode("data.children").alias("pos", "c")).select("subreddit", "pos", "c.data.*")
    return d.where(~F.coalesce("stickied", F.lit(False)) & ~F.coalesce("over_18", F.lit(False)))


def reddit(posts: DataFrame) -> DataFrame:
    blank = lambda c: F.nullif(F.col(c), F.lit(""))
    d = posts.withColumn("_url", F.coalesce(blank("url_overridden_by_dest"), blank("url"), F.concat(F.lit("https://www.reddit.com"), F.coalesce("permalink", F.lit("")))))
    h = T.host(F.col("_url"))
    d = d.withColumn("_src", F.when(F.coalesce("is_self", F.lit(False)) | h.endswith("reddit.com"), "reddit").otherwise(h))
    return _article(
        d, title_en=F.coalesce("title", F.lit("Untitled")), url=F.col("_url"), source=F.col("_src"), published_at=F.timestamp_seconds("created_utc"),
        tags=F.when(F.col("_src") == "reddit", F.array("subreddit")).otherwise(F.array("subreddit", "_src")), content=F.coalesce("selftext", F.lit("")),
        comments=F.coalesce("num_comments", F.lit(0)), upvotes=F.coalesce(F.nullif("score", F.lit(0)), F.nullif("ups", F.lit(0)), F.lit(0)), read_time=T.read_time(T.word_count(F.col("selftext"))),
    )


def reddit_keep(content: Column, url: Column, post_hint: Column, gallery: Column, upvotes: Column, least: int = 100) -> Column:
    """Enough upvotes, and not a bare picture or film."""
    bare = F.trim(F.coalesce(content, F.lit(""))) == ""
    u = F.lower(url)
    media = F.coalesce(post_hint.isin("image", "rich:video", "hosted:video"), F.lit(False)) | F.coalesce(gallery, F.lit(False))
    for x in IMAGE_HOSTS:
        media = media | F.coalesce(u.contains(x), F.lit(False))
    return ~(bare & media) & (F.coalesce(upvotes, F.lit(0)) >= least)


def hackernews(items: DataFrame, limit: int = 100) -> DataFrame:
    d = items.where(F.col("pos") < limit)
    own = F.nullif(F.col("url"), F.lit(""))
    return _article(
        d, title_en=F.coalesce("title", F.lit("")), url=F.coalesce(own, F.concat(F.lit("https://news.ycombinator.com/item?id="), F.col("id").cast("string"))),
        source=F.coalesce(F.nullif(T.netloc(own), F.lit("")), F.lit("hackernews")), published_at=F.timestamp_seconds("time"), external_id=F.col("id"),
        content=F.when(own.isNull() & (F.col("text") != ""), T.strip_tags(F.col("text"))).otherwise(""), comments=F.coalesce("descendants", F.lit(0)), upvotes=F.coalesce("score", F.lit(0)), language=F.lit("en"),
    )


def hackernews_keep(title: Column, own_url: Column, score: Column, published: Column, as_of: Column, least: int = 50, days: int = 7) -> Column:
    ask = title.startswith("Ask HN:") | title.startswith("Show HN:")
    young = (F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(published.cast("timestamp"))) <= days * 86_400_000_000
    return (F.nullif(own_url, F.lit("")).isNotNull() | ask) & (F.coalesce(score, F.lit(0)) >= least) & young


def trending(pages: DataFrame, html: str = "html") -> DataFrame:
    """Repository rows of captured trending pages."""
    row = F.explode(F.regexp_extract_all(F.col(html), F.lit(r'(?is)<article[^>]*class="[^"]*Box-row[^"]*"[^>]*>(.*?)</article>'), F.lit(1)))
    d = pages.select(row.alias("r"))
    get = lambda p: F.trim(T.strip_tags(F.regexp_extract("r", p, 1)))
    path = F.regexp_extract("r", r'(?is)<h2[^>]*>.*?<a[^>]*href="([^"]*)"', 1)
    d = d.select(
        F.regexp_replace(path, r"^/+|/+$", "").alias("full_name"), F.concat(F.lit("https://github.com"), path).alias("url"), get(r"(?is)<p\b[^>]*>(.*?)</p>").alias("description"),
        F.nullif(get(r'(?is)<span[^>]*itemprop="programmingLanguage"[^>]*>(.*?)</span>'), F.lit("")).alias("language"),
        N.star_count(get(r'(?is)<a[^>]*href="[^"]*/stargazers"[^>]*>(.*?)</a>')).alias("stars"), N.star_count(get(r'(?is)<a[^>]*href="[^"]*/forks"[^>]*>(.*?)</a>')).alias("forks"),
        N.star_count(F.split(get(r'(?is)<span[^>]*class="d-inline-block float-sm-right"[^>]*>(.*?)</span>'), r"\s+")[0]).alias("stars_this_week"),
    )
    return d.where("full_name <> ''").withColumn("tags", F.when(F.col("language").isNotNull(), F.array(F.lower("language"))).otherwise(F.array().cast("array<string>")))


def models(df: DataFrame) -> DataFrame:
    """Leaderboard models. A row with a number that can't be read is dropped whole."""
    p = ("price_1m_input_tokens", "price_1m_output_tokens", "price_1m_blended_3_to_1")
    perf = {"output_speed_median": "median_output_tokens_per_second", "latency_ttft": "median_time_to_first_token_seconds", "median_time_to_first_answer_token": "median_time_to_first_answer_token"}
    raw = [F.col(f"pricing.{x}") for x in p] + [F.col(x) for x in perf.values()] + [F.col("evaluations")[k] for k in [*EVALUATIONS.values(), *INDICES.values()]]
    good = F.lit(True)
    for c in raw:
        good = good & N.strict_decimal_ok(c)
    dec = lambda c, k: c.try_cast(k)
    return df.where(good).select(
        F.col("id").alias("external_id"), "slug", F.coalesce(F.nullif("slug", F.lit("")), F.col("id")).alias("model_id"), F.col("name").alias("model_name"), F.coalesce("model_creator.name", F.lit("Unknown")).alias("provider"),
        "description", T.strict_day(F.col("release_date")).alias("release_date"), "license", "context_window",
        *[dec(F.col(f"pricing.{x}"), "decimal(10,2)").alias(n) for x, n in zip(p, ("price_input", "price_output", "price_blended"))],
        *[dec(F.col(v), "decimal(10,4)").alias(k) for k, v in perf.items()],
        *[N.percentage(F.col("evaluations")[v]).alias(k) for k, v in EVALUATIONS.items()], *[dec(F.col("evaluations")[v], "decimal(10,2)").alias(k) for k, v in INDICES.items()],
        F.col("model_creator.id").alias("creator_external_id"),
    )


def creators(df: DataFrame, lenient: bool = False) -> DataFrame:
    """Creators with id, name and slug; leniently, name and slug are made up from one another."""
    c = df.select(F.col("model_creator.id").alias("external_id"), F.col("model_creator.name").alias("name"), F.col("model_creator.slug").alias("slug"))
    b = lambda x: F.nullif(F.col(x), F.lit(""))
    if not lenient:
        return c.where(b("external_id").isNotNull() & b("name").isNotNull() & b("slug").isNotNull())
    made = F.concat(T.slug(F.coalesce(b("name"), F.lit("provider"))), F.lit("-"), F.substring("external_id", 1, 8))
    c = c.where(b("external_id").isNotNull() | b("slug").isNotNull())
    return c.select("external_id", F.coalesce(b("name"), b("slug")).alias("name"), F.coalesce(b("slug"), made).alias("slug"))


def media_models(df: DataFrame) -> DataFrame:
    d = df.where(F.nullif("id", F.lit("")).isNotNull() & F.nullif("name", F.lit("")).isNotNull())
    return d.select("media_type", F.col("id").alias("external_id"), "slug", "name", N.lenient_decimal(F.col("elo")).alias("elo"), N.lenient_int(F.col("rank")).alias("model_rank"), N._clean(F.col("ci95")).alias("ci95"), N.lenient_int(F.col("appearances")).alias("appearances"), "release_date")


def media_categories(df: DataFrame) -> DataFrame:
    kinds = ("text_to_image", "text_to_video", "image_to_video")
    d = df.where(F.col("media_type").isin(*kinds)).select("media_type", F.col("id").alias("model_id"), F.explode("categories").alias("c"))
    video = F.col("media_type") != "text_to_image"
    return d.select("media_type", "model_id", "c.style_category", "c.subject_matter_category", F.when(video, F.col("c.format_category")).alias("format_category"), N.lenient_decimal(F.col("c.elo")).alias("elo"), N._clean(F.col("c.ci95")).alias("ci95"), F.col("c.appearances").alias("appearances"))


def releases(df: DataFrame, as_of: Column, project: str = "project_id") -> DataFrame:
    """Event rows of releases: tag_name, name, body, published_at, created_at, html_url per project."""
    b = lambda x: F.nullif(F.col(x), F.lit(""))
    version = F.coalesce(b("tag_name"), b("name"), F.lit("unknown"))
    d = df.select(F.col(project).alias("project_id"), version.alias("version"), F.coalesce(b("name"), version).alias("title"), T.iso_day(F.coalesce(b("published_at"), b("created_at")), as_of).alias("released_at"), F.coalesce("body", F.lit("")).alias("raw_notes"), F.col("html_url").alias("source_url"))
    return events(d)


def tags(df: DataFrame, as_of: Column, project: str = "project_id") -> DataFrame:
    """Event rows of tags; their day is ``as_of``."""
    n = F.coalesce(F.nullif("name", F.lit("")), F.lit("unknown"))
    d = df.select(F.col(project).alias("project_id"), n.alias("version"), n.alias("title"), as_of.alias("released_at"), F.coalesce("commit.sha", F.lit("")).alias("raw_notes"), F.col("commit.url").alias("source_url"))
    return events(d)


def events(d: DataFrame) -> DataFrame:
    t = T.labels(F.col("title"), F.col("raw_notes"))
    d = d.withColumn("event_types", t)
    return d.select(
        "project_id", T.event_id(F.col("project_id"), F.col("version"), F.col("released_at")).alias("external_id"), F.substring("version", 1, 50).alias("version"), "released_at", "event_types",
        T.release_summary(F.col("version"), F.col("event_types")).alias("summary"), T.bullets(F.col("raw_notes")).alias("bullets"), T.impact(F.col("event_types")).alias("impact_score"),
        F.array_contains("event_types", "security").alias("is_security"), F.array_contains("event_types", "breaking").alias("is_breaking"), "raw_notes", "source_url",
    )
