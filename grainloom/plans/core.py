"""Queries of scoring, deduplication, text, upserts and aggregates over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from grainloom.functions import numbers as N
from grainloom.functions import scoring as S
from grainloom.functions import text as T
from grainloom.operators import relational as R
from grainloom.operators.grid import one_per, usable
from grainloom.plans import pipelines
from grainloom.session import table

AS_OF = "2025-06-30 00:00:00"
QUERIES: dict = {}
ORACLE: dict = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f

    return add


def asof():
    return F.lit(AS_OF).cast("timestamp_ntz")


_SCORE = """greatest(1, CAST(trunc(
  (CASE WHEN lower(source) = 'github' THEN coalesce(stars, 0) WHEN lower(source) IN ('devto', 'hashnode', 'medium') THEN coalesce(upvotes, 0) ELSE greatest(coalesce(stars, 0), coalesce(upvotes, 0)) END)
  * (CASE WHEN age <= 2 THEN 2.0 WHEN age <= 14 THEN 2.0 * exp(-(age - 2) / 4.0) ELSE 0.0 END)
  * (CASE WHEN lower(source) = 'github' THEN 2.0 ELSE 1.0 END)
  * (CASE WHEN coalesce(comments, 0) <= 0 THEN 1.0 WHEN comments < 5 THEN 1.1 WHEN comments < 10 THEN 1.2 WHEN comments < 20 THEN 1.3 WHEN comments < 50 THEN 1.4 ELSE 1.5 END)) AS INT))"""
_AGED = f"(SELECT *, (epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(created_at_source)) / 86400e6 AS age FROM articles)"


def _scored(spark, sf):
    a = table(spark, sf, "articles")
    return a.select("id", "source", "created_at_source", "score", S.score(F.col("source"), F.col("stars"), F.col("upvotes"), F.col("comments"), F.col("created_at_source"), asof()).alias("fresh"))


@query("score_articles", f"SELECT id, {_SCORE} AS fresh FROM {_AGED} WHERE created_at_source IS NOT NULL")
def _(spark, sf):
    return _scored(spark, sf).where("created_at_source IS NOT NULL").select("id", "fresh")


@query("refresh_scores", f"SELECT id, CASE WHEN created_at_source >= TIMESTAMP '{AS_OF}' - INTERVAL 14 DAY THEN {_SCORE} ELSE score END AS score FROM {_AGED}")
def _(spark, sf):
    a = table(spark, sf, "articles").select("id", "source", "stars", "upvotes", "comments", "created_at_source", "score")
    return pipelines.refresh_scores(a, asof()).select("id", "score")


@query("score_stats", f"SELECT lower(source) AS source, count(*) AS articles, sum(CASE WHEN s = 1 THEN 1 ELSE 0 END) AS at_floor, max(s) AS best FROM (SELECT source, {_SCORE} AS s FROM {_AGED} WHERE created_at_source IS NOT NULL) GROUP BY 1")
def _(spark, sf):
    d = _scored(spark, sf).where("created_at_source IS NOT NULL")
    return d.groupBy(F.lower("source").alias("source")).agg(F.count("*").alias("articles"), F.count_if(F.col("fresh") == 1).alias("at_floor"), F.max("fresh").alias("best"))


@query("normalize_scores", "WITH m AS (SELECT min(score) AS lo, max(score) AS hi FROM articles) SELECT id, CASE WHEN lo = hi THEN score ELSE CAST(trunc((score - lo) * 1000.0 / (hi - lo)) AS INT) END AS scaled FROM articles, m WHERE score IS NOT NULL")
def _(spark, sf):
    a = table(spark, sf, "articles").where("score IS NOT NULL").select("id", "score")
    lo, hi = a.agg(F.min("score"), F.max("score")).first()  # two numbers
    if lo is None or lo == hi:
        return a.select("id", F.col("score").alias("scaled"))
    return a.select("id", ((F.col("score") - lo) * F.lit(1000.0) / (hi - lo)).cast("int").alias("scaled"))


@query("item_type_route", "SELECT CASE WHEN source = 'github' THEN 'REPO' WHEN source = 'reddit' THEN 'DISCUSSION' ELSE 'BLOG' END AS kind, count(*) AS n FROM articles GROUP BY 1")
def _(spark, sf):
    return table(spark, sf, "articles").groupBy(T.item_type(F.col("source")).alias("kind")).agg(F.count("*").alias("n"))


_CATS = "('AI_LLM','DEVOPS_SRE','INFRA_CLOUD','DATABASE','BLOCKCHAIN','SECURITY','DATA_SCIENCE','ARCHITECTURE','MOBILE','FRONTEND','BACKEND','OTHER')"


@query("category_normalize", f"SELECT CASE WHEN category IN {_CATS} THEN category ELSE 'OTHER' END AS kind, count(*) AS n FROM articles GROUP BY 1")
def _(spark, sf):
    c = F.col("category")
    return table(spark, sf, "articles").groupBy(F.when(c.isin(*[x.strip("'") for x in _CATS[1:-1].split(",")]), c).otherwise("OTHER").alias("kind")).agg(F.count("*").alias("n"))


@query("content_gate", "SELECT raw_id FROM raw_articles WHERE length(coalesce(content, '')) >= 6000")
def _(spark, sf):
    return table(spark, sf, "raw_articles").where(F.length(F.coalesce("content", F.lit(""))) >= 6000).select("raw_id")


@query("dedup_keep_first", "SELECT url, min(raw_id) AS raw_id FROM raw_articles GROUP BY url")
def _(spark, sf):
    return R.keep_first(table(spark, sf, "raw_articles").select("url", "raw_id"), ["url"], [F.col("raw_id")])


@query("dedup_keep_newest", "SELECT id, url FROM (SELECT id, url, row_number() OVER (PARTITION BY url ORDER BY created_at DESC NULLS LAST, id DESC) AS rn FROM articles) WHERE rn = 1")
def _(spark, sf):
    return R.keep_first(table(spark, sf, "articles").select("id", "url", "created_at"), ["url"], [F.col("created_at").desc(), F.col("id").desc()]).select("id", "url")


@query("dedup_removed_count", "SELECT count(*) - count(DISTINCT url) AS removed FROM articles WHERE url IS NOT NULL")
def _(spark, sf):
    a = table(spark, sf, "articles").where("url IS NOT NULL").groupBy("url").agg(F.count("*").alias("n"))
    return a.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("removed"))


@query("dedup_removed_rows", "SELECT id FROM (SELECT id, row_number() OVER (PARTITION BY url ORDER BY created_at DESC NULLS LAST, id DESC) AS rn FROM articles WHERE url IS NOT NULL) WHERE rn > 1")
def _(spark, sf):
    a = table(spark, sf, "articles").where("url IS NOT NULL").select("id", "url", "created_at")
    kept = R.keep_first(a, ["url"], [F.col("created_at").desc(), F.col("id").desc()])
    return a.join(kept.select("id"), "id", "left_anti").select("id")


@query("anti_join_existing", "SELECT raw_id FROM raw_articles r WHERE NOT EXISTS (SELECT 1 FROM articles a WHERE a.external_id = r.external_id)")
def _(spark, sf):
    return table(spark, sf, "raw_articles").join(table(spark, sf, "articles").select("external_id").distinct(), "external_id", "left_anti").select("raw_id")


@query("engagement_filters", "SELECT id FROM articles WHERE CASE lower(source) WHEN 'devto' THEN coalesce(upvotes, 0) >= 10 WHEN 'hashnode' THEN coalesce(upvotes, 0) >= 5 WHEN 'reddit' THEN coalesce(upvotes, 0) >= 100 WHEN 'github' THEN coalesce(stars, 0) >= 50 ELSE true END")
def _(spark, sf):
    u, st, src = F.coalesce("upvotes", F.lit(0)), F.coalesce("stars", F.lit(0)), F.lower("source")
    ok = F.when(src == "devto", u >= 10).when(src == "hashnode", u >= 5).when(src == "reddit", u >= 100).when(src == "github", st >= 50).otherwise(True)
    return table(spark, sf, "articles").where(ok).select("id")


@query("source_allowlist_counts", "SELECT lower(trim(source)) AS source, count(*) AS n, count(DISTINCT lang) AS langs, sum(n_chars) AS chars FROM documents GROUP BY 1")
def _(spark, sf):
    return table(spark, sf, "documents").groupBy(F.lower(F.trim("source")).alias("source")).agg(F.count("*").alias("n"), F.count_distinct("lang").alias("langs"), F.sum("n_chars").alias("chars"))


@query("url_host", r"SELECT id, regexp_replace(lower(regexp_extract(regexp_replace(url, '^[A-Za-z][A-Za-z0-9+.-]*://', ''), '^/*([^/?#]*)', 1)), '^www\.', '') AS host FROM articles")
def _(spark, sf):
    return table(spark, sf, "articles").select("id", T.host(F.col("url")).alias("host"))


@query("url_netloc", "SELECT raw_id, regexp_extract(url, '^[A-Za-z][^:/?#]*://([^/?#]*)', 1) AS netloc FROM raw_articles")
def _(spark, sf):
    return table(spark, sf, "raw_articles").select("raw_id", T.netloc(F.col("url")).alias("netloc"))


@query("url_normalize", "SELECT id, regexp_replace(trim(url), '/+$', '') AS url FROM articles")
def _(spark, sf):
    return table(spark, sf, "articles").select("id", T.plain_url(F.col("url")).alias("url"))


@query("pages_per_host", r"SELECT regexp_replace(lower(source), '^www\.', '') AS host, count(*) AS pages, sum(CASE WHEN content IS NULL OR content = '' THEN 1 ELSE 0 END) AS empty FROM raw_articles GROUP BY 1")
def _(spark, sf):
    c = F.col("content")
    return table(spark, sf, "raw_articles").groupBy(F.regexp_replace(F.lower("source"), r"^www\.", "").alias("host")).agg(F.count("*").alias("pages"), F.count_if(c.isNull() | (c == "")).alias("empty"))


@query("read_time", r"SELECT doc_id, CASE WHEN w > 0 THEN CAST(greatest(1, w // 200) AS VARCHAR) || ' min read' END AS read_time FROM (SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '[^ \t\n\r\f\v]+')) AS w FROM documents)")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.read_time(T.word_count(F.col("text"))).alias("read_time"))


@query("text_truncate", "SELECT raw_id, length(CASE WHEN length(content) > 15000 THEN substr(content, 1, 15000) || chr(10) || chr(10) || '[Content truncated]' ELSE content END) AS chars FROM raw_articles")
def _(spark, sf):
    return table(spark, sf, "raw_articles").select("raw_id", F.length(T.limited(F.col("content"))).alias("chars"))


@query("redact_tokens", r"SELECT doc_id, md5(regexp_replace(regexp_replace(text, '(?i)(token\s*[=:]\s*)[^\s,;]+', '\1***REDACTED***', 'g'), '(?i)(secret\s*[=:]\s*)[^\s,;]+', '\1***REDACTED***', 'g')) AS digest FROM documents WHERE NOT regexp_matches(text, '(?i)(bearer\s|access_token=|api[_-]?key|cookie|session)')")
def _(spark, sf):
    d = table(spark, sf, "documents").where(~F.col("text").rlike(r"(?i)(bearer\s|access_token=|api[_-]?key|cookie|session)"))
    return d.select("doc_id", F.md5(T.redact(F.col("text"))).alias("digest"))


@query("redact_documents")  # all seven patterns over all documents; tested against brute force
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.md5(T.redact(F.col("text"))).alias("digest"))


@query("redact_payload", "SELECT raw_id, CASE WHEN trim(content) = '' THEN '' WHEN content IS NOT NULL THEN '<redacted payload (' || length(content) || ' chars)>' END AS shown FROM raw_articles")
def _(spark, sf):
    return table(spark, sf, "raw_articles").select("raw_id", T.redact_payload(F.col("content")).alias("shown"))


_RL = "|".join(("feat", "feature", "add", "new", "introduce", "support"))
_LAB = "list_filter([{}], lambda x: x IS NOT NULL)".format(", ".join(f"CASE WHEN regexp_matches(t, '{'|'.join(ws)}') THEN '{n}' END" for n, ws in T.LABEL_WORDS))
_NOTES = "(SELECT doc_id, lower(coalesce(title, '') || ' ' || coalesce(text, '')) AS t FROM documents)"
_LABELS = f"(SELECT doc_id, CASE WHEN len(l) > 0 THEN l ELSE ['misc'] END AS types FROM (SELECT doc_id, {_LAB} AS l FROM {_NOTES}))"
_HAS = lambda n: f"CAST(list_contains(types, '{n}') AS INT)"


@query("event_types_substring", f"SELECT doc_id, array_to_string(types, ',') AS types FROM {_LABELS}")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.array_join(T.labels(F.col("title"), F.col("text")), ",").alias("types"))


@query("event_impact", f"SELECT doc_id, least(10, 1 + 4 * {_HAS('security')} + 3 * {_HAS('breaking')} + 2 * {_HAS('feature')} + {_HAS('fix')} + {_HAS('perf')}) AS impact FROM {_LABELS}")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.impact(T.labels(F.col("title"), F.col("text"))).alias("impact"))


def _cnt(col: str, p: str) -> str:
    return f"len(regexp_extract_all({col}, '(?im){p}'))"


_SC = {n: " + ".join([f"2 * {_cnt('ti', p)} + {_cnt('bo', p)}" for p in ps] + [f"2 * {_cnt('bo', h)}"]) for n, ps, h in T.TYPE_PATTERNS}
@query("event_type_scores", "SELECT doc_id, {} FROM (SELECT doc_id, coalesce(title, '') AS ti, coalesce(text, '') AS bo FROM documents)".format(", ".join(f"{e} AS {n}" for n, e in _SC.items())))
def _(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", T.lit_text(F.col("title")).alias("ti"), T.lit_text(F.col("text")).alias("bo"))
    out = []
    for n, ps, h in T.TYPE_PATTERNS:
        c = 2 * F.regexp_count("bo", F.lit("(?im)" + h))
        for p in ps:
            c = c + 2 * F.regexp_count("ti", F.lit("(?im)" + p)) + F.regexp_count("bo", F.lit("(?im)" + p))
        out.append(c.cast("bigint").alias(n))
    return d.select("doc_id", *out)


_WT = "WITH d AS (SELECT doc_id, {} FROM (SELECT doc_id, coalesce(title, '') AS ti, coalesce(text, '') AS bo FROM documents)), v AS ({}), ".format(
    ", ".join(f"{e} AS {n}" for n, e in _SC.items()), " UNION ALL ".join(f"SELECT doc_id, '{n}' AS n, {n} AS s, {i} AS i FROM d" for i, n in enumerate(_SC))
) + """r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY s DESC, i) AS rk FROM v),
t AS (SELECT doc_id, coalesce(list(n ORDER BY rk) FILTER (WHERE s >= 2 AND rk <= 2), []) AS l, max(CASE WHEN n = 'security' THEN s END) AS sec, max(CASE WHEN rk = 1 THEN n END) AS b, max(CASE WHEN rk = 1 THEN s END) AS bs FROM r GROUP BY 1)
SELECT doc_id, array_to_string(CASE WHEN sec > 0 AND NOT list_contains(l, 'security') THEN list_slice(list_concat(['security'], l), 1, 2) WHEN len(l) > 0 THEN l WHEN bs > 0 THEN [b] ELSE ['misc'] END, ',') AS types FROM t"""


@query("event_types_regex", _WT)
def _(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", T.type_scores(F.col("title"), F.col("text")).alias("scores"))
    return d.select("doc_id", F.array_join(T.types_of(F.col("scores")), ",").alias("types"))


@query("event_bullets", r"SELECT doc_id, array_to_string(list_slice(list_transform(list_filter(string_split_regex(replace(coalesce(text, ''), chr(13) || chr(10), chr(10)), '\n|\r'), lambda x: starts_with(trim(x), '-')), lambda x: trim(regexp_replace(trim(x), '^[- ]+|[- ]+$', '', 'g'))), 1, 5), '|') AS bullets FROM documents")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.array_join(T.bullets(F.col("text")), "|").alias("bullets"))


@query("event_external_id", "SELECT o_orderkey, 'evt-' || o_custkey || '-' || substr(sha1(o_custkey || ':' || o_orderpriority || ':' || strftime(o_orderdate, '%Y-%m-%d')), 1, 16) AS event_id FROM orders")
def _(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", T.event_id(F.col("o_custkey"), F.col("o_orderpriority"), F.col("o_orderdate").cast("date")).alias("event_id"))


@query("event_summary", f"SELECT doc_id, substr(coalesce(title, 'unknown') || ': ' || array_to_string(list_slice(types, 1, 3), ', '), 1, 1000) AS summary FROM {_LABELS} JOIN documents USING (doc_id)")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.release_summary(F.coalesce("title", F.lit("unknown")), T.labels(F.col("title"), F.col("text"))).alias("summary"))


@query("last_release", "SELECT o_custkey, CAST(max(o_orderdate) AS DATE) AS last_release FROM orders WHERE o_orderstatus = 'F' GROUP BY 1")
def _(spark, sf):
    return table(spark, sf, "orders").where("o_orderstatus = 'F'").groupBy("o_custkey").agg(F.max("o_orderdate").cast("date").alias("last_release"))


@query("fallback_union", "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F' AND o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def _(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return R.fallback_union(o.where("o_orderstatus = 'F'"), o.where("o_orderstatus <> 'F'"), "o_custkey").select("o_orderkey")


@query("snapshot_mirror", "SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN p_name WHEN p_partkey % 3 = 0 THEN p_name ELSE 'new ' || p_name END AS p_name, CAST(p_size + 1 AS INT) AS p_size FROM part WHERE p_partkey % 7 <> 1")
def _(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_name", "p_size")
    old = p.where("p_partkey % 5 <> 0")
    new = p.where("p_partkey % 7 <> 1").select("p_partkey", F.when(F.col("p_partkey") % 5 == 0, F.col("p_name")).when(F.col("p_partkey") % 3 == 0, F.lit("")).otherwise(F.concat(F.lit("new "), "p_name")).alias("p_name"), (F.col("p_size") + 1).cast("int").alias("p_size"))
    return R.snapshot_mirror(old, new, "p_partkey", refresh=["p_name", "p_size"], keep_if_blank=["p_name"])


_PM = "date IS NOT NULL AND stars IS NOT NULL AND stars >= 0 AND date BETWEEN DATE '2015-01-01' AND DATE '2025-06-30'"


@query("upsert_daily_metrics", f"SELECT project_id, date, max_by(stars, (ingested_at, id)) AS stars, max_by(forks, (ingested_at, id)) AS forks FROM (SELECT * FROM project_metrics_daily WHERE {_PM} AND ingested_at IS NOT NULL AND forks IS NOT NULL) GROUP BY 1, 2")
def _(spark, sf):
    m = table(spark, sf, "project_metrics_daily").where(usable(F.col("date"), F.col("stars"))).where("ingested_at IS NOT NULL AND forks IS NOT NULL")
    split = F.col("ingested_at") < F.lit("2025-01-01").cast("timestamp_ntz")
    order = [F.col("ingested_at").desc(), F.col("id").desc()]
    cols = ["project_id", "date", "stars", "forks"]
    first = R.keep_first(m.where(split), ["project_id", "date"], order).select(*cols)
    return R.upsert(first, m.where(~split), ["project_id", "date"], order=order)


@query("project_rollup", f"WITH t AS (SELECT project_id, max_by(stars, (date, ingested_at, id)) AS s FROM project_metrics_daily WHERE {_PM} AND ingested_at IS NOT NULL GROUP BY 1) SELECT p.id, coalesce(t.s, p.stars) AS stars FROM projects p LEFT JOIN t ON t.project_id = p.id")
def _(spark, sf):
    m = table(spark, sf, "project_metrics_daily").where(usable(F.col("date"), F.col("stars"))).where("ingested_at IS NOT NULL")
    t = one_per(m, ["project_id"], [F.col("date"), F.col("ingested_at"), F.col("id")], ["stars"]).select(F.col("project_id").alias("id"), F.col("stars").alias("_s"))
    return table(spark, sf, "projects").select("id", "stars").join(t, "id", "left").select("id", F.coalesce("_s", "stars").alias("stars"))


_SP = f"(SELECT project_id, date, max(stars) AS stars FROM star_points WHERE {_PM} GROUP BY 1, 2)"


def _points(spark, sf):
    return table(spark, sf, "star_points").where(usable(F.col("date"), F.col("stars"))).groupBy("project_id", "date").agg(F.max("stars").alias("stars"))


@query("running_max", f"SELECT project_id, date, greatest(0, max(stars) OVER (PARTITION BY project_id ORDER BY date)) AS stars FROM {_SP}")
def _(spark, sf):
    from grainloom.operators.timeseries import monotonic

    return monotonic(_points(spark, sf), "project_id", "date", "stars")


@query("star_rollup", f"""WITH m AS (SELECT project_id, date, greatest(0, max(stars) OVER (PARTITION BY project_id ORDER BY date)) AS stars FROM {_SP}),
k AS (SELECT project_id, max(date) AS date FROM m WHERE date < DATE '2025-04-01' GROUP BY project_id, year(date), month(date) UNION ALL SELECT project_id, date FROM m WHERE date >= DATE '2025-04-01')
SELECT m.project_id, m.date, m.stars FROM m JOIN k ON k.project_id = m.project_id AND k.date = m.date""")
def _(spark, sf):
    from grainloom.operators.timeseries import star_rollup

    return star_rollup(_points(spark, sf), "project_id", "date", "stars", F.lit("2025-06-30").cast("date"))


@query("backfill_dates", "SELECT project_id, CAST(b - CAST(i AS INT) AS DATE) AS day FROM (SELECT project_id, max(date) AS b, least(730, greatest(1, date_diff('day', min(date), max(date)))) AS n FROM star_points WHERE date BETWEEN DATE '2015-01-01' AND DATE '2025-06-30' GROUP BY 1) t, LATERAL (SELECT unnest(generate_series(0, n - 1)) AS i) s")
def _(spark, sf):
    from grainloom.operators.timeseries import backfill_days

    p = table(spark, sf, "star_points").where(F.col("date").between(F.lit("2015-01-01").cast("date"), F.lit("2025-06-30").cast("date")))
    p = p.groupBy("project_id").agg(F.min("date").alias("a"), F.max("date").alias("b"))
    return p.select("project_id", F.explode(backfill_days(F.col("b"), F.datediff("b", "a"))).alias("day"))


@query("pct_normalize", "SELECT l_orderkey, l_linenumber, CAST(round(CAST(l_discount AS DECIMAL(20,10)) * 100, 2) AS DECIMAL(10,2)) AS pct FROM lineitem")
def _(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", N.percentage(F.col("l_discount").cast("string")).alias("pct"))


_TXT = "CASE o_orderkey % 5 WHEN 0 THEN 'n/a' WHEN 1 THEN '—' WHEN 2 THEN ' ' ELSE format('{:,}', CAST(trunc(o_totalprice) AS BIGINT)) END"


@query("decimal_clean", "SELECT o_orderkey, CASE WHEN o_orderkey % 5 >= 3 THEN CAST(trunc(o_totalprice) AS DECIMAL(10,2)) END AS v FROM orders")
def _(spark, sf):
    o = F.col("o_orderkey") % 5
    t = F.when(o == 0, "n/a").when(o == 1, "—").when(o == 2, " ").otherwise(F.format_number(F.floor("o_totalprice"), 0))
    return table(spark, sf, "orders").select("o_orderkey", N.lenient_decimal(t).alias("v"))


@query("int_clean", "SELECT o_orderkey, CASE WHEN o_orderkey % 5 >= 3 THEN CAST(trunc(o_totalprice) AS INT) END AS v FROM orders")
def _(spark, sf):
    o = F.col("o_orderkey") % 5
    t = F.when(o == 0, "null").when(o == 1, "abc").when(o == 2, "").otherwise(F.format_number("o_totalprice", 2))
    return table(spark, sf, "orders").select("o_orderkey", N.lenient_int(t).alias("v"))


@query("star_count_parse", "SELECT id, CASE WHEN stars IS NULL THEN 0 WHEN id % 2 = 0 THEN stars ELSE (stars // 100) * 100 END AS v FROM projects")
def _(spark, sf):
    t = F.when(F.col("id") % 2 == 0, F.format_number("stars", 0)).otherwise(F.concat(F.format_string("%d.%d", F.expr("stars div 1000"), F.expr("(stars div 100) % 10")), F.lit("k")))
    return table(spark, sf, "projects").select("id", N.star_count(F.when(F.col("stars").isNotNull(), t)).alias("v"))


@query("slugify", "SELECT p_partkey, coalesce(nullif(regexp_replace(regexp_replace(lower(p_name), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), ''), 'provider') AS slug FROM part")
def _(spark, sf):
    return table(spark, sf, "part").select("p_partkey", T.slug(F.col("p_name")).alias("slug"))


@query("unique_slug", "WITH s AS (SELECT s_suppkey, regexp_replace(lower('Owner ' || (s_suppkey % 10)), '[^a-z0-9]+', '-', 'g') AS slug FROM supplier), f AS (SELECT slug, min(s_suppkey) AS owner FROM s GROUP BY 1) SELECT s_suppkey, CASE WHEN owner = s_suppkey THEN s.slug ELSE s.slug || '-' || substr(CAST(s_suppkey AS VARCHAR), 1, 8) END AS slug FROM s JOIN f ON f.slug = s.slug")
def _(spark, sf):
    s = table(spark, sf, "supplier").select("s_suppkey", T.slug(F.concat(F.lit("Owner "), (F.col("s_suppkey") % 10).cast("string"))).alias("slug"))
    f = s.groupBy("slug").agg(F.min("s_suppkey").alias("owner"))
    return s.join(f, "slug").select("s_suppkey", F.when(F.col("owner") == F.col("s_suppkey"), F.col("slug")).otherwise(F.concat("slug", F.lit("-"), F.substring(F.col("s_suppkey").cast("string"), 1, 8))).alias("slug"))


@query("clean_tags", "SELECT DISTINCT id, tag FROM (SELECT id, unnest(list_transform(tags, lambda x: replace(lower(trim(x)), ' ', '-'))) AS tag FROM projects WHERE len(tags) <= 5) WHERE tag <> ''")
def _(spark, sf):
    return table(spark, sf, "projects").where(F.size("tags") <= 5).select("id", F.explode(T.clean_tags(F.col("tags"))).alias("tag"))


@query("article_tags_sink", "SELECT DISTINCT article_id, tag FROM article_tags")
def _(spark, sf):
    return table(spark, sf, "article_tags").dropDuplicates(["article_id", "tag"])


@query("append_validated", "SELECT id, length(coalesce(source, '')) <= 20 AS accepted FROM articles")
def _(spark, sf):
    ok, bad = R.within_lengths(table(spark, sf, "articles").select("id", "source"), {"source": 20})
    return ok.select("id", F.lit(True).alias("accepted")).unionByName(bad.select("id", F.lit(False).alias("accepted")))


@query("creator_dedupe", "SELECT n_regionkey, arg_max(n_name, n_nationkey) AS last_name FROM nation GROUP BY 1")
def _(spark, sf):
    return R.keep_first(table(spark, sf, "nation"), ["n_regionkey"], [F.col("n_nationkey").desc()]).select("n_regionkey", F.col("n_name").alias("last_name"))


@query("creator_upsert", "SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN s_name || ' v2' ELSE s_name END AS s_name FROM supplier")
def _(spark, sf):
    s = table(spark, sf, "supplier").select("s_suppkey", "s_name")
    return R.upsert(s.where("s_suppkey % 2 = 0"), s.where("s_suppkey % 3 = 0 OR s_suppkey % 2 = 1").withColumn("s_name", F.when(F.col("s_suppkey") % 3 == 0, F.concat("s_name", F.lit(" v2"))).otherwise(F.col("s_name"))), ["s_suppkey"], order=[F.col("s_name")])


@query("or_key_lookup", "SELECT a.id, coalesce(x.p, y.p) AS project_id FROM articles a LEFT JOIN (SELECT CAST(id AS VARCHAR) AS k, min(id) AS p FROM projects GROUP BY 1) x ON x.k = CAST(a.id AS VARCHAR) LEFT JOIN (SELECT stars AS k, min(id) AS p FROM projects WHERE stars IS NOT NULL GROUP BY 1) y ON y.k = a.stars")
def _(spark, sf):
    a = table(spark, sf, "articles").select("id", "stars").withColumn("k1", F.col("id").cast("string"))
    p = table(spark, sf, "projects").select(F.col("id").cast("string").alias("pid"), F.col("stars").alias("pstars"), F.col("id").alias("v"))
    return R.two_pass_lookup(a, p, [("k1", "pid"), ("stars", "pstars")], "v", "project_id").select("id", "project_id")


@query("category_children_replace", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_orderkey % 10 <> 0 UNION ALL SELECT l_orderkey, l_linenumber, l_quantity + 1 FROM lineitem WHERE l_orderkey % 10 = 0 AND l_linenumber = 1")
def _(spark, sf):
    c = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    new = c.where("l_orderkey % 10 = 0 AND l_linenumber = 1").withColumn("l_quantity", F.col("l_quantity") + 1)
    return R.replace_children(c, table(spark, sf, "orders").where("o_orderkey % 10 = 0").select(F.col("o_orderkey").alias("l_orderkey")), new, "l_orderkey")


@query("batch_assign", "SELECT id, CAST((row_number() OVER (PARTITION BY source ORDER BY id) - 1) // 3 AS BIGINT) AS batch FROM articles")
def _(spark, sf):
    w = Window.partitionBy("source").orderBy("id")
    return table(spark, sf, "articles").select("id", F.floor((F.row_number().over(w) - 1) / 3).alias("batch"))


@query("response_url_match", "WITH r AS (SELECT url || CASE WHEN raw_id % 2 = 0 THEN '/' ELSE '' END AS url, min(raw_id) AS k FROM raw_articles WHERE raw_id % 3 <> 0 AND url IS NOT NULL GROUP BY 1), n AS (SELECT regexp_replace(trim(url), '/+$', '') AS u, min(k) AS k FROM r GROUP BY 1) SELECT a.raw_id, n.k AS answer FROM raw_articles a LEFT JOIN n ON n.u = regexp_replace(trim(a.url), '/+$', '')")
def _(spark, sf):
    a = table(spark, sf, "raw_articles").select("raw_id", "url")
    r = a.where("raw_id % 3 <> 0 AND url IS NOT NULL").select(F.concat("url", F.when(F.col("raw_id") % 2 == 0, "/").otherwise("")).alias("url"), "raw_id")
    n = r.groupBy(T.plain_url(F.col("url")).alias("u")).agg(F.min("raw_id").alias("answer"))
    return a.withColumn("u", T.plain_url(F.col("url"))).join(n, "u", "left").select("raw_id", "answer")


@query("json_props_extract", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events")
def _(spark, sf):
    return table(spark, sf, "events").select("event_id", F.from_json("props", "k INT")["k"].alias("k"))


@query("source_stats", "SELECT source, count(*) AS crawled, sum(CASE WHEN length(coalesce(content, '')) >= 6000 THEN 1 ELSE 0 END) AS kept FROM raw_articles GROUP BY ROLLUP (source)")
def _(spark, sf):
    return table(spark, sf, "raw_articles").rollup("source").agg(F.count("*").alias("crawled"), F.count_if(F.length(F.coalesce("content", F.lit(""))) >= 6000).alias("kept"))


@query("stage_success", "SELECT event_type, coalesce(bool_and(value > 0), true) AS ok FROM events GROUP BY 1")
def _(spark, sf):
    return table(spark, sf, "events").groupBy("event_type").agg(F.coalesce(F.bool_and(F.col("value") > 0), F.lit(True)).alias("ok"))


@query("iso_date_parse", "SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN DATE '2025-06-30' ELSE CAST(o_orderdate AS DATE) END AS day FROM orders")
def _(spark, sf):
    o = F.col("o_orderkey") % 4
    t = F.when(o == 0, "soon").when(o == 1, F.date_format("o_orderdate", "yyyy-MM-dd")).when(o == 2, F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T23:30:00-05:00"))).otherwise(F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T00:10:00Z")))
    return table(spark, sf, "orders").select("o_orderkey", T.iso_day(t, F.lit("2025-06-30").cast("date")).alias("day"))


@query("top_projects", "SELECT id FROM (SELECT id, row_number() OVER (ORDER BY stars DESC NULLS LAST, id) AS rn FROM projects) WHERE rn <= 50")
def _(spark, sf):
    return table(spark, sf, "projects").orderBy(F.col("stars").desc_nulls_last(), "id").limit(50).select("id")


@query("range_scan", f"SELECT id FROM articles WHERE created_at_source >= TIMESTAMP '{AS_OF}' - INTERVAL 14 DAY")
def _(spark, sf):
    return table(spark, sf, "articles").where(F.col("created_at_source") >= asof() - F.expr("interval 14 days")).select("id")


@query("ids_scan", "SELECT id, full_name FROM projects WHERE id IN (101, 103, 150)")
def _(spark, sf):
    return table(spark, sf, "projects").where(F.col("id").isin(*(pipelines.id_list("101, 103,x,150") or []))).select("id", "full_name")


@query("owner_repo_split", "SELECT id, trim(split_part(full_name, '/', 1)) AS owner, trim(substr(full_name, strpos(full_name, '/') + 1)) AS repo FROM projects WHERE full_name LIKE '%/%'")
def _(spark, sf):
    p = F.split("full_name", "/", 2)
    return table(spark, sf, "projects").where(F.col("full_name").contains("/")).select("id", F.trim(p[0]).alias("owner"), F.trim(p[1]).alias("repo"))


@query("metrics_payload_pick", "SELECT id, greatest(coalesce(nullif(stars_week_delta, 0), stars, 0), 0) AS picked FROM projects")
def _(spark, sf):
    return table(spark, sf, "projects").select("id", N.first_int(N.truthy(F.col("stars_week_delta")), F.col("stars")).alias("picked"))


@query("releases_30d", "SELECT project_id, count(DISTINCT date) AS days FROM star_points WHERE date > DATE '2025-05-31' AND date <= DATE '2025-06-30' GROUP BY 1")
def _(spark, sf):
    return table(spark, sf, "star_points").where("date > DATE '2025-05-31' AND date <= DATE '2025-06-30'").groupBy("project_id").agg(F.count_distinct("date").alias("days"))
