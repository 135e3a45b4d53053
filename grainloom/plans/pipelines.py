"""Entry points: whole runs from input tables to the tables to persist."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainloom.config import DEFAULT, Config
from grainloom.functions import scoring
from grainloom.functions import text as T
from grainloom.operators import relational as R
from grainloom.sources import payloads as P

STAGES = ("events", "metrics")


def articles(crawled: dict[str, DataFrame], stored: DataFrame, enrich: Callable[[DataFrame], DataFrame], as_of: Column, cfg: Config = DEFAULT) -> dict[str, DataFrame]:
    """Normalised articles of all sources: first by URL, not yet stored, long enough, enriched, technical, scored.

    ``crawled`` maps a source to its rows (order of the dict is priority);
    ``enrich`` adds ``is_technical, title_ko, summary_ko, category, llm_tags`` by url.
    """
    every = None
    for i, (_, d) in enumerate(crawled.items()):
        d = d.withColumn("_seq", F.struct(F.lit(i).alias("i"), F.monotonically_increasing_id().alias("n")))
        every = d if every is None else every.unionByName(d)
    new = R.keep_first(every, ["url"], [F.col("_seq")]).drop("_seq").join(stored.select("url").distinct(), "url", "left_anti")
    new = new.where(F.length(F.coalesce("content", F.lit(""))) >= cfg.min_content)
    done = enrich(new).where(F.coalesce("is_technical", F.lit(False)))
    done = done.withColumn("tags", T.clean_tags(F.when(F.size("llm_tags") > 0, F.col("llm_tags")).otherwise(F.col("tags"))))
    s = scoring.score(F.col("source"), F.col("stars"), F.col("upvotes"), F.col("comments"), F.col("published_at"), as_of, cfg)
    rows = done.withColumn("score", s).withColumn("item_type", T.item_type(F.col("source")))
    tags = rows.select("url", F.explode("tags").alias("tag")).dropDuplicates(["url", "tag"])
    return {"articles": rows, "article_tags": tags}


def repos(crawled: DataFrame, stored: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """The repository snapshot: an empty crawl leaves it as it is."""
    fresh = R.keep_first(crawled.where(F.col("stars") >= cfg.min_stars_github), ["url"], [F.col("full_name")])
    fresh = fresh.withColumn("score", F.greatest(F.lit(1), F.col("stars") * 4))
    return R.snapshot_mirror(stored, fresh, "url", refresh=["full_name", "description", "language", "stars", "forks", "stars_this_week", "score"], keep_if_blank=["full_name", "description", "language"])


def refresh_scores(articles: DataFrame, as_of: Column, days: int | None = None, cfg: Config = DEFAULT) -> DataFrame:
    """Articles with the scores of those of the last ``days`` days renewed."""
    n = cfg.refresh_days if days is None else days
    recent = F.coalesce(F.col("created_at_source") >= as_of - F.expr(f"interval {int(n)} days"), F.lit(False))
    s = scoring.score(F.col("source"), F.col("stars"), F.col("upvotes"), F.col("comments"), F.col("created_at_source"), as_of, cfg)
    return articles.withColumn("score", F.when(recent, s).otherwise(F.col("score")))


def leaderboards(payload: DataFrame, stored_models: DataFrame, stored_creators: DataFrame) -> dict[str, DataFrame]:
    """Creators by external id, then models by model id or external id."""
    c = R.upsert(stored_creators, P.creators(payload), ["external_id"], order=[F.col("name")])
    return {"creators": c, "models": R.upsert(stored_models, P.models(payload), ["model_id"], order=[F.col("external_id")])}


def stage_list(stages: str | list[str] | None) -> list[str]:
    """Known stages in the order asked for, each once; all of them if none is left."""
    parts = stages.split(",") if isinstance(stages, str) else list(stages or [])
    return list(dict.fromkeys(p for p in (str(x).strip() for x in parts) if p in STAGES)) or list(STAGES)


def id_list(ids: str | list | None) -> list[int] | None:
    parts = ids.split(",") if isinstance(ids, str) else list(ids or [])
    out = [int(str(x).strip()) for x in parts if str(x).strip().lstrip("-").isdigit()]
    return out or None


def port_sync(projects: DataFrame, release_rows: DataFrame, tag_rows: DataFrame, metrics: DataFrame, stored_events: DataFrame, stored_metrics: DataFrame, as_of: Column, stages=None, project_ids=None) -> dict[str, DataFrame]:
    """Events (releases, else tags) and daily metrics of projects, written into their tables."""
    ids = id_list(project_ids)
    if ids is not None:
        projects = projects.where(F.col("id").isin(*ids))
    out = {}
    todo = stage_list(stages)
    if "events" in todo:
        ev = R.fallback_union(P.releases(release_rows, as_of), P.tags(tag_rows, as_of), "project_id").join(projects.select(F.col("id").alias("project_id")), "project_id", "left_semi")
        out["project_events"] = R.upsert(stored_events, ev, ["external_id"], order=[F.col("version")])
        last = ev.groupBy(F.col("project_id").alias("id")).agg(F.max("released_at").alias("_last"))
        projects = projects.join(last, "id", "left").withColumn("last_release", F.coalesce("_last", "last_release")).drop("_last")
    if "metrics" in todo:
        m = metrics.join(projects.select(F.col("id").alias("project_id")), "project_id", "left_semi")
        out["project_metrics_daily"] = R.upsert(stored_metrics, m, ["project_id", "date"], order=[F.col("ingested_at").desc()])
        today = R.keep_first(m, ["project_id"], [F.col("date").desc(), F.col("ingested_at").desc()]).select(F.col("project_id").alias("id"), *[F.col(c).alias(f"_{c}") for c in ("stars", "forks", "contributors")])
        projects = projects.join(today, "id", "left")
        for c in ("stars", "forks", "contributors"):
            projects = projects.withColumn(c, F.coalesce(f"_{c}", c)).drop(f"_{c}")
    out["projects"] = projects
    return out


def run(name: str, **inputs):
    """An entry point by name; an unknown one is an error."""
    known = {"articles": articles, "repos": repos, "refresh_scores": refresh_scores, "leaderboards": leaderboards, "port_sync": port_sync}
    if name not in known:
        raise ValueError(f"unknown source: {name}")
    return known[name](**inputs)
