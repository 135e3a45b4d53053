"""Engagement scores with time decay, as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from grainloom.config import DEFAULT, Config


def age_days(published: Column, as_of: Column) -> Column:
    """Fractional days from ``published`` to ``as_of``; negative for the future."""
    micros = lambda c: F.unix_micros(c.cast("timestamp"))
    return (micros(as_of) - micros(published)) / F.lit(86400e6)


def engagement(source: Column, stars: Column, upvotes: Column) -> Column:
    s, u = F.coalesce(stars, F.lit(0)), F.coalesce(upvotes, F.lit(0))
    src = F.lower(source)
    return F.when(src == "github", s).when(src.isin("devto", "hashnode", "medium"), u).otherwise(F.greatest(s, u))


def decay(age: Column, cfg: Config = DEFAULT) -> Column:
    """A plateau, then exponential decay, then nothing. Future dates sit on the plateau."""
    return (
        F.when(age <= cfg.plateau_days, F.lit(cfg.base_multiplier))
        .when(age <= cfg.max_age_days, F.lit(cfg.base_multiplier) * F.exp(-(age - cfg.plateau_days) / cfg.decay_days))
        .otherwise(F.lit(0.0))
    )


def source_weight(source: Column, cfg: Config = DEFAULT) -> Column:
    w = F.lit(1.0)
    for name, v in cfg.source_weights.items():
        w = F.when(F.lower(source) == name, F.lit(v)).otherwise(w)
    return w


def comment_multiplier(comments: Column) -> Column:
    c = F.coalesce(comments, F.lit(0))
    return F.when(c <= 0, 1.0).when(c < 5, 1.1).when(c < 10, 1.2).when(c < 20, 1.3).when(c < 50, 1.4).otherwise(1.5)


def score(source: Column, stars: Column, upvotes: Column, comments: Column, published: Column, as_of: Column, cfg: Config = DEFAULT) -> Column:
    """At least 1; the product is cut towards zero."""
    v = engagement(source, stars, upvotes) * decay(age_days(published, as_of), cfg) * source_weight(source, cfg) * comment_multiplier(comments)
    return F.greatest(F.lit(1), v.cast("int"))
