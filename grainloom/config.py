"""Thresholds the engine carries, with their defaults."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Config:
    plateau_days: float = 2.0
    decay_days: float = 4.0
    max_age_days: float = 14.0
    base_multiplier: float = 2.0
    source_weights: dict = field(default_factory=lambda: {"github": 2.0})
    min_upvotes_devto: int = 10
    min_upvotes_hashnode: int = 5
    min_upvotes_reddit: int = 100
    min_score_hn: int = 50
    max_age_hn_days: int = 7
    max_stories_hn: int = 100
    min_stars_github: int = 50
    similarity: float = 0.9
    min_content: int = 6000
    max_content: int = 15000
    history_cap_days: int = 730
    recent_days: int = 90
    refresh_days: int = 14


DEFAULT = Config()
