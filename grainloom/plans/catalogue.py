"""Every core query with its oracle, gathered from the plan modules."""

from __future__ import annotations

from grainloom.plans import core, ingest, series

_MODULES = (series, core, ingest)
QUERIES = {k: q for m in _MODULES for k, q in m.QUERIES.items()}
ORACLE = {k: s for m in _MODULES for k, s in m.ORACLE.items()}
