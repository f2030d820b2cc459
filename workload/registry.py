"""All registered queries and their checking SQL."""

from __future__ import annotations

import importlib

AREAS = ("storage", "quality", "profiling", "versions", "mapping", "entities", "validation", "runs")
QUERIES, ORACLES = {}, {}
for _area in AREAS:
    _module = importlib.import_module(f"workload.{_area}")
    QUERIES.update(_module.QUERIES)
    ORACLES.update(_module.ORACLES)
