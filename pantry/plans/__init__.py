"""Registered queries (Spark builders + DuckDB oracle SQL)."""

from __future__ import annotations

import importlib

_MODULES = ["q_enrich", "q_training", "q_eval", "q_quality", "q_candidates", "q_monitor", "q_io", "q_ml", "q_stream"]


def load_all():
    from .registry import REGISTRY
    for m in _MODULES:
        importlib.import_module(f"{__name__}.{m}")
    return REGISTRY
