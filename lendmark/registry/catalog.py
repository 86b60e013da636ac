"""All registered queries: importing the modules fills the registry."""

from __future__ import annotations

import importlib

from lendmark.registry.base import ORACLES, QUERIES, Query

MODULES = ("layers", "history", "statistics", "scorecard", "validation", "monitoring")


def load() -> tuple[dict[str, Query], dict[str, str]]:
    for name in MODULES:
        importlib.import_module(f"lendmark.registry.{name}")
    return dict(QUERIES), dict(ORACLES)
