"""All registered queries by name."""

from __future__ import annotations

import importlib

from shelfwise.plans.query import REGISTRY

for _module in ("facts", "cleaning", "dimensions", "stock", "forecasting", "streams"):
    importlib.import_module(f"shelfwise.plans.{_module}")


def queries():
    return {name: q.frame for name, q in REGISTRY.items()}


def oracle_sql():
    return {name: q.oracle() for name, q in REGISTRY.items() if q.sql is not None}
