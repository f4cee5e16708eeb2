"""All registered queries."""

from __future__ import annotations

import importlib

from trialmill.plans.registry import Query

MODULES = (
    "run_queries",
    "gate_queries",
    "text_queries",
    "engine_queries",
    "submission_queries",
    "storage_queries",
    "history_queries",
    "metadata_queries",
)


def _registries():
    return [importlib.import_module(f"trialmill.plans.{m}").registry for m in MODULES]


def queries() -> dict[str, Query]:
    return {name: q for r in _registries() for name, q in r.queries.items()}


def oracle_sql() -> dict[str, str]:
    return {name: q for r in _registries() for name, q in r.sql.items()}
