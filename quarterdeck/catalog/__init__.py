"""Registered queries: operators bound to the driver's tables, with SQL counterparts."""

from __future__ import annotations

import importlib

MODULES = ["q_sources", "q_sinks", "q_scalars", "q_payloads", "q_joins", "q_aggregates", "q_series", "q_sets", "q_formulas", "q_jobs", "q_modes"]


def load():
    """(queries, sql) of every module."""
    from quarterdeck.catalog import registry

    for m in MODULES:
        importlib.import_module(f"quarterdeck.catalog.{m}")
    return dict(registry.QUERIES), dict(registry.ORACLES)
