"""Collects the registered queries and oracles of every family."""

from __future__ import annotations

_FAMILIES = ("queries", "queries_io", "queries_eval", "queries_ml", "queries_live")
_ORACLES = ("oracles", "oracles_io", "oracles_eval", "oracles_live")


def _load():
    import importlib
    for m in _FAMILIES + _ORACLES:
        importlib.import_module(f"barpanel.plans.{m}")


def all_queries() -> dict:
    _load()
    from barpanel.plans import queries
    return dict(queries.REGISTRY)


def all_oracles() -> dict:
    _load()
    from barpanel.plans import oracles
    q = all_queries()
    return {k: v for k, v in oracles.ORACLES.items() if k in q}
