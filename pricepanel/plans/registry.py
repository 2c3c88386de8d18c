"""All queries of the price panel, and their oracle SQL."""

from __future__ import annotations

from importlib import import_module

_MODULES = ("panel_queries", "report_queries", "calendar_queries", "quote_queries", "source_queries")


def _parts():
    for name in _MODULES:
        try:
            yield import_module(f"pricepanel.plans.{name}")
        except ModuleNotFoundError as e:
            if e.name != f"pricepanel.plans.{name}":
                raise


def queries() -> dict:
    return {k: v for part in _parts() for k, v in part.Q.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v for part in _parts() for k, v in part.O.items()}
