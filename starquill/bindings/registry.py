"""All registered queries and their comparison SQL."""

from __future__ import annotations

from importlib import import_module

FAMILIES = ("report_queries", "function_queries", "expression_queries", "source_queries",
            "job_queries", "quality_queries", "access_queries", "catalog_queries")


def _collect(attribute: str) -> dict:
    found: dict = {}
    for family in FAMILIES:
        found.update(getattr(import_module(f"starquill.bindings.{family}"), attribute))
    return found


def queries() -> dict:
    return _collect("QUERIES")


def oracle_sql() -> dict[str, str]:
    return _collect("ORACLES")
