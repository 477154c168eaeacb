"""Queries by name, and their SQL."""

from __future__ import annotations

from tesserae.plans import catalogue, instances, mesh, metadata, observing, scene

FLAGSHIP = "support_patches"
_FAMILIES = (mesh, scene, metadata, catalogue, instances, observing)


def queries() -> dict:
    return {name: q for family in _FAMILIES for name, q in family.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for family in _FAMILIES for name, sql in family.SQL.items()}
