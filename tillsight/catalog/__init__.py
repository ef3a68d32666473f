"""Every query by name, with the SQL that states its expected result."""

from __future__ import annotations

from . import aggregates, expressions, files, joins, learning, ordering, profiling, reports, streams  # noqa: F401
from .registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
