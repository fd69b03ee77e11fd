"""All registered queries over the driver's tables, each beside the SQL that checks it."""

from __future__ import annotations

from . import evaluating, files, mining, scoring  # noqa: F401  they register their queries
from .registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
