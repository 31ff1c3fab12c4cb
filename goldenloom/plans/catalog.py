"""All queries by name, with the SQL that gives the same rows."""

from __future__ import annotations

from goldenloom.plans import linkage, mastering, operations, relational, warehouse  # noqa: F401
from goldenloom.plans.registry import ORACLE_SQL, QUERIES  # noqa: F401
