"""All queries of the core."""

from __future__ import annotations

from tidemill.plans import cdc, index, problems

MODULES = (problems, cdc, index)


def queries() -> dict:
    return {k: v for m in MODULES for k, v in m.queries().items()}


def oracle_sql() -> dict[str, str]:
    return {k: v for m in MODULES for k, v in m.oracle_sql().items()}
