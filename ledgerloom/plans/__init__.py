"""Registered queries: each is a Spark callable and, where SQL can say it, a DuckDB text."""

from __future__ import annotations

from . import images, onboarding, sales
from .registry import Query

CATALOG: dict[str, Query] = {
    q.name: q for module in (onboarding, sales, images) for q in module.QUERIES
}
