"""Registered queries of this package."""

from __future__ import annotations

from ..plans.registry import Query
from . import queries_dedup, queries_layout, queries_models, queries_prints, queries_text

QUERIES: list[Query] = [*queries_dedup.QUERIES, *queries_text.QUERIES, *queries_layout.QUERIES,
                        *queries_models.QUERIES, *queries_prints.QUERIES]
