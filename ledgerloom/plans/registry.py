"""What a registered query is."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    """A name, a callable over the table folder, and the same question in SQL."""

    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


class Collected:
    """Collects the queries of one module in order of definition."""

    def __init__(self) -> None:
        self.queries: list[Query] = []

    def add(self, sql: str | None = None):
        def register(run: Callable[[SparkSession, str], DataFrame]):
            self.queries.append(Query(run.__name__, run, sql))
            return run

        return register
