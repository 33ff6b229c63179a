"""The list of queries. A query has a name, a builder and, where SQL can say it, the SQL of its result."""

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


class Query(NamedTuple):
    build: Builder
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable[[Builder], Builder]:
    def register(build: Builder) -> Builder:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = Query(build, sql)
        return build

    return register
