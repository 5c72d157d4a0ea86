"""The list of named queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ledgerlark.sources.tables import Tables

Build = Callable[[Tables], DataFrame]


@dataclass(frozen=True)
class Query:
    """A Spark query and, where SQL can say it, a differently written SQL twin."""

    name: str
    build: Build
    sql: str | None

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.build(Tables(spark, folder))


QUERIES: dict[str, Query] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Build], Build]:
    """Register the decorated function under its own name."""

    def register(build: Build) -> Build:
        key = name or build.__name__
        if key in QUERIES:
            raise ValueError(f"query {key} registered twice")
        QUERIES[key] = Query(key, build, sql)
        return build

    return register
