"""Registered queries: a Spark builder, a column spec and, where possible, a SQL check."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from barloom.plans.present import present, wrap_sql
from barloom.session import ship_package

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    build: Builder
    spec: str
    sql: str | None

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return present(self.build(ship_package(spark), sf_dir), self.spec)


REGISTRY: dict[str, Query] = {}


def query(name: str, spec: str, prefix: str = "", sql: str | None = None):
    """Register a builder under ``name``; without ``sql`` only its rows are checked."""
    def register(build: Builder) -> Builder:
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        check = wrap_sql(prefix, sql, spec) if sql is not None else None
        REGISTRY[name] = Query(build, spec, check)
        return build
    return register
