"""Collects the named queries with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .sql import query
from .views import Views

Build = Callable[[Views], DataFrame]

QUERIES: dict[str, Build] = {}
SQL: dict[str, str] = {}


def add(name: str, build: Build, sql: str | None = None) -> None:
    if name in QUERIES:
        raise ValueError(f"query {name!r} exists")
    QUERIES[name] = build
    if sql is not None:
        SQL[name] = query(sql)


def runner(name: str) -> Callable[[SparkSession, str], DataFrame]:
    build = QUERIES[name]
    return lambda spark, sf_dir: build(Views(spark, sf_dir))
