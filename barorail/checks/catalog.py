"""Every named query and its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import facts, live, streams  # noqa: F401  (importing them registers the queries)
from .registry import QUERIES, SQL, runner


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: runner(name) for name in QUERIES}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
