import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]

from barorail.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, 4)
    yield session
    session.stop()


@pytest.fixture
def value(spark):
    """Evaluate an expression on one row of named literals."""
    from pyspark.sql import functions as F

    def evaluate(column, **literals):
        row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in literals.items()] or ["id"])
        return row.select(column.alias("v")).head()[0]

    return evaluate
