from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from dossierkit.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8)
    yield session
    session.stop()


@pytest.fixture
def evaluate(spark):
    """Results of an expression over column ``x`` for a list of texts."""

    def run(expression: str, values: list, kind: str = "string"):
        df = spark.createDataFrame(list(enumerate(values)), f"i int, x {kind}")
        return [r.y for r in df.selectExpr("i", f"{expression} AS y").orderBy("i").collect()]

    return run


@pytest.fixture
def plan():
    """Physical plan of a DataFrame as text."""

    def text(df) -> str:
        return df.select("*")._jdf.queryExecution().executedPlan().toString()

    return text
