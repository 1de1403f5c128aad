from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]


@pytest.fixture(scope="session")
def spark():
    from rivulet.session import local_session

    session = local_session("8", memory="6g")
    yield session
    session.stop()


@pytest.fixture
def values(spark):
    """Evaluates a column function over hand-made rows and returns the results in order."""
    def run(rows, schema, *columns):
        df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"_i int, {schema}")
        found = df.select("_i", *[c.alias(f"r{n}") for n, c in enumerate(columns)]).orderBy("_i")
        results = [tuple(r)[1:] for r in found.collect()]
        return [r[0] for r in results] if len(columns) == 1 else results
    return run
