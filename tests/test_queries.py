"""Every registered query against its SQL on the smallest data set."""

from __future__ import annotations

import parity
import pytest

from rivulet.plans import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return parity.connect(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, con, name):
    assert parity.compare(spark, con, QUERIES[name], ORACLES[name], SF_DIR) == ""


def test_entry_is_a_frame(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
