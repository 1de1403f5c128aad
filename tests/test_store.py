"""A bucketed store: touched buckets only, and nothing half done."""

from __future__ import annotations

import random
import re
import tempfile

import pytest
from pyspark.errors import AnalysisException

from rivulet.sources import caches, store

SCHEMA = "place string, state string, lat double"


@pytest.fixture
def path(spark):
    where = tempfile.mkdtemp(prefix="run-", dir="/tmp") + "/store"
    store.create_store(spark, where, spark.createDataFrame([], SCHEMA).schema, ["place", "state"], buckets=8)
    return where


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def content(spark, path):
    return {(r.place, r.state): r.lat for r in store.read_store(spark, path).collect()}


def files(spark, path):
    found = {}
    for name in store.read_store(spark, path).inputFiles():
        found.setdefault(int(re.search(r"bucket=(\d+)", name)[1]), set()).add(name)
    return found


def test_many_batches_equal_a_dictionary(spark, path):
    draw, expected = random.Random(1), {}
    assert content(spark, path) == {}
    for _ in range(4):
        keys = {(draw.choice([None, *"abcdefgh"]), draw.choice(["x", "y", None])) for _ in range(9)}
        rows = [(p, s, draw.random()) for p, s in keys]
        store.upsert(spark, path, table(spark, rows))
        expected |= {(p, s): v for p, s, v in rows}
        got = store.read_store(spark, path)
        assert got.count() == len(expected) and content(spark, path) == expected


def test_untouched_buckets_keep_their_files(spark, path):
    store.upsert(spark, path, table(spark, [(f"p{i}", "x", float(i)) for i in range(200)]))
    before = files(spark, path)
    held = store.read_store(spark, path)
    store.upsert(spark, path, table(spark, [("p7", "x", -1.0)]))
    after = files(spark, path)
    assert len(before) == 8 and sum(before[b] != after[b] for b in before) == 1
    assert content(spark, path)["p7", "x"] == -1.0 and len(content(spark, path)) == 200
    assert {r.place: r.lat for r in held.collect()}["p7"] == 7.0
    store.upsert(spark, path, table(spark, []))
    assert files(spark, path) == after


def test_interrupted_between_data_and_pointer(spark, path):
    store.upsert(spark, path, table(spark, [("a", "x", 1.0), ("b", "x", 2.0)]))
    lost = store.prepare_upsert(spark, path, table(spark, [("a", "x", 9.0), ("c", "x", 3.0)]))
    assert content(spark, path) == {("a", "x"): 1.0, ("b", "x"): 2.0}
    # The work goes on with what is not stored yet, and the lost batch cannot be committed late.
    wanted = table(spark, [("a", "x", 0.0), ("b", "x", 0.0), ("c", "x", 0.0)])
    open_keys = caches.anti_uncached(wanted, store.read_store(spark, path), ["place", "state"])
    store.upsert(spark, path, open_keys)
    assert content(spark, path) == {("a", "x"): 1.0, ("b", "x"): 2.0, ("c", "x"): None}
    with pytest.raises(AnalysisException):
        store.commit_upsert(spark, path, lost)


def test_refusals(spark, path):
    schema = table(spark, []).schema
    with pytest.raises(AnalysisException):
        store.create_store(spark, path, schema, ["place"])
    for keys, buckets in (([], 8), (["nowhere"], 8), (["place"], 0)):
        with pytest.raises(ValueError):
            store.create_store(spark, path + "2", schema, keys, buckets)
    with pytest.raises(ValueError):
        store.upsert(spark, path, table(spark, [("a", "x", 1.0), ("a", "x", 2.0)]))
    with pytest.raises(ValueError):
        store.upsert(spark, path, table(spark, []).drop("state"))
    with pytest.raises(ValueError):
        store.upsert(spark, path, table(spark, []).selectExpr("*", "1 as more"))
    assert content(spark, path) == {}
