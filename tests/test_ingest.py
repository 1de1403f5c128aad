"""Change detection by digest: what is read again, what stays, and what an interruption leaves."""

from __future__ import annotations

import os
import re
import tempfile

import pytest

from rivulet.functions.digests import digest_per
from rivulet.operators import ingest, knowledge
from rivulet.sources import store

PAGES = "source string, page int, text string"


@pytest.fixture
def path(spark):
    where = tempfile.mkdtemp(prefix="run-", dir="/tmp") + "/chunks"
    ingest.create_chunk_store(spark, where, buckets=4)
    return where


def files(path):
    return sorted(os.path.join(folder, name) for folder, _, names in os.walk(path) for name in names)


def run(spark, path, rows, **sizes):
    pages = spark.createDataFrame(rows, PAGES)
    return ingest.ingest_changed(spark, path, pages, "page", **({"size": 3, "overlap": 1} | sizes))


def content(spark, path):
    return sorted((r.source, r.chunk_index, r.document, r.batch) for r in ingest.read_chunks(spark, path).collect())


FIRST = [("a", 1, "one two"), ("a", 2, "three four"), ("b", 1, "five"), ("c", 1, "six"), ("c", 2, None), (None, 1, "lost")]


def test_a_second_run_writes_nothing(spark, path):
    assert run(spark, path, FIRST) == 3
    held, before = content(spark, path), files(path)
    assert held == [("a", 0, "one two three", 1), ("a", 1, "three four", 1), ("b", 0, "five", 1), ("c", 0, "six", 1)]
    assert run(spark, path, FIRST[::-1]) == 0
    assert files(path) == before and content(spark, path) == held


def test_only_changed_sources_are_written(spark, path):
    run(spark, path, FIRST)
    before = set(ingest.read_chunks(spark, path).inputFiles())
    # b gets another text, c loses its words, d is new, a is not given.
    assert run(spark, path, [("b", 1, "five!"), ("c", 1, " "), ("c", 2, None), ("d", 1, "new")]) == 3
    assert content(spark, path) == [
        ("a", 0, "one two three", 1), ("a", 1, "three four", 1), ("b", 0, "five!", 2), ("d", 0, "new", 2)]
    buckets = spark.sql("SELECT s, pmod(xxhash64(s), 4L) AS b FROM VALUES ('a'), ('b'), ('c'), ('d') t(s)")
    of = {r.s: r.b for r in buckets.collect()}
    after = set(ingest.read_chunks(spark, path).inputFiles())
    for name in before:
        bucket = int(re.search(r"bucket=(\d+)", name)[1])
        assert (name in after) == (bucket not in {of[s] for s in "bcd"})
    # Pages swapped between numbers, one page doubled, and other chunk sizes are changes too.
    assert run(spark, path, [("a", 1, "three four"), ("a", 2, "one two")]) == 1
    assert run(spark, path, [("b", 1, "five!"), ("b", 1, "five!")]) == 1
    assert run(spark, path, [("d", 1, "new")], size=4) == 1


def test_everything_can_leave_a_bucket(spark, path):
    run(spark, path, [("a", 1, "one")])
    assert run(spark, path, [("a", 1, "")]) == 1
    assert content(spark, path) == [] and run(spark, path, [("a", 1, "")]) == 0
    assert run(spark, path, [("a", 1, "back")]) == 1
    assert content(spark, path) == [("a", 0, "back", 3)]


def test_an_interrupted_run_is_done_again(spark, path):
    run(spark, path, FIRST)
    pages = spark.createDataFrame([("b", 1, "later")], PAGES)
    changed = ingest.changed_sources(spark, path, pages, "page", size=3, overlap=1)
    new = knowledge.chunk_ids(knowledge.chunk_pages(pages, "source", "page", size=3, overlap=1))
    # Cut off after the chunks and before the digests.
    store.upsert(spark, f"{path}/chunks", new.selectExpr("*", "2 as batch"), changed)
    assert run(spark, path, [("b", 1, "later")]) == 1
    assert ("b", 0, "later", 2) in content(spark, path) and len(content(spark, path)) == 4
    assert run(spark, path, [("b", 1, "later")]) == 0


def test_empty_input(spark, path):
    assert run(spark, path, []) == 0 and content(spark, path) == []


def test_digests_tell_row_sets_apart(spark):
    sets = {"same": [("x", "y"), ("p", "q")], "turned": [("p", "q"), ("x", "y")], "doubled": [("x", "y"), ("x", "y"), ("p", "q")],
            "moved": [("xy", ""), ("p", "q")], "null": [("x", "y"), ("p", None)], "empty": [("x", "y"), ("p", "")]}
    rows = [(k, a, b) for k, pairs in sets.items() for a, b in pairs]
    df = spark.createDataFrame(rows, "k string, a string, b string").repartition(5)
    found = {r.k: r.digest for r in digest_per(df, ["k"], ["a", "b"]).collect()}
    assert found["same"] == found["turned"] and len(set(found.values())) == len(sets) - 1
