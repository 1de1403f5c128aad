"""Exact search in the pivot index against all pairs."""

from __future__ import annotations

import numpy as np
import pytest

from rivulet.operators import vector_index


def brute(rows, queries, k):
    x = np.array([v for _, v in rows])
    out = set()
    for q, v in queries:
        d = ((x - np.array(v)) ** 2).sum(axis=1)
        order = sorted(range(len(rows)), key=lambda i: (d[i], rows[i][0]))[:k]
        out |= {(q, rows[i][0], r + 1) for r, i in enumerate(order)}
    return out


@pytest.mark.parametrize(("pivots", "block", "k"), [(7, 16, 4), (1, 2048, 3), (40, 5, 30), (3, 4, 500)])
def test_equals_all_pairs_and_skips_most(spark, pivots, block, k):
    rng = np.random.default_rng(pivots)
    centres = rng.normal(size=(8, 5)) * 50
    rows = [(i, (centres[i % 8] + np.round(rng.normal(size=5), 1)).tolist()) for i in range(300)]
    rows += [(300 + i, rows[0][1]) for i in range(100)]  # a large group of equal vectors
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(5)
    queries = rows[::30] + [(9_999, [1000.0] * 5)]
    asked = spark.createDataFrame(queries, "query_id bigint, embedding array<double>")
    path = vector_index.build_index(df, pivots=pivots, block=block)
    found = vector_index.search_index(spark, path, asked, k).collect()
    assert {(r["query_id"], r["chunk_id"], r["rank"]) for r in found} == brute(rows, queries, k)
    # The kept index answers again, for other queries.
    again = vector_index.search_index(spark, path, asked.limit(1), 2).collect()
    assert len(again) == 2
    if pivots == 7:
        pairs = vector_index.search_index(spark, path, asked, k, count_pairs=True).first()
        assert pairs["possible"] == 400 * len(queries) and pairs["compared"] < pairs["possible"] / 2


def test_rows_that_take_no_part(spark):
    rows = [(1, [1.0, 2.0]), (2, None), (3, [None, 1.0]), (None, [1.0, 1.0]), (4, []), (5, [0.0, 0.0]), (5, [0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    path = vector_index.build_index(df)
    found = vector_index.search_index(spark, path, df.withColumnRenamed("vec_id", "query_id"), 2)
    assert sorted((r["query_id"], r["chunk_id"], r["distance"]) for r in found.collect()) == [
        (1, 1, 0.0), (1, 5, 5.0), (5, 5, 0.0), (5, 5, 0.0)]
    none = vector_index.build_index(df.limit(0))
    assert vector_index.search_index(spark, none, df.withColumnRenamed("vec_id", "query_id"), 2).collect() == []
