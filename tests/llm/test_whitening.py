"""Whitening against plain whole-number and floating-point versions."""

from __future__ import annotations

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rivulet.llm import whitening


def plain(vectors, scale=64, shift=1_000_000):
    x = [[math.floor(scale * float(np.float64(c))) + shift for c in v] for v in vectors]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    spread = [[n * sum(r[i] * r[j] for r in x) - sums[i] * sums[j] for j in range(len(sums))] for i in range(len(sums))]
    return x, n, sums, np.array([[v / (n * n) for v in row] for row in spread])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 1 << 40), min_size=3, max_size=3), min_size=1, max_size=90))
def test_bit_planes_give_exact_products(rows):
    found = whitening.scatter(np.array(rows, dtype=np.int64))
    for i in range(3):
        for j in range(i, 3):
            assert int(found[i, j]) == sum(r[i] * r[j] for r in rows)


@pytest.mark.parametrize("scale_of", [1.0, 1e6, 1e12])
def test_against_plain(spark, scale_of):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(301, 6)) @ rng.normal(size=(6, 6)) * scale_of
    rows = [(i, [float(c) for c in v], "k") for i, v in enumerate(base)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, x string").repartition(7)
    model = whitening.fit(df, components=4)
    x, n, sums, covariance = plain(base)
    assert model.n == n and model.sums == sums
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(values)[::-1][:4]
    np.testing.assert_allclose(model.variances, values[order], rtol=1e-9)
    np.testing.assert_allclose(model.explained, values[order] / np.trace(covariance), rtol=1e-9)
    assert whitening.identity_error(df, model) < 1e-8
    found = {r["vec_id"]: r for r in whitening.whiten(df, model).collect()}
    assert len(found) == 301
    for i in (0, 17, 300):
        y = [n * c - s for c, s in zip(x[i], sums)]
        assert int(found[i]["deviation"]) == sum(v * v for v in y)
        expected = np.abs(np.array(y, dtype=float) / n @ vectors[:, order]) / np.sqrt(values[order])
        np.testing.assert_allclose(np.abs(found[i]["whitened"]), expected, rtol=1e-6, atol=1e-9)


def test_unusable_rows_and_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0, 0.5]), (2, None), (3, [1.0, None, 2.0]), (4, [nan, 1.0, 1.0]), (5, [inf, 1.0, 1.0]), (None, [3.0, 1.0, 0.25]),
            (6, [0.0, 0.0, 7.0]), (6, [0.0, 0.0, 7.0]), (7, [2.0]), (8, []), (9, [-20_000.0, 5.0, 1.0])]
    df = spark.createDataFrame([(*r, "z", 1) for r in rows], "vec_id bigint, embedding array<double>, _x string, id int")
    model = whitening.fit(df.drop("_x"))
    used = [r[1] + [0.0] * (3 - len(r[1])) for r in rows if r[0] in (1, None, 6, 7, 8, 9)]
    x, n, sums, covariance = plain(used)
    assert (model.n, model.sums) == (7, sums) == (n, sums)
    found = whitening.whiten(df, model).collect()
    assert sorted(str(r["vec_id"]) for r in found) == ["1", "6", "6", "7", "8", "9", "None"]
    assert {int(r["deviation"]) for r in found} == {sum((n * c - s) ** 2 for c, s in zip(row, sums)) for row in x}
    assert whitening.identity_error(df, model) < 1e-6
    none = df.where("false")
    assert whitening.whiten(none, whitening.fit(none)).collect() == []


def test_components_without_variance_are_left_out(spark):
    df = spark.createDataFrame([(i, [float(i), float(2 * i), 3.0]) for i in range(50)], "vec_id bigint, embedding array<double>")
    model = whitening.fit(df)
    assert len(model.variances) == 1 and abs(model.explained[0] - 1) < 1e-12
    same = df.select("vec_id").withColumn("embedding", F.array(*[F.lit(1.0)] * 3))
    flat = whitening.fit(same)
    assert [r["whitened"] for r in whitening.whiten(same, flat).limit(2).collect()] == [[], []]
    huge = spark.createDataFrame([(1, [1e300, 1.0]), (2, [-1e300, 2.0]), (3, [0.0, 5.0])], "vec_id bigint, embedding array<double>")
    assert len(whitening.whiten(huge, whitening.fit(huge)).collect()) == 3
