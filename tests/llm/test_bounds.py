"""Large components of vectors, and the documented bounds on what models learn from."""

from __future__ import annotations

import random

import pytest
from test_topk_urls import brute

from rivulet.llm import quality, topk, toxicity


def long_or_none(rows):
    return {(q, n, i, s if -(1 << 63) <= s < 1 << 63 else None) for q, n, i, s in rows}


@pytest.mark.parametrize("sizes, fits", [
    ([0.25, -1.5, 3e5, -5e5, 2.0 ** 22, -(2.0 ** 23) - 0.5], True),
    ([0.25, -1.5, 3e5, -5e5, 2.0 ** 40, -(2.0 ** 45), 2.0 ** 49, -(2.0 ** 49)], False)])
def test_topk_with_large_components(spark, sizes, fits):
    draw = random.Random(3)
    rows = [(i, [draw.choice(sizes) for _ in range(4)]) for i in range(120)]
    rows += [] if fits else [(200, [4e12, 0.0, 0.0, 0.0]), (201, [0.0, 2.0 ** 49, 0.0, 0.0]), (202, [-2000.0, 0.5, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    asked = [0, 20] if fits else [0, 20, 200, 201, 202]
    found = topk.bit_sliced_topk(df, df.where(df.vec_id.isin(asked)), 20, block_rows=50).collect()
    expected = long_or_none(brute(rows, asked, 20))
    assert {(r.query_id, r.rank, r.vec_id, r.score) for r in found} == expected
    among = {s for q, _, _, s in expected if q < 200}
    assert (max(map(abs, among)) > 1 << 56) if fits else among == {None}


def test_topk_holds_components_beyond_its_range(spark):
    rows = [(1, [1.0, 0.0]), (2, [1e300, 0.0]), (3, [-1.7e308, 1.0]), (4, [2.0 ** 49, 5.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    found = sorted(tuple(r) for r in topk.bit_sliced_topk(df, df.where("vec_id = 1"), 3).collect())
    assert found == [(1, 1, 2, 64 << 55), (1, 2, 4, 64 << 55), (1, 3, 3, -(64 << 55))]


def test_a_very_long_text_leaves_room_for_others_in_a_dictionary():
    long, short = b"L" * 5_000_000, [bytes([65 + i]) * 1500 for i in range(20)]
    chunks = quality._chunks_in_turn([long, *short, b""], 40_000)
    assert sum(map(len, chunks)) == 40_000
    assert {c[:1] for c in chunks} >= {s[:1] for s in short}
    assert b"".join(quality._chunks_in_turn(short[:2], 1 << 20)) == (
        short[0][:1024] + short[1][:1024] + short[0][1024:] + short[1][1024:])
    assert quality._chunks_in_turn([], 10) == quality._chunks_in_turn([b"abc"], 0) == []


def labelled(spark, long_text):
    draw = random.Random(8)
    good = "harbour water sample measured clear river oxygen report station".split()
    bad = "click win prize zzz buy cheap now offer !!!".split()
    rows = [(i, " ".join(draw.choices(good if i % 2 else bad, k=60)), i % 2) for i in range(120)]
    return spark.createDataFrame([*rows, (500, long_text, 0)], "doc_id bigint, text string, label int"), rows


def test_quality_learns_beside_a_very_long_text(spark):
    df, rows = labelled(spark, "win cheap " * 400_000)
    model = quality.fit(df, dictionary_text=64 << 10)
    scores = {r.doc_id: r.score for r in quality.score(df, model).collect()}
    assert sum((scores[i] >= 0.5) == (label == 1) for i, _, label in rows) >= 118


def test_toxic_features_and_plain_sequences_are_parameters(spark):
    draw = random.Random(4)
    words = "the river was calm and people walked home after work today".split()
    rows = [(i, " ".join(draw.choices(words, k=20) + (["vermin", "scumbag"] if i % 4 == 0 else [])), int(i % 4 == 0))
            for i in range(160)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, label int")
    field = toxicity.fit(df, features=200, plain_sequences=50)
    scores = {r.doc_id: r.score for r in toxicity.score(df, field).collect()}
    assert all((scores[i] >= 0.3) == (label == 1) for i, _, label in rows)
    unmarked = toxicity.score(df, toxicity.fit(df, features=0)).collect()
    assert len({r.score for r in unmarked}) == 1
