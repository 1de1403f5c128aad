"""Bounded samples keep the base rate of the labels, whatever the size of the table."""

from __future__ import annotations

import random

import numpy as np

from rivulet.llm import langid, quality, toxicity
from rivulet.llm.common import bounded_sample


def test_sample_rows_weigh_as_their_class(spark):
    df = spark.createDataFrame([(i, int(i % 10 == 0), "z") for i in range(4000)],
                               "doc_id bigint, label int, text string")
    rows = bounded_sample(df, "doc_id", "label", "text", 400).collect()
    assert {(r.label, r.weight) for r in rows} == {(1, 1.0), (0, 9.0)}
    share = sum(r.weight for r in rows if r.label) / sum(r.weight for r in rows)
    assert abs(share - 0.1) < 0.02 and len(rows) < 1000
    assert {r.weight for r in bounded_sample(df, "doc_id", "label", "text", 4000).collect()} == {1.0}


def test_calibration_and_temperature_count_weights():
    y, weights = np.array([0.0, 1.0] * 50), np.array([1.0, 9.0] * 50)
    w = quality.calibrate(np.ones((100, 1)), y, weights=weights)
    assert abs(1 / (1 + np.exp(-w[0])) - 0.9) < 0.01
    logits, y = np.array([[2.0, 0.0], [2.0, 0.0]]), np.array([0, 1])
    sure, unsure = (langid.best_temperature(logits, y, np.array(c)) for c in ([9.0, 1.0], [6.0, 4.0]))
    assert abs(2 / sure - np.log(9)) < 0.01 and abs(2 / unsure - np.log(1.5)) < 0.01


def test_quality_of_a_bounded_sample(spark):
    draw = random.Random(1)
    rows = [(i, " ".join(draw.choice("abcdefgh") * 3 for _ in range(30)), int(i % 10 > 0)) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, label int")
    model = quality.fit(df, sample_rows=200)  # the texts say nothing, so the share of good is all there is
    assert abs(np.mean([r.score for r in quality.score(df, model).collect()]) - 0.9) < 0.06


def test_toxicity_of_a_bounded_sample(spark):
    draw, rows = random.Random(2), []
    for i in range(3000):
        toxic = i % 10 == 0
        words = [draw.choice(["river", "water", "stone", "bridge", "garden", "window"]) for _ in range(30)]
        if toxic or draw.random() < 0.1:
            words[draw.randrange(30)] = "vile"
        rows.append((i, " ".join(words), int(toxic)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string, label int")
    texts = df.where("text like '%vile%'")  # about half of these are toxic
    found = [np.mean([r.score for r in toxicity.score(texts, toxicity.fit(df, sample_rows=n)).collect()])
             for n in (200, 3000)]
    assert abs(found[0] - found[1]) < 0.15
