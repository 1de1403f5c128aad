"""Near duplicates among rows whose id is repeated with different texts."""

from __future__ import annotations

import random

from rivulet.llm import simhash


def text(seed):
    draw = random.Random(seed)
    return " ".join("".join(draw.choice("abcdefghij") for _ in range(6)) for _ in range(60))


def stay(spark, rows):
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(3)
    return sorted((r.doc_id, r.text, r.source) for r in simhash.keep_first(df).collect())


def test_every_group_of_a_repeated_id_keeps_a_row(spark):
    rows = [(8, text(n), "hot") for n in range(40)]  # one id, forty unlike texts
    rows += [(9 + n, text(n).upper(), "copy") for n in range(40)] + [(100, text(100), "own")]
    assert stay(spark, rows) == sorted([r for r in rows if r[2] != "copy"])


def test_row_of_another_group_does_not_stand_in(spark):
    # Id 8 has a text of the group whose representative is 3, and the only text of another group; the
    # first of its rows by their other columns is the one that must go.
    a, b = sorted([text(1), text(2)])
    rows = [(3, a, "x"), (8, a, "x"), (8, b, "x")]
    assert stay(spark, rows) == [(3, a, "x"), (8, b, "x")]


def test_one_row_of_a_group_whose_id_has_near_texts(spark):
    a = " ".join(map(text, range(3, 13)))
    longer = (f"{a} more{n}" for n in range(500))
    b = next(t for t in longer if 0 < (simhash.fingerprint(t) ^ simhash.fingerprint(a)).bit_count() <= 4)
    rows = [(8, b, "x"), (8, a, "x"), (8, a, "y"), (9, b, "x"), (10, None, "x")]
    assert stay(spark, rows) == [(8, b, "x"), (10, None, "x")]  # a space sorts before the closing quote
