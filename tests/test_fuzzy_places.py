"""Gazetteer lookup with misspellings, against all pairs."""

from __future__ import annotations

import random

from rivulet.operators import locate


def distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_no_similar_pair_is_lost(spark):
    rng = random.Random(4)
    words = ["".join(rng.choice("abcd") for _ in range(rng.randrange(1, 16))) for _ in range(120)]
    for w in list(words):
        for _ in range(2):
            t = list(w)
            for _ in range(rng.randrange(1, 4)):
                i = rng.randrange(len(t) + 1)
                t[i:i + rng.randrange(2)] = rng.choice(["", "a", "x", "é"])
            words.append("".join(t))
    texts = sorted({f"{w}, {rng.choice('PQ')}, India" for w in words} | {"no area", "", "lonely, part"})
    half = set(texts[::2])
    df = spark.createDataFrame([(t,) for t in texts], "query string")
    known = spark.createDataFrame([(t,) for t in half] + [(None,)], "query string")
    found = {(r["text"], r["match"]): r["distance"] for r in locate.similar_places(df, known).collect()}

    def cut(t):
        parts = t.rsplit(", ", 2)
        return (parts[0], parts[1:]) if len(parts) == 3 else (t, [])

    expected = {}
    for a in texts:
        for b in half:
            (x, p), (y, q) = cut(a), cut(b)
            d = distance(x, y)
            if p == q and 0 < d <= min(2, len(x) // 6):
                expected[a, b] = d
    assert found == expected and len(expected) > 40


def test_best_hit_and_misses(spark):
    places = spark.createDataFrame([("Hussain Sagar Lake", "Telangana"), ("Hussain Sagar Lake", "Goa"), ("abc", "Goa"), (None, None)],
                                   "monitoring_location string, state string")
    known = spark.createDataFrame([("Husain Sagar Lake, Telangana, India", 1.0, 2.0), ("Hussain Saggar Lake, Telangana, India", 3.0, 4.0),
                                   ("abd, Goa, India", 5.0, 6.0), ("Lake, Goa, India", None, None)], "query string, lat double, lng double")
    got = {(r["monitoring_location"], r["state"]): r for r in locate.join_gazetteer_fuzzy(places, known).collect()}
    hit = got["Hussain Sagar Lake", "Telangana"]
    assert (hit["lat"], hit["matched"], hit["distance"], hit["success"]) == (1.0, "Husain Sagar Lake, Telangana, India", 1, True)
    assert not got["Hussain Sagar Lake", "Goa"]["success"] and not got["abc", "Goa"]["success"]
    assert not got["", ""]["success"] and len(got) == 4


def test_no_pairing_of_all_texts_in_the_plan(spark):
    df = spark.createDataFrame([("abcdefgh, P, India",)], "query string")
    plan = locate.similar_places(df, df)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_crowded_places_lose_no_pair(spark):
    rng = random.Random(5)
    texts = {f"{rng.choice(['blue ring', 'red roof'])} {rng.randrange(10 ** 4)}" for _ in range(90)}
    for w in sorted(texts):
        t = list(w)
        for _ in range(rng.randrange(1, 4)):
            i = rng.randrange(len(t))
            t[i:i + rng.randrange(2)] = rng.choice(["", "z", "o", t[i], "\U0001f30a"])
        texts.add("".join(t))
    half = set(sorted(texts)[::2]) | {f"small {i}" for i in range(20)}
    df = spark.createDataFrame([(f"{t}, P, India",) for t in texts], "query string")
    known = spark.createDataFrame([(f"{t}, P, India",) for t in half], "query string")
    found = [tuple(r) for r in locate.similar_places(df, known).collect()]
    tail = ", P, India"
    expected = {(a + tail, b + tail, d) for a in texts for b in half
                if abs(len(a) - len(b)) < 3 and 0 < (d := distance(a, b)) <= min(2, len(a) // 6)}
    assert len(found) == len(set(found)) and set(found) == expected and len(expected) > 60


def joined_rows(node) -> int:
    """The most rows that a join of an executed plan gave."""
    name, inner = node.nodeName(), []
    if name == "AdaptiveSparkPlan":
        inner = [node.executedPlan()]
    elif name.endswith("QueryStage"):
        inner = [node.plan()]
    children = node.children()
    inner += [children.apply(i) for i in range(children.size())]
    own = node.metrics().get("numOutputRows").get().value() if "Join" in name else 0
    return max([own] + [joined_rows(n) for n in inner])


def test_numbered_places_do_not_all_meet(spark):
    rng, met = random.Random(6), []
    rules = "spark.sql.optimizer.excludedRules"
    spark.conf.set(rules, "org.apache.spark.sql.catalyst.optimizer.PushDownPredicates")  # joins count what they compare
    try:
        for n in (1500, 6000):
            df = spark.createDataFrame([(f"blue ring {i}, P, India",) for i in rng.sample(range(10 ** 8, 10 ** 9), n)], "query string")
            near = locate.similar_places(df, df)
            near.collect()
            met.append(joined_rows(near._jdf.queryExecution().executedPlan()))
    finally:
        spark.conf.unset(rules)
    assert 0 < met[1] < 6 * met[0], met
