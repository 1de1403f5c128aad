"""Operators over hand-made rows."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from rivulet import rules as R
from rivulet import schema as S
from rivulet.operators import (batch, compare, evaluate, explain, extract, forecast, knowledge, latest, locate, score, shaping,
                               stats)

MEASURES = ["do_avg", "ph_avg", "bod_avg", "nitrate_avg", "fecal_coliform_avg", "total_coliform_avg"]


def measured(spark, rows):
    """Rows of measures given as dicts; the position is the station code."""
    data = [(str(i), *[r.get(m) for m in MEASURES]) for i, r in enumerate(rows)]
    return spark.createDataFrame(data, "stn_code string, " + ", ".join(f"{m} double" for m in MEASURES))


def by_station(df, *columns):
    rows = {r["stn_code"]: tuple(r[c] for c in columns) for r in df.collect()}
    return [rows[str(i)] if len(columns) > 1 else rows[str(i)][0] for i in range(len(rows))]


def test_bis_label_and_violations_at_the_limits(spark):
    rows = [
        {}, {"do_avg": 5.0, "ph_avg": 6.5, "bod_avg": 3.0, "fecal_coliform_avg": 500.0, "total_coliform_avg": 2500.0},
        {"do_avg": 4.99}, {"ph_avg": 8.5}, {"ph_avg": 8.51}, {"ph_avg": 6.49, "bod_avg": 3.01}, {"fecal_coliform_avg": 500.1},
        {"total_coliform_avg": 2500.1}, {"do_avg": math.nan},
    ]
    df = score.violations_bis(score.classify_bis(measured(spark, rows)))
    assert by_station(df, "safety_label", "violated_params") == [
        ("Safe", "None"), ("Safe", "None"), ("Unsafe", "Low DO"), ("Safe", "None"), ("Unsafe", "pH Out of Range"),
        ("Unsafe", "pH Out of Range, High BOD"), ("Unsafe", "High Fecal Coliform"), ("Unsafe", "High Total Coliform"),
        ("Safe", "None")]


def brute_100(r):
    parts = []
    if r.get("do_avg") is not None:
        parts.append(max(0, (5.0 - r["do_avg"]) / 5.0) * 100)
    if r.get("bod_avg") is not None:
        parts.append(min(100, r["bod_avg"] / 3.0 * 33.3))
    if r.get("ph_avg") is not None:
        ph = r["ph_avg"]
        parts.append((6.5 - ph) / 6.5 * 100 if ph < 6.5 else (ph - 8.5) / 8.5 * 100 if ph > 8.5 else 0)
    for name, limit in (("fecal_coliform_avg", 500.0), ("total_coliform_avg", 2500.0)):
        if r.get(name) is not None:
            parts.append(min(100, r[name] / limit * 10))
    return round(min(100.0, sum(parts) / len(parts)), 2) if parts else 0.0


def brute_10(r):
    def above(v, limit):
        return None if v is None else 0.0 if v <= limit else min((v - limit) / limit, 1.0)

    ph, do, fc = r.get("ph_avg"), r.get("do_avg"), r.get("fecal_coliform_avg")
    shares = [
        (None if ph is None else (6.5 - ph) / 6.5 if ph < 6.5 else min((ph - 8.5) / 8.5, 1.0) if ph > 8.5 else 0.0, 0.10),
        (None if do is None else 0.0 if do >= 6 else min((6 - do) / 6, 1.0), 0.20),
        (above(r.get("bod_avg"), 2.0), 0.25), (above(r.get("nitrate_avg"), 10.0), 0.15),
        (None if fc is None else 0.0 if fc <= 50 else min(math.log2(fc / 50) / math.log2(100), 1.0) ** 0.5, 0.30),
    ]
    shares = [(c, w) for c, w in shares if c is not None]
    if not shares:
        return None
    total = sum(w for _, w in shares)
    return round((max(c for c, _ in shares) * 0.6 + sum(c * w / total for c, w in shares) * 0.4) * 10, 3)


EDGES = [
    {}, {"ph_avg": 7.0}, {"fecal_coliform_avg": 50.0}, {"fecal_coliform_avg": 520.0}, {"fecal_coliform_avg": 5000.0},
    {"fecal_coliform_avg": 50000.0}, {"bod_avg": 2.0}, {"bod_avg": 4.0}, {"bod_avg": 6.0}, {"do_avg": 0.0}, {"ph_avg": 0.0},
    {"ph_avg": 14.0}, {"do_avg": 8.0, "ph_avg": 9.1, "bod_avg": 2.7, "nitrate_avg": 11.0, "fecal_coliform_avg": 73.0},
    {"do_avg": 3.3, "bod_avg": 500.0, "total_coliform_avg": 1e6}, {"nitrate_avg": 17.0},
]


def test_scores_match_brute_force(spark):
    df = score.score_10(score.score_100(measured(spark, EDGES), "score_100"))
    for (ten, hundred), r in zip(by_station(df, "pollution_score", "score_100"), EDGES):
        assert ten == pytest.approx(brute_10(r), abs=1e-9) if brute_10(r) is not None else ten is None
        assert hundred == pytest.approx(brute_100(r), abs=0.0051)
    assert by_station(df, "pollution_score")[:2] == [None, 0.0]


def test_class_a_labels(spark):
    rows = [{}, {"ph_avg": 8.6, "fecal_coliform_avg": 51.0}, {"do_avg": 5.9, "bod_avg": 2.1, "nitrate_avg": 10.1}, {"do_avg": 6.0}]
    df = score.classify_class_a(measured(spark, rows))
    assert by_station(df, "violated_params", "safety_label") == [
        ("", "Safe"), ("pH, Fecal Coliform", "Unsafe"), ("DO, BOD, Nitrate", "Unsafe"), ("", "Safe")]
    with pytest.raises(ValueError, match="Missing required columns: nitrate_avg"):
        score.score_10(df.drop("nitrate_avg"))


def test_cap_keeps_missing_values(spark):
    df = score.cap_outliers(measured(spark, [{"bod_avg": 508.5}, {}, {"bod_avg": 499.0}]))
    assert by_station(df, "bod_avg") == [500.0, None, 499.0]


def test_clean_uses_the_location_before_the_title(spark):
    df = spark.createDataFrame(
        [(None, " goa fort ", "River", "GOA", 2018, None, None, 600.0), ("12.0", None, None, "GOA", 2018, 7.0, 4.0, None)],
        "stn_code string, monitoring_location string, water_body_type string, state string, year int, do_avg double, ph_avg double, bod_avg double",
    ).withColumns({c: F.lit(None).cast("double") for c in ("nitrate_avg", "fecal_coliform_avg", "total_coliform_avg")})
    rows = {r["monitoring_location"]: r for r in score.clean_samples(df).collect()}
    import hashlib

    assert rows["Goa Fort"]["stn_code"] == "GEN-" + hashlib.md5(b"goa fort").hexdigest()[:6].upper()
    assert rows["Goa Fort"]["bod_avg"] == 500.0 and rows["Goa Fort"]["pollution_score"] == 100.0
    assert rows[""]["stn_code"] == "12" and rows[""]["violated_params"] == "pH Out of Range"


PAGES = [
    ("r/WQ_river.pdf", "river quality", ["11", "Kali\n  bridge", "GOA", "1", "3", None, "-", "6", "7", "8"]),
    ("r/x.pdf", "Type water body", ["12", "Bay", "Beach", "KARN ATAKA", "10", "", "5", "6", "7"]),
    ("r/x.pdf", "TDS and arsenic", ["13", "Well", "Tamil  Nadu", "20", "22", "7", "7.4", "100"]),
    ("r/x.pdf", "river", ["14", "Deep", "GOALPARA", "1", "1", "2", "2", "15", "16"]),
    ("r/x.pdf", "river", ["15", "", "GOA", "1", "1"]),
    ("r/x.pdf", "river", ["16", "Nowhere", "none", "1", "1"]),
    ("r/x.pdf", "river", ["Stn", "Code", "Monitoring", "GOA", "1"]),
    ("r/x.pdf", "river", ["17", "Short", "GOA"]),
    ("r/x.pdf", "river", ["18", "Empty", "J & K", "-", "N/A"]),
    ("r/x.pdf", "canal", ["19", "Lone", "Kerala", "1", "3", "5"]),
    ("r/x.pdf", "Type water body", ["20", "Spit", " ", "J&K", "9"]),
]


def test_extract_samples(spark):
    rows = spark.createDataFrame(
        [(p, p.split("/")[-1], 2020, 1, t, 1, i, c) for i, (p, t, c) in enumerate(PAGES)], S.PAGE_ROW)
    got = {r["stn_code"]: r for r in extract.extract_samples(rows).collect()}
    assert sorted(got) == ["11", "12", "13", "19", "20"]
    a = got["11"]
    assert (a["monitoring_location"], a["state"], a["water_body_type"]) == ("Kali bridge", "GOA", "River")
    # The missing cell is dropped first, so later cells move up; the lone last cell is ignored.
    assert (a["temperature_avg"], a["do_avg"], a["ph_avg"], a["conductivity_avg"]) == (2.0, 6.0, 7.5, None)
    b = got["12"]
    assert (b["water_body_type"], b["state"], b["temperature_avg"], b["do_avg"], b["ph_avg"]) == (
        "Beach", "KARNATAKA", 10.0, 5.5, 7.0)
    c = got["13"]
    assert (c["state"], c["temperature_avg"], c["ph_avg"], c["conductivity_avg"], c["do_avg"]) == (
        "TAMIL NADU", 21.0, 7.2, 100.0, None)
    assert got["19"]["do_avg"] is None and got["19"]["water_body_type"] == "Canal"
    assert got["20"]["water_body_type"] == "Coastal" and got["20"]["state"] == "J&K"


def series(spark, rows):
    return spark.createDataFrame(rows, "stn_code string, year int, pollution_score double")


def test_forecast_routes(spark):
    rows = [("one", 2020, 4.0), ("same", 2020, 2.0), ("same", 2020, 4.0), ("two", 2019, 1.0), ("two", 2020, 2.0),
            ("down", 2018, 3.0), ("down", 2019, 2.0), ("down", 2020, 1.0), ("flat", 2018, 2.0), ("flat", 2019, 2.0),
            ("flat", 2020, 2.0), ("none", 2020, None)]
    got = forecast.forecast_router(series(spark, rows), 3).collect()
    by = {}
    for r in sorted(got, key=lambda r: r["year"]):
        by.setdefault(r["stn_code"], []).append(r)
    assert sorted(by) == ["down", "flat", "one", "same", "two"] and all(len(v) == 3 for v in by.values())
    assert [(r["yhat"], r["yhat_lower"], r["yhat_upper"]) for r in by["one"]] == [(4.0, 2.0, 6.0)] * 3
    assert by["same"][0]["trend"] == "Fallback (last_value)" and by["same"][0]["yhat"] == 3.0
    assert [r["yhat"] for r in by["two"]] == pytest.approx([3.0, 4.0, 5.0]) and by["two"][0]["yhat_upper"] == pytest.approx(3.0)
    assert [r["yhat"] for r in by["down"]] == pytest.approx([0.0, 0.0, 0.0], abs=1e-9)
    assert by["down"][2]["yhat_lower"] == pytest.approx(-2.0) and by["down"][0]["trend"] == "Improving"
    assert by["flat"][0]["trend"] == "Stable" and by["flat"][0]["ds"] == "2021-01-01"
    with pytest.raises(ValueError):
        forecast.forecast_router(series(spark, rows), 21)


def test_backtest(spark):
    rows = [("a", y, float(y - 2015)) for y in range(2016, 2022)] + [("b", y, 0.0) for y in (2018, 2019, 2020, 2021)]
    rows += [("short", y, 1.0) for y in (2019, 2020, 2021)] + [("late", y, 1.0) for y in (2016, 2017, 2018, 2019)]
    rows += [("c", 2017, 1.0), ("c", 2018, 3.0), ("c", 2020, 2.0), ("c", 2021, 4.0)]
    got = {r["stn_code"]: r for r in forecast.forecast_backtest(series(spark, rows), 2020).collect()}
    assert sorted(got) == ["a", "b", "c"]
    assert got["a"]["mae"] == pytest.approx(0.0) and got["b"]["mape"] is None
    slope, base = np.polyfit([2017, 2018, 2020], [1.0, 3.0, 2.0], 1)
    assert got["c"]["predicted"] == pytest.approx(base + slope * 2021)


def test_latest_takes_the_last_known_value_per_column(spark):
    df = spark.createDataFrame(
        [("a", 2019, 1, 5.0, "x"), ("a", 2020, 1, None, "y"), ("a", 2020, 2, None, None), (None, 2020, 1, 1.0, "z"),
         ("b", None, 1, 9.0, "q")], "stn_code string, year int, k1 int, do_avg double, t string")
    got = latest.latest_per_station(df, order=["year", "k1"], columns=["do_avg", "t", "year"]).collect()
    assert [tuple(r) for r in got] == [("a", 5.0, "y", 2020)]
    whole = latest.latest_row(df, order=["year", "k1"]).collect()
    assert [(r["stn_code"], r["year"], r["do_avg"], r["t"]) for r in whole] == [("a", 2020, None, None)]


def test_trend_uses_the_first_and_last_year(spark):
    df = spark.createDataFrame(
        [("a", 2018, 1.0), ("a", 2019, 9.0), ("a", 2020, None), ("b", 2018, 2.0), ("b", 2020, 1.0)],
        "stn_code string, year int, do_avg double")
    got = {r["stn_code"]: tuple(r)[2:] for r in stats.trend_summary(df, ["do_avg"]).collect()}
    assert got == {"a": (1.0, 9.0, None, "Stable"), "b": (1.0, 2.0, 1.0, "Worsening")}


def test_empty_summaries(spark):
    empty = score.scored(measured(spark, [])).withColumns(
        {"year": F.lit(2020), "monitoring_location": F.lit("x"), "conductivity_avg": F.lit(1.0)})
    row = stats.overview_stats(empty).collect()[0]
    assert (row["total_stations"], row["safe_percentage"], row["avg_pollution_score"]) == (0, 0.0, None)
    assert {r["violation_percentage"] for r in stats.parameter_stats(empty).collect()} == {0.0}
    assert stats.most_common_violation(empty).count() == 0


def test_compare(spark):
    df = spark.createDataFrame(
        [("a", 2019, 7.0, 3.0), ("a", 2020, 4.0, 2.0), ("b", 2018, 8.0, 2.0), ("c", 2020, 1.0, None)],
        "stn_code string, year int, do_avg double, pollution_score double").withColumns(
        {c: F.lit(1.0) for c in ("bod_avg", "ph_avg", "nitrate_avg", "fecal_coliform_avg")})
    pairs = spark.createDataFrame([("a", "b"), ("c", "a"), ("c", "c"), ("a", "zz")], "station_a string, station_b string")
    got = {(r["station_a"], r["station_b"]): r for r in compare.compare_stations(df, pairs).filter(
        F.col("parameter") == "do_avg").collect()}
    assert {k: v["winner"] for k, v in got.items()} == {
        ("a", "b"): "a", ("c", "a"): "a", ("c", "c"): "c", ("a", "zz"): None}
    unknown = got["a", "zz"]
    assert (unknown["year_a"], unknown["a_value"], unknown["year_b"], unknown["b_value"]) == (2020, 4.0, None, None)
    assert (unknown["a_pollution_score"], unknown["b_pollution_score"]) == (2.0, None)
    assert (got["a", "b"]["a_status"], got["a", "b"]["b_status"]) == ("violation", "ok")
    asked = spark.createDataFrame([("a", 2019, 2020), ("a", 2000, 2019), ("zz", 1, 2)], "stn_code string, year_a int, year_b int")
    got = {(r["year_a"], r["year_b"]): r for r in compare.compare_years(df, asked).filter(
        F.col("parameter") == "do_avg").collect()}
    assert got[2019, 2020]["change"] == "Worsened"
    assert got[2000, 2019]["a_value"] == 4.0 and got[2000, 2019]["change"] == "Improved"


def test_gazetteer_takes_the_best_ranked_hit(spark):
    places = spark.createDataFrame([("Upper Kali Town", "Goa"), ("Unknown Spot", "Goa"), ("Upper Kali Town", "Goa")],
                                   "monitoring_location string, state string")
    known = spark.createDataFrame([("town, Goa, India", 1.0, 2.0), ("kali town, Goa, India", 3.0, 4.0)], "query string, lat double, lng double")
    got = {r["monitoring_location"]: r for r in locate.join_gazetteer_ranked(places, known).collect()}
    assert (got["Upper Kali Town"]["lat"], got["Upper Kali Town"]["query"]) == (3.0, "kali town, Goa, India")
    miss = got["Unknown Spot"]
    assert (miss["success"], miss["lat"], miss["query"]) == (False, None, "unknown spot, Goa, India")
    odd = spark.createDataFrame([("Kali", None), (None, "Goa"), (None, None)], "monitoring_location string, state string")
    got = {(r["monitoring_location"], r["state"]): r["success"] for r in locate.join_gazetteer_ranked(odd, known).collect()}
    assert got == {("Kali", ""): False, ("", "Goa"): False, ("", ""): False}


def test_chunks_stop_at_the_end(spark):
    docs = spark.createDataFrame([(1, " ".join(map(str, range(10)))), (2, "a b"), (3, "  "), (4, None), (5, " ".join(map(str, range(11))))],
                                 "doc_id int, text string")
    got = {}
    for r in knowledge.chunk_tokens(docs, ["doc_id"], size=4, overlap=1).collect():
        got.setdefault(r["doc_id"], []).append((r["chunk_index"], r["document"]))
    assert sorted(got) == [1, 2, 5]
    assert got[1] == [(0, "0 1 2 3"), (1, "3 4 5 6"), (2, "6 7 8 9")]
    assert got[5][-1] == (3, "9 10") and got[2] == [(0, "a b")]
    for bad in ((0, 0), (4, 4), (4, -1)):
        with pytest.raises(ValueError):
            knowledge.chunk_tokens(docs, ["doc_id"], size=bad[0], overlap=bad[1])


@pytest.mark.parametrize("size, overlap, block", [(4, 1, 2), (7, 3, 1), (3, 0, 5), (50, 10, 3)])
def test_chunk_pages_equals_chunks_of_the_joined_text(spark, size, overlap, block):
    import random

    rng = random.Random(size)
    rows = [(d, p, " ".join(f"w{rng.randrange(99)}" for _ in range(rng.choice([0, 1, 2, 9, 30]))))
            for d in range(6) for p in range(rng.randrange(1, 12))]
    pages = spark.createDataFrame(rows, "doc int, page int, text string")
    whole = knowledge.chunk_tokens(knowledge.join_pages_text(pages, "doc", "page"), ["doc"], size=size, overlap=overlap)
    parts = knowledge.chunk_pages(pages, "doc", "page", size=size, overlap=overlap, block=block)
    key = lambda df: sorted((r["doc"], r["chunk_index"], r["document"]) for r in df.collect())
    assert key(whole) == key(parts)


def test_knn_in_blocks_equals_brute_force(spark):
    rng = np.random.default_rng(1)
    vectors = rng.integers(0, 4, (200, 3)).astype(float)
    chunks = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id int, embedding array<float>").repartition(5)
    queries = spark.createDataFrame([(q, vectors[q].tolist()) for q in range(7)], "query_id int, embedding array<float>")
    got = sorted((r["query_id"], r["rank"], r["chunk_id"]) for r in knowledge.knn_topk(chunks, queries, 4, block_size=3).collect())
    want = []
    for q in range(7):
        d = ((vectors - vectors[q]) ** 2).sum(1)
        want += [(q, n + 1, int(i)) for n, i in enumerate(sorted(range(200), key=lambda i: (d[i], i))[:4])]
    assert got == want
    assert knowledge.knn_topk(chunks, queries, 0).count() == 0
    assert knowledge.knn_topk(chunks, queries.limit(0), 3).count() == 0
    assert knowledge.knn_topk(chunks.limit(0), queries, 3).count() == 0


def test_knn_with_many_queries_and_blocks(spark):
    rng = np.random.default_rng(5)
    vectors = rng.integers(0, 4, (9000, 6)).astype(float)  # many ties
    chunks = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id int, embedding array<float>").coalesce(2)
    odd = spark.createDataFrame([(-1, None), (None, [0.0] * 6), (-2, []), (-3, [None] + [0.0] * 5)], "vec_id int, embedding array<float>")
    queries = spark.createDataFrame([(f"q{q}", vectors[3 * q].tolist()) for q in range(3000)], "query_id string, embedding array<float>")
    got = {}
    for r in knowledge.knn_topk(chunks.union(odd), queries.union(odd.withColumn("vec_id", F.col("vec_id").cast("string"))), 5).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["distance"], r["chunk_id"])
    assert len(got) == 3000
    for q in range(3000):
        d = ((vectors - vectors[3 * q]) ** 2).sum(1)
        want = np.lexsort((np.arange(9000), d))[:5]
        assert [got[f"q{q}"][n + 1] for n in range(5)] == [(d[i], i) for i in want]


def test_ingest_replaces_sources_with_words(spark):
    store = spark.createDataFrame([("a", 0, "old", "x_0"), ("a", 1, "old too", "x_1"), ("b", 0, "kept", "y_0"), ("c", 0, "kept too", "z_0")],
                                  "source string, chunk_index int, document string, id string")
    pages = spark.createDataFrame([("a", 2, "three four five"), ("a", 1, "one two"), ("c", 1, "  "), ("c", 2, None), ("d", 1, "new")],
                                  "source string, page int, text string")
    got = sorted(tuple(r) for r in knowledge.ingest_pages(store, pages, "page", size=3, overlap=1).drop("id").collect())
    assert got == [("a", 0, "one two three"), ("a", 1, "three four five"), ("b", 0, "kept"), ("c", 0, "kept too"), ("d", 0, "new")]


def test_batch_reads_accepted_files_only(spark):
    cells = ["12", " Site\n a ", "KARNATAKA", "10", "12", "7", "7", "7.1", "7.3", "100", "120", "9", "9"]
    rows = [("NWMP_DATA_2020.pdf", 2020, cells), ("NWMP_DATA_2019.pdf", 2020, cells), (None, 2020, cells),
            ("NWMP_DATA_2020.pdf", 2020, ["13", "Site b", "KERALA", *cells[3:]]), ("NWMP_DATA_2020.pdf", 2020, None)]
    pages = spark.createDataFrame([("/r/" + (f or "x"), f, y, 1, "river", 1, 1, c) for f, y, c in rows], S.PAGE_ROW)
    cache = spark.createDataFrame([("Site A", "KARNATAKA", 12.5, 75.0, "q", True)],
                                  "monitoring_location string, state string, lat double, lng double, query string, success boolean")
    got = {r["stn_code"]: r for r in batch.predict_batch(pages, cache).collect()}
    assert sorted(got) == ["12", "13"] and (got["12"]["latitude"], got["13"]["latitude"]) == (12.5, None)
    assert got["12"]["violated_params"] == "BOD" and got["12"]["safety_label"] == "Unsafe"
    assert [r["stn_code"] for r in batch.predict_batch(pages, cache, state="Karnataka").collect()] == ["12"]
    assert sorted((r["file_name"] or "") for r in batch.rejected_files(pages).collect()) == ["", "NWMP_DATA_2019.pdf"]
    assert batch.predict_batch(pages.limit(0), cache).count() == 0


def test_chat_fields_default_where_the_request_knew_nothing(spark):
    replies = spark.createDataFrame([(1, "no answer", False, None, [])], "request_id int, reply string, has_station boolean, "
                                    "safety_label string, violations array<struct<parameter string, value string, limit_text string, status string>>")
    row = knowledge.merge_chat_answer(replies).first()
    assert (row["sources_used"], row["station_name"], row["violated_params"], row["has_station_context"]) == (0, None, [], False)


def test_histogram_and_box(spark):
    df = spark.createDataFrame([("a", float(v)) for v in [0, 1, 2, 3, 4, 5, 6, 7, 8, 100]] + [("b", 5.0), ("b", None)],
                               "water_body_type string, pollution_score double")
    bins = [r["n"] for r in evaluate.score_histogram(df, bins=10).collect()]
    assert sum(bins) == 11 and bins[0] == 10 and bins[-1] == 1
    flat = evaluate.score_histogram(df.filter(F.col("water_body_type") == "b"), bins=4).collect()
    assert [(r["lower"], r["n"]) for r in flat] == [(4.5, 0), (4.75, 0), (5.0, 1), (5.25, 0)]
    box = {r["water_body_type"]: r for r in evaluate.box_stats(df).collect()}
    assert (box["a"]["median"], box["a"]["high_whisker"], box["a"]["outliers"]) == (4.5, 8.0, 1)


def test_metrics_without_a_class(spark):
    df = spark.createDataFrame([("Unsafe", "Unsafe")] * 3, "actual string, predicted string")
    got = {r["metric"]: r["value"] for r in evaluate.classification_metrics(df, "actual", "predicted").collect()}
    assert got["Precision (Safe)"] == 0.0 and got["F1 (Unsafe)"] == 1.0 and got["Accuracy"] == 1.0
    assert len(evaluate.confusion_matrix(df, "actual", "predicted").collect()) == 4


def test_enrich_with_insights(spark):
    df = measured(spark, [{"bod_avg": 9.0}, {}]).withColumn("water_body_type", F.lit("River"))
    insights = spark.createDataFrame([("BOD", "River", [" act ", "", "act", "b"])],
                                     "violated_params string, water_body_type string, recommended_measures array<string>")
    assert by_station(explain.enrich_samples(df, insights), "measures") == ['["act","b"]', "[]"]
    assert by_station(explain.enrich_samples(df), "causes")[1] == "[]"
    assert by_station(explain.enrich_samples(df), "impacts")[0] == f'["{R.PARAMETER_KNOWLEDGE["BOD"][1]}"]'


def test_shaping(spark):
    df = spark.createDataFrame([("1", "x", None, 15.0), ("2", "x", "GOA", 14.0), ("3", "", "GOA", 7.0), ("4", "y", "GOA", None)],
                               "stn_code string, monitoring_location string, state string, ph_avg double")
    assert [r["stn_code"] for r in shaping.drop_invalid_rows(df).collect()] == ["2", "4"]
    assert [r["stn_code"] for r in shaping.drop_all_null_params(df).collect()] == ["1", "2", "3"]
    assert set(S.SCORED_PARAMETERS) <= set(shaping.ensure_columns(df).columns)
    assert shaping.project_known_columns(df, ["state", "zz", "stn_code"]).columns == ["state", "stn_code"]


def test_forecast_of_large_values(spark):
    from rivulet.operators import forecast

    rows = [("1", y, 5e6 + y) for y in (2016, 2017, 2018, 2019)]
    df = spark.createDataFrame(rows, "stn_code string, year int, pollution_score double")
    found = forecast.forecast_router(df, horizon=2).collect()
    assert found and all("1" == r.stn_code for r in found)


def test_box_stats_and_histogram_of_edge_rows(spark):
    rows = spark.createDataFrame([("a", 1.0), ("a", 2.0), (None, 3.0), (None, None), ("b", 5.0)],
                                 "water_body_type string, pollution_score double")
    boxes = {r["water_body_type"]: (r["q1"], r["median"], r["q3"], r["outliers"]) for r in evaluate.box_stats(rows).collect()}
    assert boxes == {"a": (1.25, 1.5, 1.75, 0), None: (3.0, 3.0, 3.0, 0), "b": (5.0, 5.0, 5.0, 0)}
    assert [r["n"] for r in evaluate.score_histogram(rows, bins=3).orderBy("bin").collect()] == [2, 1, 1]
    assert evaluate.box_stats(rows.limit(0)).count() == 0
    assert {r["n"] for r in evaluate.score_histogram(rows.limit(0)).collect()} == {0}
