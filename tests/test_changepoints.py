"""Divided trends against a search of every division."""

from __future__ import annotations

import itertools
import math
import random

import numpy as np
import pytest

from rivulet.operators import changepoints, forecast

SCHEMA = "stn_code string, year int, pollution_score double"


def line_cost(points):
    x, y = np.array([p[0] for p in points], float), np.array([p[1] for p in points])
    slope, base = np.polyfit(x - x.mean(), y, 1)
    return float(((y - base - slope * (x - x.mean())) ** 2).sum())


def best_division(points, penalty, least=3):
    """Least cost over all divisions, each tried by itself."""
    n, found = len(points), []
    price = penalty * math.log(n) * line_cost(points) / (n - 2)
    for breaks in range(n // least):
        for cuts in itertools.combinations(range(least, n - least + 1), breaks):
            ends = [0, *cuts, n]
            if all(b - a >= least for a, b in itertools.pairwise(ends)):
                cost = sum(line_cost(points[a:b]) for a, b in itertools.pairwise(ends)) + price * breaks
                found.append((cost, breaks, ends[:-1]))
    return min(found)


def solve(spark, rows, **options):
    got = changepoints.changepoint_segments(spark.createDataFrame(rows, SCHEMA), **options).collect()
    return {r["stn_code"]: r for r in got}


@pytest.mark.parametrize("penalty", [0.0, 0.4, 3.0])
def test_equals_the_best_of_all_divisions(spark, penalty):
    rng = random.Random(5)
    series = {}
    for s in range(40):
        years = sorted(rng.sample(range(1990, 2012), rng.randint(3, 14)))
        level, slope = rng.uniform(20, 60), rng.uniform(-2, 2)
        series[f"s{s}"] = [(y, round(level + slope * (y - 1990) + (20 if y > 2001 else 0) + rng.gauss(0, 2), 3)) for y in years]
    rows = [(s, y, v) for s, points in series.items() for y, v in points]
    rng.shuffle(rows)
    got = solve(spark, rows, penalty=penalty)
    assert set(got) == set(series)
    broken = 0
    for s, points in series.items():
        cost, breaks, starts = best_division(points, penalty)
        segments = got[s]["segments"]
        assert [x["first_year"] for x in segments] == [points[i][0] for i in starts], s
        price = penalty * math.log(len(points)) * line_cost(points) / (len(points) - 2)
        assert got[s]["error"] / 1e6 == pytest.approx(cost - price * breaks, abs=1e-4)
        broken += breaks
    assert broken > 0


def test_ties_prefer_fewer_segments_then_the_earlier_break(spark):
    rows = [("line", 2000 + i, 1.5 * i) for i in range(12)] + [("flat", 2000 + i, 4.0) for i in range(12)]
    # A mirror image of itself, so breaks at both ends cost the same.
    rows += [("mirror", 2000 + i, v) for i, v in enumerate([0.0, 0.0, 0.0, 9.0, 9.0, 0.0, 0.0, 0.0])]
    got = solve(spark, rows, penalty=0.0)
    assert len(got["line"]["segments"]) == len(got["flat"]["segments"]) == 1
    points = [(y, v) for s, y, v in rows if s == "mirror"]
    assert [x["first_year"] for x in got["mirror"]["segments"]][1] == points[3][0]


def test_short_series_unknown_values_and_repeated_years(spark):
    rows = [("two", 2000, 1.0), ("two", 2001, 2.0), ("gone", 2000, None), (None, 2000, 1.0),
            ("three", 2000, 1.0), ("three", 2000, 3.0), ("three", 2004, 4.0), ("three", 2009, 5.0), ("three", None, 9.0)]
    got = solve(spark, rows)
    assert list(got) == ["three"]
    assert (got["three"]["years"], len(got["three"]["segments"])) == (3, 1)
    assert changepoints.forecast_changepoints(
        changepoints.changepoint_segments(spark.createDataFrame([], SCHEMA))).count() == 0
    for wrong in ({"least_points": 2}, {"penalty": -1.0}, {"penalty": float("nan")}):
        with pytest.raises(ValueError):
            changepoints.changepoint_segments(spark.createDataFrame(rows, SCHEMA), **wrong)


def test_forecast_follows_the_last_segment(spark):
    rng = random.Random(2)
    rows = [("up", 1990 + i, 10.0 + (0 if i < 20 else 4.0 * (i - 20)) + rng.gauss(0, 0.3)) for i in range(30)]
    rows += [("calm", 1990 + i, 30.0 + rng.gauss(0, 1)) for i in range(30)]
    df = spark.createDataFrame(rows, SCHEMA)
    segments = changepoints.changepoint_segments(df)
    by = {r["stn_code"]: r for r in segments.collect()}
    assert len(by["calm"]["segments"]) == 1 and abs(by["up"]["segments"][-1]["first_year"] - 2010) <= 1
    lines = {(r["stn_code"], r["segment"]): r for r in changepoints.segment_lines(segments).collect()}
    assert lines["up", len(by["up"]["segments"])]["slope"] == pytest.approx(4.0, abs=0.3)
    found = sorted(changepoints.forecast_changepoints(segments, 3).filter("stn_code = 'up'").collect(), key=lambda r: r["year"])
    assert [r["year"] for r in found] == [2020, 2021, 2022] and {r["trend"] for r in found} == {"Worsening"}
    assert found[0]["yhat"] == pytest.approx(50.0, abs=1.5)
    widths = [r["yhat_upper"] - r["yhat_lower"] for r in found]
    assert 0 < widths[0] < widths[1] < widths[2]
    flat = {r["stn_code"]: r["yhat"] for r in forecast.forecast_trend(forecast.station_lines(df), 3).collect()}
    assert abs(flat["up"] - 50) > 10
    tested = {r["stn_code"]: r for r in changepoints.changepoint_backtest(df, 2018).collect()}
    assert tested["up"]["broken_error"] < 2 < tested["up"]["line_error"] and tested["calm"]["breaks"] == 0
    assert tested["calm"]["broken"] == tested["calm"]["line"]


def test_a_station_with_most_samples_costs_its_years_only(spark):
    from pyspark.sql import functions as F

    hot = spark.range(300_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 50)).alias("stn_code"),
        (1950 + F.floor(F.col("id") / 3) % 70).cast("int").alias("year"), (F.col("id") % 97).cast("double").alias("pollution_score"))
    segments = changepoints.changepoint_segments(hot)
    plan = segments._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("Aggregate") == 2
    got = {r["stn_code"]: r["years"] for r in segments.select("stn_code", "years").collect()}
    assert len(got) == 51 and got["hot"] == 70
